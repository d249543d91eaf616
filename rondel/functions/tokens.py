"""Token expressions for the two tokenising rules and their stop lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Stop words removed by the "nonword" rule.
NONWORD_STOP_WORDS = (
    "a", "an", "the", "and", "or", "of", "in", "on", "at", "to",
    "for", "with", "by", "from", "is", "it", "its", "as", "be",
    "was", "are", "were", "this", "that", "not", "but", "if",
    "vs", "de", "la", "le",
)

# Stop words removed by the "alnum" rule.
ALNUM_STOP_WORDS = (
    "vs", "the", "and", "or", "of", "in", "on", "at", "to", "a", "an", "is", "it", "by", "for",
)

STOP_WORDS = {"nonword": NONWORD_STOP_WORDS, "alnum": ALNUM_STOP_WORDS}

# Shortest token either rule keeps.
MIN_TOKEN_LENGTH = 2


def token_array(text: Column, rule: str) -> Column:
    """All pieces of ``text``, empty ones included.

    ``nonword`` cuts at every run of characters other than ASCII letters, digits and ``_``;
    ``alnum`` also cuts at ``_``. Accented letters separate tokens under both rules.
    """
    lowered = F.lower(text)
    if rule == "nonword":
        return F.split(lowered, r"[\s\W]+")
    if rule == "alnum":
        return F.split(lowered, "[^a-z0-9]+")  # white space is among them
    raise ValueError(f"unknown tokenising rule {rule!r}")


def is_kept(token: Column, rule: str, stop_words=None, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    words = STOP_WORDS[rule] if stop_words is None else tuple(stop_words)
    long_enough = F.length(token) >= min_length
    return long_enough & ~token.isin(*words) if words else long_enough
