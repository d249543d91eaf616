"""Whole texts to token ids with the vocabularies of the ``tokenizers`` library.

The library spends its time in splitting and merging, not in looking things up, and words repeat. Both kinds
of vocabulary supported here never merge across a space between two other signs, so texts are cut there, all texts of a
span at once as Arrow columns. Each different word is looked at once per span; the library encodes its parts when they
are first met, and their ids are kept in a cache of bounded size, from which those go first that were met once. Ids of
texts are then gathered as arrays.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries kept by a worker process, of stems (letters only) and of other words and signs; about 50 bytes each, and as much
# while they are looked up.
CACHE_STEMS = 300_000
CACHE_WORDS = 100_000
LONGEST = 32            # characters of an entry on average, beyond which fewer are kept
ENCODED_AT_ONCE = 1 << 22  # characters; a longer text is encoded alone
# Letters on whose class every vocabulary agrees, then signs; such a word falls into these two parts.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = ".,;:!?|%&$#*"
# Ids one run after another, and the length or the bounds of each run.
Runs = tuple[np.ndarray, np.ndarray]
SIGN_BEHIND_LETTER = re.compile(f"[{_LETTERS}][{re.escape(_SIGNS)}]")
# White space other than single spaces and line breaks between words.
_RARE = "".join(c for c in map(chr, range(0x10000)) if c.isspace() and c not in " \n")
_SPACING = f"[{_RARE}]|[ \n][ \n]|^[ \n]|[ \n]$"


def vocabulary(name: str) -> str:
    """Where the named public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


def spans(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of together about ``most`` characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs with these starts and lengths, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def masked(mask: pa.Array) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False)


def _letters(strings: pa.Array) -> int:
    return pc.sum(pc.utf8_length(strings)).as_py() or 0


class Slots:
    """Ids of strings by one or several vocabularies; per vocabulary they are runs of one array. Slot 0 is empty.

    The strings are Arrow columns too: as Python objects they would take several times the room.
    """

    def __init__(self, most: int, vocabularies: int = 1):
        self.most, self.vocabularies = most, vocabularies
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, tuple[pa.Array, np.ndarray]] = {}  # strings of each kind and their slots
        self.ids = [np.empty(0, "<u4")] * self.vocabularies
        self.starts = [np.zeros(2, np.int64)] * self.vocabularies
        self.again = np.zeros(1, bool)  # which slots were asked for again since they were learned or last kept
        self.letters = 0

    def full(self) -> bool:
        return len(self.again) > self.most or self.letters > LONGEST * self.most

    def thin(self) -> None:
        """Keeps the strings that were asked for again; if they are more than half of what there may be, none."""
        keep = self.again.copy()
        keep[0] = True
        at = {kind: (strings.filter(pa.array(keep[slots])), slots[keep[slots]]) for kind, (strings, slots) in self.at.items()}
        letters = sum(_letters(strings) for strings, _ in at.values())
        if 2 * keep.sum() > self.most or 2 * letters > LONGEST * self.most:
            self.clear()
            return
        new, stay = np.cumsum(keep) - 1, np.flatnonzero(keep)
        self.at = {kind: (strings, new[slots]) for kind, (strings, slots) in at.items()}
        for k in range(self.vocabularies):
            self.ids[k], lengths = self.runs(stay[:, None], k)
            self.starts[k] = np.concatenate(([0], np.cumsum(lengths)))
        self.again, self.letters = np.zeros(len(stay), bool), letters

    def find(self, kind: str, strings: pa.Array, learn: Callable[[list[str]], list[Runs]]) -> np.ndarray:
        """The slots of different ``strings``; ``learn`` gives the ids of those not met before, by each vocabulary."""
        known, slots = self.at.get(kind, (pa.array([], pa.string()), np.empty(0, np.int64)))
        place = pc.index_in(strings, value_set=known)
        new = masked(place.is_null())
        found = np.empty(len(strings), np.int64)
        found[~new] = slots[place.drop_null().to_numpy()]
        self.again[found[~new]] = True
        if new.any():
            fresh = strings.filter(pa.array(new))
            found[new] = np.arange(len(self.again), len(self.again) + len(fresh))
            for k, (ids, lengths) in enumerate(learn(fresh.to_pylist())):
                self.starts[k] = np.concatenate((self.starts[k], self.starts[k][-1] + np.cumsum(lengths)))
                self.ids[k] = np.concatenate((self.ids[k], ids))
            self.at[kind] = pa.concat_arrays([known, fresh]), np.concatenate((slots, found[new]))
            self.again = np.concatenate((self.again, np.zeros(len(fresh), bool)))
            self.letters += _letters(fresh)
        return found

    def runs(self, slots: np.ndarray, k: int) -> Runs:
        """The ids of each row of ``slots`` by vocabulary ``k``, one after another, and their numbers."""
        one = slots.reshape(-1)
        starts, lengths = self.starts[k][one], self.starts[k][one + 1] - self.starts[k][one]
        return self.ids[k][ragged(starts, lengths)], lengths.reshape(slots.shape).sum(axis=1)


def flat(found: list[list[int]]) -> Runs:
    """Lists of ids as one array, and their numbers."""
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), "<u4", lengths.sum()), lengths


class PartCache:
    """Ids of texts that are cut at every space, from the ids of the parts of words, which are kept.

    A word of letters and signs behind them falls into these two parts, others are one. A word's ids depend on whether a
    space or a line break is in front: ``before`` is one of ``sides``, a space or nothing. Each vocabulary has
    ``stem_ids`` and ``word_ids`` of ``(strings, before)`` and the ids of a line break, ``line``.
    """

    def __init__(self, vocabularies: list, stems: int, words: int, sides: tuple[str, ...] = (" ", ""), lower: bool = False,
                 by_part: bool = True):
        """``lower``: case makes no difference. ``by_part``: words may be taken apart."""
        self.vocabularies, self.sides, self.lower, self.by_part = vocabularies, sides, lower, by_part
        self.stems, self.others = Slots(stems, len(vocabularies)), Slots(words, len(vocabularies))

    def _words(self, before: str) -> Callable[[list[str]], list[Runs]]:
        return lambda strings: [v.word_ids(strings, before) for v in self.vocabularies]

    def _stems(self, before: str) -> Callable[[list[str]], list[Runs]]:
        return lambda strings: [v.stem_ids(strings, before) for v in self.vocabularies]

    def _learned(self, names: pa.Array) -> Iterator[Runs]:
        """By each vocabulary the ids of different words. One that begins a line has the line break in front."""
        first = masked(pc.starts_with(names, "\n"))
        words = pc.utf8_ltrim(names, "\n")
        stems = pc.utf8_rtrim(words, _SIGNS)
        simple = masked(pc.match_substring_regex(stems, f"^[{_LETTERS}]+$")) & self.by_part
        filled = masked(pc.not_equal(words, ""))
        core, other = np.zeros((len(names), 1), np.int64), np.zeros((len(names), 2), np.int64)
        for before, here in zip(self.sides, (~first, first)):
            split = stems.filter(pa.array(here & simple))
            if self.lower:
                split = pc.utf8_lower(split)
            split = split.dictionary_encode()
            slots = self.stems.find(before, split.dictionary, self._stems(before))
            core[here & simple, 0] = slots[split.indices.to_numpy()]
            here = here & ~simple & filled
            other[here, 0] = self.others.find(before, words.filter(pa.array(here)), self._words(before))
        signs = pc.replace_substring_regex(words.filter(pa.array(simple)), f"^[{_LETTERS}]+", "").dictionary_encode()
        slots = self.others.find("signs", signs.dictionary, self._words(""))
        other[simple, 1] = slots[signs.indices.to_numpy()]

        for k, vocabulary_ in enumerate(self.vocabularies):
            # The line break, the letters, then signs or the whole word.
            line = vocabulary_.line
            ids, lengths = zip(self.stems.runs(core, k), self.others.runs(other, k))
            sizes = np.stack((np.where(first, len(line), 0), *lengths), axis=1)
            ends = np.cumsum(sizes.reshape(-1)).reshape(sizes.shape)
            out = np.empty(ends[-1, -1] if len(ends) else 0, "<u4")
            for i, part in enumerate((np.tile(line, first.sum()), *ids)):
                out[ragged(ends[:, i] - sizes[:, i], sizes[:, i])] = part
            yield out, sizes.sum(axis=1)

    def gathered(self, cut: pa.Array) -> list[Runs]:
        """By each vocabulary the ids of the texts, one after another, and where each text begins and ends among them."""
        for slots in (self.stems, self.others):
            if slots.full():
                slots.thin()
        words = pc.split_pattern(cut, " ")
        bounds = np.concatenate(([0], np.cumsum(words.value_lengths().to_numpy())))
        names = words.flatten().dictionary_encode()
        at, out = names.indices.to_numpy(), []
        for ids, lengths in self._learned(names.dictionary):
            sizes = lengths[at]
            ends = np.concatenate(([0], np.cumsum(sizes)))
            out.append((ids[ragged((np.cumsum(lengths) - lengths)[at], sizes)], ends[bounds]))
        return out


class WordCache:
    """``encode(texts)`` gives the same ids as the library's own encoding of each whole text."""

    def __init__(self, path: str, stems: int = CACHE_STEMS, words: int = CACHE_WORDS, plain: bool = False):
        """``plain`` reads the strings of special tokens as ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if plain:
            self.library.encode_special_tokens = True
        # A byte-level vocabulary keeps spaces: ids of a word depend on the space before it, and case matters.
        self.keeps_space = self.library.pre_tokenizer.__class__.__name__ == "ByteLevel"
        # Strings with an id of their own may reach over spaces or take them in.
        added = self.library.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.added_lower = [t.content.lower() for t in added if t.normalized or not self.keeps_space]
        self.line = np.frombuffer(self._ids("\n"), "<u4") if self.keeps_space else np.empty(0, "<u4")
        self.parts = PartCache([self], stems, words, (" ", "") if self.keeps_space else ("",), lower=not self.keeps_space)
        # Which ids begin a word behind a space, or end one.
        entries = self.library.get_vocab()
        self.edge = np.zeros(max(entries.values(), default=0) + 1, bool)
        self.edge[[i for x, i in entries.items() if (x.startswith("Ġ") if self.keeps_space else x.endswith("</w>"))]] = True

    def _ids(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def word_ids(self, words: list[str], before: str) -> Runs:
        found: list[list[int]] = []
        for i in range(0, len(words), 1000):
            found += [x.ids for x in self.library.encode_batch_fast([before + w for w in words[i:i + 1000]], add_special_tokens=False)]
        return flat(found)

    def stem_ids(self, stems: list[str], before: str) -> Runs:
        """Many stems as one text. Where each begins or ends shows in its ids, else the stems are encoded singly."""
        ids, lengths = [], []
        for i in range(0, len(stems), 1000):
            part = stems[i:i + 1000]
            text = " " + " ".join(part) if before or not self.keeps_space else "\n".join(part) + "\n"
            got = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            if not self.keeps_space:
                ends = np.flatnonzero(self.edge[got]) + 1
            elif before:
                ends = np.append(np.flatnonzero(self.edge[got])[1:], len(got))
            else:
                stay = got != self.line[0]
                ends, got = np.cumsum(stay)[~stay], got[stay]
            if len(ends) == len(part) and ends[-1] == len(got) and not self._holds_added(text):
                ids.append(got)
                lengths.append(np.diff(ends, prepend=0))
            else:
                one, n = self.word_ids(part, before)
                ids.append(one)
                lengths.append(n)
        return np.concatenate(ids), np.concatenate(lengths)

    def _holds_added(self, text: str) -> bool:
        if any(s in text for s in self.added):
            return True
        lower = text.lower() if self.added_lower else ""
        return any(s in lower for s in self.added_lower)

    def encode(self, texts: list[str | None], lead: str = "") -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is an empty text.

        ``lead`` may be a space that is read before each text that is not empty.
        """
        return [x for s, e in spans(texts, ENCODED_AT_ONCE) for x in self._encode_span([t or "" for t in texts[s:e]], lead)]

    def whole(self, texts: list[str], column: pa.Array) -> np.ndarray:
        """The texts that the library reads whole: strings in them have ids of their own, or spaces can be part of longer tokens."""
        out = np.fromiter(map(self._holds_added, texts), bool, len(texts))
        return out | masked(pc.match_substring_regex(column, _SPACING)) if self.keeps_space else out

    def _encode_span(self, texts: list[str], lead: str) -> list[bytes]:
        column = pa.array(texts, pa.string())
        whole = self.whole(texts, column)
        cut = column.filter(pa.array(~whole & masked(pc.not_equal(column, ""))))
        if not self.keeps_space:  # an end of line gives no id and only parts words
            cut = pc.replace_substring(cut, "\n", " ")
        else:
            cut = pc.replace_substring(cut, "\n", " \n")
            if not lead:  # as if each text began behind a line break, which is left out again
                cut = pc.binary_join_element_wise(pa.scalar("\n"), cut, "")
        (ids, bounds), = self.parts.gathered(cut)
        data = ids.tobytes()
        skip = 0 if lead else len(self.line)
        found = iter([data[4 * (s + skip):4 * e] for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
        return [self._ids(lead + text) if alone else next(found) if text else b"" for text, alone in zip(texts, whole.tolist())]


_OPEN: dict[str, WordCache] = {}


def opened(path: str) -> WordCache:
    """One cache per vocabulary and worker process, kept from task to task."""
    if path not in _OPEN:
        _OPEN[path] = WordCache(path)
    return _OPEN[path]
