"""Quality classifier by co-training of two views of a document.

One view sees the text (all its words and their character n-grams, hashed, and measures of its form), the other the page's metadata (source, language, length).
Each is fitted on labelled rows; in each round it labels the unlabelled rows it is sure of, calibrated on held-out labels, and hands them
to the other view. At the end both margins are weighed together on the held-out labels, and every document is scored.
"""

from __future__ import annotations

import math
import warnings
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from rondel.llm.shared import arrow_pass, batch_of, plain_words, quoted, small_batches, stored

MAX_LABELLED = 20_000  # rows that fitting takes of the labelled documents, about; chosen by a hash of the id
MAX_POOL = 20_000      # and of the unlabelled ones that views may label for each other
ROUNDS = 2
SURE = 0.97            # calibrated probability from which a view hands a label on
MIN_GOOD = 0.5
BINS = 1 << 18         # that words and their n-grams are hashed to
GRAM = 4               # characters of an n-gram; the ends of a word count as one each
CACHE_WORDS = 300_000  # whose bins a worker process keeps
LONGEST = 64           # characters of a word that is kept there
PENALTY = 0.001
MAX_STEPS = 2000       # of one descent, and
MAX_ROUNDS = 60        # descents of a fit: safety limits; a fit that reaches them is reported
REST = 1e-5            # change of a weight at which a descent has come to rest
TOLERANCE = 0.01       # by which a slope may exceed the penalty
JOIN_AT_ONCE = 400     # columns that join a descent
HANDED_WEIGHT = 0.5    # of a label that another view handed on
META_FEATURES = 1 << 10
_HASH_RANGE = 1 << 30


# Kinds of bytes whose share of a text tells its form.
_KINDS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#$%&*+<=>@\\^_`{}~", "|", "!?", ".,;:", "\n")
_SCALES = (2, 5, 20, 50, 20, 10, 20)
_KIND_OF = np.zeros(256, np.uint8)
for _i, _signs in enumerate(_KINDS):
    _KIND_OF[list(_signs.encode())] = _i + 1


def form_of(text: str | None) -> tuple[list[float], list[str]]:
    """Measures of a text's form, each between 0 and about 1, and its distinct words."""
    text = text or ""
    words = plain_words(text)
    distinct = list(set(words))
    n, data = len(words), np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shares = np.bincount(_KIND_OF[data], minlength=len(_KINDS) + 1)[1:] / max(len(text), 1)
    form = np.minimum(shares * _SCALES, 1.0).tolist()
    # Of running text the logarithms of distinct and all words keep one ratio; repetition lowers it.
    form += [len(distinct) / max(n, 1), math.log(len(distinct)) / math.log(n) if n > 1 else 1.0,
             min(len(text) / (20 * max(n, 1)), 1.0), float(n < 10), math.log1p(n) / 10]
    return form, distinct


def bins_of(word: str) -> np.ndarray:
    """The bins of a word and of its character n-grams."""
    marked = f"<{word}>"
    parts = {marked, *(marked[i:i + GRAM] for i in range(len(marked) - GRAM + 1))}
    return np.array([zlib.crc32(p.encode("utf-8", "surrogatepass")) % BINS for p in parts], np.int32)


class WordBins:
    """Bins of many words, all or only the ``wanted`` ones."""

    def __init__(self, wanted: np.ndarray | None = None):
        self.wanted = wanted
        self.known: dict[str, bytes] = {}

    def _of(self, word: str) -> bytes:
        bins = bins_of(word)
        data = (bins if self.wanted is None else bins[self.wanted[bins]]).tobytes()
        if len(word) <= LONGEST:
            self.known[word] = data
        return data

    def all(self, words: Iterable[str]) -> np.ndarray:
        """The distinct bins of ``words``, in order."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        return np.unique(np.frombuffer(b"".join([known[w] if w in known else self._of(w) for w in words]), np.int32))


def _metadata(docs: DataFrame) -> list[Column]:
    """What the views are made of: the text, the metadata's tags and the size; null and missing columns are empty."""
    def column(name: str) -> Column:
        return F.col(quoted(name)) if name in docs.columns else F.lit(None)

    tags = F.array(F.concat(F.lit("source="), F.coalesce(column("source").cast("string"), F.lit(""))),
                   F.concat(F.lit("lang="), F.coalesce(column("lang").cast("string"), F.lit(""))))
    size = F.log1p(F.greatest(F.coalesce(column("n_chars").cast("double"), F.lit(0.0)), F.lit(0.0))) / 10
    return [column("text").cast("string").alias("_text"), tags.alias("_tags"), size.alias("_size")]


def tag_bins(tags: Iterable[str]) -> list[int]:
    return sorted({zlib.crc32(t.encode("utf-8", "surrogatepass")) % META_FEATURES for t in tags})


_VIEWS = pa.schema([("doc_id", pa.int64()), ("good", pa.float64()), ("held", pa.bool_()), ("bins", pa.list_(pa.int32())),
                    ("form", pa.list_(pa.float64())), ("tags", pa.list_(pa.int32())), ("size", pa.float64())])


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordBins()
    for batch in batches:
        texts, tags = batch.column("_text").to_pylist(), batch.column("_tags").to_pylist()
        for i in range(0, len(texts), 200):
            seen = [form_of(t) for t in texts[i:i + 200]]
            part = batch.slice(i, 200)
            yield batch_of(_VIEWS, [part.column("doc_id"), part.column("good"), part.column("held"),
                                    [words.all(distinct) for _, distinct in seen], [form for form, _ in seen],
                                    [tag_bins(t) for t in tags[i:i + 200]], part.column("_size")])


class View:
    """Rows of a view: the bins that are set, row after row, and a few dense measures."""

    def __init__(self, bins: np.ndarray, ends: np.ndarray, dense: np.ndarray, width: int):
        self.bins, self.ends, self.dense, self.width = bins, ends, dense, width

    def rows(self, which: np.ndarray) -> View:
        starts = np.concatenate(([0], self.ends[:-1]))[which]
        lengths = self.ends[which] - starts
        ends = np.cumsum(lengths)
        at = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return View(self.bins[at], ends, self.dense[which], self.width)

    def columns(self, keep: np.ndarray) -> View:
        """Only the bins of ``keep``, numbered by their place in it."""
        place = np.full(self.width, -1, np.int32)
        place[keep] = np.arange(len(keep), dtype=np.int32)
        moved = place[self.bins]
        inside = moved >= 0
        return View(moved[inside], np.concatenate(([0], np.cumsum(inside)))[self.ends], self.dense, len(keep))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Products with weights of the bins, then of the dense measures."""
        out = np.empty(len(self.ends))
        for s in range(0, len(out), 2000):  # so that what is gathered at once stays small
            ends = self.ends[s:s + 2000]
            first = self.ends[s - 1] if s else 0
            sums = np.concatenate(([0.0], np.cumsum(weights[self.bins[first:ends[-1]]])))
            out[s:s + 2000] = np.diff(sums[np.concatenate(([0], ends - first))])
        return out + self.dense @ weights[self.width:]

    def turned(self, values: np.ndarray) -> np.ndarray:
        """Products of all columns with a value per row."""
        out = np.zeros(self.width)
        for s in range(0, len(values), 2000):
            ends = self.ends[s:s + 2000]
            first = self.ends[s - 1] if s else 0
            lengths = np.diff(np.concatenate(([first], ends)))
            out += np.bincount(self.bins[first:ends[-1]], np.repeat(values[s:s + 2000], lengths), self.width)
        return np.concatenate([out, self.dense.T @ values])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _descend(view: View, scale: np.ndarray, y: np.ndarray, share: np.ndarray, start: np.ndarray, bias: float,
             steps: int) -> tuple[np.ndarray, float, bool]:
    """Accelerated proximal descent of the weighted log loss with an absolute penalty on scaled weights; whether it came to rest."""
    def loss(w: np.ndarray, b: float) -> tuple[float, np.ndarray]:
        m = view.dot(w / scale) + b
        return float(share @ (np.logaddexp(0, m) - y * m)), m

    w, b, ahead, ahead_b, speed, rate = start.copy(), bias, start.copy(), bias, 1.0, 4.0
    for _ in range(steps):
        at, m = loss(ahead, ahead_b)
        off = share * (_sigmoid(m) - y)
        slope, slope_b = view.turned(off) / scale, float(off.sum())
        while True:
            moved = ahead - rate * slope
            new = np.sign(moved) * np.maximum(np.abs(moved) - rate * PENALTY, 0)
            new_b = ahead_b - rate * slope_b
            by, by_b = new - ahead, new_b - ahead_b
            if loss(new, new_b)[0] <= at + slope @ by + slope_b * by_b + (by @ by + by_b * by_b) / (2 * rate) + 1e-12:
                break
            rate /= 2
        step, step_b = new - w, new_b - b
        if step @ (ahead - new) + step_b * (ahead_b - new_b) > 0:
            speed = 1.0  # it went too far: start anew from here
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        ahead, ahead_b = new + (speed - 1) / faster * step, new_b + (speed - 1) / faster * step_b
        w, b, speed, rate = new, new_b, faster, rate * 1.1
        if max(np.abs(step).max(initial=0), abs(step_b)) < REST * max(1.0, np.abs(w).max(initial=0)):
            return w, b, True
    return w, b, False


def fit(view: View, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float, bool]:
    """Weights and bias of a logistic regression with an absolute penalty, and whether it converged.

    Columns are scaled by their deviation, as the penalty is. Only columns that the penalty does not hold at zero take part in a
    descent; after it the slope of all columns tells which ones have to join. It ends when none has.
    """
    share = weight / weight.sum()
    mean = view.turned(share)
    square = np.concatenate([mean[:view.width], (view.dense ** 2).T @ share])
    scale = np.sqrt(np.maximum(square - mean * mean, 0))
    usable = scale > 1e-6
    weights, bias = np.zeros(len(mean)), float(np.log((share @ y) / (share @ (1 - y))))
    taken = np.zeros(len(mean), bool)
    taken[view.width:] = True  # dense measures always take part
    for _ in range(MAX_ROUNDS):
        slope = view.turned(share * (_sigmoid(view.dot(weights) + bias) - y))
        excess = np.where(usable & ~taken, np.abs(slope) / np.where(usable, scale, 1), 0)
        joining = np.flatnonzero(excess > PENALTY * (1 + TOLERANCE))
        if not len(joining) and taken[:view.width].any():
            return weights, bias, rested
        taken[joining[np.argsort(-excess[joining])[:JOIN_AT_ONCE]]] = True
        keep = np.flatnonzero(taken[:view.width])
        both = np.concatenate([keep, np.arange(view.width, len(mean))])
        part_scale = np.where(usable[both], scale[both], np.inf)
        found, bias, rested = _descend(view.columns(keep), part_scale, y, share,
                                       np.where(usable[both], weights[both] * scale[both], 0), bias, MAX_STEPS)
        weights = np.zeros(len(mean))
        weights[both] = found / part_scale
        if not len(joining):
            return weights, bias, rested
        taken[:view.width] &= weights[:view.width] != 0
        taken[joining] |= weights[joining] != 0
    return weights, bias, False


def _calibrated(good: np.ndarray, *margins: np.ndarray) -> np.ndarray:
    """Bias and weights of a logistic regression of the held-out labels on margins, by Newton steps."""
    y, x = good, np.column_stack([np.ones(len(good)), *margins])
    y = (y * (y.sum() + 1) + (1 - y)) / np.where(y > 0, y.sum() + 2, (1 - y).sum() + 2)  # smoothed targets
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + 1e-3 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return weights


_MODEL = pa.schema([("bins", pa.list_(pa.int32())), ("heavy", pa.list_(pa.float64())), ("form", pa.list_(pa.float64())),
                    ("text_bias", pa.float64()), ("meta", pa.list_(pa.float64())), ("meta_bias", pa.float64()),
                    ("combine", pa.list_(pa.float64())), ("converged", pa.bool_())])
_MODEL_SQL = ("bins array<int>, heavy array<double>, form array<double>, text_bias double, meta array<double>, "
              "meta_bias double, combine array<double>, converged boolean")


def _cotrain(rounds: int):
    """Co-training over the bounded sample, in one task; what comes out are the weights that are not zero."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("size", "ascending")]))

        def listed(name: str) -> tuple[np.ndarray, np.ndarray]:
            column = table.column(name).combine_chunks()
            return column.flatten().to_numpy(), np.cumsum(pc.list_value_length(column).to_numpy().astype(np.int64))

        good = table.column("good").to_numpy(zero_copy_only=False)
        held = table.column("held").to_numpy(zero_copy_only=False).astype(bool)
        form = listed("form")[0].reshape(len(good), -1)
        size = table.column("size").to_numpy()[:, None]
        views = {"text": View(*listed("bins"), form, BINS), "meta": View(*listed("tags"), size, META_FEATURES)}
        del table, rows
        known = ~np.isnan(good)
        base, judges, pool = (np.flatnonzero(x) for x in (known & ~held, known & held, ~known))
        if any(len(np.unique(good[x])) < 2 for x in (base, judges)):
            return
        given = {name: (np.empty(0, np.int64), np.empty(0)) for name in views}
        fitted: dict[str, tuple[np.ndarray, float, bool]] = {}
        margin = lambda name, which: views[name].rows(which).dot(fitted[name][0]) + fitted[name][1]
        for turn in range(rounds + 1):
            for name, view in views.items():
                more, labels = given[name]
                if name in fitted and not len(more):
                    continue  # nothing but the rows it was fitted on
                which = np.concatenate([base, more])
                weight = np.concatenate([np.ones(len(base)), np.full(len(more), HANDED_WEIGHT)])
                fitted[name] = fit(view.rows(which), np.concatenate([good[base], labels]), weight)
            if turn == rounds:
                break
            for name, other in (("text", "meta"), ("meta", "text")):
                bias, slope = _calibrated(good[judges], margin(name, judges))
                p = _sigmoid(bias + slope * margin(name, pool))
                sure = (p >= SURE) | (p <= 1 - SURE)
                if sure.any() or len(given[other][0]):
                    given[other] = pool[sure], (p[sure] >= 0.5).astype(float)
        combine = _calibrated(good[judges], margin("text", judges), margin("meta", judges))
        (text, text_bias, a), (meta, meta_bias, b) = fitted["text"], fitted["meta"]
        wanted = np.flatnonzero(text[:BINS]).astype(np.int32)
        yield batch_of(_MODEL, [[wanted], [text[wanted]], [text[BINS:]], [text_bias], [meta], [meta_bias], [combine], [a and b]])
    return work


class Judge:
    """Two fitted views and the weights that turn their margins into one probability."""

    def __init__(self, model: dict):
        self.bins = np.array(model["bins"], np.int32)
        self.heavy, self.form, self.meta, self.combine = (
            np.array(model[k], np.float64) for k in ("heavy", "form", "meta", "combine"))
        self.text_bias, self.meta_bias = model["text_bias"], model["meta_bias"]

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``good_probability``.

        Most bins weigh nothing, so the words' bins that do are all that is looked up.
        """
        wanted, heavy, form_weights, meta = self.bins, self.heavy, self.form, self.meta
        bias = float(self.combine[0] + self.combine[1] * self.text_bias + self.combine[2] * self.meta_bias)
        of_text, of_meta = float(self.combine[1]), float(self.combine[2])

        @F.pandas_udf("double")
        def probability(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            of_bin = np.zeros(BINS)
            of_bin[wanted] = heavy
            words = WordBins(of_bin != 0)

            def text_margin(text: str | None) -> float:
                form, distinct = form_of(text)
                return float(np.dot(form, form_weights)) + float(of_bin[words.all(distinct)].sum())

            for texts, tags, sizes in parts:
                text = np.array([text_margin(t) for t in texts], np.float64)
                about = np.array([meta[tag_bins(t)].sum() for t in tags], np.float64) + sizes.to_numpy(np.float64) * meta[-1]
                yield pd.Series(_sigmoid(bias + of_text * text + of_meta * about), dtype="float64")

        small_batches(docs.sparkSession)
        whole = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc")
        rows = docs.select(whole, *_metadata(docs)).select("doc", probability("_text", "_tags", "_size").alias("_p"))
        kept = [c for c in docs.columns if c != "good_probability"]
        return rows.select(*[F.col(f"doc.{quoted(c)}").alias(c) for c in kept], F.col("_p").alias("good_probability"))


def _sample(most: int, of: int) -> Column:
    """A condition on ``doc_id`` that about ``most`` of ``of`` rows meet, the same ones every time."""
    return F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(_HASH_RANGE)) < int(min(1.0, most / max(of, 1)) * _HASH_RANGE)


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, max_labelled: int = MAX_LABELLED,
          max_pool: int = MAX_POOL) -> Judge | None:
    """The judge learned from ``labels`` (``doc_id``, ``good`` as 0 or 1); ``None`` if they do not hold both classes.

    A fifth of the labelled rows, chosen by id, is never fitted on and calibrates the margins. Fitting uses at most about
    ``max_labelled`` labelled and ``max_pool`` unlabelled rows; counts come from all rows.
    """
    known = stored(labels.filter("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id")
                   .agg(F.min(F.col("good").cast("double")).alias("good")), "labels")
    n_known = known.count()
    n_docs = docs.count()
    # Labels are cut to the sample on both sides before texts are moved.
    take = _sample(max_labelled, n_known)
    held = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)) == 0
    rows = docs.select("doc_id", *_metadata(docs)).filter(F.col("doc_id").isNotNull())
    own = rows.filter(take).join(known.filter(take), "doc_id").withColumn("held", held)
    pool = rows.filter(_sample(max_pool, n_docs)).join(known.select("doc_id"), "doc_id", "left_anti").select(
        "*", F.lit(None).cast("double").alias("good"), F.lit(False).alias("held"))
    sample = own.unionByName(pool).withColumn("doc_id", F.col("doc_id").cast("long"))
    seen = stored(arrow_pass(sample, _views, "doc_id long, good double, held boolean, bins array<int>, form array<double>, "
                                             "tags array<int>, size double"), "views")
    found = seen.coalesce(1).mapInArrow(_cotrain(rounds), _MODEL_SQL).collect()  # the sample is bounded, and weights alone come back
    if not found:
        return None
    if not found[0]["converged"]:
        warnings.warn("a fit of the quality classifier did not converge")
    return Judge(found[0].asDict())


def document_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``good`` from rows ``doc_id, quality, toxic``: good quality and not toxic. Nulls teach nothing."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return labels.filter("quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", good.cast("int").alias("good"))


def score(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``docs`` with ``good_probability`` for every row.

    * Null texts and metadata count as empty; every row gets a probability. Rows with a null id are scored but
      never fitted on; repeated rows are scored each, and labels of one id that differ count as bad.
    * Labels of one class only, or none, teach nothing: every row gets probability 1.
    * An empty table gives no rows. Columns beside ``doc_id, text, lang, source, n_chars`` are carried along, unless they
      are named like a result.
    """
    judge = train(docs.select(*[c for c in ("doc_id", "text", "lang", "source", "n_chars") if c in docs.columns]),
                  labels, **settings)
    if judge is None:
        return docs.withColumn("good_probability", F.lit(1.0))
    return judge.score(docs)


def good_documents(docs: DataFrame, labels: DataFrame, min_good: float = MIN_GOOD, **settings) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns."""
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc"),
                       *[F.col(c) for c in ("doc_id", "text", "lang", "source", "n_chars") if c in docs.columns])
    kept = score(rows, labels, **settings).filter(F.col("good_probability") >= min_good)
    return kept.select(*[F.col(f"doc.{quoted(c)}").alias(c) for c in docs.columns])
