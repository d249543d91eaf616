"""What the corpus operators share: stored intermediate tables, Arrow passes and word rules."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rondel.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters, digits and everything beyond ASCII; the text is lower-cased (A-Z) before.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLAIN = re.compile(PLAIN_WORD)
_LOWERED = str.maketrans(UPPER, LOWER)
# Rows of one Arrow batch: a batch of the longest texts must still fit beside the executor's heap.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    Later jobs, and tasks repeated after an executor is lost, read the files; nothing is computed twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a ``stored`` table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def arrow_pass(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
               schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def plain_words(text: str | None) -> list[str]:
    """Words of letters, digits and non-ASCII signs, A-Z lower-cased; none for null."""
    return _PLAIN.findall(text.translate(_LOWERED)) if text else []


def space_words(text: str | None) -> list[bytes]:
    """What stands between ASCII white space, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def text_of(column: pa.Array) -> list[str | None]:
    return column.to_pylist()


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def rolling(codes: np.ndarray, k: int, odd: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive codes (wrap-around arithmetic), in window order."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), np.uint64(odd)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = (out + codes[i:i + n]) * factor
            out ^= out >> np.uint64(29)
    return out


def union_length(spans: Column) -> Column:
    """Places covered by spans ``(start, length)``, each counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))

    def step(acc: Column, span: Column) -> Column:
        end = (span["start"] + span["length"]).cast("long")
        begin = F.greatest(span["start"].cast("long"), acc["end"])
        return F.struct((acc["hit"] + F.greatest(end - begin, F.lit(0).cast("long"))).alias("hit"),
                        F.greatest(end, acc["end"]).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, step)["hit"]


# Bytes of text that are hashed at once; a longer text is taken alone.
CHUNK_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C13  # odd, so that it has an inverse among 64-bit numbers
SPACES = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class WordHasher:
    """64-bit hashes of all words of many texts at once: polynomials over their bytes, from running sums."""

    def __init__(self, size: int = CHUNK_BYTES):
        """``size``: bytes that are usually hashed at once."""
        self.signs = np.random.default_rng(42).integers(1, 2 ** 63, 256, dtype=np.uint64)
        self._grow(size)

    def _grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            base, back = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
            self.powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base))))
            self.inverse = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, back))))

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word of the UTF-8 bytes starts and ends, and its hash; words are cut at ASCII white space."""
        if len(data) >= len(self.powers):
            self._grow(len(data))
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = (data != 0x20) & (data - np.uint8(9) > 4)  # as SPACES, without a look-up
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.take(self.signs, data, out=sums[1:], mode="wrap")
            sums[1:] *= self.powers[:len(data)]
            np.cumsum(sums, out=sums)
            return starts, ends, mixed((sums[ends] - sums[starts]) * self.inverse[starts])


def text_chunks(texts: list[str | None], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in order as UTF-8, in chunks of at most ``most`` bytes, each with the number of its first text."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        if held and size + len(data) > most:
            yield first, held
            held, size, first = [], 0, i
        held.append(data)
        size += len(data) + 1
    if held:
        yield first, held


_PAGE = 1 << 12


def dense(cells: DataFrame, size: int, kind: str) -> np.ndarray:
    """An array of ``size`` numbers (zero where no row is) from rows ``(at, value)`` with distinct places.

    The driver gets pages of packed numbers, together as large as the array, whose size is fixed beforehand.
    """
    def page(part: pa.Table) -> pa.Table:
        at, value = part.column("at").to_numpy(), part.column("value").to_numpy()
        out = np.zeros(_PAGE, kind)
        out[at % _PAGE] = value
        return pa.table({"page": pa.array([int(at[0]) // _PAGE], pa.int64()),
                         "data": pa.array([out.tobytes()], pa.binary())})

    pages = (cells.select(F.col("at").cast("long").alias("at"), F.col("value").cast("long").alias("value"))
             .withColumn("page", F.shiftright("at", _PAGE.bit_length() - 1))
             .groupBy("page").applyInArrow(page, "page long, data binary"))
    out = np.zeros(-(-size // _PAGE) * _PAGE, kind)
    for number, data in pages.toLocalIterator():
        out[number * _PAGE:(number + 1) * _PAGE] = np.frombuffer(data, kind)
    return out[:size]


class BitFilter:
    """A set of 64-bit hashes in a fixed number of bits: members always pass, few others do."""

    BITS = 1 << 25

    def __init__(self, keys: DataFrame):
        """``keys`` has one long column; ``BITS`` bits reach the driver, whatever its size."""
        name = keys.columns[0]
        at = F.explode(F.array(*[F.shiftrightunsigned(F.col(name), s).bitwiseAND(F.lit(self.BITS - 1))
                                 for s in (0, 32)]))
        cells = (keys.select(at.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("value")))
        self.bits = dense(cells, self.BITS // 64, "<i8")

    def passes(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64)
        out = np.ones(len(keys), bool)
        for s in (0, 32):
            bit = ((keys >> np.uint64(s)) & np.uint64(self.BITS - 1)).astype(np.int64)
            out &= (self.bits[bit >> 6] >> (bit & 63)) & 1 == 1
        return out


def with_place(docs: DataFrame) -> DataFrame:
    """``doc`` (the row as a struct) and where it lies in its file, as ``file`` and ``row``.

    A place does not change between jobs, however the files are split. Rows that do not come straight from files are
    stored first.
    """
    whole = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc")

    def placed(df: DataFrame) -> DataFrame:
        place = df.metadataColumn("_metadata")
        return df.select(whole, F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row"))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(stored(docs, "documents"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_text(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``doc`` in their order, with ``text`` taken from the column of that name beside it."""
    return rows.select(*[F.col("text") if c == "text" else F.col(f"doc.{quoted(c)}").alias(c) for c in columns])
