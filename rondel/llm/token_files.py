"""Token ids as files of bit planes.

Documents are laid out in ascending id order, each followed by an end id. A chunk holds the ids of whole
documents. Its ids are cut into blocks of fixed size; a block is transposed into planes (plane i holds byte i,
or bit i, of every id), planes that are zero throughout are left out, and each plane is compressed with zstandard. The
chunk index tells where each chunk starts in the corpus, where each block starts in the chunk, and which
documents it holds. Chunks are rows of a Parquet folder, so writing has Spark's commit protocol and any store works.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rondel.llm.shared import arrow_pass, batch_of
from rondel.llm.tokens import opened

BLOCK_IDS = 1 << 15
CHUNK_IDS = 1 << 20
END_ID = 2
LEVEL = 1

CHUNK = ("part int, chunk int, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
         "block_ends array<long>, payload binary")
_CHUNK = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
                    ("block_ends", pa.list_(pa.int64())), ("payload", pa.binary())])


def pack_block(ids: np.ndarray, bits: bool) -> bytes:
    """One block: kind, count, number of planes, then each plane's compressed size and data."""
    ids = np.ascontiguousarray(ids, "<u4")
    raw = ids.view(np.uint8).reshape(-1, 4)
    if bits:
        width = int(ids.max()).bit_length() if len(ids) else 0
        every = np.unpackbits(raw, axis=1, bitorder="little")
        planes = [np.packbits(every[:, i], bitorder="little").tobytes() for i in range(width)]
    else:
        width = (int(ids.max()).bit_length() + 7) // 8 if len(ids) else 0
        planes = [np.ascontiguousarray(raw[:, i]).tobytes() for i in range(width)]
    press = zstandard.ZstdCompressor(level=LEVEL)
    small = [press.compress(p) for p in planes]
    head = np.array([int(bits), len(ids), width, *map(len, small)], "<u4").tobytes()
    return head + b"".join(small)


def unpack_block(data: bytes) -> np.ndarray:
    bits, n, width = np.frombuffer(data, "<u4", 3).tolist()
    sizes = np.frombuffer(data, "<u4", width, 12).tolist()
    at = 12 + 4 * width
    press = zstandard.ZstdDecompressor()
    raw = np.zeros((n, 32 if bits else 4), np.uint8)
    for i, size in enumerate(sizes):
        plane = np.frombuffer(press.decompress(data[at:at + size]), np.uint8)
        raw[:, i] = np.unpackbits(plane, count=n, bitorder="little") if bits else plane
        at += size
    if bits:
        raw = np.packbits(raw, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def pack_chunk(ids: np.ndarray, bits: bool) -> tuple[list[int], bytes]:
    blocks = [pack_block(ids[i:i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)]
    return np.cumsum([len(b) for b in blocks], dtype=np.int64).tolist(), b"".join(blocks)


def unpack_chunk(ends: list[int], payload: bytes) -> np.ndarray:
    parts = [unpack_block(payload[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
    return np.concatenate(parts) if parts else np.empty(0, "<u4")


def _chunks(path: str, end_id: int, bits: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = opened(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        number, held, ids, lengths, docs = 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            stream = np.frombuffer(b"".join(ids), "<u4")
            ends, payload = pack_chunk(stream, bits)
            return batch_of(_CHUNK, [[part], [number], [len(stream)], [list(docs)], [list(lengths)], [ends], [payload]])

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, got in zip(keys, words.encode(texts)):
                docs.append(key)
                ids.append(got + end)
                lengths.append(len(got) // 4 + 1)
                held += lengths[-1]
                if held >= CHUNK_IDS:
                    yield close()
                    number, held, ids, lengths, docs = number + 1, 0, [], [], []
        if docs:
            yield close()
    return work


def write_ids(docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID, bits: bool = False) -> None:
    """Encode every whole text of ``docs`` (``doc_id``, ``text``) and write the files to ``folder``.

    * Null and empty texts are just the end id. A null ``doc_id`` comes first; rows with one id follow
      each other in an order fixed by their texts. Other columns are ignored. An empty table gives no chunk.
    * Texts are dealt by id ranges; rows that share an id are spread by their text and their place in the input.
    * A chunk ends with the document that fills it, so memory is bounded by a chunk and the longest text.

    ``vocabulary`` is the path of a vocabulary file that every machine has; ``bits`` chooses bit planes, else byte planes.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = keyed.withColumn("_text", F.xxhash64("text")).withColumn("_place", F.monotonically_increasing_id())
    order = ["doc_id", "_text", "_place"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    arrow_pass(dealt, _chunks(vocabulary, end_id, bits), CHUNK).write.mode("overwrite").parquet(folder)


def chunk_index(spark, folder: str) -> DataFrame:
    """Per chunk where it starts in the corpus; sums run over parts first, then inside each part."""
    chunks = spark.read.schema(CHUNK).parquet(folder).select("part", "chunk", "n_ids")
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (chunks.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(parts, "part").select("part", "chunk", (F.col("part_start") + F.col("inside")).alias("start")))


def _documents(digest: bool):
    last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.list_(pa.int64()))
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("doc_id", pa.int64()), ("inside", pa.int64()),
                        ("n_tokens", pa.int64()), last])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, chunk, _, docs, lengths, ends, payload = (batch.column(c)[i].as_py() for c in range(7))
                ids = unpack_chunk(ends, payload)
                cuts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
                pieces = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                found = [zlib.crc32(p.tobytes()) for p in pieces] if digest else [p.tolist() for p in pieces]
                yield batch_of(schema, [[part] * len(docs), [chunk] * len(docs), docs, cuts[:-1], lengths, found])
    return work


def read_ids(spark, folder: str, digest: bool = False) -> DataFrame:
    """Documents read back from the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids``, or ``ids_crc32``."""
    last = "ids_crc32 long" if digest else "ids array<long>"
    chunks = spark.read.schema(CHUNK).parquet(folder)
    rows = chunks.mapInArrow(_documents(digest),
                             f"part int, chunk int, doc_id long, inside long, n_tokens long, {last}")
    return rows.join(chunk_index(spark, folder), ["part", "chunk"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", last.split()[0])
