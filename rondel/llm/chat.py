"""Chat formatting: messages that reply to each other become conversations with a loss mask.

Messages form trees. Every message learns its ancestors by self-joins that double the distance they reach, so a
chain of any length takes a logarithmic number of joins. A leaf stands for the path from its root; the paths of a tree
are ranked by the sum of their messages' scores, and each chosen path is written as one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rondel.llm.shared import arrow_pass, batch_of, stored

ASSISTANT = "assistant"
# The template: "### Role: text</turn>" and a line break for each turn. Signs that could imitate it are escaped.
_ESCAPED = re.compile(r"[\\#<]")
_ESCAPED_ROLE = re.compile(r"[\\#<:]")
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)


def escape(text: str, role: bool = False) -> str:
    return (_ESCAPED_ROLE if role else _ESCAPED).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as text, and the spans (in code points) of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"### {escape(role, role=True)}: ", escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</turn>\n"]
        at += len(head) + len(body) + len(parts[-1])
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; an error if any part of it is not a turn."""
    out, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"not a turn at {at}")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


def loss_text(formatted: str, spans: list[tuple[int, int]]) -> str:
    """What the loss mask covers, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def jumps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestor tables by doubling: table ``i`` has ``(node, up)`` with ``up`` 2^i replies above ``node``.

    Also ``(node, depth, total)``: how many messages lie on the way to the root and their summed score. ``messages``:
    ``node, parent, score``; a parent that is missing makes a root. Replies in a circle are not a tree and are an error.
    """
    known = messages.select(F.col("node").alias("up"))
    start = (messages.select("node", F.col("parent").alias("up"), F.col("score").alias("total"))
             .join(known.withColumn("_there", F.lit(True)), "up", "left")
             .select("node", F.when(F.col("_there"), F.col("up")).alias("up"), F.lit(1).cast("long").alias("depth"),
                     "total"))
    now = stored(start, "replies")
    tables: list[DataFrame] = []
    while not now.filter("up IS NOT NULL").isEmpty():
        if len(tables) > 40:
            raise ValueError("replies form a circle")
        tables.append(now.filter("up IS NOT NULL").select("node", "up"))
        above = now.select(F.col("node").alias("up"), F.col("up").alias("top"), F.col("depth").alias("more"),
                           F.col("total").alias("above"))
        now = stored(now.join(above, "up", "left").select(
            "node", F.col("top").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            (F.col("total") + F.coalesce("above", F.lit(0.0))).alias("total")), "replies")
    return tables, now.select("node", "depth", "total")


def chosen_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """``tree, path, rank, node, depth``: messages of the best ``per_tree`` paths of every tree.

    ``messages``: ``tree, node, parent, score``. Paths of a tree rank by total score, ties by the smaller leaf. ``path``
    is the leaf's node.
    """
    tables, ways = jumps(messages)
    leaves = messages.select("tree", "node").join(
        messages.select(F.col("parent").alias("node")).distinct(), "node", "left_anti").join(ways, "node")
    order = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    best = (leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_tree)
            .select("tree", F.col("node").alias("path"), "rank", "node"))
    # Distances from a leaf are sums of distinct powers of two, so every ancestor is reached once.
    for table in reversed(tables):
        best = stored(best.unionByName(best.join(table, "node").select("tree", "path", "rank", F.col("up").alias("node"))),
                      "paths")
    return best.join(ways.select("node", "depth"), "node")


def _write():
    schema = pa.schema([("tree", pa.int64()), ("path", pa.int64()), ("rank", pa.int32()), ("formatted", pa.string()),
                        ("loss_spans", pa.list_(pa.list_(pa.int64())))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for turns in batch.column(3).to_pylist():
                text, mask = format_turns([(t["role"], t["text"]) for t in turns])
                texts.append(text)
                spans.append([list(s) for s in mask])
            yield batch_of(schema, [batch.column(0), batch.column(1), batch.column(2), texts, spans])
    return work


def format_trees(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """One conversation per chosen path: ``tree, path, rank, formatted, loss_spans``, stored.

    ``messages``: ``tree`` (long), ``node`` (long, unique), ``parent``, ``role``, ``text``, ``score``. Null roles and texts are empty, null
    scores are zero. A conversation is one value and is put together in one place; nothing else is grouped by tree.
    """
    plain = messages.select(
        F.col("tree").cast("long").alias("tree"), F.col("node").cast("long").alias("node"),
        F.col("parent").cast("long").alias("parent"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    paths = chosen_paths(plain.select("tree", "node", "parent", "score"), per_tree)
    turns = (paths.join(plain.select("node", "role", "text"), "node")
             .groupBy("tree", "path", "rank")
             .agg(F.array_sort(F.collect_list(F.struct("depth", "role", "text"))).alias("turns")))
    return stored(arrow_pass(turns, _write(),
                             "tree long, path long, rank int, formatted string, loss_spans array<array<long>>"), "chats")


def _number():
    """Dense numbers inside each sorted partition, and whether the row goes on with the conversation before it."""
    schema = pa.schema([("part", pa.int64()), ("at", pa.int64()), ("conv_id", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("follows", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, before = TaskContext.get().partitionId(), 0, (None, False)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            follows = []
            for key in ids:
                follows.append(before == (key, True))
                before = (key, True)
            n = len(ids)
            yield batch_of(schema, [[part] * n, list(range(at, at + n)), ids, batch.column(1), batch.column(2), follows])
            at += n
    return work


def reply_chains(rows: DataFrame) -> DataFrame:
    """Messages from rows ``conv_id, turn, role, text`` of plain conversations: each turn replies to the one before it.

    Turns are ordered by ``turn`` (null first), then role and a hash of the text. Rows are numbered across the whole table by a range
    partition, so a conversation with very many turns is spread over tasks. Rows without ``conv_id`` are one conversation.
    """
    typed = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = typed.withColumn("_h", F.xxhash64("text")).repartitionByRange("conv_id", "turn", "role", "_h")
    numbered = stored(arrow_pass(dealt.sortWithinPartitions("conv_id", "turn", "role", "_h", "text").select(*[
        "conv_id", "role", "text"]), _number(),
        "part long, at long, conv_id long, role string, text string, follows boolean"), "turns")
    node = F.shiftleft("part", 36) + F.col("at")
    ends = numbered.groupBy("part").agg(F.max(F.struct("at", "conv_id")).alias("last"))
    step = Window.orderBy("part")  # one row per partition
    ends = ends.select("part", F.lag("part").over(step).alias("p"), F.lag("last").over(step).alias("q"))
    first = numbered.filter("at = 0").join(ends, "part").select(
        node.alias("node"), F.when(F.col("q.conv_id").eqNullSafe(F.col("conv_id")) & F.col("p").isNotNull(),
                                   F.shiftleft("p", 36) + F.col("q.at")).alias("parent"), "conv_id", "role", "text")
    rest = numbered.filter("at > 0").select(node.alias("node"), F.when(F.col("follows"), node - 1).alias("parent"),
                                            "conv_id", "role", "text")
    return stored(first.unionByName(rest).withColumn("score", F.lit(1.0)), "messages")


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans`` of every conversation of ``rows`` (``conv_id, turn, role, text``)."""
    messages = reply_chains(rows)
    # A root names its tree.
    tables, _ = jumps(messages.select("node", "parent", "score"))
    root = messages.select("node", F.col("node").alias("tree"))
    for table in reversed(tables):  # the longest jump that still finds an ancestor, then shorter ones
        up = table.select(F.col("node").alias("tree"), "up")
        root = stored(root.join(up, "tree", "left").select("node", F.coalesce("up", "tree").alias("tree")), "roots")
    named = messages.join(root, "node")
    chats = format_trees(named)
    owner = messages.filter("parent IS NULL").select(F.col("node").alias("tree"), "conv_id")
    return chats.join(owner, "tree").select("conv_id", "formatted", "loss_spans")


def _digest():
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def hexed(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for formatted, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns, loss = read_turns(formatted), loss_text(formatted, [tuple(s) for s in spans])
                for column, value in zip(out, (len(turns), hexed("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss),
                                               hexed(loss), len(formatted))):
                    column.append(value)
            yield batch_of(schema, [batch.column(0), *out])
    return work


def read_back(chats: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read from their text and mask alone."""
    return arrow_pass(chats.select("conv_id", "formatted", "loss_spans"), _digest(),
                      "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                      "formatted_chars long")
