"""Merkle manifest, alignment of two tokenizers and best-fit packing, against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rondel.llm import alignment, best_fit, merkle
from rondel.llm.queries import LEAF_COLUMNS, QUERIES
from rondel.llm.tokens import vocabulary

FULL = "doc_id long, text string, lang string, source string, n_chars long, `group` string, hash int, `kids.x` string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(nodes):
    """The top and, for each node, its siblings ``(left, right)`` from the lowest level on."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = place // 3 * 3
            paths[i].append(("".join(nodes[run:place]), "".join(nodes[place + 1:run + 3])))
        nodes = [sha(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at = [place // 3 for place in at]
    return nodes[0], paths


def brute_manifest(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, brute_leaf(row, row[1]), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, above = brute_tree([trees[s][0] for s in order])
    out = []
    for s, high in zip(order, above):
        for (_, _, leaf, row), low in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1]):
            path, text, key = low + high, row[1], row[0]
            if key is not None and zlib.crc32(str(key).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            fold = brute_leaf(row, text)
            for left, right in path:
                fold = sha(left, fold, right)
            out.append((key, leaf, trees[s][0], root, sha(*(a + b for a, b in path)), fold, fold == root))
    return out


def manifest_rows(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "g", 1, "k") for r in rows], FULL).repartition(parts)
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.manifest(frame, "doc_id", "source", LEAF_COLUMNS, {"text": text})
    found = found.withColumn("fold", merkle.folded(F.col("claimed"), F.col("path")))
    return [tuple(r) for r in found.select("key", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256), "fold",
                                           (F.col("fold") == F.col("root"))).collect()]


def made_rows(sizes, seed=1):
    rnd = random.Random(seed)
    rows, key = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            key += 1
            text = rnd.choice(["a\nb", "é 日本\n", "", None, "x" * 3000, f"text {key}"])
            rows.append((key, text, rnd.choice(["en", None]), source, None if key % 7 == 0 else len(text or "")))
    return rows


@pytest.mark.parametrize("sizes", [
    {"only": 1}, {"a": 2, "b": 1}, {"a": 3, None: 4, "": 1, "é": 10, "Z": 27}, {"s": 28, "t": 9, "u": 1, "v": 82},
    {f"s{i}": i % 4 + 1 for i in range(31)}])
def test_manifest(spark, sizes):
    rows = made_rows(sizes)
    assert collections.Counter(manifest_rows(spark, rows)) == collections.Counter(brute_manifest(rows))


def test_manifest_repeats_and_null_keys(spark):
    rows = made_rows({"a": 5, "b": 2})
    rows += [(None, "n", "en", "a", 1), (None, "m\n", None, "a", 1), rows[0], rows[0], (rows[1][0], "other\n", "fr", rows[1][3], 5)]
    assert collections.Counter(manifest_rows(spark, rows)) == collections.Counter(brute_manifest(rows))


def test_manifest_over_several_tiers(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 2)
    rows = made_rows({"hot": 800, "b": 80, "c": 82, "d": 9, "e": 10} | {f"s{i}": 1 for i in range(90)})
    assert collections.Counter(manifest_rows(spark, rows)) == collections.Counter(brute_manifest(rows))


def test_manifest_of_an_empty_table(spark):
    assert manifest_rows(spark, []) == []


def test_manifest_plan_has_one_shuffle_per_tier(spark):
    nodes = spark.range(100).selectExpr("cast(id % 2 AS string) AS `group`", "50 + id % 2 AS size", "id AS rank", "'h' AS hash", "struct(id AS key) AS item")
    plan = merkle._rolled(nodes, 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


# alignment ------------------------------------------------------------------------------------------------------------

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    letters = alignment.byte_letters()
    entry = {i: bytes(letters[c] for c in e) for e, i in first.get_vocab().items() if all(c in letters for c in e)}
    docs, counts = [], collections.Counter()
    for text in texts:
        x = first.encode(" " + text, add_special_tokens=False).ids if text else []
        y = second.encode(text) if text else []
        names = [second.id_to_piece(i) for i in y]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(y, names)]
        bytes_a = [entry[i] for i in x]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            docs.append((0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
        links, said, i, j = [], [], 0, 0
        place_a, place_b = ({e: k + 1 for k, e in enumerate(ends)} for ends in (ends_a, ends_b))
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = place_a[end], place_b[end]
            said.append(",".join(map(str, x[i:p])) + "|" + ",".join(map(str, y[j:q])))
            links.append((x[p - 1], y[q - 1]))
            i, j = p, q
        docs.append((len(x), len(y), links, ";".join(said)))
        counts.update(links)
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(n_a, n_b, len(links), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), said)
            for n_a, n_b, links, said in docs]


TEXTS = [None, "", " ", "a", "A b  c", " lead", "trail ", "\nnew", "x\n y\n\nz", "x \ny", "tab\tand\r\nline", "<|endoftext|> <s> <unk>",
         "▁ sign", "日本語 текст ñandú", "can't won't I'll 12345 3.14", "word" * 40, "y" * 300, " nbsp　wide", "😀😀 ok", "a\x00b",
         "The quick brown fox, jumped over 13 lazy dogs.\nAnd again: the quick brown fox!", "\n", "  ", "a\n", "é combining", "\t"]


def test_alignment(spark):
    rnd = random.Random(3)
    pieces = " ".join(t for t in TEXTS if t).split(" ") + ["\n", "", "réeuxment", "achlichch,", "(x)"]
    texts = TEXTS + [rnd.choice([" ", " ", "\n", "  "]).join(rnd.choices(pieces, k=rnd.randrange(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i if i % 9 else None, t, i, "b") for i, t in enumerate(texts + texts[:3])],
                                 "doc_id long, text string, pair int, block string").coalesce(2)
    found = alignment.align(docs, A, B).collect()
    expected = brute_alignment(texts + texts[:3])
    assert collections.Counter(tuple(r) for r in found) == collections.Counter(
        (i if i % 9 else None, *row) for i, row in enumerate(expected))
    digests = alignment.align(docs, A, B, digest=True).select("groups").collect()
    assert collections.Counter(r[0] for r in digests) == collections.Counter(sha(e[-1]) if e[-1] else "" for e in expected)


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_blocks_of_any_size_agree(spark, monkeypatch):
    both = alignment.Aligner(A, B)
    texts = [t for t in TEXTS if t] * 3
    whole = both.block(both.encode(texts))
    one_by_one = [both.block(both.encode([t])) for t in texts]
    assert whole[0].tolist() == [x for links, _, _ in one_by_one for x in links.tolist()]
    assert whole[2] == [g for _, _, groups in one_by_one for g in groups]


def test_both_vocabularies_meet_a_word_once():
    """The parts of words are looked up together, and each is given to a library once; ids stay those of whole texts."""
    both = alignment.Aligner(A, B)
    rnd = random.Random(8)
    letters = ["".join(rnd.choices("abcdeéÖstT", k=8)) for _ in range(300)]
    words = [x + sign for x in letters for sign in ("", ",", ".", ";", "?!")]
    texts = ["\n".join(" ".join(rnd.choices(words, k=rnd.randrange(1, 30))) for _ in range(rnd.randrange(1, 6))) for _ in range(500)]
    library, asked = both.b.library, []

    class Counted:
        def encode(self, given, **more):
            asked.extend(given if isinstance(given, list) else [given])
            return library.encode(given, **more)

    both.b.library = Counted()
    ids = both.encode(texts) + both.encode(texts) + both.encode(["", None])
    assert len(asked) == len(set(asked)) <= 2 * len(letters) + 5
    for text, (x, y) in zip(texts + texts + ["", ""], ids):
        assert y.tolist() == library.encode(text)
        assert x.tolist() == (both.a.library.encode(" " + text, add_special_tokens=False).ids if text else [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(61, 64)), min_size=1, max_size=6))
def test_shared_ends(texts):
    a, b, last, base = [], [], [], 0
    for x, y, end in texts:
        a += [base + v for v in sorted(x)] + [base + end]
        b += [base + v for v in sorted(y)] + [base + end]
        last.append(len(a) - 1)
        base += end
    found = alignment.shared_ends(np.array(a), np.array(b), np.array(last))
    assert found.tolist() == [v in set(b) for v in a]


def test_long_interval_without_a_cut():
    a, b = np.arange(1, 200_001, 2), np.arange(2, 200_001, 2)
    a, b = np.append(a, 300_000), np.append(b, 300_000)
    assert alignment.shared_ends(a, b, np.array([len(a) - 1])).sum() == 1


# packing --------------------------------------------------------------------------------------------------------------

def used(patterns):
    out = collections.Counter()
    for lengths, n in patterns:
        for x in lengths:
            out[x] += n
    return out


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_patterns_use_every_length_once(counts):
    patterns = best_fit.pack_exact(counts, 40)
    assert used(patterns) == collections.Counter(counts)
    assert all(sum(lengths) <= 40 and n > 0 for lengths, n in patterns)
    full, left = best_fit.exact_fills(counts, 40)
    assert all(sum(lengths) == 40 for lengths, _ in full)
    assert used(full) + collections.Counter(left) == collections.Counter(counts)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=12), st.integers(1, 30))
def test_complement_lookup(counts, gap):
    import itertools

    held = best_fit.Complements(counts, 30)
    items = [x for x, n in counts.items() for _ in range(min(n, 3))]
    sums = {k: any(sum(c) == gap for c in itertools.combinations(items, k)) for k in (1, 2, 3)}
    found = held.filling(gap)
    assert bool(found) == any(sums.values())
    if found:
        assert sum(found) == gap and all(collections.Counter(found)[x] <= counts[x] for x in found)
        assert len(found) == min(k for k in sums if sums[k])


@pytest.mark.parametrize("seed", range(3))
def test_few_sequences(seed):
    rnd = np.random.default_rng(seed)
    lengths = np.clip(rnd.lognormal(5.5 + seed / 2, 1.0, 50_000).astype(int), 1, 4096)
    patterns = best_fit.pack_exact(dict(collections.Counter(lengths.tolist())), 4096)
    least = -(-int(lengths.sum()) // 4096)
    assert sum(n for _, n in patterns) <= least * 1.003 + 1


def test_counts_of_any_size():
    patterns = best_fit.pack_exact({4000: 10 ** 11, 96: 10 ** 11, 1500: 3, 3000: 10 ** 10}, 4096)
    assert used(patterns) == {4000: 10 ** 11, 96: 10 ** 11, 1500: 3, 3000: 10 ** 10}
    assert len(patterns) < 20


def check_places(found, docs, most, end_id):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    sequences = collections.defaultdict(list)
    rows = collections.Counter()
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        rows[r.doc_id, r.start, r.length, r.ids_crc32] += 1
    expected = collections.Counter()
    for key, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end_id]
        for start in range(0, len(ids), most):
            piece = ids[start:start + most]
            expected[key, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert rows == expected
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    return len(sequences)


def test_best_fit_places(spark):
    rnd = random.Random(5)
    docs = [(None, None), (1, ""), (1, ""), (2, "<|endoftext|> x"), (3, "long " * 200)]
    docs += [(i, " ".join(rnd.choices(["a", "bee", "Tokenization", "é", "\n"], k=rnd.randrange(0, 70)))) for i in range(10, 150)]
    frame = spark.createDataFrame([(a, b, 1, "s") for a, b in docs], "doc_id long, text string, length int, task string").repartition(4)
    found = best_fit.pack(frame, vocabulary("word_bpe_49k.json"), sequence_ids=64).collect()
    n = check_places(found, docs, 64, 1)
    assert n <= -(-sum(r.length for r in found) // 64) * 1.05 + 1
    assert best_fit.pack(frame.limit(0), vocabulary("word_bpe_49k.json")).collect() == []


def test_best_fit_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op13_best_fit"](spark, sf_dir).collect()
    n = check_places(found, [tuple(r) for r in docs], 4096, 1)
    assert n <= -(-sum(r.length for r in found) // 4096) + 2
    assert all(r.piece == r.start // 4096 for r in found)


def test_alignment_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_alignment([r.text for r in docs])
    found = QUERIES["op12_alignment"](spark, sf_dir).collect()
    assert collections.Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found) == (
        collections.Counter((d.doc_id, *e[:-1], sha(e[-1]) if e[-1] else "") for d, e in zip(docs, expected)))
