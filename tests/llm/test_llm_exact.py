"""Operators on small tables with nulls, ties, repeats and odd texts, against brute force."""

import collections
import gc
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rondel.llm import components, decontaminate, line_dedup, packing, simhash, substring_dedup, token_files, tokens
from rondel.llm.fm_index import FmIndex
from rondel.llm.shared import plain_words, with_place
from rondel.llm.tokens import WordCache, vocabulary
from rondel.session import scratch_path

DOCS = "doc_id long, text string, row int, `file` string, `doc.x` string"


def table(spark, rows, extra=True):
    """Rows ``(doc_id, text)`` with columns whose names clash with those the operators use inside."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(a, b, i, "f", None) for i, (a, b) in enumerate(rows)], DOCS).coalesce(2)


ODD = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, "one two three"), (5, "x" * 5000),
       (6, "é ß 日本   x"), (7, "be " * 300), (None, "one two three"), (8, "a\n\nb c d e f\r\ng")]


def brute_contaminated(docs, items, size=10):
    windows = {}
    for key, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i:i + size]), set()).add(key)
    lengths = {len(w) for w in windows}
    out = []
    for key, text in docs:
        words = plain_words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                owners = windows.get(tuple(words[i:i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        out.append((key, len(words), len(hit), tuple(sorted(x for x in found if x is not None)), bool(hit)))
    return out


def contaminated(docs, items):
    return [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated)
            for r in decontaminate.contaminated(docs, items).collect()]


def same(a, b):
    assert collections.Counter(map(repr, a)) == collections.Counter(map(repr, b))


def test_contaminated(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randrange(0, 16)))) for i in range(12)]
    items += [(3, items[3][1]), (None, "only here it is"), (99, None), (98, "The"), (97, "a b"), (96, "b a")]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randrange(0, 40)) + items[i % 12][1].upper().split())) for i in range(40)]
    docs += ODD + [(50, "x THE y only-here it IS a b a")]
    frame = table(spark, items, False).withColumnRenamed("doc_id", "item_id")
    same(contaminated(table(spark, docs), frame), brute_contaminated(docs, items))
    same(contaminated(table(spark, docs), frame.limit(0)), brute_contaminated(docs, []))
    assert contaminated(table(spark, []), frame) == []
    clean = decontaminate.clean_documents(table(spark, docs), frame)
    assert clean.columns == table(spark, docs).columns
    want = [d[0] for d, b in zip(docs, brute_contaminated(docs, items)) if not b[4]]
    same([r.doc_id for r in clean.collect()], want)


def brute_repeats(docs, size):
    split = [(x or "").encode().split() for _, x in docs]
    counts = collections.Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for (key, text), words in zip(docs, split):
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if counts[tuple(words[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((key, len(words), sum(gone), None if text is None else kept))
    return out


@pytest.mark.parametrize("segments", [8, 8000])
def test_substring_repeats(spark, monkeypatch, segments):
    monkeypatch.setattr(substring_dedup, "SHARD_SEGMENTS", segments)  # small: crowded anchors are dealt by windows
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    passages = [rnd.choices(words, k=20) for _ in range(3)]
    docs = []
    for i in range(150):
        text = []
        for _ in range(rnd.randrange(0, 6)):
            text += rnd.choice(passages)[rnd.randrange(0, 6):] if rnd.random() < .6 else rnd.choices(words, k=rnd.randrange(1, 30))
        docs.append((i, " ".join(text)))
    docs += [(d, t) for d, t in ODD]
    done = substring_dedup.without_repeats(table(spark, docs), 12, 5)
    same([(r.doc.doc_id, r.n_words, r.n_removed, r.text) for r in done.collect()], brute_repeats(docs, 12))
    assert substring_dedup.without_repeats(table(spark, []), 12, 5).count() == 0


def test_matching_statistics():
    rng = np.random.default_rng(1)
    text = np.concatenate((rng.integers(1, 5, 800), [0]))
    ends = rng.integers(16, 800, 60)
    numbers = text.tolist()
    for end, found in zip(ends.tolist(), FmIndex(text, 16).matching(text, ends, 16).tolist()):
        longest = 0
        for n in range(1, 17):
            part = numbers[end - n:end]
            if sum(numbers[i:i + n] == part for i in range(len(numbers) - n + 1)) < 2:
                break
            longest = n
        assert longest == found


def groups(values, most):
    label = np.arange(len(values))
    for i in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= most)
        low = label[near].min()
        for old in np.unique(label[near]):
            label[label == old] = low
    return label


def test_near_duplicates(spark):
    rnd = random.Random(5)
    base = rnd.choices([f"w{i}" for i in range(500)], k=120)
    docs = list(ODD)
    for i in range(100, 160):
        copy = list(base)
        for _ in range(rnd.randrange(0, 3)):
            copy[rnd.randrange(120)] = "edited"
        docs.append((i, " ".join(copy)))
    docs += [(200 + i, " ".join(rnd.choices(base, k=50))) for i in range(20)]
    found = simhash.near_duplicates(table(spark, docs)).collect()
    prints = np.array([simhash.fingerprint(t) for _, t in docs], np.uint64)
    label = groups(prints, 2)
    least = {g: min((d for (d, _), k in zip(docs, label) if k == g and d is not None), default=None) for g in set(label)}
    same([(r.doc_id, r.bits % 2**64, r.component_id) for r in found],
         [(d, int(p), least[g]) for (d, _), p, g in zip(docs, prints, label)])
    kept = simhash.keep_one(table(spark, docs))
    assert kept.columns == table(spark, docs).columns
    assert kept.count() == len(set(label))
    assert {r.doc_id for r in kept.collect()} >= {x for x in least.values() if x is not None}
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_dense_trie(spark, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_ROWS", 64)  # nodes are taken apart by joins, several steps deep
    rng = np.random.default_rng(0)
    values = set()
    for centre in rng.integers(0, 2 ** 63, 3, dtype=np.uint64).tolist():
        for _ in range(400):
            x = int(centre)
            for bit in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                x ^= 1 << bit
            values.add(x)
    values = np.array(sorted(values), np.uint64)
    nodes = spark.createDataFrame([(v,) for v in values.view(np.int64).tolist()], "bits long")
    roots = {r.node: r.root for r in components.components(simhash.links(nodes)).collect()}
    signed = values.view(np.int64).tolist()
    mine = [roots.get(v, v) for v in signed]
    want = groups(values, 2)
    assert len(set(mine)) == len(set(want.tolist())) == len(set(zip(mine, want.tolist())))


def brute_lines(docs, t=0.8):
    rows = sorted(((d if d is not None else -1), j, k, frozenset(line.encode().split())) for k, (d, x) in enumerate(docs)
                  for j, line in enumerate((x or "").split("\n")) if line.encode().split())
    first = {}
    for d, j, k, s in rows:
        first.setdefault(s, (d, j, k))
    sets, gone = list(first), set()
    for i, s in enumerate(sets):
        for x in sets[:i]:
            both = len(s & x)
            if both >= t * (len(s) + len(x) - both) - 1e-9:
                gone.add(s)
                break
    keep = {(first[s][2], first[s][1]) for s in sets if s not in gone}
    return [(k, None if x is None else "\n".join(line for j, line in enumerate(x.split("\n"))
                                                 if not line.encode().split() or (k, j) in keep))
            for k, (_, x) in enumerate(docs)]


@pytest.mark.parametrize("proposals, short_run, long_run", [(1, 256, 1 << 17), (3, 4, 1 << 17), (2, 4, 25), (8, 256, 60)])
def test_line_dedup(spark, monkeypatch, proposals, short_run, long_run):
    monkeypatch.setattr(line_dedup, "PROPOSALS", proposals)
    monkeypatch.setattr(line_dedup, "SHORT_RUN", short_run)
    monkeypatch.setattr(line_dedup, "LONG_RUN", long_run)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(300):
        line = words[(i % 5) * 10:(i % 5) * 10 + 14]
        for _ in range(rnd.randrange(0, 5)):
            line[rnd.randrange(14)] = rnd.choice(words)
        docs.append((i if i else None, "\n".join([" ".join(line), "", " ".join(rnd.choices(words, k=rnd.randrange(0, 7)))])))
    docs += [(1001, None), (1002, ""), (1003, " "), (1004, "x y\n\nx y"), (1005, "z " * 2000 + "\nq"), (1005, "z " * 2000 + "\nq")]
    done = line_dedup.dedup_lines(table(spark, docs))
    assert done.columns == table(spark, docs).columns
    same([(r.row, r.text) for r in done.collect()], brute_lines(docs))
    assert line_dedup.dedup_lines(table(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_cache(name):
    cache = WordCache(vocabulary(name), stems=20, words=10)
    texts = ["a  b\tc", "", None, "\n\nx", " lead", "trail ", "it's 5,000 'tis\n'Tis x", "Σ ΑΣ é \x1c ok", "日本 語",
             "²x ½, naïve! Ünï #a* *b 3rd ÐÞß", "<|endoftext|> <|startoftext|>", "é ́x", "plain words, plain.\nNext line"]
    plain = [np.array(cache.library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert cache.encode(texts) == plain
    assert cache.encode(texts[::-1]) == plain[::-1]


def test_runs_are_ordered_where_they_are_compared():
    """Entries of a run may come in any order: a line meets the lines before it, null ids first."""
    rnd = np.random.default_rng(4)
    n = 600
    word = np.sort(rnd.integers(0, 4, n)).astype(np.int32)
    doc = [None if x == 0 else int(x) for x in rnd.permutation(n)]
    columns = [word, np.zeros(n, np.int64), np.full(n, 5, np.int32), np.zeros(n, np.int64), np.full(n, line_dedup.WITHIN, np.int32),
               np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), doc, np.zeros(n, np.int32)]
    rows = pa.table([pa.array(c) for c in columns], names=line_dedup._ENTRY)

    def pairs(table, size=150):
        found = list(line_dedup._propose(0.8)(iter(table.to_batches(max_chunksize=size))))
        return sorted((x["name"], x["other"]) for b in found for x in b.to_pylist())

    expected = []
    for w in range(4):
        run = sorted(np.flatnonzero(word == w).tolist(), key=lambda i: doc[i] or 0)
        expected += [(run[i], run[j]) for i in range(len(run)) for j in range(min(i, line_dedup.PROPOSALS + 1))]
    assert pairs(rows) == pairs(rows, n) == sorted(expected)


def test_order_of_equal_high_bits():
    key = np.array([5, 5, 5, 5, 2, 5])
    hashes = np.array([7, 3, 7, 1 << 40, 9, 3], np.uint64)
    order = line_dedup._by_key(key, hashes)
    assert [(key[i], hashes[i]) for i in order] == sorted(zip(key, hashes))
    assert len(line_dedup._by_key(key[:0], hashes[:0])) == 0


def test_counts_leave_a_task_as_pages():
    texts = ["a b c a", None, "", "d\na " + " ".join(f"w{i}" for i in range(20_000))]
    batches = list(line_dedup._count_words()(iter([pa.record_batch([pa.array(texts)], names=["text"])] * 2)))
    assert sum(b.num_rows for b in batches) <= line_dedup.CELLS // 4096
    rows = sorted((x["page"], x["data"]) for b in batches for x in b.to_pylist())
    pages = pa.record_batch(list(zip(*rows)), names=["page", "data"])
    ranks = np.zeros(line_dedup.CELLS, "<u2")
    for x in (x for b in line_dedup._rank_pages(iter(pages.slice(i, 100) for i in range(0, len(rows), 100))) for x in b.to_pylist()):
        ranks[x["page"] * 4096:(x["page"] + 1) * 4096] = np.frombuffer(x["data"], "<u2")
    counts = np.zeros(line_dedup.CELLS, np.int64)
    for text in 2 * texts:
        np.add.at(counts, line_dedup._cell(line_dedup.WordHasher().words(np.frombuffer((text or "").encode(), np.uint8))[2]), 1)
    assert (ranks == np.floor(np.log2(np.maximum(counts, 1)) * 1000)).all() and counts.max() >= 6


def test_only_lines_asked_for_are_hashed(monkeypatch):
    texts = ["one two\nthree two three\n\nfour", None, "", "five\nsix"]
    rows = np.array([11, -5, 7, 1 << 40])
    asked = line_dedup._line_keys(rows[[0, 3, 0]], np.array([1, 0, 2]))

    class Wanted:
        def passes(self, keys):
            return np.isin(keys, asked)

    hashed = []
    words = line_dedup.WordHasher.words
    monkeypatch.setattr(line_dedup.WordHasher, "words", lambda self, data: hashed.append(bytes(data)) or words(self, data))
    found = [x for b in line_dedup._fetch(Wanted())(iter([pa.record_batch([pa.array(texts), pa.array(rows)], names=["text", "row"])]))
             for x in b.to_pylist()]
    assert hashed == [b"three two three\n\nfive"]
    assert sorted(len(x["set"]) for x in found) == [1, 2]


def test_lines_read_again_keep_their_places(monkeypatch):
    """The same set at two places asked for comes twice, each time with its place; chunks of a few bytes."""
    monkeypatch.setattr(line_dedup, "CHUNK", 8)
    texts, rows = ["a b\n\nc", None, "x\nb a\n \nd"], np.array([11, 5, -7])
    keys = line_dedup._line_keys(rows[[0, 0, 2, 2]], np.array([0, 1, 1, 3]))

    class Wanted:
        def passes(self, all_keys):
            return np.isin(all_keys, keys)

    batch = pa.record_batch([pa.array(texts), pa.array(rows)], names=["text", "row"])
    found = [x for b in line_dedup._fetch(Wanted())(iter([batch])) for x in b.to_pylist()]
    assert [(x["key"], len(x["set"])) for x in found] == [(keys[0], 2), (keys[2], 2), (keys[3], 1)]
    assert found[0]["name"] == found[1]["name"] != found[2]["name"]


def test_place_keys_agree(spark):
    rows = [(5, 0), (-7, 3), (1 << 62, 100_000), (-1, 2 ** 31 - 1)]
    keys = spark.createDataFrame(rows, "row long, line int").select(line_dedup._place_key(F.col("row"), F.col("line")))
    assert [r[0] for r in keys.collect()] == line_dedup._line_keys(*(np.array(c, np.int64) for c in zip(*rows))).tolist()


def paged(batches, size=3):
    """Pages in the order of their buckets, in small batches."""
    pages = pa.Table.from_batches(batches).sort_by("bucket").combine_chunks()
    return iter(pages.to_batches(max_chunksize=size))


def test_entries_travel_as_pages():
    """Rows that are shuffled are pages; the entries in them propose what the rows of sorted entries do."""
    rnd = np.random.default_rng(5)
    sets = [dict(words=rnd.choice(40, rnd.integers(0, 9), replace=False) * 100_000_007 % (1 << 32) - (1 << 31), n=int(rnd.integers(8, 14)),
                 skip=int(rnd.integers(0, 2)), name=i, sketch=int(rnd.integers(0, 8)), wide=0,
                 doc_id=None if i % 50 == 0 else int(rnd.integers(0, 400)), line=int(rnd.integers(0, 3))) for i in range(900)]
    kinds = {"words": pa.list_(pa.int32()), "n": pa.int32(), "skip": pa.int32(), "line": pa.int32()}
    table = pa.table({k: pa.array([x[k] for x in sets], kinds.get(k, pa.int64())) for k in sets[0]})
    batches = table.to_batches(max_chunksize=200)
    entries = [(int(w), 0, x["n"], x["skip"] + k, line_dedup.WITHIN, x["name"], x["sketch"], x["wide"], x["doc_id"], x["line"])
               for x in sets for k, w in enumerate(x["words"])]
    pages = list(line_dedup._deal_entries(7)(iter(batches[:2]))) + list(line_dedup._deal_entries(7)(iter(batches[2:])))
    counts = [x["rows"] for b in pages for x in b.to_pylist()]
    assert sum(counts) == len(entries) and len(counts) < len(entries) / 50 and max(counts) <= 256
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    rows = pa.table([pa.array(c, k) for c, k in zip(zip(*sorted(entries, key=lambda e: e[0])), kinds)], names=line_dedup._ENTRY)

    def pairs(found):
        return sorted(tuple(x.values()) for b in found for x in b.to_pylist())

    plain = pairs(line_dedup._propose(0.8)(iter(rows.to_batches(max_chunksize=100))))
    assert pairs(line_dedup._propose_pages(0.8)(paged(pages))) == pairs(line_dedup._propose_pages(0.8)(paged(pages, 1000))) == plain
    assert any(x[-1] for x in plain)
    assert not list(line_dedup._deal_entries(7)(iter([batches[0].slice(0, 0)])))


def test_lines_travel_as_pages():
    """Of all lines that are one set, the first one stays, wherever its pages come from."""
    rnd = random.Random(6)
    lines = []
    for _ in range(2000):
        name = rnd.randrange(300) * 0x3D70A3D70A3D70 - (1 << 62)
        lines.append(dict(doc_id=rnd.choice([None, *range(-3, 60)]), file=rnd.randrange(2), row=rnd.randrange(-2, 40), line=rnd.randrange(3), name=name,
                          sketch=rnd.randrange(2), wide=name % 7, n=5 + name % 11, skip=name % 3, often=0, words=[name % 1000] * (name % 4)))
    batches = pa.Table.from_pylist(lines, schema=line_dedup._LINE).to_batches(max_chunksize=300)
    pages = [b for part in (batches[:4], batches[4:]) for b in line_dedup._deal_lines(lambda x: x, 9)(iter(part))]
    counts = [x["rows"] for b in pages for x in b.to_pylist()]
    assert sum(counts) == len(lines) and len(counts) < len(lines) / 20 and max(counts) <= 64
    want = {}
    for x in lines:
        place = (x["doc_id"] is not None, x["doc_id"] or 0, x["line"], x["file"], x["row"])
        want[x["name"], x["sketch"]] = min(place, want.get((x["name"], x["sketch"]), place))
    for size in (1, 3, 1000):
        found = [x for b in line_dedup._distinct_sets(paged(pages, size)) for x in b.to_pylist()]
        assert len(found) == len(want)
        for x in found:
            first = x["first"]
            assert want[x["name"], x["sketch"]] == (first["doc_id"] is not None, first["doc_id"] or 0, first["line"], first["file"], first["row"])
            name = x["name"]
            assert (x["wide"], x["n"], x["skip"], x["words"]) == (name % 7, 5 + name % 11, name % 3, [name % 1000] * (name % 4))


def test_short_runs_meet_sizes_that_fit():
    """The pairs of short runs are those that a look at every pair gives, with the same first partners."""
    rnd = np.random.default_rng(8)
    n = 500
    size, run = rnd.integers(4, 30, n), np.sort(rnd.integers(0, 20, n))
    place = rnd.integers(0, 3, n)
    sketch, wide = (rnd.integers(0, 4, n).astype(np.uint64) for _ in range(2))
    rows = [size, place, np.full(n, line_dedup.WITHIN), np.arange(n).astype(np.uint64), sketch, wide, np.ones(n, np.int8), np.arange(n), np.zeros(n, int)]
    found = [(x["name"], x["other"]) for b in line_dedup._compare(0.8)(run, rows) for x in b.to_pylist()]
    want = []
    for z in range(n):
        met = []
        for x in range(z):
            a, b = int(size[z]), int(size[x])
            need = -(-4 * (a + b) // 9)
            apart = (int(sketch[z]) ^ int(sketch[x])).bit_count() + (int(wide[z]) ^ int(wide[x])).bit_count()
            if run[z] == run[x] and 5 * min(a, b) >= 4 * max(a, b) and min(a - place[z], b - place[x]) >= need and (a + b - apart) // 2 >= need:
                met.append((z, x))
        want += met[:line_dedup.PROPOSALS + 1]
    assert sorted(found) == sorted(want) and len(want) > 300


def test_lines_are_cut_without_python(spark):
    docs = [(1, "a b\n \t\x0b\x0c\r\na b\n\nc\n"), (2, "a b"), (3, None), (4, ""), (5, "\n"), (6, " \n\x1c\nc\r\né x \nd"), (None, "c")]
    done = line_dedup.with_removals(table(spark, docs))
    plan = done._jdf.queryExecution().toString()
    assert "EvalPython" not in plan
    assert done._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1  # not once for each use of the lines
    found = {r.doc.doc_id: (r.text, r.n_removed) for r in done.collect()}
    assert found == {1: ("a b\n \t\x0b\x0c\r\n\n", 2), 2: ("", 1), 3: (None, 0), 4: ("", 0), 5: ("\n", 0),
                     6: (" \n\x1c\né x \nd", 1), None: ("c", 0)}


class Counted:
    """The library, with the number of texts it was asked for."""

    def __init__(self, library):
        self.library, self.asked = library, 0

    def encode_batch_fast(self, texts, **more):
        self.asked += len(texts)
        return self.library.encode_batch_fast(texts, **more)

    def encode(self, text, **more):
        self.asked += 1
        return self.library.encode(text, **more)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("lead", ["", " "])
def test_words_reach_the_library_together(name, lead):
    rnd = random.Random(6)
    words = ["".join(rnd.choices("abcdeéÖstTR", k=rnd.randrange(1, 9))) + rnd.choice(["", ",", ".", "?!"]) for _ in range(5000)]
    texts = ["\n".join(" ".join(rnd.choices(words, k=rnd.randrange(1, 30))) for _ in range(rnd.randrange(1, 6))) for _ in range(900)]
    cache = WordCache(vocabulary(name))
    plain = [np.array(cache.library.encode(lead + t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    small = WordCache(vocabulary(name), stems=50, words=20)
    assert [x for i in range(0, 900, 100) for x in small.encode(texts[i:i + 100], lead)] == plain
    cache.library = Counted(cache.library)
    assert cache.encode(texts, lead) == plain
    assert cache.library.asked < 50
    asked = cache.library.asked
    assert cache.encode(texts[::-1], lead) == plain[::-1]
    assert cache.library.asked == asked
    assert cache.encode([None, ""], lead) == [b"", b""] and cache.encode([], lead) == []


def test_cache_holds_many_strings_in_little_room():
    n = 200_000
    words = pa.array([f"word{i:08d}" for i in range(n)])
    one = np.ones(n, np.int64)
    gc.collect()
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        cache = tokens.Slots(n)
        found = cache.find("", words, lambda strings: [(np.arange(len(strings), dtype="<u4"), one[:len(strings)])])
        gc.collect()
        room = tracemalloc.get_traced_memory()[0] - found.nbytes + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert cache.runs(found[:, None], 0)[0].tolist() == list(range(n))
    assert room < 70 * n


def test_best_fit_worker_keeps_a_bounded_part_of_the_words():
    """With the sizes that ``pieces`` uses: a worker that meets ever new words keeps no more than these and a span's."""
    rnd = random.Random(12)
    cache = WordCache(vocabulary("word_bpe_49k.json"))
    for _ in range(8):
        cache.encode([" ".join("".join(rnd.choices("abcdefghij", k=9)) for _ in range(60_000))])
        assert len(cache.parts.stems.starts[0]) <= 300_000 + 60_000 + 2


def test_full_cache_keeps_what_is_met_again():
    rnd = random.Random(8)
    cache = WordCache(vocabulary("word_bpe_49k.json"), stems=400, words=20)
    often = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(50)]
    learned, learn = collections.Counter(), cache.stem_ids
    cache.stem_ids = lambda stems, before: learned.update(stems) or learn(stems, before)
    for _ in range(12):
        text = " ".join(often + ["".join(rnd.choices("abcdefgh", k=9)) for _ in range(150)])
        assert cache.encode([text]) == [np.array(cache.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert all(learned[x] == 1 for x in often) and len(learned) > 1800


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_the_library_has_them(name):
    from tokenizers import Tokenizer

    path = vocabulary(name)
    fresh = Tokenizer.from_file(path)
    added = [t.content for t in fresh.get_added_tokens_decoder().values()]
    assert added
    texts = [t for a in added for t in (a, f"one {a} two", f"one{a}two\n{a}  x", f" {a}", f"{a} ", a.upper(), a[:-1])]
    plain = [np.array(fresh.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert WordCache(path).encode(texts) == plain


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, monkeypatch, bits):
    monkeypatch.setattr(token_files, "CHUNK_IDS", 50)
    monkeypatch.setattr(token_files, "BLOCK_IDS", 16)
    folder = scratch_path(spark, "ids")
    path = vocabulary("byte_bpe_50k.json")
    token_files.write_ids(table(spark, ODD), path, folder, bits=bits)
    rows = token_files.read_ids(spark, folder).collect()
    library = WordCache(path).library
    want = collections.Counter((d, tuple(library.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t in ODD)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids)
    digest = {(r.start, r.ids_crc32) for r in token_files.read_ids(spark, folder, digest=True).collect()}
    assert digest == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows}
    token_files.write_ids(table(spark, []), path, folder)
    assert token_files.read_ids(spark, folder).count() == 0


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("ids", [[], [0], [0, 0, 0], [2 ** 32 - 1, 1], list(range(70000))])
def test_blocks(ids, bits):
    ids = np.array(ids, "<u4")
    ends, payload = token_files.pack_chunk(ids, bits)
    assert np.array_equal(token_files.unpack_chunk(ends, payload), ids)


def test_histogram_packing():
    rnd = random.Random(1)
    counts = collections.Counter(min(64, max(1, int(rnd.lognormvariate(2.5, 1)))) for _ in range(3000))
    patterns = packing.pack_histogram(dict(counts), 64)
    back = collections.Counter()
    for lengths, n in patterns:
        assert sum(lengths) <= 64 and n > 0
        for x in lengths:
            back[x] += n
    assert back == counts
    assert sum(a * b for a, b in counts.items()) > 0.97 * 64 * sum(n for _, n in patterns)
    assert packing.pack_histogram({}, 64) == []


def test_packing(spark):
    path = vocabulary("word_bpe_49k.json")
    docs = table(spark, ODD)
    cut = packing.pieces(docs, path, 16)
    rows = packing.place(cut, 16).collect()
    library = WordCache(path).library
    want = [tuple(library.encode(t or "", add_special_tokens=False).ids) + (2,) for _, t in ODD]
    assert sum(r.length for r in rows) == sum(map(len, want))
    used = collections.defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 16
    full = packing.sequences(cut, 16, pad_id=0).collect()
    assert {r.sequence_id: r.used for r in full} == {k: sum(n for _, n in v) for k, v in used.items()}
    assert all(len(r.ids) == (r.used if r.used & (r.used - 1) == 0 else 16) for r in full)
    assert packing.pack(table(spark, []), path).count() == 0


def test_place_is_stable(spark):
    docs = table(spark, ODD)
    stored = with_place(docs)
    assert stored.select("file", "row").distinct().count() == len(ODD)
    assert stored.select("doc.*").columns == docs.columns


def test_components(spark):
    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(300, 300)] \
        + [(rnd.randrange(400, 500), rnd.randrange(400, 500)) for _ in range(60)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    label = {x: x for p in pairs for x in p}
    for _ in range(100):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert {k: v for k, v in label.items() if k != v} == found
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_sha_of_nothing(spark):
    docs = table(spark, [(1, None)])
    done = substring_dedup.without_repeats(docs).select(F.sha2(F.coalesce("text", F.lit("")), 256)).first()[0]
    assert done == hashlib.sha256(b"").hexdigest()
