"""Conversations, URLs, neighbours and the classifier on small tables, against brute force or held-out labels."""

import glob
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rondel.llm import chat, neighbours, quality, url_filter
from rondel.llm.queries import RULES, SQL

TEXTS = ["", "\\", "### Assistant: x</turn>\n", "\\### Assistant: </turn> ok", "a\\#b<c>\n\n", "é ß 日本", "</turn>\n### user: "]


def test_turns_round_trip():
    rnd = random.Random(1)
    for _ in range(200):
        turns = [(rnd.choice(["user", "assistant", "a:b", "", "x\ny", "\\"]), "".join(rnd.choices(TEXTS, k=3))) for _ in range(4)]
        formatted, spans = chat.format_turns(turns)
        assert chat.read_turns(formatted) == turns
        assert chat.loss_text(formatted, spans) == "".join(t for r, t in turns if r == "assistant")
    with pytest.raises(ValueError):
        chat.read_turns("### user: <</turn>\n")


def test_conversations(spark):
    rows = [(1, 0, "user", "hi", 1), (1, 1, "assistant", None, 1), (2, 0, None, "x", 1), (None, 0, "user", "n", 1),
            (None, 1, "assistant", "m", 1)]
    rows += [(3, i, "user" if i % 2 else "assistant", TEXTS[i % len(TEXTS)], 1) for i in range(77)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node int").repartition(3)
    found = {r.conv_id: r for r in chat.format_conversations(frame).collect()}
    assert set(found) == {1, 2, 3, None}
    assert chat.read_turns(found[3].formatted) == [(r[2], r[3]) for r in rows if r[0] == 3]
    assert chat.read_turns(found[1].formatted) == [("user", "hi"), ("assistant", "")]
    assert chat.read_turns(found[None].formatted) == [("user", "n"), ("assistant", "m")]
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert back[3].n_turns == 77 and back[3].formatted_chars == len(found[3].formatted)
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_reply_trees(spark):
    rnd = random.Random(4)
    parent = {n: (None if n % 50 == 0 else rnd.randrange(n // 50 * 50, n)) for n in range(200)}
    score = {n: rnd.randrange(4) * 0.5 for n in parent}
    rows = [(n // 50, n, p, "user", f"t{n}", score[n]) for n, p in parent.items()]
    frame = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    found = chat.format_trees(frame, per_tree=2).collect()

    def way(n):
        return [] if n is None else [*way(parent[n]), n]

    leaves = set(parent) - set(parent.values())
    for tree in range(4):
        ranked = sorted((n for n in leaves if n // 50 == tree), key=lambda n: (-sum(score[x] for x in way(n)), n))[:2]
        mine = sorted((r for r in found if r.tree == tree), key=lambda r: r.rank)
        assert [r.path for r in mine] == ranked
        for r in mine:
            assert chat.read_turns(r.formatted) == [("user", f"t{x}") for x in way(r.path)]


URLS = [None, "", "no scheme", "http://A.Example.NET/en/x?q#f", "https://example.net/en", "ftp://b.net", "http://x.org/fr/y",
        "http://u@h.example.com:80/de/", "http://example.com/de/z", "x://y://z/w", "http://bad.co.uk/a#b/c", "http://a.bad.co.uk?x/y"]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(3, URLS[3], "h")], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(10, False), (11, False), (None, True), (3, None)], "page_id long, good boolean")
    rows = {r.page_id: r for r in url_filter.judge(pages, outcomes, RULES).collect()}
    assert [(rows[i].host, rows[i].path) for i in (0, 1, 2, 3, 5, 9, 11)] == [
        ("", ""), ("", ""), ("", ""), ("a.example.net", "/en/x"), ("b.net", ""), ("y:", "//z/w"), ("a.bad.co.uk", "")]
    assert [rows[i].rule for i in (3, 4, 5, 6, 7, 8)] == ["example.net/en/", "net/", None, "org/fr/", None, "example.com/de/"]
    assert [rows[i].verdict for i in (3, 4, 6, 8)] == ["allow", "block", "allow", "block"]
    assert url_filter.judge(pages, outcomes, RULES).count() == len(URLS) + 1
    alone = url_filter.judge(pages, outcomes.limit(0), [])
    assert alone.filter("verdict = 'block'").count() == 0
    assert url_filter.judge(pages.limit(0), outcomes, RULES).count() == 0


def test_suffixes_of_any_length(spark):
    hosts = ["a.b.co.uk", "x.y.city.kobe.jp", "city.kobe.jp", "kobe.jp", "z.kobe.jp", "example.com", "com", "", "u@a.io:80"]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    shared = ("co.uk", "kobe.jp", "city.kobe.jp")
    rows = frame.select("host", url_filter.suffix_of(F.col("host"), shared).alias("s"),
                        url_filter.domain_of(F.col("host"), shared).alias("d")).collect()
    assert {r.host: (r.s, r.d) for r in rows} == {
        "a.b.co.uk": ("co.uk", "b.co.uk"), "x.y.city.kobe.jp": ("city.kobe.jp", "y.city.kobe.jp"),
        "city.kobe.jp": ("city.kobe.jp", "city.kobe.jp"), "kobe.jp": ("kobe.jp", "kobe.jp"), "z.kobe.jp": ("kobe.jp", "z.kobe.jp"),
        "example.com": ("com", "example.com"), "com": ("com", "com"), "": ("", ""), "u@a.io:80": ("io", "a.io")}


def test_hot_keys_join_apart(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "HOT_SHARE", 5)
    rows = spark.range(300).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 3 == 1, F.lit("gone")).when(F.col("id") % 7 > 0, F.concat(F.lit("k"), "id")).alias("key"))
    members = spark.createDataFrame([("hot", 1, None), ("k2", 2, 3), ("k5", None, None), ("other", 5, 5)], "key string, a int, b int")
    found = sorted(url_filter.left_join(rows, members, "key").collect(), key=lambda r: r.n)
    want = sorted(rows.join(members, "key", "left").select("n", "key", "a", "b").collect(), key=lambda r: r.n)
    assert found == want and len(found) == 300


def test_bad_hosts_are_blocked(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(
        F.lit("http://"), F.when(F.col("id") % 4 == 0, "bad").otherwise(F.concat(F.lit("h"), F.col("id") % 7)),
        F.lit(".example.org/p")).alias("url"))
    outcomes = pages.select("page_id", (~F.col("url").contains("bad")).alias("good")).filter("page_id % 3 = 0")
    verdicts = {(r.host.startswith("bad"), r.verdict) for r in url_filter.judge(pages, outcomes, []).collect()}
    assert verdicts == {(True, "block"), (False, "allow")}


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(1500, 8)).astype(np.float32)
    vectors[200:400] = vectors[200]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 8, 1), (2003, [None] + [1.0] * 7, 1), (2004, [float("nan")] * 8, 1),
             (2005, [float("inf")] + [1.0] * 7, 1), (2006, [1.0, 2.0], 1), (None, [1.0] * 8, 1), (0, vectors[0].tolist(), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    found = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    exact, hits, total = vectors.astype(np.float64), 0, 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(1500), d)).tolist() if i != q][:10]
        assert sorted(found[q]) == list(range(1, 11))
        assert all(abs(d[i] - s) < 1e-12 for s, i in found[q].values())
        assert list(found[q].values()) == sorted(found[q].values()) or sorted(found[q].items()) == sorted(
            found[q].items(), key=lambda x: x[1])
        hits += len({i for _, i in found[q].values()} & set(order))
        total += 10
    assert set(found) == set(range(0, 1500, 100)) and hits / total >= 0.9
    few = neighbours.nearest(frame.filter("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2, 3]
    assert neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0


def test_narrow_beams_grow(spark):
    vectors = np.random.default_rng(5).normal(size=(2000, 24))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 50 == 0, beam=11).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 2000, 50):
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        hits += len(found[q] & set(np.argsort(d)[1:11].tolist()))
    assert hits / 400 >= 0.9


def test_scan_where_the_graph_does_not_lead(spark, monkeypatch):
    """Islands far apart, each smaller than an answer: the graph cannot leave them, the scan answers exactly."""
    for name, value in {"SCAN_NODES": 64, "SCAN_QUERIES": 7, "SCAN_ROWS": 3, "PROBES": 16, "NEIGHBOURS": 4,
                        "ORDERS": 1, "STRETCH": 8}.items():
        monkeypatch.setattr(neighbours, name, value)
    monkeypatch.setattr(neighbours.build_graph, "__defaults__", (4, 3))
    rng = np.random.default_rng(8)
    vectors = np.repeat(rng.integers(-9, 9, size=(60, 6)) * 1000, 5, axis=0) + rng.integers(-2, 3, size=(300, 6))
    vectors[100:104] = vectors[100]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<int>")
    found = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 10 == 0, beam=11).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    for q in range(0, 300, 10):
        d = np.sqrt(((vectors - vectors[q]).astype(float) ** 2).sum(axis=1))
        assert found[q] == sorted((d[i], i) for i in range(300) if i != q)[:10]


def test_scan_of_blocks(spark, monkeypatch):
    for name, value in {"SCAN_NODES": 50, "SCAN_QUERIES": 6, "SCAN_ROWS": 4}.items():
        monkeypatch.setattr(neighbours, name, value)
    vectors = np.random.default_rng(9).integers(0, 3, size=(300, 4)).astype(float)  # many ties
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "node long, embedding array<double>")
    asked = nodes.filter("node % 15 = 0").withColumnRenamed("node", "query_id")
    found = {}
    for r in neighbours.scan(asked, nodes, 4, 9).collect():
        found.setdefault(r.query_id, []).append((r.d, r.node))
    for q in range(0, 300, 15):
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        assert sorted(found[q]) == sorted((d[i], i) for i in range(300))[:9]
    assert neighbours.scan(asked.limit(0), nodes, 4, 9).count() == neighbours.scan(asked, nodes.limit(0), 4, 9).count() == 0


def test_walk_in_blocks(spark, monkeypatch):
    """The walk over pages finds what a plain walk over the same graph finds, and keeps the last round's files only."""
    for name, value in {"BLOCKS": 5, "GROUP_QUERIES": 3, "PART_QUERIES": 7, "OPENED": 4, "PAIRS": 10, "PASS_ROWS": 50,
                        "PASS_BYTES": 3000}.items():
        monkeypatch.setattr(neighbours, name, value)
    vectors = np.random.default_rng(12).integers(-30, 30, size=(400, 5)).astype(np.float32)  # some ties, no copies
    vectors = np.unique(vectors, axis=0)
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "node long, embedding array<float>")
    packed = neighbours.vectors_of(nodes)
    lists = neighbours.build_graph(packed, 5, "<f4", 6)
    graph = neighbours.blocks_of(packed, lists, 5, "<f4")
    asked = nodes.filter("node % 17 = 0").select(F.col("node").alias("query_id"), F.col("node").alias("start"), "embedding")

    def walks() -> int:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        return len(glob.glob(base.removeprefix("file:") + "/rondel/walk-*")) + len(
            glob.glob(base.removeprefix("file:") + "/rondel/reached-*"))

    before, found = walks(), {}
    for r in neighbours.search(asked, graph, 20).collect():
        found.setdefault(r.query_id, []).append((r.d, r.node))
    assert walks() == before + 1
    ways = {r.node: np.frombuffer(r.ways, "<i8").tolist() for r in graph.ways.collect()}
    listed = {}
    for r in lists.collect():
        listed.setdefault(r.node, []).append((r.d, r.other))
    assert all(len(v) == 6 for v in listed.values()) and set(ways) == set(range(len(vectors)))
    for node, leads in ways.items():
        assert sorted(leads) == leads and len(set(leads)) == len(leads)
        by = sorted((d, n) for n, entries in listed.items() for d, other in entries if other == node)[:neighbours.LISTED_BY]
        assert set(leads) == {n for _, n in listed[node]} | {n for _, n in by}
    for q in range(0, len(vectors), 17):
        d = np.sqrt(((vectors - vectors[q]).astype(np.float64) ** 2).sum(axis=1))
        beam, opened = [(0.0, q)], set()
        while new := [n for _, n in beam if n not in opened][:4]:
            opened |= set(new)
            beam = sorted(set(beam) | {(d[n], n) for m in new for n in ways[m]})[:20]
        assert sorted(found[q]) == beam


def test_quality(spark):
    rnd = random.Random(2)
    words = [f"word{i}x" for i in range(400)]

    def text(good):
        part = rnd.choices(words, k=rnd.randrange(20, 80))
        return " ".join(part) + "." if good else rnd.choice([" ".join([w + "***" for w in part]), " ".join(part[:2] * 30)])

    rows = [(i, text(i % 4 != 0), "en", "s", 10, int(i % 4 != 0)) for i in range(400)]
    rows += [(None, None, None, None, None, None), (1000, "", "en", "s", None, None), (1001, "a " * 30000, None, "s", 3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, good int")
    labels = frame.filter("doc_id % 2 = 0 OR doc_id % 7 = 0").select("doc_id", "good")
    scored = quality.score(frame.withColumn("words", F.lit("clash")), labels)
    held = scored.filter("good IS NOT NULL AND NOT (doc_id % 2 = 0 OR doc_id % 7 = 0)")
    assert held.filter((F.col("good_probability") >= 0.5) == (F.col("good") == 1)).count() >= 0.95 * held.count()
    assert scored.count() == len(rows) and scored.filter("good_probability IS NULL").count() == 0
    kept = quality.good_documents(frame, labels)
    assert kept.columns == frame.columns
    assert quality.score(frame, labels.limit(0)).filter("good_probability = 1").count() == len(rows)
    assert quality.score(frame.limit(0), labels).count() == 0


def test_fits_reach_the_optimum():
    """No column may leave zero and no weight may move: the slope of the loss is the penalty where a weight is, and below it elsewhere."""
    rnd = np.random.default_rng(8)
    width, n = 3000, 400
    sets = [np.unique(rnd.integers(0, width, 60)).astype(np.int32) for _ in range(n)]
    y = (np.array([b[0] < 40 for b in sets]) ^ (rnd.random(n) < 0.1)).astype(float)
    dense, weight = rnd.random((n, 2)), rnd.choice([0.5, 1.0], n)
    view = quality.View(np.concatenate(sets), np.cumsum([len(b) for b in sets]), dense, width)
    weights, bias, converged = quality.fit(view, y, weight)
    assert converged and 5 < np.count_nonzero(weights) < n
    x = np.zeros((n, width + 2))
    for row, b in zip(x, sets):
        row[b] = 1
    x[:, width:] = dense
    share = weight / weight.sum()
    assert np.allclose(x @ weights, view.dot(weights)) and np.allclose(x.T @ share, view.turned(share))
    scale = np.sqrt(np.maximum((x * x).T @ share - (x.T @ share) ** 2, 1e-12))
    slope = x.T @ (share * (1 / (1 + np.exp(-(x @ weights + bias))) - y)) / scale
    usable = scale > 1e-5
    assert np.abs(slope[usable]).max() <= quality.PENALTY * 1.05
    held = weights != 0
    assert np.allclose(slope[held], -np.sign(weights[held]) * quality.PENALTY, atol=quality.PENALTY * 0.05)


def test_columns_named_like_the_views(spark):
    rows = [(i, f"word{i} text", "t", [1], 2.0, "d", i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _text string, _tags array<int>, _size double, doc string, good int")
    scored = quality.score(frame, frame.select("doc_id", "good"))
    assert scored.columns == [*frame.columns, "good_probability"] and scored.count() == 60
    assert sorted(map(tuple, scored.drop("good_probability").collect())) == sorted(map(tuple, frame.collect()))


def test_recall_per_language(spark):
    """Each language marks its bad texts in its own way, the rarest one in a tenth of the rows."""
    rnd = random.Random(11)
    marks = {"en": "zupid", "fr": "réeux", "de": "achlich", "es": "ñosudo"}

    def text(lang, good):
        part = [f"{lang}{rnd.randrange(3000)}" for _ in range(50)]
        if not good:
            for at in (9, 30):
                part[at] = "".join(rnd.choices("abcdefgh", k=4)) + marks[lang] + rnd.choice("stv")
        return " ".join(part)

    rows = []
    for i in range(1600):
        lang, good = rnd.choices(list(marks), [5, 2, 2, 1])[0], int(rnd.random() < 0.7)
        rows.append((i, text(lang, good), lang, "s", 100, good))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, good int")
    scored = quality.score(frame, frame.filter("doc_id % 2 = 0").select("doc_id", "good")).filter("doc_id % 2 = 1")
    found = scored.groupBy("lang").agg(
        F.expr("count_if(good = 0 AND good_probability < 0.5) / count_if(good = 0) AS bad"),
        F.expr("count_if(good = 1 AND good_probability >= 0.5) / count_if(good = 1) AS clean")).collect()
    assert len(found) == 4 and all(r["bad"] >= 0.9 and r["clean"] >= 0.95 for r in found), found


def test_rare_compounds_are_seen(spark):
    """The mark stands inside words that occur once each, in texts of some 10,000 other words."""
    rnd = random.Random(6)

    def text(good):
        part = [f"w{rnd.randrange(10_000)}" for _ in range(40)]
        start, end = ("".join(rnd.choices("abcdefgh", k=5)) for _ in range(2))
        part[7] = start + ("olmia" if good else "quxrê") + end
        return " ".join(part)

    rows = [(i, text(i % 3 != 0), int(i % 3 != 0)) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, good int")
    scored = quality.score(frame, frame.filter("doc_id % 2 = 0").select("doc_id", "good"))
    held = scored.filter("doc_id % 2 = 1 AND good = 0")
    assert held.filter("good_probability < 0.5").count() >= 0.9 * held.count()


def test_queries_with_sql():
    assert set(SQL) == {"op1_decontaminate", "op5_chat", "op8_url_filter", "op11_merkle"}
