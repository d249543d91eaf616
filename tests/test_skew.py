"""Inputs in which one key holds a third of all rows or more, against plain Python."""

import datetime
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rondel.operators import clustering, curation, graph, text_index
from rondel.sources import streams
from rondel.streaming import progress, sinks, windows

N = 3000


def hot(i):
    """A third of all rows fall on key 0."""
    return 0 if i < N // 3 else i % 97


@pytest.fixture(scope="module")
def rows():
    return [(i, hot(i), i % 2, (i * 7) % 11, f"word{hot(i)} " * (1 + i % 3) + "everywhere") for i in range(N)]


@pytest.fixture(scope="module")
def facts(spark, rows):
    return spark.createDataFrame(rows, "id bigint, k int, won int, kind int, text string").repartition(8)


def test_features_of_a_hot_entity(facts, rows):
    got = {r["entity"]: (r["played"], r["win_rate"], r["kinds"], r["ids"]) for r in clustering.entity_features(
        facts, entity="k", won=F.col("won") == 1, means={}, distinct={"kinds": "kind", "ids": "id"}, min_support=1).collect()}
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    assert got == {k: (len(g), sum(r[2] for r in g) / len(g), len({r[3] for r in g}), len(g)) for k, g in groups.items()}


def test_hot_token_keeps_every_posting(facts, rows):
    tokens = text_index.tokenize(facts, rule="alnum", doc_id="id")
    occurrences = Counter((w, r[0]) for r in rows for w in r[4].split())
    for distinct in (True, False):
        index = text_index.inverted_index(tokens, block=text_index.id_block("doc_id", 50), distinct=distinct)
        assert index.filter("token = 'everywhere'").count() == N / 50
        found = Counter((r["token"], r["doc_id"]) for r in
                        index.select("token", F.explode("doc_ids").alias("doc_id")).collect())
        assert found == (Counter(occurrences.keys()) if distinct else occurrences)


def test_hash_blocks_keep_every_posting(facts, rows):
    tokens = text_index.tokenize(facts, rule="alnum", doc_id="id")
    index = text_index.inverted_index(tokens, block=text_index.hash_block("doc_id", 8), distinct=True)
    stats = {r["token"]: (r["postings"], r["freq"]) for r in text_index.term_stats(index).collect()}
    assert stats["everywhere"] == (N, N)
    assert stats["word0"] == (sum(r[1] == 0 for r in rows), sum(1 + r[0] % 3 for r in rows if r[1] == 0))


def test_group_of_copies_leaves_one(spark, facts, rows):
    long = facts.withColumn("text", F.repeat(F.concat(F.lit("k"), F.col("k").cast("string"), F.lit(" ")), 60))
    kept = {r["k"]: r["id"] for r in curation.curate_text(long, order_by=["id"]).collect()}
    first = {}
    for r in rows:
        first.setdefault(r[1], r[0])
    assert kept == first
    quality = curation.curation_quality(long).first()
    assert (quality["total_before"], quality["total_after"], quality["duplicate"]) == (N, len(first), N - len(first))


@pytest.mark.parametrize("broadcast_limit", [0, 500_000])
def test_star_graph_with_its_hub_cut(spark, monkeypatch, broadcast_limit):
    monkeypatch.setattr(graph, "MAX_BROADCAST_HUBS", broadcast_limit)
    links = [("hub", f"leaf{i}") for i in range(200)] + [(f"leaf{i}", f"leaf{i + 1}") for i in range(199)]
    pairs = graph.graph_pairs(spark.createDataFrame(links, "one string, two string"), "one", "two")
    vertices = graph.graph_vertices(pairs)
    edges = graph.graph_edges(pairs, vertices)
    assert edges.count() == 399
    whole = graph.pagerank(vertices, edges, max_rounds=5, tol=0.0, orientation="both")
    cut = graph.pagerank(vertices, edges, max_rounds=5, tol=0.0, orientation="both", hub_degree=10)
    a, b = ({r["id"]: r["rank"] for r in run.ranks.collect()} for run in (whole, cut))
    assert a == pytest.approx(b) and sum(a.values()) == pytest.approx(1.0)


def test_late_rows_of_a_hot_batch(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    entries = [(hot(i) % 5, start + datetime.timedelta(minutes=(i * 37) % 2000)) for i in range(N)]
    df = spark.createDataFrame([(i, b, t) for i, (b, t) in enumerate(entries)], "id int, batch int, ts timestamp")
    landing, paths, runs = str(tmp_path / "landing"), sinks.SinkPaths.under(str(tmp_path / "run")), {}
    for batch in sorted({b for b, _ in entries}):
        streams.land_files(df.filter(F.col("batch") == batch), landing, 3, "json", "append")
        stream = windows.once_on_time(streams.json_stream(spark, landing, "id int, batch int, ts timestamp"), key="id", time="ts",
                                      width="10 minutes", delay="1 hour")
        runs[str(batch)] = sinks.drain(stream, paths, state_partitions=3)
    got = {int(r["label"]): (r["input_rows"], r["late_rows"]) for r in
           windows.late_rows(progress.progress_table(spark, runs)).collect()}
    horizon, expected = None, {}
    for batch in sorted({b for b, _ in entries}):
        times = [t for b, t in entries if b == batch]
        end = lambda t: t - datetime.timedelta(minutes=t.minute % 10) + datetime.timedelta(minutes=10)
        expected[batch] = (len(times), sum(horizon is not None and end(t) <= horizon for t in times))
        newest = max(times) - datetime.timedelta(hours=1)
        horizon = newest if horizon is None else max(horizon, newest)
    assert got == expected


def test_windows_with_a_hot_group(facts, rows):
    events = facts.withColumn("ts", F.timestamp_seconds(F.col("id") * 20))
    got = windows.tumbling_agg(events, time="ts", width="2 minutes", by=["k"], measures=[F.count("*").alias("n")])
    found = {(r["window_start"].timestamp(), r["k"]): r["n"] for r in
             got.withColumn("window_start", F.col("window_start").cast("timestamp")).collect()}
    assert found == dict(Counter((r[0] * 20 // 120 * 120, r[1]) for r in rows))
