import datetime
import json

import pytest
from pyspark.sql import functions as F

from rondel.sources import streams
from rondel.streaming import progress, sinks, state, windows

SCHEMA = "ts timestamp, kind string, v int"


def rows(spark, *entries):
    return spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1, *map(int, t.split(":"))), k, v) for t, k, v in entries], SCHEMA)


def counts(events, delay=None):
    return windows.tumbling_agg(events, time="ts", width="5 minutes", by=["kind"], delay=delay,
                                measures=[F.count("*").alias("n"), F.sum("v").alias("v")])


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def paths(tmp_path):
    return sinks.SinkPaths.under(str(tmp_path / "run"))


def drain(spark, landing, paths):
    return sinks.drain(counts(streams.json_stream(spark, landing, SCHEMA), "30 minutes"), paths)


BATCHES = [
    [("10:00", "a", 1), ("10:10", "a", 2)],
    [("10:20", "a", 4), ("11:00", "b", 8), ("09:00", "a", 16)],
    [("09:01", "a", 32), ("11:45", "b", 64)],
]


def test_late_rows_are_dropped_and_counted(spark, landing, paths):
    for batch in BATCHES:
        streams.land_files(rows(spark, *batch), landing, 1, "json", "append")
        drain(spark, landing, paths)
    emitted = {(r["window_start"].strftime("%H:%M"), r["kind"]): r["v"] for r in sinks.read_sink(spark, paths).collect()}
    # 09:00 and 09:01 came after 10:10 - 30 min had passed their window
    assert emitted == {("10:00", "a"): 1, ("10:10", "a"): 2, ("10:20", "a"): 4, ("11:00", "b"): 8}


def test_late_rows_are_counted_by_the_running_stream(spark, landing, paths):
    runs = {}
    for number, batch in enumerate(BATCHES):
        events = rows(spark, *batch, *batch[:1])  # one row twice
        streams.land_files(events, landing, 2, "json", "append")
        stream = windows.once_on_time(streams.json_stream(spark, landing, SCHEMA), key="v", time="ts", width="5 minutes",
                                      delay="30 minutes")
        runs[str(number)] = sinks.drain(stream, paths, state_partitions=2)
    late = windows.late_rows(progress.progress_table(spark, runs)).collect()
    # 09:00 and 09:01 came after 10:10 - 30 min had passed their window; 09:01 came twice
    assert {r["label"]: (r["input_rows"], r["late_rows"]) for r in late} == {"0": (3, 0), "1": (4, 1), "2": (3, 2)}
    assert sorted(r["v"] for r in sinks.read_sink(spark, paths).collect()) == [1, 2, 4, 8, 64]
    whole = progress.progress_summary(progress.stored_reports(spark, paths.reports, "x")).first()
    assert (whole["input_rows"], whole["dropped_partial_groups"], whole["state_partitions"]) == (10, 3, 2)


@pytest.mark.parametrize("store", ["rocksdb", "memory"])
def test_open_windows_are_read_back_from_the_state(spark, landing, paths, store):
    for batch in BATCHES:
        streams.land_files(rows(spark, *batch), landing, 1, "json", "append")
        sinks.drain(counts(streams.json_stream(spark, landing, SCHEMA), "30 minutes"), paths, state_partitions=3, state_store=store)
    held = state.open_windows(spark, paths, by=["kind"], measures={"n": F.col("b0"), "v": F.col("b1")})
    assert sorted((r["window_start"].strftime("%H:%M"), r["kind"], r["n"], r["v"]) for r in held.collect()) == [
        ("11:45", "b", 1, 64)]
    assert [r["numPartitions"] for r in state.stores(spark, paths).collect()] == [3]
    first = state.entries(spark, paths, batch=0).count()
    assert first == 2  # 10:00 and 10:10, before anything was closed


def test_starting_a_stream_leaves_the_session_as_it_was(spark, landing, paths):
    names = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass",
             "spark.sql.streaming.numRecentProgressUpdates"]
    before = [spark.conf.get(n) for n in names]
    streams.land_files(rows(spark, *BATCHES[0]), landing, 1, "json")
    drain(spark, landing, paths)
    assert [spark.conf.get(n) for n in names] == before


def test_newest_file_first(spark, landing, paths):
    import os
    import time

    for i, at in enumerate(("10:00", "11:00", "12:00")):
        streams.land_files(rows(spark, (at, "a", i)), landing, 1, "json", "append")
        new = [f for f in os.scandir(landing) if f.name.endswith(".json") and time.time() - f.stat().st_mtime < 60]
        for f in new:
            if open(f.path).read().find(f'"v":{i}') >= 0:
                os.utime(f.path, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    stream = streams.json_stream(spark, landing, SCHEMA, files_per_trigger=1, newest_first=True)
    query = sinks.drain(stream, paths)
    reports = progress.progress_table(spark, {"x": query}).filter("numInputRows > 0")
    assert reports.count() == 3
    log = [json.loads(line) for line in open(f"{paths.data}/_spark_metadata/0").read().splitlines()[1:]]
    first = spark.read.parquet(*[entry["path"] for entry in log])
    assert [r["v"] for r in first.collect()] == [2]


def test_landing_width_follows_the_bytes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert streams.landing_width(spark, path, least=5) == 5
    assert streams.landing_width(spark, path, most_bytes=50_000) == -(-size * streams.TEXT_FACTOR // 50_000)


def test_on_time_rows_in_batch_equal_the_stream(spark, landing, paths):
    events = rows(spark, *[(f"{h:02d}:{m:02d}", k, h * m) for h in range(8, 11) for m in range(0, 60, 7) for k in "ab"])
    streams.land_files(events, landing, 3, "json")
    drain(spark, landing, paths)
    expected = windows.closed_windows(counts(events), events, time="ts", delay="30 minutes")
    assert sorted(sinks.read_sink(spark, paths).collect()) == sorted(expected.collect())


def test_resume_adds_no_duplicates(spark, landing, paths):
    first, second = rows(spark, *BATCHES[0]), rows(spark, ("11:00", "a", 1), ("12:00", "a", 1))
    streams.land_files(first, landing, 1, "json", "append")
    drain(spark, landing, paths)
    drain(spark, landing, paths)  # nothing new
    streams.land_files(second, landing, 1, "json", "append")
    drain(spark, landing, paths)
    both = first.unionByName(second)
    expected = windows.closed_windows(counts(both), both, time="ts", delay="30 minutes")
    assert sorted(sinks.read_sink(spark, paths).collect()) == sorted(expected.collect())


def test_used_sink_under_a_fresh_checkpoint_is_refused(spark, landing, paths, tmp_path):
    streams.land_files(rows(spark, *BATCHES[0]), landing, 1, "json")
    drain(spark, landing, paths)
    with pytest.raises(ValueError):
        drain(spark, landing, sinks.SinkPaths(paths.data, str(tmp_path / "other")))


def test_windows_are_half_open_and_close_at_the_horizon(spark):
    events = rows(spark, ("10:00", "a", 1), ("10:05", "a", 2), ("10:40", "a", 4))
    got = {r["window_start"].strftime("%H:%M"): r["v"] for r in counts(events).collect()}
    assert got == {"10:00": 1, "10:05": 2, "10:40": 4}
    closed = windows.closed_windows(counts(events), events, time="ts", delay="30 minutes")
    # the horizon is 10:10, exactly the end of the second window
    assert sorted(r["window_start"].strftime("%H:%M") for r in closed.collect()) == ["10:00", "10:05"]


def test_csv_stream_with_rate_limit_and_continuous_trigger(spark, landing, paths):
    events = rows(spark, *[("10:%02d" % m, "a", m) for m in range(40)])
    streams.land_files(events, landing, 4, "csv")
    stream = streams.csv_stream(spark, landing, SCHEMA, files_per_trigger=1)
    query = sinks.start_append(stream, paths, every="100 milliseconds")
    query.processAllAvailable()
    sinks.run_for(query, 1, paths)
    assert sorted(sinks.read_sink(spark, paths).collect()) == sorted(events.collect())
    assert not query.isActive
    summary = progress.progress_summary(progress.progress_table(spark, {"x": query})).first()
    assert summary["input_rows"] == 40 and summary["batches_sampled"] == 4 and summary["avg_input_rows"] == 10.0


def test_summary_reads_state_and_skips_idle_batches(spark, landing, paths):
    for batch in BATCHES:
        streams.land_files(rows(spark, *batch), landing, 1, "json", "append")
    query = drain(spark, landing, paths)
    summary = progress.progress_summary(progress.progress_table(spark, {"x": query})).first()
    assert summary["input_rows"] == 7 and summary["batches_sampled"] == 1
    assert summary["max_state_rows"] > 0 and summary["avg_trigger_exec_ms"] > 0


def test_microseconds_survive_the_landing(spark, landing):
    one = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 0, 0, 7, 179575), "a", 1)], SCHEMA)
    for fmt in ("json", "csv"):
        streams.land_files(one, f"{landing}_{fmt}", 1, fmt)
        reader = spark.read.schema(SCHEMA)
        back = reader.json(f"{landing}_json") if fmt == "json" else reader.option("header", True).csv(f"{landing}_csv")
        assert back.first()["ts"] == one.first()["ts"]




def test_summary_of_150_batches(spark, landing, paths):
    streams.land_files(spark.range(1500).select(F.col("id").cast("string").alias("kind")), landing, 150, "json")
    query = sinks.drain(streams.json_stream(spark, landing, "kind string", files_per_trigger=1), paths)
    summary = progress.progress_summary(progress.progress_table(spark, {"x": query})).first()
    assert (summary["batches_sampled"], summary["input_rows"], summary["avg_input_rows"]) == (150, 1500, 10)
