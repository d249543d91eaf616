"""Queries over event windows, in batch and through file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rondel.operators import aggregates
from rondel.plans import match_results as matches
from rondel.plans.registry import query
from rondel.plans.standins import EVENTS_SQL, PLAYS_SQL, match_events, plays, table
from rondel.session import scratch_path
from rondel.sources import files, streams
from rondel.streaming import progress, sinks, state, windows

_WIDTH, _DELAY = "2 minutes", "30 seconds"


def _bucket(width: str, time: str = "event_timestamp") -> str:
    return f"time_bucket(INTERVAL '{width}', {time}, TIMESTAMP '1970-01-01')"


def _windowed_sql(width: str) -> str:
    return f"""
        SELECT {_bucket(width)} AS window_start, {_bucket(width)} + INTERVAL '{width}' AS window_end, map,
               count(*) AS map_plays, avg(result_1) AS avg_rounds_team1, avg(result_2) AS avg_rounds_team2,
               count(*) FILTER (WHERE map_winner = 1) AS team1_wins,
               count(*) FILTER (WHERE map_winner = 2) AS team2_wins, avg(abs(rank_1 - rank_2)) AS avg_rank_diff
        FROM {EVENTS_SQL} GROUP BY ALL"""


def _closed_sql(width: str, delay: str) -> str:
    return f"""
        SELECT * FROM ({_windowed_sql(width)}) AS w
        WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '{delay}'"""


@query("tumbling_agg", _windowed_sql(_WIDTH))
def tumbling_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.windowed_plays(match_events(spark, sf_dir), _WIDTH, None, digits=None)


_FIVE_MINUTES_SQL = f"""
    SELECT {_bucket("5 minutes")} AS window_start, {_bucket("5 minutes")} + INTERVAL '5 minutes' AS window_end, _map,
           count(*) AS match_count, avg(score_diff) AS avg_score_diff, avg(rank_1) AS avg_rank
    FROM {EVENTS_SQL} GROUP BY ALL"""


@query("tumbling_agg_5min", _FIVE_MINUTES_SQL)
def tumbling_agg_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.windowed_matches(match_events(spark, sf_dir), delay=None)


@query("tumbling_agg_daily", f"""
    SELECT CAST(date AS TIMESTAMP) AS window_start, CAST(date AS TIMESTAMP) + INTERVAL '1 day' AS window_end, _map,
           count(*) AS match_count, avg(result_1) AS avg_result_1
    FROM {PLAYS_SQL} GROUP BY ALL
""")
def tumbling_agg_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = plays(spark, sf_dir).withColumn("date", F.col("date").cast("timestamp_ntz"))
    return matches.windowed_daily(dated, delay=None)


# ---- analysis of closed windows --------------------------------------------------------------

def _closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = match_events(spark, sf_dir)
    windowed = matches.windowed_plays(events, _WIDTH, None, digits=None)
    return windows.closed_windows(windowed, events, time="event_timestamp", delay=_DELAY)


@query("closed_windows", _closed_sql(_WIDTH, _DELAY))
def closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed(spark, sf_dir)


@query("sink_top_groups", f"""
    SELECT map, CAST(sum(map_plays) AS BIGINT) AS total_plays FROM ({_closed_sql(_WIDTH, _DELAY)}) AS c GROUP BY map
""")
def sink_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.top_groups(_emitted(spark, sf_dir), by="map", amount="map_plays", name="total_plays")


@query("sink_avg_by_group", f"""
    SELECT map, round(avg(avg_rounds_team1), 6) AS avg_r1, round(avg(avg_rounds_team2), 6) AS avg_r2
    FROM ({_closed_sql(_WIDTH, _DELAY)}) AS c GROUP BY map
""")
def sink_avg_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.avg_by_group(
        _emitted(spark, sf_dir), by="map", means={"avg_r1": "avg_rounds_team1", "avg_r2": "avg_rounds_team2"}, digits=6)


@query("sink_weighted_avg_by_group", f"""
    SELECT map, round(sum(avg_rounds_team1 * map_plays) / sum(map_plays), 6) AS avg_r1,
           round(sum(avg_rounds_team2 * map_plays) / sum(map_plays), 6) AS avg_r2
    FROM ({_closed_sql(_WIDTH, _DELAY)}) AS c GROUP BY map
""")
def sink_weighted_avg_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.avg_by_group(
        _emitted(spark, sf_dir), by="map", weight="map_plays", digits=6,
        means={"avg_r1": "avg_rounds_team1", "avg_r2": "avg_rounds_team2"})


@query("win_rate_by_group", f"""
    SELECT map, CAST(sum(team1_wins) AS BIGINT) AS first_wins, CAST(sum(team2_wins) AS BIGINT) AS second_wins,
           CAST(sum(team1_wins) AS DOUBLE) / CAST(sum(team1_wins) + sum(team2_wins) AS DOUBLE) AS first_win_rate
    FROM ({_closed_sql(_WIDTH, _DELAY)}) AS c GROUP BY map
""")
def win_rate_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.win_rate_by_group(
        _emitted(spark, sf_dir), by="map", first="team1_wins", second="team2_wins", digits=None)


# ---- file streams ----------------------------------------------------------------------------

_EVENT_ROW = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
_ALL_EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _zoned(df: DataFrame, time: str) -> DataFrame:
    """A watermark needs a zoned timestamp; the test tables have none."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def _unzoned(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


def _landed_events(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    path = scratch_path(spark, f"landing_{fmt}")
    streams.land_files(_zoned(table(spark, sf_dir, "events"), "ts"), path, _landing_width(spark, sf_dir), fmt)
    return path


def _landing_width(spark: SparkSession, sf_dir: str) -> int:
    """Five files or more, so that a rate limit shows; from a size on, as many as the bytes of the events ask for."""
    return streams.landing_width(spark, f"{sf_dir}/events.parquet", least=5)


# State is a few counters per open window and group, whatever the number of events.
_STATE_STORES = 4


def _drain(spark: SparkSession, stream: DataFrame, paths: sinks.SinkPaths, stores: int = _STATE_STORES):
    return sinks.drain(stream, paths, state_partitions=stores)


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    paths = sinks.SinkPaths.under(scratch_path(spark, "stream"))
    _drain(spark, stream, paths)
    return sinks.read_sink(spark, paths)


@query("landing_replay", _ALL_EVENTS_SQL)
def landing_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unzoned(files.read_csv_typed(spark, _landed_events(spark, sf_dir, "csv"), _EVENT_ROW), "ts")


@query("stream_json_source", _ALL_EVENTS_SQL)
def stream_json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streams.json_stream(spark, _landed_events(spark, sf_dir, "json"), _EVENT_ROW, files_per_trigger=2)
    return _unzoned(_drained(spark, stream), "ts")


@query("stream_csv_source", _ALL_EVENTS_SQL)
def stream_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streams.csv_stream(spark, _landed_events(spark, sf_dir, "csv"), _EVENT_ROW, files_per_trigger=2)
    return _unzoned(_drained(spark, stream), "ts")


# The lab stream's fields that the test events can fill.
_PLAY_ROW = "event_id bigint, event_timestamp timestamp, map string, _map string, result_1 int, result_2 int, " \
            "score_diff int, map_winner int, rank_1 int, rank_2 int"


def _land_plays(spark: SparkSession, sf_dir: str, events: DataFrame, path: str, mode: str = "overwrite") -> None:
    streams.land_files(_zoned(events, "event_timestamp"), path, _landing_width(spark, sf_dir), "json", mode)


def _emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream has written to its sink: the windows that the watermark closed."""
    landing = scratch_path(spark, "landing_plays")
    _land_plays(spark, sf_dir, match_events(spark, sf_dir), landing)
    stream = streams.json_stream(spark, landing, _PLAY_ROW)
    return _drained(spark, matches.windowed_plays(stream, _WIDTH, _DELAY, digits=None))


@query("stream_parquet_sink", _closed_sql(_WIDTH, _DELAY))
def stream_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unzoned(_emitted(spark, sf_dir), "window_start", "window_end")


@query("stream_sink_readback", f"""
    SELECT * FROM ({_FIVE_MINUTES_SQL}) AS w
    WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'
    ORDER BY window_start, _map
""")
def stream_sink_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing_plays")
    _land_plays(spark, sf_dir, match_events(spark, sf_dir), landing)
    emitted = _drained(spark, matches.windowed_matches(streams.json_stream(spark, landing, _PLAY_ROW)))
    return _unzoned(emitted, "window_start", "window_end").orderBy("window_start", "_map")


@query("stream_resume", _closed_sql(_WIDTH, _DELAY))
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one checkpoint: the second one picks up only what landed after the first."""
    landing, paths = scratch_path(spark, "landing_plays"), sinks.SinkPaths.under(scratch_path(spark, "stream"))
    events = match_events(spark, sf_dir)
    early = F.col("event_timestamp") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part, mode in ((events.filter(early), "overwrite"), (events.filter(~early), "append")):
        _land_plays(spark, sf_dir, part, landing, mode)
        stream = streams.json_stream(spark, landing, _PLAY_ROW)
        _drain(spark, matches.windowed_plays(stream, _WIDTH, _DELAY, digits=None), paths)
    return _unzoned(sinks.read_sink(spark, paths), "window_start", "window_end")


@query("stream_open_windows", f"""
    SELECT * FROM (SELECT {_bucket("1 day")} AS window_start, {_bucket("1 day")} + INTERVAL '1 day' AS window_end, _map,
                          count(*) AS match_count, avg(score_diff) AS avg_score_diff, avg(rank_1) AS avg_rank
                   FROM {EVENTS_SQL} GROUP BY ALL) AS w
    WHERE window_end > (SELECT max(ts) FROM events) - INTERVAL '10 days'
""")
def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a drained stream still holds, read back from its state stores."""
    landing, paths = scratch_path(spark, "landing_plays"), sinks.SinkPaths.under(scratch_path(spark, "stream"))
    _land_plays(spark, sf_dir, match_events(spark, sf_dir), landing)
    _drain(spark, matches.windowed_matches(streams.json_stream(spark, landing, _PLAY_ROW), "1 day", "10 days"), paths)
    held = state.open_windows(spark, paths, by=["_map"], measures={
        "match_count": F.col("b0"), "avg_score_diff": F.col("b1") / F.col("b2"), "avg_rank": F.col("b3") / F.col("b4")})
    return _unzoned(held, "window_start", "window_end")


# Rows land in a few arrivals, by a number in their properties; those without one come first.
_ARRIVAL_SQL = f"""
    arrived AS (SELECT *, coalesce(CAST(floor(rank_2 / 25) AS BIGINT), -1) AS batch FROM {EVENTS_SQL}),
    newest AS (SELECT batch, max(event_timestamp) AS newest FROM arrived GROUP BY batch),
    horizon AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                              - INTERVAL '10 days' AS horizon FROM newest),
    marked AS (SELECT batch, coalesce({_bucket("5 minutes")} + INTERVAL '5 minutes' <= horizon, FALSE) AS late
               FROM arrived JOIN horizon USING (batch)),
    late AS (SELECT batch, count(*) AS input_rows, count(*) FILTER (WHERE NOT late) AS on_time_rows,
                    count(*) FILTER (WHERE late) AS late_rows FROM marked GROUP BY batch)"""


def _arrivals(spark: SparkSession, sf_dir: str) -> tuple[dict, sinks.SinkPaths]:
    """One drain per arrival over one checkpoint, each starting from the watermark of the earlier ones."""
    arrived = match_events(spark, sf_dir).withColumn("batch", F.coalesce(F.floor(F.col("rank_2") / 25), F.lit(-1)))
    numbers = sorted(r[0] for r in arrived.select("batch").distinct().collect())  # one per landing, not per event
    landing, paths = scratch_path(spark, "landing_arrivals"), sinks.SinkPaths.under(scratch_path(spark, "stream"))
    runs = {}
    for number in numbers:
        part = arrived.filter(F.col("batch") == number).drop("batch")
        _land_plays(spark, sf_dir, part, landing, "append")
        stream = windows.once_on_time(streams.json_stream(spark, landing, _PLAY_ROW), key="event_id",
                                      time="event_timestamp", width="5 minutes", delay="10 days")
        runs[str(number)] = _drain(spark, stream, paths)
    return runs, paths


@query("late_rows", f"WITH {_ARRIVAL_SQL} SELECT batch, input_rows, on_time_rows, late_rows FROM late")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted by the running stream: an observation of its input and its state operator's dropped rows."""
    runs, _ = _arrivals(spark, sf_dir)
    return windows.late_rows(progress.progress_table(spark, runs)).select(
        F.col("label").cast("bigint").alias("batch"), "input_rows", "on_time_rows", "late_rows")


@query("stream_progress_summary", f"""
    WITH {_ARRIVAL_SQL}
    SELECT 'arrivals' AS label, count(*) AS batches_sampled, CAST(sum(input_rows) AS BIGINT) AS input_rows,
           avg(input_rows) AS avg_input_rows, CAST(sum(late_rows) AS BIGINT) AS dropped_partial_groups,
           CAST({_STATE_STORES} AS BIGINT) AS state_partitions
    FROM late
""")
def stream_progress_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reproducible part of the summary; rates and times differ between runs."""
    _, paths = _arrivals(spark, sf_dir)
    summary = progress.progress_summary(progress.stored_reports(spark, paths.reports, "arrivals"))
    return summary.select("label", "batches_sampled", "input_rows", "avg_input_rows", "dropped_partial_groups",
                          "state_partitions")


# Files per batch, state stores and trigger of two runs over the same landing files.
_TUNING = {"baseline": (2, 4, "2 seconds"), "optimized": (5, 2, "1 second")}
_TUNING_SQL = ", ".join(f"('{label}', {stores})" for label, (_, stores, _) in _TUNING.items())


@query("stream_tuning_compare", f"""
    WITH c AS (SELECT count(*) AS windows, CAST(sum(map_plays) AS BIGINT) AS map_plays FROM ({_closed_sql("1 hour", "10 days")}) AS w)
    SELECT label, CAST(stores AS BIGINT) AS state_partitions, (SELECT count(*) FROM events) AS input_rows, windows, map_plays,
           CAST(0 AS BIGINT) AS rows_only_here
    FROM (VALUES {_TUNING_SQL}) AS t(label, stores), c
""")
def stream_tuning_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two settings of one stream: what each wrote, and the rows that the other one did not. Times are left out as they vary."""
    landing = scratch_path(spark, "landing_plays")
    # The delay is longer than a slice, so no setting makes a row late.
    streams.land_in_order(_zoned(match_events(spark, sf_dir), "event_timestamp"), landing, "event_timestamp", 5,
                          _landing_width(spark, sf_dir))
    reports, written = {}, {}
    for label, (limit, stores, every) in _TUNING.items():
        paths = sinks.SinkPaths.under(scratch_path(spark, "stream"))

        def stream() -> DataFrame:
            source = streams.json_stream(spark, landing, _PLAY_ROW, files_per_trigger=limit)
            return matches.windowed_plays(source, "1 hour", "10 days", digits=None)

        sinks.run_triggered(stream(), paths, every, state_partitions=stores)
        _drain(spark, stream(), paths, stores)
        reports[label] = progress.progress_summary(progress.stored_reports(spark, paths.reports, label))
        written[label] = sinks.read_sink(spark, paths)
    parts = []
    for label, other in zip(written, reversed(written)):
        totals = written[label].agg(F.count("*").alias("windows"), F.sum("map_plays").alias("map_plays"))
        missing = written[label].exceptAll(written[other]).agg(F.count("*").alias("rows_only_here"))
        parts.append(reports[label].select("label", "state_partitions", "input_rows").crossJoin(totals).crossJoin(missing))
    return parts[0].unionByName(parts[1])
