"""The match-results data set from raw CSV to its analysis tables, built from the operators.

Each function is one table. ``build_all`` writes every table below one root and returns the
metric log; run it with a raw CSV whose columns follow ``RESULT_SCHEMA``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rondel.functions.conditions import count_where, gap
from rondel.operators import aggregates, clustering, curation, evidence, graph, quality, text_index
from rondel.session import cut_lineage
from rondel.sources import files, layout, streams
from rondel.streaming import progress, sinks, windows

# Columns of a raw result file, in file order, with their silver types.
RESULT_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("team_1", T.StringType()),
    T.StructField("team_2", T.StringType()),
    T.StructField("_map", T.StringType()),
    T.StructField("result_1", T.IntegerType()),
    T.StructField("result_2", T.IntegerType()),
    T.StructField("map_winner", T.IntegerType()),
    T.StructField("starting_ct", T.IntegerType()),
    T.StructField("ct_1", T.IntegerType()),
    T.StructField("t_2", T.IntegerType()),
    T.StructField("t_1", T.IntegerType()),
    T.StructField("ct_2", T.IntegerType()),
    T.StructField("event_id", T.IntegerType()),
    T.StructField("match_id", T.LongType()),
    T.StructField("rank_1", T.IntegerType()),
    T.StructField("rank_2", T.IntegerType()),
    T.StructField("map_wins_1", T.IntegerType()),
    T.StructField("map_wins_2", T.IntegerType()),
    T.StructField("match_winner", T.IntegerType()),
])

# Rows of the JSON event stream.
EVENT_SCHEMA = """
    event_timestamp timestamp, date string, team_1 string, team_2 string, map string, result_1 int,
    result_2 int, map_winner int, rank_1 int, rank_2 int, event_id int, match_id int
"""

# Rows of the CSV landing stream.
LANDING_SCHEMA = """
    match_id bigint, event_timestamp timestamp, _map string, score_diff int, rank_1 int, rank_2 int, year int
"""

# Contract, layout, feature and objective settings.
DATE_PATTERNS = {"date": "yyyy-MM-dd"}
REQUIRED = ("date", "team_1", "team_2", "_map", "match_id")
NATURAL_KEY = ("match_id", "_map")
MEASURES = ("result_1", "result_2")
PARTITION_BY = ("year", "month")
SORT_BY = ("date", "match_id")
FEATURES = ("win_rate", "avg_rank", "avg_score_diff", "avg_score", "maps_variety")
CLUSTER_COUNTS = (3, 5, 8, 12)
SEEDS = (42, 123, 456)
MIN_MAPS_PLAYED = 5
MIN_TEXT_LENGTH = 100
QUERY_TERMS = ("natus", "fnatic", "mirage", "dust2", "inferno")
TEXT_SOURCE, TEXT_VERSION = "HLTV_CSGO", "v1.0"
OBJECTIVES = {
    "best_silhouette": ("min", 0.25),
    "parquet_to_csv": ("max", 0.6),
    "pass_ratio": ("min", 0.80),
    "avg_processed_rows_s": ("min", 100.0),
    "lookup_ms": ("max", 2_000.0),
    "full_run_ms": ("max", 600_000.0),
}


def first_won():
    return F.col("map_winner") == 1


def silver(raw: DataFrame) -> DataFrame:
    """Typed, complete rows, one per match and map, with calendar parts and score gap."""
    return quality.silver_clean(
        raw, RESULT_SCHEMA, required=REQUIRED, natural_key=NATURAL_KEY, measures=MEASURES,
        patterns=DATE_PATTERNS,
        derived={
            "year": F.year("date"),
            "month": F.month("date"),
            "score_diff": gap(F.col("result_1"), F.col("result_2")),
        },
    )


def silver_contract(raw: DataFrame) -> DataFrame:
    return quality.contract_report(raw, silver_rules())


def silver_rules() -> dict[str, Column]:
    """The contract of a raw row: whatever removes a row from ``silver`` breaks one of these rules."""
    return quality.parse_rules(RESULT_SCHEMA, DATE_PATTERNS, (*REQUIRED, *MEASURES))


def silver_balance(raw: DataFrame) -> DataFrame:
    return quality.silver_balance(raw, RESULT_SCHEMA, required=REQUIRED, natural_key=NATURAL_KEY, measures=MEASURES,
                                  patterns=DATE_PATTERNS)


def team_stats(clean: DataFrame) -> DataFrame:
    return aggregates.entity_period_stats(
        clean, entity="team_1", period=["year"], won=first_won(), entity_name="team_name",
        means={"avg_rank": "rank_1", "avg_score_diff": "score_diff", "avg_score": "result_1"},
    ).withColumnsRenamed({"played": "maps_played", "won": "maps_won"})


def map_stats(clean: DataFrame) -> DataFrame:
    return aggregates.category_month_stats(
        clean, keys=["_map", "year", "month"], distinct={"events_count": "event_id"},
        means={"avg_score_t1": "result_1", "avg_score_t2": "result_2", "avg_score_diff": "score_diff"},
    ).withColumnRenamed("played", "matches_played")


def match_results(clean: DataFrame) -> DataFrame:
    return aggregates.outcome_enrich(
        clean, first_won=first_won(),
        pairs={"name": ("team_1", "team_2"), "score": ("result_1", "result_2")},
        keep=["match_id", "_map", "date", "year", "month", "team_1", "team_2", "result_1", "result_2",
              "rank_1", "rank_2", "score_diff", "event_id"],
    )


def landing_rows(clean: DataFrame) -> DataFrame:
    """Silver rows as stream events; the event time is midnight of the match day."""
    return clean.select("match_id", F.col("date").cast("timestamp").alias("event_timestamp"), "_map",
                        "score_diff", "rank_1", "rank_2", "year")


def windowed_plays(events: DataFrame, width: str = "2 minutes", delay: str | None = "30 seconds",
                   digits: int | None = 2) -> DataFrame:
    """Window x map with plays, mean rounds, wins of both sides and mean rank gap."""
    return windows.tumbling_agg(
        events, time="event_timestamp", width=width, by=["map"], delay=delay,
        measures=[
            F.count("*").alias("map_plays"),
            *aggregates.averages({"avg_rounds_team1": "result_1", "avg_rounds_team2": "result_2"}, digits),
            count_where(first_won()).alias("team1_wins"),
            count_where(F.col("map_winner") == 2).alias("team2_wins"),
            *aggregates.averages({"avg_rank_diff": gap(F.col("rank_1"), F.col("rank_2"))}, digits),
        ],
    )


def windowed_matches(events: DataFrame, width: str = "5 minutes", delay: str | None = "10 minutes") -> DataFrame:
    """Window x map with match count, mean score gap and mean rank."""
    return windows.tumbling_agg(
        events, time="event_timestamp", width=width, by=["_map"], delay=delay,
        measures=[F.count("*").alias("match_count"),
                  *aggregates.averages({"avg_score_diff": "score_diff", "avg_rank": "rank_1"})],
    )


def windowed_daily(results: DataFrame, delay: str | None = "2 days") -> DataFrame:
    """Day x map with match count and mean rounds of side 1, on ``date`` as event time."""
    return windows.tumbling_agg(
        results, time="date", width="1 day", by=["_map"], delay=delay,
        measures=[F.count("*").alias("match_count"), F.avg("result_1").alias("avg_result_1")],
    )


def lab_corpus(results: DataFrame, key: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """One document per ``key`` from team and map names; a match has several maps, so both are the default."""
    return text_index.corpus_build(
        results, id_parts=key, text_parts=["team_1", "team_2", "_map"],
        required=["match_id", "team_1", "team_2", "_map"],
    )


def corpus(clean: DataFrame) -> DataFrame:
    """One document per match and map from names and scores, with its origin columns."""
    return text_index.corpus_build(
        clean, id_parts=NATURAL_KEY, text_parts=["team_1", "team_2", "_map", "result_1", "result_2"],
        required=list(NATURAL_KEY), keep=["date", "_map", "team_1", "team_2"],
    )


def term_index(docs: DataFrame, rule: str = "alnum", width: int = text_index.BLOCK_WIDTH) -> DataFrame:
    """Posting blocks; distinct documents under ``alnum``, one entry per occurrence under ``nonword``.

    Counts the documents to size the blocks: pass a stored corpus, where that reads file footers only.
    """
    block = text_index.hash_block("doc_id", text_index.blocks_for(docs.count(), width))
    return text_index.inverted_index(text_index.tokenize(docs, rule=rule), block=block, distinct=rule == "alnum")


def team_graph(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Teams as vertices, matches between two teams as weighted edges."""
    pairs = cut_lineage(graph.graph_pairs(results, "team_1", "team_2"))
    vertices = graph.graph_vertices(pairs)
    return vertices, graph.graph_edges(pairs, vertices)


def team_features(clean: DataFrame, min_support: int = MIN_MAPS_PLAYED) -> DataFrame:
    return clustering.entity_features(
        clean, entity="team_1", won=first_won(), min_support=min_support, entity_name="team_name",
        means={"avg_rank": "rank_1", "avg_score_diff": "score_diff", "avg_score": "result_1"},
        distinct={"maps_variety": "_map", "events_played": "event_id"},
    ).withColumnRenamed("played", "maps_played")


# The wording of the rendered sentence.
def _sentence() -> list:
    return [
        "On", F.col("date"), "in CS:GO event", F.col("event_id"), ",", F.col("winner_team"), "defeated",
        F.col("loser_team"), "on", F.col("_map"), "with a score of", F.col("winner_score"), "to",
        F.col("loser_score"), ". Team 1 world ranking:", F.col("rank_1"), ", Team 2 world ranking:",
        F.col("rank_2"), ".",
    ]


_ABOUT = ("doc_id", "date", "_map", "winner_team", "loser_team", "event_id")


def _outcomes(clean: DataFrame) -> DataFrame:
    """What a sentence is made of, and what it is about."""
    resolved = aggregates.outcome_enrich(
        clean, first_won=first_won(), pairs={"team": ("team_1", "team_2"), "score": ("result_1", "result_2")})
    key = F.concat(F.col("match_id").cast("string"), F.lit("_"), F.col("_map"))
    return resolved.withColumn("doc_id", key).select(*_ABOUT, "winner_score", "loser_score", "rank_1", "rank_2")


def _told(outcomes: DataFrame) -> DataFrame:
    rendered = curation.render_narrative(outcomes, _sentence(), keep=_ABOUT)
    return curation.with_provenance(rendered, source=TEXT_SOURCE, version=TEXT_VERSION)


def narratives(clean: DataFrame) -> DataFrame:
    """One sentence per row about the outcome, with provenance."""
    return _told(_outcomes(clean))


_CURATED = ("doc_id", "text", "source", "version", "curated_at", "content_hash", "date", "_map",
            "winner_team", "loser_team", "event_id")


def curated(texts: DataFrame) -> DataFrame:
    return curation.curate_text(texts, min_length=MIN_TEXT_LENGTH).select(*_CURATED)


def curated_narratives(clean: DataFrame) -> DataFrame:
    """``curated(narratives(clean))`` without storing the sentences: they are rendered for their hash, and again where they are kept."""
    kept = curation.curate_rendered(_outcomes(clean), curation.sentence(_sentence()), min_length=MIN_TEXT_LENGTH)
    return _told(kept).select(*_CURATED)


def text_card(texts: DataFrame) -> DataFrame:
    """Profile of the curated sentences; its columns and types come from the table itself."""
    return curation.dataset_card(
        texts, name="Outcome sentences", source=TEXT_SOURCE, version=TEXT_VERSION,
        intended_use="one sentence per played map, as input for training or search",
        filters=[f"at least {MIN_TEXT_LENGTH} characters", "each different text once"])


class _Stages:
    """Runs the stages of a build and keeps how long each took."""

    def __init__(self):
        self.started = self.last = time.monotonic()
        self.elapsed_ms: dict[str, float] = {}

    def done(self, task: str) -> None:
        now = time.monotonic()
        self.elapsed_ms[task] = (now - self.last) * 1000
        self.last = now

    def total_ms(self) -> float:
        return (time.monotonic() - self.started) * 1000


def build_all(spark: SparkSession, raw_csv: str, root: str, *, ks: Sequence[int] = CLUSTER_COUNTS,
              seeds: Sequence[int] = SEEDS, min_support: int = MIN_MAPS_PLAYED, files_in_landing: int | None = None) -> DataFrame:
    """Write every layer below ``root``; each later table reads the stored earlier one.

    The log holds the metrics with the time their stage took; ``objectives`` judges those of this run.
    """
    gold, stages = f"{root}/gold", _Stages()
    raw = files.land_raw(spark, raw_csv, f"{root}/bronze")
    stages.done("bronze_landing")
    silver(raw).write.mode("overwrite").parquet(f"{root}/silver")
    stages.done("silver_cleaning")
    clean = spark.read.parquet(f"{root}/silver")

    layout.write_partitioned(team_stats(clean), f"{gold}/team_stats", ["year"])
    stages.done("team_stats")
    layout.write_partitioned(map_stats(clean), f"{gold}/map_stats", PARTITION_BY)
    stages.done("map_stats")
    match_results(clean).write.mode("overwrite").partitionBy(*PARTITION_BY).parquet(f"{gold}/match_results")
    stages.done("match_results")
    layout.compact(spark, f"{gold}/match_results", f"{gold}/match_results_compact", PARTITION_BY, SORT_BY)
    stages.done("compaction")

    width = files_in_landing or streams.landing_width(spark, f"{root}/silver", least=5)
    streams.land_files(landing_rows(clean), f"{root}/landing", width)
    landed = streams.csv_stream(spark, f"{root}/landing", LANDING_SCHEMA, files_per_trigger=1)
    run = sinks.SinkPaths.under(f"{root}/stream-{uuid.uuid4().hex}")
    query = sinks.drain(windowed_matches(landed), run)
    batches = progress.progress_summary(progress.progress_table(spark, {"baseline": query}))

    stages.done("window_agg")

    docs = corpus(clean)
    docs.write.mode("overwrite").parquet(f"{root}/corpus_parquet")
    files.write_csv(spark.read.parquet(f"{root}/corpus_parquet"), f"{root}/corpus_csv")
    stages.done("corpus")
    text_index.write_index(term_index(spark.read.parquet(f"{root}/corpus_parquet")), f"{root}/index")
    index = spark.read.parquet(f"{root}/index")
    stages.done("build_index")
    text_index.lookup_terms(spark, index, QUERY_TERMS).write.mode("overwrite").parquet(f"{root}/lookup")
    stages.done("lookup")
    footprint = layout.footprint_ratio(
        layout.layout_stats(spark, {"parquet": f"{root}/corpus_parquet", "csv": f"{root}/corpus_csv"}),
        "parquet", "csv").withColumnRenamed("ratio", "parquet_to_csv")
    stages.done("footprint")

    teams = team_features(clean, min_support)
    teams.write.mode("overwrite").parquet(f"{root}/features")
    vectors = clustering.scaled_vectors(spark.read.parquet(f"{root}/features"), FEATURES)
    fits = clustering.kmeans_sweep(vectors, ks, seeds)
    k = clustering.best_k(fits)
    stages.done("kmeans_sweep")
    model = clustering.save_and_reload(clustering.fit_kmeans(vectors, k, seeds[0]), f"{root}/models/kmeans_k{k}")
    model.transform(vectors).select(
        "team_name", "win_rate", "avg_rank", "maps_played", "avg_score_diff", "maps_variety", "prediction",
    ).write.mode("overwrite").parquet(f"{root}/clusters")
    layout.write_partitioned(spark.read.parquet(f"{root}/clusters"), f"{gold}/team_clusters", ["prediction"])

    clusters = spark.read.parquet(f"{root}/clusters")
    clustering.cluster_profile(clusters, cluster="prediction", means={
        "avg_win_rate": "win_rate", "avg_rank": "avg_rank", "avg_maps_played": "maps_played",
    }).write.mode("overwrite").parquet(f"{gold}/cluster_profile")
    stages.done("team_clusters")

    narratives(clean).write.mode("overwrite").parquet(f"{root}/narratives")
    texts = spark.read.parquet(f"{root}/narratives")
    curated(texts).write.mode("overwrite").parquet(f"{root}/curated")
    text_card(spark.read.parquet(f"{root}/curated")).write.mode("overwrite").json(f"{root}/data_card")

    stages.done("curate")

    row_count = lambda path: spark.read.parquet(path).agg(F.count("*").alias("row_count"))
    parts = [
        evidence.metric_rows(raw.agg(F.count("*").alias("row_count")), stage="ETL", task="bronze_landing", metrics=["row_count"]),
        evidence.metric_rows(row_count(f"{root}/silver"), stage="ETL", task="silver_cleaning", metrics=["row_count"]),
        *[evidence.metric_rows(row_count(f"{gold}/{t}"), stage="ETL", task=t, metrics=["row_count"])
          for t in ("team_stats", "map_stats", "match_results")],
        evidence.metric_rows(batches, stage="Streaming", task="window_agg",
                             metrics=["input_rows", "avg_processed_rows_s"]),
        evidence.metric_rows(text_index.term_stats(index).agg(F.count("*").alias("unique_terms")),
                             stage="Text", task="build_index", metrics=["unique_terms"]),
        evidence.metric_rows(footprint, stage="Text", task="footprint", metrics=["parquet_to_csv"]),
        evidence.metric_rows(spark.read.parquet(f"{root}/lookup"), stage="Text", task="lookup", metrics=["hits"], label="term"),
        evidence.metric_rows(layout.file_inventory(spark, f"{root}/index").agg(F.sum("bytes").alias("index_bytes")),
                             stage="Text", task="build_index", metrics=["index_bytes"]),
        evidence.metric_rows(clustering.sweep_summary(fits), stage="Iterative", task="kmeans_sweep",
                             metrics=["mean_silhouette"], label="k"),
        evidence.metric_rows(fits.groupBy("k").agg(F.avg("silhouette").alias("s")).agg(F.max("s").alias("best_silhouette")),
                             stage="Iterative", task="kmeans_sweep", metrics=["best_silhouette"]),
        evidence.metric_rows(curation.curation_quality(texts, min_length=MIN_TEXT_LENGTH), stage="Curation",
                             task="curate", metrics=["total_before", "total_after", "pass_ratio"]),
    ]
    for phase, table in (("before", "match_results"), ("after", "match_results_compact")):
        inventory = layout.file_inventory(spark, f"{gold}/{table}").agg(
            F.count("*").alias("file_count"), F.sum("bytes").alias("bytes"))
        parts.append(evidence.metric_rows(inventory, stage="ETL", task="compaction", phase=phase,
                                          metrics=["file_count", "bytes"]))
    took = spark.createDataFrame(
        [(stages.elapsed_ms["lookup"], stages.total_ms())], "lookup_ms double, full_run_ms double")
    parts.append(evidence.metric_rows(took, stage="Run", task="objectives", metrics=["lookup_ms", "full_run_ms"]))
    metrics = parts[0]
    for part in parts[1:]:
        metrics = metrics.unionByName(part)
    run = uuid.uuid4().hex
    evidence.append_metrics(evidence.log_rows(metrics, run_id=run, elapsed_ms=stages.elapsed_ms), f"{root}/metrics_log")
    log = spark.read.parquet(f"{root}/metrics_log")
    evidence.slo_check(spark, log, OBJECTIVES, run_id=run).write.mode("overwrite").parquet(f"{root}/objectives")
    return log
