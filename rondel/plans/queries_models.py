"""Queries over entity features and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rondel.operators import clustering
from rondel.plans import match_results as matches
from rondel.plans.registry import query
from rondel.plans.standins import PLAYS_SQL, plays
from rondel.session import cut_lineage, scratch_path
from rondel.sources import layout

_Z = [f"{c}_z" for c in matches.FEATURES]
# Centers in standardised feature space: weak, middling and strong entities.
_CENTERS = [
    (-1.0, 0.5, -0.5, -0.5, 0.0),
    (0.0, 0.0, 0.0, 0.0, 0.0),
    (1.0, -0.5, 0.5, 0.5, 0.0),
]

_FEATURES_SQL = f"""
    SELECT team_1 AS team_name, count(*) AS maps_played,
           avg(CASE WHEN map_winner = 1 THEN 1 ELSE 0 END) AS win_rate, avg(rank_1) AS avg_rank,
           avg(score_diff) AS avg_score_diff, avg(result_1) AS avg_score, count(DISTINCT _map) AS maps_variety,
           count(DISTINCT event_id) AS events_played
    FROM {PLAYS_SQL} GROUP BY team_1 HAVING count(*) >= {matches.MIN_MAPS_PLAYED}"""


@query("entity_features", _FEATURES_SQL)
def entity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.team_features(plays(spark, sf_dir))


def _z_sql() -> str:
    scaled = ", ".join(
        f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0) AS {c}_z"
        for c in matches.FEATURES)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in matches.FEATURES)
    return f"SELECT *, {scaled} FROM ({_FEATURES_SQL}) AS f WHERE {complete}"


def _standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = cut_lineage(matches.team_features(plays(spark, sf_dir)))  # read more than once below
    return clustering.standardize(features, matches.FEATURES)


@query("standardize", f"""
    SELECT team_name, {", ".join(f"round({z}, 9) AS {z}" for z in _Z)} FROM ({_z_sql()}) AS z
""")
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standardized(spark, sf_dir).select("team_name", *[F.round(z, 9).alias(z) for z in _Z])


def _distance_sql(center) -> str:
    return " + ".join(f"({z} - ({at})) * ({z} - ({at}))" for z, at in zip(_Z, center))


def _assigned_ctes() -> str:
    columns = ", ".join(f"{_distance_sql(c)} AS d{i}" for i, c in enumerate(_CENTERS))
    least = "least(d0, d1, d2)"
    return f"""
    z AS MATERIALIZED ({_z_sql()}),
    d AS (SELECT *, {columns} FROM z),
    a AS MATERIALIZED (SELECT *, {least} AS distance,
               CAST(CASE {least} WHEN d0 THEN 0 WHEN d1 THEN 1 ELSE 2 END AS INT) AS cluster FROM d)"""


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.assign_clusters(_standardized(spark, sf_dir), _Z, _CENTERS)


@query("assign_clusters", f"WITH {_assigned_ctes()} SELECT team_name, cluster, round(distance, 9) AS distance FROM a")
def assign_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir).select("team_name", "cluster", F.round("distance", 9).alias("distance"))


def _silhouette_sql() -> str:
    norm = " + ".join(f"{z} * {z}" for z in _Z)
    sums = ", ".join(f"sum({z}) AS s{i}" for i, z in enumerate(_Z))
    mean = f"({norm}) + q / n - 2 * ({' + '.join(f'a.{z} * s{i}' for i, z in enumerate(_Z))}) / n"
    return f"""
    WITH {_assigned_ctes()},
    c AS (SELECT cluster AS other, count(*) AS n, sum({norm}) AS q, {sums} FROM a GROUP BY cluster),
    m AS (SELECT team_name, cluster, other, n, {mean} AS mean FROM a CROSS JOIN c),
    b AS (SELECT team_name, cluster,
                 max(CASE WHEN other = cluster AND n > 1 THEN mean * n / (n - 1) END) AS inside,
                 min(CASE WHEN other <> cluster THEN mean END) AS outside
          FROM m GROUP BY team_name, cluster)
    SELECT cluster, count(*) AS n,
           round(avg(CASE WHEN inside IS NULL THEN 0 ELSE (outside - inside) / greatest(inside, outside) END), 9) AS silhouette
    FROM b GROUP BY cluster"""


@query("silhouette", _silhouette_sql())
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.silhouette(_assigned(spark, sf_dir), _Z).withColumn("silhouette", F.round("silhouette", 9))


@query("cluster_profile", f"""
    WITH {_assigned_ctes()}
    SELECT cluster, count(*) AS n, round(avg(win_rate), 6) AS avg_win_rate, round(avg(avg_rank), 6) AS avg_rank,
           round(avg(maps_played), 6) AS avg_maps_played
    FROM a GROUP BY cluster
""")
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_profile(
        _assigned(spark, sf_dir), cluster="cluster", digits=6,
        means={"avg_win_rate": "win_rate", "avg_rank": "avg_rank", "avg_maps_played": "maps_played"})


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = cut_lineage(matches.team_features(plays(spark, sf_dir)))
    return clustering.scaled_vectors(features, matches.FEATURES)


# The seeding of the model library has no SQL counterpart: scores and labels are rows only, what must hold of them has SQL.

def _sweep(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vectors = _vectors(spark, sf_dir)
    return vectors, clustering.kmeans_sweep(vectors, matches.CLUSTER_COUNTS, matches.SEEDS)


@query("kmeans_sweep")
def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.sweep_summary(_sweep(spark, sf_dir)[1])


@query("kmeans_selection", f"""
    SELECT k, CAST({len(matches.SEEDS)} AS BIGINT) AS fits, TRUE AS in_range, CAST(1 AS BIGINT) AS chosen
    FROM (VALUES {", ".join(f"({k})" for k in matches.CLUSTER_COUNTS)}) AS t(k)
""")
def kmeans_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of any sweep: every k was fitted with every seed, scores lie between -1 and 1, and one k is chosen."""
    summary = clustering.sweep_summary(_sweep(spark, sf_dir)[1])
    chosen = summary.agg(F.count_if("is_best")).scalar()
    return summary.select("k", "fits", F.col("mean_silhouette").between(-1, 1).alias("in_range"), chosen.alias("chosen"))


def _final(spark: SparkSession, sf_dir: str) -> tuple[clustering.KMeansModel, DataFrame]:
    """The stored model of the selected k, and its labelled entities as stored, partitioned by cluster."""
    vectors, fits = _sweep(spark, sf_dir)
    model = clustering.fit_kmeans(vectors, clustering.best_k(fits), matches.SEEDS[0])
    model = clustering.save_and_reload(model, scratch_path(spark, "kmeans"))
    path = scratch_path(spark, "team_clusters")
    layout.write_partitioned(model.transform(vectors), path, ["prediction"])
    return model, spark.read.parquet(path)


@query("kmeans_final")
def kmeans_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir)[1].select(
        "team_name", "win_rate", "avg_rank", "maps_played", "avg_score_diff", "maps_variety", "prediction")


@query("kmeans_final_check", f"""
    SELECT count(*) AS entities, CAST(0 AS BIGINT) AS off_center FROM ({_FEATURES_SQL}) AS f
    WHERE {" AND ".join(f"{c} IS NOT NULL" for c in matches.FEATURES)}
""")
def kmeans_final_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entity with all features is stored once, under the cluster whose center is nearest."""
    model, stored = _final(spark, sf_dir)
    return clustering.off_center(stored, model)
