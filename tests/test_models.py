import math

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from rondel.operators import clustering


@pytest.fixture
def plays(spark):
    rows = [(f"t{i}", 1 if j % (i + 2) == 0 else 2, None if i == 5 else j, j % 3)
            for i in range(6) for j in range(4 if i == 0 else 8)]
    return spark.createDataFrame(rows, "team string, won int, rank int, map int")


def features(plays):
    return clustering.entity_features(
        plays, entity="team", won=F.col("won") == 1, means={"avg_rank": "rank"}, distinct={"maps": "map"}, min_support=5)


def test_support_limit_and_null_feature(plays):
    rows = {r["entity"]: r for r in features(plays).collect()}
    assert set(rows) == {"t1", "t2", "t3", "t4", "t5"}
    assert rows["t1"]["win_rate"] == 3 / 8 and rows["t1"]["maps"] == 3 and rows["t5"]["avg_rank"] is None


def test_standardize_skips_incomplete_rows_and_uses_the_sample_deviation(plays):
    names = ["win_rate", "avg_rank", "maps"]
    scaled = clustering.standardize(features(plays), names)
    assert scaled.count() == 4
    stats = scaled.agg(F.avg("win_rate_z"), F.stddev_samp("win_rate_z"), F.max("maps_z")).first()
    assert stats[0] == pytest.approx(0) and stats[1] == pytest.approx(1) and stats[2] == 0.0
    vectors = clustering.scaled_vectors(features(plays), names)
    pairs = scaled.join(vectors, "entity").select("win_rate_z", "scaled_features").collect()
    assert len(pairs) == 4 and all(p[0] == pytest.approx(p[1][0]) for p in pairs)


POINTS = [(0.0, 0.0, 0), (0.0, 2.0, 0), (10.0, 0.0, 1), (10.0, 2.0, 1), (50.0, 50.0, 2)]


def test_silhouette_equals_the_pairwise_definition(spark):
    df = spark.createDataFrame(POINTS, "x double, y double, cluster int")

    def by_hand(i):
        d = lambda p, q: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2
        mean = lambda c: [d(POINTS[i], q) for j, q in enumerate(POINTS) if q[2] == c and j != i]
        own = mean(POINTS[i][2])
        if not own:
            return 0.0
        a = sum(own) / len(own)
        b = min(sum(m) / len(m) for c in (0, 1, 2) if c != POINTS[i][2] for m in [mean(c)])
        return (b - a) / max(a, b)

    got = {(r["x"], r["y"]): r["silhouette"] for r in clustering.silhouette_scores(df, ["x", "y"]).collect()}
    for i, p in enumerate(POINTS):
        assert got[p[0], p[1]] == pytest.approx(by_hand(i))
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(df)
    judged = ClusteringEvaluator(featuresCol="v", predictionCol="cluster").evaluate(vectors)
    assert sum(got.values()) / len(got) == pytest.approx(judged)


def test_assignment_prefers_the_lower_center_on_a_tie(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (2.5,)], "x double")
    got = {r["x"]: (r["cluster"], r["distance"]) for r in clustering.assign_clusters(df, ["x"], [[1.0], [4.0]]).collect()}
    assert got == {1.0: (0, 0.0), 4.0: (1, 0.0), 2.5: (0, 2.25)}


def test_sweep_finds_the_planted_clusters_and_the_model_survives_storage(spark, tmp_path):
    blobs = spark.range(90).select(
        "id", ((F.col("id") % 3) * 100 + F.rand(1)).alias("x"), ((F.col("id") % 3) * 50 + F.rand(2)).alias("y"))
    vectors = clustering.scaled_vectors(blobs, ["x", "y"])
    fits = clustering.kmeans_sweep(vectors, [2, 3, 5], [1, 2])
    summary = {r["k"]: r for r in clustering.sweep_summary(fits).collect()}
    assert clustering.best_k(fits) == 3 and summary[3]["is_best"] and not summary[2]["is_best"]
    assert summary[3]["mean_silhouette"] > 0.95 and summary[3]["fits"] == 2
    model = clustering.save_and_reload(clustering.fit_kmeans(vectors, 3, 1), str(tmp_path / "model"))
    labels = model.transform(vectors).groupBy((F.col("id") % 3).alias("g")).agg(
        F.count_distinct("prediction").alias("n")).collect()
    assert [r["n"] for r in labels] == [1, 1, 1]


def test_single_seed_has_no_deviation(spark):
    fits = spark.createDataFrame([(3, 1, 0.5), (5, 1, 0.5)], "k int, seed int, silhouette double")
    rows = {r["k"]: r for r in clustering.sweep_summary(fits).collect()}
    assert rows[3]["std_silhouette"] == 0.0 and rows[3]["is_best"] and not rows[5]["is_best"]


def test_profile(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 1 / 3)], "cluster int, w double")
    got = {r["cluster"]: (r["n"], r["avg_w"]) for r in
           clustering.cluster_profile(df, cluster="cluster", means={"avg_w": "w"}).collect()}
    assert got == {0: (2, 1.5), 1: (1, 0.333)}
    assert not math.isnan(got[1][1])


def test_distinct_counts_multiply_no_rows(plays):
    plan = features(plays)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    hot = plays.withColumn("team", F.when(F.col("team") == "t0", None).otherwise(F.col("team")))
    got = {r["entity"]: r["maps"] for r in clustering.entity_features(
        hot, entity="team", won=F.col("won") == 1, means={}, distinct={"maps": "map", "ranks": "rank"}, min_support=1).collect()}
    assert got[None] == 3 and got["t5"] == 3


def test_silhouette_of_many_clusters_and_of_one(spark):
    df = spark.range(1500).select((F.col("id") % 500).alias("cluster"), (F.col("id") % 500 * 10.0 + F.rand(3)).alias("x"))
    scored = clustering.silhouette_scores(df, ["x"])
    assert scored.agg(F.min("silhouette")).first()[0] > 0.5 and scored.columns == ["cluster", "x", "silhouette"]
    vectors = VectorAssembler(inputCols=["x"], outputCol="v").transform(df.withColumn("cluster", F.col("cluster").cast("int")))
    judged = ClusteringEvaluator(featuresCol="v", predictionCol="cluster").evaluate(vectors)
    assert scored.agg(F.avg("silhouette")).first()[0] == pytest.approx(judged, abs=1e-6)
    one = clustering.silhouette_scores(df.withColumn("cluster", F.lit(1)), ["x"])
    assert one.agg(F.max("silhouette")).first()[0] == 0.0


def test_sweeps_in_a_row(spark):
    blobs = spark.range(60).select(((F.col("id") % 3) * 100 + F.rand(1)).alias("x"), F.rand(2).alias("y"))
    vectors = clustering.scaled_vectors(blobs, ["x", "y"])
    for _ in range(5):
        assert clustering.kmeans_sweep(vectors, [2, 3], [1, 2, 3, 4], max_iter=3).count() == 8


def test_rows_off_their_center(spark, tmp_path):
    blobs = spark.range(60).select("id", ((F.col("id") % 3) * 100 + F.rand(1)).alias("x"), F.rand(2).alias("y"))
    vectors = clustering.scaled_vectors(blobs, ["x", "y"])
    model = clustering.fit_kmeans(vectors, 3, 1)
    labelled = model.transform(vectors)
    assert tuple(clustering.off_center(labelled, model).first()) == (60, 0)
    moved = labelled.withColumn("prediction", F.when(F.col("id") < 6, (F.col("prediction") + 1) % 3).otherwise(F.col("prediction")))
    assert tuple(clustering.off_center(moved, model).first()) == (60, 6)


def test_fits_run_on_few_partitions_and_all_rows(spark):
    rows = spark.range(3000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b")).repartition(60)
    cores = spark.sparkContext.defaultParallelism
    vectors = clustering.scaled_vectors(rows, ["a", "b"])
    assert vectors.rdd.getNumPartitions() == cores
    assert vectors.count() == 3000 and vectors.select("id").distinct().count() == 3000
    # more rows than the cores' partitions may hold get more of them
    assert clustering.gathered(rows, per_partition=100).rdd.getNumPartitions() == 30
