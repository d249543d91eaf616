"""Entity features, standardisation, KMeans selection by silhouette, and cluster profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from rondel.functions.conditions import maybe_round, share_where
from rondel.operators.aggregates import averages

# Fewer vectors than this are not worth a partition of their own.
VECTORS_PER_PARTITION = 200_000


def entity_features(df: DataFrame, *, entity: str, won: Column, means: Mapping[str, str | Column],
                    distinct: Mapping[str, str], min_support: int, entity_name: str = "entity") -> DataFrame:
    """Row count, win rate, means and distinct counts per entity with at least ``min_support`` rows.

    Each distinct count is an aggregate of its own in two levels, pairs first and then entities, over a scan of two columns. Rows
    are never multiplied, and pairs of a hot entity lie in many tasks. The parts, one row per entity each, meet in one grouping.
    """
    name = F.col(entity).alias(entity_name)
    parts = [df.groupBy(name).agg(F.count("*").alias("played"), share_where(won).alias("win_rate"), *averages(means))]
    parts += [df.filter(F.col(c).isNotNull()).select(name, F.col(c).alias("_value")).distinct()
              .groupBy(entity_name).agg(F.count("*").alias(count)) for count, c in distinct.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    whole = every.groupBy(entity_name).agg(*[
        (F.coalesce(F.max(c), F.lit(0).cast("long")) if c in distinct else F.max(c)).alias(c)
        for c in every.columns if c != entity_name])
    return whole.filter(F.col("played") >= min_support)


def standardize(df: DataFrame, features: Sequence[str], suffix: str = "_z") -> DataFrame:
    """``(x - mean) / sample deviation`` beside each feature; rows with a null feature are left out.

    A feature without spread becomes 0. Two numbers per feature pass through the driver.
    """
    complete = df.dropna(subset=list(features))
    spread = complete.agg(*[
        s for i, c in enumerate(features)
        for s in (F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"))
    ]).first()
    scaled = []
    for i, c in enumerate(features):
        mean, dev = spread[f"m{i}"], spread[f"s{i}"]
        value = (F.col(c) - F.lit(mean)) / F.lit(dev) if dev else F.lit(0.0)
        scaled.append(value.alias(f"{c}{suffix}"))
    return complete.select("*", *scaled)


def gathered(df: DataFrame, per_partition: int = VECTORS_PER_PARTITION) -> DataFrame:
    """``df`` in few, full partitions, and enough for the cores.

    A fit has dozens of short stages with a task per partition each, so what a shuffle leaves in hundreds of small partitions
    costs more to start than to compute. Rows are counted, not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-df.count() // per_partition)))


def scaled_vectors(df: DataFrame, features: Sequence[str], out: str = "scaled_features") -> DataFrame:
    """The same standardisation as one vector column, for the model library, in few partitions; ``df`` should be stored."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol=out, withMean=True, withStd=True),
    ]
    rows = gathered(df)
    return Pipeline(stages=stages).fit(rows).transform(rows).drop("_raw")


def _distance(features: Sequence[str], center: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for name, at in zip(features, center):
        off = F.col(name) - F.lit(float(at))
        total = total + off * off
    return total


def assign_clusters(df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Nearest center (squared euclidean) by column arithmetic; a tie goes to the lower number."""
    options = [
        F.struct(_distance(features, c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centers)
    ]
    nearest = F.least(*options) if len(options) > 1 else options[0]
    return df.withColumn("_near", nearest).select(
        *df.columns, F.col("_near.cluster").alias("cluster"), F.col("_near.distance").alias("distance"))


def silhouette_scores(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Silhouette of every row, squared euclidean, without comparing rows with each other.

    The mean squared distance from a row to a cluster follows from the cluster's size, sum and
    sum of squared norms. Those numbers of all clusters are one array, computed beside the rows by a scalar subquery, so
    nothing passes through the driver and the plan does not grow with the number of clusters.
    """
    norm = sum((F.col(f) * F.col(f) for f in features), F.lit(0.0))
    per_cluster = df.groupBy(cluster).agg(
        F.count("*").alias("n"), F.sum(norm).alias("q"), F.array(*[F.avg(f) for f in features]).alias("center"))
    clusters = per_cluster.agg(F.collect_list(F.struct(F.col(cluster).alias("label"), "n", "q", "center"))).scalar()
    zero = F.lit(0.0)

    def mean_to(c: Column) -> Column:
        dot = sum((F.col(f) * F.get(c["center"], F.lit(i)) for i, f in enumerate(features)), zero)
        return F.greatest(norm + c["q"] / c["n"] - 2 * dot, zero)

    own = F.col(cluster)
    rows = df.withColumn("_clusters", clusters)
    inside = F.get(F.transform(F.filter("_clusters", lambda c: c["label"] == own), lambda c: F.struct(
        c["n"].alias("n"), F.when(c["n"] > 1, mean_to(c) * c["n"] / (c["n"] - 1)).otherwise(zero).alias("mean"))), F.lit(0))
    outside = F.array_min(F.transform(F.filter("_clusters", lambda c: c["label"] != own), mean_to))
    rows = rows.withColumn("_inside", inside).withColumn("_outside", outside).drop("_clusters")
    near, far = F.col("_inside.mean"), F.col("_outside")
    worst = F.greatest(near, far)
    score = F.when(far.isNull() | (F.col("_inside.n") == 1) | (worst <= 0), zero).otherwise((far - near) / worst)
    return rows.withColumn("silhouette", score).drop("_inside", "_outside")


def silhouette(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Rows and mean silhouette per cluster."""
    return silhouette_scores(df, features, cluster).groupBy(cluster).agg(
        F.count("*").alias("n"), F.avg("silhouette").alias("silhouette"))


def fit_kmeans(vectors: DataFrame, k: int, seed: int, *, features: str = "scaled_features",
               max_iter: int = 30) -> KMeansModel:
    return KMeans(featuresCol=features, k=k, seed=seed, maxIter=max_iter).fit(vectors)


def kmeans_sweep(vectors: DataFrame, ks: Sequence[int], seeds: Sequence[int], *,
                 features: str = "scaled_features", max_iter: int = 30, parallel: int = 8) -> DataFrame:
    """Silhouette of every ``(k, seed)`` fit as rows.

    The vectors are read into memory once. ``parallel`` fits submit their jobs at a time, which
    fills the cores that the many short stages of a single fit leave idle.
    """
    spark = vectors.sparkSession
    held = gathered(vectors.select(features)).persist(StorageLevel.MEMORY_AND_DISK)
    held.count()
    judge = ClusteringEvaluator(featuresCol=features, metricName="silhouette")

    def fit(setting: tuple[int, int]) -> tuple[int, int, float]:
        k, seed = setting
        model = fit_kmeans(held, k, seed, features=features, max_iter=max_iter)
        return k, seed, float(judge.evaluate(model.transform(held)))

    with ThreadPoolExecutor(parallel) as pool:
        # Each fit gets a copy of the session's properties of its own: threads that share one set and clear it under each other.
        fits = [pool.submit(inheritable_thread_target(spark)(fit), (k, s)) for k in ks for s in seeds]
        rows = [f.result() for f in fits]
    held.unpersist()
    return spark.createDataFrame(rows, "k int, seed int, silhouette double")


def sweep_summary(fits: DataFrame) -> DataFrame:
    """Mean and sample deviation over the seeds of each k, with the best k marked."""
    per_k = fits.groupBy("k").agg(
        F.count("*").alias("fits"), F.avg("silhouette").alias("mean_silhouette"),
        F.coalesce(F.stddev_samp("silhouette"), F.lit(0.0)).alias("std_silhouette"))
    # highest mean; the smaller k on a tie
    best = per_k.agg(F.max_by("k", F.struct("mean_silhouette", -F.col("k")))).scalar()
    return per_k.withColumn("is_best", F.col("k") == best)


def best_k(fits: DataFrame) -> int:
    """The k with the highest mean silhouette."""
    return sweep_summary(fits).filter("is_best").first()["k"]


def save_and_reload(model: KMeansModel, path: str) -> KMeansModel:
    model.write().overwrite().save(path)
    return KMeansModel.load(path)


def off_center(df: DataFrame, model: KMeansModel, *, features: str = "scaled_features", prediction: str = "prediction") -> DataFrame:
    """Rows, and how many of them are not assigned to a nearest center of ``model``."""
    centers = [c.tolist() for c in model.clusterCenters()]  # k of them
    names = [f"_f{i}" for i in range(len(centers[0]))]
    parts = df.withColumn("_v", vector_to_array(features)).select(
        F.col(prediction).alias("_given"), *[F.get("_v", F.lit(i)).alias(n) for i, n in enumerate(names)])
    given = F.lit(None).cast("double")
    for i, center in enumerate(centers):
        given = F.when(F.col("_given") == i, _distance(names, center)).otherwise(given)
    nearest = assign_clusters(parts, names, centers)
    off = F.coalesce(given > F.col("distance") + 1e-9, F.lit(True))
    return nearest.agg(F.count("*").alias("entities"), F.count_if(off).alias("off_center"))


def cluster_profile(df: DataFrame, *, cluster: str, means: Mapping[str, str], digits: int | None = 3) -> DataFrame:
    """Size and rounded means of each cluster."""
    return df.groupBy(cluster).agg(F.count("*").alias("n"), *averages(means, digits))
