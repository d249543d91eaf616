"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the operators are tuned for; a cluster may override every one of them.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "12g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master; on a cluster a missing
    setting is an error, since executors could not see such a folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="rondel-")
    sc.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; two runs never share one."""
    return f"{shared_dir(spark)}/rondel/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Settings that hold inside the block; the session's own values are put back after it."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on the shared folder and drop its history.

    Its shuffle files are deleted with it: otherwise they stay until the driver's garbage collector finds them, and a loop
    fills the disk with those of all its rounds.
    """
    spark = df.sparkSession
    base = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    with settings(spark, {SHUFFLE_CLEANUP_KEY: "true"}):
        done = df.select("*")  # the setting counts when a plan is made
    return done.checkpoint(eager=True)


def _checkpoint_file(df: DataFrame) -> str | None:
    """Where ``df`` lies, if it is what ``cut_lineage`` returned and nothing was done to it since."""
    plan = df._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() != "LogicalRDD":
        return None
    file = plan.rdd().getCheckpointFile()
    return file.get() if file.isDefined() else None


def is_cut(df: DataFrame) -> bool:
    return _checkpoint_file(df) is not None


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a ``cut_lineage`` that nothing reads any more; anything else is left alone."""
    file = _checkpoint_file(df)
    if file:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Re-split an input too small to give every core a file split of its own.

    Files are cut into splits of at least ``openCostInBytes``; an input of that size per core or
    more fills the cores by itself and passes through untouched, so the shuffle is only ever
    paid on small inputs. The check uses the optimizer's size estimate and runs no job.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate >= cores * split:
        return df
    return df.repartition(cores)  # round-robin: no key can make one part larger
