"""Spark session and cluster-facing helpers.

Settings that matter at scale: adaptive execution (runtime broadcast choice, skew-join splitting,
partition coalescing) and a checkpoint folder read from the session. The number of shuffle
partitions is the cluster's own setting.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "factweave",
              driver_memory: str | None = None, extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the settings the operators are tuned for."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (e.g. the driver's)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Where it is unset, a local session (tests) gets a scratch folder of its own; on a cluster there is
    none, because a machine-local folder is not visible to the other machines.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="factweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if d and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)  # named by the configuration but not yet registered on the context
    return d


def scratch_dir(spark: SparkSession) -> str | None:
    """This application's folder below the shared checkpoint folder; None where there is no shared folder."""
    folder = checkpoint_dir(spark)
    return f"{folder.rstrip('/')}/factweave-{spark.sparkContext.applicationId}" if folder else None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder for an intermediate that another step reads back."""
    folder = scratch_dir(spark)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """The shuffle files of the writes inside go as soon as each write is done, instead of when the driver's JVM happens to
    collect what refers to them. For writes only: a plan that is run again would have to make its files anew."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table to the shared folder and read back; without such a folder ``df`` as it is.

    A lost executor re-reads files instead of recomputing, later steps read the columns they need, and the planner
    knows the table's size; the shuffle files behind it go at once. ``drop_stored`` removes a table that no step reads any
    more, ``drop_scratch`` all of them when their results have been written.
    """
    spark = df.sparkSession
    if not checkpoint_dir(spark):
        return df
    path = scratch_path(spark, "stored")
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete the tables of frames that ``cut_lineage`` returned and that nothing will read again; other frames are left alone
    (without a shared folder nothing is stored, and all later frames still read them)."""
    for df in frames:
        if path := getattr(df, "_stored_at", None):
            _delete(df.sparkSession, path)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete the application's scratch folder (frames built on it must have been written before)."""
    folder = scratch_dir(spark)
    if not folder:
        return False
    return _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
