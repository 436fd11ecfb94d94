"""Session factory with the settings the plans are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # documents of 100-150 KB: small Arrow batches
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints of frames that nothing refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "speechloom", master: str | None = None, **settings: str) -> SparkSession:
    b = SparkSession.builder.appName(app).config(map=SETTINGS | settings)
    return (b.master(master) if master else b).getOrCreate()


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows, as `session` sets: whole documents are held several times over on their way to a
    Python worker and back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares: spark.checkpoint.dir of the session.

    Where it is unset, a local session gets a temporary folder; on a cluster such a folder would not be shared, so that
    is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the cluster shares")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="speechloom-checkpoints-"))
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared one, for tables of one run; whoever asks for it removes it."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4()}"


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder the cluster shares.

    Spark deletes shuffle files of steps that are over when the driver collects its garbage, and checkpoints too if
    spark.cleaner.referenceTracking.cleanCheckpoints is set, as `session` does. A driver with little to hold hardly ever
    collects (every half hour by default); so it is asked to here.
    """
    checkpoint_folder(df.sparkSession)
    df.sparkSession._jvm.System.gc()
    return df.checkpoint(eager=True)
