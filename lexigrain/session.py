"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on. Partition counts are left to the cluster; AQE
#: coalesces small shuffles and splits skewed joins.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints nothing refers to any more are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Recording the Python call site of every column costs more than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A dictionary literal may be long; its text form is of no use in a plan.
    "spark.sql.maxPlanStringLength": "20000",
}


def build_session(app: str = "lexigrain", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that ``spark.checkpoint.dir`` or the application names."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(folder)


def materialise(frame: DataFrame) -> DataFrame:
    """Write ``frame`` once to the checkpoint folder and go on from there.

    Used where two later branches must see the very same rows (range ids, fitted
    inputs), so that an executor lost half-way cannot give them different ones.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


#: Paths of intermediate tables this process has written.
_written: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for data that ``remove_stored`` may delete."""
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return remembered(f"{folder}/{name}-{uuid.uuid4().hex}")


def remembered(path: str) -> str:
    _written.append(path)
    return path


def remove_stored(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far; call it once the results that read them are written."""
    removed = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """``frame`` as Parquet in the shared folder, written with the writer's ``options``.

    For wide frames that many branches read: each then reads only its columns, with statistics,
    where a checkpoint would give back whole rows.
    """
    path = shared_path(frame.sparkSession, name)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
