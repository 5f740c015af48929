"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "arealis", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library is tuned for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: AQE coalesces
    from the cluster's own default.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # long column expressions build several times faster without call-site capture
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as set in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster each
    machine would see a different one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="arealis-")


# paths that this process has given out
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one run's written tables."""
    path = f"{shared_dir(spark)}/arealis-{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this process has written to the shared folder. Results that still
    read from there are lost: call it when they have been used."""
    count = len(_SCRATCH)
    while _SCRATCH:
        remove(spark, _SCRATCH.pop())
    return count


def checkpointed(df):
    """Cut the lineage of ``df`` through the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df, label: str):
    """``df`` written once to the shared folder and read back, so that several
    jobs use it without working it out again and lost tasks reread it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def estimated_bytes(df) -> int:
    """The optimizer's size estimate; nothing runs for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Inputs up to this estimate are cheap to shuffle.
SPREAD_BYTES = 1 << 30


def spread(df):
    """Give row-heavy work (geometry loops, exact tests) a task per core.

    A small file arrives as one or two scan partitions however slow each row is;
    anything larger already comes in enough of them and is left as it is.
    """
    small = estimated_bytes(df) < SPREAD_BYTES
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if small else df
