"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State outside the heap, saved as changes, without a count kept on every write.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

PARTITION_BYTES = 4 << 20  # stored input of a shuffle partition; a sort holds some 20 times that
GATHERED_BYTES = 8 << 20  # what small shuffle partitions are put together to


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session for the batch jobs and the streams.

    Adaptive execution coalesces shuffle partitions and splits skewed ones, so callers
    set their number for the largest input. ``conf`` keys use ``__`` for dots and win
    over the defaults.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        **STREAM_SETTINGS,
        # Call sites of column operations cost two driver calls each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_of(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files and folders that are there."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = place.getFileSystem(conf)
        if store.exists(place):
            total += store.getContentSummary(place).getLength()
    return total


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session like ``spark`` whose shuffles have a partition for every ``PARTITION_BYTES`` of
    input, so that what one task sorts or aggregates does not grow with the input.

    Adaptive execution puts partitions together again, here up to ``GATHERED_BYTES``: its
    usual size is that of compressed rows, which take ten to twenty times as much memory.
    """
    session = spark.newSession()
    known = session.conf.getAll
    for key, value in spark.conf.getAll.items():
        if known.get(key) != value and session.conf.isModifiable(key):
            session.conf.set(key, value)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(partitions, math.ceil(input_bytes / PARTITION_BYTES))
    session.conf.set("spark.sql.shuffle.partitions", str(wanted))
    gathered = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if input_bytes > partitions * PARTITION_BYTES:
        session.conf.set(gathered, str(GATHERED_BYTES))
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    A machine-local folder is used only by a local master with nothing set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="cadenza-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's scratch in the shared folder, which is deleted
    when the driver's JVM ends."""
    folder = f"{shared_folder(spark)}/cadenza-{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        store.mkdirs(place)
        store.deleteOnExit(place)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever it is stored."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession, label: str):
    """A fresh path below the shared folder, deleted at the end, also after a failure."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        remove_path(spark, path)


def checkpointed(df):
    """``df`` materialised once in the shared folder, so every later read sees the
    same rows in the same partitions even when executors are lost."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
