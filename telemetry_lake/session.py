"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, safe to change on a live session.  Time buckets, dates and hours assume UTC.
# AQE splits skewed join partitions and turns a join into a broadcast only after measuring the side.
# The JVM never compiles methods over 8000 bytes; past that, wide projections run faster as several
# small generated methods than as one big interpreted one.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# For long-running streams: state on executor disks instead of the heap, with changes written to the
# checkpoint as a log.  Pass to ``build_session``; a query keeps the store it was started with.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_MADE: set[str] = set()  # scratch folders of the applications this process has run


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "telemetry-lake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``, removed when the application ends.

    A machine-local folder is used only in local mode, where it is shared by definition.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="telemetry-lake-")
        spark.conf.set("spark.checkpoint.dir", base)
    own = f"{base.rstrip('/')}/telemetry-lake-{spark.sparkContext.applicationId}"
    if own not in _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _MADE.add(own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    For results that several later steps read: they are computed once, survive lost executors, and
    each step reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of settled tables that nothing reads any more."""
    for table in tables:
        spark, files = table.sparkSession, table.inputFiles()
        if files:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(files[0])).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of each query go when it ends, not when its plan is collected as garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
