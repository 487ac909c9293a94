"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

PACKED = {"compression": "zstd"}  # of tables that hold whole texts: about two thirds of the default's bytes
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UNEVEN = 2  # times a core's share of the rows that a partition may hold
DEALT_BYTES = 16 << 20


def build_session(app: str = "corpusmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs here are written for.

    Only behaviour is set: partition counts, memory and the checkpoint folder belong to the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there, driver and executors share the disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder path below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query leave the disks as it ends, not when the driver happens to collect its garbage.

    A DataFrame that runs once more shuffles once more.
    """
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


# Schemes under which Hadoop and Arrow know the same file system.
SAME_SCHEME = {"s3a": "s3", "s3n": "s3"}


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Hadoop writes it, and the path there.

    Hadoop does not escape characters in such paths, so a local one is taken as it stands.
    """
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, path: str) -> str:
    """The path on Spark's own file system, under a scheme that Python tasks can open; any other is refused."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    scheme, rest = system.makeQualified(hadoop).toString().split(":", 1)
    uri = f"{SAME_SCHEME.get(scheme, scheme)}:{rest}"
    try:
        file_system(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as error:
        raise ValueError(f"Python tasks cannot open {uri}: {error}") from error
    return uri


def ship_package() -> None:
    """Let this package's Python helpers travel with the job instead of being installed on executors."""
    import corpusmill

    cloudpickle.register_pickle_by_value(corpusmill)


def register(spark: SparkSession, source: type[DataSource]) -> None:
    """Make a Python data source known to the session and ship it to the tasks.

    Spark looks sources up in the active session of the calling thread, which a thread of its own still lacks.
    """
    ship_package()
    spark.dataSource.register(source)
    getattr(spark._jvm, "org.apache.spark.sql.classic.SparkSession").setActiveSession(spark._jsparkSession)


def materialized(df: DataFrame, name: str = "table", **options: str) -> DataFrame:
    """The rows written once to the shared folder and read back; ``options`` are the writer's.

    Later uses neither recompute them nor depend on executors that held them.
    """
    path = work_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give CPU-heavy narrow work at least one partition per core, none with far more than its share of the rows.

    A table whose row groups lie evenly over its partitions passes through without a shuffle; a few gzip members or
    large row groups are dealt out first. How many partitions a scan has does not tell: Spark cuts files by size, but a
    row group is read by one of the cuts and leaves the others empty. Rows are counted without reading a column.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts >= cores:
        held = df.groupBy(F.spark_partition_id().alias("part")).count()
        rows = held.agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
        if (rows["most"] or 0) * cores <= UNEVEN * (rows["all"] or 0):
            return df
    # By the row's number, not round robin: that would sort all rows of a task first.
    return df.repartition(max(cores, parts), *(keys or [F.monotonically_increasing_id()]))


def dealt(df: DataFrame, size: Column, key: str, share: int | None = None) -> DataFrame:
    """Rows of a key in one partition, and about ``share`` bytes in each, however large the table is.

    By number: Spark would put partitions together by their bytes before the work, which says nothing of what a task
    makes of them.
    """
    total = df.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-total // (share or DEALT_BYTES))), key)
