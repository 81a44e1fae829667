"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "versemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and Arrow switched on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: the cluster's ``spark.checkpoint.dir`` when it is set.

    A machine-local folder is only acceptable when driver and executors share one
    machine, so anything but a local master must name the folder itself.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="versemill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage_table(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once under the staging root and return a scan of it.

    Used where several later branches need the same expensive result. Unlike a cached
    DataFrame the table survives a lost executor, and unlike a checkpoint it stays
    columnar: each branch still prunes columns, filters and partitions.
    """
    return _write_and_scan(df, f"{staging_root(df.sparkSession)}/versemill/{uuid.uuid4().hex}", partition_by)


def _write_and_scan(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> DataFrame:
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """Owner of staged tables: leaving the block deletes what :meth:`table` wrote inside it.

    For algorithms that need several intermediate tables and leave one final result, which
    is staged outside the block (or written by the caller before the block ends).
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._folder = f"{staging_root(spark)}/versemill/{uuid.uuid4().hex}"
        self._count = 0

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *failure: object) -> None:
        self.drop(self._folder)

    def path(self) -> str:
        """A folder of this owner that nothing has used yet."""
        self._count += 1
        return f"{self._folder}/{self._count}"

    def table(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        return _write_and_scan(df, self.path(), partition_by)

    def drop(self, path: str) -> None:
        target = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(target, True)
