"""Scans of raw sources, and persisted splits, features, embeddings and models."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versemill.operators.linear import LinearWeights

SPLITS = ("train", "eval", "test")
_MANIFEST = "version int, name string, schema string"


def scan_source(
    spark: SparkSession,
    path: str,
    src: int,
    row_key: Column,
    schema: T.StructType | str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A raw table plus ``src`` (source order) and ``id`` (order within the source).

    Text files hold line breaks and quotes inside fields, hence the CSV options. CSV
    needs a declared schema: inferring one would read the whole file an extra time.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV source needs a declared schema")
        raw = reader.csv(path, header=True, multiLine=True, quote='"', escape='"')
    else:
        raw = reader.format(fmt).load(path)
    return raw.withColumns({"src": F.lit(src).cast("int"), "id": row_key.cast("long")})


def spread_small_scan(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows spread over all task slots when the files give fewer splits than there are slots.

    Regular expressions over text are processor-bound, and one small file would keep a
    single core busy. A large table has more splits than slots and passes untouched.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots, key) if df.rdd.getNumPartitions() < slots else df


def write_splits(df: DataFrame, path: str) -> None:
    """One table, one folder per split; an absent split simply has no folder."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a persisted table; only its folder is read."""
    if split not in SPLITS:
        raise ValueError(f"unknown split {split!r}, expected one of {SPLITS}")
    return spark.read.parquet(path).where(F.col("split") == split)


def write_bundle(spark: SparkSession, path: str, tables: Mapping[str, DataFrame]) -> int:
    """Several tables (vocabularies, features, labels, tokens) published as one version.

    Every table is written first, by split where it has one; the manifest that names them comes
    last and appears as a whole, so a reader never sees half a bundle. Versions count from 1 and
    stay as they are. One writer at a time: a version that is there already is an error.
    """
    version = max(bundle_versions(spark, path), default=0) + 1
    lines = []
    for name, table in tables.items():
        by_split = "split" in table.columns
        writer = table.write.mode("errorifexists")
        (writer.partitionBy("split") if by_split else writer).parquet(f"{path}/tables/{version}/{name}")
        lines.append((version, name, table.schema.json()))
    manifest = spark.createDataFrame(lines, _MANIFEST)
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/manifests/{version}")
    return version


def bundle_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that are published under ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifests")
    filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(folder):
        return []
    names = [status.getPath().getName() for status in filesystem.listStatus(folder)]
    done = lambda name: filesystem.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{name}/_SUCCESS"))
    return sorted(int(name) for name in names if name.isdigit() and done(name))


def read_bundle(spark: SparkSession, path: str, name: str, split: str | None = None, version: int | None = None) -> DataFrame:
    """A table of a published bundle, by default of the newest; a split nobody wrote is empty."""
    if split is not None and split not in SPLITS:
        raise ValueError(f"unknown split {split!r}, expected one of {SPLITS}")
    if version is None:
        version = max(bundle_versions(spark, path), default=0)
    manifest = spark.read.schema(_MANIFEST).json(f"{path}/manifests/{version}").where(F.col("name") == name).first()
    if manifest is None:
        raise ValueError(f"version {version} of the bundle has no table {name!r}")
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    table = spark.read.schema(schema).parquet(f"{path}/tables/{version}/{name}").select(*schema.names)
    return table if split is None else table.where(F.col("split") == split)


# The two names a split can be asked for in.
SPLIT_FORMS = {
    "baseline": ("term_ids", "weights", "label"),
    "transformer": ("text", "label", "input_ids", "attention_mask"),
}


def split_view(df: DataFrame, split: str, form: str, key_cols: tuple[str, ...] = ("id",)) -> DataFrame:
    """A split as sparse features with label, or as token ids with label."""
    if form not in SPLIT_FORMS:
        raise ValueError(f"unknown form {form!r}, expected one of {tuple(SPLIT_FORMS)}")
    missing = [c for c in SPLIT_FORMS[form] if c not in df.columns]
    if missing:
        raise ValueError(f"form {form!r} is not computed yet, missing columns {missing}")
    return df.where(F.col("split") == split).select(*key_cols, *SPLIT_FORMS[form])


def materialise_embeddings(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame]
) -> DataFrame:
    """Read embeddings saved at ``path``; compute and save them when there are none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    filesystem = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(target):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_model(model: LinearWeights, path: str) -> None:
    """Persist a fitted model."""
    model.save(path)


def load_model(path: str) -> LinearWeights:
    """Restore a model saved with :func:`save_model`."""
    return LinearWeights.load(path)
