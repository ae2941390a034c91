"""Delimited files at the edges, Parquet between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronlens.sources.schemas import SOURCES
from patronlens.workspace import new_path

_VERSION = "version-"
_QUOTES = {"header": True, "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Header row, declared types; a header or value that does not fit fails the read. Quotes are doubled."""
    reader = spark.read.schema(schema).options(**_QUOTES).option("mode", "FAILFAST").option("enforceSchema", False)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_QUOTES).csv(path)


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five source tables from `<folder>/<name>.csv`."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in SOURCES.items()}


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of all versions of a stage and of the whole ones, which have Spark's mark of success."""
    files, place = _folder(spark, path)
    found = files.listStatus(place) if files.exists(place) else []
    names = [status.getPath().getName() for status in found]
    numbers = sorted(int(n.removeprefix(_VERSION)) for n in names if n.startswith(_VERSION))
    whole = [n for n in numbers if files.exists(_folder(spark, f"{path}/{_VERSION}{n:08d}/_SUCCESS")[1])]
    return numbers, whole


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage output as a new version and hand over the written table.

    Readers take the latest whole version, so a write that breaks leaves the one before in place, and
    `df` may read it. One earlier version is kept for frames that still read it.
    """
    spark = df.sparkSession
    numbers, whole = _versions(spark, path)
    written = f"{path}/{_VERSION}{max(numbers, default=0) + 1:08d}"
    df.write.parquet(written)
    for old in numbers:
        if old not in whole[-1:]:
            files, place = _folder(spark, f"{path}/{_VERSION}{old:08d}")
            files.delete(place, True)
    return spark.read.schema(df.schema).parquet(written)


def stored_stage(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest whole version of the stage at `path`, or None if no run has written one yet."""
    whole = _versions(spark, path)[1]
    return spark.read.parquet(f"{path}/{_VERSION}{whole[-1]:08d}") if whole else None


def enrich_master(
    master: DataFrame, columns: DataFrame, key: str = "customer_id", path: str | None = None
) -> DataFrame:
    """Add `columns` to the master table and write the result as a new stage.

    Columns of an earlier run are replaced, so the stage can be repeated. The input is
    never overwritten.
    """
    added = [c for c in columns.columns if c != key]
    enriched = master.drop(*added).join(columns, key, "left")
    return write_stage(enriched, path or new_path(master.sparkSession, "master"))
