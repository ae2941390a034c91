"""Null keys, duplicate rows, the audit of both, and null filling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.columns import decimal_mean


def drop_null_keys(df: DataFrame, key: str = "customer_id") -> DataFrame:
    return df.na.drop(subset=[key])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact copies collapse map-side first, so a row copied very often does not travel."""
    return df.dropDuplicates()


def clean_source(df: DataFrame, key: str = "customer_id") -> DataFrame:
    return drop_duplicate_rows(drop_null_keys(df, key))


def cleaning_audit(raw: dict[str, DataFrame], key: str = "customer_id") -> DataFrame:
    """Rows before and after cleaning per source, each source read once."""

    def audit(name: str, df: DataFrame) -> DataFrame:
        copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
        total = F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_raw")
        kept = F.count(F.col(key)).alias("rows_clean")
        return copies.agg(total, kept).select(
            F.lit(name).alias("source"),
            "rows_raw",
            "rows_clean",
            (F.col("rows_raw") - F.col("rows_clean")).alias("removed"),
        )

    return reduce(DataFrame.unionByName, [audit(n, d) for n, d in raw.items()])


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.na.fill(0, subset=present)


def fill_from(df: DataFrame, **fallbacks: Column) -> DataFrame:
    """Fill the nulls of each named column from an expression over the row."""
    return df.withColumns({c: F.coalesce(F.col(c), value) for c, value in fallbacks.items()})


def fill_with_mean(df: DataFrame, column: str, source: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the mean over the non-null rows, a one-value subquery.

    `source` may be a narrower frame with the same non-null values of the column.
    """
    average = (df if source is None else source).agg(decimal_mean(column).alias("m"))
    return fill_from(df, **{column: average.scalar()})
