"""Projections, filters, limits, aggregates and the distinct union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tablekeep.session import col

# Cents add up to the same total in any order of addition; binary fractions do not.
MONEY = DecimalType(18, 2)


def project(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, or all of them."""
    return df.select(*map(col, names)) if names else df.select("*")


def plus(df: DataFrame, keep: str, value: Column, by: int, alias: str) -> DataFrame:
    """``keep`` next to ``value + by``; NULL stays NULL and overflow raises."""
    return df.select(col(keep), (value + F.lit(by)).alias(alias))


def prefixed(df: DataFrame, name: str, prefix: str, alias: str) -> DataFrame:
    """``prefix`` put before a text column; NULL stays NULL."""
    return df.select(F.concat(F.lit(prefix), col(name)).alias(alias))


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the file each row came from and one load time to a file-based batch or stream."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("processing_time"))


def greater_than(df: DataFrame, name: str, bound) -> DataFrame:
    return df.where(col(name) > F.lit(bound))


def in_range(df: DataFrame, name: str, low, high) -> DataFrame:
    """Rows with ``low <= value <= high``."""
    return df.where(col(name).between(low, high))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows: no order is asked for, so none is paid for."""
    return df.limit(n)


def count_all(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(alias))


def count_one(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def sum_by_key(df: DataFrame, key: str, value: str, alias: str = "total", exact: bool = False) -> DataFrame:
    """Sum per key; ``exact`` adds two-decimal amounts as decimals and gives the total as double.

    Partial sums are made before the shuffle, so a hot key sends one row per task.
    """
    amount = col(value).cast(MONEY) if exact else col(value)
    total = F.sum(amount)
    return df.groupBy(col(key)).agg((total.cast("double") if exact else total).alias(alias))


def count_by_key(df: DataFrame, key: Column, name: str, alias: str = "n") -> DataFrame:
    """Rows per key; NULL is a group of its own."""
    return df.groupBy(key.alias(name)).agg(F.count("*").alias(alias))


def fold_sum(df: DataFrame, value: Column, alias: str = "total") -> DataFrame:
    """All values added up to one; a single row per task is exchanged."""
    return df.agg(F.sum(value).alias(alias))


def indicator_ratio(df: DataFrame, passes: Column, scale: float, alias: str = "ratio") -> DataFrame:
    """``scale`` times the share of rows for which ``passes`` holds."""
    hits = F.sum(F.when(passes, 1).otherwise(0)).cast("double")
    return df.agg((F.lit(scale).cast("double") * hits / F.count("*").cast("double")).alias(alias))


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """SQL ``UNION``: columns paired by position, equal rows collapsed (within each task before the shuffle)."""
    return left.union(right).distinct()
