"""Applying an increment to a table: by full rewrite (NOT IN + UNION) or by merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tablekeep.operators.matching import (
    IN_SOURCE,
    IN_TARGET,
    SOURCE_PREFIX,
    TARGET_PREFIX,
    Profile,
    anti_not_in,
    collapse_copies,
    fits_broadcast,
    latest_order,
    match_rows,
    merged_rows,
    profile,
    reject_ambiguous,
    same_case,
    warn_float_key,
)
from tablekeep.operators.relational import union_distinct
from tablekeep.operators.revisions import set_marks
from tablekeep.operators.tables import check_positions, only_partitions, partition_columns, set_properties
from tablekeep.operators.upkeep import evenly_bucketed, is_lake_table, overwrite_partitions, rebuild, recover
from tablekeep.session import col, qualified, quote, settled


def rewritten_rows(target: DataFrame, source: DataFrame, key: str, broadcast_limit: int | None = None) -> DataFrame:
    """``target WHERE key NOT IN (source keys) UNION source``: equal rows collapse, columns pair by position.

    SQL's rules on NULL keys hold, harsh as they are: a NULL key in the source drops every target row, and a target row
    with a NULL key is dropped by any non-empty source. ``merged_rows`` keeps both.
    """
    [key], source = same_case(target, [key]), source.toDF(*same_case(target, source.columns))
    check_positions(target.schema, source.schema)
    warn_float_key(target.schema[key].dataType, key)
    kept = anti_not_in(target, source, key, broadcast_limit=broadcast_limit)
    if [c.lower() for c in target.columns] != [c.lower() for c in source.columns]:
        return union_distinct(kept, source)
    # No kept row has a key of the source, so equal rows are on one side: the big side is then not shuffled with the rest.
    return collapse_copies(kept, key, broadcast_limit).union(source.distinct())


def upsert_rewrite(
    spark: SparkSession, table: str, source: DataFrame, key: str, broadcast_limit: int | None = None
) -> None:
    """Rebuild a table by the rewrite rule and publish it; the former state stays as ``<table>_OLD``."""
    recover(spark, table)
    rows = rewritten_rows(spark.table(qualified(table)), settled(source), key, broadcast_limit)
    rebuild(spark, table, rows)


def upsert_merge(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    key: str,
    broadcast_limit: int | None = None,
    properties: dict[str, str] | None = None,
    touched_only: bool = False,
    order_by: list[str] | None = None,
) -> None:
    """Merge an increment into a table: matched rows are updated in all columns, the others inserted.

    A lake table is changed by its own MERGE, which rewrites only the files it must. Any other table is rebuilt in one
    pass and published; names are matched whatever their case; ``properties`` then go live with the new rows. With ``touched_only``, a partitioned table has only
    the partitions rewritten that the increment reaches, where that is safe (see ``_touched_partitions``). A large
    increment is brought to the buckets of a table that is bucketed by the key, whose rows then stay where they lie. With
    ``order_by`` a row older than the table's is not taken over (see ``merged_rows``).
    """
    recover(spark, table)
    target = spark.table(qualified(table))
    # Settled, as it is measured and joined several times.
    [key], source = same_case(target, [key]), settled(source.toDF(*same_case(target, source.columns)))
    if order_by is not None:
        order_by = same_case(target, order_by)
    if is_lake_table(spark, table):
        reject_ambiguous(target, source, key, profile(source, key))
        on = source.alias("s")[quote(key)] == target[quote(key)]
        wins = None
        if order_by is not None:
            order = latest_order(target.columns, key, order_by)
            now, old = (F.struct(*(side[quote(c)] for c in order)) for side in (source.alias("s"), target))
            wins = now >= old
        merge = source.alias("s").mergeInto(qualified(table), on)
        merge.whenMatched(wins).updateAll().whenNotMatched().insertAll().merge()
        # Not one transaction with the merge, but merging the same rows again changes nothing.
        set_properties(spark, table, properties or {})
        return
    seen = profile(source, key)
    parts = partition_columns(spark, table)
    touched = _touched_partitions(target, source, key, parts, seen, broadcast_limit) if touched_only and parts else None
    if touched is None:
        by_bucket = not parts and not fits_broadcast(spark, seen.size, broadcast_limit) and evenly_bucketed(spark, table, key)
        rows = merged_rows(target, source, key, broadcast_limit, seen, order_by, by_bucket)
        rebuild(spark, table, rows, properties, laid_out=by_bucket)
        return
    if touched:
        reached = only_partitions(target, parts, touched)
        overwrite_partitions(spark, table, merged_rows(reached, source, key, broadcast_limit, seen, order_by))
    set_marks(spark, table, properties or {})


def _touched_partitions(
    target: DataFrame, source: DataFrame, key: str, parts: list[str], seen: Profile, broadcast_limit: int | None
) -> list[Row] | None:
    """Partitions an increment reaches, or None when the whole table has to be rebuilt.

    Overwriting partitions is not one transaction, so it must be safe to repeat after a failure halfway: the keys of the
    increment are set and unique, and no row moves to another partition. Only the key and partition columns are read. What
    comes back is a row per partition of the table, which the catalog lists in the driver anyway.
    """
    if seen.null_keys or seen.most_copies > 1:
        return None
    pairs = match_rows(
        target.select(col(key), *map(col, parts)), source.select(col(key), *map(col, parts)), key, broadcast_limit
    ).where(F.col(IN_SOURCE))
    same = reduce(
        lambda a, b: a & b, (col(TARGET_PREFIX + p).eqNullSafe(col(SOURCE_PREFIX + p)) for p in parts), F.lit(True)
    )
    reached = (
        pairs.withColumn("moved", F.col(IN_TARGET) & ~same)
        .groupBy(*(col(SOURCE_PREFIX + p).alias(p) for p in parts))
        .agg(F.max("moved").alias("moved"))
        .collect()
    )
    if any(r["moved"] for r in reached):
        return None
    return reached
