"""Key matching between a large target and an increment: NOT IN and the merge match.

Three ways to join, picked by measuring the increment:

* it fits the broadcast bound: the target is only streamed past a hash table and never shuffled;
* it does not: both sides are shuffled on the key, by semi, anti and left joins with the target (or the increment) on the
  left, which are the types that AQE splits where a key is common. NULL keys match nothing, so they are not joined at all;
* it does not, and the target is stored in buckets of the key (``co_located``): the increment alone is shuffled, to the
  target's buckets, and one full outer join per bucket gives rows that lie as the target's files do.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    AtomicType,
    BinaryType,
    DataType,
    FloatType,
    StringType,
    StructType,
)

from tablekeep.session import col, quote, settled

log = logging.getLogger(__name__)

BROADCAST_BYTES = 64 * 1024 * 1024

# Rough memory of a row, and of a value, beside the bytes of its text.
ROW_OVERHEAD = 32
VALUE_BYTES = 16

IN_TARGET = "in_target"
IN_SOURCE = "in_source"
TARGET_PREFIX = "t_"
SOURCE_PREFIX = "s_"

# Working columns, named so that no table column is likely to clash.
KEY = "__key"


class AmbiguousMatchError(ValueError):
    """More than one increment row wants to update the same target key."""


@dataclass(frozen=True)
class Profile:
    """What one pass over an increment tells: rows, rows with NULL key, most rows of one key, bytes (None: unknown)."""

    rows: int
    null_keys: int
    most_copies: int
    size: int | None


def profile(df: DataFrame, key: str) -> Profile:
    """Measure an increment; rows are pre-aggregated by key, so copies of a key cost one row per task."""
    size = _row_bytes(df.schema)
    per_key = df.groupBy(col(key).alias(KEY)).agg(
        F.count("*").alias("n"), F.sum(size if size is not None else F.lit(0)).alias("b")
    )
    found = per_key.agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col(KEY).isNull(), F.col("n"))).alias("null_keys"),
        F.max(F.when(F.col(KEY).isNotNull(), F.col("n"))).alias("most_copies"),
        F.sum("b").alias("size"),
    ).first()
    return Profile(
        found["rows"] or 0,
        found["null_keys"] or 0,
        found["most_copies"] or 0,
        (found["size"] or 0) if size is not None else None,
    )


def _row_bytes(schema: StructType) -> Column | None:
    """Bytes of a row in memory, or None when a column has no simple bound."""
    if not all(isinstance(f.dataType, AtomicType) for f in schema.fields):
        return None
    texts = [
        F.coalesce(F.octet_length(col(f.name)).cast("bigint"), F.lit(0))
        for f in schema.fields
        if isinstance(f.dataType, (StringType, BinaryType))
    ]
    fixed = F.lit(ROW_OVERHEAD + VALUE_BYTES * len(schema.fields)).cast("bigint")
    return reduce(lambda a, b: a + b, texts, fixed)


def fits_broadcast(spark: SparkSession, size: int | None, limit: int | None = None) -> bool:
    """Whether a measured side may be broadcast; a session that turned broadcasts off is obeyed."""
    if str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).startswith("-"):
        return False
    return size is not None and size <= (BROADCAST_BYTES if limit is None else limit)


def same_case(table: DataFrame, names: list[str]) -> list[str]:
    """``names`` as the columns of ``table`` are written, where they differ in case alone; a case-sensitive session is obeyed."""
    if str(table.sparkSession.conf.get("spark.sql.caseSensitive")).lower() == "true":
        return names
    written = {c.lower(): c for c in table.columns}
    return [written.get(n.lower(), n) for n in names]


def warn_float_key(data_type: DataType, key: str) -> None:
    if isinstance(data_type, FloatType):
        log.warning("key %s is a float: whole numbers above 2^24 collide", key)


# ---- NOT IN


def anti_not_in(
    target: DataFrame,
    source: DataFrame,
    key: str,
    source_key: str | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Target rows whose key is NOT IN the source's keys, with SQL's NULL rules.

    An empty source keeps every row; a NULL among the source keys keeps none; otherwise rows with a NULL key go.
    """
    keys = source.select(col(source_key or key).alias(KEY))
    seen = profile(keys, KEY)
    if seen.rows == 0:
        return target
    if seen.null_keys:
        return target.where(F.lit(False))
    kept = target.where(col(key).isNotNull())
    return _anti(kept, keys, key, seen, broadcast_limit)


def _anti(target: DataFrame, keys: DataFrame, key: str, seen: Profile, limit: int | None) -> DataFrame:
    spark = target.sparkSession
    if fits_broadcast(spark, seen.size, limit):
        return target.join(F.broadcast(keys.distinct()), col(key) == F.col(KEY), "left_anti")
    return target.join(keys, col(key) == F.col(KEY), "left_anti")


# ---- equal rows


def collapse_copies(df: DataFrame, key: str, broadcast_limit: int | None = None) -> DataFrame:
    """``distinct``, for a table whose key is nearly unique: only rows that may have a copy are shuffled.

    Equal rows have equal keys, so a first pass over the key column alone finds the keys that repeat. Rows of the other
    keys go through untouched; with no repeated key, that is the whole table. Where too many keys repeat to be broadcast,
    all rows are compared.
    """
    keyed = df.select(col(key).alias(KEY))
    repeated = keyed.groupBy(KEY).count().where("count > 1").select(KEY)
    repeated = settled(repeated)
    seen = profile(repeated, KEY)
    if seen.rows == 0:
        return df
    if not fits_broadcast(df.sparkSession, seen.size, broadcast_limit):
        return df.distinct()
    known = F.broadcast(repeated.where(F.col(KEY).isNotNull()))
    same = col(key) == F.col(KEY)
    again = df.join(known, same, "left_semi")
    if not seen.null_keys:
        return df.join(known, same, "left_anti").union(again.distinct())
    once = df.where(col(key).isNotNull()).join(known, same, "left_anti")
    return once.union(again.union(df.where(col(key).isNull())).distinct())


# ---- merge match


def reject_ambiguous(
    target: DataFrame, source: DataFrame, key: str, seen: Profile, broadcast_limit: int | None = None
) -> None:
    """Raise when a key with several increment rows is present in the target; new keys may repeat."""
    if seen.most_copies < 2:
        return
    twice = source.where(col(key).isNotNull()).groupBy(col(key).alias(KEY)).count().where("count > 1").select(KEY)
    present = target.select(col(key).alias(KEY))
    if fits_broadcast(target.sparkSession, seen.size, broadcast_limit):
        clash = present.join(F.broadcast(twice), KEY, "left_semi").first()
    else:
        clash = twice.join(present.distinct(), KEY, "left_semi").first()
    if clash is not None:
        raise AmbiguousMatchError(f"several source rows match target key {key} = {clash[KEY]!r}")


def match_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    broadcast_limit: int | None = None,
    seen: Profile | None = None,
    co_located: bool = False,
) -> DataFrame:
    """Pair target and increment rows by key: every target row with its match if any, then the unmatched increment rows.

    Gives ``in_target``, ``in_source`` and both sides' columns as ``t_<name>`` and ``s_<name>``. Equality decides, so a
    NULL key matches nothing on either side. An increment that would pair twice with a target row is refused.
    ``co_located`` says that the target is a scan of a table in buckets of the key alone.
    """
    spark = target.sparkSession
    seen = seen or profile(source, key)
    warn_float_key(target.schema[key].dataType, key)
    reject_ambiguous(target, source, key, seen, broadcast_limit)
    t = target.select(F.lit(True).alias(IN_TARGET), *(col(c).alias(TARGET_PREFIX + c) for c in target.columns))
    s = source.select(F.lit(True).alias(IN_SOURCE), *(col(c).alias(SOURCE_PREFIX + c) for c in source.columns))
    t_key, s_key = col(TARGET_PREFIX + key), col(SOURCE_PREFIX + key)
    order = [*t.columns, *s.columns]

    if fits_broadcast(spark, seen.size, broadcast_limit):
        updated = t.join(F.broadcast(s), t_key == s_key, "left")
        # At most one row per increment key, and the increment was measured.
        wanted = source.select(col(key).alias(KEY))
        matched = target.select(col(key).alias(KEY)).join(F.broadcast(wanted), KEY, "left_semi").distinct()
        new = s.join(F.broadcast(matched), s_key == F.col(KEY), "left_anti")
        paired = updated.unionByName(new, allowMissingColumns=True)
    elif co_located:
        # The increment's repeated keys are new ones (or it was refused), so no row pairs twice here either.
        paired = t.join(s.hint("merge"), t_key == s_key, "full_outer")
    else:
        paired = _by_shuffle(t, s, t_key, s_key, seen)
    flags = [F.coalesce(F.col(f), F.lit(False)).alias(f) for f in (IN_TARGET, IN_SOURCE)]
    return paired.select(*flags, *(col(c) for c in order if c not in (IN_TARGET, IN_SOURCE)))


def _by_shuffle(t: DataFrame, s: DataFrame, t_key: Column, s_key: Column, seen: Profile) -> DataFrame:
    """The match without a full outer join, which is the one type that AQE cannot split.

    AQE splits the left side of these joins where both sides come straight from their exchanges. An increment of unique
    keys is like that. One with repeated keys (which are in no target row, or it was refused) is cut down to the keys of
    the target first, and what the joins read is settled.

    The join for new rows reads the target's keys alone, which are few bytes in a shuffle and many times that in a sort or
    a hash table. AQE goes by the bytes, and would give a task millions of keys. So where the increment's keys are unique,
    and there is nothing to split, that join has all the shuffle partitions.
    """
    present = t.where(t_key.isNotNull()).select(t_key.alias(KEY)).distinct()
    matched = keyed = s.where(s_key.isNotNull())
    if seen.most_copies > 1:
        present = settled(present)
        matched = settled(keyed.join(present, s_key == F.col(KEY), "left_semi"))
        new = keyed.join(present, s_key == F.col(KEY), "left_anti")
    else:
        # An anti join, in a form that Spark does not move below the repartition.
        spread = keyed.repartition(int(t.sparkSession.conf.get("spark.sql.shuffle.partitions")), s_key)
        new = spread.join(present, s_key == F.col(KEY), "left").where(F.col(KEY).isNull()).drop(KEY)
        # Not a file of new rows from each of those tasks.
        new = new.hint("rebalance", s_key)
    updated = t.where(t_key.isNotNull()).join(matched, t_key == s_key, "left")
    for rows in (t.where(t_key.isNull()), new, s.where(s_key.isNull())):
        updated = updated.unionByName(rows, allowMissingColumns=True)
    return updated


def merged_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    broadcast_limit: int | None = None,
    seen: Profile | None = None,
    order_by: list[str] | None = None,
    co_located: bool = False,
) -> DataFrame:
    """The target after a merge: matched rows take every column of the increment, by name; new rows are added.

    With ``order_by``, a matched row is only taken over if it is not below the target's in these columns, ties broken by
    the remaining ones, as in ``latest_per_key``: then the order in which increments come does not matter.
    """
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    aligned = source.select(*(col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields))
    pairs = match_rows(target, aligned, key, broadcast_limit, seen, co_located)
    wins = F.col(IN_SOURCE)
    if order_by is not None:
        order = latest_order(target.columns, key, order_by)
        old, now = (F.struct(*(col(prefix + c) for c in order)) for prefix in (TARGET_PREFIX, SOURCE_PREFIX))
        wins = wins & (~F.col(IN_TARGET) | (now >= old))
    return pairs.select(
        *(
            F.when(wins, col(SOURCE_PREFIX + c)).otherwise(col(TARGET_PREFIX + c)).alias(c)
            for c in target.columns
        )
    )


def match_sides(target: DataFrame, source: DataFrame, key: str, broadcast_limit: int | None = None) -> DataFrame:
    """Each row's key ``k`` and where it stands: ``both``, ``target`` or ``source``. Only keys are read and moved."""
    pairs = match_rows(target.select(col(key)), source.select(col(key)), key, broadcast_limit)
    side = F.when(~F.col(IN_SOURCE), "target").when(~F.col(IN_TARGET), "source").otherwise("both")
    k = F.coalesce(col(TARGET_PREFIX + key), col(SOURCE_PREFIX + key))
    return pairs.select(k.alias("k"), side.alias("side"))


def merge_counts(target: DataFrame, source: DataFrame, key: str, broadcast_limit: int | None = None) -> DataFrame:
    """How many target rows an increment updates, how many rows it inserts, and how many target rows it leaves."""
    sides = match_sides(target, source, key, broadcast_limit)

    def of(side: str, alias: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, 1)), F.lit(0)).cast("bigint").alias(alias)

    return sides.agg(of("both", "n_updated"), of("source", "n_inserted"), of("target", "n_kept"))


def latest_order(columns: list[str], key: str, order_by: list[str]) -> list[str]:
    """The columns that decide which row of a key is the latest: ``order_by``, then all others but the key."""
    return [*order_by, *(c for c in columns if c not in order_by and c != key)]


def latest_per_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """The last row of each key by ``order_by``, ties broken by the remaining columns; NULL keys are all kept.

    A maximum over whole rows: each task sends one row per key, so a hot key is reduced before the shuffle.
    """
    best = (
        df.where(col(key).isNotNull())
        .groupBy(col(key))
        .agg(F.max(F.struct(*(col(c) for c in latest_order(df.columns, key, order_by)))).alias("best"))
    )
    picked = best.select(*(col(c) if c == key else F.col(f"best.{quote(c)}").alias(c) for c in df.columns))
    return picked.union(df.where(col(key).isNull()))
