"""Publishing a rebuilt table, converting its format, compacting its files, and dropping superseded copies."""

from __future__ import annotations

import logging
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablekeep.operators.revisions import NEW, OLD, SUPERSEDED_AT, end_revisions, publish_rows, purge_revisions, revisions
from tablekeep.operators.tables import (
    OWN_PROPERTY,
    REVISION,
    Buckets,
    buckets_of,
    comment_of,
    create_table_like,
    create_typed_table,
    drop_table,
    in_partitions,
    insert_rows,
    is_external,
    location_of,
    only_partitions,
    own_properties,
    partition_columns,
    provider_of,
    set_comment,
    set_properties,
    settable_properties,
    table_exists,
)
from tablekeep.session import col, local_conf, qualified, with_conf
from tablekeep.sources.files import file_listing

log = logging.getLogger(__name__)

READY = OWN_PROPERTY + "ready"
TARGET_FILE_BYTES = 256 * 1024 * 1024
# The columns that say how many files a partition should be in, and how many files of other partitions come before them.
FILES = "__files"
BEFORE = "__before"
# Where each task's rows are of one partition, they go to its file as they come. Without this, Spark sorts a task's rows by
# partition before it writes them, which takes the memory of a whole file's rows.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "4"}

# Formats whose tables have row-level changes, file compaction and revision removal as SQL commands of their own.
LAKE_FORMATS = {"delta"}

# Fixed value: how Spark names the files of a bucket, `..._00012.c000.snappy.parquet`.
BUCKET_FILE = r"_(\d+)(?:\.[^/]*)?$"
# A bucket of more than so many bytes and so many times the median is swollen.
SWOLLEN_BYTES = 256 * 1024 * 1024
SWOLLEN_TIMES = 5


def is_lake_table(spark: SparkSession, table: str) -> bool:
    return provider_of(spark, table) in LAKE_FORMATS


# ---- rename-swap


def recover(spark: SparkSession, table: str) -> bool:
    """Put right what a failure left behind: a publish between its two renames, or partitions not all overwritten."""
    if table_exists(spark, table):
        if not table_exists(spark, table + NEW) or READY not in own_properties(spark, table + NEW):
            return False
        log.warning("%s was left with partitions half overwritten: the rest is written now", table)
        _overwrite_from_staged(spark, table)
        return True
    if not table_exists(spark, table + OLD):
        return False
    log.warning("%s was left half published: its former state is put back", table)
    _rename(spark, table + OLD, table)
    return True


def publish(spark: SparkSession, table: str, rebuilt: str) -> None:
    """Make ``rebuilt`` the live ``table``; the former one stays as ``<table>_OLD`` until it is purged.

    Two renames, not one transaction: ``recover`` puts a half-done publish right on the next run. A rebuild of an
    unpartitioned table in the same format does without (see ``rebuild``); older revisions than the former state end here.
    """
    drop_table(spark, table + OLD)
    end_revisions(spark, table)
    set_properties(spark, table, {SUPERSEDED_AT: str(int(time.time()))})
    _rename(spark, table, table + OLD)
    _rename(spark, rebuilt, table)
    spark.catalog.refreshTable(qualified(table))


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {qualified(old)} RENAME TO {qualified(new)}")


def rebuild(
    spark: SparkSession, table: str, rows: DataFrame, properties: dict[str, str] | None = None, laid_out: bool = False
) -> None:
    """Write ``rows`` (in table column order) as the new state of ``table``, and publish it together with ``properties``.

    An unpartitioned table gets a new revision, which goes live in one catalog step. A partitioned one is copied and
    swapped by renames, its properties set before them. The former state stays as ``<table>_OLD``. Partitions and buckets
    stay; rows that are ``laid_out`` come as their files should be.
    """
    refuse_sink_log(spark, table)
    if not partition_columns(spark, table):
        publish_rows(spark, table, rows, properties, laid_out)
        return
    drop_table(spark, table + NEW)
    create_table_like(spark, table + NEW, table, location=_beside(spark, table))
    insert_rows(rows, table + NEW, laid_out)
    _keep_properties(spark, table, table + NEW, properties)
    publish(spark, table, table + NEW)


def _beside(spark: SparkSession, table: str) -> str | None:
    """Where the copy of an external table goes, so that it stays external: a new folder beside the present one."""
    return f"{location_of(spark, table).rstrip('/')}_{uuid.uuid4().hex[:8]}" if is_external(spark, table) else None


def refuse_sink_log(spark: SparkSession, table: str) -> None:
    if has_sink_log(spark, table):
        raise ValueError(f"{table} is a streaming sink with a file log; write it through ingest_replaceable to change its files")


def _keep_properties(spark: SparkSession, table: str, copy: str, extra: dict[str, str] | None = None) -> None:
    """All properties and the comment go over to the copy."""
    kept = {k: v for k, v in settable_properties(spark, table).items() if not k.startswith(REVISION)}
    kept = {k: v for k, v in {**kept, **own_properties(spark, table)}.items() if k != SUPERSEDED_AT}
    set_properties(spark, copy, {**kept, **(extra or {})})
    set_comment(spark, copy, comment_of(spark, table))


def overwrite_partitions(spark: SparkSession, table: str, rows: DataFrame, laid_out: bool = False) -> None:
    """Replace the partitions that occur in ``rows`` by ``rows``, which may be read from the table itself.

    They are written beside the table first; only then are the partitions of the live table overwritten. Rows that are
    ``laid_out`` come as their files should be; others are brought together by partition.
    """
    drop_table(spark, table + NEW)
    create_table_like(spark, table + NEW, table)
    if laid_out:
        rows.write.insertInto(qualified(table + NEW))
    else:
        insert_rows(rows, table + NEW)
    # From here on a failure is put right by writing again from the staged rows.
    set_properties(spark, table + NEW, {READY: "true"})
    _overwrite_from_staged(spark, table)


def _overwrite_from_staged(spark: SparkSession, table: str) -> None:
    # Which partitions an overwrite replaces is a session setting; a session beside the caller's leaves that alone.
    # Staged files have their layout already: each is read whole by one task and written as one file, without a shuffle.
    replacing = local_conf(
        spark,
        {
            "spark.sql.sources.partitionOverwriteMode": "dynamic",
            "spark.sql.files.maxPartitionBytes": "1t",
            "spark.sql.files.openCostInBytes": "1t",
            **UNSORTED,
        },
    )
    replacing.table(qualified(table + NEW)).write.insertInto(qualified(table), overwrite=True)
    spark.catalog.refreshTable(qualified(table))
    drop_table(spark, table + NEW)


def purge_superseded(spark: SparkSession, table: str, retain_hours: float = 168) -> bool:
    """Delete every former state superseded for ``retain_hours``; refuse while no live table exists.

    That is each revision of such an age, and ``<table>_OLD`` where a swap by renames has left it.
    """
    if not table_exists(spark, table):
        raise ValueError(f"{table} does not exist: its superseded copy may be the only one")
    if is_lake_table(spark, table):
        spark.sql(f"VACUUM {qualified(table)} RETAIN {retain_hours:g} HOURS")
        return True
    old, folders = table + OLD, {r.folder for r in revisions(spark, table)}
    purged = purge_revisions(spark, table, retain_hours)
    if not table_exists(spark, old) or location_of(spark, old) in folders:
        return bool(purged)
    since = own_properties(spark, old).get(SUPERSEDED_AT)
    if since is None or time.time() - int(since) < retain_hours * 3600:
        return bool(purged)
    end_revisions(spark, old)
    drop_table(spark, old)
    return True


# ---- format and files


def bucket_sizes(spark: SparkSession, table: str) -> DataFrame:
    """Bytes and files per ``bucket`` of a bucketed table, by the file names; a row per file is listed, none per record."""
    listed = file_listing(spark, location_of(spark, table))
    bucket = F.regexp_extract("path", BUCKET_FILE, 1).cast("int").alias("bucket")
    return listed.groupBy(bucket).agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


def evenly_bucketed(spark: SparkSession, table: str, key: str) -> bool:
    """Whether a table is stored in buckets of ``key`` alone, none of them so large that its one task would hold up a join.

    A bucket is read by one task, which AQE cannot split; so where a common key has swollen one, a shuffle serves better.
    The bound is the one by which AQE calls a partition skewed.
    """
    buckets = buckets_of(spark, table)
    if buckets is None or [c.lower() for c in buckets.columns] != [key.lower()]:
        return False
    found = bucket_sizes(spark, table).agg(F.max("bytes").alias("most"), F.median("bytes").alias("median")).first()
    if found["most"] is None:
        return True
    return found["most"] <= max(SWOLLEN_BYTES, SWOLLEN_TIMES * found["median"])



def convert_format(spark: SparkSession, table: str, provider: str = "orc", partition_by: list[str] | None = None) -> None:
    """Turn a table into another format under the same name: one scan and write, no shuffle, then the swap.

    Buckets stay, and partitioning stays as it is unless ``partition_by`` names another (an empty list: none). A lake format converts a Parquet table in place by its own command, without a rewrite.
    """
    recover(spark, table)
    if provider.lower() == "delta" and provider_of(spark, table) == "parquet" and not partition_by:
        spark.sql(f"CONVERT TO DELTA {qualified(table)}")
        return
    refuse_sink_log(spark, table)
    if is_external(spark, table):
        raise ValueError(f"{table} is external: convert a managed copy of it")
    drop_table(spark, table + NEW)
    rows = spark.table(qualified(table))
    if partition_by is None:
        partition_by = partition_columns(spark, table)
    # Partition columns come last in a table.
    order = [c for c in rows.columns if c not in partition_by] + partition_by
    rows = rows.select(*map(col, order))
    buckets = buckets_of(spark, table)
    create_typed_table(spark, table + NEW, rows.schema, provider, partition_by=partition_by, buckets=buckets)
    # A bucketed table's files are split by the scan as any, and each task writes what it has of a bucket.
    insert_rows(rows, table + NEW, laid_out=buckets is not None and not partition_by)
    _keep_properties(spark, table, table + NEW)
    publish(spark, table, table + NEW)


def compact_files(spark: SparkSession, table: str, file_bytes: int = TARGET_FILE_BYTES) -> bool:
    """Rewrite many small files as files of ``file_bytes`` to twice that; False when that would save none.

    Of a partitioned table only the partitions with more files than they need are read and overwritten, in place. Any
    other table is rebuilt without a shuffle: a scan that packs small files into splits of the wanted size feeds one
    output file per split. Repeated calls come to an end, as each rewrite leaves fewer files.
    """
    recover(spark, table)
    if is_lake_table(spark, table):
        spark.sql(f"OPTIMIZE {qualified(table)}")
        return True
    refuse_sink_log(spark, table)
    parts, buckets = partition_columns(spark, table), buckets_of(spark, table)
    if buckets and not parts:
        return _compact_buckets(spark, table, buckets, file_bytes)
    ragged = _ragged(spark, table, parts, buckets is not None, file_bytes)
    if not ragged:
        return False
    if parts:
        overwrite_partitions(spark, table, _laid_out(spark, table, parts, ragged, buckets), laid_out=True)
        return True
    packing = local_conf(
        spark,
        {
            "spark.sql.files.maxPartitionBytes": str(file_bytes),
            "spark.sql.files.minPartitionNum": "1",
            "spark.sql.files.openCostInBytes": "0",
        },
    )
    rebuild(spark, table, packing.table(qualified(table)), laid_out=True)
    return True


def _compact_buckets(spark: SparkSession, table: str, buckets: Buckets, file_bytes: int) -> bool:
    """Deal the rows of each bucket evenly over as many tasks as it should have files: one list entry per bucket."""
    sizes = {r["bucket"]: r for r in bucket_sizes(spark, table).collect()}
    if all(r["files"] <= max(1, -(-r["bytes"] // file_bytes)) for r in sizes.values()):
        return False
    files = [max(1, sizes[b]["bytes"] // file_bytes) if b in sizes else 1 for b in range(buckets.number)]
    # Fixed by Spark: the bucket of a row is this hash of its columns.
    bucket = F.pmod(F.hash(*map(col, buckets.columns)), F.lit(buckets.number))
    live = spark.table(qualified(table))
    numbered = live.withColumn("__row", F.monotonically_increasing_id()).withColumn("__bucket", bucket)
    of_bucket = F.element_at(F.array(*map(F.lit, files)), F.col("__bucket") + 1)
    dealt = numbered.withColumn("__file", F.pmod("__row", of_bucket))
    rebuild(spark, table, dealt.repartition(sum(files), "__bucket", "__file").select(*map(col, live.columns)), laid_out=True)
    return True


def _ragged(spark: SparkSession, table: str, parts: list[str], bucketed: bool, file_bytes: int) -> list[Row]:
    """Partition values, and how many files they should be in, where there are more than needed: at most a row per partition.

    A row per file is listed, none per record. In a bucketed partition each bucket is one file.
    """
    kinds = StructType([f for f in spark.table(qualified(table)).schema.fields if f.name in parts])
    listed = file_listing(spark, location_of(spark, table), kinds if parts else None)
    by = [col(p) for p in parts]
    if bucketed:
        each = listed.groupBy(*by, F.regexp_extract("path", BUCKET_FILE, 1).alias("__bucket")).agg(F.count("*").alias("n"))
        return each.where("n > 1").select(*by, F.lit(1).cast("long").alias(FILES)).distinct().collect()
    sizes = listed.groupBy(*by).agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))
    more = sizes.where(F.col("n") > F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(file_bytes))))
    files = F.greatest(F.lit(1), F.floor(F.col("bytes") / F.lit(file_bytes))).alias(FILES)
    return more.select(*by, files).collect()


def _laid_out(spark: SparkSession, table: str, parts: list[str], ragged: list[Row], buckets: Buckets | None = None) -> DataFrame:
    """The rows of the named partitions, each dealt evenly over as many tasks as it should have files; buckets stay whole.

    A task has the rows of one file, so its session writes them unsorted.
    """
    live = with_conf(spark, UNSORTED).table(qualified(table))
    placed, before = [], 0
    for r in ragged:
        placed.append(Row(**r.asDict(), **{BEFORE: before}))
        before += r[FILES]
    # Filtered before the ids, which no filter is pushed through. A scan gives its rows the same ids whenever it is
    # repeated, so a lost task deals them out as before.
    numbered = live.where(in_partitions(parts, ragged)).withColumn("__row", F.monotonically_increasing_id())
    dealt = only_partitions(numbered, parts, placed, [FILES, BEFORE])
    if buckets:
        file = F.col(BEFORE) * buckets.number + F.pmod(F.hash(*map(col, buckets.columns)), F.lit(buckets.number))
    else:
        file = F.col(BEFORE) + F.pmod("__row", FILES)
    tasks = before * (buckets.number if buckets else 1)
    return dealt.repartitionById(tasks, file.cast("int")).select(*map(col, live.columns))


def has_sink_log(spark: SparkSession, table: str) -> bool:
    """Whether a streaming file sink keeps its log in the table's folder: readers trust it, a swap would lose it."""
    try:
        # Spark reads no rows of such a hidden folder, but it does say when a path is missing.
        spark.read.text(location_of(spark, table).rstrip("/") + "/_spark_metadata")
        return True
    except AnalysisException:
        return False
