"""Totals that follow a stream: exact partial sums per batch and key, added up when asked for.

A batch's partial sums are a partition of their own, written by overwriting, so a replay puts the same ones in place. New
files, however late, are just another batch. What is read for the totals is a row per batch and key, never the raw rows;
``fold_totals`` makes one of all batches but the last of each stream, the only one that may be replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from tablekeep.operators.relational import MONEY
from tablekeep.operators.tables import create_typed_table, table_exists
from tablekeep.operators.upkeep import rebuild, recover
from tablekeep.session import col, qualified
from tablekeep.streaming.ingest import BATCH_ID, overwrite_batch, read_raw_stream, run_batches, stream_id

TOTAL = "total"
ROWS = "n_rows"
FOLDED = "folded"

# A batch's sums have room for any number of them to be added without rounding.
SUMS = DecimalType(38, MONEY.scale)


def ingest_totals(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    checkpoint: str,
    schema: StructType,
    key: str,
    amount: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> None:
    """Add new raw rows' sums of ``amount`` per ``key`` (NULL is a key too) to ``table``, made on first use."""
    if not table_exists(spark, table):
        fields = [StructField(key, schema[key].dataType), StructField(TOTAL, SUMS), StructField(ROWS, LongType())]
        create_typed_table(spark, table, StructType([*fields, StructField(BATCH_ID, StringType())]), partition_by=[BATCH_ID])

    def add(batch: DataFrame, batch_id: int) -> None:
        inner = batch.sparkSession
        recover(inner, table)
        inner.catalog.refreshTable(qualified(table))
        sums = batch.groupBy(col(key)).agg(F.sum(col(amount).cast(MONEY)).cast(SUMS).alias(TOTAL), F.count("*").alias(ROWS))
        # One small file per batch: a row per key.
        overwrite_batch(sums.coalesce(1), table, stream_id(inner, checkpoint), batch_id)

    stream = read_raw_stream(spark, raw_dir, schema, max_files=max_files, max_bytes=max_bytes)
    run_batches(spark, stream, checkpoint, table, add)


def running_totals(spark: SparkSession, table: str, key: str) -> DataFrame:
    """Total (NULL where no amount was there) and rows per key, over all batches so far."""
    return _added(spark.table(qualified(table)), key)


def _added(partials: DataFrame, key: str) -> DataFrame:
    return partials.groupBy(col(key)).agg(F.sum(TOTAL).cast(SUMS).alias(TOTAL), F.sum(ROWS).alias(ROWS))


def fold_totals(spark: SparkSession, table: str, key: str) -> None:
    """Make one batch of all but the last of each stream; the table is swapped, so no sum is ever there twice."""
    recover(spark, table)
    partials = spark.table(qualified(table))
    stream = F.regexp_extract(BATCH_ID, "^(.*)-[0-9]+$", 1)
    number = F.regexp_extract(BATCH_ID, "-([0-9]+)$", 1).try_cast("bigint")
    batches = partials.select(BATCH_ID).distinct().withColumns({"stream": stream, "number": number})
    last = F.max("number").over(W.partitionBy("stream"))
    open_ones = batches.withColumn("last", last).where("number = last and stream <> ''").select(BATCH_ID)
    kept = partials.join(open_ones, BATCH_ID, "left_semi").select(*map(col, partials.columns))
    folded = _added(partials.join(open_ones, BATCH_ID, "left_anti"), key).withColumn(BATCH_ID, F.lit(FOLDED))
    rebuild(spark, table, folded.select(*map(col, partials.columns)).union(kept))
