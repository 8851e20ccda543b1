"""Streams from the raw zone: append to bronze, replaceable append, and merge per micro-batch.

Each run takes the files not yet in the checkpoint, stops when it has caught up, and may be repeated at will.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tablekeep.operators.matching import latest_per_key, same_case
from tablekeep.operators.relational import with_provenance
from tablekeep.operators.tables import OWN_PROPERTY, create_typed_table, own_properties, set_properties, table_exists
from tablekeep.operators.upkeep import overwrite_partitions, recover
from tablekeep.operators.upsert import upsert_merge
from tablekeep.schemas import with_provenance as provenance_schema
from tablekeep.session import col, qualified
from tablekeep.sources.files import JSON_TIMESTAMPS

BATCH_ID = "batch_id"
LOAD_DATE = "load_date"

# Name ending of the table beside a merge stream's that holds the lines which did not parse.
REJECTED = "_REJECTED"

# Working columns, named so that no raw column is likely to clash.
LINE = "__line"
FROM_FILE = "__source_file"


def read_raw_stream(
    spark: SparkSession,
    raw_dir: str,
    schema: StructType,
    fmt: str = "json",
    max_files: int | None = None,
    max_bytes: str | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """New files anywhere under ``raw_dir``; ``max_files`` or ``max_bytes`` bound one micro-batch.

    ``corrupt_column`` keeps lines that do not parse as text in an extra column.
    """
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType(), True)])
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true").options(**JSON_TIMESTAMPS)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(raw_dir)


def ingest_append(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    checkpoint: str,
    schema: StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> None:
    """Append new raw rows, with source file and load time, to a bronze table (made on first use)."""
    stream = with_provenance(read_raw_stream(spark, raw_dir, schema, max_files=max_files, max_bytes=max_bytes))
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.toTable(qualified(table)).awaitTermination()
    spark.catalog.refreshTable(qualified(table))


def ingest_replaceable(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    checkpoint: str,
    schema: StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> None:
    """As ``ingest_append``, into a table that may also be compacted or swapped.

    The table is partitioned by load date, so files of many batches can be compacted into one, and has the batch as a
    column. The batch begun last is a property of the table: one found there is replayed after a failure, and replaces
    the rows that it left in its date's partition, even if it failed halfway through its commit. Any other is appended.
    """
    if not table_exists(spark, table):
        columns = provenance_schema(schema).add(BATCH_ID, StringType(), True).add(LOAD_DATE, DateType(), True)
        create_typed_table(spark, table, columns, partition_by=[LOAD_DATE])

    def write(batch: DataFrame, batch_id: int) -> None:
        write_replaceable(batch, batch_id, table, checkpoint)

    stream = with_provenance(read_raw_stream(spark, raw_dir, schema, max_files=max_files, max_bytes=max_bytes))
    run_batches(spark, stream, checkpoint, table, write)


def write_replaceable(batch: DataFrame, batch_id: int, table: str, checkpoint: str) -> None:
    """Append a batch to a table partitioned by load date, in place of what an earlier try of it left there."""
    inner, stream = batch.sparkSession, stream_id(batch.sparkSession, checkpoint)
    recover(inner, table)
    inner.catalog.refreshTable(qualified(table))
    begun, name = OWN_PROPERTY + "begun." + stream, f"{stream}-{batch_id}"
    # A replayed batch has the load time of its first try, hence its date.
    rows = batch.withColumns({BATCH_ID: F.lit(name), LOAD_DATE: F.to_date("processing_time")})
    if own_properties(inner, table).get(begun) != str(batch_id):
        set_properties(inner, table, {begun: str(batch_id)})
        rows.write.insertInto(qualified(table))
    elif (some := rows.select(LOAD_DATE).first()) is not None:
        of_date = inner.table(qualified(table)).where(F.col(LOAD_DATE) == F.lit(some[LOAD_DATE]))
        overwrite_partitions(inner, table, of_date.where(F.col(BATCH_ID) != name).union(rows))


def ingest_upsert(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    checkpoint: str,
    schema: StructType,
    key: str,
    order_by: list[str],
    max_files: int | None = None,
    max_bytes: str | None = None,
    broadcast_limit: int | None = None,
    touched_only: bool = False,
) -> None:
    """Merge new raw rows into an existing table, one merge per micro-batch.

    The last row of a key by ``order_by`` counts, within a batch and against the live row, so the result does not depend on
    how files are cut into batches or in which order they come. The id of the last batch merged is a property of the
    table and goes live with its rows, so a batch replayed after a failure is not merged, or even read, again.
    Lines of which not every field parses are not merged: they go, with their file, to ``<table>_REJECTED``, a partition per
    batch that has any, written before the merge and by overwriting, so a replay adds none twice.
    Each merge rebuilds the table, so let a run take all it finds as one batch, or partition the table and set
    ``touched_only``.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        inner = batch.sparkSession
        recover(inner, table)
        inner.catalog.refreshTable(qualified(table))
        mark = OWN_PROPERTY + "batch." + stream_id(inner, checkpoint)
        if int(own_properties(inner, table).get(mark, -1)) >= batch_id:
            return
        batch.persist()
        try:
            _put_aside(batch, table + REJECTED, stream_id(inner, checkpoint), batch_id)
            live = inner.table(qualified(table))
            parsed = batch.where(F.col(LINE).isNull()).select(*map(col, schema.fieldNames()))
            parsed = parsed.toDF(*same_case(live, parsed.columns))
            rows = latest_per_key(parsed, *same_case(live, [key]), same_case(live, order_by))
            upsert_merge(inner, table, rows, key, broadcast_limit, {mark: str(batch_id)}, touched_only, order_by)
        finally:
            batch.unpersist()

    stream = read_raw_stream(spark, raw_dir, schema, max_files=max_files, max_bytes=max_bytes, corrupt_column=LINE)
    stream = stream.select("*", F.col("_metadata.file_path").alias(FROM_FILE))
    run_batches(spark, stream, checkpoint, table, merge)


def _put_aside(batch: DataFrame, rejected: str, stream: str, batch_id: int) -> None:
    """Store the lines of a batch that did not parse, if there are any; the table is made on first use."""
    bad = batch.where(F.col(LINE).isNotNull()).select(F.col(LINE).alias("line"), F.col(FROM_FILE).alias("source_file"))
    if bad.isEmpty():
        return
    spark = batch.sparkSession
    if not table_exists(spark, rejected):
        columns = StructType([StructField(c, StringType(), True) for c in ("line", "source_file", BATCH_ID)])
        create_typed_table(spark, rejected, columns, partition_by=[BATCH_ID])
    overwrite_batch(bad, rejected, stream, batch_id)


def overwrite_batch(rows: DataFrame, table: str, stream: str, batch_id: int) -> None:
    """Write a batch as a partition of its own, in place of what an earlier try left there."""
    view = "batch_" + stream.replace("-", "_")
    rows.createOrReplaceTempView(view)
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {qualified(table)} PARTITION ({BATCH_ID} = '{stream}-{batch_id}') SELECT * FROM {view}"
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a query keeps in its checkpoint for life; a new checkpoint counts its batches from 0 under a new id."""
    return json.loads(spark.read.text(checkpoint.rstrip("/") + "/metadata").first()["value"])["id"]


def run_batches(spark: SparkSession, stream: DataFrame, checkpoint: str, table: str, write) -> None:
    """Run ``write(batch, batch_id)`` for all that is there now."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    # The batches ran in a cloned session; this one would still list the former files.
    if table_exists(spark, table):
        spark.catalog.refreshTable(qualified(table))
