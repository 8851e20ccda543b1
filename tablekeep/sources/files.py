"""Scans over files: Parquet, JSON lines, split text, delimited text, and a generated range."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablekeep.session import col, local_conf

# Writing and reading JSON with default options would cut microseconds off zone-less timestamps.
JSON_TIMESTAMPS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

BLANKS = " \t\n\r\f\v"


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_json(spark: SparkSession, path: str, schema: StructType, corrupt_column: str | None = None) -> DataFrame:
    """JSON lines under a declared schema; a missing field is NULL and so is every field of a line that does not parse.

    ``corrupt_column`` keeps such lines as text in an extra column.
    """
    reader = spark.read.options(**JSON_TIMESTAMPS)
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).json(path)


def scan_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the schema taken from every line: fields in alphabetical order, whole numbers as bigint.

    Inference reads all the files once more, so big or repeated loads want ``remembered_schema`` or a declared schema.
    """
    return spark.read.options(**JSON_TIMESTAMPS).json(path)


def remembered_schema(spark: SparkSession, path: str, schema_dir: str) -> StructType:
    """The schema of JSON files, inferred on first use and kept in ``schema_dir`` for every later use."""
    try:
        kept = spark.read.text(schema_dir).first()
    except AnalysisException:
        kept = None
    if kept is None:
        reader = spark.read.option("recursiveFileLookup", "true").options(**JSON_TIMESTAMPS)
        schema = reader.json(path).schema
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(schema_dir)
        return schema
    return StructType.fromJson(json.loads(kept.value))


def _parts(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return spark.read.text(path).select(F.split("value", "\\Q" + sep + "\\E").alias("parts"))


def _part(i: int) -> Column:
    # A short line gives NULL instead of an error.
    return F.try_element_at("parts", F.lit(i + 1))


def scan_split_text(
    spark: SparkSession, path: str, schema: StructType, sep: str = ",", tolerant: bool = False
) -> DataFrame:
    """Text lines cut at ``sep`` into typed columns; blanks around a non-string value are dropped.

    Text that is no value of its type raises, or becomes NULL when ``tolerant``.
    """
    out = []
    for i, field in enumerate(schema.fields):
        value = _part(i)
        if not isinstance(field.dataType, StringType):
            value = F.btrim(value, F.lit(BLANKS))
            value = value.try_cast(field.dataType) if tolerant else value.cast(field.dataType)
        out.append(value.alias(field.name))
    return _parts(spark, path, sep).select(*out)


def scan_string_text(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """Text lines cut at ``sep`` under an all-string schema; every part after the first is stripped."""
    names = schema.names
    out = [_part(0).alias(names[0])]
    out += [F.btrim(_part(i), F.lit(BLANKS)).alias(name) for i, name in enumerate(names) if i]
    return _parts(spark, path, sep).select(*out)


def scan_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = ";") -> DataFrame:
    return spark.read.schema(schema).options(sep=sep, header="true").csv(path)


def generate_range(spark: SparkSession, first: int, last: int, partitions: int | None = None) -> DataFrame:
    """The whole numbers ``first``..``last`` as ``id``, both ends included."""
    return spark.range(first, last + 1, 1, partitions)


def file_inventory(df: DataFrame) -> DataFrame:
    """The data files behind a file-based DataFrame, with bytes and rows of each.

    Only hidden metadata columns are read, so a Parquet or ORC scan is served from file footers.
    """
    meta = ["file_path", "file_name", "file_size"]
    return (
        df.select(*(F.col(f"_metadata.{m}").alias(m) for m in meta))
        .groupBy(*map(col, meta))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def file_listing(spark: SparkSession, folder: str, partition_by: StructType | None = None) -> DataFrame:
    """The data files below a folder: ``path``, ``length`` and, of a partitioned layout, the partition values.

    A row per file (of one byte at least) and none per record: no file is opened, and a task is given as many files as if each had 4 MB. Values
    are read off the paths, as text that is then cast to the declared types.
    """
    listing = local_conf(
        spark,
        {
            "spark.sql.files.maxPartitionBytes": "1t",
            "spark.sql.files.openCostInBytes": "4m",
            "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        },
    )
    reader = listing.read.format("binaryFile")
    if partition_by is None:
        return reader.option("recursiveFileLookup", "true").load(folder).select("path", "length")
    found = reader.option("basePath", folder).load(folder)
    # A table without rows has no partition folders yet.
    values = [
        (col(f.name) if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in partition_by.fields
    ]
    return found.select("path", "length", *values)
