"""A stream whose schema is found, kept in a log, and widened as the files change, without losing a value.

Lines of a batch are read as text. Their schema is inferred from the batch's own files, merged with the one that the log
holds last, and logged if that changed anything, before a row is written. The merge rule:

* a field not seen before is added at the end;
* whole numbers and fractions of one field make it a double; integers of different widths the wider;
* structs are merged field by field, arrays and maps by their elements;
* anything else keeps the type it has, and so does a field that differs from another in case alone.

What a line holds that does not fit (a value of another type, a field that was not taken up, a line that is no JSON object)
is kept as the whole line in a rescue column, beside whatever of it does fit.

Every schema has a table of its own, a generation, named ``<table>_G<n>``; ``<table>`` is a view that casts them all to the
last schema. So a new field or a wider type rewrites nothing that is stored. A batch belongs to the generation that was
logged before its first row, and a replay of it finds the log unchanged, so it replaces its own rows there.

Defined cases: a batch without lines, or with blank ones alone, writes nothing; a field that was always null is taken up
once it has a value; an empty object or array of no known content waits for content, and lines with it are rescued; a
whole number beyond 2^53 in a double field rescues its line; nested fields whose names differ in case alone are rescued.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from tablekeep.operators.relational import with_provenance
from tablekeep.operators.tables import create_typed_table, table_exists
from tablekeep.schemas import with_provenance as provenance_schema
from tablekeep.session import col, local_conf, qualified, quote, text_literal
from tablekeep.streaming.ingest import BATCH_ID, LOAD_DATE, read_raw_stream, run_batches, write_replaceable

RESCUED = "rescued_line"
GENERATION = "_G"

# Working columns, named so that no raw field is likely to clash.
LINE = "__line"
PARSED = "__parsed"
BAD_LINE = "__bad_line"

# Beyond this a whole number may have no double of its own.
EXACT_IN_DOUBLE = 1 << 53

_WIDTHS: list[type[DataType]] = [ByteType, ShortType, IntegerType, LongType]
_FRACTIONS = (FloatType, DoubleType, DecimalType)


# ---- the merge rule


def merged_type(known: DataType, found: DataType) -> DataType | None:
    """The type that holds values of both, or None when there is none but text."""
    if isinstance(found, NullType) or known == found:
        return known
    if isinstance(known, NullType):
        return found
    kinds = (type(known), type(found))
    if all(k in _WIDTHS for k in kinds):
        return max((known, found), key=lambda t: _WIDTHS.index(type(t)))
    if all(k in _WIDTHS or k in _FRACTIONS for k in kinds):
        return DoubleType()
    if isinstance(known, StructType) and isinstance(found, StructType):
        return merged_schema(known, found)
    if isinstance(known, ArrayType) and isinstance(found, ArrayType):
        inner = merged_type(known.elementType, found.elementType)
        return ArrayType(inner) if inner is not None else None
    if isinstance(known, MapType) and isinstance(found, MapType) and known.keyType == found.keyType:
        inner = merged_type(known.valueType, found.valueType)
        return MapType(known.keyType, inner) if inner is not None else None
    return None


def merged_schema(known: StructType, found: StructType) -> StructType:
    """``known`` with the wider types and the new fields of ``found``; what cannot be merged stays as it is known."""
    by_name = {f.name: f for f in found.fields}
    out = []
    for f in known.fields:
        wider = merged_type(f.dataType, by_name[f.name].dataType) if f.name in by_name else f.dataType
        out.append(StructField(f.name, f.dataType if wider is None else wider, True))
    taken = {f.name.lower() for f in out}
    for f in found.fields:
        kind = _known_part(f.dataType)
        if f.name.lower() not in taken and kind is not None:
            taken.add(f.name.lower())
            out.append(StructField(f.name, kind, True))
    return StructType(out)


def _known_part(kind: DataType) -> DataType | None:
    """A type without parts of which no value has been seen, or None when nothing is left of it."""
    if isinstance(kind, NullType):
        return None
    if isinstance(kind, StructType):
        inner = merged_schema(StructType([]), kind)
        return inner if inner.fields else None
    if isinstance(kind, ArrayType):
        element = _known_part(kind.elementType)
        return ArrayType(element) if element is not None else None
    return kind


# ---- the log


class SchemaLog:
    """Schemas in the order in which they came, a folder each, in the shared folder given; none is ever changed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def all(self) -> list[StructType]:
        try:
            rows = self.spark.read.option("recursiveFileLookup", "true").json(self.folder, "version int, schema string").collect()
        except AnalysisException:
            return []
        by_version = {r["version"]: r["schema"] for r in rows}
        return [StructType.fromJson(json.loads(by_version[v])) for v in sorted(by_version)]

    def extended(self, found: StructType) -> list[StructType]:
        """The log after taking up ``found``; a version is written once, so two writers cannot both add it."""
        known = self.all()
        merged = merged_schema(known[-1] if known else StructType([]), found)
        if not known or merged != known[-1]:
            version = len(known)
            entry = self.spark.createDataFrame([(version, merged.json())], "version int, schema string")
            entry.coalesce(1).write.mode("errorifexists").json(f"{self.folder}/{version:06d}")
            known.append(merged)
        return known


# ---- parsing


def parsed_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """``LINE`` as the fields of ``schema``, with the other columns of ``lines``, and the rescue column."""
    full = StructType([*schema.fields, StructField(BAD_LINE, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    read = lines.withColumn(PARSED, F.from_json(LINE, full, options))
    field = lambda name: F.col(f"{PARSED}.{quote(name)}")
    bad = F.col(PARSED).isNull() | field(BAD_LINE).isNotNull() | _unlisted(F.col(LINE), schema)
    for f in schema.fields:
        if isinstance(f.dataType, DoubleType):
            bad = bad | F.coalesce(F.abs(field(f.name)) >= F.lit(float(EXACT_IN_DOUBLE)), F.lit(False))
    kept = [c for c in lines.columns if c != LINE]
    return read.select(
        *(field(n).alias(n) for n in schema.fieldNames()), F.when(bad, F.col(LINE)).alias(RESCUED), *map(col, kept)
    )


def _unlisted(line: Column, schema: StructType) -> Column:
    """Whether an object (or one inside it) has a field with a value that the schema does not name."""
    named = F.array(*(F.lit(n) for n in schema.fieldNames())) if schema.fields else F.array().cast("array<string>")
    others = F.array_except(F.json_object_keys(line), named)
    # A field that is null has no value to lose.
    held = F.exists(others, lambda k: _member(line, k).isNotNull())
    out = F.coalesce(held, F.lit(False))
    for f in schema.fields:
        if isinstance(f.dataType, StructType):
            inner = F.get_json_object(line, f"$['{f.name}']") if "'" not in f.name else F.lit(None).cast("string")
            out = out | F.coalesce(_unlisted(inner, f.dataType), F.lit(False))
    return out


def _member(line: Column, key: Column) -> Column:
    return F.element_at(F.from_json(line, "map<string,string>"), key)


# ---- the stream


def ingest_evolving(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    checkpoint: str,
    schema_dir: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> None:
    """Append new JSON lines below ``raw_dir`` to the generations behind ``table``, a view made on first use.

    Each row has its source file, load time, batch and load date, and the rescue column.
    """
    text = StructType([StructField("value", StringType(), True)])
    stream = read_raw_stream(spark, raw_dir, text, fmt="text", max_files=max_files, max_bytes=max_bytes)
    stream = with_provenance(stream.withColumnRenamed("value", LINE).where(F.trim(F.col(LINE)) != ""))

    def write(batch: DataFrame, batch_id: int) -> None:
        inner = batch.sparkSession
        # As many paths as the batch has files.
        paths = [r["source_file"] for r in batch.select("source_file").distinct().collect()]
        if not paths:
            return
        # Names that differ in case alone are told apart when they are found, and one of them is taken up.
        exact = local_conf(inner, {"spark.sql.caseSensitive": "true"})
        found = exact.read.options(columnNameOfCorruptRecord=BAD_LINE, dropFieldIfAllNull="true").json(paths).schema
        found = StructType([f for f in found.fields if f.name != BAD_LINE])
        log = SchemaLog(inner, schema_dir).extended(found)
        generation = len(log) - 1
        rows = parsed_lines(batch, log[generation])
        name = f"{table}{GENERATION}{generation}"
        if not table_exists(inner, name):
            create_typed_table(inner, name, generation_schema(log[generation]), partition_by=[LOAD_DATE])
        write_replaceable(rows, batch_id, name, checkpoint)
        show_generations(inner, table, log)

    run_batches(spark, stream, checkpoint, table, write)


def generation_schema(schema: StructType) -> StructType:
    rows = StructType([*schema.fields, StructField(RESCUED, StringType(), True)])
    return provenance_schema(rows).add(BATCH_ID, StringType(), True).add(LOAD_DATE, DateType(), True)


def show_generations(spark: SparkSession, table: str, log: list[StructType]) -> None:
    """Make ``table`` the view over all generations there are, in the columns of the last schema; one catalog step."""
    last = generation_schema(log[-1])
    parts = []
    for n, schema in enumerate(log):
        name = f"{table}{GENERATION}{n}"
        if not table_exists(spark, name):
            continue
        have = {f.name: f.dataType for f in generation_schema(schema).fields}
        columns = (f"{widened_sql(quote(f.name), have.get(f.name), f.dataType)} AS {quote(f.name)}" for f in last.fields)
        parts.append(f"SELECT {', '.join(columns)} FROM {qualified(name)}")
    spark.sql(f"CREATE OR REPLACE VIEW {qualified(table)} AS {' UNION ALL '.join(parts)}")


def widened_sql(value: str, have: DataType | None, want: DataType, depth: int = 0) -> str:
    """SQL for a value of an earlier type as the later one that it was merged into; ``have`` is None for a new field."""
    if have is None:
        return f"CAST(NULL AS {want.simpleString()})"
    if have == want:
        return value
    if isinstance(want, StructType):
        inner = {f.name: f.dataType for f in have.fields}
        fields = (
            f"{text_literal(f.name)}, {widened_sql(f'{value}.{quote(f.name)}', inner.get(f.name), f.dataType, depth)}" for f in want.fields
        )
        return f"IF({value} IS NULL, NULL, NAMED_STRUCT({', '.join(fields)}))"
    if isinstance(want, ArrayType):
        return f"TRANSFORM({value}, x{depth} -> {widened_sql(f'x{depth}', have.elementType, want.elementType, depth + 1)})"
    if isinstance(want, MapType):
        return f"TRANSFORM_VALUES({value}, (k{depth}, x{depth}) -> {widened_sql(f'x{depth}', have.valueType, want.valueType, depth + 1)})"
    return f"CAST({value} AS {want.simpleString()})"
