"""Namespaces, table definition, positional inserts, and what the catalog tells about a table."""

from __future__ import annotations

import json
import logging
import re
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablekeep.functions.scalars import sanitize_identifier
from tablekeep.operators.matching import fits_broadcast
from tablekeep.schemas import columns_ddl
from tablekeep.session import col, qualified, quote, text_literal

log = logging.getLogger(__name__)

# The Hive storage clauses of a Parquet table.
HIVE_PARQUET = (
    "ROW FORMAT SERDE 'org.apache.hadoop.hive.ql.io.parquet.serde.ParquetHiveSerDe' "
    "STORED AS INPUTFORMAT 'org.apache.hadoop.hive.ql.io.parquet.MapredParquetInputFormat' "
    "OUTPUTFORMAT 'org.apache.hadoop.hive.ql.io.parquet.MapredParquetOutputFormat'"
)

# Table properties with this prefix are ours and move along when a table is rebuilt.
OWN_PROPERTY = "tablekeep."
# Entries of the list of revisions (see ``operators.revisions``).
REVISION = OWN_PROPERTY + "revision."

# Memory that a row of partition values may take on a broadcast side.
PARTITION_ROW_BYTES = 1024



@dataclass(frozen=True)
class Buckets:
    """``CLUSTERED BY (columns) INTO number BUCKETS``."""

    columns: tuple[str, ...]
    number: int


# ---- namespaces


def user_namespace(spark: SparkSession) -> str:
    """The current user's name, made safe as a database name."""
    return spark.range(1).select(sanitize_identifier(F.current_user()).alias("name")).first()["name"]


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> str:
    at = f" LOCATION {text_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)}{at}")
    return name


@contextmanager
def using_namespace(spark: SparkSession, name: str):
    """``USE name`` for a block, then back to the former database."""
    before = spark.catalog.currentDatabase()
    spark.sql(f"USE {quote(name)}")
    try:
        yield
    finally:
        spark.sql(f"USE {quote(before)}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {qualified(table)}")


# ---- definition


def create_external_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    location: str,
    provider: str = "json",
    options: dict[str, str] | None = None,
) -> str:
    """A table with declared columns over files that stay where they are."""
    opts = _pairs("OPTIONS", options)
    spark.sql(
        f"CREATE TABLE {qualified(table)} ({columns_ddl(schema)}) USING {provider}{opts} LOCATION {text_literal(location)}"
    )
    return table


def create_table_like(
    spark: SparkSession, table: str, model: str, provider: str | None = None, location: str | None = None
) -> str:
    """Clone columns (and, unless named, the provider) of ``model``; optionally at a location of its own."""
    using = f" USING {provider}" if provider else ""
    at = f" LOCATION {text_literal(location)}" if location else ""
    spark.sql(f"CREATE TABLE {qualified(table)} LIKE {qualified(model)}{using}{at}")
    return table


def create_typed_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    provider: str = "parquet",
    properties: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
    buckets: Buckets | None = None,
) -> str:
    """A managed table with explicit columns in a chosen format, unpartitioned and unbucketed unless asked."""
    parts = f" PARTITIONED BY ({', '.join(map(quote, partition_by))})" if partition_by else ""
    if buckets:
        parts += f" CLUSTERED BY ({', '.join(map(quote, buckets.columns))}) INTO {buckets.number} BUCKETS"
    props = _pairs("TBLPROPERTIES", properties)
    spark.sql(f"CREATE TABLE {qualified(table)} ({columns_ddl(schema)}) USING {provider}{parts}{props}")
    return table


def create_hive_table(
    spark: SparkSession, table: str, schema: StructType, properties: dict[str, str] | None = None
) -> str:
    """A Parquet table by Hive DDL with SerDe and input/output formats; the native form where the session has no Hive."""
    if spark.conf.get("spark.sql.catalogImplementation") != "hive":
        log.warning("no Hive support in this session: %s is made with USING PARQUET", table)
        return create_typed_table(spark, table, schema, "parquet", properties)
    props = _pairs("TBLPROPERTIES", properties)
    spark.sql(f"CREATE TABLE {qualified(table)} ({columns_ddl(schema)}) {HIVE_PARQUET}{props}")
    return table


def _pairs(clause: str, values: dict[str, str] | None) -> str:
    if not values:
        return ""
    return f" {clause} (" + ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in values.items()) + ")"


# ---- filling


def check_positions(target: StructType, source: StructType) -> None:
    """A positional insert pairs columns by place: refuse another count or other types, warn on other names."""
    if len(target) != len(source):
        raise ValueError(f"{len(source)} columns cannot fill {len(target)} by position")
    for i, (a, b) in enumerate(zip(target.fields, source.fields)):
        if a.dataType != b.dataType:
            raise TypeError(
                f"column {i + 1}: {b.name} {b.dataType.simpleString()} cannot fill {a.name} {a.dataType.simpleString()}"
            )
        if a.name.lower() != b.name.lower():
            log.warning("column %d: %s fills %s by position", i + 1, b.name, a.name)


def insert_rows(df: DataFrame, table: str, laid_out: bool = False) -> None:
    """Append by position. Rows of a partitioned or bucketed table are first brought together by partition and bucket, hot
    ones split, unless they are ``laid_out`` already."""
    spark = df.sparkSession
    schema, buckets = spark.table(qualified(table)).schema, buckets_of(spark, table)
    check_positions(schema, df.schema)
    # Paired by position, so the layout's columns are looked up in the table.
    place = dict(zip(schema.names, df.columns))
    by = [place[c] for c in [*partition_columns(spark, table), *(buckets.columns if buckets else ())]]
    if by and not laid_out:
        # As many parts as buckets: Spark deals rows out as it does into buckets, so a part is a bucket's file.
        df = df.hint("rebalance", *([buckets.number] if buckets else []), *map(col, by))
    df.write.insertInto(qualified(table))
    spark.catalog.refreshTable(qualified(table))


def insert_from_table(spark: SparkSession, table: str, source: str) -> None:
    """``INSERT INTO table SELECT * FROM source``."""
    insert_rows(spark.table(qualified(source)), table)


# ---- catalog


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(qualified(table))


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(qualified(table)) if c.isPartition]


def buckets_of(spark: SparkSession, table: str) -> Buckets | None:
    """The bucketing of a table, or None; a table has one only if the number of buckets is told."""
    details = _described(spark, table)[1]
    if not details.get("Num Buckets", "-1").strip().isdigit():
        return None
    columns = tuple(c.replace("``", "`") for c in re.findall("`((?:[^`]|``)*)`", details["Bucket Columns"]))
    return Buckets(columns, int(details["Num Buckets"])) if columns and int(details["Num Buckets"]) > 0 else None


def in_partitions(parts: list[str], wanted: list[Row]) -> Column:
    """A condition on each partition column alone, so that other partitions are not even listed for the scan.

    Of several columns it also lets through other combinations of their values; ``only_partitions`` does not.
    """

    def one(p: str) -> Column:
        values = {r[p] for r in wanted}
        some = col(p).isin(list(values - {None})) if values - {None} else F.lit(False)
        return some | col(p).isNull() if None in values else some

    return reduce(lambda a, b: a & b, map(one, parts))


def only_partitions(df: DataFrame, parts: list[str], wanted: list[Row], extra: list[str] | None = None) -> DataFrame:
    """The rows of the given partitions, with the columns ``extra`` (longs) of ``wanted``, if named, added to them."""
    spark, reached = df.sparkSession, df.where(in_partitions(parts, wanted))
    if len(parts) == 1 and not extra:
        return reached
    extra = extra or []
    by = [f"__p{i}" for i in range(len(parts))]
    kinds = [StructField(b, df.schema[p].dataType) for p, b in zip(parts, by)] + [StructField(e, LongType()) for e in extra]
    listed = spark.createDataFrame([tuple(r[c] for c in parts + extra) for r in wanted], StructType(kinds))
    if fits_broadcast(spark, len(wanted) * PARTITION_ROW_BYTES):
        listed = F.broadcast(listed)
    same = [col(p).eqNullSafe(F.col(b)) for p, b in zip(parts, by)]
    return reached.join(listed, same, "inner" if extra else "left_semi").drop(*by)


def _described(spark: SparkSession, table: str) -> tuple[list[Row], dict[str, str]]:
    """The column lines and the detail lines of DESCRIBE EXTENDED, told apart by section, as names may clash."""
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(table)}").collect()
    heads = [i for i, r in enumerate(lines) if r["col_name"].startswith("#") or not r["col_name"]]
    details = next(i for i, r in enumerate(lines) if r["col_name"] == "# Detailed Table Information")
    return lines[: heads[0]], {r["col_name"]: r["data_type"] for r in lines[details + 1 :] if r["col_name"]}


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """Columns with types, and the ``Provider`` line, of DESCRIBE EXTENDED."""
    columns, details = _described(spark, table)
    rows = [(r["col_name"], r["data_type"]) for r in columns] + [("Provider", details["Provider"])]
    return spark.createDataFrame(rows, "col_name string, data_type string")


def provider_of(spark: SparkSession, table: str) -> str:
    return _described(spark, table)[1]["Provider"].lower()


def location_of(spark: SparkSession, table: str) -> str:
    return _described(spark, table)[1]["Location"]


def is_external(spark: SparkSession, table: str) -> bool:
    return _described(spark, table)[1].get("Type") == "EXTERNAL"


def comment_of(spark: SparkSession, table: str) -> str | None:
    return _described(spark, table)[1].get("Comment")


def show_ddl(spark: SparkSession, table: str) -> str:
    return spark.sql(f"SHOW CREATE TABLE {qualified(table)}").first()[0]


def settable_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """All table properties but those that the catalog keeps for itself."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {qualified(table)}").collect()
    return {r["key"]: r["value"] for r in rows if not r["key"].startswith(("spark.sql.", "transient_", "option."))}


def own_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """Our properties; where the live state is in the list of revisions, as its entry has them."""
    found = settable_properties(spark, table)
    own = {k: v for k, v in found.items() if k.startswith(OWN_PROPERTY) and not k.startswith(REVISION)}
    listed = [json.loads(v) for k, v in found.items() if k.startswith(REVISION)]
    at = location_of(spark, table) if listed else None
    return next(({**own, **r["marks"]} for r in listed if r["folder"] == at), own)


def set_comment(spark: SparkSession, table: str, comment: str | None) -> None:
    if comment:
        spark.sql(f"COMMENT ON TABLE {qualified(table)} IS {text_literal(comment)}")


def set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    if properties:
        spark.sql(f"ALTER TABLE {qualified(table)} SET{_pairs('TBLPROPERTIES', properties)}")


def remove_properties(spark: SparkSession, table: str, names: list[str]) -> None:
    if names:
        spark.sql(f"ALTER TABLE {qualified(table)} UNSET TBLPROPERTIES IF EXISTS ({', '.join(map(text_literal, names))})")


def spot_check(df: DataFrame, key: str) -> DataFrame:
    """After a load: rows, rows with NULL key, and distinct keys, in one pass."""
    n, keyed = F.count("*"), F.count(col(key))
    return df.agg(
        n.alias("n_rows"), (n - keyed).alias("n_null_key"), F.count_distinct(col(key)).alias("n_distinct_key")
    )


# Bits of a sketch's register index: some 1.6 % off at most times, in 4 KB a load.
SKETCH_BITS = 12
LOAD = "load"


def check_load(df: DataFrame, key: str, checks: str, load: str) -> None:
    """The spot check of one load, stored in the table ``checks`` (made on first use) as a partition of its name.

    Rows and NULL keys are exact; distinct keys are a sketch that can be merged with those of other loads, so that a check
    after a load reads that load alone. Only keys with a sketch are counted: whole numbers, texts and bytes.
    """
    spark = df.sparkSession
    n, keyed = F.count("*"), F.count(col(key))
    sketch = F.coalesce(F.hll_sketch_agg(col(key), SKETCH_BITS), F.lit(b""))
    found = df.agg(n.alias("n_rows"), (n - keyed).alias("n_null_key"), sketch.alias("sketch"))
    if not table_exists(spark, checks):
        create_typed_table(spark, checks, StructType([*found.schema.fields, StructField(LOAD, StringType())]), partition_by=[LOAD])
    view = "check_" + uuid.uuid4().hex
    found.createOrReplaceTempView(view)
    spark.sql(f"INSERT OVERWRITE TABLE {qualified(checks)} PARTITION ({LOAD} = {text_literal(load)}) SELECT * FROM {view}")
    spark.sql(f"DROP VIEW {view}")
    spark.catalog.refreshTable(qualified(checks))


def checked_total(spark: SparkSession, checks: str) -> DataFrame:
    """What the checks of all loads so far say together: rows, rows with NULL key, and some number of distinct keys.

    A row per load is read, never the table. Loads without a key have no sketch to merge.
    """
    sketches = F.when(F.length("sketch") > 0, F.col("sketch"))
    merged = F.hll_union_agg(sketches, F.lit(False))
    return spark.table(qualified(checks)).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_null_key"), F.lit(0)).alias("n_null_key"),
        F.coalesce(F.hll_sketch_estimate(merged), F.lit(0)).alias("distinct_keys"),
    )
