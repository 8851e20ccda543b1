"""Identifier clean-up, type names and the type-label function, as built-in expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tablekeep.session import col, qualified, quote, text_literal

# What is replaced in an identifier, and by what.
UNSAFE = "[^a-zA-Z0-9]"
SAFE = "_"

# The label texts, and the Java class that holds a value of each primitive type.
LABEL = "Type: "
NULL_LABEL = "Type: NULL"
JAVA_CLASSES: dict[type[DataType], str] = {
    BooleanType: "java.lang.Boolean",
    ByteType: "java.lang.Byte",
    ShortType: "java.lang.Short",
    IntegerType: "java.lang.Integer",
    LongType: "java.lang.Long",
    FloatType: "java.lang.Float",
    DoubleType: "java.lang.Double",
    StringType: "java.lang.String",
    DecimalType: "java.math.BigDecimal",
    DateType: "java.sql.Date",
    TimestampType: "java.sql.Timestamp",
    TimestampNTZType: "java.time.LocalDateTime",
    BinaryType: "[B",
}


def sanitize_identifier(text: Column) -> Column:
    """Every character that is no ASCII letter or digit becomes an underscore."""
    return F.regexp_replace(text, UNSAFE, SAFE)


def type_name(value: Column) -> Column:
    """The SQL type name of a column, on every row."""
    return F.typeof(value)


def java_class(data_type: DataType) -> str:
    for kind, name in JAVA_CLASSES.items():
        if isinstance(data_type, kind):
            return name
    raise TypeError(f"a primitive type is needed, not {data_type.simpleString()}")


def type_label(df: DataFrame, name: str) -> Column:
    """``Type: <Java class>`` of the column's type, or ``Type: NULL`` where the value is NULL."""
    held = LABEL + java_class(df.schema[name].dataType)
    return F.when(col(name).isNull(), F.lit(NULL_LABEL)).otherwise(F.lit(held))


def register_type_label(spark: SparkSession, function: str, data_type: DataType) -> None:
    """Drop if present, then create the type label as a temporary SQL function of one primitive argument."""
    held = text_literal(LABEL + java_class(data_type))
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {quote(function)}")
    spark.sql(
        f"CREATE TEMPORARY FUNCTION {quote(function)}(x {data_type.simpleString()}) RETURNS STRING "
        f"RETURN CASE WHEN x IS NULL THEN {text_literal(NULL_LABEL)} ELSE {held} END"
    )


def create_type_label(spark: SparkSession, function: str, data_type: DataType) -> None:
    """The type label as a permanent SQL function of the catalog (``db.function``), which every session sees."""
    held = text_literal(LABEL + java_class(data_type))
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {qualified(function)}(x {data_type.simpleString()}) RETURNS STRING "
        f"RETURN CASE WHEN x IS NULL THEN {text_literal(NULL_LABEL)} ELSE {held} END"
    )


def drop_function(spark: SparkSession, function: str) -> None:
    spark.sql(f"DROP FUNCTION IF EXISTS {qualified(function)}")


def register_class_function(spark: SparkSession, function: str, class_name: str) -> None:
    """Drop if present, then create a temporary function from a class on the class path (needs a Hive session)."""
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {quote(function)}")
    spark.sql(f"CREATE TEMPORARY FUNCTION {quote(function)} AS {text_literal(class_name)}")
