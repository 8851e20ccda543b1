import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from tablekeep.functions import scalars


def test_sanitize(spark):
    df = spark.createDataFrame([("a.b@c-d",), ("ok9",), ("é x",), (None,)], "s string")
    got = [r[0] for r in df.select(scalars.sanitize_identifier(F.col("s"))).collect()]
    assert got == ["a_b_c_d", "ok9", "__x", None]


@pytest.mark.parametrize(
    "literal, sql_type, java",
    [
        ("cast(1 as float)", "float", "java.lang.Float"),
        ("'x'", "string", "java.lang.String"),
        ("1L", "bigint", "java.lang.Long"),
        ("1", "int", "java.lang.Integer"),
        ("1.5d", "double", "java.lang.Double"),
        ("true", "boolean", "java.lang.Boolean"),
        ("1.5", "decimal(2,1)", "java.math.BigDecimal"),
        ("date'2020-01-01'", "date", "java.sql.Date"),
        ("x'00'", "binary", "[B"),
    ],
)
def test_type_names_and_labels(spark, literal, sql_type, java):
    df = spark.sql(f"select {literal} as v union all select null")
    labels = df.select(scalars.type_label(df, "v").alias("l"), scalars.type_name(F.col("v")).alias("t")).collect()
    assert {r["l"] for r in labels} == {"Type: " + java, "Type: NULL"}
    assert {r["t"] for r in labels} == {sql_type}


@pytest.mark.parametrize("literal", ["array(1)", "map(1, 2)", "struct(1)"])
def test_label_needs_a_primitive(spark, literal):
    with pytest.raises(TypeError, match="primitive"):
        scalars.type_label(spark.sql(f"select {literal} as v"), "v")


def test_sql_function_is_registered_and_replaced(spark):
    scalars.register_type_label(spark, "label_of", LongType())
    assert spark.sql("select label_of(cast(null as bigint)), label_of(1L)").first() == ("Type: NULL", "Type: java.lang.Long")
    scalars.register_type_label(spark, "label_of", StringType())
    assert spark.sql("select label_of('x')").first()[0] == "Type: java.lang.String"
    with pytest.raises(Exception, match="WRONG_NUM_ARGS"):
        spark.sql("select label_of('x', 'y')").first()
    scalars.register_type_label(spark, "label_of", DoubleType())
    spark.sql("drop temporary function label_of")
