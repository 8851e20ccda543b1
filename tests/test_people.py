"""The people files: results as printed by the programs this library stands in for."""

import os

import pytest
from conftest import DATA
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tablekeep.operators import relational
from tablekeep.schemas import PEOPLE, all_strings
from tablekeep.sources import files, views

JSON = os.path.join(DATA, "people.json")
TEXT = os.path.join(DATA, "people.txt")
CSV = os.path.join(DATA, "people.csv")

PEOPLE_ROWS = {(None, "Michael"), (30, "Andy"), (19, "Justin")}


def rows(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture
def people(spark):
    return files.scan_json_inferred(spark, JSON)


def test_inferred_schema_and_rows(people):
    assert people.schema == StructType([StructField("age", LongType()), StructField("name", StringType())])
    assert rows(people) == PEOPLE_ROWS


def test_fixed_schema_reads_missing_field_as_null(spark):
    assert rows(files.scan_json(spark, JSON, PEOPLE)) == {("Michael", None), ("Andy", 30), ("Justin", 19)}


def test_bad_line_is_null_or_kept(spark, ws):
    path = ws.path("bad")
    spark.createDataFrame([('{"name":"Andy","age":30}',), ("no json",)], "value string").write.text(path)
    assert rows(files.scan_json(spark, path, PEOPLE)) == {("Andy", 30), (None, None)}
    kept = files.scan_json(spark, path, PEOPLE, corrupt_column="line")
    assert rows(kept) == {("Andy", 30, None), (None, None, "no json")}


def test_name_column(people):
    assert rows(relational.project(people, "name")) == {("Michael",), ("Andy",), ("Justin",)}


def test_age_plus_one(people):
    out = relational.plus(people, "name", F.col("age"), 1, "(age + 1)")
    assert out.columns == ["name", "(age + 1)"]
    assert rows(out) == {("Michael", None), ("Andy", 31), ("Justin", 20)}


def test_older_than_21(people):
    assert rows(relational.greater_than(people, "age", 21)) == {(30, "Andy")}


def test_count_by_age(people):
    assert rows(relational.count_by_key(people, F.col("age"), "age", "count")) == {(19, 1), (None, 1), (30, 1)}


def test_views(spark, people):
    assert rows(views.query_temp_view(people, "people", "SELECT * FROM people")) == PEOPLE_ROWS
    sql = "SELECT * FROM global_temp.people"
    assert rows(views.query_global_view(people, "people", sql, spark)) == PEOPLE_ROWS
    assert rows(views.query_global_view(people, "people", sql)) == PEOPLE_ROWS
    views.drop_view(spark, "people")
    views.drop_view(spark, "people", is_global=True)


def test_teenagers_from_text(spark):
    people = files.scan_split_text(spark, TEXT, PEOPLE)
    assert rows(people) == {("Michael", 29), ("Andy", 30), ("Justin", 19)}
    teens = views.query_temp_view(people, "people_text", "SELECT name FROM people_text WHERE age >= 13 AND age <= 19")
    assert rows(relational.prefixed(teens, "name", "Name: ", "label")) == {("Name: Justin",)}
    assert rows(relational.project(relational.in_range(people, "age", 13, 19), "name")) == {("Justin",)}


def test_text_as_strings(spark):
    people = files.scan_string_text(spark, TEXT, all_strings("name age"))
    assert [f.dataType for f in people.schema] == [StringType(), StringType()]
    assert rows(people) == {("Michael", "29"), ("Andy", "30"), ("Justin", "19")}


def test_short_and_bad_lines(spark, ws):
    path = ws.path("lines")
    spark.createDataFrame([("Andy, 30",), ("Short",), ("Bad, x",)], "value string").write.text(path)
    tolerant = files.scan_split_text(spark, path, PEOPLE, tolerant=True)
    assert rows(tolerant) == {("Andy", 30), ("Short", None), ("Bad", None)}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.scan_split_text(spark, path, PEOPLE).collect()


def test_separator_is_plain_text(spark, ws):
    path = ws.path("lines")
    spark.createDataFrame([("Andy|.30",)], "value string").write.text(path)
    assert rows(files.scan_split_text(spark, path, PEOPLE, sep="|.")) == {("Andy", 30)}


def test_delimited(spark):
    schema = StructType([*all_strings("name").fields, StructField("age", IntegerType()), *all_strings("job").fields])
    assert rows(files.scan_delimited(spark, CSV, schema)) == {("Jorge", 30, "Developer"), ("Bob", 32, "Developer")}


def test_remembered_schema(spark, ws, people):
    kept = ws.path("schema")
    assert files.remembered_schema(spark, JSON, kept) == people.schema
    # From now on the kept schema counts, whatever the files hold.
    assert files.remembered_schema(spark, TEXT, kept) == people.schema


def test_range(spark):
    assert [r.id for r in files.generate_range(spark, 1, 5, 2).collect()] == [1, 2, 3, 4, 5]
