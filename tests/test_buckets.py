"""Bucketed tables: kept by every rebuild, merged without moving the target, compacted bucket by bucket; file listings."""

import collections

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from test_matching import bag
from test_queries import executed_plans, plan_of

from tablekeep.operators import tables, upkeep
from tablekeep.operators.matching import AmbiguousMatchError
from tablekeep.operators.upsert import upsert_merge
from tablekeep.session import qualified
from tablekeep.sources import files

SCHEMA = "k long, v string, w int"


def made(spark, ws, rows, name="t", n=4, by=("k",), parts=None, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    live = tables.create_typed_table(spark, ws.table(name), df.schema, buckets=tables.Buckets(by, n), partition_by=parts)
    tables.insert_rows(df, live)
    return live


def rows_of(spark, table):
    return bag(spark.table(qualified(table)))


def merge_brute(target, source):
    by_key = {r[0]: r for r in source if r[0] is not None}
    present = {r[0] for r in target}
    out = [by_key.get(r[0], r) if r[0] is not None else r for r in target]
    return collections.Counter(out + [r for r in source if r[0] is None or r[0] not in present])


TARGET = [(i % 90 if i % 10 else None, f"t{i}", i) for i in range(200)] + [(7, "same", 1)] * 3
SOURCE = [(k, f"s{k}", k) for k in range(0, 120, 3)] + [(None, "n1", 1), (None, "n1", 1), (500, "new", 1), (500, "new", 2)]


@pytest.mark.parametrize("limit", [None, 0])
def test_merge_agrees_with_the_other_forms(spark, ws, limit):
    source = spark.createDataFrame(SOURCE, SCHEMA)
    expected = merge_brute(TARGET, SOURCE)
    live = made(spark, ws, TARGET)
    plain = tables.create_typed_table(spark, ws.table("plain"), source.schema)
    tables.insert_rows(spark.createDataFrame(TARGET, SCHEMA), plain)
    for table in (live, plain):
        upsert_merge(spark, table, source, "K", broadcast_limit=limit)
        assert rows_of(spark, table) == expected
    assert tables.buckets_of(spark, live) == tables.Buckets(("k",), 4)
    twice = spark.createDataFrame([(7, "a", 1), (7, "b", 1)], SCHEMA)
    with pytest.raises(AmbiguousMatchError):
        upsert_merge(spark, live, twice, "k", broadcast_limit=limit)
    assert rows_of(spark, live) == expected


def test_merge_does_not_move_the_target(spark, ws):
    live = made(spark, ws, [(i, "x" * 50, i) for i in range(5000)])
    source = spark.createDataFrame([(i, "y", i) for i in range(4000, 6000)], SCHEMA)
    with executed_plans(spark) as plans:
        upsert_merge(spark, live, source, "k", broadcast_limit=0)
    [merge] = [p for p in plans if "FullOuter" in p]
    # One exchange, the increment's; the target's scan is read by buckets straight into the sort of its bucket.
    tree = merge.split("Initial Plan")[0]
    assert tree.count("Exchange") == 1 and "Bucketed: true" in merge and "SelectedBucketsCount: 4 out of 4" in merge
    sizes = {r["bucket"]: r["files"] for r in upkeep.bucket_sizes(spark, live).collect()}
    assert sizes == {0: 1, 1: 1, 2: 1, 3: 1}
    # Every key is in one bucket, so that it can be grouped there: nothing was written into a wrong one.
    again = spark.table(qualified(live)).groupBy("k").count()
    assert "Exchange" not in plan_of(again) and again.where("count = 1").count() == again.count() == 6000


def test_a_swollen_bucket_is_shuffled_instead(spark, ws, monkeypatch):
    rows = [(5, f"hot {i}", i) for i in range(3000)] + [(i, "x", i) for i in range(60)]
    source = [(i, "y", i) for i in range(40, 80)]
    live = made(spark, ws, rows)
    assert upkeep.evenly_bucketed(spark, live, "k") and not upkeep.evenly_bucketed(spark, live, "v")
    monkeypatch.setattr(upkeep, "SWOLLEN_BYTES", 100)
    assert not upkeep.evenly_bucketed(spark, live, "k")
    with executed_plans(spark) as plans:
        upsert_merge(spark, live, spark.createDataFrame(source, SCHEMA), "k", broadcast_limit=0)
    assert not [p for p in plans if "FullOuter" in p]
    assert rows_of(spark, live) == merge_brute(rows, source) and tables.buckets_of(spark, live).number == 4


@pytest.mark.parametrize("parts", [None, ["w"]])
def test_conversion_and_compaction_keep_buckets(spark, ws, parts):
    rows = [(i, f"v{i}", i % 3) for i in range(600)]
    live = made(spark, ws, rows[:200], parts=parts)
    for a in (200, 400):
        tables.insert_rows(spark.createDataFrame(rows[a : a + 200], SCHEMA), live)
    folder = tables.location_of(spark, live)
    assert files.file_listing(spark, folder).count() == (36 if parts else 12)
    assert upkeep.compact_files(spark, live)
    assert files.file_listing(spark, tables.location_of(spark, live)).count() == (12 if parts else 4)
    assert not upkeep.compact_files(spark, live)
    assert rows_of(spark, live) == bag(spark.createDataFrame(rows, SCHEMA))
    upkeep.convert_format(spark, live, "orc")
    assert tables.buckets_of(spark, live) == tables.Buckets(("k",), 4)
    assert tables.partition_columns(spark, live) == (parts or [])
    assert rows_of(spark, live) == bag(spark.createDataFrame(rows, SCHEMA))
    if not parts:
        # More than one file for a bucket of more bytes than a file should have.
        assert not upkeep.compact_files(spark, live, file_bytes=10**6)
        tables.insert_rows(spark.createDataFrame(rows, SCHEMA), live)
        most = max(r["bytes"] for r in upkeep.bucket_sizes(spark, live).collect())
        upkeep.compact_files(spark, live, file_bytes=most // 2)
        sizes = upkeep.bucket_sizes(spark, live).collect()
        assert {r["files"] for r in sizes} <= {1, 2} and max(r["files"] for r in sizes) == 2
        assert rows_of(spark, live) == bag(spark.createDataFrame(rows * 2, SCHEMA))


def test_columns_with_quotes_and_no_buckets(spark, ws):
    odd = "a `b`, c"
    live = made(spark, ws, [(1, "x", 2)], by=(odd,), schema=f"`a ``b``, c` long, v string, w int")
    assert tables.buckets_of(spark, live) == tables.Buckets((odd,), 4)
    plain = tables.create_typed_table(spark, ws.table("plain"), spark.range(1).schema)
    assert tables.buckets_of(spark, plain) is None


def test_a_listing_has_a_row_per_file_and_opens_none(spark, ws):
    rows = [("a b", 1, i) for i in range(50)] + [("x=/é", None, i) for i in range(50)] + [(None, 2, 1), ("01", 3, 1)]
    df = spark.createDataFrame(rows, "p string, q int, v int")
    path = ws.path("parts")
    df.repartition(3).write.partitionBy("p", "q").parquet(path)
    kinds = StructType([StructField("p", StringType()), StructField("q", IntegerType())])
    listed = files.file_listing(spark, path, kinds)
    assert "ReadSchema: struct<path:string,length:bigint>" in plan_of(listed)
    per_part = {(r["p"], r["q"]): r["n"] for r in listed.groupBy("p", "q").agg(F.count("*").alias("n")).collect()}
    written = spark.read.parquet(path).select("p", "q", F.input_file_name().alias("f")).distinct().groupBy("p", "q").count().collect()
    assert set(per_part) == {("a b", 1), ("x=/é", None), (None, 2), ("01", 3)}
    assert sum(per_part.values()) == sum(r["count"] for r in written) == files.file_listing(spark, path).count()


def test_compaction_reads_no_record_to_find_small_files(spark, ws):
    live = tables.create_typed_table(spark, ws.table("t"), spark.range(1).schema)
    tables.insert_rows(spark.range(100_000).repartition(3), live)
    upkeep.compact_files(spark, live)
    with executed_plans(spark) as plans:
        assert not upkeep.compact_files(spark, live)
    scans = [line for p in plans for line in p.split("\n") if "Scan " in line and "(" in line]
    assert scans and not [line for line in scans if "parquet" in line.lower()]
