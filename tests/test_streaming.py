"""Incremental ingest: new files only, restarts, replays, merging, and living with compaction."""

import collections

import loans
import pytest
from pyspark.sql import functions as F

from tablekeep.operators import tables, upkeep
from tablekeep.operators.upsert import upsert_merge, upsert_rewrite
from tablekeep.schemas import BRONZE_TRANSACTIONS, TRANSACTIONS
from tablekeep.session import qualified
from tablekeep.sources.files import file_inventory
from tablekeep.sources.landing import land_increment
from tablekeep.streaming import ingest

SCHEMA = "id bigint, v string, at bigint"


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.fixture
def raw(spark, ws):
    """Land rows as an increment of the raw zone, in a folder of their own."""
    steps = iter(range(100))

    def land(rows):
        i = next(steps)
        df = rows if hasattr(rows, "write") else spark.createDataFrame(rows, SCHEMA)
        df.write.json(ws.path("source", str(i)))
        return land_increment(spark, ws.path("source", str(i)), ws.path("raw"), f"step_{i}")

    return land


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_loan_story(spark, ws, raw):
    """Bronze grows by the three rows of the increment, and by nothing when nothing is new."""
    bronze, n = ws.table("bronze"), 60
    run = lambda: ingest.ingest_append(spark, ws.path("raw"), bronze, ws.path("cp"), TRANSACTIONS)
    counts = []
    raw(loans.snapshot(spark, n))
    run()
    counts.append(spark.table(bronze).count())
    raw(loans.increment(spark, n))
    run()
    counts.append(spark.table(bronze).count())
    run()
    counts.append(spark.table(bronze).count())
    assert counts == [n, n + 3, n + 3]
    got = spark.table(bronze)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BRONZE_TRANSACTIONS]
    assert bag(got.select(TRANSACTIONS.names)) == bag(loans.snapshot(spark, n)) + bag(loans.increment(spark, n))
    assert got.where("source_file like '%/step_1/%'").count() == 3
    assert got.select("processing_time").distinct().count() == 2


def test_any_split_of_files_gives_one_load(spark, ws, raw):
    rows = [(i, f"v{i}", i) for i in range(90)]
    for i in range(3):
        raw(rows[i::3])
    for name, max_files in (("once", None), ("by_file", 1)):
        ingest.ingest_append(spark, ws.path("raw"), ws.table(name), ws.path("cp", name), schema(spark), max_files)
        assert bag(spark.table(ws.table(name)).select("id", "v", "at")) == collections.Counter(rows)


def test_landing_keeps_lines_and_refuses_twice(spark, ws):
    lines = ['{"a": 1 }', "", "  text\twith blanks ", "ü", "carriage\rreturn"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(ws.path("source"))
    landed = land_increment(spark, ws.path("source"), ws.path("raw"), "one", compression="gzip")
    back = spark.read.option("lineSep", "\n").text(landed)
    assert collections.Counter(r.value for r in back.collect()) == collections.Counter(lines)
    with pytest.raises(Exception, match="(?i)exist"):
        land_increment(spark, ws.path("source"), ws.path("raw"), "one")


def test_sink_with_a_log_is_not_compacted(spark, ws, raw):
    raw([(1, "a", 1)])
    ingest.ingest_append(spark, ws.path("raw"), ws.table("bronze"), ws.path("cp"), schema(spark))
    with pytest.raises(ValueError, match="file log"):
        upkeep.compact_files(spark, ws.table("bronze"))


def test_replaceable_bronze_survives_compaction(spark, ws, raw):
    bronze = ws.table("bronze")

    def run():
        ingest.ingest_replaceable(spark, ws.path("raw"), bronze, ws.path("cp"), schema(spark), max_files=2)
        return spark.table(bronze).select("id", "v", "at")

    rows = [(i, f"v{i}", i) for i in range(40)]
    raw(spark.createDataFrame(rows[:30], SCHEMA).repartition(6))
    assert bag(run()) == collections.Counter(rows[:30])
    upkeep.compact_files(spark, bronze)
    assert bag(run()) == collections.Counter(rows[:30])
    raw(rows[30:])
    assert bag(run()) == collections.Counter(rows)
    assert bag(run()) == collections.Counter(rows)


def test_bronze_is_compacted_across_increments(spark, ws, raw):
    bronze, rows = ws.table("bronze"), [(i, f"v{i}", i) for i in range(50)]

    def run(i):
        raw(rows[i * 10 : i * 10 + 10])
        ingest.ingest_replaceable(spark, ws.path("raw"), bronze, ws.path("cp"), schema(spark))

    for i in range(4):
        run(i)
    before = file_inventory(spark.table(bronze)).count()
    assert upkeep.compact_files(spark, bronze) and file_inventory(spark.table(bronze)).count() < before
    assert not upkeep.compact_files(spark, bronze)
    assert bag(spark.table(bronze).select("id", "v", "at")) == collections.Counter(rows[:40])
    run(4)
    assert bag(spark.table(bronze).select("id", "v", "at")) == collections.Counter(rows)
    assert spark.table(bronze).select(ingest.BATCH_ID).distinct().count() == 5


@pytest.mark.parametrize("compacted", [False, True])
def test_replayed_bronze_batch_replaces_its_own_rows(spark, ws, raw, monkeypatch, compacted):
    """A batch that wrote its rows and failed before its commit, with a compaction before it is tried again."""
    bronze = ws.table("bronze")

    def run():
        ingest.ingest_replaceable(spark, ws.path("raw"), bronze, ws.path("cp"), schema(spark))

    raw([(1, "a", 1)])
    run()
    raw([(2, "b", 2), (2, "b", 2)])
    with monkeypatch.context() as patched:
        patched.setattr(ingest, "set_properties", failing_after_write(ingest.set_properties, spark, bronze))
        with pytest.raises(Exception, match="once"):
            run()
    spark.catalog.refreshTable(qualified(bronze))
    assert spark.table(bronze).where("id = 9").count() == 1  # the half that was written
    if compacted:
        upkeep.compact_files(spark, bronze)
    for _ in range(2):
        run()
        assert bag(spark.table(bronze).select("id", "v", "at")) == {(1, "a", 1): 1, (2, "b", 2): 2}


def failing_after_write(original, spark, table):
    """Mark the batch as begun, leave a row of it behind, and fail."""

    def wrapped(inner, name, properties):
        original(inner, name, properties)
        [(mark, number)] = properties.items()
        batch = f"{mark.rsplit('.', 1)[1]}-{number}"
        left = inner.table(qualified(table)).limit(1).withColumns({"id": F.lit(9).cast("long"), ingest.BATCH_ID: F.lit(batch)})
        left.write.insertInto(qualified(table))
        raise Failure("once")

    return wrapped


def test_replaceable_bronze_with_a_new_checkpoint_keeps_the_old_rows(spark, ws, raw):
    bronze = ws.table("bronze")
    raw([(1, "a", 1)])
    for cp in ("one", "two"):
        ingest.ingest_replaceable(spark, ws.path("raw"), bronze, ws.path(cp), schema(spark))
    assert spark.table(bronze).count() == 2


class Failure(Exception):
    pass


def failing_once(monkeypatch, module, name, after):
    """Let ``module.name`` run (if ``after``) and then fail, one time."""
    original, calls = getattr(module, name), []

    def wrapped(*args, **kwargs):
        calls.append(1)
        if len(calls) > 1:
            return original(*args, **kwargs)
        if after:
            original(*args, **kwargs)
        raise Failure("once")

    monkeypatch.setattr(module, name, wrapped)


@pytest.mark.parametrize("after", [False, True], ids=["before the write", "after the write"])
def test_merge_restart_after_a_failed_batch(spark, ws, raw, monkeypatch, after):
    target = tables.create_typed_table(spark, ws.table("t"), schema(spark))
    tables.insert_rows(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], SCHEMA), target)
    raw([(2, "B", 1), (3, "C", 1), (None, "N", 1)])

    def run():
        ingest.ingest_upsert(spark, ws.path("raw"), target, ws.path("cp"), schema(spark), "id", ["at"])

    failing_once(monkeypatch, ingest, "upsert_merge", after)
    with pytest.raises(Exception, match="once"):
        run()
    run()
    expected = {(1, "a", 0): 1, (2, "B", 1): 1, (3, "C", 1): 1, (None, "N", 1): 1}
    spark.catalog.refreshTable(qualified(target))
    assert bag(spark.table(target)) == expected
    run()
    assert bag(spark.table(target)) == expected


def test_merge_takes_the_last_row_whatever_batch_it_comes_in(spark, ws, raw):
    target = tables.create_typed_table(spark, ws.table("t"), schema(spark))
    tables.insert_rows(spark.createDataFrame([(1, "a", 0)], SCHEMA), target)

    def run():
        ingest.ingest_upsert(spark, ws.path("raw"), target, ws.path("cp"), schema(spark), "id", ["at"])
        return bag(spark.table(target))

    raw([(1, "late", 9), (1, "early", 3), (2, "x", 1)])
    assert run() == {(1, "late", 9): 1, (2, "x", 1): 1}
    raw([(2, "old", 0)])
    assert run() == {(1, "late", 9): 1, (2, "x", 1): 1}
    raw([(2, "y", 2)])
    assert run() == {(1, "late", 9): 1, (2, "y", 2): 1}
    assert upkeep.purge_superseded(spark, target, 0)
    assert run() == {(1, "late", 9): 1, (2, "y", 2): 1}


def test_merge_stream_equals_one_batch_merge(spark, ws, raw):
    """Any cut of the changes into landings ends in the same table."""
    changes = [(k, f"s{i}", i) for i, k in enumerate([5, 6, 7, 5, 8, 6, 99, 100, 99])]
    ends = []
    for name, cuts in (("one", [9]), ("three", [3, 6, 9])):
        target = tables.create_typed_table(spark, ws.table(name), schema(spark))
        tables.insert_rows(spark.range(10).selectExpr("id", "'t' as v", "-1L as at"), target)
        start = 0
        for end in cuts:
            df = spark.createDataFrame(changes[start:end], SCHEMA)
            df.write.json(ws.path("source", name, str(end)))
            land_increment(spark, ws.path("source", name, str(end)), ws.path("raw", name), f"to_{end}")
            ingest.ingest_upsert(spark, ws.path("raw", name), target, ws.path("cp", name), schema(spark), "id", ["at"])
            start = end
        ends.append(bag(spark.table(target)))
    assert ends[0] == ends[1]
    assert sum(ends[0].values()) == 12


def test_stream_drops_nothing_on_bad_lines(spark, ws):
    spark.createDataFrame([('{"id": 1, "v": "a"}',), ("no json",)], "value string").write.text(ws.path("raw", "x"))
    ingest.ingest_append(spark, ws.path("raw"), ws.table("bronze"), ws.path("cp"), schema(spark))
    got = spark.table(ws.table("bronze"))
    assert got.count() == 2 and got.where(F.col("id").isNull()).count() == 1


def test_merge_puts_bad_lines_aside_once(spark, ws, monkeypatch):
    target = tables.create_typed_table(spark, ws.table("t"), schema(spark))
    tables.insert_rows(spark.createDataFrame([(1, "a", 0)], SCHEMA), target)
    bad = ["no json", '{"id": "x", "v": "b", "at": 1}']
    lines = ['{"id": 1, "v": "A", "at": 1}', '{"id": 2}', *bad]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(ws.path("raw", "x"))

    def run():
        ingest.ingest_upsert(spark, ws.path("raw"), target, ws.path("cp"), schema(spark), "ID", ["AT"])

    failing_once(monkeypatch, ingest, "upsert_merge", False)
    with pytest.raises(Exception, match="once"):
        run()
    for _ in range(2):
        run()
        spark.catalog.refreshTable(qualified(target))
        assert bag(spark.table(target)) == {(1, "A", 1): 1, (2, None, None): 1}
        aside = spark.table(target + ingest.REJECTED)
        assert sorted(r.line for r in aside.collect()) == sorted(bad)
        assert aside.where("source_file like '%/raw/x/%'").count() == 2


@pytest.mark.parametrize("upsert", [upsert_merge, upsert_rewrite])
def test_names_are_matched_whatever_their_case(spark, ws, upsert):
    target = tables.create_typed_table(spark, ws.table("t"), schema(spark))
    tables.insert_rows(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], SCHEMA), target)
    upsert(spark, target, spark.createDataFrame([(2, "B", 1), (3, "C", 1)], "ID bigint, V string, At bigint"), "Id")
    assert spark.table(target).columns == ["id", "v", "at"]
    assert bag(spark.table(target)) == {(1, "a", 0): 1, (2, "B", 1): 1, (3, "C", 1): 1}


@pytest.mark.parametrize("max_files", [None, 1, 2])
def test_merge_does_not_depend_on_the_batch_cut(spark, ws, raw, max_files):
    target = tables.create_typed_table(spark, ws.table("t"), schema(spark))
    tables.insert_rows(spark.createDataFrame([(1, "a", 0), (3, "kept", 8)], SCHEMA), target)
    for rows in ([(1, "new", 5)], [(1, "old", 3), (2, "x", 1)], [(3, "late", 7), (2, "w", 0)], [(4, "n", 1)]):
        raw(rows)
    ingest.ingest_upsert(
        spark, ws.path("raw"), target, ws.path("cp"), schema(spark), "id", ["at"], max_files=max_files
    )
    assert bag(spark.table(target)) == {(1, "new", 5): 1, (2, "x", 1): 1, (3, "kept", 8): 1, (4, "n", 1): 1}
