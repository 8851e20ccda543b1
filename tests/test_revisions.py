"""Publishing in one catalog step, the list of revisions, retention and restoring."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from test_matching import bag

from tablekeep.operators import revisions, tables, upkeep
from tablekeep.operators.upsert import upsert_merge
from tablekeep.session import qualified
from tablekeep.sources import files


def filled(spark, ws, name="t", n=5, **kind):
    live = tables.create_typed_table(spark, ws.table(name), spark.range(1).schema, **kind)
    tables.insert_rows(spark.range(n), live)
    return live


def ids(spark, table):
    return sorted(r[0] for r in spark.table(qualified(table)).collect())


def age(spark, table, number, hours):
    """As if a revision had been superseded (or begun) earlier."""
    [r] = [r for r in revisions.revisions(spark, table) if r.number == number]
    back = int(time.time() - hours * 3600)
    aged = revisions.replace(r, made_at=back, superseded_at=back if r.superseded_at else None)
    tables.set_properties(spark, table, aged.stored())


def test_readers_never_miss_the_table_while_it_is_published(spark, ws):
    live, seen, failed, done = filled(spark, ws), [], [], threading.Event()
    reading = spark.newSession()

    def read():
        while not done.is_set():
            try:
                reading.catalog.refreshTable(qualified(live))
                seen.append(tuple(sorted(r[0] for r in reading.table(qualified(live)).collect())))
            except Exception as e:  # noqa: BLE001
                failed.append(repr(e))

    thread = threading.Thread(target=read)
    thread.start()
    for i in range(10):
        upkeep.rebuild(spark, live, spark.range(i, i + 5))
    done.set()
    thread.join()
    assert not failed and len(seen) > 10
    assert set(seen) <= {tuple(range(i, i + 5)) for i in range(-1, 10)} | {tuple(range(5))} and len(set(seen)) > 2
    assert not upkeep.recover(spark, live)


def test_a_query_under_way_keeps_the_files_it_began_with(spark, ws):
    live = filled(spark, ws)
    begun = spark.table(qualified(live)).where(F.col("id") >= 0)
    begun.schema, begun.rdd.getNumPartitions()
    upkeep.rebuild(spark, live, spark.range(100, 103))
    assert sorted(r[0] for r in begun.collect()) == list(range(5)) and ids(spark, live) == [100, 101, 102]


def test_purge_by_age_keeps_exactly_the_younger_ones_and_restore_gives_the_older_rows(spark, ws):
    live = filled(spark, ws, n=1)
    for i in range(1, 6):
        upkeep.rebuild(spark, live, spark.range(i * 10, i * 10 + i), {"tablekeep.note": str(i)})
    listed = {r["number"]: (r["n_rows"], r["state"]) for r in revisions.list_revisions(spark, live).collect()}
    assert listed == {1: (1, "superseded"), **{i: (i - 1, "superseded") for i in range(2, 6)}, 6: (5, "live")}
    assert ids(spark, live + upkeep.OLD) == [40, 41, 42, 43]
    for number, hours in ((1, 300), (2, 200), (3, 169), (4, 167)):
        age(spark, live, number, hours)
    folders = {r.number: r.folder for r in revisions.revisions(spark, live)}
    assert revisions.purge_revisions(spark, live) == [1, 2, 3]
    assert [r.number for r in revisions.revisions(spark, live)] == [4, 5, 6]
    there = {n: os.path.isdir(f.removeprefix("file:")) for n, f in folders.items()}
    assert there == {1: False, 2: False, 3: False, 4: True, 5: True, 6: True}
    assert sorted(r[0] for r in revisions.read_revision(spark, live, 4).collect()) == [30, 31, 32]

    revisions.restore_revision(spark, live, 4)
    assert ids(spark, live) == [30, 31, 32] and tables.own_properties(spark, live)["tablekeep.note"] == "3"
    assert ids(spark, live + upkeep.OLD) == [50, 51, 52, 53, 54]
    with pytest.raises(ValueError, match="no revision 2"):
        revisions.restore_revision(spark, live, 2)
    # Going on from there: the state gone back from is a revision like any.
    upsert_merge(spark, live, spark.range(32, 34), "id", properties={"tablekeep.note": "merged"})
    assert ids(spark, live) == [30, 31, 32, 33] and tables.own_properties(spark, live)["tablekeep.note"] == "merged"
    assert [r.number for r in revisions.revisions(spark, live)] == [4, 5, 6, 7]
    assert upkeep.purge_superseded(spark, live, 0) and not upkeep.purge_superseded(spark, live, 0)
    assert [r.number for r in revisions.revisions(spark, live)] == [7] and ids(spark, live) == [30, 31, 32, 33]


@pytest.mark.parametrize("step", ["insert_rows", "_switch", "list"])
def test_a_failed_rebuild_leaves_the_table_as_it_was(spark, ws, monkeypatch, step):
    live = filled(spark, ws)
    upkeep.rebuild(spark, live, spark.range(3), {"tablekeep.note": "before"})

    def fails(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        if step == "list":
            # The list is written, and the location is not set any more.
            patched.setattr(revisions, "text_literal", fails)
        else:
            patched.setattr(revisions, step, fails)
        with pytest.raises(RuntimeError, match="lost"):
            upkeep.rebuild(spark, live, spark.range(9), {"tablekeep.note": "after"})
    assert ids(spark, live) == [0, 1, 2] and tables.own_properties(spark, live)["tablekeep.note"] == "before"
    assert not upkeep.recover(spark, live)
    upkeep.rebuild(spark, live, spark.range(7), {"tablekeep.note": "again"})
    assert ids(spark, live) == list(range(7)) and tables.own_properties(spark, live)["tablekeep.note"] == "again"
    upkeep.purge_superseded(spark, live, 0)
    assert [r.folder for r in revisions.revisions(spark, live)] == [tables.location_of(spark, live)]
    beside = os.path.dirname(tables.location_of(spark, live).removeprefix("file:"))
    assert [f for f in os.listdir(beside) if f.startswith("t_r") or f == "t"] == [os.path.basename(tables.location_of(spark, live))]


def test_conversion_ends_the_list(spark, ws):
    live = filled(spark, ws, buckets=tables.Buckets(("id",), 2))
    for i in range(2):
        upkeep.rebuild(spark, live, spark.range(i, i + 4), {"tablekeep.note": str(i)})
    upkeep.convert_format(spark, live, "orc")
    assert revisions.revisions(spark, live) == [] and tables.own_properties(spark, live)["tablekeep.note"] == "1"
    assert ids(spark, live) == [1, 2, 3, 4] and ids(spark, live + upkeep.OLD) == [1, 2, 3, 4]
    assert tables.provider_of(spark, live) == "orc" and not tables.is_external(spark, live)
    upsert_merge(spark, live, spark.range(4, 6), "id")
    assert ids(spark, live) == [1, 2, 3, 4, 5] and tables.buckets_of(spark, live).number == 2
    upkeep.convert_format(spark, live, "parquet")
    assert ids(spark, live) == [1, 2, 3, 4, 5]
    assert upkeep.purge_superseded(spark, live, 0) and ids(spark, live) == [1, 2, 3, 4, 5]
    revisions.drop_all_revisions(spark, live)
    assert not tables.table_exists(spark, live) and not tables.table_exists(spark, live + upkeep.OLD)
    revisions.drop_all_revisions(spark, live)


def test_compaction_is_a_revision(spark, ws):
    live = filled(spark, ws, n=1)
    tables.insert_rows(spark.range(1, 2000).repartition(9), live)
    assert upkeep.compact_files(spark, live) and not upkeep.compact_files(spark, live)
    assert [r.rows for r in revisions.revisions(spark, live)] == [2000, 2000]
    assert files.file_listing(spark, tables.location_of(spark, live)).count() == 1


def test_marks_of_the_live_state(spark, ws):
    live = filled(spark, ws)
    revisions.set_marks(spark, live, {"tablekeep.note": "plain"})
    assert tables.own_properties(spark, live)["tablekeep.note"] == "plain"
    upkeep.rebuild(spark, live, spark.range(2), {"tablekeep.note": "first"})
    revisions.set_marks(spark, live, {"tablekeep.note": "second", "tablekeep.other": "x"})
    assert tables.own_properties(spark, live)["tablekeep.note"] == "second"
    upkeep.rebuild(spark, live, spark.range(3))
    assert tables.own_properties(spark, live)["tablekeep.note"] == "second"
    revisions.restore_revision(spark, live, 1)
    assert tables.own_properties(spark, live)["tablekeep.note"] == "plain"
