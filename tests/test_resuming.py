"""Copies and jobs that break off: what a rerun repeats, what it does not, and that the result is the same. Functions."""

import collections
import os

import pytest
from pyspark.sql.types import DoubleType
from test_matching import bag

from tablekeep.functions import scalars
from tablekeep.operators import tables
from tablekeep.plans import jobs
from tablekeep.plans.steps import Steps
from tablekeep.session import Workspace, qualified
from tablekeep.sources import landing

# ---- landing


def lines_of(spark, folder):
    found = spark.read.options(lineSep="\n", recursiveFileLookup="true").text(folder)
    return collections.Counter(r.value for r in found.collect())


def source(ws, names, lines=("ü 1", "", "  two\t", "car\rriage", "ü 1")):
    os.makedirs(ws.path("source"), exist_ok=True)
    for name in names:
        with open(f"{ws.path('source')}/{name}.json", "w", newline="") as out:
            out.write("\n".join(f"{name} {x}" for x in lines) + "\n" if lines else "")


@pytest.mark.parametrize("at", ["before", "copied", "before_manifest"])
def test_a_copy_goes_on_where_it_broke_off(spark, ws, monkeypatch, at):
    source(ws, "abcdef")
    raw, manifest = ws.path("raw"), ws.path("manifest")
    original, calls = landing._land_group, []

    def third_fails(spark, sizes, target, *rest):
        calls.append(sorted(os.path.basename(p) for p in sizes))
        if len(calls) != 3:
            return original(spark, sizes, target, *rest)
        if at == "copied":
            # A half of the group's lines, as a task might leave them.
            half = spark.createDataFrame([("c ü 1", "0" * 24)], "value string, from_file string")
            half.write.mode("append").partitionBy("from_file").text(target)
        if at == "before_manifest":
            with monkeypatch.context() as inner:
                inner.setattr(landing, "MANIFEST", None)
                inner.setattr(landing.time, "time", lambda: 1 / 0)
                original(spark, sizes, target, *rest)
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(landing, "_land_group", third_fails)
        with pytest.raises((RuntimeError, ZeroDivisionError)):
            landing.land_files(spark, ws.path("source"), raw, "one", manifest, group_bytes=1)
    assert len(calls) == 3 and landing.read_manifest(spark, manifest).count() == 2
    assert landing.land_files(spark, ws.path("source"), raw, "one", manifest, group_bytes=1) == 4
    given = lines_of(spark, ws.path("source"))
    held = lines_of(spark, raw + "/one")
    if at == "copied":
        # That line lies in a folder of no source file, which the manifest does not name.
        held -= collections.Counter(["c ü 1"])
    assert held == given
    assert landing.land_files(spark, ws.path("source"), raw, "one", manifest) == 0
    entries = landing.read_manifest(spark, manifest).collect()
    assert {os.path.basename(r["source_path"]): r["n_lines"] for r in entries} == {f"{x}.json": 5 for x in "abcdef"}


def test_new_files_and_increments(spark, ws):
    source(ws, "ab")
    args = (ws.path("raw"), "one", ws.path("manifest"))
    assert landing.land_files(spark, ws.path("source"), *args) == 2
    source(ws, "c")
    source(ws, "d", lines=())
    # Spark lists no file without bytes, and there is nothing in one to land.
    assert landing.land_files(spark, ws.path("source"), *args, compression="gzip") == 1
    assert landing.land_files(spark, ws.path("source"), *args) == 0
    assert lines_of(spark, ws.path("raw") + "/one") == lines_of(spark, ws.path("source"))
    assert landing.land_files(spark, ws.path("source"), ws.path("raw"), "two", ws.path("manifest")) == 3
    found = {(r["increment"], os.path.basename(r["source_path"])): (r["n_lines"], r["bytes"]) for r in landing.read_manifest(spark, args[2]).collect()}
    assert len(found) == 6 and found["two", "a.json"] == found["one", "a.json"] and found["one", "c.json"][0] == 5


def test_a_copy_that_differs_is_not_in_the_manifest(spark, ws, monkeypatch):
    source(ws, "ab")
    original = landing._measured
    calls = []

    def other(lines, *by):
        calls.append(by)
        return original(lines, *by) if len(calls) == 1 else original(lines.limit(3), *by)

    monkeypatch.setattr(landing, "_measured", other)
    with pytest.raises(landing.IncompleteCopyError, match="has not landed whole"):
        landing.land_files(spark, ws.path("source"), ws.path("raw"), "one", ws.path("manifest"))
    assert landing.read_manifest(spark, ws.path("manifest")).count() == 0


# ---- jobs


ROWS = [(i, f"v{i}", float(i)) for i in range(40)]
CHANGED = [(3, "new", 0.5), (7, "new", 0.5), (90, "in", 1.0), (None, "no key", 2.0)]
STEPS = "define_raw land_snapshot ingest_snapshot define_increment land_increment ingest_increment load convert count merge purge report".split()


def inputs(spark, ws):
    schema = spark.createDataFrame([], "id bigint, v string, x double").schema
    for name, rows in (("snapshot", ROWS), ("increment", CHANGED)):
        jobs.write_json(spark.createDataFrame(rows, schema).coalesce(2), ws.path("in", name))
    return ws.path("in", "snapshot"), ws.path("in", "increment"), schema, "id"


def expected():
    kept = [r for r in ROWS if r[0] not in (3, 7)]
    return collections.Counter(kept + CHANGED)


def test_a_job_goes_on_at_the_step_that_failed(spark, ws, monkeypatch):
    """Every step fails once when its work is done and not recorded, one after the other, in one workspace."""
    args, failed, ran = inputs(spark, ws), set(), []
    original = Steps.run

    def run(self, name, action):
        def failing(digest):
            ran.append(name)
            out = action(digest)
            if name not in failed:
                failed.add(name)
                raise RuntimeError(f"lost in {name}")
            return out

        return original(self, name, failing)

    monkeypatch.setattr(Steps, "run", run)
    for name in STEPS:
        with pytest.raises(RuntimeError, match=name):
            jobs.incremental_load(ws, *args)
    live, report = jobs.incremental_load(ws, *args)
    assert bag(spark.table(qualified(live))) == expected()
    assert (report.bronze_rows, report.snapshot_rows, report.increment_rows) == (44, 40, 4)
    assert (report.updated, report.inserted, report.final_rows) == (2, 2, 42)
    # Each step was done twice: the time that failed and the next, and never again.
    assert ran == [name for name in STEPS for _ in range(2)]
    again = jobs.incremental_load(ws, *args)
    assert again == (live, report) and len(ran) == 2 * len(STEPS)
    assert tables.provider_of(spark, live) == "orc"


@pytest.mark.parametrize("step, function", [("land", "land_increment"), ("load", "insert_from_table"), ("merge", "upsert_merge"), ("convert", "convert_format")])
def test_a_step_cut_off_in_the_middle_is_done_again(spark, ws, monkeypatch, step, function):
    args, original = inputs(spark, ws), getattr(jobs, function)

    def halfway(*given, **kwargs):
        original(*given, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, function, halfway)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.incremental_load(ws, *args)
    live, report = jobs.incremental_load(ws, *args)
    assert bag(spark.table(qualified(live))) == expected() and report.bronze_rows == 44


def test_other_inputs_begin_anew(spark, ws):
    name, count = ws.table("steps"), []
    for inputs_of in ({"a": "1"}, {"a": "1"}, {"a": "2"}):
        steps = Steps(spark, name, **inputs_of)
        first = steps.run("one", lambda d: count.append(d) or {"n": len(count)})
        second = steps.run("two", lambda d: count.append(d))
    assert len(count) == 4 and first == {"n": 3} and second == {} and len(set(count)) == 4
    assert steps.done() == ["one", "two"]
    steps.forget()
    assert steps.done() == []


def test_a_named_workspace_is_found_again(spark, ws):
    area = Workspace(spark, name=ws.name + "_job")
    tables.create_typed_table(spark, area.table("t"), spark.range(1).schema)
    assert tables.table_exists(spark, Workspace(spark, name=ws.name + "_job").table("t"))
    area.close()


# ---- permanent functions


def test_a_permanent_function_is_seen_by_a_new_session(spark, ws):
    name = ws.table("label")
    for _ in range(2):
        scalars.create_type_label(spark, name, DoubleType())
    other = spark.newSession()
    got = other.sql(f"SELECT {qualified(name)}(x) AS a FROM VALUES (1.5D), (NULL) t(x)").collect()
    assert [r.a for r in got] == ["Type: java.lang.Double", "Type: NULL"]
    scalars.drop_function(spark, name)
    scalars.drop_function(spark, name)
    with pytest.raises(Exception, match="(?i)routine|function"):
        other.sql(f"SELECT {qualified(name)}(1.5D)").collect()


# ---- checks per load


def test_checks_of_loads_add_up(spark, ws):
    checks = ws.table("checks")
    loads = {"a": [1, 2, 2, None], "b": [2, 3], "empty": [], "nulls": [None, None], "it's": list(range(5000))}
    for name, keys in loads.items():
        df = spark.createDataFrame([(k,) for k in keys], "k bigint")
        for _ in range(2):
            tables.check_load(df, "k", checks, name)
    held = {r["load"]: (r["n_rows"], r["n_null_key"]) for r in spark.table(qualified(checks)).collect()}
    assert held == {"a": (4, 1), "b": (2, 0), "empty": (0, 0), "nulls": (2, 2), "it's": (5000, 0)}
    total = tables.checked_total(spark, checks).first()
    assert (total["n_rows"], total["n_null_key"]) == (5008, 3) and abs(total["distinct_keys"] - 5000) < 250
    whole = spark.createDataFrame([(k,) for keys in loads.values() for k in keys], "k bigint")
    tables.check_load(whole, "k", ws.table("whole"), "all")
    once = tables.checked_total(spark, ws.table("whole")).first()
    # Sketches that were merged estimate by other means than those that were not.
    assert once[:2] == total[:2] and abs(once["distinct_keys"] - total["distinct_keys"]) < 100
