"""A stream whose schema changes: nothing is lost, replays change nothing, the log says what was when. Running totals."""

import collections
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablekeep.operators import tables
from tablekeep.session import qualified
from tablekeep.streaming import evolving, ingest, totals


@pytest.fixture
def raw(spark, ws):
    count = [0]

    def add(*lines):
        path = f"{ws.path('raw')}/{count[0]}"
        count[0] += 1
        texts = [x if isinstance(x, str) else json.dumps(x) for x in lines]
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(path)

    return add


def run(spark, ws, **bounds):
    evolving.ingest_evolving(spark, ws.path("raw"), ws.table("bronze"), ws.path("cp"), ws.path("schemas"), **bounds)


def rows(spark, ws, *names):
    found = spark.table(qualified(ws.table("bronze")))
    return collections.Counter(tuple(r) for r in found.select(*names, evolving.RESCUED).collect())


def test_new_fields_and_wider_types_lose_nothing(spark, ws, raw):
    raw({"id": 1, "n": 5}, {"id": 2, "n": None})
    run(spark, ws)
    raw({"id": 3, "n": 2.5, "tag": "new"}, {"id": 4, "extra": {"a": 1}})
    run(spark, ws)
    raw({"id": "five", "n": 1}, {"id": 6, "extra": {"a": "text", "b": 2}}, {"id": 7, "tag": 8}, "no json", '["a"]', "  ", "")
    run(spark, ws)
    run(spark, ws)
    five, six = '{"id": "five", "n": 1}', '{"id": 6, "extra": {"a": "text", "b": 2}}'
    found = rows(spark, ws, "id", "n", "tag", "extra.a", "extra.b")
    assert found == collections.Counter(
        [
            (1, 5.0, None, None, None, None),
            (2, None, None, None, None, None),
            (3, 2.5, "new", None, None, None),
            (4, None, None, 1, None, None),
            (None, 1.0, None, None, None, five),
            (6, None, None, None, 2, six),
            (7, None, "8", None, None, None),
            (None, None, None, None, None, "no json"),
            (None, None, None, None, None, '["a"]'),
        ]
    )
    log = evolving.SchemaLog(spark, ws.path("schemas")).all()
    assert [[f.name + " " + f.dataType.simpleString() for f in s.fields] for s in log] == [
        ["id bigint", "n bigint"],
        ["id bigint", "n double", "extra struct<a:bigint>", "tag string"],
        ["id bigint", "n double", "extra struct<a:bigint,b:bigint>", "tag string"],
    ]
    # What was stored before is not rewritten: each schema has a table of its own.
    counts = [spark.table(qualified(f"{ws.table('bronze')}_G{n}")).count() for n in range(3)]
    assert counts == [2, 2, 5]


def test_names_that_differ_in_case_and_large_numbers_are_rescued(spark, ws, raw):
    raw({"a": 1, "x": 0.5})
    run(spark, ws)
    big, other = '{"a": 2, "x": 9007199254740993}', '{"A": 3}'
    raw(big, other, {"A": None, "a": 4}, {"b": {}, "a": 5}, {"c": [], "a": 6}, {"d": None, "a": 7})
    run(spark, ws)
    found = {r["a"]: r[evolving.RESCUED] for r in spark.table(qualified(ws.table("bronze"))).collect()}
    assert found[1] is None and found[2] == big and found[None] == other and found[4] is None and found[7] is None
    assert found[5] == '{"b": {}, "a": 5}' and found[6] == '{"c": [], "a": 6}'


def test_first_batch_without_a_field(spark, ws, raw):
    run_empty = lambda: run(spark, ws)
    raw("nothing", "at all")
    run_empty()
    raw({"id": 1})
    run_empty()
    assert rows(spark, ws, "id") == collections.Counter([(None, "nothing"), (None, "at all"), (1, None)])


@pytest.mark.parametrize("at", ["log", "rows", "view"])
def test_a_replayed_batch_changes_nothing(spark, ws, raw, monkeypatch, at):
    raw({"id": 1})
    run(spark, ws)
    raw({"id": 2, "more": 0.5}, {"id": "x"})

    def fails(*args, **kwargs):
        if at == "rows":
            # Half of the batch is there, and its start is marked.
            batch, batch_id, table, checkpoint = args
            original(batch.where("id is not null"), batch_id, table, checkpoint)
        raise RuntimeError("lost once")

    original = evolving.write_replaceable
    with monkeypatch.context() as patched:
        patched.setattr(evolving, {"log": "parsed_lines", "rows": "write_replaceable", "view": "show_generations"}[at], fails)
        with pytest.raises(Exception, match="lost once"):
            run(spark, ws)
    for _ in range(2):
        run(spark, ws)
        assert rows(spark, ws, "id", "more") == collections.Counter([(1, None, None), (2, 0.5, None), (None, None, '{"id": "x"}')])
    assert len(evolving.SchemaLog(spark, ws.path("schemas")).all()) == 2


def test_any_split_into_batches_holds_every_line(spark, ws, raw):
    lines = [{"id": i, "v": [i, i + 0.5, str(i), {"in": i}][i % 4]} for i in range(24)]
    for i in range(6):
        raw(*lines[i * 4 : i * 4 + 4])
    run(spark, ws, max_files=1)
    found = spark.table(qualified(ws.table("bronze"))).select("id", F.to_json(F.struct("v")).alias("v"), evolving.RESCUED).collect()
    assert sorted(r["id"] for r in found) == list(range(24))
    for r in found:
        held = json.loads(r[evolving.RESCUED])["v"] if r[evolving.RESCUED] else json.loads(r["v"])["v"]
        given = lines[r["id"]]["v"]
        assert held == given or json.loads(held) == given or held == json.dumps(given, separators=(",", ":"))


def merged(known, found):
    return evolving.merged_schema(StructType.fromDDL(known), StructType.fromDDL(found)).simpleString()


@pytest.mark.parametrize(
    "known, found, expected",
    [
        ("a int", "a bigint, b string", "struct<a:bigint,b:string>"),
        ("a bigint", "a double", "struct<a:double>"),
        ("a double", "a bigint", "struct<a:double>"),
        ("a bigint", "a string", "struct<a:bigint>"),
        ("a string", "a bigint", "struct<a:string>"),
        ("a boolean", "A int", "struct<a:boolean>"),
        ("a struct<x:int>", "a struct<y:int,x:double>", "struct<a:struct<x:double,y:int>>"),
        ("a array<int>", "a array<double>", "struct<a:array<double>>"),
        ("a array<int>", "a int", "struct<a:array<int>>"),
        ("a array<struct<x:int>>", "a array<struct<y:string>>", "struct<a:array<struct<x:int,y:string>>>"),
        ("a map<string,int>", "a map<string,bigint>", "struct<a:map<string,bigint>>"),
        ("a void", "a int", "struct<a:int>"),
        ("a int", "a void, b void", "struct<a:int>"),
    ],
)
def test_merge_rule(known, found, expected):
    assert merged(known, found) == expected


def test_widened_values(spark):
    have = StructType.fromDDL("s struct<x:int,`y z`:string>, a array<struct<x:int>>, m map<string,array<int>>, n int")
    want = StructType.fromDDL("s struct<x:double,`y z`:string,n:int>, a array<struct<x:bigint,t:string>>, m map<string,array<double>>, n bigint, o string")
    rows = [((1, "t"), [(2,), None], {"k": [3, None]}, 4), (None, None, None, None)]
    by_name = {f.name: f.dataType for f in have.fields}
    columns = [f"{evolving.widened_sql(f.name, by_name.get(f.name), f.dataType)} AS {f.name}" for f in want.fields]
    got = spark.createDataFrame(rows, have).selectExpr(*columns)
    assert got.schema.simpleString() == want.simpleString()
    assert [tuple(r) for r in got.collect()] == [((1.0, "t", None), [(2, None), None], {"k": [3.0, None]}, 4, None), (None,) * 5]


# ---- totals


SCHEMA = "k string, x double"


def test_totals_follow_the_stream_through_replays_folds_and_late_files(spark, ws, monkeypatch):
    kept, schema = ws.table("totals"), StructType.fromDDL(SCHEMA)
    given = []

    def add(name, *part):
        given.extend(part)
        spark.createDataFrame(part, SCHEMA).write.json(f"{ws.path('raw')}/{name}")

    def run():
        totals.ingest_totals(spark, ws.path("raw"), kept, ws.path("cp"), schema, "k", "x")

    def check():
        expected = {}
        for k, x in given:
            t, n = expected.get(k, (None, 0))
            expected[k] = (t if x is None else round((t or 0) + x, 2), n + 1)
        got = {r["k"]: (None if r["total"] is None else float(r["total"]), r["n_rows"]) for r in totals.running_totals(spark, kept, "k").collect()}
        assert got == expected

    add("b", ("a", 0.1), ("a", 0.2), (None, 5.0), ("n", None))
    run()
    check()
    add("c", ("a", 1.0), ("z", -2.5))
    with monkeypatch.context() as patched:

        def fails(*args):
            original(*args)
            raise RuntimeError("lost once")

        original = ingest.overwrite_batch
        patched.setattr(totals, "overwrite_batch", fails)
        with pytest.raises(Exception, match="lost once"):
            run()
    run()
    check()
    add("a_late", ("n", 3.25), ("z", 2.5))
    run()
    check()
    partials = spark.table(qualified(kept))
    assert partials.select("batch_id").distinct().count() == 3
    for _ in range(2):
        totals.fold_totals(spark, kept, "k")
        check()
        found = {r["batch_id"] for r in spark.table(qualified(kept)).select("batch_id").distinct().collect()}
        assert len(found) == 2 and totals.FOLDED in found
    add("d", ("a", 7.0))
    run()
    check()
    totals.fold_totals(spark, kept, "k")
    check()
    # One row per key and batch, whatever the rows that came.
    assert spark.table(qualified(kept)).count() == 5 and tables.partition_columns(spark, kept) == ["batch_id"]
