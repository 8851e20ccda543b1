"""Table definition, publishing, conversion, compaction and purging; the loan story in batch."""

import collections

import loans
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F
from test_queries import executed_plans, plan_of

from tablekeep.operators import relational, tables, upkeep
from tablekeep.operators.matching import merged_rows
from tablekeep.operators.upsert import upsert_merge, upsert_rewrite
from tablekeep.schemas import BRONZE_TRANSACTIONS, TRANSACTIONS
from tablekeep.session import Workspace, qualified, shared_dir
from tablekeep.sources import files

N = 200


def read(spark, name):
    return spark.table(qualified(name))


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def filled(ws, name, df, provider="parquet", **how):
    made = tables.create_typed_table(ws.spark, ws.table(name), df.schema, provider, **how)
    tables.insert_rows(df, made)
    return made


@pytest.fixture
def story(spark, ws):
    """Raw JSON tables of snapshot and increment, the Parquet copy and the typed copy."""
    loans.snapshot(spark, N).write.json(ws.path("raw"))
    loans.increment(spark, N).write.json(ws.path("raw_new"))
    raw = tables.create_external_table(spark, ws.table("raw"), TRANSACTIONS, ws.path("raw"))
    raw_new = tables.create_table_like(spark, ws.table("raw_new"), raw, location=ws.path("raw_new"))
    parquet = tables.create_table_like(spark, ws.table("parquet"), raw, provider="parquet")
    tables.insert_from_table(spark, parquet, raw)
    typed = tables.create_typed_table(spark, ws.table("typed"), TRANSACTIONS)
    tables.insert_from_table(spark, typed, parquet)
    return raw, raw_new, parquet, typed


def test_schema_has_the_23_columns():
    assert len(TRANSACTIONS) == 23 and len(BRONZE_TRANSACTIONS) == 25
    assert TRANSACTIONS["id"].dataType.simpleString() == "float"
    assert sum(f.dataType.simpleString() == "float" for f in TRANSACTIONS.fields) == 10


def test_copies_hold_the_raw_rows(spark, story):
    raw, raw_new, parquet, typed = story
    expected = bag(loans.snapshot(spark, N))
    for name in (raw, parquet, typed):
        assert bag(read(spark, name)) == expected
    assert relational.count_all(read(spark, raw_new)).first()["n"] == 3
    assert tables.provider_of(spark, raw_new) == "json" and tables.provider_of(spark, parquet) == "parquet"


@pytest.mark.parametrize("how", [upsert_rewrite, upsert_merge])
@pytest.mark.parametrize("limit", [None, 0])
def test_upserts_update_two_and_insert_one(spark, story, how, limit):
    _, raw_new, parquet, _ = story
    before = bag(read(spark, parquet))
    for _ in range(2):
        how(spark, parquet, read(spark, raw_new), "id", limit)
        live = read(spark, parquet)
        assert live.count() == N + 1
        assert {r["id"] for r in live.where("status = 'changed'").collect()} == {1.0, 2.0, float(N)}
    assert sum((before & bag(live)).values()) == N - 2
    assert bag(read(spark, parquet + upkeep.OLD)) == bag(live)


def test_sum_per_country(spark, story):
    raw = story[0]
    got = {r["country_code"]: r["total"] for r in relational.sum_by_key(read(spark, raw), "country_code", "balance").collect()}
    expected = collections.Counter()
    for k in range(N):
        expected[loans.COUNTRIES[k % 4]] += k * 10 if k % 7 else 0
    assert got == expected


def test_spot_check(spark):
    df = spark.sql("select * from values (1), (1), (null) t(id)")
    assert tuple(tables.spot_check(df, "id").first()) == (3, 1, 1)


# ---- positional insert


def test_positional_insert_is_checked(spark, ws, caplog):
    made = filled(ws, "t", spark.sql("select 1 as a, 'x' as b"))
    with pytest.raises(ValueError, match="by position"):
        tables.insert_rows(spark.sql("select 1 as a"), made)
    with pytest.raises(TypeError, match="column 1"):
        tables.insert_rows(spark.sql("select 'x' as b, 1 as a"), made)
    with caplog.at_level("WARNING"):
        tables.insert_rows(spark.sql("select 2 as c, 'y' as b"), made)
    assert "c fills a" in caplog.text
    assert bag(read(spark, made)) == {(1, "x"): 1, (2, "y"): 1}


# ---- namespaces


def test_namespace(spark, ws):
    name = tables.create_namespace(spark, ws.name + "_ns", ws.path("ns"))
    before = spark.catalog.currentDatabase()
    with tables.using_namespace(spark, name):
        assert spark.catalog.currentDatabase() == name
        tables.create_typed_table(spark, "t", TRANSACTIONS)
        tables.drop_table(spark, "t")
        tables.drop_table(spark, "t")
    assert spark.catalog.currentDatabase() == before
    spark.sql(f"drop database {name} cascade")
    assert tables.user_namespace(spark).replace("_", "a").isalnum()


# ---- rename-swap


def test_half_done_publish_is_undone(spark, ws):
    live = filled(ws, "t", spark.range(5).toDF("id"))
    spark.sql(f"alter table {live} rename to {live}{upkeep.OLD}")
    assert upkeep.recover(spark, live)
    assert read(spark, live).count() == 5
    assert not upkeep.recover(spark, live)
    # An upsert that finds the half-done state starts from the former rows.
    spark.sql(f"alter table {live} rename to {live}{upkeep.OLD}")
    upsert_merge(spark, live, spark.range(3, 7).toDF("id"), "id")
    assert sorted(r.id for r in read(spark, live).collect()) == list(range(7))


def test_left_over_rebuilt_table_is_replaced(spark, ws):
    live = filled(ws, "t", spark.range(5).toDF("id"))
    filled(ws, "t" + upkeep.NEW, spark.range(99).toDF("id"))
    upsert_rewrite(spark, live, spark.range(4, 6).toDF("id"), "id")
    assert sorted(r.id for r in read(spark, live).collect()) == list(range(6))


def test_purge(spark, ws):
    live = filled(ws, "t", spark.range(5).toDF("id"))
    assert not upkeep.purge_superseded(spark, live, 0)
    upsert_merge(spark, live, spark.range(4, 6).toDF("id"), "id")
    old = live + upkeep.OLD
    assert not upkeep.purge_superseded(spark, live)
    assert tables.table_exists(spark, old)
    assert upkeep.purge_superseded(spark, live, 0)
    assert not tables.table_exists(spark, old) and read(spark, live).count() == 6
    spark.sql(f"alter table {live} rename to {old}")
    with pytest.raises(ValueError, match="only one"):
        upkeep.purge_superseded(spark, live, 0)


def test_rebuild_keeps_partitions_and_own_properties(spark, ws):
    df = spark.range(20).selectExpr("id", "cast(id % 3 as int) as p")
    live = filled(ws, "t", df, partition_by=["p"])
    tables.set_properties(spark, live, {"tablekeep.note": "kept"})
    upsert_merge(spark, live, spark.range(18, 25).selectExpr("id", "cast(7 as int) as p"), "id")
    assert tables.partition_columns(spark, live) == ["p"]
    assert tables.own_properties(spark, live)["tablekeep.note"] == "kept"
    assert bag(read(spark, live)) == collections.Counter([(i, i % 3) for i in range(18)] + [(i, 7) for i in range(18, 25)])


# ---- merging into the touched partitions only


@pytest.fixture
def parted(spark, ws):
    df = spark.range(40).selectExpr("id", "'t' as v", "cast(id % 4 as int) as p", "if(id % 8 = 0, null, 'q') as q")
    return filled(ws, "t", df, partition_by=["p", "q"]), df


def files_of(spark, name):
    rows = read(spark, name).select("p", "q", "_metadata.file_path")
    return {(r["p"], r["q"]): r["file_path"] for r in rows.collect()}


CHANGES = {
    # The increment, and whether only its partitions may be rewritten.
    "one partition": ("id in (1, 5)", "p", "id", True),
    "null partition value": ("id in (0, 8, 3)", "p", "id", True),
    "a row moves": ("id in (1, 5)", "2", "id", False),
    "null key": ("id in (1, 5)", "p", "if(id = 1, null, id)", False),
    "new key twice": ("id in (1, 5)", "p", "99", False),
}


@pytest.mark.parametrize("case", CHANGES)
@pytest.mark.parametrize("limit", [None, 0])
def test_only_touched_partitions_are_rewritten(spark, parted, case, limit):
    where, p, key, in_place = CHANGES[case]
    live, df = parted
    new = df.where("id < 2").selectExpr("id + 100 as id", "'n' as v", "1 as p", "'q' as q")
    source = df.where(where).selectExpr(f"cast({key} as bigint) as id", "'s' as v", f"cast({p} as int) as p", "q").union(new)
    before = files_of(spark, live)
    expected = bag(merged_rows(df, source, "id").select("id", "v", "p", "q"))
    upsert_merge(spark, live, source, "id", limit, {"tablekeep.note": "done"}, touched_only=True)
    assert bag(read(spark, live).select("id", "v", "p", "q")) == expected
    assert tables.own_properties(spark, live)["tablekeep.note"] == "done"
    after = files_of(spark, live)
    untouched = [k for k in before if before[k] == after.get(k)]
    assert tables.table_exists(spark, live + upkeep.OLD) != in_place
    assert bool(untouched) == in_place
    if in_place:
        # Repeating the merge, as after a failure, changes nothing.
        upsert_merge(spark, live, source, "id", limit, touched_only=True)
        assert bag(read(spark, live).select("id", "v", "p", "q")) == expected


def test_half_overwritten_partitions_are_finished(spark, parted, monkeypatch):
    live, df = parted
    source = df.where("id in (1, 5)").withColumn("v", F.lit("s")).select("id", "v", "p", "q")
    original = upkeep._overwrite_from_staged

    def fail(inner, table):
        inner.sql(f"alter table {table} drop partition (p = 1, q = 'q')")
        raise OSError("lost")

    monkeypatch.setattr(upkeep, "_overwrite_from_staged", fail)
    with pytest.raises(OSError):
        upsert_merge(spark, live, source, "id", touched_only=True)
    monkeypatch.setattr(upkeep, "_overwrite_from_staged", original)
    spark.catalog.refreshTable(live)
    assert read(spark, live).where("p = 1").count() == 0
    upsert_merge(spark, live, source, "id", touched_only=True)
    assert bag(read(spark, live).select("id", "v", "p", "q")) == bag(merged_rows(df, source, "id").select("id", "v", "p", "q"))
    assert not tables.table_exists(spark, live + upkeep.NEW)


def test_touched_merge_reads_and_writes_few_partitions(spark, ws):
    df = spark.range(1000).selectExpr("id", "'t' as v", "cast(id % 50 as int) as p")
    live = filled(ws, "t", df, partition_by=["p"])
    plan = plan_of(read(spark, live).where(tables.in_partitions(["p"], [{"p": 3}, {"p": 4}])))
    assert "PartitionFilters: [p#" in plan and "IN (3,4)" in plan
    upsert_merge(spark, live, df.where("id < 0"), "id", touched_only=True)
    assert read(spark, live).count() == 1000


# ---- conversion and compaction


@pytest.mark.parametrize("partition_by", [None, ["country_code"]])
def test_convert(spark, story, partition_by):
    parquet = story[2]
    before = loans.snapshot(spark, N)
    upkeep.convert_format(spark, parquet, "orc", partition_by)
    described = {r["col_name"]: r["data_type"] for r in tables.describe_table(spark, parquet).collect()}
    assert described["Provider"] == "orc" and described["id"] == "float"
    assert bag(read(spark, parquet).select(before.columns)) == bag(before)
    assert tables.partition_columns(spark, parquet) == (partition_by or [])


def n_files(spark, name):
    return files.file_inventory(read(spark, name)).count()


def test_compaction_keeps_rows_and_saves_files(spark, ws):
    df = loans.snapshot(spark, N)
    live = filled(ws, "t", df.repartition(30))
    assert n_files(spark, live) == 30
    assert upkeep.compact_files(spark, live)
    assert n_files(spark, live) == 1
    assert bag(read(spark, live)) == bag(df)
    assert not upkeep.compact_files(spark, live)


def test_compaction_to_a_size_does_not_shuffle(spark, ws):
    df = spark.range(0, 400_000, 1, 40).selectExpr("id", "cast(rand(3) as string) as v")
    live = filled(ws, "t", df)
    size = sum(r["file_size"] for r in files.file_inventory(read(spark, live)).collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert upkeep.compact_files(spark, live, size // 5)
    assert 5 <= n_files(spark, live) <= 8
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert read(spark, live).select(F.count_distinct("id")).first()[0] == 400_000


def test_compaction_of_a_partitioned_table(spark, ws):
    df = spark.range(0, 900, 1, 10).selectExpr("id", "cast(id % 3 as int) as p")
    live = tables.create_typed_table(spark, ws.table("t"), df.schema, partition_by=["p"])
    df.write.insertInto(qualified(live))
    assert n_files(spark, live) == 30
    assert upkeep.compact_files(spark, live)
    assert n_files(spark, live) == 3
    assert bag(read(spark, live)) == bag(df)
    assert not upkeep.compact_files(spark, live)


def test_compaction_rewrites_only_ragged_partitions(spark, ws):
    """A null partition value and two columns among them; a full partition is cut into files of the wanted size."""
    schema = spark.createDataFrame([], "id bigint, v string, p int, q string").schema
    live = tables.create_typed_table(spark, ws.table("t"), schema, partition_by=["p", "q"])
    rows = spark.range(0, 60_000, 1, 12).selectExpr("id", "cast(rand(3) as string) as v", "cast(nullif(id % 2, 0) as int) as p", "'x' as q")
    rows.write.insertInto(qualified(live))
    spark.sql("select 7L as id, 'v' as v, 5 as p, 'y' as q").write.insertInto(qualified(live))
    expected = bag(read(spark, live))
    single = [r.file_path for r in files.file_inventory(read(spark, live).where("p = 5")).collect()]
    size = sum(r.file_size for r in files.file_inventory(read(spark, live).where("p = 1")).collect())
    ragged = [Row(p=p, q="x", __files=3) for p in (1, None)]
    assert "PartitionFilters: [isnotnull(q" in plan_of(upkeep._laid_out(spark, live, ["p", "q"], ragged))
    assert upkeep.compact_files(spark, live, size // 3)
    assert [r.file_path for r in files.file_inventory(read(spark, live).where("p = 5")).collect()] == single
    for condition in ("p = 1", "p is null"):
        found = files.file_inventory(read(spark, live).where(condition)).collect()
        assert 2 <= len(found) <= 3 and max(r.n_rows for r in found) < 1.1 * 30_000 * 2 / 3
    assert bag(read(spark, live)) == expected
    assert not upkeep.compact_files(spark, live, size // 3)


def test_compaction_of_a_partitioned_table_sorts_nothing(spark, ws):
    """Spark would sort a task's rows by partition before it writes them: a file's rows in memory. A task per file needs none."""
    df = spark.range(0, 9000, 1, 6).selectExpr("id", "cast(nullif(id % 5, 0) as int) as p")
    live = tables.create_typed_table(spark, ws.table("t"), df.schema, partition_by=["p"])
    df.write.insertInto(qualified(live))
    with executed_plans(spark) as plans:
        assert upkeep.compact_files(spark, live)
    assert n_files(spark, live) == 5 and bag(read(spark, live)) == bag(df)
    writes = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p]
    assert len(writes) == 2 and not [p for p in writes if "Sort" in p]


def test_compaction_keeps_an_external_table_external(spark, ws):
    spark.range(0, 90, 1, 9).write.parquet(ws.path("outside"))
    name = tables.create_external_table(spark, ws.table("ext"), spark.range(1).schema, ws.path("outside"), "parquet")
    assert upkeep.compact_files(spark, name)
    assert tables.is_external(spark, name) and n_files(spark, name) == 1 and spark.table(name).count() == 90


def test_a_condition_on_thousands_of_partitions(spark):
    wanted = [Row(p=i, q=None if i % 2 else str(i)) for i in range(5000)]
    given = spark.range(10_000).selectExpr("cast(id as int) as p", "if(id % 2 = 1, null, cast(id as string)) as q")
    assert tables.only_partitions(given, ["p", "q"], wanted).count() == 5000
    assert tables.only_partitions(given, ["p", "q"], wanted[:3] + [Row(p=9, q="9")]).count() == 3


@pytest.mark.parametrize("upsert", [upsert_merge, upsert_rewrite])
def test_an_increment_is_computed_once(spark, ws, upsert):
    live = filled(ws, "t", spark.range(10).selectExpr("id", "'a' as v"))
    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(i):
        computed.add(1)
        return str(i)

    upsert(spark, live, spark.range(5, 15, 1, 2).select("id", counted("id").alias("v")), "id")
    assert computed.value == 10 and read(spark, live).count() == 15


def test_show_create_is_runnable(spark, story):
    ddl = tables.show_ddl(spark, story[3])
    assert "`imit_amount`" in ddl or "imit_amount FLOAT" in ddl
    spark.sql(ddl.replace(".typed ", ".twin ", 1))
    assert read(spark, story[3].replace(".typed", ".twin")).schema == TRANSACTIONS


def test_hive_ddl_falls_back_without_hive(spark, ws, caplog):
    with caplog.at_level("WARNING"):
        made = tables.create_hive_table(spark, ws.table("t"), TRANSACTIONS)
    assert "USING PARQUET" in caplog.text and tables.provider_of(spark, made) == "parquet"


def test_lake_commands_are_not_for_parquet(spark, ws):
    live = filled(ws, "t", spark.range(5).toDF("id"))
    assert not upkeep.is_lake_table(spark, live)


# ---- session


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named


def test_workspace_close(spark):
    area = Workspace(spark)
    made = filled(area, "t", spark.range(3).toDF("id"))
    area.close()
    with pytest.raises(AnalysisException):
        spark.table(made)


def test_lookups_are_not_fooled_by_column_names(spark, ws):
    made = tables.create_typed_table(
        spark, ws.table("odd"), spark.createDataFrame([], "Location string, Provider string, p int").schema, partition_by=["p"]
    )
    assert tables.provider_of(spark, made) == "parquet"
    assert tables.location_of(spark, made).endswith("odd")
    assert [r["col_name"] for r in tables.describe_table(spark, made).collect()] == ["Location", "Provider", "p", "Provider"]


def test_conversion_and_rebuild_keep_the_table(spark, ws):
    name = ws.table("kept")
    spark.sql(f"create table {name} (id bigint comment 'the key', p int) using parquet partitioned by (p) comment 'told' tblproperties ('mine' = 'x')")
    tables.insert_rows(spark.range(6).selectExpr("id", "cast(id % 2 as int) as p"), name)
    upkeep.convert_format(spark, name, "orc")
    upsert_merge(spark, name, spark.sql("select 9L as id, 1 as p"), "id")
    assert tables.partition_columns(spark, name) == ["p"] and tables.provider_of(spark, name) == "orc"
    assert tables.settable_properties(spark, name)["mine"] == "x" and tables.comment_of(spark, name) == "told"
    assert spark.table(name).schema["id"].metadata.get("comment") == "the key"
    assert spark.table(name).count() == 7


def test_a_merge_keeps_an_external_table_external(spark, ws):
    spark.range(5).write.parquet(ws.path("outside"))
    name = tables.create_external_table(spark, ws.table("ext"), spark.range(1).schema, ws.path("outside"), "parquet")
    upsert_merge(spark, name, spark.range(4, 7), "id")
    assert tables.is_external(spark, name) and spark.table(name).count() == 7
