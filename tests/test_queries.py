"""Every registered query against its SQL in DuckDB, and the plans behind the read-only ones."""

import contextlib
import io
import re

import oracle
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tablekeep.operators import tables
from tablekeep.operators.upsert import upsert_merge
from tablekeep.plans import catalog

# The training-data queries have tests of their own, which go where their subpackage goes.
QUERIES = catalog.QUERIES
SQL = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@contextlib.contextmanager
def executed_plans(spark):
    """The final plans of all that Spark executes in the block: writes, merges and streams too.

    Executions are told apart by their ids, which only grow: Spark forgets the oldest ones (conftest.py says how many it
    keeps, far more than one query has), so their number says nothing.
    """
    store, plans = spark._jsparkSession.sharedState().statusStore(), []

    def executions():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.executionsList()
        return [found.apply(i) for i in range(found.size())]

    last = max((e.executionId() for e in executions()), default=-1)
    yield plans
    plans += [e.physicalPlanDescription() for e in executions() if e.executionId() > last]


BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_sql(spark, con, key):
    with executed_plans(spark) as plans:
        df = QUERIES[key](spark, SF_DIR)
        assert oracle.differences(df, con, SQL[key]) == []
    assert plans
    for plan in [*plans, plan_of(df)]:
        assert not [word for word in BANNED if word in plan]


def test_a_nested_loop_in_a_merge_is_noticed(spark, ws):
    live = tables.create_typed_table(spark, ws.table("t"), spark.range(1).schema)
    tables.insert_rows(spark.range(5), live)
    apart = spark.range(3).alias("a").join(spark.range(3).alias("b"), F.col("a.id") < F.col("b.id")).select(F.col("a.id") + F.col("b.id") * 10)
    with executed_plans(spark) as plans:
        upsert_merge(spark, live, apart.toDF("id"), "id")
    assert any(word in plan for plan in plans for word in BANNED)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["o_orderstatus", "n", "total"]
    assert df.count() > 0


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)", plan)


def test_only_needed_columns_are_read(spark):
    assert read_schemas(plan_of(QUERIES["sum_by_key"](spark, SF_DIR))) == [
        "struct<o_orderstatus:string,o_totalprice:double>"
    ]
    assert set(read_schemas(plan_of(QUERIES["filter_range"](spark, SF_DIR)))) == {
        "struct<c_name:string,c_nationkey:int>"
    }
    # Counting needs no column, and neither does listing the files.
    assert read_schemas(plan_of(QUERIES["count_all"](spark, SF_DIR))) == ["struct<>"]
    assert read_schemas(plan_of(QUERIES["file_inventory"](spark, SF_DIR))) == ["struct<>"]


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["filter_gt"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,5000.0)]" in plan
    plan = plan_of(QUERIES["filter_range"](spark, SF_DIR))
    assert "GreaterThanOrEqual(c_nationkey,13), LessThanOrEqual(c_nationkey,19)" in plan


def test_aggregates_are_partial_before_the_exchange(spark):
    plan = plan_of(QUERIES["sum_by_key"](spark, SF_DIR))
    assert "partial_sum" in plan and plan.count("Exchange") >= 1


def test_plans_are_found_after_more_executions_than_spark_keeps(spark, ws):
    kept = int(spark.conf.get("spark.sql.ui.retainedExecutions"))
    for _ in range(kept + 20):
        spark.sql("SHOW DATABASES").collect()
    with executed_plans(spark) as plans:
        spark.range(5).write.parquet(ws.path("five"))
    assert len(plans) == 1 and "Range" in plans[0]
