"""Every training-data query against its SQL, and over tables with nothing in them."""

import os

import oracle
import pytest
from conftest import SF_DIR

from tablekeep.llm import queries

TABLES = ("documents", "benchmark", "labels", "conversations", "embeddings", "pages")
SMALL = os.path.join(os.path.dirname(SF_DIR), "sf0.001")


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_matches_sql(spark, monkeypatch, key):
    monkeypatch.setattr(oracle, "TABLES", TABLES)
    df = queries.QUERIES[key](spark, SMALL)
    assert oracle.differences(df, oracle.connect(SMALL), queries.ORACLES[key]) == []


@pytest.mark.parametrize("key", sorted(queries.QUERIES))
def test_empty_tables(spark, tmp_path, key):
    for name in TABLES:
        spark.read.parquet(f"{SMALL}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    rows = queries.QUERIES[key](spark, str(tmp_path)).collect()
    assert [r["conv_id"] for r in rows] == [-7] if key.startswith("op3_") else rows == []


def test_decontamination_is_native(spark):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        queries.QUERIES["op2_decontamination"](spark, SMALL).explain()
    assert "Python" not in out.getvalue() and "Arrow" not in out.getvalue()
