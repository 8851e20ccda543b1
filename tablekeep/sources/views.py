"""SQL over registered DataFrames: session views and cross-session global views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablekeep.session import quote


def query_temp_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` as ``view`` in its session and run ``sql`` there."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)


def query_global_view(df: DataFrame, view: str, sql: str, session: SparkSession | None = None) -> DataFrame:
    """Register ``df`` as ``global_temp.view`` and run ``sql`` in another session (a new one by default)."""
    df.createOrReplaceGlobalTempView(view)
    return (session or df.sparkSession.newSession()).sql(sql)


def drop_view(spark: SparkSession, view: str, is_global: bool = False) -> None:
    """Forget a view; results already defined over it stay valid."""
    if is_global:
        spark.catalog.dropGlobalTempView(view)
    else:
        spark.sql(f"DROP VIEW IF EXISTS {quote(view)}")
