"""The whole story as one Spark job: land, stream to bronze, define and convert tables, merge, validate, query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablekeep.operators.matching import merge_counts
from tablekeep.operators.relational import MONEY
from tablekeep.operators.revisions import drop_all_revisions
from tablekeep.operators.tables import (
    OWN_PROPERTY,
    create_external_table,
    create_table_like,
    create_typed_table,
    drop_table,
    insert_from_table,
    own_properties,
    provider_of,
)
from tablekeep.operators.upkeep import convert_format, purge_superseded, recover
from tablekeep.operators.upsert import upsert_merge
from tablekeep.plans.steps import Steps
from tablekeep.session import Workspace, col, delete_folder, qualified
from tablekeep.sources.files import JSON_TIMESTAMPS
from tablekeep.sources.landing import land_increment
from tablekeep.streaming.ingest import ingest_append

# The digest of the merge step whose rows are live.
MERGED = OWN_PROPERTY + "merged"


@dataclass(frozen=True)
class LoadReport:
    """Row counts along the way; ``check`` raises when they do not add up."""

    bronze_rows: int
    snapshot_rows: int
    increment_rows: int
    updated: int
    inserted: int
    final_rows: int

    def check(self) -> None:
        if self.bronze_rows != self.snapshot_rows + self.increment_rows:
            raise ValueError(f"bronze lost or doubled rows: {self}")
        if self.final_rows != self.snapshot_rows + self.inserted:
            raise ValueError(f"the merge lost or doubled rows: {self}")


def write_json(df: DataFrame, path: str) -> str:
    df.write.options(**JSON_TIMESTAMPS).json(path)
    return path


def totals(df: DataFrame, code: str, amount: str) -> DataFrame:
    """Rows and exact amount per code."""
    total = F.sum(col(amount).cast(MONEY)).cast("double")
    return df.groupBy(col(code)).agg(F.count("*").alias("n"), total.alias("total"))


def incremental_load(
    ws: Workspace, snapshot: str, increment: str, schema: StructType, key: str, provider: str = "orc"
) -> tuple[str, LoadReport]:
    """Load a snapshot and one increment, both JSON folders, into a table; returns its name and the row counts.

    Run again in the same workspace after a failure, it goes on at the step that failed (see ``Steps``).
    """
    spark = ws.spark
    raw, checkpoint = ws.path("raw"), ws.path("checkpoints", "bronze")
    bronze, live, raw_table, raw_new = (ws.table(name) for name in ("bronze", "live", "raw_rows", "raw_rows_new"))
    steps = Steps(
        spark, ws.table("steps"), snapshot=snapshot, increment=increment, schema=schema.json(), key=key, provider=provider
    )

    def land(source: str, name: str) -> None:
        # What a failed copy left is no increment yet, and no stream has seen it.
        delete_folder(spark, f"{raw}/{name}")
        land_increment(spark, source, raw, name)

    def define_raw() -> None:
        drop_table(spark, raw_table)
        create_external_table(spark, raw_table, schema, f"{raw}/snapshot", options=JSON_TIMESTAMPS)

    def define_new() -> None:
        drop_table(spark, raw_new)
        create_table_like(spark, raw_new, raw_table, location=f"{raw}/increment")

    def load() -> None:
        drop_all_revisions(spark, live)
        create_typed_table(spark, live, schema)
        spark.catalog.refreshTable(qualified(raw_table))
        insert_from_table(spark, live, raw_table)

    def convert() -> None:
        recover(spark, live)
        if provider_of(spark, live) != provider.lower():
            convert_format(spark, live, provider)

    def count() -> dict:
        counts = merge_counts(spark.table(qualified(live)), spark.table(qualified(raw_new)), key).first()
        return counts.asDict()

    def merge(digest: str) -> None:
        # The mark goes live with the rows, so a merge that was done is known even if that was not recorded.
        if own_properties(spark, live).get(MERGED) != digest:
            upsert_merge(spark, live, spark.table(qualified(raw_new)), key, properties={MERGED: digest})

    def report() -> dict:
        return {
            "bronze_rows": spark.table(qualified(bronze)).count(),
            "increment_rows": spark.table(qualified(raw_new)).count(),
            "final_rows": spark.table(qualified(live)).count(),
        }

    steps.run("define_raw", lambda _: define_raw())
    steps.run("land_snapshot", lambda _: land(snapshot, "snapshot"))
    steps.run("ingest_snapshot", lambda _: ingest_append(spark, raw, bronze, checkpoint, schema))
    steps.run("define_increment", lambda _: define_new())
    steps.run("land_increment", lambda _: land(increment, "increment"))
    steps.run("ingest_increment", lambda _: ingest_append(spark, raw, bronze, checkpoint, schema))
    steps.run("load", lambda _: load())
    steps.run("convert", lambda _: convert())
    counts = steps.run("count", lambda _: count())
    steps.run("merge", merge)
    steps.run("purge", lambda _: {"purged": purge_superseded(spark, live, retain_hours=0)})
    sizes = steps.run("report", lambda _: report())

    found = LoadReport(
        snapshot_rows=counts["n_updated"] + counts["n_kept"],
        updated=counts["n_updated"],
        inserted=counts["n_inserted"],
        **sizes,
    )
    found.check()
    return live, found
