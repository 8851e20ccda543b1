"""Revisions of an unpartitioned table: every rebuild lies in a folder of its own, and one catalog step makes it the live one.

A rebuild writes its rows into a new folder beside the table's and then sets the table's location to it. So a reader always
finds the table, in its former state or its new one, and a query under way still has the files it began with. The list of
revisions (folder, rows, times, marks) is kept in table properties, one per revision:

* an entry is made before its folder is written, so a rebuild that failed is known and its files are purged in time;
* marks, such as the id of the last batch merged, are part of the entry. Those of the revision whose folder is the table's
  location are the ones that count, so rows and marks go live in the same step;
* ``<table>_OLD`` is an external table over the revision before the live one, for whoever wants to look at it.

Nothing is left to repair after a failure: until its location is set a table is as it was, and from then on it is as it
should be. Partitions have locations of their own in the catalog, so partitioned tables are published by renames instead.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tablekeep.operators.tables import (
    OWN_PROPERTY,
    REVISION,
    create_table_like,
    drop_table,
    insert_rows,
    location_of,
    own_properties,
    remove_properties,
    set_properties,
    settable_properties,
    table_exists,
)
from tablekeep.session import delete_folder, qualified, text_literal

log = logging.getLogger(__name__)

# Name endings of the superseded and of the rebuilt table.
OLD = "_OLD"
NEW = "_NEW"

SUPERSEDED_AT = OWN_PROPERTY + "superseded_at"


@dataclass(frozen=True)
class Revision:
    """A state of a table. ``rows`` is None while its folder is being written; times are in seconds."""

    number: int
    folder: str
    rows: int | None
    made_at: int
    superseded_at: int | None
    marks: dict[str, str]

    @property
    def property_name(self) -> str:
        return f"{REVISION}{self.number:06d}"

    def stored(self) -> dict[str, str]:
        return {self.property_name: json.dumps(asdict(self), sort_keys=True)}


def revisions(spark: SparkSession, table: str) -> list[Revision]:
    """All revisions known, oldest first; none for a table that has not been rebuilt yet."""
    found = settable_properties(spark, table)
    return [Revision(**json.loads(v)) for k, v in sorted(found.items()) if k.startswith(REVISION)]


def live_revision(spark: SparkSession, table: str) -> Revision | None:
    at = location_of(spark, table)
    return next((r for r in revisions(spark, table) if r.folder == at), None)


def list_revisions(spark: SparkSession, table: str) -> DataFrame:
    """The revision list as rows, with which of them is live."""
    at = location_of(spark, table)
    fields = [StructField("number", LongType()), StructField("folder", StringType()), StructField("n_rows", LongType())]
    fields += [StructField("made_at", LongType()), StructField("superseded_at", LongType()), StructField("state", StringType())]
    state = lambda r: "live" if r.folder == at else "unfinished" if r.rows is None else "superseded"
    rows = [(r.number, r.folder, r.rows, r.made_at, r.superseded_at, state(r)) for r in revisions(spark, table)]
    listed = spark.createDataFrame(rows, StructType(fields))
    return listed.withColumns({c: listed[c].cast(TimestampType()) for c in ("made_at", "superseded_at")})


def read_revision(spark: SparkSession, table: str, number: int) -> DataFrame:
    """The rows of one revision, whether live or not, by the columns that the table has now."""
    return spark.table(qualified(_definition(spark, table, _find(spark, table, number).folder, f"_R{number:06d}")))


def _find(spark: SparkSession, table: str, number: int) -> Revision:
    for r in revisions(spark, table):
        if r.number == number and r.rows is not None:
            return r
    raise ValueError(f"{table} has no revision {number}")


def _definition(spark: SparkSession, table: str, folder: str, ending: str) -> str:
    """An external table over a folder, in the columns, format and buckets of ``table``."""
    drop_table(spark, table + ending)
    return create_table_like(spark, table + ending, table, location=folder)


# ---- publishing


def publish_rows(
    spark: SparkSession, table: str, rows: DataFrame, marks: dict[str, str] | None = None, laid_out: bool = False
) -> Revision:
    """Write ``rows`` (in table column order) as a new revision and make it live, together with ``marks``."""
    known, now = revisions(spark, table), int(time.time())
    at, held = location_of(spark, table), own_properties(spark, table)
    before = next((r for r in known if r.folder == at), None)
    if before is None:
        # The table as it was made, or as its definition was changed from outside.
        before = Revision(_next(known), at, spark.table(qualified(table)).count(), now, None, held)
        known.append(before)
    number = _next(known)
    made = Revision(number, _folder(known[0].folder, number), None, now, None, {**held, **(marks or {})})
    set_properties(spark, table, {**before.stored(), **made.stored()})

    staged = _definition(spark, table, made.folder, NEW)
    # As the catalog writes it, to be compared with the table's location.
    made = replace(made, folder=location_of(spark, staged))
    insert_rows(rows, staged, laid_out)
    made = replace(made, rows=spark.table(qualified(staged)).count(), made_at=int(time.time()))
    _switch(spark, table, before, made)
    drop_table(spark, staged)
    return made


def restore_revision(spark: SparkSession, table: str, number: int) -> Revision:
    """Make an earlier revision live again, with the marks it had; the present one stays in the list."""
    wanted, now = _find(spark, table, number), live_revision(spark, table)
    if now is None:
        raise ValueError(f"the present state of {table} is not in its list of revisions")
    if wanted.folder != now.folder:
        _switch(spark, table, now, replace(wanted, superseded_at=None))
    return wanted


def _next(known: Iterable[Revision]) -> int:
    return 1 + max((r.number for r in known), default=0)


def _folder(first: str, number: int) -> str:
    """Beside the folder that the table began with; the time keeps apart what tables of one name, made anew, leave behind."""
    return f"{first.rstrip('/')}_r{number:06d}_{time.time_ns():x}"


def _switch(spark: SparkSession, table: str, before: Revision, after: Revision) -> None:
    """The list first, which counts for nothing until the location is set in the one step that readers see."""
    superseded = replace(before, superseded_at=int(time.time()))
    set_properties(spark, table, {**superseded.stored(), **after.stored()})
    spark.sql(f"ALTER TABLE {qualified(table)} SET LOCATION {text_literal(after.folder)}")
    spark.catalog.refreshTable(qualified(table))
    old = _definition(spark, table, before.folder, OLD)
    set_properties(spark, old, {SUPERSEDED_AT: str(superseded.superseded_at)})


def set_marks(spark: SparkSession, table: str, marks: dict[str, str]) -> None:
    """Set own properties of the state that is live now."""
    live = live_revision(spark, table)
    changed = replace(live, marks={**live.marks, **marks}).stored() if live else {}
    set_properties(spark, table, {**marks, **changed})


# ---- retention


def purge_revisions(spark: SparkSession, table: str, retain_hours: float = 168) -> list[int]:
    """Delete the revisions superseded, or begun and never published, for so long; the live one always stays.

    Not beside a rebuild of the table, whose folder a short retention would take away.
    """
    at, now = location_of(spark, table), time.time()
    gone = []
    for r in revisions(spark, table):
        since = r.made_at if r.superseded_at is None else r.superseded_at
        if r.folder == at or now - since < retain_hours * 3600:
            continue
        delete_folder(spark, r.folder)
        gone.append(r)
    if gone:
        remove_properties(spark, table, [r.property_name for r in gone])
        old = table + OLD
        if table_exists(spark, old) and location_of(spark, old) in {r.folder for r in gone}:
            drop_table(spark, old)
    return [r.number for r in gone]


def end_revisions(spark: SparkSession, table: str) -> None:
    """Keep the live state alone, its marks as plain properties: for changes that no list can go on across."""
    held, at = own_properties(spark, table), location_of(spark, table)
    known = revisions(spark, table)
    for r in known:
        if r.folder != at:
            delete_folder(spark, r.folder)
    if known:
        remove_properties(spark, table, [r.property_name for r in known])
        set_properties(spark, table, held)


def drop_all_revisions(spark: SparkSession, table: str) -> None:
    """Drop a table with all its revisions; DROP TABLE by itself deletes the live folder at most."""
    if not table_exists(spark, table):
        return
    folders = [r.folder for r in revisions(spark, table)]
    drop_table(spark, table + OLD)
    drop_table(spark, table)
    for folder in folders:
        delete_folder(spark, folder)
