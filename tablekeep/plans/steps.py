"""A job in steps that a rerun does not repeat: each step's outcome is kept under its name, with what it was made from."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tablekeep.operators.tables import (
    OWN_PROPERTY,
    create_typed_table,
    own_properties,
    remove_properties,
    set_properties,
    table_exists,
)

STEP = OWN_PROPERTY + "step."


class Steps:
    """The record of a job's steps, in the properties of a small table.

    A step is known by its name, the job's inputs and all steps before it. ``run`` gives the stored outcome of one that has
    been done from the same inputs, and else does it and stores what it returned. So a rerun after a failure goes on at the
    step that failed, and one with other inputs begins anew at the first. An action may be cut off at any point, after its
    last write too, so it must come out right when it is done again: it replaces what it finds half made.
    """

    def __init__(self, spark: SparkSession, table: str, **inputs: str):
        self.spark, self.table = spark, table
        self.digest = hashlib.sha256(json.dumps(inputs, sort_keys=True).encode()).hexdigest()
        if not table_exists(spark, table):
            create_typed_table(spark, table, StructType([StructField("step", StringType())]))

    def run(self, name: str, action: Callable[[str], dict | None]) -> dict:
        """Do a step, or not; ``action`` takes the digest that tells this run of the step from any other."""
        self.digest = hashlib.sha256(f"{self.digest}/{name}".encode()).hexdigest()
        kept = own_properties(self.spark, self.table).get(STEP + name)
        if kept is not None and json.loads(kept)["digest"] == self.digest:
            return json.loads(kept)["outcome"]
        outcome = action(self.digest) or {}
        set_properties(self.spark, self.table, {STEP + name: json.dumps({"digest": self.digest, "outcome": outcome})})
        return outcome

    def done(self) -> list[str]:
        """The names of the steps in the record."""
        return sorted(k.removeprefix(STEP) for k in own_properties(self.spark, self.table) if k.startswith(STEP))

    def forget(self) -> None:
        remove_properties(self.spark, self.table, [STEP + name for name in self.done()])
