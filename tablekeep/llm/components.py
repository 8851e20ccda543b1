"""Connected components of an edge table by alternating large-star and small-star steps, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeep.llm.common import settled
from tablekeep.session import Workspace


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def component_roots(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """``u, v``: each node of ``edges`` (long columns ``u``, ``v``) but the smallest of its component, with that smallest.

    Only a count and a checksum per step come to the driver. A hub's edges are reduced to their minimum before the
    shuffle, and the joins are ones that AQE can split. Without edges the result is empty.
    """
    pointed = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    now = settled(pointed, ws, f"{name}_0")
    before, step = None, 0
    while (after := _signature(now)) != before and after[0]:
        before, step = after, step + 1
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = settled(small.select("e.*").where("u > v").distinct(), ws, f"{name}_{step}")
    return now
