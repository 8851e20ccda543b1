"""Shards by jump consistent hashing: the key and the number of shards decide, without a table of the ring.

A document's shard follows from a 64-bit hash of its ``doc_id`` alone. With one shard more, a document stays or moves
into the new shard, and one in (n + 1) moves.

Defined cases: null ``doc_id`` is a key like any other (all such rows share a shard); repeated keys share a shard; a null
text has size 1; an empty table gives an empty table; other columns are carried along by ``sharded``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekeep.llm.common import doc_texts, free_name, ranked
from tablekeep.session import col

# Fixed values of the published method: the multiplier of its linear congruential generator, and 2 to the 31st.
MULTIPLIER = np.uint64(2862933555777941757)
SPAN = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key: each key jumps ahead by random steps until one would leave the shards."""
    keys = keys.astype(np.uint64)
    at = np.zeros(len(keys), dtype=np.int64)
    ahead = np.zeros(len(keys), dtype=np.int64)
    going = np.arange(len(keys))
    while len(going):
        at[going] = ahead[going]
        keys[going] = keys[going] * MULTIPLIER + np.uint64(1)
        step = SPAN / ((keys[going] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[going] = ((at[going] + 1) * step).astype(np.int64)
        going = going[ahead[going] < shards]
    return at.astype(np.int32)


def jump_shard(key: Column, shards: int) -> Column:
    """The jump shard of a column of any type, through its 64-bit hash."""
    if shards < 1:
        raise ValueError("there must be a shard")

    @F.pandas_udf("int")
    def of(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(hashes.to_numpy(dtype=np.int64).view(np.uint64), shards))

    return of(F.xxhash64(key))


def sharded(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """Add each row's shard as the last column, ``name`` (with a number, where there is such a column). One scan, no shuffle."""
    return df.withColumn(free_name(df, name), jump_shard(col(key), shards))


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Per document its size, the CRC of its text, its shard, its slot there (from 0 without gaps) and its shard if there
    were one more. Slots are given by ``ranked``, so a shard is never in one task; texts are not shuffled."""
    sized = doc_texts(docs).select(
        "doc_id",
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    placed = sharded(sharded(sized, "doc_id", shards), "doc_id", shards + 1, "grown_shard")
    out = ranked(placed, "shard", ["doc_id", "size", "text_crc32"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int) -> None:
    """Write all columns of the documents into one folder per shard (``shard=0`` and so on, or as ``sharded`` names it)."""
    split = sharded(docs, "doc_id", shards)
    name = split.columns[-1]
    split.hint("rebalance", col(name)).write.mode("overwrite").partitionBy(name).parquet(path)
