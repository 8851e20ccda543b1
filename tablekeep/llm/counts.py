"""Token counts through a digest cache: only texts never counted before by this tokenizer are encoded, each once.

The cache is a Parquet folder of (tokenizer, digest, n_tokens). A text's digest is the SHA-256 of its normalised content:
runs of ASCII white space become one blank, which changes no count, as the vocabulary drops white space. The tokenizer's
version is the SHA-256 of its file.

Defined cases: a null text counts as empty (0 tokens); equal texts share a count; null or repeated ``doc_id`` are kept row
by row; an empty table gives an empty table; other columns are ignored. A run that dies before its append is repeated
from the same cache; two runs that append the same digest do no harm.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeep.llm.common import doc_texts
from tablekeep.llm.tokens import in_groups, word_counter

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
GROUP_TEXTS = 200


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of one tokenizer version, a row per digest; empty where there is no cache yet."""
    if _exists(spark, cache):
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    else:
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _normalised(docs: DataFrame) -> DataFrame:
    content = F.regexp_replace("text", "[ \\t-\\r]+", " ")
    return doc_texts(docs).withColumn("content", content).withColumn("digest", F.unhex(F.sha2("content", 256)))


def add_misses(docs: DataFrame, tokenizer: str, cache: str) -> None:
    """Encode the distinct contents that the cache lacks, and append their counts.

    Copies are reduced before the shuffle (one content per digest and task), so a common text crosses once per task.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    distinct = _normalised(docs).groupBy("digest").agg(F.first("content").alias("content"))
    misses = distinct.join(cached_counts(spark, cache, version).select("digest"), "digest", "left_anti")

    def encode(batches):
        counter = word_counter(tokenizer)
        for batch in batches:
            digests, texts = batch.column("digest"), batch.column("content")
            counts = [n for group in in_groups((t.as_py() for t in texts), GROUP_TEXTS) for n in counter.counts(group)]
            yield pa.RecordBatch.from_arrays([digests, pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    fresh = misses.mapInArrow(encode, "digest binary, n_tokens long")
    fresh.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, all counts read from the cache after the misses went in.

    The join by digest moves no text, and its only large side is one that AQE can split where copies are many.
    """
    add_misses(docs, tokenizer, cache)
    counts = cached_counts(docs.sparkSession, cache, tokenizer_version(tokenizer))
    keyed = _normalised(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    joined = keyed.join(counts, "digest", "left")
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
