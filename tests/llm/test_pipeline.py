"""The pipeline against what its stages decide, each from its own input, and against plain versions on odd rows."""

import collections
import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp

from odd_rows import odd_docs  # noqa: F401

from tablekeep.llm import decontaminate, quality, secrets, sharding, simhash
from tablekeep.llm.common import table

SMALL = "/root/testdata/sf0.01"


def test_stages(spark, ws):
    docs = table(spark, SMALL, "documents")
    columns, results = docs.columns, []
    for number, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SMALL).write.parquet(ws.path(str(number)))
        docs = spark.read.parquet(ws.path(str(number)))
        results.append(docs)
    good, single, clean, safe, packed = results
    assert all(df.columns == columns for df in results[:-1])
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(good, ws).collect()}
    assert {r["doc_id"] for r in single.collect()} == set(groups.values())
    found = decontaminate.contamination(single, table(spark, SMALL, "benchmark"), ws)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in found.where("not contaminated").collect()}
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert {r["doc_id"]: r["text"] for r in safe.collect()} == {d: secrets.redacted(t) for d, t in texts.items()}
    assert {r["doc_id"] for r in packed.collect()} == set(texts)
    assert cp.run(spark, SMALL).drop("ids").count() == packed.count()


# Names that operators use, or once used, for themselves.
CLASHING = "__d __g __digest __row __row_1 digest key shard root fp k range words token r".split()


def with_clashing_columns(df):
    return df.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING if c not in df.columns))


def in_plain_words(rows):
    """Which of the good rows (doc_id, text) stay, and how their texts come out: one of each group, without its secrets."""
    fps = [simhash.fingerprint(t or "") % (1 << 64) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            label[i] = min(label[j] for j in range(len(rows)) if (fps[i] ^ fps[j]).bit_count() <= simhash.RADIUS)
    by_group = {}
    for (doc_id, text), k in zip(rows, label):
        order = (doc_id is None, doc_id or 0, hashlib.md5((text or "").encode()).hexdigest())
        mine = (order, doc_id, text)
        by_group[k] = min(by_group.get(k, mine), mine, key=lambda x: x[0])
    return [(d, None if t is None else secrets.redacted(t)) for _, d, t in by_group.values()]


def test_odd_rows(spark, odd_docs, tmp_path, ws):
    """No stage but the last changes the columns, whatever their names, and the packed pieces are those of the plain version."""
    labels = table(spark, SMALL, "labels")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    table(spark, SMALL, "benchmark").where("false").write.parquet(f"{tmp_path}/benchmark.parquet")
    with_clashing_columns(odd_docs).write.parquet(f"{tmp_path}/documents.parquet")
    docs = table(spark, str(tmp_path), "documents")
    columns, kept = docs.columns, []
    for name, stage in cp.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(ws.path(name.replace(" ", "_")))
        docs = spark.read.parquet(ws.path(name.replace(" ", "_")))
        assert docs.columns == columns and docs.count() > 0
        assert all(r[c] == f"own {c}" for r in docs.collect() for c in CLASHING if c not in odd_docs.columns)
        kept.append([(r["doc_id"], r["text"]) for r in docs.collect()])
    good = quality.keep_good(table(spark, str(tmp_path), "documents"), labels, ws).collect()
    assert collections.Counter(kept[0]) == collections.Counter((r["doc_id"], r["text"]) for r in good)
    expected = in_plain_words(kept[0])
    assert collections.Counter(kept[-1]) == collections.Counter(expected)
    pieces = cp.run(spark, str(tmp_path)).collect()
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = collections.Counter((d, len(ids.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in expected)
    assert collections.Counter((r["doc_id"], r["doc_tokens"]) for r in pieces if r["start"] == 0) == sizes


def test_no_documents(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        table(spark, SMALL, name).where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_shards_carry_a_column_of_their_name(spark, ws):
    docs = spark.createDataFrame([(i, f"t{i}", f"mine {i}") for i in range(20)], "doc_id long, text string, Shard string")
    sharding.write_shards(docs, ws.path("shards"), 3)
    back = spark.read.parquet(ws.path("shards"))
    assert {(r["doc_id"], r["Shard"]) for r in back.collect()} == {(i, f"mine {i}") for i in range(20)}
    assert {r["shard_1"] for r in back.collect()} <= {0, 1, 2} and back.columns[-1] == "shard_1"
