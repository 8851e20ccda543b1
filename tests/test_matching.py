"""Key matching and upserts against brute force, for the broadcast form and for the shuffled one."""

import collections
import random

import pytest
from pyspark.sql import functions as F
from test_queries import executed_plans, plan_of

from tablekeep.operators import matching
from tablekeep.operators.matching import AmbiguousMatchError
from tablekeep.operators.upsert import rewritten_rows

SCHEMA = "id bigint, v string"

# None: the usual bound, so small increments are broadcast. 0: nothing is, and Spark may not either, so the
# shuffled form runs.
LIMITS = pytest.mark.parametrize("limit", [None, 0], ids=["broadcast", "shuffled"])


@pytest.fixture(autouse=True)
def no_automatic_broadcast(request, spark):
    off = getattr(request.node, "callspec", None) and request.node.callspec.params.get("limit") == 0
    if off:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def merge_by_hand(target, source):
    by_key = {k: (k, v) for k, v in source if k is not None}
    present = {k for k, _ in target}
    out = [by_key.get(k, (k, v)) if k is not None else (k, v) for k, v in target]
    return collections.Counter(out + [r for r in source if r[0] is None or r[0] not in present])


def rewrite_by_hand(target, source):
    keys = [k for k, _ in source]
    if not source:
        kept = list(target)
    elif None in keys:
        kept = []
    else:
        kept = [r for r in target if r[0] is not None and r[0] not in keys]
    return collections.Counter(set(kept) | set(source))


T = [(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "n")]

# Increment, and whether merging it is ambiguous.
CASES = {
    "update and insert": [(2, "B"), (9, "z")],
    "null key in source": [(2, "B"), (9, "z"), (None, "N")],
    "only null keys": [(None, "N"), (None, "N")],
    "empty": [],
    "repeated new key": [(9, "y"), (9, "z"), (9, "z")],
    "repeated new key and update": [(9, "y"), (9, "z"), (3, "C")],
    "nothing new": [(1, "A"), (3, "C")],
}


@LIMITS
@pytest.mark.parametrize("case", CASES)
def test_cases(spark, case, limit):
    target, source = frame(spark, T), frame(spark, CASES[case])
    assert bag(matching.merged_rows(target, source, "id", limit)) == merge_by_hand(T, CASES[case])
    assert bag(rewritten_rows(target, source, "id", limit)) == rewrite_by_hand(T, CASES[case])
    counts = matching.merge_counts(target, source, "id", limit).first()
    keys = {k for k, _ in CASES[case]} - {None}
    updated = sum(k in keys for k, _ in T)
    new = sum(k is None or k not in {1, 2, 3} for k, _ in CASES[case])
    assert tuple(counts) == (updated, new, len(T) - updated)


@LIMITS
def test_ambiguous_update_is_refused(spark, limit):
    source = frame(spark, [(2, "x"), (2, "y"), (9, "z")])
    with pytest.raises(AmbiguousMatchError, match="id = 2"):
        matching.merged_rows(frame(spark, T), source, "id", limit)


def test_merge_is_by_name_and_rewrite_by_position(spark):
    target = frame(spark, T)
    turned = spark.createDataFrame([("B", 2)], "v string, id bigint")
    assert bag(matching.merged_rows(target, turned, "id"))[(2, "B")] == 2
    with pytest.raises(TypeError, match="by position|cannot fill"):
        rewritten_rows(target, turned, "id")
    with pytest.raises(ValueError, match="lacks"):
        matching.merged_rows(target, turned.select("id"), "id")


def random_sides(seed, hot=False):
    rng = random.Random(seed)

    def key(n):
        return rng.choice([7, None, rng.randrange(n)]) if hot else rng.randrange(n)

    target = [(key(200), f"t{i % 40}") for i in range(600)]
    fresh = rng.sample(range(400), 60)
    source = [(k, f"s{k}") for k in fresh]
    if hot:
        source += [(None, "s")] * 40 + [(5000, f"s{i % 3}") for i in range(90)]
        if 7 not in fresh:
            source.append((7, "s7"))
    return target, source


@LIMITS
@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_sides(spark, seed, hot, limit):
    target, source = random_sides(seed, hot)
    t, s = frame(spark, target), frame(spark, source)
    merged = matching.merged_rows(t, s, "id", limit)
    assert bag(merged) == merge_by_hand(target, source)
    assert bag(rewritten_rows(t, s, "id", limit)) == rewrite_by_hand(target, source)
    no_nulls = [r for r in source if r[0] is not None]
    s = frame(spark, no_nulls)
    assert bag(rewritten_rows(t, s, "id", limit)) == rewrite_by_hand(target, no_nulls)


@LIMITS
def test_rewrite_and_merge_agree_on_clean_sides(spark, limit):
    """Keys set and unique in the increment, no equal rows in the target: both rules give the same rows."""
    rng = random.Random(5)
    target = [(k, f"t{k}") for k in rng.sample(range(1000), 300)]
    source = [(k, f"s{k}") for k in rng.sample(range(1000), 80)]
    t, s = frame(spark, target), frame(spark, source)
    merged = matching.merged_rows(t, s, "id", limit)
    assert bag(merged) == bag(rewritten_rows(t, s, "id", limit))
    again = matching.merged_rows(merged, s, "id", limit)
    assert bag(again) == bag(merged)
    counts = matching.merge_counts(t, s, "id", limit).first()
    assert counts["n_updated"] + counts["n_inserted"] == len(source)
    assert counts["n_updated"] + counts["n_kept"] == len(target)


@pytest.mark.parametrize("kind", ["string", "float", "decimal(20,0)", "date", "timestamp", "int"])
@LIMITS
def test_key_types(spark, kind, limit):
    cast = {"date": "date_add(date'2020-01-01', cast(id as int))", "timestamp": "timestamp_seconds(id)"}
    key = F.expr(cast.get(kind, f"cast(id as {kind})")).alias("id")
    t = spark.range(50).union(spark.range(3).selectExpr("0 as id")).select(key, F.lit("t").alias("v"))
    s = spark.range(40, 60).select(key, F.lit("s").alias("v"))
    out = matching.merged_rows(t, s, "id", limit).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in out} == {"t": 43, "s": 20}


def test_float_keys_collide_with_a_warning(spark, caplog):
    t = spark.sql("select cast(16777216 as float) as id, 't' as v")
    s = spark.sql("select cast(16777217 as float) as id, 's' as v")
    with caplog.at_level("WARNING"):
        assert bag(matching.merged_rows(t, s, "id")) == {(16777216.0, "s"): 1}
    assert "2^24" in caplog.text


@pytest.mark.parametrize("nulls", [0, 1, 3])
@pytest.mark.parametrize("copies", [0, 3])
@LIMITS
def test_collapse_copies(spark, limit, copies, nulls):
    rows = [(i, "v") for i in range(20)] + [(i, f"v{i % 2}") for i in range(5) for _ in range(copies)]
    rows += [(None, "n")] * nulls
    out = matching.collapse_copies(frame(spark, rows), "id", limit)
    assert bag(out) == collections.Counter(set(rows))


def test_unique_keys_are_collapsed_without_a_shuffle(spark):
    t = spark.range(1000).select("id", F.lit("t").alias("v"))
    assert "Exchange" not in plan_of(matching.collapse_copies(t, "id"))


def test_rewrite_pairs_swapped_columns_by_position(spark, caplog):
    t = spark.createDataFrame([(1, 2), (5, 6)], "id bigint, v bigint")
    s = spark.createDataFrame([(1, 2), (7, 8)], "v bigint, id bigint")
    with caplog.at_level("WARNING"):
        out = rewritten_rows(t, s, "id")
    assert bag(out) == {(1, 2): 1, (5, 6): 1, (7, 8): 1}
    assert "by position" in caplog.text


def test_columns_named_like_words_of_ours(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "`k` bigint, `salt` string, `in.target` int")
    s = spark.createDataFrame([(2, "B", 2), (3, "C", 2)], "`k` bigint, `salt` string, `in.target` int")
    for limit in (None, 0):
        out = matching.merged_rows(t, s, "k", limit)
        assert bag(out) == {(1, "a", 1): 1, (2, "B", 2): 1, (3, "C", 2): 1}


def test_latest_per_key(spark):
    rows = [(1, "a"), (1, "c"), (1, "b"), (2, "x"), (None, "n"), (None, "m")]
    out = matching.latest_per_key(frame(spark, rows), "id", ["v"])
    assert bag(out) == {(1, "c"): 1, (2, "x"): 1, (None, "n"): 1, (None, "m"): 1}


# ---- plans


def test_broadcast_form_does_not_shuffle_the_target(spark):
    t = spark.range(100_000).select("id", F.lit("t").alias("v"))
    s = spark.range(50).select("id", F.lit("s").alias("v"))
    plan = plan_of(matching.merged_rows(t, s, "id"))
    assert "BroadcastHashJoin LeftOuter" in plan and "SortMergeJoin" not in plan
    plan = plan_of(matching.anti_not_in(t, s, "id"))
    assert "BroadcastHashJoin LeftAnti" in plan and "Exchange hashpartitioning(id" not in plan


@pytest.mark.parametrize("limit", [0])
def test_shuffled_form_uses_joins_that_can_be_split(spark, limit):
    t = spark.range(1000).select("id", F.lit("t").alias("v"))
    s = spark.range(50).select("id", F.lit("s").alias("v"))
    plan = plan_of(matching.merged_rows(t, s, "id", limit))
    assert "SortMergeJoin LeftOuter" in plan and "FullOuter" not in plan and "BroadcastExchange" not in plan


@pytest.mark.parametrize("key", ["id", "timestamp_seconds(id)"], ids=["long", "timestamp"])
def test_a_common_key_is_split_by_aqe(spark, tmp_path, key):
    """Two thirds of the target under one key: the final plan of the join splits it."""
    hot = spark.range(0, 300_000, 1, 16).select(F.expr(f"case when id % 3 > 0 then {key.replace('id', '7')} else {key} end").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    s = spark.range(1000).select(F.expr(key).alias("id"), F.lit("s").alias("v"))
    hot.write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        merged = matching.merged_rows(t, s, "id", 0)
        assert merged.groupBy("v").count().where("v = 's'").first()["count"] == merged.where("v = 's'").count() >= 200_000
        merged.collect()
        assert "skew=true" in plan_of(merged)
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_many_common_keys(spark):
    """1,200 keys, each far above a reducer's share of 2,000 reducers."""
    t = spark.range(60_000).select((F.col("id") % 1200).alias("id"), F.lit("t").alias("v"))
    s = spark.range(600, 1800).select("id", F.lit("s").alias("v"))
    got = matching.merged_rows(t, s, "id", 0).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {"t": 30_000, "s": 30_600}


@LIMITS
def test_older_rows_do_not_win_where_an_order_is_given(spark, limit):
    t, s = frame(spark, [(1, "m"), (2, "m"), (None, "n")]), frame(spark, [(1, "a"), (2, "z"), (3, "a"), (None, "a")])
    out = matching.merged_rows(t, s, "id", limit, order_by=["v"])
    assert bag(out) == {(1, "m"): 1, (2, "z"): 1, (3, "a"): 1, (None, "n"): 1, (None, "a"): 1}


def test_broadcasts_off_is_obeyed(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not matching.fits_broadcast(spark, 10)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert matching.fits_broadcast(spark, 10)
    assert not matching.fits_broadcast(spark, None)
    assert not matching.fits_broadcast(spark, matching.BROADCAST_BYTES + 1)


def test_profile(spark):
    seen = matching.profile(frame(spark, [(1, "aa"), (1, None), (None, "b")]), "id")
    assert (seen.rows, seen.null_keys, seen.most_copies) == (3, 1, 2)
    assert seen.size == 3 * (matching.ROW_OVERHEAD + 2 * matching.VALUE_BYTES) + 3
    nested = spark.sql("select 1L as id, array(1, 2) as a")
    assert matching.profile(nested, "id").size is None


def test_new_rows_are_found_over_all_shuffle_partitions(spark):
    """Keys are few bytes in a shuffle, so that AQE would give all of the target's to one task, which holds them in memory."""
    target = spark.range(0, 40_000, 1, 4).selectExpr("id as k", "'t' as v")
    source = spark.range(39_000, 42_000, 1, 2).union(spark.range(1).selectExpr("cast(null as bigint)")).selectExpr("id as k", "'s' as v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = matching.merged_rows(target, source, "k")
        found = rows.groupBy("v").count().collect()
        with executed_plans(spark) as plans:
            rows.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["v"]: r["count"] for r in found} == {"t": 39_000, "s": 3_001}
    # Spark deals these keys over as many tasks as it was told, and AQE makes them no fewer.
    assert any("REPARTITION_BY_NUM" in p for p in plans)
