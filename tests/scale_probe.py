"""Time the upsert forms on a table made large by repeating orders, plain and with skewed keys.

    python tests/scale_probe.py [repeats] [sf_dir]

Not a test: it prints one line per form. ``skewed`` puts a third of the rows under one key and a sixth under NULL.
"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tablekeep.operators import matching  # noqa: E402
from tablekeep.operators.upsert import rewritten_rows  # noqa: E402
from tablekeep.plans.catalog import order_increment, table  # noqa: E402
from tablekeep.session import Workspace, local_session  # noqa: E402


def build(orders: DataFrame, repeats: int, skewed: bool) -> DataFrame:
    """``repeats`` copies of orders under keys of their own."""
    per_copy = orders.agg(F.max("o_orderkey")).first()[0] + 1
    copies = orders.crossJoin(F.broadcast(orders.sparkSession.range(repeats).withColumnRenamed("id", "copy")))
    key = F.col("o_orderkey") + F.col("copy") * F.lit(per_copy)
    if skewed:
        key = F.when(key % 3 == 0, F.lit(7)).when(key % 6 == 1, F.lit(None)).otherwise(key)
    return copies.withColumn("o_orderkey", key.cast("bigint")).drop("copy")


def timed(name: str, make) -> None:
    for label in ("first", "second"):
        start = time.time()
        make().write.format("noop").mode("overwrite").save()
        print(f"{name:55s} {label:6s} {time.time() - start:7.2f} s", flush=True)


def plain_full_outer(t: DataFrame, s: DataFrame) -> DataFrame:
    s = s.select(*(F.col(c).alias("s_" + c) for c in s.columns))
    joined = t.join(s, F.col("o_orderkey") == F.col("s_o_orderkey"), "full_outer")
    return joined.select(*(F.coalesce("s_" + c, c).alias(c) for c in t.columns))


def plain_rewrite(t: DataFrame, s: DataFrame) -> DataFrame:
    t.createOrReplaceTempView("t")
    s.createOrReplaceTempView("s")
    return t.sparkSession.sql(
        "SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION SELECT * FROM s"
    )


def main(repeats: int, sf_dir: str) -> None:
    spark = local_session(8, conf={"spark.sql.shuffle.partitions": "64", "spark.driver.memory": "16g"})
    ws = Workspace(spark)
    orders = table(spark, sf_dir, "orders")
    for skewed in (False, True):
        path = ws.path("skewed" if skewed else "plain")
        build(orders, repeats, skewed).write.parquet(path)
        target = spark.read.parquet(path)
        small = order_increment(orders).where("o_orderkey <> 7")
        large = target.where("o_orderkey % 5 = 0 and o_orderkey <> 7").dropDuplicates(["o_orderkey"])
        large = large.withColumn("o_orderstatus", F.lit("U"))
        large.write.parquet(path + "_increment")
        large = spark.read.parquet(path + "_increment")
        print(f"--- {'skewed' if skewed else 'plain'}: {target.count()} rows; increments {small.count()}, {large.count()}")
        timed("merge, small increment", lambda: matching.merged_rows(target, small, "o_orderkey"))
        timed("merge, small increment, full outer join", lambda: plain_full_outer(target, small))
        timed("merge, large increment, shuffled", lambda: matching.merged_rows(target, large, "o_orderkey", 0))
        timed("merge, large increment, full outer join", lambda: plain_full_outer(target, large))
        timed("rewrite, small increment", lambda: rewritten_rows(target, small, "o_orderkey"))
        timed("rewrite, small increment, NOT IN + UNION", lambda: plain_rewrite(target, small))
        timed("rewrite, large increment", lambda: rewritten_rows(target, large, "o_orderkey"))
        timed("counts, small increment", lambda: matching.merge_counts(target, small, "o_orderkey"))
    ws.close()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 100, sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1")
