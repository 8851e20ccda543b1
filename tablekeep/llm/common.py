"""What the operators share: settled tables, gapless ranks, texts in Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablekeep.session import Workspace, col

# The letters that "lower-cases A-Z" is about.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: what the cluster's owner sized to the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def settled(df: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: computed once, and safe to lose executors."""
    path = ws.path(name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or it with a number, so that no column of ``df`` has the name in whatever case."""
    taken, name, n = {c.lower() for c in df.columns}, wanted, 0
    while name.lower() in taken:
        n += 1
        name = f"{wanted}_{n}"
    return name


def row_key(doc_id: Column, digest: Column) -> Column:
    """One text for a document's id (which may be null) and its text's digest, to join by plain equality."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("/"), digest)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(col(name), F.lit(""))


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (null text: empty), whatever other columns there are."""
    return docs.select(col("doc_id"), text_or_empty().alias("text"))


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add a gapless rank from 0 within each ``group`` (not null), without bringing a group into one task.

    Rows of a group are spread over buckets by a hash of the ``order`` columns; bucket sizes give where a bucket's ranks
    begin, and rows are numbered within their bucket. Rows that tie in all of ``order`` may swap, so name all columns
    that matter.
    """
    buckets = partitions(df.sparkSession)
    spread = df.withColumn("__bucket", F.pmod(F.xxhash64(*map(col, order)), F.lit(buckets)).cast("int"))
    sizes = spread.groupBy(group, "__bucket").agg(F.count("*").alias("__n"))
    before = W.partitionBy(group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    begins = sizes.select(group, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__begin"))
    within = W.partitionBy(group, "__bucket").orderBy(*map(col, order))
    return (
        spread.join(begins, [group, "__bucket"])
        .withColumn(name, (F.col("__begin") + F.row_number().over(within) - 1).cast("long"))
        .drop("__bucket", "__begin")
        .select(*map(col, [*df.columns, name]))
    )
