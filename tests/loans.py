"""Seeded loan transactions of the 23-column shape, as a Spark job."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tablekeep.schemas import TRANSACTIONS

COUNTRIES = ["DE", "FR", "GB", "US"]


def snapshot(spark: SparkSession, n: int) -> DataFrame:
    """``n`` rows with unique ids 0..n-1; every seventh balance is missing."""
    out = []
    for i, f in enumerate(TRANSACTIONS.fields):
        if f.name == "id":
            value = F.col("k")
        elif f.name == "balance":
            value = F.when(F.col("k") % 7 != 0, F.col("k") * 10)
        elif f.name == "country_code":
            value = F.element_at(F.array(*map(F.lit, COUNTRIES)), (F.col("k") % 4 + 1).cast("int"))
        elif isinstance(f.dataType, FloatType):
            value = F.pmod(F.xxhash64("k", F.lit(i)), F.lit(1000)) / 4
        else:
            value = F.concat(F.lit(f.name + "_"), F.pmod(F.xxhash64("k", F.lit(i)), F.lit(10)))
        out.append(value.cast(f.dataType).alias(f.name))
    return spark.range(n).withColumnRenamed("id", "k").select(*out)


def increment(spark: SparkSession, n: int) -> DataFrame:
    """Three rows: ids 1 and 2 change, id ``n`` is new."""
    rows = snapshot(spark, n + 1).where(F.col("id").isin(1.0, 2.0, float(n)))
    return rows.withColumns({"status": F.lit("changed"), "balance": F.lit(5.0).cast("float")})
