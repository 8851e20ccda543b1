"""Run in a process of its own, with Hive support: SerDe DDL and a function by class name. Argument: a new folder."""

import sys
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from pyspark.sql import SparkSession  # noqa: E402

import loans  # noqa: E402
from tablekeep.functions.scalars import register_class_function  # noqa: E402
from tablekeep.operators import tables  # noqa: E402
from tablekeep.operators.upsert import upsert_merge  # noqa: E402
from tablekeep.schemas import TRANSACTIONS  # noqa: E402

folder = sys.argv[1]
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.warehouse.dir", folder + "/warehouse")
    .config("javax.jdo.option.ConnectionURL", f"jdbc:derby:;databaseName={folder}/metastore;create=true")
    .config("spark.hadoop.javax.jdo.option.ConnectionURL", f"jdbc:derby:;databaseName={folder}/metastore;create=true")
    .enableHiveSupport()
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")

made = tables.create_hive_table(spark, "default.loans", TRANSACTIONS, {"origin": "test"})
ddl = spark.sql("SHOW CREATE TABLE loans AS SERDE").first()[0]
assert "ParquetHiveSerDe" in ddl and "MapredParquetInputFormat" in ddl, ddl
tables.insert_rows(loans.snapshot(spark, 20), made)
upsert_merge(spark, made, loans.increment(spark, 20), "id")
assert spark.table("loans").count() == 21
assert tables.provider_of(spark, made) == "hive"

register_class_function(spark, "upper_by_class", "org.apache.hadoop.hive.ql.udf.generic.GenericUDFUpper")
register_class_function(spark, "upper_by_class", "org.apache.hadoop.hive.ql.udf.generic.GenericUDFUpper")
got = {r[0] for r in spark.sql("SELECT DISTINCT upper_by_class(status) FROM loans").collect()}
assert "CHANGED" in got, got
print("hive ok")
