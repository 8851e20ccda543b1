"""The registered queries, each next to the SQL that gives the same rows.

Every query takes ``(spark, sf_dir)``, runs its operator over whole tables, and returns a DataFrame. Where an operator
is about a file format, a table or a stream, the query first writes the table in that form and reads it back through the
operator. Files and tables live in a workspace of their own, in the folder the session names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tablekeep.functions import scalars
from tablekeep.operators import matching, relational, revisions, tables, upkeep, upsert
from tablekeep.plans import jobs
from tablekeep.schemas import all_strings
from tablekeep.session import Workspace, qualified
from tablekeep.sources import files, landing, views
from tablekeep.streaming import evolving, ingest, totals

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(key: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = " ".join(sql.split())
        return query

    return add


# ---- inputs derived from the given tables

# The increment on orders: urgent open orders change status and price, high-priority pending ones are placed again
# under a new (negative) key. The same relation in SQL and as DataFrame.
INCREMENT_SQL = """
select o_orderkey, o_custkey, 'U' as o_orderstatus, o_totalprice + cast(1 as double) as o_totalprice, o_orderdate,
  o_orderpriority
from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O'
union all
select -1 - o_orderkey as o_orderkey, o_custkey, 'I' as o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderpriority = '2-HIGH' and o_orderstatus = 'P'
"""

MERGED_SQL = f"""
select t.* from orders t left join ({INCREMENT_SQL}) s on t.o_orderkey = s.o_orderkey where s.o_orderkey is null
union all select * from ({INCREMENT_SQL}) s2
"""

MERGED_TOTALS_SQL = f"""
select o_orderstatus, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from ({MERGED_SQL}) m group by o_orderstatus
"""

# The moment that parts the events into the first landing and the increment.
EVENTS_CUT = "2024-01-28 00:00:00"
# And one before it, for a third landing.
EVENTS_MIDDLE = "2024-01-15 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return files.scan_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_increment(orders: DataFrame) -> DataFrame:
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    again = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P")
    changed = orders.where(urgent).withColumns(
        {"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") + F.lit(1.0)}
    )
    placed = orders.where(again).withColumns(
        {"o_orderkey": F.lit(-1).cast("bigint") - F.col("o_orderkey"), "o_orderstatus": F.lit("I")}
    )
    return changed.union(placed)


def event_landings(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.to_timestamp_ntz(F.lit(EVENTS_CUT))
    return events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)


def saved(ws: Workspace, name: str, df: DataFrame, provider: str = "parquet") -> str:
    """A managed table filled with ``df``."""
    made = tables.create_typed_table(ws.spark, ws.table(name), df.schema, provider)
    tables.insert_rows(df, made)
    return made


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(qualified(name))


def dataset(path: str) -> Column:
    """``orders.parquet`` out of a path to it or to a file below it."""
    return F.regexp_extract(path, "([^/]+\\.parquet)", 1)


# ---- scans


@registered("scan_parquet_full", "select * from orders")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@registered("json_fixed_schema_scan", "select * from customer")
def _(spark, sf_dir):
    df, ws = table(spark, sf_dir, "customer"), Workspace(spark)
    return files.scan_json(spark, jobs.write_json(df, ws.path("customer")), df.schema)


@registered(
    "json_inferred_scan",
    """select c_acctbal, c_custkey, c_mktsegment, c_name, cast(c_nationkey as bigint) as c_nationkey from customer""",
)
def _(spark, sf_dir):
    ws = Workspace(spark)
    return files.scan_json_inferred(spark, jobs.write_json(table(spark, sf_dir, "customer"), ws.path("customer")))


def _text_lines(spark, sf_dir, name, *columns) -> str:
    """Lines like ``Andy, 30``, blank after the separator included."""
    path = Workspace(spark).path(name)
    lines = table(spark, sf_dir, name).select(F.concat_ws(", ", *(F.col(c).cast("string") for c in columns)))
    lines.write.text(path)
    return path


@registered("text_split_cast", "select c_name as name, c_custkey as age from customer")
def _(spark, sf_dir):
    schema = StructType([StructField("name", StringType()), StructField("age", LongType())])
    return files.scan_split_text(spark, _text_lines(spark, sf_dir, "customer", "c_name", "c_custkey"), schema)


@registered("text_string_schema", "select p_name as name, cast(p_partkey as varchar) as age from part")
def _(spark, sf_dir):
    return files.scan_string_text(spark, _text_lines(spark, sf_dir, "part", "p_name", "p_partkey"), all_strings("name age"))


@registered("delimited_header_scan", "select c_name as name, c_custkey as age, c_mktsegment as job from customer")
def _(spark, sf_dir):
    people = table(spark, sf_dir, "customer").selectExpr("c_name as name", "c_custkey as age", "c_mktsegment as job")
    path = Workspace(spark).path("people")
    people.write.options(sep=";", header="true").csv(path)
    return files.scan_delimited(spark, path, people.schema)


@registered("external_table_like", "select * from supplier")
def _(spark, sf_dir):
    ws, supplier = Workspace(spark), table(spark, sf_dir, "supplier")
    first = tables.create_external_table(
        spark, ws.table("first"), supplier.schema, ws.path("first"), options=files.JSON_TIMESTAMPS
    )
    path = jobs.write_json(supplier, ws.path("second"))
    return read(spark, tables.create_table_like(spark, ws.table("second"), first, location=path))


@registered(
    "range_source",
    """select c.k as id, count(o.o_orderkey) as n_orders
    from (select unnest(range((select min(c_custkey) from customer), (select max(c_custkey) + 1 from customer))) as k) c
    left join orders o on o.o_custkey = c.k group by c.k""",
)
def _(spark, sf_dir):
    """Every customer number in the range that the table spans, with its number of orders, zero included."""
    ends = table(spark, sf_dir, "customer").agg(F.min("c_custkey").alias("a"), F.max("c_custkey").alias("b")).first()
    ids = files.generate_range(spark, ends["a"], ends["b"])
    # Counted before the join, so that a busy customer is one row there.
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    joined = ids.join(per_customer, F.col("id") == F.col("o_custkey"), "left")
    return joined.select("id", F.coalesce("n", F.lit(0)).alias("n_orders"))


@registered("file_inventory", "select 'orders.parquet' as file_name, count(*) as n_rows from orders")
def _(spark, sf_dir):
    found = files.file_inventory(table(spark, sf_dir, "orders"))
    return found.groupBy(dataset("file_path").alias("file_name")).agg(F.sum("n_rows").alias("n_rows"))


@registered(
    "file_listing",
    """select o_orderstatus, count(*) as n_rows, cast(1 as bigint) as n_files, true as has_bytes from orders
    group by o_orderstatus""",
)
def _(spark, sf_dir):
    """Files per partition by a listing, which gives no row per record, beside the rows by the inventory, which does."""
    ws, orders = Workspace(spark), table(spark, sf_dir, "orders")
    path = ws.path("orders")
    orders.repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    listed = files.file_listing(spark, path, orders.select("o_orderstatus").schema)
    per_part = listed.groupBy("o_orderstatus").agg(F.count("*").alias("n_files"), (F.sum("length") > 0).alias("has_bytes"))
    held = files.file_inventory(spark.read.parquet(path))
    status = F.regexp_extract("file_path", "o_orderstatus=([^/]*)/", 1).alias("o_orderstatus")
    return held.groupBy(status).agg(F.sum("n_rows").alias("n_rows")).join(per_part, "o_orderstatus")


@registered("land_raw_increment", "select event_id, ts, user_id, event_type, value, props from events")
def _(spark, sf_dir):
    ws, events = Workspace(spark), table(spark, sf_dir, "events")
    landed = landing.land_increment(spark, jobs.write_json(events, ws.path("source")), ws.path("raw"), "first")
    return files.scan_json(spark, landed, events.schema)


@registered(
    "land_resumable",
    """select event_id, ts, user_id, event_type, value, props, 0 as landed_again, true as all_in_manifest from events""",
)
def _(spark, sf_dir):
    """Events landed in two runs, the second over a source that has grown, and a third that finds nothing new."""
    ws, events = Workspace(spark), table(spark, sf_dir, "events")
    manifest, source = ws.path("manifest"), ws.path("source")
    runs = []
    for name, part in zip(("a", "b"), event_landings(events)):
        jobs.write_json(part.repartition(3), f"{source}/{name}")
        runs.append(landing.land_files(spark, source, ws.path("raw"), "first", manifest, group_bytes=1 << 20))
    again = landing.land_files(spark, source, ws.path("raw"), "first", manifest)
    entries = landing.read_manifest(spark, manifest).agg(F.sum("n_lines").alias("lines"), F.count("*").alias("n")).first()
    whole = entries["lines"] == events.count() and entries["n"] == sum(runs) == files.file_listing(spark, source).count()
    rows = files.scan_json(spark, f"{ws.path('raw')}/first", events.schema).drop(landing.FROM_FILE)
    return rows.withColumns({"landed_again": F.lit(again), "all_in_manifest": F.lit(whole)})


@registered("temp_view_query", "select c_custkey, c_name from customer")
def _(spark, sf_dir):
    name = Workspace(spark).name
    out = views.query_temp_view(table(spark, sf_dir, "customer"), name, f"SELECT c_custkey, c_name FROM {name}")
    views.drop_view(spark, name)
    return out


@registered("global_temp_view_query", "select c_nationkey, count(*) as n from customer group by c_nationkey")
def _(spark, sf_dir):
    name = Workspace(spark).name
    sql = f"SELECT c_nationkey, count(*) AS n FROM global_temp.{name} GROUP BY c_nationkey"
    out = views.query_global_view(table(spark, sf_dir, "customer"), name, sql)
    views.drop_view(spark, name, is_global=True)
    return out


# ---- tables


@registered("create_external_json_table", "select * from orders")
def _(spark, sf_dir):
    ws, orders = Workspace(spark), table(spark, sf_dir, "orders")
    path = jobs.write_json(orders, ws.path("orders"))
    name = ws.table("orders")
    return read(
        spark, tables.create_external_table(spark, name, orders.schema, path, options=files.JSON_TIMESTAMPS)
    )


@registered("create_like_insert", "select * from orders")
def _(spark, sf_dir):
    ws, orders = Workspace(spark), table(spark, sf_dir, "orders")
    path = jobs.write_json(orders, ws.path("raw"))
    raw = tables.create_external_table(spark, ws.table("raw"), orders.schema, path, options=files.JSON_TIMESTAMPS)
    copy = tables.create_table_like(spark, ws.table("copy"), raw, provider="parquet")
    tables.insert_from_table(spark, copy, raw)
    return read(spark, copy)


@registered("create_typed_table", "select * from customer")
def _(spark, sf_dir):
    ws, customer = Workspace(spark), table(spark, sf_dir, "customer")
    made = tables.create_typed_table(
        spark, ws.table("customer"), customer.schema, "orc", properties={"origin": "customer"}
    )
    tables.insert_rows(customer, made)
    return read(spark, made)


@registered("hive_ddl_table", "select *, 'parquet' as provider from customer")
def _(spark, sf_dir):
    """The rows, and how the table is stored: `hive` by the SerDe DDL, in a session that has a metastore for it, which a test
    process has; `parquet` says that this session made the native table instead."""
    ws, customer = Workspace(spark), table(spark, sf_dir, "customer")
    made = tables.create_hive_table(spark, ws.table("customer"), customer.schema)
    tables.insert_rows(customer, made)
    return read(spark, made).withColumn("provider", F.lit(tables.provider_of(spark, made)))


@registered("insert_into_select", "select * from orders union all select * from orders where o_orderstatus = 'P'")
def _(spark, sf_dir):
    ws, orders = Workspace(spark), table(spark, sf_dir, "orders")
    made = saved(ws, "orders", orders)
    pending = saved(ws, "pending", orders.where("o_orderstatus = 'P'"))
    tables.insert_from_table(spark, made, pending)
    return read(spark, made)


@registered("namespace_setup", "select c_mktsegment, count(*) as n, true as named_after_user from customer group by 1")
def _(spark, sf_dir):
    ws, customer = Workspace(spark), table(spark, sf_dir, "customer")
    user = tables.user_namespace(spark)
    name = tables.create_namespace(spark, f"{user}_{ws.name}", ws.path("namespace"))
    with tables.using_namespace(spark, name):
        tables.drop_table(spark, "customer")
        tables.create_typed_table(spark, "customer", customer.schema)
        tables.insert_rows(customer, "customer")
        named = spark.catalog.currentDatabase() == name and name.replace("_", "").isalnum()
        rows = spark.table("customer")
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("n")).withColumn("named_after_user", F.lit(named))


REBUILT_SQL = """select o_orderkey, o_custkey, case when o_orderstatus = 'P' then 'F' else o_orderstatus end
  as o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders"""


def _published(ws, sf_dir) -> str:
    """Orders, rebuilt with pending ones finished, and published over the former copy."""
    orders = table(ws.spark, sf_dir, "orders")
    live = saved(ws, "orders", orders)
    status = F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
    rebuilt = tables.create_table_like(ws.spark, ws.table("orders" + upkeep.NEW), live)
    tables.insert_rows(orders.withColumn("o_orderstatus", status), rebuilt)
    upkeep.publish(ws.spark, live, rebuilt)
    return live


@registered("rename_swap_publish", f"select *, 'live' as copy from ({REBUILT_SQL}) r union all select *, 'old' from orders")
def _(spark, sf_dir):
    live = _published(Workspace(spark), sf_dir)
    new, old = read(spark, live), read(spark, live + upkeep.OLD)
    return new.withColumn("copy", F.lit("live")).union(old.withColumn("copy", F.lit("old")))


@registered("purge_superseded", f"select *, false as old_left from ({REBUILT_SQL}) r")
def _(spark, sf_dir):
    live = _published(Workspace(spark), sf_dir)
    upkeep.purge_superseded(spark, live, retain_hours=0)
    return read(spark, live).withColumn("old_left", F.lit(tables.table_exists(spark, live + upkeep.OLD)))


def _rebuilt_twice(ws, sf_dir) -> str:
    """Orders, with pending ones finished in a second revision and urgent ones left out of a third."""
    orders = table(ws.spark, sf_dir, "orders")
    live = saved(ws, "orders", orders)
    status = F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
    finished = orders.withColumn("o_orderstatus", status)
    upkeep.rebuild(ws.spark, live, finished)
    upkeep.rebuild(ws.spark, live, finished.where("o_orderpriority <> '1-URGENT'"))
    return live


@registered(
    "revision_list",
    f"""select 1 as number, count(*) as n_rows, 'superseded' as state, true as counted from orders
    union all select 2, count(*), 'superseded', true from ({REBUILT_SQL}) a
    union all select 3, count(*), 'live', true from ({REBUILT_SQL}) b where o_orderpriority <> '1-URGENT'""",
)
def _(spark, sf_dir):
    """Each revision as listed, and whether the rows in its folder are as many as its entry says."""
    live = _rebuilt_twice(Workspace(spark), sf_dir)
    listed = revisions.list_revisions(spark, live).select(F.col("number").cast("int").alias("number"), "n_rows", "state")
    held = [revisions.read_revision(spark, live, n).agg(F.lit(n).alias("number"), F.count("*").alias("n")) for n in (1, 2, 3)]
    counts = held[0].union(held[1]).union(held[2])
    return listed.join(counts, "number").select("number", "n_rows", "state", (F.col("n") == F.col("n_rows")).alias("counted"))


@registered("restore_revision", f"select *, 3 as n_revisions from ({REBUILT_SQL}) r")
def _(spark, sf_dir):
    """The second of three revisions, live again."""
    live = _rebuilt_twice(Workspace(spark), sf_dir)
    revisions.restore_revision(spark, live, 2)
    return read(spark, live).withColumn("n_revisions", F.lit(len(revisions.revisions(spark, live))))


@registered(
    "describe_provider",
    """select * from (values ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'),
    ('c_acctbal', 'double'), ('c_mktsegment', 'string'), ('Provider', 'orc')) t(col_name, data_type)""",
)
def _(spark, sf_dir):
    made = saved(Workspace(spark), "customer", table(spark, sf_dir, "customer"))
    upkeep.convert_format(spark, made, "orc")
    return tables.describe_table(spark, made)


@registered("show_create_ddl", "select * from customer")
def _(spark, sf_dir):
    """The DDL text is run again under another name; the twin takes the rows."""
    ws = Workspace(spark)
    made = saved(ws, "customer", table(spark, sf_dir, "customer"))
    ddl = tables.show_ddl(spark, made)
    spark.sql(ddl.replace(".customer ", ".twin ", 1))
    tables.insert_from_table(spark, ws.table("twin"), made)
    return read(spark, ws.table("twin"))


@registered("convert_format", "select *, 'orc' as provider, 'o_orderstatus' as partitioned_by from orders")
def _(spark, sf_dir):
    """A partitioned table in another format: its partitioning stays."""
    ws, orders = Workspace(spark), table(spark, sf_dir, "orders")
    last = orders.select(*(c for c in orders.columns if c != "o_orderstatus"), "o_orderstatus")
    made = tables.create_typed_table(spark, ws.table("orders"), last.schema, partition_by=["o_orderstatus"])
    tables.insert_rows(last, made)
    upkeep.convert_format(spark, made, "orc")
    by = ",".join(tables.partition_columns(spark, made))
    return read(spark, made).withColumns(
        {"provider": F.lit(tables.provider_of(spark, made)), "partitioned_by": F.lit(by)}
    )


@registered("compact_files", "select *, true as fewer_files from orders")
def _(spark, sf_dir):
    """Orders written as more, smaller files than they came in, then compacted."""
    orders = table(spark, sf_dir, "orders")
    many = max(8, 4 * orders.rdd.getNumPartitions())
    made = saved(Workspace(spark), "orders", orders.repartition(many, "o_orderkey"))
    before = files.file_listing(spark, tables.location_of(spark, made)).count()
    upkeep.compact_files(spark, made)
    after = files.file_listing(spark, tables.location_of(spark, made)).count()
    return read(spark, made).withColumn("fewer_files", F.lit(after < before))


@registered(
    "insert_spot_check",
    """select count(*) as n_rows, count(*) - count(o_orderkey) as n_null_key, count(distinct o_orderkey) as n_distinct_key
    from orders""",
)
def _(spark, sf_dir):
    return tables.spot_check(read(spark, saved(Workspace(spark), "orders", table(spark, sf_dir, "orders"))), "o_orderkey")


@registered(
    "spot_check_per_load",
    """select l.load, l.n_rows, l.n_null_key, t.n_rows as n_rows_so_far, t.n_null_key as n_null_so_far, true as distinct_is_near
    from (select o_orderstatus as load, count(*) as n_rows, cast(sum(case when o_orderpriority = '5-LOW' then 1 else 0 end)
    as bigint) as n_null_key from orders group by 1) l, (select count(*) as n_rows, cast(sum(case when o_orderpriority = '5-LOW'
    then 1 else 0 end) as bigint) as n_null_key from orders) t""",
)
def _(spark, sf_dir):
    """Orders in a load per status, each checked by itself; the sums and the union of sketches tell of the whole table."""
    ws, orders = Workspace(spark), table(spark, sf_dir, "orders")
    checks = ws.table("checks")
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    keyed = orders.withColumn("k", key)
    for status in ("F", "O", "P"):
        tables.check_load(keyed.where(F.col("o_orderstatus") == status), "k", checks, status)
    # A load that is checked again replaces its own entry.
    tables.check_load(keyed.where(F.col("o_orderstatus") == "P"), "k", checks, "P")
    total = tables.checked_total(spark, checks).first()
    exact = keyed.agg(F.count_distinct("k").alias("n")).first()["n"]
    near = abs(total["distinct_keys"] - exact) <= 0.05 * exact
    return read(spark, checks).select(
        "load",
        "n_rows",
        "n_null_key",
        F.lit(total["n_rows"]).alias("n_rows_so_far"),
        F.lit(total["n_null_key"]).alias("n_null_so_far"),
        F.lit(near).alias("distinct_is_near"),
    )


# ---- projections, filters, limits


@registered("project_star", "select * from lineitem")
def _(spark, sf_dir):
    return relational.project(table(spark, sf_dir, "lineitem"))


@registered("project_column", "select c_name from customer")
def _(spark, sf_dir):
    return relational.project(table(spark, sf_dir, "customer"), "c_name")


@registered("project_arithmetic", "select c_name, nullif(c_nationkey, 0) + 1 as nation_next from customer")
def _(spark, sf_dir):
    nation = F.nullif(F.col("c_nationkey"), F.lit(0))
    return relational.plus(table(spark, sf_dir, "customer"), "c_name", nation, 1, "nation_next")


@registered("project_provenance", "select event_id, 'events.parquet' as source_file, true as stamped from events")
def _(spark, sf_dir):
    rows = relational.with_provenance(table(spark, sf_dir, "events"))
    return rows.select(
        "event_id", dataset("source_file").alias("source_file"), F.col("processing_time").isNotNull().alias("stamped")
    )


@registered("project_label", "select 'Name: ' || c_name as label from customer")
def _(spark, sf_dir):
    return relational.prefixed(table(spark, sf_dir, "customer"), "c_name", "Name: ", "label")


@registered("filter_gt", "select * from customer where c_acctbal > 5000")
def _(spark, sf_dir):
    return relational.greater_than(table(spark, sf_dir, "customer"), "c_acctbal", 5000)


@registered("filter_range", "select c_name, c_nationkey from customer where c_nationkey >= 13 and c_nationkey <= 19")
def _(spark, sf_dir):
    some = relational.in_range(table(spark, sf_dir, "customer"), "c_nationkey", 13, 19)
    return relational.project(some, "c_name", "c_nationkey")


@registered("limit_n", "select count(*) as n, count(*) as n_in_table from (select * from orders limit 10) t")
def _(spark, sf_dir):
    """Ten rows of orders, then looked up again in the whole table."""
    orders = table(spark, sf_dir, "orders")
    ten = relational.first_rows(orders, 10)
    again = orders.join(F.broadcast(ten.select("o_orderkey")), "o_orderkey", "left_semi")
    marks = ten.select(F.lit(1).alias("a"), F.lit(0).alias("b")).union(again.select(F.lit(0), F.lit(1)))
    return marks.agg(F.sum("a").cast("bigint").alias("n"), F.sum("b").cast("bigint").alias("n_in_table"))


# ---- joins and sets


@registered(
    "anti_not_in",
    """select * from orders where o_orderkey not in
    (select o_orderkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O')""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    urgent = orders.where("o_orderpriority = '1-URGENT' and o_orderstatus = 'O'")
    return matching.anti_not_in(orders, urgent, "o_orderkey")


@registered(
    "anti_not_in_nulls",
    """select count(*) as n from orders where o_orderkey not in
    (select case when o_orderstatus <> 'P' then o_orderkey end from orders where o_orderpriority = '1-URGENT')""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderkey")
    urgent = orders.where("o_orderpriority = '1-URGENT'").select(key)
    return relational.count_all(matching.anti_not_in(orders, urgent, "o_orderkey"))


@registered(
    "merge_match",
    f"""select coalesce(t.o_orderkey, s.o_orderkey) as k, case when s.o_orderkey is null then 'target'
    when t.o_orderkey is null then 'source' else 'both' end as side
    from orders t full outer join ({INCREMENT_SQL}) s on t.o_orderkey = s.o_orderkey""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return matching.match_sides(orders, order_increment(orders), "o_orderkey")


@registered("union_distinct", "select c_nationkey as k from customer union select s_nationkey as k from supplier")
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return relational.union_distinct(customers, suppliers)


# ---- aggregates


@registered("count_all", "select count(*) as n from lineitem")
def _(spark, sf_dir):
    return relational.count_all(table(spark, sf_dir, "lineitem"))


@registered("count_one", "select count(1) as n from orders")
def _(spark, sf_dir):
    return relational.count_one(table(spark, sf_dir, "orders"))


@registered(
    "sum_by_key",
    """select o_orderstatus, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by o_orderstatus""",
)
def sum_by_status(spark, sf_dir):
    return relational.sum_by_key(table(spark, sf_dir, "orders"), "o_orderstatus", "o_totalprice", exact=True)


@registered(
    "count_by_key",
    "select nullif(o_orderstatus, 'F') as status, count(*) as n from orders group by nullif(o_orderstatus, 'F')",
)
def _(spark, sf_dir):
    status = F.nullif(F.col("o_orderstatus"), F.lit("F"))
    return relational.count_by_key(table(spark, sf_dir, "orders"), status, "status")


@registered("global_fold_sum", "select cast(sum(l_linenumber) as bigint) as total from lineitem")
def _(spark, sf_dir):
    return relational.fold_sum(table(spark, sf_dir, "lineitem"), F.col("l_linenumber"))


@registered(
    "indicator_ratio",
    """select cast(1 as double) * cast(sum(case when o_totalprice > 150000 then 1 else 0 end) as double)
    / cast(count(*) as double) as ratio from orders""",
)
def _(spark, sf_dir):
    """The share of orders above a price."""
    return relational.indicator_ratio(table(spark, sf_dir, "orders"), F.col("o_totalprice") > 150000, 1)


# ---- scalars and SQL functions


@registered("sanitize_identifier", "select p_partkey, regexp_replace(p_name, '[^a-zA-Z0-9]', '_', 'g') as ident from part")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", scalars.sanitize_identifier(F.col("p_name")).alias("ident"))


@registered("typeof_column", "select c_custkey, 'double' as type_name from customer")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", scalars.type_name(F.col("c_acctbal")).alias("type_name"))


@registered(
    "type_label",
    """select c_custkey, case when nullif(c_mktsegment, 'BUILDING') is null then 'Type: NULL'
    else 'Type: java.lang.String' end as type_label from customer""",
)
def _(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    customer = table(spark, sf_dir, "customer").select("c_custkey", segment)
    return customer.select("c_custkey", scalars.type_label(customer, "segment").alias("type_label"))


@registered(
    "register_sql_function",
    """select c_custkey, case when c_nationkey = 0 then 'Type: NULL' else 'Type: java.lang.Double' end as label
    from customer""",
)
def _(spark, sf_dir):
    """The label as a SQL function; the view and the function are dropped once the query is defined."""
    name = Workspace(spark).name
    scalars.register_type_label(spark, name + "_label", DoubleType())
    sql = f"SELECT c_custkey, {name}_label(if(c_nationkey = 0, NULL, c_acctbal)) AS label FROM {name}"
    out = views.query_temp_view(table(spark, sf_dir, "customer"), name, sql)
    views.drop_view(spark, name)
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}_label")
    return out


@registered(
    "permanent_sql_function",
    """select c_custkey, case when c_nationkey = 0 then 'Type: NULL' else 'Type: java.lang.Double' end as label
    from customer""",
)
def _(spark, sf_dir):
    """The label as a function of the catalog, called in a session that did not make it."""
    function = Workspace(spark).table("type_label")
    scalars.create_type_label(spark, function, DoubleType())
    customer = table(spark.newSession(), sf_dir, "customer")
    value = F.when(F.col("c_nationkey") != 0, F.col("c_acctbal"))
    return customer.select("c_custkey", F.call_function(function, value).alias("label"))


# ---- upserts


@registered(
    "upsert_rewrite",
    f"""select * from orders where o_orderkey not in (select o_orderkey from ({INCREMENT_SQL}) s)
    union select * from ({INCREMENT_SQL}) s2""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    live = saved(Workspace(spark), "orders", orders)
    upsert.upsert_rewrite(spark, live, order_increment(orders), "o_orderkey")
    return read(spark, live)


@registered("upsert_merge", MERGED_SQL)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    live = saved(Workspace(spark), "orders", orders)
    upsert.upsert_merge(spark, live, order_increment(orders), "o_orderkey")
    return read(spark, live)


@registered("upsert_merge_bucketed", f"select *, 8 as n_buckets from ({MERGED_SQL}) m")
def _(spark, sf_dir):
    """A merge into orders in buckets of their key: the increment comes to the buckets, whose rows do not move."""
    orders = table(spark, sf_dir, "orders")
    live = Workspace(spark).table("orders")
    tables.create_typed_table(spark, live, orders.schema, buckets=tables.Buckets(("o_orderkey",), 8))
    tables.insert_rows(orders, live)
    # An increment of this size would be broadcast; the limit of 0 bytes treats it as a large one.
    upsert.upsert_merge(spark, live, order_increment(orders), "o_orderkey", broadcast_limit=0)
    return read(spark, live).withColumn("n_buckets", F.lit(tables.buckets_of(spark, live).number))


@registered(
    "merge_counts",
    f"""select cast(sum(case when s.o_orderkey is not null and t.o_orderkey is not null then 1 else 0 end) as bigint)
    as n_updated, cast(sum(case when t.o_orderkey is null then 1 else 0 end) as bigint) as n_inserted,
    cast(sum(case when s.o_orderkey is null then 1 else 0 end) as bigint) as n_kept
    from orders t full outer join ({INCREMENT_SQL}) s on t.o_orderkey = s.o_orderkey""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return matching.merge_counts(orders, order_increment(orders), "o_orderkey")


# ---- streams


def _ingest_events(spark, sf_dir, landings: int, runs: int, replaceable: bool = False) -> DataFrame:
    """Bronze events after landing them in one or two steps, with a stream run after each and extra runs at the end."""
    ws, events = Workspace(spark), table(spark, sf_dir, "events")
    bronze, raw, checkpoint = ws.table("bronze"), ws.path("raw"), ws.path("checkpoint")
    run = ingest.ingest_replaceable if replaceable else ingest.ingest_append
    steps = event_landings(events) if landings == 2 else (events,)
    for i, part in enumerate(steps):
        landing.land_increment(spark, jobs.write_json(part, ws.path("source", str(i))), raw, f"increment_{i}")
        run(spark, raw, bronze, checkpoint, events.schema)
    for _ in range(runs - len(steps)):
        run(spark, raw, bronze, checkpoint, events.schema)
    return read(spark, bronze)


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@registered("stream_ingest_append", f"select {', '.join(EVENT_COLUMNS)}, true as stamped from events")
def _(spark, sf_dir):
    stamped = F.col("source_file").isNotNull() & F.col("processing_time").isNotNull()
    return _ingest_events(spark, sf_dir, 1, 1).select(*EVENT_COLUMNS, stamped.alias("stamped"))


@registered(
    "stream_ingest_incremental",
    f"""select {', '.join(EVENT_COLUMNS)}, case when ts < timestamp '{EVENTS_CUT}' then 'increment_0'
    else 'increment_1' end as landed_in from events""",
)
def _(spark, sf_dir):
    landed_in = F.regexp_extract("source_file", "(increment_[0-9])/[^/]*$", 1)
    return _ingest_events(spark, sf_dir, 2, 2).select(*EVENT_COLUMNS, landed_in.alias("landed_in"))


@registered("stream_ingest_idempotent", "select count(*) as n, count(distinct event_id) as n_ids from events")
def _(spark, sf_dir):
    bronze = _ingest_events(spark, sf_dir, 2, 4)
    return bronze.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"))


@registered("stream_ingest_replaceable", f"select {', '.join(EVENT_COLUMNS)} from events")
def _(spark, sf_dir):
    return _ingest_events(spark, sf_dir, 2, 3, replaceable=True).select(*EVENT_COLUMNS)


@registered(
    "stream_compact",
    f"select {', '.join(EVENT_COLUMNS)}, true as fewer_files, false as compacted_again from events",
)
def _(spark, sf_dir):
    """Two increments, a compaction across their batches (a second one has nothing to do), and a third increment."""
    ws, events = Workspace(spark), table(spark, sf_dir, "events")
    bronze, raw = ws.table("bronze"), ws.path("raw")
    early, last = event_landings(events)
    middle = F.to_timestamp_ntz(F.lit(EVENTS_MIDDLE))

    def run(part: DataFrame, name: str) -> None:
        landing.land_increment(spark, jobs.write_json(part, ws.path("source", name)), raw, name)
        ingest.ingest_replaceable(spark, raw, bronze, ws.path("checkpoint"), events.schema)

    run(early.where(F.col("ts") < middle), "increment_0")
    run(early.where(F.col("ts") >= middle), "increment_1")
    folder = tables.location_of(spark, bronze)
    before = files.file_listing(spark, folder).count()
    upkeep.compact_files(spark, bronze)
    after, again = files.file_listing(spark, folder).count(), upkeep.compact_files(spark, bronze)
    run(last, "increment_2")
    return read(spark, bronze).select(*EVENT_COLUMNS, F.lit(after < before).alias("fewer_files"), F.lit(again).alias("compacted_again"))


@registered(
    "stream_ingest_evolving",
    f"""select event_id, event_type, case when ts < timestamp '{EVENTS_MIDDLE}' then floor(value) else value end as value,
    case when ts < timestamp '{EVENTS_MIDDLE}' then null else props end as props,
    case when ts >= timestamp '{EVENTS_CUT}' then null else user_id end as user_id,
    case when ts >= timestamp '{EVENTS_CUT}' then 'u' || user_id end as rescued_user, 'double' as value_type from events""",
)
def _(spark, sf_dir):
    """Events without props and with whole values; then with both; then with user ids that are no numbers any more."""
    ws, events = Workspace(spark), table(spark, sf_dir, "events")
    bronze, raw = ws.table("bronze"), ws.path("raw")
    early, late = event_landings(events)
    middle = F.to_timestamp_ntz(F.lit(EVENTS_MIDDLE))
    steps = (
        early.where(F.col("ts") < middle).withColumn("value", F.floor("value").cast("bigint")).drop("props"),
        early.where(F.col("ts") >= middle),
        late.withColumn("user_id", F.concat(F.lit("u"), F.col("user_id").cast("string"))),
    )
    for i, part in enumerate(steps):
        landing.land_increment(spark, jobs.write_json(part, ws.path("source", str(i))), raw, f"increment_{i}")
        # Twice, as a job would run again: the second run finds nothing new.
        for _ in range(2):
            evolving.ingest_evolving(spark, raw, bronze, ws.path("checkpoint"), ws.path("schemas"))
    rescued = F.get_json_object(evolving.RESCUED, "$.user_id").alias("rescued_user")
    rows = read(spark, bronze)
    return rows.select("event_id", "event_type", "value", "props", "user_id", rescued, F.typeof("value").alias("value_type"))


@registered(
    "stream_sum_by_key",
    """select event_type, cast(sum(cast(value as decimal(18,2))) as double) as total, count(*) as n_rows
    from events group by event_type""",
)
def _(spark, sf_dir):
    """Totals kept batch by batch: two landings, a fold of the first batch, a late third landing, and a run without news."""
    ws, events = Workspace(spark), table(spark, sf_dir, "events")
    kept, raw = ws.table("totals"), ws.path("raw")
    early, late = event_landings(events)
    middle = F.to_timestamp_ntz(F.lit(EVENTS_MIDDLE))

    def run() -> None:
        totals.ingest_totals(spark, raw, kept, ws.path("checkpoint"), events.schema, "event_type", "value")

    for name, part in (("a", early.where(F.col("ts") >= middle)), ("b", late), ("late", early.where(F.col("ts") < middle))):
        landing.land_increment(spark, jobs.write_json(part, ws.path("source", name)), raw, name)
        run()
        totals.fold_totals(spark, kept, "event_type")
    run()
    now = totals.running_totals(spark, kept, "event_type")
    return now.select("event_type", F.col(totals.TOTAL).cast("double").alias("total"), totals.ROWS)


@registered("stream_upsert", MERGED_TOTALS_SQL)
def _(spark, sf_dir):
    """The increment, and then, late, the former state of the orders it changes, which is older by the order columns."""
    ws, orders = Workspace(spark), table(spark, sf_dir, "orders")
    live, raw = saved(ws, "orders", orders), ws.path("raw")
    former = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"))
    for name, rows in (("increment", order_increment(orders)), ("late", former)):
        landing.land_increment(spark, jobs.write_json(rows, ws.path("source", name)), raw, name)
        ingest.ingest_upsert(
            spark, raw, live, ws.path("checkpoint"), orders.schema, "o_orderkey", ["o_orderdate", "o_totalprice"]
        )
    return jobs.totals(read(spark, live), "o_orderstatus", "o_totalprice")


@registered(
    "bronze_sum_by_key",
    """select event_type, cast(sum(cast(value as decimal(18,2))) as double) as total from events group by event_type""",
)
def _(spark, sf_dir):
    return relational.sum_by_key(_ingest_events(spark, sf_dir, 2, 2), "event_type", "value", exact=True)


# ---- the whole job


@registered("end_to_end", MERGED_TOTALS_SQL)
def end_to_end(spark, sf_dir):
    ws, orders = Workspace(spark), table(spark, sf_dir, "orders")
    snapshot = jobs.write_json(orders, ws.path("source", "snapshot"))
    increment = jobs.write_json(order_increment(orders), ws.path("source", "increment"))
    live, _ = jobs.incremental_load(ws, snapshot, increment, orders.schema, "o_orderkey")
    return jobs.totals(read(spark, live), "o_orderstatus", "o_totalprice")
