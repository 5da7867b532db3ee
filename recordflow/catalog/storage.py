"""Sources, sinks and table maintenance, each as a round trip through files."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.catalog.registry import query
from recordflow.catalog.roles import with_roles
from recordflow.functions import dates
from recordflow.operators import filters
from recordflow.session import scratch_path
from recordflow.sources import events, loads, summaries, tables

DEC = "decimal(38,4)"


def _amount():
    return F.col("o_totalprice").cast("decimal(26,4)")


def _orders(t):
    return t.orders.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", _amount().alias("amount"), F.col("o_orderdate").cast("date").alias("day")
    )


_ORDERS_SQL = """SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(26,4)) AS amount,
CAST(o_orderdate AS DATE) AS day FROM orders"""


@query("scan_pruned", "SELECT o_orderkey, amount FROM (" + _ORDERS_SQL + ") WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def _(t):
    path = scratch_path(t.spark, "orders")
    tables.write_partitioned(_orders(t), path, ["o_orderstatus", "o_orderpriority"])
    stored = tables.read_table(t.spark, path, _orders(t).schema)
    keep = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return stored.where(keep).select("o_orderkey", "amount")


@query("truncate_read", "SELECT s_suppkey, s_name FROM supplier")
def _(t):
    """A table that was emptied stays readable and takes new rows of its schema."""
    path = scratch_path(t.spark, "emptied")
    people = t.customer.select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"))
    people.write.parquet(path)
    tables.truncate_with_schema(t.spark, path, people.schema)
    tables.insert_into(t.supplier.select("s_suppkey", "s_name"), path)
    return tables.read_table(t.spark, path, people.schema)


@query("partitioned_roundtrip", _ORDERS_SQL)
def _(t):
    path = scratch_path(t.spark, "orders")
    tables.write_partitioned(_orders(t), path, ["o_orderstatus", "o_orderpriority"])
    return tables.read_table(t.spark, path, _orders(t).schema)


@query(
    "dynamic_overwrite",
    """SELECT c_custkey, c_name, DATE '2025-04-01' AS logical_date FROM customer UNION ALL
    SELECT s_suppkey, s_name, DATE '2025-04-02' FROM supplier""",
)
def _(t):
    path = scratch_path(t.spark, "dated")
    people = t.customer.select("c_custkey", "c_name")
    vendors = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    tables.write_dated(people, path, "2025-04-01")
    tables.write_dated(people, path, "2025-04-02")
    tables.write_dated(vendors, path, "2025-04-02")
    return tables.read_table(t.spark, path).select("c_custkey", "c_name", "logical_date")


@query(
    "staged_chain",
    """SELECT c_mktsegment, count(*) AS n, CAST(sum(total) AS DECIMAL(38,4)) AS total FROM
    (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(26,4))) AS total FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def _(t):
    tables.ctas(t.orders.groupBy("o_custkey").agg(F.sum(_amount()).alias("total")), "staged_totals")
    staged = t.spark.table("staged_totals")
    joined = tables.ctas(staged.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), "staged_joined")
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum("total").cast(DEC).alias("total"))


@query("copy_table", "SELECT p_partkey, p_name, p_type FROM part")
def _(t):
    return tables.copy_table(t.part.select("p_partkey", "p_name", "p_type"), scratch_path(t.spark, "copy"))


@query("append_rows", "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(t):
    path = scratch_path(t.spark, "append")
    tables.insert_into(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), path)
    tables.insert_into(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    return tables.read_table(t.spark, path)


@query(
    "dyn_partition_insert",
    """SELECT c_custkey, CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 WHEN c_acctbal > 0 THEN 2 ELSE 0 END AS INTEGER) AS stmnt FROM customer""",
)
def _(t):
    path = scratch_path(t.spark, "dynamic")
    kind = F.when(F.col("c_mktsegment") == "HOUSEHOLD", 1).when(F.col("c_acctbal") > 0, 2).otherwise(0)
    rows = t.customer.select("c_custkey", kind.alias("stmnt"))
    tables.insert_dynamic_partition(rows.where(F.col("stmnt") == 1), path, "stmnt")
    tables.insert_dynamic_partition(rows.where(F.col("stmnt") != 1), path, "stmnt")
    return tables.read_table(t.spark, path, rows.schema)


@query(
    "bulk_load",
    """SELECT s_suppkey AS id, s_name AS name, 'b1' AS load_batch FROM supplier UNION ALL SELECT c_custkey, c_name, 'b2' FROM customer""",
)
def _(t):
    first, second, target = (scratch_path(t.spark, n) for n in ("in1", "in2", "loaded"))
    t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).write.parquet(first)
    t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).write.parquet(second)
    tables.load_files(t.spark, first, target, "b1", overwrite=True)
    tables.load_files(t.spark, second, target, "b2")
    tables.load_files(t.spark, second, target, "b2")  # a repeated load replaces its batch
    return tables.read_table(t.spark, target).select("id", "name", "load_batch")


@query(
    "summary_refresh",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(26,4))) AS DECIMAL(38,4)) AS total FROM orders GROUP BY 1""",
)
def _(t):
    aggs = {"n": F.count("*"), "total": F.sum(_amount()).cast(DEC)}
    return tables.refresh_aggregate(t.orders, scratch_path(t.spark, "summary"), ["o_orderstatus"], aggs)


@query(
    "summary_incremental",
    """SELECT o_custkey, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,4)) AS total, min(amount) AS least, max(amount) AS most,
    CAST(CAST(sum(amount) AS DOUBLE) / count(*) AS DOUBLE) AS mean FROM (
      SELECT o_custkey, year(o_orderdate) AS y, CAST(o_totalprice AS DECIMAL(26,4)) AS amount FROM orders
      UNION ALL SELECT o_custkey, 1997, CAST(o_totalprice AS DECIMAL(26,4)) FROM orders WHERE year(o_orderdate) = 2000)
    WHERE y <> 1995 AND NOT (y = 1996 AND o_custkey % 2 = 0) GROUP BY o_custkey""",
)
def _(t):
    """A summary refreshed after a new file, a replaced folder and a removed one."""
    source, root = scratch_path(t.spark, "by-year"), scratch_path(t.spark, "summary")
    rows = t.orders.select("o_custkey", _amount().alias("amount"), F.year("o_orderdate").alias("y"))
    tables.write_partitioned(rows, source, ["y"])
    amount = F.col("amount")
    measures = {
        "n": summaries.Measure("count"),
        "total": summaries.Measure("sum", amount, DEC),
        "least": summaries.Measure("min", amount),
        "most": summaries.Measure("max", amount),
        "mean": summaries.Measure("avg", amount.cast("double")),
    }

    def refresh():
        return summaries.refresh_by_partition(t.spark, source, root, "y", ["o_custkey"], measures)

    refresh()
    rows.where("y = 2000").withColumn("y", F.lit(1997)).write.mode("append").partitionBy("y").parquet(source)
    rows.where("y = 1996 and o_custkey % 2 <> 0").drop("y").write.mode("overwrite").parquet(f"{source}/y=1996")
    tables.remove_path(t.spark, f"{source}/y=1995")
    return refresh().summary


@query(
    "bulk_move",
    """SELECT s_suppkey AS id, s_name AS name, 'b1' AS load_batch FROM supplier UNION ALL SELECT c_custkey, c_name, 'b2' FROM customer""",
)
def _(t):
    """Files moved into the table instead of being read and written again."""
    first, second, target = (scratch_path(t.spark, n) for n in ("in1", "in2", "moved"))
    t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).write.parquet(first)
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    people.write.parquet(second)
    loads.move_files(t.spark, first, target, "b1")
    loads.move_files(t.spark, second, target, "b2")
    loads.move_files(t.spark, second, target, "b2")  # nothing is left to move
    return loads.read_loaded(t.spark, target, people.schema).select("id", "name", "load_batch")


@query(
    "ingest_files",
    with_roles("event_rows")
    + """ SELECT event_id, tenant_id, split_part(customer_id, '_', 1) AS partition_id, strftime(logical_date, '%Y-%m-%d') AS logical_date FROM event_rows""",
)
def _(t):
    path = scratch_path(t.spark, "events")
    rows = t.event_rows.select(
        "event_id",
        "tenant_id",
        events.domain_partition("customer_id").alias("partition_id"),
        dates.to_epoch_day("logical_date").alias("logical_date"),
    )
    events.ingest_files(rows, path)
    return tables.read_table(t.spark, path, events.date_text(rows).schema)


@query(
    "delta_history",
    with_roles("event_rows")
    + """ SELECT logical_date, count(*) AS n FROM event_rows WHERE logical_date < DATE '2024-01-15' GROUP BY 1""",
)
def _(t):
    path = scratch_path(t.spark, "deltas")
    tables.write_partitioned(t.event_rows.select("event_id", "logical_date"), path, ["logical_date"])
    stored = tables.read_table(t.spark, path)
    return filters.prior_dates(stored, "logical_date", "2024-01-15").groupBy("logical_date").agg(F.count("*").alias("n"))
