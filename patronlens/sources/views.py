"""The five customer sources as views over the star-schema test tables.

Product is `p_name` and customer is `c_custkey`. Suppliers are accounts too: they never
buy, under ids that start at `SUPPLIER_IDS`. Event dates are moved back so that the last
one lies one day before the as-of date.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patronlens.functions.columns import line_revenue

AS_OF = datetime.date(2001, 8, 2)
EVENT_SHIFT_DAYS = 8217
SUPPLIER_IDS = 10**15
CHANNELS = ["Online", "In-Store", "Marketplace", "B2B Direct"]
# Bytes of stored order lines whose rows a task of the sales holds (some 170,000 lines).
TASK_BYTES = 2 << 20


_layouts: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its layout is read from the file once and declared afterwards."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _layouts:
        _layouts[key] = spark.read.parquet(path).schema
    return spark.read.schema(_layouts[key]).parquet(path)


def _channel(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (number % 4 + 1).cast("int"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers sign up to a year before their first order, suppliers within the last year."""
    first_order = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("first_order"))
    )
    start = F.coalesce(F.col("first_order"), F.lit(datetime.date(1995, 1, 1)))
    buyers = (
        table(spark, sf_dir, "customer")
        .join(first_order, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("n_nationkey"),
            F.col("c_mktsegment").alias("customer_type"),
            F.date_sub(start, (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
        )
    )
    last_day = F.lit(AS_OF - datetime.timedelta(days=1))
    suppliers = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + SUPPLIER_IDS).alias("customer_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("n_nationkey"),
        F.lit("SUPPLIER").alias("customer_type"),
        F.date_sub(last_day, (F.col("s_suppkey") * 7 % 365).cast("int")).alias("signup_date"),
    )
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    placed = (
        buyers.unionByName(suppliers)
        .join(nation, "n_nationkey")
        .join(table(spark, sf_dir, "region"), "r_regionkey")
    )
    key = F.col("customer_id")
    return placed.select(
        key,
        F.split_part("name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        "customer_type",
        "signup_date",
        _channel(key).alias("preferred_channel"),
        F.when(key % 100 < 72, 1).otherwise(0).alias("email_opt_in"),
    )


def stored_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def sales_lines(orders: DataFrame, lines: DataFrame, parts: DataFrame, tasks: int | None = None) -> DataFrame:
    """Order header, line and product flattened to one row per order line.

    With `tasks` the lines come dealt by order over so many tasks. The orders are joined last, so what is done per line,
    order or whole row next (duplicates, orders of a customer) finds its rows together.
    """
    named = lines.join(parts, lines.l_partkey == parts.p_partkey)
    if tasks:
        named, orders = named.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    joined = named.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("p_name").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_discount").cast("decimal(3,2)").alias("discount_pct"),
        line_revenue("l_extendedprice", "l_discount").alias("revenue"),
        _channel(F.col("l_orderkey") + F.col("l_linenumber")).alias("sales_channel"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    tasks = max(1, -(-stored_bytes(spark, f"{sf_dir}/lineitem.parquet") // TASK_BYTES))
    return sales_lines(table(spark, sf_dir, "orders"), lines, table(spark, sf_dir, "part"), tasks)


def _events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin(*types))
    return events.select(
        F.col("event_id"),
        F.col("user_id").alias("customer_id"),
        F.date_sub(F.col("ts").cast("date"), EVENT_SHIFT_DAYS).alias("day"),
        "event_type",
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "click", "view", "purchase").select(
        F.col("event_id").alias("session_id"),
        "customer_id",
        F.col("day").alias("session_date"),
        (F.lit(1) + F.col("k") % 10).alias("pages_viewed"),
        F.col("amount").alias("time_on_site_min"),
        (F.col("event_type") == "purchase").cast("int").alias("added_to_cart"),
    )


def support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "error").select(
        F.col("event_id").alias("ticket_id"),
        "customer_id",
        F.col("day").alias("ticket_date"),
        F.col("amount").alias("resolution_time_hours"),
        (F.lit(1) + F.col("k") % 5).alias("csat_score"),
        (F.col("k") < 20).cast("int").alias("escalated"),
    )


def marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "signup").select(
        F.col("event_id").alias("touch_id"),
        "customer_id",
        F.col("day").alias("sent_date"),
        (F.col("k") >= 40).cast("int").alias("opened"),
        (F.col("k") >= 90).cast("int").alias("converted"),
    )
