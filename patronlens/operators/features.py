"""Aggregates from one source to one row per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronlens.functions.columns import mean, whole_days


def top_by(df: DataFrame, partition: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First `n` rows of each group in the given order."""
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def _with_ages(df: DataFrame, as_of) -> DataFrame:
    return df.withColumns(
        {
            "recency_days": whole_days(as_of, "last_purchase_date"),
            "customer_tenure_days": whole_days(as_of, "first_purchase_date"),
        }
    )


def order_features(sales: DataFrame, as_of) -> DataFrame:
    """Orders, spend, first and last purchase per customer.

    `avg_order_value` is the mean line revenue; `frequency` counts distinct orders.
    """
    base = (
        sales.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.countDistinct("order_id").alias("frequency"),
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("monetary"),
            F.max("order_date").alias("last_purchase_date"),
            F.min("order_date").alias("first_purchase_date"),
            mean("revenue").alias("avg_order_value"),
            F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_units"),
        )
    )
    return _with_ages(base, as_of)


def favorite_category(sales: DataFrame) -> DataFrame:
    """Category of highest revenue per customer, the first by name on a tie."""
    spent = (
        sales.dropna(subset=["customer_id", "category"])
        .groupBy("customer_id", "category")
        .agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("spent"))
    )
    best = F.min(F.struct((-F.col("spent")).alias("_rank"), F.col("category")))
    return spent.groupBy("customer_id").agg(best["category"].alias("favorite_category"))


def top_channel(sales: DataFrame) -> DataFrame:
    """Channel with most order lines per customer, the first by name on a tie."""
    used = (
        sales.dropna(subset=["customer_id", "sales_channel"])
        .groupBy("customer_id", "sales_channel")
        .agg(F.count("order_id").alias("lines"))
    )
    best = F.min(F.struct((-F.col("lines")).alias("_rank"), F.col("sales_channel")))
    return used.groupBy("customer_id").agg(best["sales_channel"].alias("top_purchase_channel"))


def last_product(sales: DataFrame) -> DataFrame:
    """Product of the latest line; ties by order id, then product name, both descending."""
    latest = F.max(F.struct("order_date", "order_id", "product_name"))
    return (
        sales.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(latest["product_name"].alias("last_product_purchased"))
    )


def purchase_profile(sales: DataFrame, as_of) -> DataFrame:
    """`order_features`, `favorite_category`, `top_channel` and `last_product` together.

    Grouping sets reduce the lines in one pass to (customer, order), (customer, category)
    and (customer, channel) cells. The cells spread a customer with very many lines over
    all tasks; one further aggregate brings them to one row per customer. Only the last
    product needs a second look at the lines, on four columns of the same cleaned rows.
    """
    lines = sales.where(F.col("customer_id").isNotNull())
    keys = ["customer_id", "order_id", "category", "sales_channel"]
    cells = lines.groupingSets(
        [["customer_id", "order_id"], ["customer_id", "category"], ["customer_id", "sales_channel"]],
        *keys,
    ).agg(
        F.grouping_id().alias("cell"),
        F.sum("revenue").alias("revenue"),
        F.count("revenue").alias("revenue_lines"),
        F.count("order_id").alias("order_lines"),
        F.sum("quantity").alias("units"),
        F.max("order_date").alias("last_date"),
        F.min("order_date").alias("first_date"),
    )
    # grouping_id has one bit per key of `keys`, set where the key is not part of the cell.
    of_order, of_category, of_channel = (F.col("cell") == bits for bits in (0b0011, 0b0101, 0b0110))
    no_money = F.lit(0)
    category_rank = F.struct(
        (-F.coalesce("revenue", no_money)).alias("_rank"), F.col("category").alias("name")
    )
    channel_rank = F.struct((-F.col("order_lines")).alias("_rank"), F.col("sales_channel").alias("name"))
    base = cells.groupBy("customer_id").agg(
        F.count(F.when(of_order, F.col("order_id"))).alias("frequency"),
        F.coalesce(F.sum(F.when(of_order, F.col("revenue"))), no_money).alias("monetary"),
        F.max("last_date").alias("last_purchase_date"),
        F.min("first_date").alias("first_purchase_date"),
        F.try_divide(
            F.sum(F.when(of_order, F.col("revenue"))).cast("double"),
            F.sum(F.when(of_order, F.col("revenue_lines"))).cast("double"),
        ).alias("avg_order_value"),
        F.coalesce(F.sum(F.when(of_order, F.col("units"))), F.lit(0)).alias("total_units"),
        F.min(F.when(of_category & F.col("category").isNotNull(), category_rank))["name"].alias(
            "favorite_category"
        ),
        F.min(F.when(of_channel & F.col("sales_channel").isNotNull(), channel_rank))["name"].alias(
            "top_purchase_channel"
        ),
    )
    return _with_ages(base, as_of).join(last_product(sales), "customer_id", "left")


def web_features(web: DataFrame, as_of) -> DataFrame:
    base = (
        web.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.countDistinct("session_id").alias("total_sessions"),
            mean("pages_viewed").alias("avg_pages_per_session"),
            mean("time_on_site_min").alias("avg_time_on_site"),
            F.coalesce(F.sum("added_to_cart"), F.lit(0)).alias("cart_adds"),
            F.max("session_date").alias("last_session_date"),
        )
    )
    return base.withColumn("days_since_last_session", whole_days(as_of, "last_session_date"))


def support_features(support: DataFrame) -> DataFrame:
    return (
        support.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.countDistinct("ticket_id").alias("total_tickets"),
            mean("csat_score").alias("avg_csat"),
            mean("resolution_time_hours").alias("avg_resolution_hours"),
            mean("escalated").alias("escalation_rate"),
        )
    )


def marketing_features(marketing: DataFrame) -> DataFrame:
    return (
        marketing.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.countDistinct("touch_id").alias("total_touches"),
            mean("opened").alias("open_rate"),
            mean("converted").alias("conversion_rate"),
        )
    )
