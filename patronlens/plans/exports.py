"""The dashboard's fact table and its three summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.columns import decimal_mean, mean, month_bucket, risk_band
from patronlens.operators.ranking import quantile_score

# The dashboard's columns and business names.
DASHBOARD_COLUMNS = [
    "customer_id", "customer_name", "region", "country", "customer_type",
    "segment", "customer_value", "clv_historical", "revenue", "purchase_frequency",
    "avg_order_value", "recency_days", "last_purchase", "signup_date",
    "churn_probability", "predicted_churn",
    "favorite_category", "recommended_product", "recommendation_score",
    "top_purchase_channel", "total_sessions", "avg_csat", "total_tickets",
    "RFM_score", "RFM_total", "email_opt_in",
]

RENAMED = {
    "clv_predicted": "customer_value",
    "monetary": "revenue",
    "frequency": "purchase_frequency",
    "last_purchase_date": "last_purchase",
    "segment_name": "segment",
}

# Value tiers from the lowest quarter to the highest.
TIERS = ["Bronze", "Silver", "Gold", "Platinum"]


def value_tiers(df: DataFrame, value: str = "customer_value", out: str = "value_tier") -> DataFrame:
    """Quarter of the customers by value, as a name. `df` should be a written table."""
    scored = quantile_score(df, value, len(TIERS), "_quarter")
    tier = F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("_quarter"))
    return scored.withColumn(out, tier).drop("_quarter")


def dashboard(customers: DataFrame) -> DataFrame:
    """One row per customer under business names, with risk band and value tier.

    Columns that the customer table does not have yet are left out.
    """
    renamed = customers.drop("segment").withColumnsRenamed(RENAMED)
    chosen = renamed.select(*[c for c in DASHBOARD_COLUMNS if c in renamed.columns])
    return value_tiers(chosen.withColumn("churn_risk_band", risk_band("churn_probability")))


def segment_summary(dashboard: DataFrame) -> DataFrame:
    return (
        dashboard.where(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.bround(decimal_mean("customer_value"), 2).alias("avg_customer_value"),
            F.bround(F.coalesce(F.sum("revenue"), F.lit(0)), 2).alias("total_revenue"),
            F.bround(decimal_mean("churn_probability"), 2).alias("avg_churn_probability"),
            F.bround(decimal_mean("purchase_frequency"), 2).alias("avg_purchase_frequency"),
            F.count_if(F.col("churn_risk_band") == "High Risk").alias("high_risk_customers"),
        )
        .orderBy(F.col("total_revenue").desc())
    )


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue, distinct orders and distinct customers per month with sales.

    Lines are first reduced to (month, order, customer). The distinct counts then work on
    that smaller table, and one big month is already spread over its orders.
    """
    per_order = (
        sales.where(F.col("order_date").isNotNull())
        .groupBy(month_bucket("order_date").alias("order_month"), "order_id", "customer_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        per_order.groupBy("order_month")
        .agg(
            F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
            F.countDistinct("order_id").alias("orders"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .orderBy("order_month")
    )


def times_recommended(customers: DataFrame) -> DataFrame:
    return (
        customers.where(F.col("recommended_product").isNotNull())
        .groupBy(F.col("recommended_product").alias("product_name"))
        .agg(F.count("*").alias("times_recommended"))
    )


def product_totals(sales: DataFrame) -> DataFrame:
    keys = ["product_id", "product_name", "category"]
    return sales.dropna(subset=keys).groupBy(*keys).agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("units_sold"),
        mean("unit_price").alias("avg_price"),
    )


def dim_products(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Product totals and how often each product is recommended."""
    joined = product_totals(sales).join(times_recommended(customers), "product_name", "left")
    return joined.select(
        "product_id", "product_name", "category", "total_revenue", "units_sold", "avg_price",
        F.coalesce("times_recommended", F.lit(0)).alias("times_recommended"),
    )
