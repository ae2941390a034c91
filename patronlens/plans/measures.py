"""Dashboard measures and views over the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.columns import color_band, decimal_mean

HIGH = "High Risk"

EXPLORER_COLUMNS = [
    "customer_id", "customer_value", "churn_probability", "segment", "revenue",
    "purchase_frequency", "last_purchase", "recommended_product",
]
SLICERS = ["segment", "churn_risk_band", "value_tier", "region", "favorite_category"]

Filters = Mapping[str, Sequence]


def slice_by(dashboard: DataFrame, filters: Filters | None = None) -> DataFrame:
    for column, values in (filters or {}).items():
        dashboard = dashboard.where(F.col(column).isin(*values))
    return dashboard


def kpi_cards(dashboard: DataFrame) -> DataFrame:
    return dashboard.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
        F.count("customer_id").alias("total_customers"),
        decimal_mean("churn_probability").alias("avg_churn_probability"),
        decimal_mean("customer_value").alias("avg_customer_value"),
    )


def risk_kpis(dashboard: DataFrame) -> DataFrame:
    """High-risk customers, the revenue they stand for, and the predicted churn rate."""
    high = F.col("churn_risk_band") == HIGH
    churned = F.count_if(F.col("predicted_churn") == 1).cast("double")
    return dashboard.agg(
        F.count_if(high).alias("high_risk_customers"),
        F.coalesce(F.sum(F.when(high, F.col("revenue"))), F.lit(0)).alias("revenue_at_risk"),
        F.try_divide(churned, F.count("*")).alias("churn_rate"),
    )


def measures(dashboard: DataFrame, filters: Filters | None = None) -> DataFrame:
    """All six measures in one row, under the given slicers."""
    chosen = slice_by(dashboard, filters)
    high = F.col("churn_risk_band") == HIGH
    return chosen.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
        decimal_mean("churn_probability").alias("avg_churn_probability"),
        F.count_if(high).alias("high_risk_customers"),
        F.coalesce(F.sum(F.when(high, F.col("revenue"))), F.lit(0)).alias("revenue_at_risk"),
        decimal_mean("customer_value").alias("avg_customer_lifetime_value"),
        F.try_divide(F.count_if(F.col("predicted_churn") == 1).cast("double"), F.count("*")).alias("churn_rate"),
    )


def segment_counts(dashboard: DataFrame) -> DataFrame:
    known = dashboard.where(F.col("segment").isNotNull())
    return known.groupBy("segment").agg(F.count("customer_id").alias("customer_count"))


def risk_band_counts(dashboard: DataFrame) -> DataFrame:
    return dashboard.groupBy("churn_risk_band").agg(F.count("customer_id").alias("customer_count"))


def reco_by_segment(dashboard: DataFrame) -> DataFrame:
    """Customers per recommended product and segment."""
    known = dashboard.dropna(subset=["recommended_product", "segment"])
    return known.groupBy("recommended_product", "segment").agg(F.count("*").alias("customer_count"))


def explorer(dashboard: DataFrame, filters: Filters | None = None) -> DataFrame:
    """The requested fields of the sliced customers with their display colour, best first."""
    chosen = slice_by(dashboard, filters).select(*EXPLORER_COLUMNS)
    return chosen.withColumn("color", color_band("churn_probability")).orderBy(
        F.col("customer_value").desc(), "customer_id"
    )


def top_customers(dashboard: DataFrame, n: int = 20) -> DataFrame:
    return dashboard.orderBy(F.col("customer_value").desc(), "customer_id").limit(n)


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    return products.orderBy(F.col("total_revenue").desc(), "product_name").limit(n)


def retention_targets(dashboard: DataFrame, tier: str = "Platinum") -> DataFrame:
    """Customers of high value and high churn risk, most valuable first."""
    chosen = dashboard.where((F.col("churn_risk_band") == HIGH) & (F.col("value_tier") == tier))
    return chosen.select(
        "customer_id", "segment", "customer_value", "churn_probability", "revenue"
    ).orderBy(F.col("customer_value").desc(), "customer_id")


def recommended_product_details(dashboard: DataFrame, products: DataFrame) -> DataFrame:
    """Each customer's recommended product with the product's category and totals."""
    details = products.select(
        F.col("product_name").alias("recommended_product"), "category", "total_revenue", "units_sold"
    )
    return dashboard.select("customer_id", "recommended_product").join(
        details, "recommended_product", "left"
    )
