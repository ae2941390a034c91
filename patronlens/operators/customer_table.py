"""One row per customer from the five sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.columns import (
    churn_flag,
    full_name,
    predicted_clv,
    purchases_per_year,
    retention_factor,
    tenure_years,
    whole_days,
)
from patronlens.operators.cleaning import clean_source, fill_from, fill_with_mean, fill_zero
from patronlens.operators.features import (
    marketing_features,
    purchase_profile,
    support_features,
    web_features,
)
from patronlens.operators.ranking import quantile_scores
from patronlens.workspace import materialize

# The columns of the customer table, in order.
CUSTOMER_COLUMNS = [
    "customer_id", "customer_name", "region", "country", "customer_type", "signup_date",
    "preferred_channel", "email_opt_in",
    "recency_days", "frequency", "monetary", "R_score", "F_score", "M_score", "RFM_score", "RFM_total",
    "clv_historical", "clv_predicted", "tenure_years", "purchase_freq_per_year", "avg_order_value",
    "favorite_category", "last_product_purchased", "top_purchase_channel", "total_units",
    "last_purchase_date", "first_purchase_date",
    "total_sessions", "avg_pages_per_session", "avg_time_on_site", "cart_adds", "days_since_last_session",
    "total_tickets", "avg_csat", "avg_resolution_hours", "escalation_rate",
    "total_touches", "open_rate", "conversion_rate",
    "churned",
]

# Columns that are 0 for customers without activity.
ZERO_FILLED = [
    "frequency", "monetary", "avg_order_value", "total_units", "total_sessions",
    "avg_pages_per_session", "avg_time_on_site", "cart_adds", "total_tickets",
    "avg_resolution_hours", "escalation_rate", "total_touches", "open_rate", "conversion_rate",
]


# Score column: (value, ascending).
RFM_SPECS = {
    "R_score": ("recency_days", True),
    "F_score": ("frequency", False),
    "M_score": ("monetary", False),
}


def rfm_scores(orders: DataFrame, best_score: int = 1) -> DataFrame:
    """Recency, frequency and spend quintiles of a written per-customer table.

    By default 1 is best: the latest, most frequent and highest spending fifth. With
    `best_score=5` the scale is mirrored.
    """
    scored = quantile_scores(orders, RFM_SPECS, 5)
    if best_score == 5:
        scored = scored.withColumns({c: F.lit(6) - F.col(c) for c in RFM_SPECS})
    digits = [F.col(c).cast("string") for c in RFM_SPECS]
    total = F.col("R_score") + F.col("F_score") + F.col("M_score")
    return scored.withColumns({"RFM_score": F.concat(*digits), "RFM_total": total})


def add_clv(df: DataFrame, as_of, years=3, weight=0.6, lo=0.1, hi=0.95) -> DataFrame:
    rated = df.withColumn("tenure_years", tenure_years(as_of)).withColumn(
        "purchase_freq_per_year", purchases_per_year()
    )
    kept = retention_factor(weight=weight, lo=lo, hi=hi)
    return rated.withColumns(
        {"clv_historical": F.bround("monetary", 2), "clv_predicted": predicted_clv(kept, years)}
    )


def add_churn_label(df: DataFrame, as_of, **thresholds) -> DataFrame:
    return df.withColumn("churned", churn_flag(as_of, **thresholds))


def build_customer_table(
    customers: DataFrame,
    sales: DataFrame,
    web: DataFrame,
    support: DataFrame,
    marketing: DataFrame,
    as_of,
    best_score: int = 1,
) -> DataFrame:
    """The 40-column customer table.

    Every source is reduced to one row per customer before it is joined, so the joins see
    unique keys. The reduced purchases are written once: the quintile cuts and the scoring
    projection both read them and do not go back to the order lines.
    """
    customers, sales, web, support, marketing = (
        clean_source(df) for df in (customers, sales, web, support, marketing)
    )
    purchases = rfm_scores(materialize(purchase_profile(sales, as_of), "purchases"), best_score)
    tickets = support_features(support)

    wide = (
        customers.join(purchases, "customer_id", "left")
        .join(web_features(web, as_of), "customer_id", "left")
        .join(tickets, "customer_id", "left")
        .join(marketing_features(marketing), "customer_id", "left")
    )
    wide = fill_from(
        fill_zero(wide, ZERO_FILLED),
        recency_days=whole_days(as_of, "signup_date"),
        top_purchase_channel=F.col("preferred_channel"),
        favorite_category=F.lit("None"),
        last_product_purchased=F.lit("None"),
        **{score: F.lit(1) for score in RFM_SPECS},
        RFM_total=F.lit(len(RFM_SPECS)),
    )
    known = customers.select("customer_id").join(tickets.select("customer_id", "avg_csat"), "customer_id")
    wide = fill_with_mean(wide, "avg_csat", known)

    labelled = add_churn_label(add_clv(wide, as_of), as_of)
    return labelled.withColumn("customer_name", full_name()).select(*CUSTOMER_COLUMNS)
