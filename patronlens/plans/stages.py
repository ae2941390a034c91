"""Stage tables over the test inputs, written once per session and input folder.

The stages hand over written tables: customer table, then segments, scores and
recommendations on top of it. Queries that need a stage read it from here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.functions.columns import predicted_flag
from patronlens.operators import affinity, churn, recommend, segments
from patronlens.operators.customer_table import build_customer_table
from patronlens.operators.trees import TreeEnsemble
from patronlens.plans import exports
from patronlens.sources import views
from patronlens.workspace import materialize, on_clear

_tables: dict[tuple[str, str, str], DataFrame] = {}
_models: dict[tuple[str, str, str], churn.Model] = {}


def reset() -> None:
    """Forget all stages; the next query that needs one builds it again."""
    _tables.clear()
    _models.clear()


on_clear.append(reset)


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, name


def _table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = _key(spark, sf_dir, name)
    if key not in _tables:
        _tables[key] = materialize(build(), name)
    return _tables[key]


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A result that several queries read, written once."""
    return _table(spark, sf_dir, name, build)


def _model(spark: SparkSession, sf_dir: str, name: str, fit: Callable[[], churn.Model]) -> churn.Model:
    key = _key(spark, sf_dir, name)
    if key not in _models:
        _models[key] = fit()
    return _models[key]


def new_customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [view(spark, sf_dir) for view in (views.customers, views.sales, views.web, views.support, views.marketing)]
    return build_customer_table(*sources, as_of=views.AS_OF)


def customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer_table", lambda: new_customer_table(spark, sf_dir))


# Columns of the order lines that products and recommendations are made from.
_SOLD = ["order_id", "customer_id", "order_date", "product_id", "product_name", "category", "quantity", "unit_price", "revenue"]


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines with their products, joined once for all that is told from baskets and the catalogue."""
    return _table(spark, sf_dir, "sold", lambda: views.sales(spark, sf_dir).select(*_SOLD))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "products", lambda: affinity.product_dimension(sold(spark, sf_dir)))


def bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condensed sales."""
    return _table(spark, sf_dir, "bought", lambda: recommend.condensed(sold(spark, sf_dir)))


def fixed_score(multiplier: int = 7919):
    """A stand-in probability that any engine can compute from the customer id."""
    digits = (F.col("customer_id") % 10000 * multiplier % 10000).cast("decimal(9,0)")
    return (digits / F.lit(10000).cast("decimal(9,0)")).cast("decimal(5,4)")


def with_fixed_scores(customers: DataFrame) -> DataFrame:
    segmented = customers.withColumn("segment", (F.col("customer_id") % 5).cast("int"))
    return segmented.withColumn("churn_probability", fixed_score()).withColumn(
        "predicted_churn", predicted_flag("churn_probability")
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer table with segment, name, probability and recommendation."""

    def build() -> DataFrame:
        customers = customer_table(spark, sf_dir)
        named = segments.with_segment_names(with_fixed_scores(customers))
        best = recommend.recommend_by_affinity(customers, sold(spark, sf_dir), products(spark, sf_dir), bought(spark, sf_dir))
        # A stand-in for the model's score, as the churn probability has one.
        none = F.lit(0).cast("decimal(5,4)")
        score = F.when(F.col("recommended_product") != "None", fixed_score(3331)).otherwise(none)
        return named.join(best.withColumn("recommendation_score", score), "customer_id", "left")

    return _table(spark, sf_dir, "enriched", build)


def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(
        spark, sf_dir, "dashboard", lambda: exports.dashboard(enriched(spark, sf_dir))
    )


def churn_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(
        spark, sf_dir, "churn_split", lambda: churn.churn_split(customer_table(spark, sf_dir))
    )


def churn_model(spark: SparkSession, sf_dir: str, kind: str) -> churn.Model:
    train = churn_split(spark, sf_dir).where("is_test = 0")
    return _model(spark, sf_dir, f"churn_{kind}", lambda: churn.fit_churn(train, kind))


def churn_predictions(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Scores of the held-out customers."""
    test = churn_split(spark, sf_dir).where("is_test = 1")
    return _table(spark, sf_dir, f"predictions_{kind}", lambda: churn.predict(churn_model(spark, sf_dir, kind), test))


def reco_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training pairs with features and an 80/20 split by label."""

    def build() -> DataFrame:
        pairs = recommend.reco_features(
            sold(spark, sf_dir), customer_table(spark, sf_dir), products(spark, sf_dir), bought=bought(spark, sf_dir)
        )
        return recommend.pair_split(materialize(pairs, "pairs"))

    return _table(spark, sf_dir, "reco_split", build)


def deep_ranker(spark: SparkSession, sf_dir: str) -> TreeEnsemble:
    """The ranker's deeper setting."""
    train = reco_split(spark, sf_dir).where("is_test = 0")
    return _model(spark, sf_dir, "ranker_deep", lambda: recommend.fit_ranker(train, **recommend.RANKERS["ranker_deep"]))


def ranker(spark: SparkSession, sf_dir: str) -> TreeEnsemble:
    train = reco_split(spark, sf_dir).where("is_test = 0")
    return _model(spark, sf_dir, "ranker", lambda: recommend.fit_ranker(train))
