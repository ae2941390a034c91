"""One query per operator over the test tables: name -> function(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.functions import columns as fn
from patronlens.operators import (
    affinity,
    churn,
    cleaning,
    evaluation,
    features,
    recommend,
    sampling,
    segments,
)
from patronlens.operators.customer_table import rfm_scores
from patronlens.plans import exports, measures, stages
from patronlens.sources import files, views
from patronlens.workspace import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EXPLORER_FILTERS = {
    "region": ["ASIA", "EUROPE", "AMERICA"],
    "churn_risk_band": ["High Risk", "Medium Risk"],
    "value_tier": ["Gold", "Platinum"],
    "segment": ["Champions", "Loyal High-Value", "Regular Customers", "At Risk"],
}
CENTERS = [(-1.0, -1.0), (-1.0, 1.0), (0.0, 0.0), (1.0, -1.0), (1.0, 1.0)]
SCORE_MULTIPLIERS = {"logreg": 7919, "rf": 6271, "gbt": 3331, "gbt_weighted": 9973}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six digits and wide decimals to (18,2), the form the oracle returns."""

    def tidy(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return (F.round(column * 1e6) / 1e6).alias(field.name)
        if isinstance(field.dataType, T.DecimalType) and field.dataType.precision > 18:
            return column.cast("decimal(18,2)").alias(field.name)
        return column

    return df.select(*[tidy(f) for f in df.schema.fields])


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_source(views.sales(spark, sf_dir))


# --- sources and sinks


@query("sales_lines")
def sales_lines(spark, sf_dir):
    return views.sales(spark, sf_dir)


@query("scan_csv_roundtrip")
def scan_csv_roundtrip(spark, sf_dir):
    sales = views.sales(spark, sf_dir)
    path = new_path(spark, "sales_csv")
    files.write_csv(sales, path)
    return files.read_csv(spark, path, sales.schema)


@query("enrich_master")
def enrich_master(spark, sf_dir):
    customers = stages.customer_table(spark, sf_dir)
    added = stages.with_fixed_scores(customers.select("customer_id"))
    once = files.enrich_master(customers, added)
    again = files.enrich_master(once, added)
    return again.select(
        "customer_id", "customer_name", "churned", "segment", "churn_probability", "predicted_churn"
    )


# --- cleaning and null handling


def _with_null_keys(sales: DataFrame) -> DataFrame:
    return sales.withColumn("customer_id", F.when(F.col("order_id") % 50 != 0, F.col("customer_id")))


def _with_copies(sales: DataFrame) -> DataFrame:
    return sales.unionByName(sales.where(F.col("order_id") % 20 == 0))


@query("clean_null_keys")
def clean_null_keys(spark, sf_dir):
    return cleaning.drop_null_keys(_with_null_keys(views.sales(spark, sf_dir)))


@query("dedup_rows")
def dedup_rows(spark, sf_dir):
    return cleaning.drop_duplicate_rows(_with_copies(views.sales(spark, sf_dir)))


@query("cleaning_audit")
def cleaning_audit(spark, sf_dir):
    return cleaning.cleaning_audit(
        {
            "customers": views.customers(spark, sf_dir),
            "sales": _with_copies(_with_null_keys(views.sales(spark, sf_dir))),
            "web": views.web(spark, sf_dir),
            "support": views.support(spark, sf_dir),
            "marketing": views.marketing(spark, sf_dir),
        }
    )


def _customers_with(spark, sf_dir, *frames):
    wide = views.customers(spark, sf_dir)
    for frame in frames:
        wide = wide.join(frame, "customer_id", "left")
    return wide


@query("fill_zero_activity")
def fill_zero_activity(spark, sf_dir):
    wide = _customers_with(
        spark, sf_dir,
        features.web_features(views.web(spark, sf_dir), views.AS_OF),
        features.marketing_features(views.marketing(spark, sf_dir)),
    )
    names = ["total_sessions", "avg_pages_per_session", "cart_adds", "total_touches", "open_rate"]
    return cleaning.fill_zero(wide, names).select("customer_id", *names)


@query("fill_from_column")
def fill_from_column(spark, sf_dir):
    sales = clean_sales(spark, sf_dir)
    wide = _customers_with(
        spark, sf_dir, features.order_features(sales, views.AS_OF), features.top_channel(sales)
    )
    wide = cleaning.fill_from(
        wide,
        recency_days=fn.whole_days(views.AS_OF, "signup_date"),
        top_purchase_channel=F.col("preferred_channel"),
    )
    return wide.select("customer_id", "recency_days", "top_purchase_channel")


@query("fill_global_mean")
def fill_global_mean(spark, sf_dir):
    wide = _customers_with(spark, sf_dir, features.support_features(views.support(spark, sf_dir)))
    return cleaning.fill_with_mean(wide, "avg_csat").select("customer_id", "avg_csat")


# --- projections


@query("recency_tenure_days")
def recency_tenure_days(spark, sf_dir):
    orders = features.order_features(clean_sales(spark, sf_dir), views.AS_OF)
    return orders.select("customer_id", "recency_days", "customer_tenure_days")


@query("tenure_frequency")
def tenure_frequency(spark, sf_dir):
    return stages.customer_table(spark, sf_dir).select(
        "customer_id", "tenure_years", "purchase_freq_per_year"
    )


@query("retention_factor")
def retention_factor(spark, sf_dir):
    customers = stages.customer_table(spark, sf_dir)
    return customers.select("customer_id", fn.retention_factor().alias("retention_factor"))


@query("clv")
def clv(spark, sf_dir):
    return stages.customer_table(spark, sf_dir).select("customer_id", "clv_historical", "clv_predicted")


@query("customer_names")
def customer_names(spark, sf_dir):
    return views.customers(spark, sf_dir).select("customer_id", fn.full_name().alias("customer_name"))


@query("log_features")
def log_features(spark, sf_dir):
    logged = segments.log_features(stages.customer_table(spark, sf_dir))
    return logged.select("customer_id", *segments.CLUSTER_FEATURES)


@query("risk_bands")
def risk_bands(spark, sf_dir):
    scored = stages.with_fixed_scores(views.customers(spark, sf_dir))
    return scored.select(
        "customer_id", "churn_probability", "predicted_churn",
        fn.risk_band("churn_probability").alias("churn_risk_band"),
    )


@query("color_bands")
def color_bands(spark, sf_dir):
    scored = stages.with_fixed_scores(views.customers(spark, sf_dir))
    return scored.select("customer_id", fn.color_band("churn_probability").alias("color"))


@query("churn_label")
def churn_label(spark, sf_dir):
    rules = fn.churn_rules(views.AS_OF)
    flags = [rule.cast("int").alias(name) for name, rule in rules.items()]
    return stages.customer_table(spark, sf_dir).select("customer_id", *flags, "churned")


# --- aggregates per source


@query("order_rfm_base")
def order_rfm_base(spark, sf_dir):
    orders = features.order_features(clean_sales(spark, sf_dir), views.AS_OF)
    return orders.drop("recency_days", "customer_tenure_days")


@query("web_engagement")
def web_engagement(spark, sf_dir):
    return features.web_features(cleaning.clean_source(views.web(spark, sf_dir)), views.AS_OF)


@query("support_experience")
def support_experience(spark, sf_dir):
    return features.support_features(cleaning.clean_source(views.support(spark, sf_dir)))


@query("marketing_response")
def marketing_response(spark, sf_dir):
    return features.marketing_features(cleaning.clean_source(views.marketing(spark, sf_dir)))


@query("favorite_category")
def favorite_category(spark, sf_dir):
    return features.favorite_category(clean_sales(spark, sf_dir))


@query("top_channel")
def top_channel(spark, sf_dir):
    return features.top_channel(clean_sales(spark, sf_dir))


@query("last_product")
def last_product(spark, sf_dir):
    return features.last_product(clean_sales(spark, sf_dir))


@query("rfm_scores")
def scores(spark, sf_dir):
    orders = features.order_features(clean_sales(spark, sf_dir), views.AS_OF)
    metrics = orders.select("customer_id", "recency_days", "frequency", "monetary")
    return rfm_scores(materialize(metrics, "rfm")).drop("recency_days", "frequency", "monetary")


@query("customer_360")
def customer_360(spark, sf_dir):
    return stages.new_customer_table(spark, sf_dir)


@query("churn_rate")
def churn_rate(spark, sf_dir):
    rate = fn.mean("churned").alias("churn_rate")
    return stages.customer_table(spark, sf_dir).agg(F.count("*").alias("customers"), rate)


# --- what is bought


@query("product_dimension")
def product_dimension(spark, sf_dir):
    return affinity.product_dimension(views.sales(spark, sf_dir))


@query("category_pivot")
def category_pivot(spark, sf_dir):
    return affinity.category_pivot(views.sales(spark, sf_dir))


@query("category_affinity")
def category_affinity(spark, sf_dir):
    return affinity.category_affinity(views.sales(spark, sf_dir))


@query("customer_baskets")
def customer_baskets(spark, sf_dir):
    return affinity.customer_baskets(views.sales(spark, sf_dir))


@query("item_cooccurrence")
def item_cooccurrence(spark, sf_dir):
    return affinity.item_cooccurrence(views.sales(spark, sf_dir))


@query("top_co_purchased")
def top_co_purchased(spark, sf_dir):
    return affinity.top_co_purchased(affinity.item_cooccurrence(views.sales(spark, sf_dir)))


@query("candidate_pairs")
def candidate_pairs(spark, sf_dir):
    return recommend.candidate_counts(views.customers(spark, sf_dir), views.sales(spark, sf_dir))


@query("unpurchased_candidates")
def unpurchased_candidates(spark, sf_dir):
    return recommend.unpurchased_summary(views.customers(spark, sf_dir), views.sales(spark, sf_dir))


@query("never_bought_products")
def never_bought_products(spark, sf_dir):
    return recommend.never_bought(views.customers(spark, sf_dir), views.sales(spark, sf_dir))


@query("negative_samples")
def negative_samples(spark, sf_dir):
    return recommend.training_pairs(stages.sold(spark, sf_dir), stages.products(spark, sf_dir), bought=stages.bought(spark, sf_dir))


@query("reco_features")
def reco_features(spark, sf_dir):
    return recommend.reco_features(
        stages.sold(spark, sf_dir), stages.customer_table(spark, sf_dir), stages.products(spark, sf_dir), bought=stages.bought(spark, sf_dir)
    )


@query("recommend_by_affinity")
def recommend_by_affinity(spark, sf_dir):
    return recommend.recommend_by_affinity(
        stages.customer_table(spark, sf_dir), stages.sold(spark, sf_dir), stages.products(spark, sf_dir), stages.bought(spark, sf_dir)
    )


# --- exports and measures


@query("dashboard")
def dashboard(spark, sf_dir):
    return exports.dashboard(stages.enriched(spark, sf_dir))


@query("value_tiers")
def value_tiers(spark, sf_dir):
    tiers = exports.value_tiers(stages.customer_table(spark, sf_dir), "clv_predicted")
    return tiers.select("customer_id", "value_tier")


@query("segment_summary")
def segment_summary(spark, sf_dir):
    return exports.segment_summary(stages.dashboard(spark, sf_dir))


@query("monthly_revenue")
def monthly_revenue(spark, sf_dir):
    return exports.monthly_revenue(views.sales(spark, sf_dir))


@query("dim_products")
def dim_products(spark, sf_dir):
    return exports.dim_products(stages.sold(spark, sf_dir), stages.enriched(spark, sf_dir))


@query("times_recommended")
def times_recommended(spark, sf_dir):
    return exports.times_recommended(stages.enriched(spark, sf_dir))


@query("kpi_cards")
def kpi_cards(spark, sf_dir):
    return measures.kpi_cards(stages.dashboard(spark, sf_dir))


@query("risk_kpis")
def risk_kpis(spark, sf_dir):
    return measures.risk_kpis(stages.dashboard(spark, sf_dir))


@query("sliced_measures")
def sliced_measures(spark, sf_dir):
    return measures.measures(stages.dashboard(spark, sf_dir), EXPLORER_FILTERS)


@query("segment_counts")
def segment_counts(spark, sf_dir):
    return measures.segment_counts(stages.dashboard(spark, sf_dir))


@query("risk_band_counts")
def risk_band_counts(spark, sf_dir):
    return measures.risk_band_counts(stages.dashboard(spark, sf_dir))


@query("reco_by_segment")
def reco_by_segment(spark, sf_dir):
    return measures.reco_by_segment(stages.dashboard(spark, sf_dir))


@query("explorer_slice")
def explorer_slice(spark, sf_dir):
    return measures.explorer(stages.dashboard(spark, sf_dir), EXPLORER_FILTERS)


@query("top_customers")
def top_customers(spark, sf_dir):
    top = measures.top_customers(stages.dashboard(spark, sf_dir))
    return top.select("customer_id", "customer_name", "customer_value", "revenue", "segment")


@query("top_products")
def top_products(spark, sf_dir):
    products = exports.product_totals(views.sales(spark, sf_dir))
    return measures.top_products(products).select("product_name", "category", "total_revenue", "units_sold")


@query("retention_targets")
def retention_targets(spark, sf_dir):
    return measures.retention_targets(stages.dashboard(spark, sf_dir))


@query("recommended_product_details")
def recommended_product_details(spark, sf_dir):
    products = exports.product_totals(views.sales(spark, sf_dir))
    return measures.recommended_product_details(stages.dashboard(spark, sf_dir), products)


# --- segments


@query("segment_profile")
def segment_profile(spark, sf_dir):
    segmented = stages.with_fixed_scores(stages.customer_table(spark, sf_dir))
    return segments.segment_profiles(materialize(segmented, "segmented"))


@query("segment_naming")
def segment_naming(spark, sf_dir):
    segmented = stages.with_fixed_scores(stages.customer_table(spark, sf_dir))
    return segments.name_segments(segments.profile_segments(segmented))


@query("standardize_features")
def standardize_features(spark, sf_dir):
    logged = segments.log_features(stages.customer_table(spark, sf_dir))
    scaled = segments.standardize(logged, segments.CLUSTER_FEATURES)
    return scaled.select("customer_id", *segments.CLUSTER_FEATURES)


@query("assign_nearest_center")
def assign_nearest_center(spark, sf_dir):
    two = ["recency_days", "monetary"]
    logged = segments.log_features(stages.customer_table(spark, sf_dir))
    scaled = segments.standardize(logged, two)
    return segments.assign_nearest_center(scaled, two, CENTERS).select("customer_id", "segment")


# --- splits, resampling, evaluation


@query("churn_features")
def churn_features(spark, sf_dir):
    return churn.churn_features(stages.customer_table(spark, sf_dir))


@query("stratified_split")
def stratified_split(spark, sf_dir):
    return churn.churn_split(stages.customer_table(spark, sf_dir)).select("customer_id", "label", "is_test")


@query("upsample_minority")
def upsample_minority(spark, sf_dir):
    labelled = stages.customer_table(spark, sf_dir).select("customer_id", F.col("churned").alias("label"))
    return sampling.upsample_minority(labelled, "label", ["customer_id"])


@query("class_weights")
def class_weights(spark, sf_dir):
    return evaluation.class_weights(stages.customer_table(spark, sf_dir), "churned")


def _fixed_predictions(spark, sf_dir, kind="logreg"):
    score = stages.fixed_score(SCORE_MULTIPLIERS[kind]).cast("double")
    labelled = stages.customer_table(spark, sf_dir).select(
        "customer_id", F.col("churned").alias("label"), score.alias("score")
    )
    return labelled.withColumn("prediction", fn.predicted_flag("score"))


@query("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion(_fixed_predictions(spark, sf_dir))


@query("classification_metrics")
def classification_metrics(spark, sf_dir):
    return evaluation.classification_metrics(_fixed_predictions(spark, sf_dir))


@query("roc_auc")
def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(_fixed_predictions(spark, sf_dir))


@query("roc_points")
def roc_points(spark, sf_dir):
    return evaluation.roc_points(_fixed_predictions(spark, sf_dir))


def _fixed_metrics(spark, sf_dir, kind, name=None):
    pred = _fixed_predictions(spark, sf_dir, kind)
    row = evaluation.evaluate_binary(pred, model=name or churn.MODEL_NAMES[kind])
    return materialize(row, "metrics")


@query("metrics_upsert")
def metrics_upsert(spark, sf_dir):
    """Rows of three models, then a rerun of one that also retires its variant."""
    table = _fixed_metrics(spark, sf_dir, "rf")
    for kind in ("logreg", "gbt_weighted"):
        table = evaluation.upsert_metrics(table, _fixed_metrics(spark, sf_dir, kind))
    rerun = _fixed_metrics(spark, sf_dir, "gbt", churn.MODEL_NAMES["logreg"])
    return evaluation.upsert_metrics(table, rerun, replaces=[churn.MODEL_NAMES["gbt_weighted"]])


@query("best_model")
def best_model(spark, sf_dir):
    table = _fixed_metrics(spark, sf_dir, "logreg")
    for kind in ("rf", "gbt", "gbt_weighted"):
        table = table.unionByName(_fixed_metrics(spark, sf_dir, kind))
    return evaluation.best_model(table)


# --- fitted models


def stored(name: str) -> Callable[[Query], Query]:
    """Results of a fitted model, written once per session and input folder."""
    def wrap(build: Query) -> Query:
        return lambda spark, sf_dir: stages.stored(spark, sf_dir, name, lambda: build(spark, sf_dir))

    return wrap


@query("kmeans_segments")
@stored("kmeans_segments")
def kmeans_segments(spark, sf_dir):
    _, segmented = segments.fit_segments(stages.customer_table(spark, sf_dir))
    named = segments.with_segment_names(materialize(segmented, "segmented"))
    return named.select("customer_id", "segment", "segment_name")


@query("k_sweep")
@stored("k_sweep")
def k_sweep(spark, sf_dir):
    return segments.sweep_k(stages.customer_table(spark, sf_dir))


def _churn_query(kind):
    def run(spark, sf_dir):
        pred = stages.churn_predictions(spark, sf_dir, kind)
        return evaluation.evaluate_binary(pred, model=churn.MODEL_NAMES[kind])

    return stored(f"metrics_{kind}")(run)


for _kind in churn.MODEL_NAMES:
    query(f"churn_{_kind}")(_churn_query(_kind))


@query("model_comparison")
@stored("model_comparison")
def model_comparison(spark, sf_dir):
    """Metrics of all four models on the held-out customers; the fits run side by side."""
    stages.churn_split(spark, sf_dir)
    pool = ThreadPool(len(churn.MODEL_NAMES))
    try:
        rows = pool.map(
            inheritable_thread_target(spark)(lambda kind: _churn_query(kind)(spark, sf_dir)),
            list(churn.MODEL_NAMES),
        )
    finally:
        pool.close()
    table = rows[0]
    for row in rows[1:]:
        table = evaluation.upsert_metrics(table, row)
    return table


@query("churn_scores")
@stored("churn_scores")
def churn_scores(spark, sf_dir):
    """All customers, scored by the better of regression and forest."""
    table = _churn_query("logreg")(spark, sf_dir).unionByName(_churn_query("rf")(spark, sf_dir))
    name = evaluation.best_model(table).first()["model"]
    kind = next(k for k, n in churn.MODEL_NAMES.items() if n == name)
    return churn.churn_scores(stages.churn_model(spark, sf_dir, kind), stages.customer_table(spark, sf_dir))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return churn.feature_importance(spark, stages.churn_model(spark, sf_dir, "rf"))


@query("model_reload_scores")
@stored("model_reload_scores")
def model_reload_scores(spark, sf_dir):
    """Scores of a model that was saved and loaded again."""
    path = new_path(spark, "model")
    churn.save_model(stages.churn_model(spark, sf_dir, "logreg"), path)
    return churn.churn_scores(churn.load_model(path), stages.customer_table(spark, sf_dir))


def _pair_scores(spark, sf_dir):
    test = stages.reco_split(spark, sf_dir).where("is_test = 1")
    scored = recommend.score_pairs(stages.ranker(spark, sf_dir), test)
    return stages.stored(spark, sf_dir, "pair_scores", lambda: scored)


def _deep_pair_scores(spark, sf_dir):
    test = stages.reco_split(spark, sf_dir).where("is_test = 1")
    scored = recommend.score_pairs(stages.deep_ranker(spark, sf_dir), test)
    return stages.stored(spark, sf_dir, "deep_pair_scores", lambda: scored)


@query("reco_ranker")
def reco_ranker(spark, sf_dir):
    """Area under the curve of the product ranker on held-out pairs."""
    return evaluation.roc_auc(_pair_scores(spark, sf_dir))


@query("reco_ranker_deep")
def reco_ranker_deep(spark, sf_dir):
    """The same for the deeper setting of the ranker."""
    return evaluation.roc_auc(_deep_pair_scores(spark, sf_dir))


@query("recommend_top1")
@stored("recommend_top1")
def recommend_top1(spark, sf_dir):
    return recommend.recommend(
        stages.customer_table(spark, sf_dir), stages.sold(spark, sf_dir), stages.ranker(spark, sf_dir),
        stages.products(spark, sf_dir), bought=stages.bought(spark, sf_dir),
    )


@query("recommend_top3")
@stored("recommend_top3")
def recommend_top3(spark, sf_dir):
    return recommend.recommend(
        stages.customer_table(spark, sf_dir), stages.sold(spark, sf_dir), stages.ranker(spark, sf_dir),
        stages.products(spark, sf_dir), top_n=3, bought=stages.bought(spark, sf_dir),
    )


# --- what SQL can state of the fitted models' results

# Floors of the area under the curve, below what the models reach on any of the test tables.
CHURN_FLOOR = 0.6
RANKER_FLOOR = 0.5


@query("kmeans_segments_valid")
def kmeans_segments_valid(spark, sf_dir):
    """Per customer: the segment is one of 0..4 and has the name that the profile's rule gives."""
    found = kmeans_segments(spark, sf_dir)
    every = stages.customer_table(spark, sf_dir).select("customer_id", *segments.CLUSTER_FEATURES)
    names = segments.name_segments(segments.profile_segments(every.join(found, "customer_id")))
    named = found.join(names.withColumnRenamed("segment_name", "_name"), "segment", "left")
    return named.select(
        "customer_id", F.col("segment").between(0, 4).alias("in_range"), F.col("segment_name").eqNullSafe(F.col("_name")).alias("named")
    )


@query("k_sweep_valid")
def k_sweep_valid(spark, sf_dir):
    """Per k: inertia is below that of the k before, and the silhouette lies in [-1, 1]."""
    swept = k_sweep(spark, sf_dir)
    before = swept.select((F.col("k") + 1).alias("k"), F.col("cost").alias("_before"))
    return swept.join(before, "k", "left").select(
        "k", (F.col("cost") < F.coalesce("_before", F.lit(float("inf")))).alias("cost_falls"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
    )


@query("model_comparison_valid")
def model_comparison_valid(spark, sf_dir):
    """Per model: test rows, all four rates in [0, 1], area under the curve above the floor."""
    n_test = stages.churn_split(spark, sf_dir).where("is_test = 1").agg(F.count("*").alias("n")).scalar()
    rates = [F.col(c).between(0, 1) for c in evaluation.METRICS]
    return model_comparison(spark, sf_dir).select(
        "model", n_test.alias("n_test"), reduce(lambda a, b: a & b, rates).alias("rates_in_range"),
        (F.col("roc_auc") >= CHURN_FLOOR).alias("auc_above_floor"),
    )


@query("churn_scores_valid")
def churn_scores_valid(spark, sf_dir):
    p = F.col("churn_probability")
    return churn_scores(spark, sf_dir).select(
        "customer_id", p.between(0, 1).alias("in_range"), ((p >= 0.5).cast("int") == F.col("predicted_churn")).alias("flag_agrees")
    )


@query("feature_importance_valid")
def feature_importance_valid(spark, sf_dir):
    weights = feature_importance(spark, sf_dir)
    total = weights.agg(F.sum("importance").alias("t")).scalar()
    return weights.select(
        "feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("sums_to_one")
    )


@query("model_reload_valid")
def model_reload_valid(spark, sf_dir):
    """Per customer: the reloaded model gives the score of the one that was saved."""
    direct = churn.churn_scores(stages.churn_model(spark, sf_dir, "logreg"), stages.customer_table(spark, sf_dir))
    pair = direct.withColumnRenamed("churn_probability", "_direct").join(model_reload_scores(spark, sf_dir), "customer_id")
    return pair.select("customer_id", (F.col("_direct") == F.col("churn_probability")).alias("equal"))


@query("reco_ranker_valid")
def reco_ranker_valid(spark, sf_dir):
    scored = _pair_scores(spark, sf_dir)
    auc = evaluation.roc_auc(scored).scalar()
    return scored.agg(F.count("*").alias("n_test")).select("n_test", (auc >= RANKER_FLOOR).alias("auc_above_floor"))


@query("reco_ranker_deep_valid")
def reco_ranker_deep_valid(spark, sf_dir):
    scored = _deep_pair_scores(spark, sf_dir)
    auc = evaluation.roc_auc(scored).scalar()
    return scored.agg(F.count("*").alias("n_test")).select("n_test", (auc >= RANKER_FLOOR).alias("auc_above_floor"))


@query("recommend_top3_valid")
def recommend_top3_valid(spark, sf_dir):
    """Per customer: up to three different unseen products in falling order of score, the first being that of `recommend_top1`."""
    sales = stages.sold(spark, sf_dir)
    bought = affinity.customer_baskets(sales).select("customer_id", F.col("product_name").alias("recommended_product"), F.lit(1).alias("_seen"))
    three = recommend_top3(spark, sf_dir).join(bought, ["customer_id", "recommended_product"], "left")
    listed = three.groupBy("customer_id").agg(
        F.count("*").alias("n_ranks"), F.max("rank").alias("_last"), F.count("_seen").alias("_known"), F.countDistinct("recommended_product").alias("_names"),
        F.array_sort(F.collect_list(F.struct("rank", "recommendation_score", "recommended_product"))).alias("_l"),
    )
    scores = F.transform("_l", lambda r: r["recommendation_score"])
    first = recommend_top1(spark, sf_dir).select("customer_id", F.col("recommended_product").alias("_first"), F.col("recommendation_score").alias("_score"))
    return listed.join(first, "customer_id").select(
        "customer_id", "n_ranks", (F.col("_last") == F.col("n_ranks")).alias("ranks_without_gaps"),
        ((F.col("_known") == 0) & (F.col("_names") == F.col("n_ranks"))).alias("different_and_unseen"),
        (scores == F.sort_array(scores, False)).alias("scores_fall"),
        ((F.get("_l", F.lit(0))["recommended_product"] == F.col("_first")) & (F.get("_l", F.lit(0))["recommendation_score"] == F.col("_score"))).alias("first_is_top1"),
    )


@query("recommend_top1_valid")
def recommend_top1_valid(spark, sf_dir):
    """Per customer: a product of the catalogue that is not in the basket, or None where nothing is left."""
    sales = stages.sold(spark, sf_dir)
    products = stages.products(spark, sf_dir)
    names = products.select(F.col("product_name").alias("recommended_product"), F.lit(True).alias("_known"))
    bought = affinity.customer_baskets(sales).select("customer_id", F.col("product_name").alias("recommended_product"), F.lit(True).alias("_seen"))
    best = recommend_top1(spark, sf_dir).join(names.distinct(), "recommended_product", "left").join(bought, ["customer_id", "recommended_product"], "left")
    left = recommend.candidate_counts(stages.customer_table(spark, sf_dir), sales, products).select("customer_id", "n_candidates")
    has = F.col("n_candidates") > 0
    fits = F.when(has, F.col("_known").isNotNull() & F.col("_seen").isNull()).otherwise(F.col("recommended_product") == "None")
    return best.join(left, "customer_id").select(
        "customer_id", has.alias("has_candidate"), fits.alias("unseen_or_none"), F.col("recommendation_score").between(0, 1).alias("score_in_range")
    )
