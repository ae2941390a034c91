"""The whole run: five source files in, stage tables, models and dashboard files out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from patronlens.functions.columns import mean
from patronlens.operators import churn, evaluation, recommend, segments
from patronlens.operators.affinity import product_dimension
from patronlens.operators.cleaning import cleaning_audit
from patronlens.operators.customer_table import build_customer_table
from patronlens.plans import exports
from patronlens.sources.files import enrich_master, read_sources, stored_stage, write_csv, write_stage
from patronlens.workspace import materialize


def segment_customers(
    master: DataFrame, out: str, k: int = 5, restarts: int = 10, ks: Iterable[int] = range(2, 10)
) -> DataFrame:
    """Fit the segments, save the model, the profiles and the sweep over k, and enrich the master table."""
    model, segmented = segments.fit_segments(master, k=k, restarts=restarts)
    churn.save_model(model, f"{out}/models/segments")
    named = materialize(segmented.select("customer_id", "segment", *segments.CLUSTER_FEATURES), "segmented")
    write_csv(segments.segment_profiles(named), f"{out}/segment_profiles")
    write_csv(segments.sweep_k(master, restarts=restarts, ks=ks), f"{out}/k_sweep")
    names = segments.with_segment_names(named).select("customer_id", "segment", "segment_name")
    return enrich_master(master, names, path=f"{out}/stages/segmented")


def score_churn(
    master: DataFrame,
    out: str,
    kinds: tuple[str, ...] = ("logreg", "rf", "gbt"),
    scoring_model: str | None = "gbt",
    params: Mapping[str, dict] | None = None,
) -> DataFrame:
    """Fit and compare the classifiers and enrich the master with the scores of one.

    Rows of an earlier run's comparison stay unless their model is fitted again.
    `scoring_model=None` takes the best by area under the curve.
    """
    spark = master.sparkSession
    split = materialize(churn.churn_split(master), "churn_split")
    train, test = split.where("is_test = 0"), split.where("is_test = 1")
    models, table = {}, stored_stage(spark, f"{out}/stages/model_comparison")
    write_csv(master.agg(mean("churned").alias("churn_rate")), f"{out}/churn_rate")
    for kind in kinds:
        models[kind] = churn.fit_churn(train, kind, **(params or {}).get(kind, {}))
        churn.save_model(models[kind], f"{out}/models/churn_{kind}")
        pred = materialize(churn.predict(models[kind], test), "predictions")
        row = materialize(evaluation.evaluate_binary(pred, model=churn.MODEL_NAMES[kind]), "metrics")
        table = row if table is None else evaluation.upsert_metrics(table, row)
        write_csv(evaluation.confusion(pred), f"{out}/confusion_{kind}")
        write_csv(evaluation.roc_points(pred), f"{out}/roc_{kind}")
        if kind != "logreg":
            write_csv(churn.feature_importance(spark, models[kind]), f"{out}/importance_{kind}")
    table = write_stage(table, f"{out}/stages/model_comparison")
    write_csv(table, f"{out}/model_comparison")
    if scoring_model is None:
        name = evaluation.best_model(table).first()["model"]
        scoring_model = next(k for k, n in churn.MODEL_NAMES.items() if n == name)
    scores = churn.churn_scores(models[scoring_model], master)
    return enrich_master(master, scores, path=f"{out}/stages/scored")


def recommend_products(master: DataFrame, sales: DataFrame, out: str, **ranker_params) -> DataFrame:
    """Fit the ranker on bought and unseen products and enrich the master with the best product.

    The lines are condensed once for training and scoring; the held-out area under the curve is written.
    """
    products = materialize(product_dimension(sales), "products")
    bought = recommend.condense(sales)
    pairs = recommend.pair_split(materialize(recommend.reco_features(bought, master, products), "pairs"))
    pairs = materialize(pairs, "pair_split")
    model = recommend.fit_ranker(pairs.where("is_test = 0"), **ranker_params)
    churn.save_model(model, f"{out}/models/ranker")
    scored = materialize(recommend.score_pairs(model, pairs.where("is_test = 1")), "pair_scores")
    write_csv(evaluation.roc_auc(scored), f"{out}/ranker_auc")
    best = recommend.recommend(master, bought, model, products)
    return enrich_master(master, best, path=f"{out}/stages/recommended")


def export_dashboard(master: DataFrame, sales: DataFrame, out: str) -> dict[str, DataFrame]:
    """The four dashboard files. Trend and products use the sales as they came."""
    board = write_stage(exports.dashboard(master), f"{out}/stages/dashboard")
    tables = {
        "customer_360_dashboard": board,
        "segment_summary": exports.segment_summary(board),
        "monthly_revenue_trend": exports.monthly_revenue(sales),
        "dim_products": exports.dim_products(sales, board),
    }
    for name, table in tables.items():
        write_csv(table, f"{out}/{name}")
    return tables


def run(
    spark: SparkSession,
    source_dir: str,
    out: str,
    as_of,
    scoring_model: str | None = "gbt",
    churn_params: Mapping[str, dict] | None = None,
    ranker_params: Mapping | None = None,
    k: int = 5,
    restarts: int = 10,
    ks: Iterable[int] = range(2, 10),
) -> dict[str, DataFrame]:
    """From `<source_dir>/<source>.csv` to the dashboard files under `out`."""
    sources = read_sources(spark, source_dir)
    write_csv(cleaning_audit(sources), f"{out}/cleaning_audit")
    sales = sources["sales_orders"]
    master = build_customer_table(
        sources["customers"],
        sales,
        sources["website_activity"],
        sources["support_tickets"],
        sources["marketing"],
        as_of,
    )
    master = write_stage(master, f"{out}/stages/customer_table")
    master = segment_customers(master, out, k, restarts, ks)
    master = score_churn(master, out, scoring_model=scoring_model, params=churn_params)
    master = recommend_products(master, sales, out, **(ranker_params or {}))
    return export_dashboard(master, sales, out)
