"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the number of local cores and BENCH_QUERIES
a comma-separated choice of queries. The stage tables that several queries read are built
and timed first, as `stage_*`. Results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from patronlens.operators import churn  # noqa: E402
from patronlens.plans import stages  # noqa: E402
from patronlens.plans.queries import QUERIES  # noqa: E402
from patronlens.workspace import build_session, clear_workspace  # noqa: E402

HEADLINE = [
    "sales_lines", "scan_csv_roundtrip", "dedup_rows", "cleaning_audit", "monthly_revenue", "order_rfm_base",
    "web_engagement", "support_experience", "marketing_response", "favorite_category", "top_channel",
    "last_product", "rfm_scores", "customer_360", "category_pivot", "category_affinity", "item_cooccurrence",
    "top_co_purchased", "unpurchased_candidates", "negative_samples", "reco_features",
    "recommend_by_affinity", "dashboard", "value_tiers", "segment_profile", "segment_summary", "dim_products",
    "kpi_cards", "risk_kpis", "explorer_slice", "reco_by_segment", "stratified_split", "upsample_minority",
    "roc_auc", "roc_points", "churn_logreg", "churn_rf", "churn_gbt", "churn_gbt_weighted", "model_comparison",
    "churn_scores", "feature_importance", "model_reload_scores", "kmeans_segments", "k_sweep", "reco_ranker", "recommend_top1",
]


def _fit(kind):
    def fit(spark, sf_dir):
        return stages.churn_model(spark, sf_dir, kind)

    fit.__name__ = f"fit_{kind}"
    return fit


# Fits are timed by themselves, before the queries that score with them.
STAGES = [
    stages.customer_table, stages.enriched, stages.dashboard, stages.churn_split,
    *[_fit(kind) for kind in churn.MODEL_NAMES], stages.reco_split, stages.ranker,
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    # Where stage tables go; on a cluster a folder that all executors share.
    folder = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="patronlens-bench-")
    settings = {"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    spark = build_session(f"local[{cpus}]", "patronlens-bench", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["monthly_revenue"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    stages.reset()
    if not chosen:
        for stage in STAGES:
            start = time.perf_counter()
            stage(spark, sf_dir)
            seconds[f"stage_{stage.__name__}"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    clear_workspace(spark)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
