import random
from decimal import Decimal

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from patronlens.operators import churn, evaluation, sampling, segments
from patronlens.workspace import materialize, new_path


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        label = int(rng.random() < 0.3)
        score = round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * label, 0.2))), 1 if i % 3 else 4)
        rows.append((i, label, score, int(score >= 0.5)))
    return materialize(spark.createDataFrame(rows, "id int, label int, score double, prediction int"), "test_pred")


def test_metrics_by_hand(predictions):
    rows = predictions.collect()
    tp = sum(r["label"] and r["prediction"] for r in rows)
    fp = sum((not r["label"]) and r["prediction"] for r in rows)
    fn = sum(r["label"] and not r["prediction"] for r in rows)
    tn = len(rows) - tp - fp - fn
    got = evaluation.evaluate_binary(predictions, model="m").first()
    assert got["accuracy"] == pytest.approx((tp + tn) / len(rows), abs=5e-5)
    assert got["precision"] == pytest.approx(tp / (tp + fp), abs=5e-5)
    assert got["recall"] == pytest.approx(tp / (tp + fn), abs=5e-5)
    assert got["f1_score"] == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=5e-5)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in evaluation.confusion(predictions).collect()}
    assert cells == {(0, 0): tn, (0, 1): fp, (1, 0): fn, (1, 1): tp}


def test_area_under_the_curve_counts_ties_half(spark, predictions, many_partitions):
    rows = predictions.collect()
    positives = [r["score"] for r in rows if r["label"]]
    negatives = [r["score"] for r in rows if not r["label"]]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    auc = evaluation.roc_auc(predictions).first()[0]
    assert auc == pytest.approx(wins / (len(positives) * len(negatives)))
    library = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(predictions)
    assert auc == pytest.approx(library)
    points = evaluation.roc_points(predictions).orderBy("tp", "fp").collect()
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(auc)
    assert points[0]["threshold"] is None and (points[-1]["tpr"], points[-1]["fpr"]) == (1.0, 1.0)


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, score double")
    row = evaluation.evaluate_binary(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"]) == (1.0, 0.0, 0.0, 0.0)
    assert row["roc_auc"] is None
    assert [r["n"] for r in evaluation.confusion(df).orderBy("actual", "predicted").collect()] == [2, 0, 0, 0]


def test_upsert_replaces_and_retires(spark):
    old = spark.createDataFrame([("a", 0.1), ("b", 0.2), ("c", 0.3)], "model string, roc_auc double")
    new = spark.createDataFrame([("b", 0.9), ("d", 0.9)], "model string, roc_auc double")
    merged = evaluation.upsert_metrics(old, new, replaces=["c"])
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 0.1), ("b", 0.9), ("d", 0.9)]
    assert evaluation.best_model(merged).first()["model"] == "b"


def test_split_is_exact_per_class_and_repeatable(spark, many_partitions):
    df = materialize(spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y")), "test_split")
    split = sampling.stratified_split(df, "y", ["id"], 0.25, 42)
    sizes = {(r["y"], r["is_test"]): r["count"] for r in split.groupBy("y", "is_test").count().collect()}
    assert sizes == {(0, 0): 675, (0, 1): 225, (1, 0): 75, (1, 1): 25}
    again = sampling.stratified_split(df.repartition(7), "y", ["id"], 0.25, 42)
    assert split.exceptAll(again).count() == 0
    other = sampling.stratified_split(df, "y", ["id"], 0.25, 43)
    assert split.exceptAll(other).count() > 0


def test_upsampled_classes_are_equal(spark):
    df = materialize(spark.range(200).select("id", (F.col("id") % 20 == 0).cast("int").alias("y")), "test_up")
    up = sampling.upsample_minority(df, "y", ["id"])
    counts = {r["y"]: r["count"] for r in up.groupBy("y").count().collect()}
    assert counts == {0: 190, 1: 190}
    assert up.where("y = 1").select("id").distinct().count() > 5
    assert up.where("y = 0").select("id").distinct().count() == 190


# A stored profile and the names given to its segments.
PROFILE = [
    (3, 60.1, 8.6, 1472.9, "Champions"),
    (4, 145.7, 4.0, 676.5, "Loyal High-Value"),
    (2, 167.7, 3.7, 629.9, "Regular Customers"),
    (1, 165.5, 3.0, 478.4, "New / Occasional"),
    (0, 386.9, 0.0, 0.3, "Lost / Dormant"),
]


def test_stored_profile_gets_its_names(spark):
    schema = "segment int, recency_days double, frequency double, clv_predicted double, name string"
    profile = spark.createDataFrame(PROFILE, schema)
    names = {r["segment"]: r["segment_name"] for r in segments.name_segments(profile).collect()}
    assert names == {row[0]: row[4] for row in PROFILE}


def test_overrides_use_no_label_and_labels_run_out(spark):
    rows = [(i, 100.0, 5.0, 100.0 - i) for i in range(6)] + [(6, 400.0, 5.0, 1000.0), (7, 101.0, 0.1, 0.0)]
    profile = spark.createDataFrame(rows, "segment int, recency_days double, frequency double, clv_predicted double")
    names = {r["segment"]: r["segment_name"] for r in segments.name_segments(profile).collect()}
    assert names == {
        0: "Champions", 1: "Loyal High-Value", 2: "Regular Customers", 3: "New / Occasional",
        4: "Segment 4", 5: "Segment 5", 6: "At Risk", 7: "Lost / Dormant",
    }


def test_equal_segments_do_not_divide_by_zero(spark):
    profile = spark.createDataFrame([(i, 9.0, 2.0, 3.0) for i in range(2)], "segment int, recency_days double, frequency double, clv_predicted double")
    names = {r["segment"]: r["segment_name"] for r in segments.name_segments(profile).collect()}
    assert names == {0: "Champions", 1: "Loyal High-Value"}


def test_standardize_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    rows = [tuple(r) for r in segments.standardize(df, ["a", "b"]).orderBy("a").collect()]
    assert rows == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.fixture(scope="module")
def customers(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        active = i % 4 != 0
        frequency = rng.randint(4, 9) if active else rng.randint(0, 3)
        values = dict(
            customer_id=f"C{i:04d}", churned=int((not active) ^ (rng.random() < 0.05)), frequency=frequency,
            monetary=Decimal(frequency * 50), avg_order_value=50.0 if frequency else 0.0,
            purchase_freq_per_year=frequency / 2, recency_days=rng.randint(1, 90) if active else rng.randint(200, 900),
            clv_predicted=frequency * 80.0, email_opt_in=i % 2, RFM_total=5 if active else 13,
        )
        for c in churn.CHURN_FEATURES:
            values.setdefault(c, round(rng.random(), 3))
        rows.append(values)
    return materialize(spark.createDataFrame(rows), "test_model_customers")


def test_no_recency_among_the_features():
    assert not {"recency_days", "days_since_last_session"} & set(churn.CHURN_FEATURES)
    assert len(churn.CHURN_FEATURES) == 18


SMALL = {
    "logreg": {}, "rf": {"numTrees": 20}, "gbt": {"maxIter": 5}, "gbt_weighted": {"maxIter": 5},
}


@pytest.mark.parametrize("kind", list(SMALL))
def test_models_find_a_planted_signal(spark, customers, kind):
    split = materialize(churn.churn_split(customers), "test_churn_split")
    model = churn.fit_churn(split.where("is_test = 0"), kind, **SMALL[kind])
    pred = materialize(churn.predict(model, split.where("is_test = 1")), "test_churn_pred")
    # Some labels are flipped, so the planted rule itself sets the mark.
    rule = pred.withColumn("score", (F.col("RFM_total") == 13).cast("double"))
    mark = evaluation.roc_auc(rule).first()[0]
    assert mark > 0.7 and evaluation.roc_auc(pred).first()[0] > mark - 0.05
    path = new_path(spark, "test_model")
    churn.save_model(model, path)
    scores = churn.churn_scores(model, customers)
    reloaded = churn.churn_scores(churn.load_model(path), customers)
    assert scores.exceptAll(reloaded).count() == 0
    wrong = "churn_probability not between 0 and 1 or (churn_probability >= 0.5) <> (predicted_churn = 1)"
    assert scores.count() == 400 and scores.where(wrong).count() == 0


@pytest.mark.parametrize("kind", ["rf", "gbt", "logreg"])
def test_a_fit_does_not_depend_on_the_input_partitions(customers, kind):
    rows = churn.churn_features(customers)
    fits = [churn.fit_churn(rows.repartition(n), kind, **SMALL[kind]) for n in (4, 9)]
    one, other = (materialize(churn.churn_scores(fit, customers), "scores") for fit in fits)
    assert one.exceptAll(other).count() == 0


def test_segments_do_not_depend_on_the_input_partitions(customers):
    one, other = (segments.fit_segments(customers.repartition(n), k=3, restarts=2)[1].select("customer_id", "segment") for n in (4, 9))
    assert one.exceptAll(other).count() == 0


def test_boosting_on_written_copies(customers):
    rows = churn.churn_features(customers)
    assert churn.fit_churn(rows, "gbt", resample=True, maxIter=2).total_nodes > 2


def test_importance_lists_every_feature(spark, customers):
    model = churn.fit_churn(churn.churn_features(customers), "rf", numTrees=5)
    rows = churn.feature_importance(spark, model).collect()
    assert {r["feature"] for r in rows} == set(churn.CHURN_FEATURES)
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert churn.feature_importance(spark, model, 5).collect() == rows[:5]


def test_segments_separate_planted_groups(customers):
    model, segmented = segments.fit_segments(customers, k=2, restarts=2)
    groups = {
        (r["active"], r["segment"]) for r in
        segmented.select((F.col("recency_days") < 100).alias("active"), "segment").distinct().collect()
    }
    assert len(groups) == 2
    named = segments.with_segment_names(segmented)
    assert named.select("segment_name").distinct().count() == 2 and named.count() == 400
    again = model.transform(customers).select("customer_id", "segment")
    assert again.exceptAll(segmented.select("customer_id", "segment")).count() == 0


def test_sweep_lowers_the_cost(customers):
    rows = segments.sweep_k(customers, ks=[2, 3], restarts=2).collect()
    assert [r["k"] for r in rows] == [2, 3] and rows[0]["cost"] > rows[1]["cost"]
    # Squared distances set clusters further apart than plain ones.
    assert rows[0]["silhouette_squared"] > 0.5 > rows[0]["silhouette"] > 0.4 and rows[0]["silhouette_error"] == 0.0
