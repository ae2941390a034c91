"""Quality of binary predictions, and the table that compares models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.operators.ranking import running_totals

METRICS = ["accuracy", "precision", "recall", "f1_score"]


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _cells(label: str, prediction: str) -> dict[str, Column]:
    y, p = F.col(label), F.col(prediction)
    return {
        "tn": _count((y == 0) & (p == 0)),
        "fp": _count((y == 0) & (p == 1)),
        "fn": _count((y == 1) & (p == 0)),
        "tp": _count((y == 1) & (p == 1)),
    }


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All four cells of the confusion matrix, empty ones included."""
    cells = pred.agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])
    rows = F.array(
        *[
            F.struct(F.lit(y).alias("actual"), F.lit(p).alias("predicted"), F.col(n).alias("n"))
            for n, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
        ]
    )
    return cells.select(F.inline(rows))


def classification_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 4
) -> DataFrame:
    """Accuracy, precision, recall and F1 from one aggregate; an undefined ratio is 0."""
    cells = pred.agg(*[c.cast("double").alias(n) for n, c in _cells(label, prediction).items()])

    def share(part: str, whole: str) -> Column:
        return F.bround(F.coalesce(F.try_divide(F.expr(part), F.expr(whole)), F.lit(0.0)), digits)

    return cells.select(
        share("tp + tn", "tp + tn + fp + fn").alias("accuracy"),
        share("tp", "tp + fp").alias("precision"),
        share("tp", "tp + fn").alias("recall"),
        share("2 * tp", "2 * tp + fp + fn").alias("f1_score"),
    )


def _by_score(pred: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return pred.groupBy(F.col(score).alias("threshold")).agg(
        _count(F.col(label) == 1).alias("pos"), _count(F.col(label) == 0).alias("neg")
    )


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve; tied scores count one half.

    Sum over the distinct scores of pos * (negatives below + neg / 2), in whole numbers.
    """
    ranked = running_totals(_by_score(pred, label, score), [("threshold", True)], {"neg_to_here": "neg"})
    pos, neg = (F.col(c).cast("decimal(19,0)") for c in ("pos", "neg"))
    doubled = F.sum(pos * (2 * F.col("neg_to_here") - neg)).cast("double")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(doubled, 2 * pairs).alias("roc_auc"))


def roc_points(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score, from the origin (no threshold) to (1, 1)."""
    counts = _by_score(pred, label, score)
    points = running_totals(counts, [("threshold", False)], {"tp": "pos", "fp": "neg"}).drop("pos", "neg")
    first = points.limit(1)
    origin = first.withColumns(
        {"threshold": F.lit(None).cast(points.schema["threshold"].dataType)}
        | {c: F.lit(0).cast("bigint") for c in ("tp", "fp")}
    )
    shares = {
        "tpr": F.try_divide(F.col("tp").cast("double"), F.col("tp_total")),
        "fpr": F.try_divide(F.col("fp").cast("double"), F.col("fp_total")),
    }
    return points.unionByName(origin).withColumns(shares).drop("tp_total", "fp_total")


def evaluate_binary(
    pred: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    model: str | None = None,
) -> DataFrame:
    """One row: the four metrics and the area under the curve, four digits each."""
    auc = roc_auc(pred, label, score)
    row = classification_metrics(pred, label, prediction).withColumn(
        "roc_auc", F.bround(auc.scalar(), 4)
    )
    return row if model is None else row.select(F.lit(model).alias("model"), *METRICS, "roc_auc")


def upsert_metrics(
    old: DataFrame, new: DataFrame, key: str = "model", replaces: Sequence[str] = ()
) -> DataFrame:
    """`new` rows replace `old` rows of the same key and of the keys in `replaces`."""
    kept = old.join(new.select(key), key, "left_anti")
    if replaces:
        kept = kept.where(~F.col(key).isin(*replaces))
    return kept.select(*old.columns).unionByName(new.select(*old.columns))


def best_model(metrics: DataFrame) -> DataFrame:
    """The row of highest area under the curve, the first by name on a tie."""
    return metrics.orderBy(F.col("roc_auc").desc(), F.col("model").asc()).limit(1)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Class sizes, balanced weights n / (2 n_class) and the weight of a positive."""
    y = F.col(label)
    sizes = df.agg(_count(y == 0).alias("n_negative"), _count(y == 1).alias("n_positive"))
    n = (F.col("n_negative") + F.col("n_positive")).cast("double")
    return sizes.withColumns(
        {
            "weight_negative": F.try_divide(n, 2.0 * F.col("n_negative")),
            "weight_positive": F.try_divide(n, 2.0 * F.col("n_positive")),
            "positive_ratio": F.try_divide(F.col("n_negative").cast("double"), F.col("n_positive")),
        }
    )
