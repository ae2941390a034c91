"""Churn classifiers on the customer table: a regression of `pyspark.ml` and three tree ensembles of `trees`."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.functions.columns import predicted_flag
from patronlens.operators.evaluation import class_weights
from patronlens.operators import trees
from patronlens.operators.sampling import stratified_split, upsample_minority
from patronlens.operators.trees import Recipe, TreeEnsemble
from patronlens.workspace import materialize

Model = PipelineModel | TreeEnsemble

# The classifier's inputs. The label is a rule over recency, so no recency column is a feature.
CHURN_FEATURES = [
    "frequency", "monetary", "avg_order_value", "purchase_freq_per_year",
    "total_sessions", "avg_pages_per_session", "avg_time_on_site", "cart_adds",
    "total_tickets", "avg_csat", "avg_resolution_hours", "escalation_rate",
    "total_touches", "open_rate", "conversion_rate",
    "tenure_years", "email_opt_in", "RFM_total",
]

MODEL_NAMES = {
    "logreg": "Logistic Regression",
    "rf": "Random Forest",
    "gbt": "Gradient Boosting",
    "gbt_weighted": "Gradient Boosting (weighted)",
}


def churn_features(customers: DataFrame) -> DataFrame:
    """Key, label and the 18 features as doubles, nulls as 0."""
    features = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in CHURN_FEATURES]
    return customers.select("customer_id", F.col("churned").cast("int").alias("label"), *features)


def churn_split(customers: DataFrame, test: float = 0.25, seed: int = 42) -> DataFrame:
    """Feature table with `is_test`. `customers` should be a written table."""
    return stratified_split(churn_features(customers), "label", ["customer_id"], test, seed)


# The settings of the three ensembles.
RECIPES = {
    "rf": Recipe(trees=300, depth=8, boosted=False, share=None, node_features=4, least_rows=10),
    "gbt": Recipe(trees=300, depth=4, rate=0.05, share=0.8),
    "gbt_weighted": Recipe(trees=400, depth=5, rate=0.05, share=0.8, columns=0.8, second_order=True, penalty=1.0, least_mass=1.0),
}

# Names that `fit_churn` takes, those of `pyspark.ml`.
_PARAMS = {
    "numTrees": "trees", "maxIter": "trees", "maxDepth": "depth", "stepSize": "rate", "subsamplingRate": "share",
    "minInstancesPerNode": "least_rows", "maxBins": "bins", "seed": "seed",
}


def recipe(kind: str, **params) -> Recipe:
    if kind not in RECIPES:
        raise ValueError(f"unknown kind of model: {kind}")
    return replace(RECIPES[kind], **{_PARAMS[name]: value for name, value in params.items()})


def _regression(n: int, params: dict) -> LogisticRegression:
    # An L2 penalty of one over the summed weights; the second factor carries the sample
    # deviation of the scaler over to the population deviation.
    defaults = {
        "featuresCol": "scaled", "labelCol": "label", "weightCol": "weight", "maxIter": 1000,
        "regParam": (n - 1) / (n * n), "elasticNetParam": 0.0, "standardization": False, "tol": 1e-4,
    }
    return LogisticRegression(**{**defaults, **params})


def fit_churn(train: DataFrame, kind: str = "logreg", resample: bool = False, **params) -> Model:
    """Fit one classifier on `label` and the churn features.

    Classes are balanced by weights: n / (2 n_class) for the regression and the forest; for
    the boosted trees positives weigh n_negative / n_positive, which stands for resampling
    one class to the size of the other without writing the copies. `resample` writes them
    instead. The ensembles draw rows by customer, so their fit depends on the rows and the seed only.
    """
    if resample:
        train = materialize(upsample_minority(train, "label", ["customer_id"]), "resampled")
    sizes = class_weights(train).first()
    n = sizes["n_negative"] + sizes["n_positive"]
    if kind in ("logreg", "rf"):
        weights = (sizes["weight_negative"], sizes["weight_positive"])
    else:
        weights = (1.0, sizes["positive_ratio"])
    weight = F.when(F.col("label") == 0, F.lit(weights[0])).otherwise(F.lit(weights[1]))
    weighted = train.withColumn("weight", weight)
    if kind != "logreg":
        # Copies of a resampled row are told apart by their draw.
        keys = ["customer_id", "draw"] if resample else ["customer_id"]
        return trees.fit(weighted, CHURN_FEATURES, keys, recipe(kind, **params), weight="weight")
    stages = [
        VectorAssembler(inputCols=CHURN_FEATURES, outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        _regression(n, params),
    ]
    return Pipeline(stages=stages).fit(weighted)


def predict(model: Model, df: DataFrame) -> DataFrame:
    """`df` with `score` (probability of churn) and `prediction`."""
    kept = [c for c in df.columns if c != "prediction"]
    if isinstance(model, TreeEnsemble):
        return df.select(*kept, model.probability().alias("score")).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    scored = model.transform(df.select(*kept))
    return scored.select(*kept, vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("prediction"))


def churn_scores(model: Model, customers: DataFrame) -> DataFrame:
    """Probability (four digits) and the flag cut from it, for every customer."""
    scored = predict(model, churn_features(customers))
    return scored.select(
        "customer_id",
        F.bround("score", 4).alias("churn_probability"),
        predicted_flag("score").alias("predicted_churn"),
    )


def feature_importance(spark: SparkSession, model: TreeEnsemble, n: int | None = None) -> DataFrame:
    """Importance per feature, highest first; with `n` the top drivers only."""
    weights = [float(w) for w in model.importances]
    rows = sorted(zip(model.features, weights), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows[:n], "feature string, importance double")


def save_model(model: Model, path: str) -> None:
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.save(path)


def load_model(path: str) -> Model:
    return TreeEnsemble.load(path) if trees.stored_ensemble(path) else PipelineModel.load(path)
