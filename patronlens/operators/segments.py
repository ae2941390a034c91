"""Behavioural segments: features, K-Means, profiles and names."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronlens.functions.columns import decimal_mean
from patronlens.operators.clustering import Points
from patronlens.workspace import materialize

# The clustering inputs, and which of them are skewed.
CLUSTER_FEATURES = [
    "recency_days", "frequency", "monetary", "clv_predicted",
    "total_sessions", "avg_csat", "purchase_freq_per_year",
]
LOGGED = ["monetary", "clv_predicted", "recency_days"]

# The segment labels, in the order they are handed out, and the two overrides.
VALUE_LABELS = ["Champions", "Loyal High-Value", "Regular Customers", "New / Occasional"]
AT_RISK = "At Risk"
DORMANT = "Lost / Dormant"


def _feature(name: str, logged: Sequence[str]) -> str:
    value = f"coalesce(cast({name} as double), 0D)"
    return f"ln(1D + {value})" if name in logged else value


def log_features(
    df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES, logged: Sequence[str] = LOGGED
) -> DataFrame:
    """Clustering features as doubles, nulls as 0, skewed ones as log(1 + x)."""
    return df.withColumns({f: F.expr(_feature(f, logged)) for f in features})


def feature_moments(df: DataFrame, features: Sequence[str]) -> tuple[list[float], list[float]]:
    """Means and population deviations; a constant feature has the deviation 1."""
    found = df.agg(
        *[decimal_mean(f).alias(f"m_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"s_{f}") for f in features],
    ).first()
    return [found[f"m_{f}"] for f in features], [found[f"s_{f}"] or 1.0 for f in features]


def _scaled(df: DataFrame, features: Sequence[str], means: Sequence[float], deviations: Sequence[float]) -> DataFrame:
    return df.withColumns({f: (F.col(f) - F.lit(m)) / F.lit(s) for f, m, s in zip(features, means, deviations)})


def standardize(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Centre and scale by the population deviation; a constant feature is only centred.

    The moments are one row, read from `fit_on` (for instance the training rows) or `df`.
    """
    return _scaled(df, features, *feature_moments(df if fit_on is None else fit_on, features))


@dataclass
class SegmentModel:
    """Centres over scaled features, and what scaling takes."""

    features: list[str]
    logged: list[str]
    means: list[float]
    deviations: list[float]
    centers: list[list[float]]
    inertia: float

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with its `segment`: the nearest centre, in built-in expressions."""
        inputs = {f"_c_{f}": F.expr(_feature(f, self.logged)) for f in self.features}
        scaled = _scaled(df.withColumns(inputs), list(inputs), self.means, self.deviations)
        return assign_nearest_center(scaled, list(inputs), self.centers).drop(*inputs)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(asdict(self)),)], "about string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> SegmentModel:
        return cls(**json.loads(SparkSession.active().read.parquet(path).first()["about"]))


def _prepared(df: DataFrame, features: Sequence[str], logged: Sequence[str]) -> tuple[list[float], list[float], DataFrame]:
    """Moments and the scaled rows, the row of an empty table being zeros."""
    plain = materialize(log_features(df.select("customer_id", *features), features, logged), "features")
    means, deviations = feature_moments(plain, features)
    means = [m or 0.0 for m in means]
    return means, deviations, _scaled(plain, features, means, deviations)


def fit_segments(
    df: DataFrame,
    features: Sequence[str] = CLUSTER_FEATURES,
    k: int = 5,
    restarts: int = 10,
    seed: int = 42,
    logged: Sequence[str] = LOGGED,
) -> tuple[SegmentModel, DataFrame]:
    """The best of `restarts` K-Means fits, all fitted in the same passes, and `df` with its `segment`."""
    means, deviations, scaled = _prepared(df, features, logged)
    with Points(scaled, ["customer_id"], features) as points:
        fits = points.fit([(k, seed + i) for i in range(restarts)])
    best = min(fits, key=lambda f: f.inertia)
    model = SegmentModel(list(features), list(logged), means, deviations, best.centers.tolist(), best.inertia)
    return model, model.transform(df)


def sweep_k(
    df: DataFrame,
    features: Sequence[str] = CLUSTER_FEATURES,
    ks: Iterable[int] = range(2, 10),
    restarts: int = 10,
    seed: int = 42,
    logged: Sequence[str] = LOGGED,
    references: int | None = None,
) -> DataFrame:
    """Inertia and silhouettes per k, each for the best of `restarts` fits; all fits share their passes.

    `silhouette` is over the Euclidean distances of all pairs, or to a sample of `references` members in larger clusters with
    `silhouette_error` as its bound, which is 0 otherwise; `silhouette_squared` is the one over squared distances.
    """
    ks = list(ks)
    _, _, scaled = _prepared(df, features, logged)
    with Points(scaled, ["customer_id"], features) as points:
        fits = points.fit([(k, seed + i) for k in ks for i in range(restarts)])
        best = [min((f for f in fits if f.k == k), key=lambda f: f.inertia) for k in ks]
        found = points.silhouettes(best, references, seed)
    rows = [(f.k, f.inertia, *values) for f, values in zip(best, found)]
    return df.sparkSession.createDataFrame(
        rows, "k int, cost double, silhouette double, silhouette_error double, silhouette_squared double"
    )


def assign_nearest_center(
    df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]], out: str = "segment"
) -> DataFrame:
    """Index of the nearest given centre, the lowest on a tie."""

    def squared(center: Sequence[float]) -> Column:
        terms = [(F.col(f) - F.lit(float(c))) * (F.col(f) - F.lit(float(c))) for f, c in zip(features, center)]
        return sum(terms[1:], terms[0])

    distances = F.array(*[F.struct(squared(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)])
    return df.withColumn(out, F.array_min(distances)["i"])


def profile_segments(df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    """Feature means to one digit and the size of each segment."""
    means = [F.bround(decimal_mean(f), 1).alias(f) for f in features]
    grouped = df.where(F.col("segment").isNotNull()).groupBy("segment")
    return grouped.agg(*means, F.count("*").alias("customer_count"))


def name_segments(profile: DataFrame) -> DataFrame:
    """A name for each segment of a profile: (segment, segment_name).

    Dormant and at-risk segments are told by frequency and recency. The others take the
    value labels in order of value (spend outlook plus frequency, both standardised);
    segments beyond the labels are called by their number. The profile has k rows.
    """
    whole = Window.partitionBy()

    def z(column: str) -> Column:
        centred = F.col(column) - F.avg(column).over(whole)
        return F.coalesce(F.try_divide(centred, F.stddev_pop(column).over(whole)), F.lit(0.0))

    median = F.median("recency_days").over(whole)
    valued = profile.select(
        "segment",
        (z("clv_predicted") + z("frequency")).alias("value"),
        F.when((F.col("frequency") < 0.5) & (F.col("recency_days") > median), DORMANT)
        .when(F.col("recency_days") > median * 1.3, AT_RISK)
        .alias("override"),
    )
    rank = F.row_number().over(
        Window.partitionBy(F.col("override").isNull()).orderBy(F.col("value").desc(), "segment")
    )
    label = F.get(F.array(*[F.lit(v) for v in VALUE_LABELS]), rank - 1)
    numbered = F.concat(F.lit("Segment "), F.col("segment").cast("string"))
    return valued.select("segment", F.coalesce("override", label, numbered).alias("segment_name"))


def with_segment_names(df: DataFrame) -> DataFrame:
    """Profile, name and attach `segment_name` to every customer.

    The names are one row per segment; written, their size is known to the planner.
    """
    names = materialize(name_segments(profile_segments(df)), "segment_names")
    return df.drop("segment_name").join(names, "segment", "left")


def segment_profiles(df: DataFrame) -> DataFrame:
    """The named profile table, best spend outlook first."""
    profile = profile_segments(df)
    return profile.join(name_segments(profile), "segment").orderBy(F.col("clv_predicted").desc())
