"""Scalar expressions for dates, money, value, risk and churn."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _as_date(as_of) -> Column:
    return F.lit(as_of).cast("date")


def whole_days(as_of, date) -> Column:
    """Whole days from `date` to the as-of date."""
    return F.datediff(_as_date(as_of), _col(date))


def clip(value, low, high) -> Column:
    return F.least(F.greatest(_col(value), F.lit(low)), F.lit(high))


def ratio(part, whole) -> Column:
    """Share of a total; a zero total counts as one."""
    whole = _col(whole)
    return _col(part) / F.when(whole == 0, F.lit(1.0)).otherwise(whole)


def mean(value) -> Column:
    """Group mean as a double. Exact sums of integers and decimals make it repeatable."""
    return F.try_divide(F.sum(_col(value)).cast("double"), F.count(_col(value)).cast("double"))


def decimal_mean(value) -> Column:
    """Mean of doubles that does not depend on row order: summed as decimals."""
    return mean(_col(value).cast("decimal(28,12)"))


def full_name(first="first_name", last="last_name") -> Column:
    """Null if either part is null."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def month_bucket(date) -> Column:
    return F.date_format(_col(date), "yyyy-MM")


def line_revenue(gross, discount) -> Column:
    """Discounted line amount in cents precision, on decimals throughout; the discount has up to four digits."""
    kept = F.lit(1).cast("decimal(5,4)") - _col(discount).cast("decimal(5,4)")
    net = (_col(gross).cast("decimal(12,2)") * kept).cast("decimal(20,6)")
    return F.round(net, 2).cast("decimal(18,2)")


def tenure_years(as_of, signup="signup_date", floor=0.1) -> Column:
    return F.greatest(whole_days(as_of, signup) / F.lit(DAYS_PER_YEAR), F.lit(floor))


def purchases_per_year(frequency="frequency", tenure="tenure_years") -> Column:
    return _col(frequency) / _col(tenure)


def retention_factor(
    recency="recency_days", tenure="tenure_years", weight=0.6, lo=0.1, hi=0.95, grace_days=30
) -> Column:
    """One minus the weighted share of the tenure spent without buying, kept in [lo, hi]."""
    idle = _col(recency) / (_col(tenure) * F.lit(DAYS_PER_YEAR) + F.lit(grace_days))
    return clip(F.lit(1.0) - clip(idle, 0.0, 1.0) * F.lit(weight), lo, hi)


def predicted_clv(retention, years=3, aov="avg_order_value", rate="purchase_freq_per_year") -> Column:
    value = F.coalesce(_col(aov), F.lit(0.0)) * F.coalesce(_col(rate), F.lit(0.0))
    return F.bround(value * F.lit(years) * retention, 2)


def churn_rules(as_of, long=365, mid=180, new=120, csat=3, missing_gap=9999) -> dict[str, Column]:
    """The three churn rules by name; a rule over a null input does not fire."""
    gap = F.coalesce(F.col("days_since_last_session"), F.lit(missing_gap))
    recency = F.col("recency_days")
    rules = {
        "long_dormant": recency > long,
        "mid_dormant": (recency > mid)
        & (F.coalesce(F.col("avg_csat") < csat, F.lit(False)) | (gap > mid)),
        "dormant_never_bought": (F.col("frequency") == 0)
        & (whole_days(as_of, "signup_date") > new)
        & (gap > new),
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def churn_flag(as_of, **thresholds) -> Column:
    rules = churn_rules(as_of, **thresholds).values()
    return reduce(lambda a, b: a | b, rules).cast("int")


def predicted_flag(probability, cut=0.5) -> Column:
    """1 when the probability, rounded to four digits, reaches the cut."""
    return (F.bround(_col(probability), 4) >= F.lit(cut)).cast("int")


def risk_band(probability, high=0.7, medium=0.4) -> Column:
    p = _col(probability)
    return F.when(p >= high, "High Risk").when(p >= medium, "Medium Risk").otherwise("Low Risk")


def color_band(probability, red=0.7, yellow=0.4) -> Column:
    """Display rule; unlike the risk band the upper bound is strict."""
    p = _col(probability)
    return F.when(p > red, "red").when(p >= yellow, "yellow").otherwise("green")
