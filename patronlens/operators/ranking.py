"""Positions in a total order over a whole table, without a one-task window.

`place` range-partitions the rows on the sort key and writes them with their
position. Partition sizes (one small row per partition) turn positions into
global ranks. The sort key must be unique, so equal values never pile up in
one partition: the tie columns spread them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronlens.workspace import materialize, small_table

# monotonically_increasing_id keeps the partition number above this bit.
_PART_SHIFT = 33
# Values that `by` may have in order_statistics: the driver sees a row per partition and value.
MOST_GROUPS = 1000

Order = Sequence[tuple[str, bool]]


def _sort_columns(order: Order) -> list[Column]:
    return [F.col(name).asc() if up else F.col(name).desc() for name, up in order]


def place(df: DataFrame, order: Order) -> DataFrame:
    """Write `df` sorted on `order`; adds `_at` (position key) and `_part`."""
    keys = _sort_columns(order)
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _PART_SHIFT))
    )
    return materialize(placed, "placed")


def order_statistics(
    df: DataFrame, order: Order, ranks: Callable[[int], list[int]], by: str | None = None
) -> dict[object, list[Row]]:
    """The rows at the given 1-based ranks of every group.

    `ranks` maps a group's size to the wanted ranks. `by` names a column with few values
    (a label, a metric id). The driver sees one row per partition and one per wanted rank.
    """
    group = [by] if by else []
    columns = group + [name for name, _ in order]
    full_order = [(name, True) for name in group] + list(order)
    placed = place(df.select(*columns), full_order)
    runs: dict[object, list[Row]] = {}
    if by and placed.select(by).distinct().limit(MOST_GROUPS + 1).count() > MOST_GROUPS:
        raise ValueError(f"{by} has more than {MOST_GROUPS} values: it must be a label or an id of a metric")
    sized = placed.groupBy("_part", *group).agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    for run in sorted(sized.collect(), key=lambda r: r["first"]):
        runs.setdefault(run[by] if by else None, []).append(run)

    wanted: dict[object, list[int]] = {}
    for value, parts in runs.items():
        wanted[value] = [_position(parts, rank) for rank in ranks(sum(p["n"] for p in parts))]
    positions = sorted({at for ats in wanted.values() for at in ats})
    found = {r["_at"]: r for r in placed.where(F.col("_at").isin(positions)).collect()}
    return {value: [found[at] for at in ats] for value, ats in wanted.items()}


def _position(parts: list[Row], rank: int) -> int:
    for part in parts:
        if rank <= part["n"]:
            return part["first"] + rank - 1
        rank -= part["n"]
    raise IndexError("rank beyond the group's size")


def follows(order: Order, at: Row) -> Column:
    """True for rows that come after the row `at` in the given order."""
    after = F.lit(False)
    for name, up in reversed(list(order)):
        here, there = F.col(name), F.lit(at[name])
        after = (here > there if up else here < there) | ((here == there) & after)
    return after


def quantile_scores(
    df: DataFrame,
    specs: dict[str, tuple[str, bool]],
    k: int,
    tie: Sequence[str] = ("customer_id",),
) -> DataFrame:
    """Equal-count scores 1..k over unique ranks, for several values at once.

    `specs` maps an output column to (value column, ascending); ties follow `tie` ascending.
    Rank r of n gets max(1, ceil(k (r-1) / (n-1))), so bin i ends at rank
    1 + floor(i (n-1) / k). Only those k-1 boundary rows are looked up; the scores
    are then comparisons in one projection over `df`, which is read twice and should
    be a written table. A null value has no score.
    """
    values = list(specs.values())
    types = dict(df.dtypes)

    def entry(i: int) -> Column:
        cells = [
            (F.col(v) if i == j else F.lit(None).cast(types[v])).alias(f"_v{j}")
            for j, (v, _) in enumerate(values)
        ]
        return F.struct(F.lit(i).alias("_metric"), *cells)

    entries = F.explode(F.array(*[entry(i) for i in range(len(values))])).alias("_e")
    stacked = df.select(*tie, entries).select("_e.*", *tie)
    stacked = stacked.where(" or ".join(f"_v{j} is not null" for j in range(len(values))))
    order = [(f"_v{j}", up) for j, (_, up) in enumerate(values)] + [(t, True) for t in tie]
    cuts = order_statistics(
        stacked, order, lambda n: [1 + (n - 1) * i // k for i in range(1, k)], by="_metric"
    )

    scores = {}
    for j, (out, (value, up)) in enumerate(specs.items()):
        score = F.lit(1)
        for cut in cuts.get(j, []):
            at = Row(**{value: cut[f"_v{j}"], **{t: cut[t] for t in tie}})
            beyond = follows([(value, up)] + [(t, True) for t in tie], at)
            score = score + F.when(beyond, 1).otherwise(0)
        scores[out] = F.when(F.col(value).isNotNull(), score)
    return df.withColumns(scores)


def quantile_score(
    df: DataFrame, value: str, k: int, out: str, ascending: bool = True, tie: Sequence[str] = ("customer_id",)
) -> DataFrame:
    return quantile_scores(df, {out: (value, ascending)}, k, tie)


def global_rank(df: DataFrame, order: Order, out: str = "rank") -> DataFrame:
    """Adds the 1-based rank of every row in a unique total order."""
    placed = place(df, order)
    sized = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    before, offsets = 0, []
    for run in sorted(sized.collect(), key=lambda r: r["first"]):
        offsets.append((run["_part"], before - run["first"] + 1))
        before += run["n"]
    shifts = small_table(df.sparkSession, offsets, "_part bigint, _shift bigint")
    ranked = placed.join(shifts, "_part").withColumn(out, F.col("_at") + F.col("_shift"))
    return ranked.drop("_part", "_at", "_shift")


def running_totals(df: DataFrame, order: Order, totals: dict[str, str]) -> DataFrame:
    """Adds cumulative sums in a unique total order, the row itself included.

    `totals` maps an output column to an integer column. Each range partition is summed
    by itself and shifted by the sum of the partitions before it. The overall sum of each
    is added as `<output>_total`.
    """
    placed = place(df, order)
    sums = [F.sum(column).alias(out) for out, column in totals.items()]
    parts = placed.groupBy("_part").agg(*sums).collect()
    before, offsets = {out: 0 for out in totals}, []
    for part in sorted(parts, key=lambda r: r["_part"]):
        offsets.append((part["_part"], *before.values()))
        before = {out: seen + (part[out] or 0) for out, seen in before.items()}
    schema = ", ".join(["_part bigint"] + [f"_before_{out} bigint" for out in totals])
    shifts = small_table(df.sparkSession, offsets, schema)
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.join(shifts, "_part").withColumns(
        {out: F.sum(column).over(inside) + F.col(f"_before_{out}") for out, column in totals.items()}
    )
    overall = {f"{out}_total": F.lit(total).cast("bigint") for out, total in before.items()}
    return summed.drop("_part", "_at", *[f"_before_{out}" for out in totals]).withColumns(overall)
