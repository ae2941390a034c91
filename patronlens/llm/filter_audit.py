"""How filters interact: what each removes in every order, from one walk over all subsets.

Every document fails some of the filters; the set of those is its mask. Documents are counted per
part and mask (at most 32 cells of five filters). A Gray code then visits all subsets of filters, each one
filter from the one before: the toggled filter moves the active-failure counter of the cells that
fail it, and a cell whose counter comes to or leaves zero joins or leaves the running survivors. The 32
stored states give every step of every order as a difference of two.

The cells need one filter that looks at the whole table: a text that some smaller id has too. Its
groups are counted per (digest, part, mask, labels) before the least id of a digest is joined back,
so a group of copies of any size is a few rows by then.

Defined cases: a null text counts as empty and a null part as the empty string; a row without an id
has no labels, is a copy of nothing and makes no copies; of rows that share the least id of a text none
is a copy; a label that is missing or null is not 1, and with several label rows of an id one that says 1 is enough;
an empty table gives an empty result. Only id, text and part are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.workspace import materialize

FEWEST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
SYMBOLS = "[#$%&*|]"
FILTERS = "ABCDE"

_GAPS = r"[\x20\x09-\x0D]+"
# Parts whose orders are written out together: 600 rows of five filters for each.
_PARTS = 64


def conditions(text: Column) -> list[Column]:
    """Where the text fails A (short), B (repetitive), C (capitals) and D (symbols)."""
    words = F.array_remove(F.split(text, _GAPS), "")
    n = F.size(words)
    return [
        n < FEWEST_WORDS,
        F.size(F.array_distinct(words)) * 100 < n * LEAST_DISTINCT,
        F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * MOST_CAPITALS,
        text.rlike(SYMBOLS),
    ]


def failure_cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters; bit i stands for filter i."""
    whole = F.coalesce(F.col(text), F.lit(""))
    failed = conditions(whole)
    mask = reduce(lambda a, b: a + b, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failed)])
    slim = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(whole, 256)).alias("digest"), mask.alias("mask")
    )
    slim = materialize(slim, "masks")
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    keys = ["id", "digest", "part", "mask", "good", "toxic"]
    known = slim.where("id is not null").join(flags, "id", "left").na.fill(0, ["good", "toxic"])
    unknown = slim.where("id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    rows = known.groupBy(*keys).agg(F.count("*").alias("n")).unionByName(unknown.groupBy(*keys).agg(F.count("*").alias("n")))

    group = ["digest", "part", "mask", "good", "toxic"]
    counted = rows.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by(F.when(F.col("id").isNotNull(), F.col("n")), "id").alias("n_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_none"),
    )
    counted = materialize(counted, "copies")
    first = counted.groupBy("digest").agg(F.min("least").alias("first"))
    split = counted.join(first, "digest").withColumn(
        "n_first", F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0) + F.col("n_none")
    )
    copied = 1 << len(failed)
    both = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("n_first").alias("n")),
        F.struct((F.col("mask") + copied).alias("mask"), (F.col("n") - F.col("n_first")).alias("n")),
    ))
    cells = split.select("part", "good", "toxic", both.alias("c")).where("c.n > 0")
    return cells.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"), F.sum(F.col("c.n") * F.col("toxic")).alias("toxic")
    )


def gray_states(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters; `cells` is (parts, masks, counts), the result (subsets, parts, counts)."""
    n_masks = cells.shape[1]
    masks = np.arange(n_masks)
    active = np.zeros(n_masks, np.int64)
    survivors = cells.sum(axis=1)
    states = np.empty((n_masks, *survivors.shape), np.int64)
    states[0] = survivors
    subset = 0
    for step in range(1, n_masks):
        bit = step & -step
        subset ^= bit
        touched = masks[masks & bit != 0]
        if subset & bit:
            survivors = survivors - cells[:, touched[active[touched] == 0]].sum(axis=1)
            active[touched] += 1
        else:
            active[touched] -= 1
            survivors = survivors + cells[:, touched[active[touched] == 0]].sum(axis=1)
        states[subset] = survivors
    return states


def _steps(states: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Per order, step and part, in this order of axes: what the step keeps, removes and loses."""
    orders = list(permutations(range(n)))
    chosen = np.array(orders)
    after = np.cumsum(1 << chosen, axis=1)
    before = after - (1 << chosen)
    single, full = 1 << chosen, (1 << n) - 1
    gone = states[before] - states[after]
    removed = gone[..., 0]
    fails = states[0][None, None, :, 0] - states[single][..., 0]
    shares = []
    for i in range(n):
        without = [s for s in range(1 << n) if not s >> i & 1]
        weight = [factorial(s.bit_count()) * factorial(n - 1 - s.bit_count()) for s in without]
        shares.append(sum(w * (states[s][:, 0] - states[s | 1 << i][:, 0]) for w, s in zip(weight, without)))
    return {
        "kept": states[after][..., 0], "removed": removed, "redundant": fails - removed,
        "unique_fails": states[full - single][..., 0] - states[full][None, None, :, 0],
        "good_lost": gone[..., 1], "toxic_lost": gone[..., 2], "shapley": np.array(shares)[chosen],
    }


def audit(cells: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the counted cells."""
    n = len(filters)
    orders = ["".join(filters[i] for i in order) for order in permutations(range(n))]
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in columns)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), _PARTS):
                some = batch.iloc[start:start + _PARTS]
                counts = np.zeros((len(some), 1 << n, 3), np.int64)
                for i, listed in enumerate(some["cells"]):
                    for cell in listed:
                        counts[i, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
                found = _steps(gray_states(counts), n)
                yield pd.DataFrame({
                    "part": np.tile(some["part"].to_numpy(), len(orders) * n),
                    "filter_order": np.repeat(orders, n * len(some)),
                    "step": np.tile(np.repeat(np.arange(1, n + 1), len(some)), len(orders)),
                    **{c: found[c].reshape(-1) for c in columns},
                })

    # At most 2^n cells to a part.
    listed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return listed.mapInPandas(walk, schema)
