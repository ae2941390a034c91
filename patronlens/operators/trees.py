"""Tree ensembles grown from histograms that Spark sums: boosting of first and second order, and forests.

Features are cut into bins once (`bin_edges`, exact order statistics of 32-bit prefixes by digit histograms).
The binned rows are dealt evenly over the tasks and kept in blocks. Every level of a tree is one pass: tasks add up
gradient, mass and rows per (node, feature, bin) over their blocks, the sums are merged, and the best split of each node
follows. The driver holds the trees and, per pass, one row per node; task histograms are merged on the executors
first when they are many. While they are few, boosting passes over the smaller child of each split only: the other
has what the parent has besides.

Rows and columns are drawn by hashes of (key, tree, seed) and sums are whole numbers, so a fit depends on the rows and
the seed alone: not on partitions, files or cores.

Boosting of small trees over unweighted rows takes features two at a time, in histograms and to walk finished trees (`Recipe.quick`); the
trees are the same.

Finished trees are added to the margins of boosting inside the passes that follow; every `CARRIED` trees the blocks are written anew
with them, and every `SPAN` trees checkpointed, so that a lost block is made again from there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from patronlens.functions import histograms as hist
from patronlens.workspace import even_tasks, shared_folder, ship_package

BINS = 64
# Boosted trees between two checkpoints of the blocks.
SPAN = 25
# Boosted trees that passes add to the margins themselves, before the blocks are kept with them: writing all blocks costs more.
CARRIED = 10
# Rows of a block, and of one whose features are taken two at a time; rows that make a task worth its start.
BLOCK = 10_000
QUICK_BLOCK = 32_000
LEAST = 4_000
# Bytes of task histograms that the driver adds up itself; more are merged on the executors.
DIRECT = 32 << 20
# Bytes of merged histograms that a task of a merge holds.
MERGED = 4 << 20
# Bytes of histograms that a task holds for the forest's trees that grow together.
TOGETHER = 32 << 20

_BLOCKS = "ids binary, bins binary, label binary, weight binary"


@dataclass(frozen=True)
class Recipe:
    """What to grow. `share` of the rows is drawn per tree, or a bootstrap if it is None."""

    trees: int
    depth: int
    boosted: bool = True
    second_order: bool = False
    rate: float = 0.1
    share: float | None = 1.0
    columns: float = 1.0
    # Features drawn anew for every node; 0 takes the tree's.
    node_features: int = 0
    penalty: float = 0.0
    least_rows: int = 1
    least_mass: float = 0.0
    bins: int = BINS
    seed: int = 42

    @property
    def quick(self) -> bool:
        """Whether features can be taken two at a time, if rows weigh the same: every tree sees all rows and columns and has few splits."""
        whole = self.share == 1.0 and self.columns == 1.0 and not self.node_features
        return self.boosted and whole and 2**self.depth - 1 <= hist.MASKED and self.bins <= 1 << hist.BIN_BITS


@dataclass
class TreeEnsemble:
    """A fitted ensemble: per tree the feature, threshold, value and gain at every place of a heap."""

    features: list[str]
    boosted: bool
    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @property
    def n_trees(self) -> int:
        return len(self.feature)

    @property
    def total_nodes(self) -> int:
        """Splits and leaves of all trees."""
        return int(2 * (self.feature >= 0).sum() + self.n_trees)

    @property
    def importances(self) -> np.ndarray:
        """Gain per feature, every tree's shares first, summing to one."""
        out = np.zeros(len(self.features))
        for feature, gain in zip(self.feature, self.gain):
            split = feature >= 0
            if gain[split].sum() > 0:
                out += np.bincount(feature[split], gain[split], len(out)) / gain[split].sum()
        return out / (out.sum() or 1.0)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for the columns of `x` (feature by row)."""
        total = np.full(x.shape[1], self.base)
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            total += hist.reached_values(x, feature, threshold, value, self.depth)
        return hist.probability(total) if self.boosted else total / self.n_trees

    def probability(self) -> Column:
        """Probability of class 1 as a column over the feature columns."""
        ship_package(SparkSession.active())
        feature, threshold, value, depth, base, boosted = self.feature, self.threshold, self.value, self.depth, self.base, self.boosted
        binned = self._binned()

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            carried = None if binned is None else hist.Carried(binned[1], depth, len(binned[0]))
            for columns in batches:
                x = np.stack([c.to_numpy(np.float64) for c in columns])
                total = np.full(x.shape[1], base)
                if carried is not None:
                    total = carried.added(hist.paired(hist.binned(x, binned[0])), total)
                else:
                    for f, t, v in zip(feature, threshold, value):
                        total += hist.reached_values(x, f, t, v, depth)
                yield pd.Series(hist.probability(total) if boosted else total / len(feature))

        return score(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in self.features])

    def _binned(self) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray, np.ndarray]]] | None:
        """Per feature its thresholds, and the trees (feature, cut, value) with places among them; None for trees with many splits."""
        thresholds = [np.unique(self.threshold[self.feature == j]) for j in range(len(self.features))]
        if 2**self.depth - 1 > hist.MASKED or any(len(t) >= 1 << hist.BIN_BITS for t in thresholds):
            return None
        cut = np.zeros_like(self.feature)
        for j, t in enumerate(thresholds):
            cut[self.feature == j] = np.searchsorted(t, self.threshold[self.feature == j])
        return thresholds, list(zip(self.feature, cut, self.value))

    def save(self, path: str) -> None:
        """One row per split or leaf, and the description in row -1."""
        spark = SparkSession.active()
        about = json.dumps({"features": self.features, "boosted": self.boosted, "base": self.base, "depth": self.depth, "trees": self.n_trees})
        grown = np.argwhere((self.feature >= 0) | (self.value != 0))
        rows = [(-1, 0, 0, 0.0, 0.0, 0.0, about)] + [
            (int(t), int(i), int(self.feature[t, i]), float(self.threshold[t, i]), float(self.value[t, i]), float(self.gain[t, i]), None) for t, i in grown
        ]
        schema = "tree int, place int, feature int, threshold double, value double, gain double, about string"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> TreeEnsemble:
        rows = SparkSession.active().read.parquet(path).toPandas()
        about = json.loads(rows.loc[rows["tree"] == -1, "about"].iloc[0])
        rows = rows[rows["tree"] >= 0]
        feature, threshold, value, gain = _empty_trees(about["trees"], about["depth"])
        at = (rows["tree"].to_numpy(), rows["place"].to_numpy())
        for array, column in ((feature, "feature"), (threshold, "threshold"), (value, "value"), (gain, "gain")):
            array[at] = rows[column].to_numpy()
        return cls(about["features"], about["boosted"], about["base"], about["depth"], feature, threshold, value, gain)


def stored_ensemble(path: str) -> bool:
    """Whether the folder holds an ensemble (one table) and not a pipeline of stages."""
    spark = SparkSession.active()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/stages")
    return not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _empty_trees(trees: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    shape = (trees, 2 ** (depth + 1) - 1)
    return np.full(shape, -1, np.int64), np.zeros(shape), np.zeros(shape), np.zeros(shape)


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """The upper 32 bits of doubles, as numbers in the order of the doubles."""
    bits = (x + 0.0).view(np.int64)
    return ((np.where(bits < 0, ~bits, bits | np.int64(-1 << 63)).view(np.uint64)) >> np.uint64(32)).astype(np.int64)


def _from_bits(bits: int) -> float:
    """The largest double with the given upper bits."""
    whole = (bits << 32) | 0xFFFFFFFF
    raw = whole & ~(1 << 63) if whole >> 63 else ~whole & (1 << 64) - 1
    return float(np.array([raw], np.uint64).view(np.float64)[0])


def _digit_counts(df: DataFrame, features: Sequence[str], shift: int, wanted: list[np.ndarray] | None) -> dict[int, dict[int, int]]:
    """Per feature the number of values under each prefix down to `shift`; only below the prefixes `wanted`, if given."""
    parents = [np.zeros(1, np.int64)] * len(features) if wanted is None else wanted
    step = 16 if wanted is None else 8

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(p) << step, np.int64) for p in parents]
        for batch in batches:
            for j, p in enumerate(parents):
                prefix = _ordered_bits(batch.column(j).to_numpy(zero_copy_only=False)) >> shift
                parent = prefix >> step
                at = np.minimum(np.searchsorted(p, parent), len(p) - 1)
                code = (at << step) + (prefix & (1 << step) - 1)
                counts[j] += np.bincount(code[p[at] == parent], minlength=len(counts[j]))
        for j, p in enumerate(parents):
            found = np.flatnonzero(counts[j])
            prefix = (p[found >> step] << step) + (found & (1 << step) - 1)
            yield pa.RecordBatch.from_pydict({"feature": np.full(len(found), j, np.int32), "prefix": prefix, "n": counts[j][found]})

    values = df.select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"f{j}") for j, f in enumerate(features)])
    counted = values.mapInArrow(count, "feature int, prefix bigint, n bigint").groupBy("feature", "prefix").agg(F.sum("n").alias("n"))
    out: dict[int, dict[int, int]] = {j: {} for j in range(len(features))}
    for row in counted.collect():
        out[row["feature"]][row["prefix"]] = row["n"]
    return out


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of at most `bins` equal-count bins per feature, the last one open.

    The values at the wanted ranks are found digit by digit: counts by the first 16 bits, then by 8 more under
    the prefixes that hold a wanted rank, then by the last 8 of 32 bits. No sort; the driver sees counts.
    """
    chosen, below, counts = None, None, None
    for shift in (16, 8, 0):
        counts = _digit_counts(df, features, shift, chosen)
        if chosen is None:
            sizes = [sum(c.values()) for c in counts.values()]
            ranks = [sorted({-(-n * i // bins) for i in range(1, bins)} - {0}) for n in sizes]
            groups = [{None: (0, r)} for r in ranks]
        step = 16 if chosen is None else 8
        after = []
        for j, by in enumerate(groups):
            found: dict[int, tuple[int, list[int]]] = {}
            for parent, (start, wanted) in by.items():
                mine = sorted((p, n) for p, n in counts[j].items() if parent is None or p >> step == parent)
                at, k = start, 0
                for prefix, n in mine:
                    held = []
                    while k < len(wanted) and wanted[k] <= at + n:
                        held.append(wanted[k])
                        k += 1
                    if held:
                        found[prefix] = (at, held)
                    at += n
            after.append(found)
        groups = after
        chosen = [np.array(sorted(g), np.int64) for g in groups]
    return [np.array([_from_bits(int(p)) for p in c]) for c in chosen]


def _narrow(x: np.ndarray) -> np.ndarray:
    """Labels of 0 and 1 as bytes."""
    small = x.astype(np.int8)
    return small if (small == x).all() else x


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches in tables of `rows` rows, the last one smaller."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= rows:
            whole = pa.Table.from_batches(held)
            yield whole.slice(0, rows)
            held = whole.slice(rows).to_batches()
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _blocks(
    df: DataFrame, keys: Sequence[str], label: str, weight: str | None, features: Sequence[str], edges: list[np.ndarray], base: float | None, n: int,
    rows: int = BLOCK, keyed: bool = True,
) -> RDD:
    """The binned rows as blocks of up to `rows`, dealt evenly by key; with margins unless `base` is None, without keys if nothing is drawn by them."""
    plain = df.select(
        F.xxhash64(*keys).alias("id"), F.col(label).cast("double").alias("label"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"f{j}") for j, f in enumerate(features)],
    )
    dealt = plain.repartition(even_tasks(n, df.sparkSession.sparkContext.defaultParallelism, LEAST), "id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(batches, rows):
            columns = [c.to_numpy() for c in part.columns]
            bins = np.stack([np.searchsorted(e, x, "left").astype(np.uint8) for e, x in zip(edges, columns[3:])])
            same = columns[2][:1] if (columns[2] == columns[2][0]).all() else columns[2]
            row = [columns[0].astype(np.int64) if keyed else columns[0][:0], bins, _narrow(columns[1]), same]
            yield pa.RecordBatch.from_pydict({c: [np.ascontiguousarray(a).tobytes()] for c, a in zip(("ids", "bins", "label", "weight"), row)})

    n_features = len(features)

    def unpack(row: Row) -> hist.Rows:
        bins = np.frombuffer(row["bins"], np.uint8).reshape(n_features, -1)
        n_rows = bins.shape[1]
        labels = np.frombuffer(row["label"], np.int8 if len(row["label"]) == n_rows else np.float64)
        margin = np.full(0 if base is None else n_rows, base or 0.0)
        return hist.Rows(np.frombuffer(row["ids"], np.int64), bins, labels, np.frombuffer(row["weight"], np.float64), margin)

    return dealt.mapInArrow(pack, _BLOCKS).rdd.map(unpack)


def _with_trees(rows: hist.Rows, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int) -> hist.Rows:
    """The rows with trees (feature, cut, value) added to their margins, one after the other."""
    added = (hist.reached_values(rows.bins, feature, cut, value, depth) for feature, cut, value in trees)
    return rows._replace(margin=reduce(np.add, added, rows.margin)) if trees else rows


def _advanced(blocks: Iterator[hist.Rows], trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int) -> Iterator[hist.Rows]:
    """`_with_trees` for blocks whose trees are walked two features at a time."""
    carried = None
    for rows in blocks:
        carried = carried or hist.Carried(trees, depth, len(rows.bins))
        yield rows._replace(margin=carried.added(hist.paired(rows.bins), rows.margin))


def _quick_sums(blocks: Iterator[hist.Rows], levels: list[hist.Level], trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], recipe: Recipe, sums: list[np.ndarray]) -> None:
    """Add the blocks' histograms to `sums`, two features at a time. Margins are made up for the rows of a slot alone."""
    walks = None
    for rows in blocks:
        if walks is None:
            carried = hist.Carried(trees, recipe.depth, len(rows.bins))
            walks = [(hist.turn_tables([(v.feature, v.cut)], len(rows.bins)), hist.ends(v.feature, v.depth, v.slot)) for v in levels]
            bits = 2**recipe.depth - 1
        whole = hist.paired(rows.bins)
        for level, (tables, slots), total in zip(levels, walks, sums):
            codes, label, margin, slot = whole, rows.label, rows.margin, None
            if level.depth:
                slot = slots.take(hist.turns_of(hist.turned(whole, tables), 0, bits))
                at = np.flatnonzero(slot >= 0)
                codes, label, margin, slot = [c.take(at) for c in whole], label.take(at), margin.take(at), slot.take(at)
            margin = carried.added(codes, margin)
            found = hist.paired_histograms(codes, label, margin, slot, len(level.chosen), len(rows.bins), recipe.second_order)
            total += found[:, :, :recipe.bins]


class _Grower:
    """Blocks of binned rows and the passes over them; `quick` ones take features two at a time."""

    def __init__(self, spark: SparkSession, blocks: RDD, recipe: Recipe, quick: bool = False):
        self.spark, self.recipe, self.stale, self.saved, self.quick = spark, recipe, [], [], quick
        self.carried: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        folder = shared_folder(spark)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        self.blocks = self._kept(blocks, True)
        self.tasks = self.blocks.getNumPartitions()

    def _kept(self, blocks: RDD, checkpoint: bool) -> RDD:
        """Keep blocks in memory, or on disk, from the next pass on."""
        blocks.persist(StorageLevel.MEMORY_AND_DISK)
        if checkpoint:
            blocks.checkpoint()
            self.saved.append(blocks)
        return blocks

    def _forget(self, saved: list[RDD]) -> None:
        """Remove checkpoints that nothing is made from any more."""
        jvm = self.spark.sparkContext._jvm
        for blocks in saved:
            if blocks.getCheckpointFile():
                path = jvm.org.apache.hadoop.fs.Path(blocks.getCheckpointFile())
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        for blocks in (*self.stale, self.blocks):
            blocks.unpersist()
        self._forget(self.saved)

    def advance(self, tree: _Tree, checkpoint: bool) -> None:
        """Add a tree to the margins; the next passes do it."""
        self.carried = [*self.carried, (tree.feature, tree.cut, tree.value)]
        if checkpoint or len(self.carried) == CARRIED:
            self.stale.append(self.blocks)
            how = {"trees": self.carried, "depth": self.recipe.depth}
            self.blocks = self._kept(
                self.blocks.mapPartitions(partial(_advanced, **how)) if self.quick else self.blocks.map(partial(_with_trees, **how)), checkpoint
            )
            self.carried = []

    def _passed(self) -> None:
        """After a pass the blocks before it are not needed."""
        for blocks in self.stale:
            blocks.unpersist()
        self.stale = []
        if len(self.saved) > 1 and self.saved[-1].isCheckpointed():
            self._forget(self.saved[:-1])
            self.saved = self.saved[-1:]

    def few(self, levels: list[hist.Level]) -> bool:
        """Whether the driver can add up the tasks' sums for the levels."""
        return sum(8 * int(np.prod(shape)) for shape in self._shapes(levels)) * self.tasks <= DIRECT

    def _shapes(self, levels: list[hist.Level]) -> list[tuple]:
        return [(*level.chosen.shape, self.recipe.bins, 4) for level in levels]

    def _summed(self, levels: list[hist.Level]) -> RDD:
        """Per task its sums for each of the levels."""
        r, shapes, carried, quick = self.recipe, self._shapes(levels), self.carried, self.quick

        def add_up(blocks: Iterator[hist.Rows]) -> Iterator[list[np.ndarray]]:
            sums = [np.zeros(shape, np.int64) for shape in shapes]
            if quick:
                _quick_sums(blocks, levels, carried, r, sums)
                yield sums
                return
            for rows in (_with_trees(rows, carried, r.depth) for rows in blocks):
                stats = partial(hist.statistics, rows, boosted=r.boosted, second_order=r.second_order)
                if not r.boosted:
                    # All trees of a forest see the same values.
                    whole = stats(np.arange(len(rows.ids)))
                    stats = partial(_chosen, whole)
                for level, total in zip(levels, sums):
                    taken = None if r.share == 1.0 else hist.multiplicity(rows.ids, level.tree, r.seed, r.share)
                    total += hist.level_histograms(rows, level, taken, stats, r.bins)
            yield sums

        return self.blocks.mapPartitions(add_up)

    def sums(self, levels: list[hist.Level]) -> list[np.ndarray]:
        """The sums of all slots of the given levels, one pass; for levels that are `few`."""
        merged = [np.zeros(shape, np.int64) for shape in self._shapes(levels)]
        for part in self._summed(levels).collect():
            for total, found in zip(merged, part):
                total += found
        self._passed()
        return merged

    def best(self, total: np.ndarray) -> np.ndarray:
        return hist.best_splits(total, self.recipe.penalty, self.recipe.least_rows, self.recipe.least_mass)

    def splits(self, levels: list[hist.Level]) -> list[np.ndarray]:
        """The best splits of all slots of the given levels, one pass."""
        if self.few(levels):
            return [self.best(total) for total in self.sums(levels)]
        r, shapes = self.recipe, self._shapes(levels)

        def choose(total: np.ndarray) -> np.ndarray:
            return hist.best_splits(total[None], r.penalty, r.least_rows, r.least_mass)[0]

        # A task of the merge holds a bounded part of the slots.
        slots, size = sum(shape[0] for shape in shapes), sum(8 * int(np.prod(shape)) for shape in shapes)
        parts = max(1, min(slots, -(-size // MERGED)))
        each = self._summed(levels).flatMap(lambda sums: (((i << 20) + j, s) for i, total in enumerate(sums) for j, s in enumerate(total)))
        out = [np.empty((shape[0], 11)) for shape in shapes]
        for at, found in each.reduceByKey(np.add, parts).mapValues(choose).collect():
            out[at >> 20][at & (1 << 20) - 1] = found
        self._passed()
        return out


def _chosen(stats: tuple[np.ndarray, ...], at: np.ndarray) -> tuple[np.ndarray, ...]:
    """The statistics of some rows; what is one array stays one."""
    label, weight, _ = stats
    weight = weight if weight.size == 1 else weight.take(at)
    return label.take(at), weight, weight


class _Tree:
    """A tree that grows level by level."""

    def __init__(self, number: int, recipe: Recipe, n_features: int):
        self.number, self.recipe = number, recipe
        self.feature, self.cut, self.value, self.gain = (a[0] for a in _empty_trees(1, recipe.depth))
        self.cut = self.cut.astype(np.int64)
        draw = np.random.default_rng((recipe.seed, number))
        n = max(1, round(recipe.columns * n_features))
        self.columns = np.sort(draw.permutation(n_features)[:n])
        self.draw, self.open, self.depth = draw, [0], 0
        # Of each open place: the slot of its parent, and its rows.
        self.parents: list[int] = []
        self.rows: list[float] = []

    def level(self) -> hist.Level:
        slot = np.full(len(self.feature), -1, np.int64)
        slot[self.open] = np.arange(len(self.open))
        n = self.recipe.node_features
        chosen = [np.sort(self.draw.permutation(self.columns)[:n]) if n else self.columns for _ in self.open]
        self.asked = np.array(chosen)
        return hist.Level(self.number, self.feature.copy(), self.cut.copy(), self.depth, slot, self.asked)

    def grow(self, splits: np.ndarray) -> None:
        r, after, self.parents, self.rows = self.recipe, [], [], []

        def worth(sums: np.ndarray) -> float:
            value = sums[0] / hist.SCALE / (sums[2] / hist.SCALE + r.penalty) if sums[2] > 0 else 0.0
            return value * r.rate if r.boosted else value

        for j, place in enumerate(self.open):
            position, cut, gain, left, whole = int(splits[j, 0]), int(splits[j, 1]), splits[j, 2], splits[j, 3:7], splits[j, 7:]
            if place == 0:
                self.value[0] = worth(whole)
            if position < 0:
                continue
            self.feature[place], self.cut[place], self.gain[place] = self.asked[j, position], cut, gain
            self.value[place] = 0.0
            for child, sums in ((2 * place + 1, left), (2 * place + 2, whole - left)):
                self.value[child] = worth(sums)
                after.append(child)
                self.parents.append(j)
                self.rows.append(sums[3])
        self.depth += 1
        self.open = after if self.depth < r.depth else []


def fit(df: DataFrame, features: Sequence[str], keys: Sequence[str], recipe: Recipe, label: str = "label", weight: str | None = None) -> TreeEnsemble:
    """Grow an ensemble over `df`, which is read a few times and should be a written table."""
    ship_package(df.sparkSession)
    edges = bin_edges(df, features, recipe.bins)
    w = F.col(weight).cast("decimal(28,10)") if weight else F.lit(1).cast("decimal(28,10)")
    mass = df.agg(F.count("*").alias("n"), F.sum(F.when(F.col(label) == 1, w)).alias("one"), F.sum(F.when(F.col(label) == 0, w)).alias("none")).first()
    base = float(np.log(float(mass["one"] or 1) / float(mass["none"] or 1))) if recipe.boosted else 0.0
    quick = recipe.quick and weight is None
    size = QUICK_BLOCK if quick else BLOCK
    blocks = _blocks(df, keys, label, weight, features, edges, base if recipe.boosted else None, mass["n"], size, keyed=not quick)
    grower = _Grower(df.sparkSession, blocks, recipe, quick)
    try:
        grown = _boosted(grower, recipe, len(features)) if recipe.boosted else _forest(grower, recipe, len(features))
    finally:
        grower.release()
    feature, threshold, value, gain = _empty_trees(recipe.trees, recipe.depth)
    for t, tree in enumerate(grown):
        feature[t], value[t], gain[t] = tree.feature, tree.value, tree.gain
        for place in np.flatnonzero(tree.feature >= 0):
            threshold[t, place] = edges[tree.feature[place]][tree.cut[place]]
    return TreeEnsemble(list(features), recipe.boosted, base, recipe.depth, feature, threshold, value, gain)


def _boosted(grower: _Grower, recipe: Recipe, n_features: int) -> list[_Tree]:
    grown: list[_Tree] = []
    for number in range(recipe.trees):
        if grown:
            grower.advance(grown[-1], number % SPAN == 0)
        tree, held = _Tree(number, recipe, n_features), None
        while tree.open:
            level = tree.level()
            if recipe.node_features or not grower.few([level]):
                held = None
                tree.grow(grower.splits([level])[0])
            else:
                held = _level_sums(grower, tree, level, held)
                tree.grow(grower.best(held))
        grown.append(tree)
    return grown


def _level_sums(grower: _Grower, tree: _Tree, level: hist.Level, parents: np.ndarray | None) -> np.ndarray:
    """Sums of a level's slots; from those of the level before, a pass over the smaller child of each pair is enough."""
    if parents is None:
        return grower.sums([level])[0]
    # Open places come in pairs, left and right.
    pairs = np.arange(len(tree.open)).reshape(-1, 2)
    right = np.array(tree.rows).reshape(-1, 2).argmin(axis=1)
    every = np.arange(len(pairs))
    asked, other = pairs[every, right], pairs[every, 1 - right]
    slot = np.full_like(level.slot, -1)
    slot[np.array(tree.open)[asked]] = every
    part = grower.sums([level._replace(slot=slot, chosen=level.chosen[asked])])[0]
    out = np.empty((len(tree.open), *part.shape[1:]), np.int64)
    out[asked] = part
    out[other] = parents[np.array(tree.parents)[other]] - part
    return out


def _forest(grower: _Grower, recipe: Recipe, n_features: int) -> list[_Tree]:
    """Trees grow side by side, as many at a level as `TOGETHER` holds."""
    trees = [_Tree(number, recipe, n_features) for number in range(recipe.trees)]
    per_slot = 32 * recipe.bins * (recipe.node_features or n_features)
    for _ in range(recipe.depth):
        waiting = [t for t in trees if t.open]
        while waiting:
            size, n = 0, 0
            while n < len(waiting) and (n == 0 or size + per_slot * len(waiting[n].open) <= TOGETHER):
                size += per_slot * len(waiting[n].open)
                n += 1
            now, waiting = waiting[:n], waiting[n:]
            for tree, splits in zip(now, grower.splits([t.level() for t in now])):
                tree.grow(splits)
    return trees
