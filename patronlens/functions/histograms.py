"""Numpy helpers of the tree learner: blocks of binned rows, their histograms, and splits from summed histograms.

A tree is three arrays over the places of a binary heap (children of i: 2i + 1 and 2i + 2): the
feature to look at (-1 in a leaf), the last bin or the threshold that goes left, and the value.
Gradients are whole numbers (`SCALE` to one), so their sums do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np

SCALE = float(1 << 24)


class Rows(NamedTuple):
    """A block of rows: hashed keys, binned features (feature by row), labels, weights (or one for all) and margins."""

    ids: np.ndarray
    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    margin: np.ndarray


class Level(NamedTuple):
    """One level of one tree that is being grown."""

    tree: int
    feature: np.ndarray
    cut: np.ndarray
    depth: int
    # Histogram slot of each heap place, -1 where no split is looked for, and the features of each slot.
    slot: np.ndarray
    chosen: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """One number in [0, 1) per row, from its key, the tree and the seed alone."""
    salt = mixed(np.array([seed * 1_000_003 + tree], np.uint64))
    return (mixed(ids.view(np.uint64) ^ salt) >> np.uint64(11)) * 2.0**-53


def multiplicity(ids: np.ndarray, tree: int, seed: int, share: float | None) -> np.ndarray:
    """How often a tree takes each row: once for `share` of the rows, or a Poisson draw of mean one."""
    u = uniform(ids, tree, seed)
    if share is not None:
        return (u < share).astype(np.float64)
    cumulative = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))
    return np.searchsorted(cumulative, u, side="right").astype(np.float64)


# Trees up to this depth are walked by comparing every split at once.
SHALLOW = 5


def descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The heap place each row reaches; works on bins and on raw values."""
    if depth <= SHALLOW:
        return _reached(feature, depth).take(_turns(bins, feature, cut, depth))
    n, after = bins.shape[1], _after(feature)
    place, every, flat = np.zeros(n, np.int64), np.arange(n), bins.ravel()
    first = np.maximum(feature, 0) * n
    for _ in range(depth):
        right = flat.take(first.take(place) + every) > cut.take(place)
        place = after.take(2 * place + right)
    return place


def reached_values(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, depth: int) -> np.ndarray:
    """The value at the place each row reaches."""
    if depth <= SHALLOW:
        return value.take(_reached(feature, depth)).take(_turns(bins, feature, cut, depth))
    return value.take(descend(bins, feature, cut, depth))


def _after(feature: np.ndarray) -> np.ndarray:
    """Where a row goes from each place, to the left and to the right; from a leaf it goes nowhere."""
    places = np.arange(len(feature))
    return np.where(feature < 0, [places, places], [2 * places + 1, 2 * places + 2]).T.ravel()


def _reached(feature: np.ndarray, depth: int) -> np.ndarray:
    """The place at the end of each sequence of turns (bits, first turn first, 1 to the right)."""
    after, turns, place = _after(feature), np.arange(2**depth), np.zeros(2**depth, np.int64)
    for level in reversed(range(depth)):
        place = after.take(2 * place + (turns >> level & 1))
    return place


def _turns(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The turns of each row as one number; whole columns are compared, and a row's turns so far pick among the places of a level."""
    turned: list[np.ndarray] = []
    code = np.zeros(bins.shape[1], np.uint8)
    none = np.zeros(bins.shape[1], bool)
    for level in range(depth):
        # A plain number leaves the type of the column as it is.
        found = [bins[feature[p]] > cut[p].item() if feature[p] >= 0 else None for p in range(2**level - 1, 2 ** (level + 1) - 1)]
        for right in reversed(turned):
            found = [_picked(right, found[i], found[i + 1]) for i in range(0, len(found), 2)]
        turned.append(none if found[0] is None else found[0])
        code = (code << 1) | turned[-1]
    return code


def _picked(right: np.ndarray, a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    """`b` where a row went to the right and `a` elsewhere; None is never."""
    if a is None:
        return None if b is None else b & right
    return a > right if b is None else a ^ (right & (a ^ b))


# Bits of a bin in the code of a pair of features, and the most splits of a tree that are turned at once, one bit of a word each.
BIN_BITS = 6
MASKED = 15
# Bits of the sum of curvatures below the count of rows, and the rows whose packed sums a double holds exactly.
CURVE_BITS = 38
PACKED = 1 << 15


def paired(bins: np.ndarray) -> list[np.ndarray]:
    """Each two features as one code of 12 bits; the last of an odd number stands alone."""
    upper = [bins[j].astype(np.uint16) << BIN_BITS for j in range(0, len(bins), 2)]
    return [u | bins[2 * i + 1] if 2 * i + 1 < len(bins) else u for i, u in enumerate(upper)]


def _bits(feature: np.ndarray) -> int:
    """The places of a tree's heap that may split."""
    return max(1, len(feature) // 2)


def turn_tables(trees: Sequence[tuple[np.ndarray, np.ndarray]], n_features: int) -> np.ndarray:
    """Per pair of features and code a word with a bit for every split (feature, cut) that goes right; the trees' bits follow each other."""
    code = np.arange(1 << 2 * BIN_BITS)
    sides = code >> BIN_BITS, code & (1 << BIN_BITS) - 1
    tables = np.zeros((-(-n_features // 2), len(code)), np.uint64)
    for i, (feature, cut) in enumerate(trees):
        for place in np.flatnonzero(feature >= 0).tolist():
            right = sides[feature[place] % 2] > cut[place]
            tables[feature[place] // 2] |= right.astype(np.uint64) << np.uint64(_bits(feature) * i + place)
    return tables


def turned(codes: list[np.ndarray], tables: np.ndarray) -> np.ndarray:
    """The word of each row; a bit of a split that the row does not come by says nothing."""
    word = np.zeros(len(codes[0]), np.uint64)
    for code, table in zip(codes, tables):
        if table.any():
            word |= table.take(code)
    return word


def turns_of(word: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The bits of the i-th tree of a word."""
    return ((word >> np.uint64(bits * i)) & np.uint64((1 << bits) - 1)).astype(np.int64)


@lru_cache(maxsize=64)
def _places(feature: bytes, depth: int) -> np.ndarray:
    """The place that each combination of turns leads to."""
    heap = np.frombuffer(feature, np.int64)
    after, turns = _after(heap), np.arange(1 << _bits(heap))
    place = np.zeros(len(turns), np.int64)
    for _ in range(depth):
        # Places below the last splits have no bit; they are leaves.
        place = after.take(2 * place + (turns >> place & 1))
    return place.astype(np.uint8)


def ends(feature: np.ndarray, depth: int, value: np.ndarray) -> np.ndarray:
    """What `value` has at the place that each combination of turns leads to."""
    return value.take(_places(feature.tobytes(), depth))


class Carried:
    """Finished trees (feature, cut, value) of up to `MASKED` splits, to be added to margins one after the other."""

    def __init__(self, trees: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int, n_features: int):
        self.bits = _bits(trees[0][0]) if trees else 1
        step = 64 // self.bits
        words = [trees[i:i + step] for i in range(0, len(trees), step)]
        self.words = [(turn_tables([t[:2] for t in word], n_features), [ends(f, depth, v) for f, _, v in word]) for word in words]

    def added(self, codes: list[np.ndarray], margin: np.ndarray) -> np.ndarray:
        for tables, values in self.words:
            word = turned(codes, tables)
            for i, value in enumerate(values):
                margin = margin + value.take(turns_of(word, i, self.bits))
        return margin


def binned(x: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    """Per feature the number of its thresholds that each value lies above; none for a value that is not a number."""
    bins = np.stack([np.searchsorted(t, v, "left") for t, v in zip(thresholds, x)]).astype(np.uint8)
    bins[np.isnan(x)] = 0
    return bins


def paired_histograms(
    codes: list[np.ndarray], label: np.ndarray, margin: np.ndarray, slot: np.ndarray | None, slots: int, n_features: int, second_order: bool
) -> np.ndarray:
    """`level_histograms` of boosting for rows of weight one, two features at a time; `slot` is None where there is one.

    The curvature and the count of rows are added up as one number, exact for up to `PACKED` rows.
    """
    p = probability(margin)
    gradient = np.rint((label - p) * SCALE)
    packed = np.rint(p * (1 - p) * SCALE) + float(1 << CURVE_BITS)
    width = 1 << BIN_BITS
    out = np.empty((slots, n_features, width, 4), np.int64)
    first = None if slot is None else slot.astype(np.int64) << 2 * BIN_BITS
    for i, code in enumerate(codes):
        at = code.astype(np.int64) if first is None else first + code
        both = np.stack([np.bincount(at, w, slots * width * width) for w in (gradient, packed)]).reshape(2, slots, width, width)
        for j in range(2 * i, min(2 * i + 2, n_features)):
            found = both.sum(axis=3 - j % 2).astype(np.int64)
            rows, curve = found[1] >> CURVE_BITS, found[1] & (1 << CURVE_BITS) - 1
            out[:, j, :, 0], out[:, j, :, 2], out[:, j, :, 3] = found[0], curve, rows
            out[:, j, :, 1] = curve if second_order else rows * int(SCALE)
    return out


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margin))


def _at(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values of some rows; one value stands for all rows of its block."""
    return values if values.size == 1 else values.take(at)


def statistics(rows: Rows, at: np.ndarray, boosted: bool, second_order: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows `at`, in whole numbers: the sum to be explained, the mass that splits weigh it by, and the one that values do.

    Boosting: gradient, Hessian or weight, Hessian. Forest: weighted label, and twice the weight.
    """
    label, plain = rows.label.take(at), _at(rows.weight, at)
    weight = np.rint(plain * SCALE)
    if not boosted:
        return np.rint(label * plain * SCALE), weight, weight
    p = probability(rows.margin.take(at))
    curve = np.rint(plain * p * (1 - p) * SCALE)
    return np.rint((label - p) * plain * SCALE), curve if second_order else weight, curve


def level_histograms(rows: Rows, level: Level, taken: np.ndarray | None, stats: Callable[[np.ndarray], tuple[np.ndarray, ...]], n_bins: int) -> np.ndarray:
    """Sums of the three statistics and of rows per slot, chosen feature and bin, as whole numbers.

    `taken` is how often each row counts (None: once), `stats` gives the statistics of the rows at the given places.
    """
    slots, per_slot = level.chosen.shape
    slot = level.slot.take(descend(rows.bins, level.feature, level.cut, level.depth))
    at = np.flatnonzero(slot >= 0 if taken is None else (slot >= 0) & (taken > 0))
    slot, n = slot.take(at), slots * n_bins
    times = None if taken is None else taken.take(at)
    if times is not None and (times == 1).all():
        times = None
    weights = tuple(s if times is None or s.size == 1 else s * times for s in stats(at))
    alike, flat = (level.chosen == level.chosen[0]).all(), rows.bins.ravel()
    out = np.zeros((per_slot, n, 4), np.int64)
    first = slot * n_bins
    for j in range(per_slot):
        bins = rows.bins[level.chosen[0, j]].take(at) if alike else flat.take(level.chosen[:, j].take(slot) * rows.bins.shape[1] + at)
        code = first + bins
        counts = np.bincount(code, times, n)
        done: dict[int, np.ndarray] = {}
        for k, w in enumerate(weights):
            if id(w) not in done:
                done[id(w)] = counts * w if w.size == 1 else np.bincount(code, w, n)
            out[j, :, k] = done[id(w)]
        out[j, :, 3] = counts
    return out.reshape(per_slot, slots, n_bins, 4).transpose(1, 0, 2, 3)


def best_splits(sums: np.ndarray, penalty: float, least_rows: int, least_mass: float) -> np.ndarray:
    """Per slot: chosen feature's position, last bin to the left, gain, and the four sums of the left side and of all.

    `sums` is (slot, feature, bin, (three statistics, rows)). The position is -1 where no split is allowed or
    none gains. The first of equal gains is taken.
    """
    left = np.cumsum(sums, axis=2)
    whole = left[:, :1, -1:, :]
    right = whole - left
    l, r, w = (x[..., :2] / SCALE for x in (left, right, whole))
    allowed = (left[..., 3] >= least_rows) & (right[..., 3] >= least_rows) & (l[..., 1] >= least_mass) & (r[..., 1] >= least_mass)
    allowed &= (left[..., 1] > 0) & (right[..., 1] > 0)

    def score(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / np.maximum(x[..., 1] + penalty, 1e-300)

    gain = np.where(allowed, score(l) + score(r) - score(w), -np.inf)
    n_slots, _, n_bins = gain.shape
    flat = gain.reshape(n_slots, -1)
    at = flat.argmax(axis=1)
    every = np.arange(n_slots)
    best = flat[every, at]
    position, cut = at // n_bins, at % n_bins
    found = np.where(best > 1e-12, position, -1)
    return np.column_stack([found, cut, np.where(found >= 0, best, 0.0), left[every, position, cut], whole[:, 0, 0]])
