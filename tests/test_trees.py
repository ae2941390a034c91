from dataclasses import replace
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.functions import histograms as hist
from patronlens.operators import evaluation, trees
from patronlens.operators.trees import Recipe, TreeEnsemble
from patronlens.workspace import materialize, new_path, ship_package

FEATURES = ["a", "b", "c", "d"]


def table(spark, n, seed=1):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(0, 1, n), draw.integers(-5, 6, n), draw.exponential(100, n), draw.integers(0, 2, n)]).astype(float)
    score = x[:, 0] + (x[:, 1] > 2) - 0.01 * x[:, 2] + x[:, 0] * x[:, 3]
    y = (score + draw.normal(0, 0.7, n) > 0).astype(int)
    rows = [(i, *map(float, r), int(t), float(1 + t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double, label int, w double")
    return x, y, materialize(df.repartition(3), "test_trees")


@pytest.fixture(scope="module")
def small(spark):
    return table(spark, 500)


RECIPES = {
    "second": Recipe(trees=6, depth=3, second_order=True, rate=0.3, share=0.8, columns=0.75, penalty=1.0, least_mass=1.0),
    "first": Recipe(trees=6, depth=3, rate=0.3, share=0.8),
    "forest": Recipe(trees=8, depth=4, boosted=False, share=None, node_features=2, least_rows=5),
}


def same(one: TreeEnsemble, other: TreeEnsemble) -> bool:
    return all((getattr(one, a) == getattr(other, a)).all() for a in ("feature", "threshold", "value", "gain")) and one.base == other.base


@pytest.mark.parametrize("kind", list(RECIPES))
def test_same_trees_from_any_partitions_and_merge(small, kind, monkeypatch):
    _, _, df = small
    recipe = replace(RECIPES[kind], trees=3)
    fits = [trees.fit(df.repartition(n), FEATURES, ["id"], recipe, weight="w") for n in (1, 8, 64)]
    assert same(fits[0], fits[1]) and same(fits[0], fits[2])
    monkeypatch.setattr(trees, "DIRECT", 1)
    monkeypatch.setattr(trees, "SPAN", 2)
    monkeypatch.setattr(trees, "TOGETHER", 20_000)
    monkeypatch.setattr(trees, "MERGED", 1000)
    assert same(fits[0], trees.fit(df.repartition(5), FEATURES, ["id"], recipe, weight="w"))


def plain_boosting(x, y, w, ids, recipe, edges, base):
    """The same trees by recursion over the rows, in floating point, with every cut tried."""
    margin = np.full(len(y), base)
    for t in range(recipe.trees):
        draw = np.random.default_rng((recipe.seed, t))
        columns = np.sort(draw.permutation(x.shape[1])[:max(1, round(recipe.columns * x.shape[1]))])
        taken = hist.uniform(ids, t, recipe.seed) < recipe.share
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (y - p), w * p * (1 - p)
        mass = h if recipe.second_order else w

        def grow(rows, level):
            inside = rows & taken
            leaf = recipe.rate * g[inside].sum() / (h[inside].sum() + recipe.penalty)
            best = None
            if level < recipe.depth:
                whole = g[inside].sum() ** 2 / (mass[inside].sum() + recipe.penalty)
                for f in columns:
                    for e in edges[f]:
                        left, right = inside & (x[:, f] <= e), inside & (x[:, f] > e)
                        if not left.any() or not right.any() or min(mass[left].sum(), mass[right].sum()) < recipe.least_mass:
                            continue
                        gain = sum(g[s].sum() ** 2 / (mass[s].sum() + recipe.penalty) for s in (left, right)) - whole
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, e)
            if best is None:
                margin[rows] += leaf
                return
            _, f, e = best
            grow(rows & (x[:, f] <= e), level + 1)
            grow(rows & (x[:, f] > e), level + 1)

        grow(np.ones(len(y), bool), 0)
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("kind", ["second", "first"])
def test_boosting_against_a_plain_loop(small, kind):
    x, y, df = small
    model = trees.fit(df, FEATURES, ["id"], RECIPES[kind], weight="w")
    rows = df.selectExpr("id", "xxhash64(id) as h").orderBy("id").collect()
    ids = np.array([r["h"] for r in rows], np.int64)
    want = plain_boosting(x, y, 1.0 + y, ids, RECIPES[kind], trees.bin_edges(df, FEATURES), model.base)
    assert np.abs(model.raw(x.T) - want).max() < 1e-5
    scored = {r["id"]: r["p"] for r in df.select("id", model.probability().alias("p")).collect()}
    assert np.abs(np.array([scored[i] for i in range(len(y))]) - want).max() < 1e-5


def test_edges_are_the_values_at_their_ranks(spark):
    draw = np.random.default_rng(4)
    values = np.concatenate([draw.normal(0, 1e6, 3000), [0.0, -0.0, 1e-300, -5.5] * 50, np.full(1500, 7.25)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    edges = trees.bin_edges(df, ["v"], 32)[0]
    ranks = np.sort(values)[[-(-len(values) * i // 32) - 1 for i in range(1, 32)]]
    # An edge is the upper end of the 32-bit prefix of the value at a rank.
    assert len(edges) <= 31 and (np.diff(edges) > 0).all()
    for v in ranks:
        assert np.isclose(edges, v, rtol=1e-6, atol=1e-290).any()
    assert np.isclose(edges, 7.25, rtol=1e-6).any()


def test_a_poisson_bootstrap_has_mean_one():
    times = hist.multiplicity(np.arange(100_000, dtype=np.int64), 3, 42, None)
    assert abs(times.mean() - 1) < 0.02 and abs(times.var() - 1) < 0.03 and abs((times == 0).mean() - np.exp(-1)) < 0.01


@pytest.mark.parametrize("kind", list(RECIPES))
def test_a_signal_is_found_and_a_model_comes_back(spark, kind):
    _, _, df = table(spark, 3000, 7)
    model = trees.fit(df.where("id % 4 <> 0"), FEATURES, ["id"], replace(RECIPES[kind], trees=25))
    test = df.where("id % 4 = 0")
    scored = materialize(test.select("id", "label", model.probability().alias("score")), "test_tree_scores")
    assert evaluation.roc_auc(scored).first()[0] > 0.85
    assert model.importances.sum() == pytest.approx(1.0) and model.importances.argmin() != 0
    path = new_path(spark, "test_trees")
    model.save(path)
    back = TreeEnsemble.load(path)
    assert same(model, back) and trees.stored_ensemble(path) and back.features == FEATURES and back.depth == model.depth


def test_one_class_and_constant_features(spark):
    df = materialize(spark.createDataFrame([(i, 1.0, 2.0, 3.0, 4.0, 1, 1.0) for i in range(50)], "id int, a double, b double, c double, d double, label int, w double"), "test_const")
    for recipe in RECIPES.values():
        model = trees.fit(df, FEATURES, ["id"], recipe)
        assert (model.feature == -1).all() and model.total_nodes == recipe.trees


def test_rows_of_one_file_are_dealt_over_the_cores(spark):
    ship_package(spark)
    one = spark.range(40_000).select("id", *[F.rand(j).alias(f) for j, f in enumerate(FEATURES)], (F.col("id") % 2).alias("label")).coalesce(1)
    blocks = trees._blocks(one, ["id"], "label", None, FEATURES, [np.array([0.5])] * 4, 0.0, 40_000)
    sizes = blocks.mapPartitions(lambda part: [sum(len(b.ids) for b in part)]).collect()
    assert sum(sizes) == 40_000 and len(sizes) > 4 and max(sizes) < 8_000


def test_a_pass_sees_the_smaller_child_of_each_split_only(small, monkeypatch):
    _, _, df = small
    asked = []
    sums = trees._Grower.sums
    monkeypatch.setattr(trees._Grower, "sums", lambda self, levels: asked.append(len(levels[0].chosen)) or sums(self, levels))
    model = trees.fit(df, FEATURES, ["id"], replace(RECIPES["first"], trees=1), weight="w")
    splits = [int((model.feature[0, 2**d - 1:2 ** (d + 1) - 1] >= 0).sum()) for d in range(2)]
    assert asked == [1, *splits]


def test_blocks_are_written_anew_after_several_trees_only(small, monkeypatch):
    _, _, df = small
    kept, keep = [], trees._Grower._kept
    monkeypatch.setattr(trees._Grower, "_kept", lambda self, blocks, checkpoint: kept.append(checkpoint) or keep(self, blocks, checkpoint))
    model = trees.fit(df, FEATURES, ["id"], replace(RECIPES["first"], trees=12), weight="w")
    assert kept == [True, False]
    monkeypatch.setattr(trees, "CARRIED", 1)
    assert same(model, trees.fit(df, FEATURES, ["id"], replace(RECIPES["first"], trees=12), weight="w"))


def test_shallow_trees_are_walked_as_deep_ones_are(monkeypatch):
    draw = np.random.default_rng(5)
    for depth in range(6):
        size = 2 ** (depth + 1) - 1
        feature, x, cut = np.full(size, -1), draw.normal(size=(4, 200)), draw.normal(size=size)
        x[draw.random(x.shape) < 0.05] = np.nan
        for place in range(2**depth - 1):
            if place == 0 or feature[(place - 1) // 2] >= 0:
                feature[place] = draw.integers(0, 4) if draw.random() < 0.8 else -1
        value = draw.normal(size=size)
        monkeypatch.setattr(hist, "SHALLOW", 5)
        places, values = hist.descend(x, feature, cut, depth), hist.reached_values(x, feature, cut, value, depth)
        monkeypatch.setattr(hist, "SHALLOW", -1)
        assert (places == hist.descend(x, feature, cut, depth)).all() and (values == value[places]).all()


def test_two_features_at_a_time_grow_the_same_trees(small, monkeypatch):
    """Carried trees, all kinds of levels, odd numbers of features and several blocks; without keys in the blocks."""
    _, _, df = small
    monkeypatch.setattr(trees, "QUICK_BLOCK", 90)
    for features, recipe in ((FEATURES, Recipe(trees=14, depth=4)), (FEATURES[:3], Recipe(trees=7, depth=2, second_order=True, bins=20))):
        assert recipe.quick
        found = trees.fit(df.repartition(3), features, ["id"], recipe)
        monkeypatch.setattr(hist, "MASKED", 0)
        assert not recipe.quick
        plain = trees.fit(df.repartition(3), features, ["id"], recipe)
        monkeypatch.undo()
        monkeypatch.setattr(trees, "QUICK_BLOCK", 90)
        assert same(found, plain)


def test_histograms_of_two_features_are_those_of_one(spark):
    draw = np.random.default_rng(8)
    bins = draw.integers(0, 64, (5, 3000)).astype(np.uint8)
    rows = hist.Rows(np.arange(3000), bins, draw.integers(0, 2, 3000).astype(np.int8), np.ones(1), draw.normal(0, 9, 3000))
    level = hist.Level(0, np.array([1, -1, 4, -1, -1, -1, -1]), np.array([30, 0, 12, 0, 0, 0, 0]), 2, np.array([-1, 0, -1, -1, -1, 1, -1]), np.tile(np.arange(5), (2, 1)))
    for second_order in (False, True):
        plain = hist.level_histograms(rows, level, None, partial(hist.statistics, rows, boosted=True, second_order=second_order), 64)
        found = np.zeros_like(plain)
        trees._quick_sums(iter([rows]), [level], [], Recipe(trees=1, depth=2, second_order=second_order), [found])
        assert (found == plain).all() and plain[..., 3].sum() > 0


def test_scores_over_bins_are_those_over_values(spark, monkeypatch):
    draw = np.random.default_rng(6)
    x = draw.choice([-1.5, 0.0, 2.0, 2.5, 7.0, np.nan, np.inf, -np.inf, 3.25], (3, 400))
    for depth in (1, 3, 4):
        shape = (11, 2 ** (depth + 1) - 1)
        feature = np.where(draw.random(shape) < 0.8, draw.integers(0, 3, shape), -1)
        feature[:, 2**depth - 1:] = -1
        model = TreeEnsemble(["a", "b", "c"], True, 0.3, depth, feature, draw.choice([-1.5, 0.0, 2.0, 3.25], shape), draw.normal(size=shape), np.zeros(shape))
        assert model._binned() is not None
        df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x.T)], "id int, a double, b double, c double")
        found = {r["id"]: r["p"] for r in df.select("id", model.probability().alias("p")).collect()}
        assert [found[i] for i in range(400)] == model.raw(x).tolist()
    monkeypatch.setattr(hist, "MASKED", 0)
    assert model._binned() is None
