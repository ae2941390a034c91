import hashlib
import random
from collections import Counter
from decimal import Decimal
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from patronlens.operators import affinity, recommend
from patronlens.plans import stages
from patronlens.plans.queries import QUERIES
from patronlens.sources import views
from patronlens.workspace import materialize

PRODUCTS = [(f"P{i:02d}", f"N{(i * 5) % 12:02d}", "ABC"[i % 3], Decimal(10 + 7 * i % 40)) for i in range(12)]


@pytest.fixture(scope="module")
def sales_rows():
    rng = random.Random(3)
    rows = []
    for c in range(40):
        # One customer has everything, one a third of all lines.
        picks = PRODUCTS if c == 0 else rng.choices(PRODUCTS[:9], k=200 if c == 1 else rng.randint(1, 6))
        for n, (pid, name, category, price) in enumerate(picks):
            rows.append((f"C{c:02d}", f"O{c}-{n}", pid, name, category, price, Decimal(rng.randint(1, 90)), "2024-01-01"))
    return rows


@pytest.fixture(scope="module")
def sales(spark, sales_rows):
    schema = (
        "customer_id string, order_id string, product_id string, product_name string, category string, "
        "unit_price decimal(12,2), revenue decimal(18,2), day string"
    )
    df = spark.createDataFrame(sales_rows, schema).withColumn("order_date", F.to_date("day")).drop("day")
    return materialize(df, "test_sales")


@pytest.fixture(scope="module")
def customers(spark):
    rows = [(f"C{c:02d}", 5.0 * c, c % 7, 3 + c % 13) for c in range(42)]
    df = spark.createDataFrame(rows, "customer_id string, avg_order_value double, frequency bigint, RFM_total int")
    return materialize(df, "test_customers")


@pytest.fixture(scope="module")
def baskets(sales_rows):
    found = {}
    for row in sales_rows:
        found.setdefault(row[0], set()).add(row[2])
    return found


def shares(sales_rows):
    spent = Counter()
    for row in sales_rows:
        spent[row[0], row[4]] += row[6]
    totals = Counter()
    for (customer, _), amount in spent.items():
        totals[customer] += amount
    return {key: float(amount) / float(totals[key[0]]) for key, amount in spent.items()}


def test_cooccurrence_with_and_without_tiles(sales, sales_rows):
    baskets = {}
    for row in sales_rows:
        baskets.setdefault(row[0], set()).add(row[3])
    expected = Counter(pair for names in baskets.values() for pair in permutations(names, 2))
    for tile in (2, 5, 2048):
        got = {(r["a"], r["b"]): r["n"] for r in affinity.item_cooccurrence(sales, tile=tile).collect()}
        assert got == dict(expected)


def test_top_co_purchased_ties_by_name(spark):
    pairs = [("x", "b", 2), ("x", "a", 2), ("x", "c", 9), ("x", "d", 1), ("y", "x", 1)]
    top = affinity.top_co_purchased(spark.createDataFrame(pairs, "a string, b string, n bigint"), 2)
    assert sorted(tuple(r) for r in top.collect()) == [("x", "a", 2), ("x", "c", 9), ("y", "x", 1)]


def test_affinity_covers_every_category_and_sums_to_one(sales, sales_rows):
    got = {(r[0], r[1]): r[2] for r in affinity.category_affinity(sales).collect()}
    expected = shares(sales_rows)
    assert len(got) == 40 * 3
    for key, share in got.items():
        assert share == pytest.approx(expected.get(key, 0.0))


def test_affinity_of_a_customer_who_spent_nothing(spark):
    df = spark.createDataFrame([("a", "x", Decimal(0)), ("b", "x", Decimal(5))], "customer_id string, category string, revenue decimal(18,2)")
    got = {r["customer_id"]: r["category_affinity"] for r in affinity.category_affinity(df).collect()}
    assert got == {"a": 0.0, "b": 1.0}


def test_pivot_fills_missing_cells(sales):
    rows = affinity.category_pivot(sales).collect()
    assert len(rows) == 40 and all(r[c] is not None for r in rows for c in "ABC")


def test_best_by_affinity_is_the_brute_force_best(sales, customers, sales_rows, baskets):
    known = shares(sales_rows)
    aov = {r["customer_id"]: r["avg_order_value"] for r in customers.collect()}
    expected = {}
    for customer, value in aov.items():
        options = [
            (-known.get((customer, category), 0.0), abs(float(price) - value), name)
            for pid, name, category, price in PRODUCTS
            if pid not in baskets.get(customer, set())
        ]
        expected[customer] = min(options)[2] if options else "None"
    got = recommend.recommend_by_affinity(customers, sales).collect()
    assert {r["customer_id"]: r["recommended_product"] for r in got} == expected
    assert expected["C00"] == "None"


def test_training_pairs(sales, baskets):
    rows = recommend.training_pairs(sales, seed=7).collect()
    bought, drawn = {}, {}
    for r in rows:
        (bought if r["label"] else drawn).setdefault(r["customer_id"], []).append(r["product_id"])
    every = {p[0] for p in PRODUCTS}
    for customer, basket in baskets.items():
        assert sorted(bought[customer]) == sorted(basket)
        said = hashlib.md5(f"{customer}|7".encode()).hexdigest()
        start, stride = int(said[:15], 16) % 13, int(said[15:30], 16) % 12 + 1
        by_name = [p[0] for p in sorted(PRODUCTS, key=lambda p: p[1])]
        walk = [by_name[k] for j in range(13) if (k := (start + j * stride) % 13) < 12]
        assert sorted(drawn.get(customer, [])) == sorted([p for p in walk if p not in basket][: len(basket)])
    assert every == set(by_name)


def test_unpurchased_summary(sales, customers, baskets):
    prices = {p[0]: p[3] for p in PRODUCTS}
    names = {p[0]: p[1] for p in PRODUCTS}
    got = {r["customer_id"]: r for r in recommend.unpurchased_summary(customers, sales).collect()}
    assert len(got) == 42
    for customer, row in got.items():
        left = set(prices) - baskets.get(customer, set())
        assert row["n_candidates"] == len(left) and row["candidate_value"] == sum(prices[p] for p in left)
        assert row["first_candidate"] == min((names[p] for p in left), default=None)
        assert row["last_candidate"] == max((names[p] for p in left), default=None)


def test_counts_agree(sales, customers, baskets):
    counts = {r["customer_id"]: r for r in recommend.candidate_counts(customers, sales).collect()}
    assert counts["C00"]["n_candidates"] == 0 and counts["C41"]["n_candidates"] == 12
    never = {r["product_id"]: r for r in recommend.never_bought(customers, sales).collect()}
    for pid in (p[0] for p in PRODUCTS):
        buyers = sum(pid in basket for basket in baskets.values())
        assert (never[pid]["n_buyers"], never[pid]["n_never_bought"]) == (buyers, 42 - buyers)


def test_first_line_gives_the_product_its_price(spark):
    rows = [("P", "2024-01-02", "O1", "n", "k", 5), ("P", "2024-01-01", "O9", "n", "k", 9), ("P", "2024-01-01", "O8", "m", "k", 7)]
    df = spark.createDataFrame(rows, "product_id string, d string, order_id string, product_name string, category string, unit_price int")
    got = affinity.product_dimension(df.withColumn("order_date", F.to_date("d"))).collect()
    assert [tuple(r) for r in got] == [("P", "m", "k", 7)]


@pytest.fixture(scope="module")
def ranker(sales, customers):
    pairs = materialize(recommend.reco_features(sales, customers), "test_pairs")
    return recommend.fit_ranker(pairs, rounds=4, depth=2)


@pytest.mark.parametrize("shelf", [10_000, 5])
def test_model_recommendation_is_the_brute_force_best(spark, monkeypatch, sales, customers, sales_rows, baskets, ranker, shelf):
    monkeypatch.setattr(recommend, "SHELF", shelf)
    known = shares(sales_rows)
    rows = []
    for r in customers.collect():
        for pid, name, category, price in PRODUCTS:
            if pid not in baskets.get(r["customer_id"], set()):
                share = known.get((r["customer_id"], category), 0.0)
                gap = abs(float(price) - r["avg_order_value"])
                rows.append((r["customer_id"], name, share, r["avg_order_value"], float(r["frequency"]), float(r["RFM_total"]), float(price), gap))
    schema = "customer_id string, name string, " + ", ".join(f"{c} double" for c in recommend.RANKER_FEATURES)
    best = {}
    for r in recommend.score_pairs(ranker, spark.createDataFrame(rows, schema)).collect():
        candidate = (-round(r["score"], 12), r["name"])
        best[r["customer_id"]] = min(best.get(r["customer_id"], candidate), candidate)
    got = recommend.recommend(customers, sales, ranker).collect()
    assert len(got) == 42
    for r in got:
        score, name = best.get(r["customer_id"], (0.0, "None"))
        assert r["recommended_product"] == name
        assert r["recommendation_score"] == pytest.approx(-score, abs=6e-5)


def test_the_first_of_the_top_three_is_the_best(customers, sales, baskets, ranker):
    one = {r["customer_id"]: r["recommended_product"] for r in recommend.recommend(customers, sales, ranker).collect()}
    three = {}
    for r in recommend.recommend(customers, sales, ranker, top_n=3).collect():
        three.setdefault(r["customer_id"], {})[r["rank"]] = (r["recommended_product"], r["recommendation_score"])
    assert {c: t[1][0] for c, t in three.items()} == one
    for customer, ranked in three.items():
        left = 12 - len(baskets.get(customer, ()))
        assert sorted(ranked) == list(range(1, max(1, min(3, left)) + 1))
        scores = [ranked[k][1] for k in sorted(ranked)]
        assert scores == sorted(scores, reverse=True)


def test_a_catalogue_of_its_own(spark, sales, customers):
    own = spark.createDataFrame(
        [("P01", "b", "A", Decimal(3)), ("X", "a", "Z", Decimal(4)), ("Y", "a", None, None)],
        "product_id string, product_name string, category string, unit_price decimal(12,2)",
    )
    counts = {r["customer_id"]: r["n_candidates"] for r in recommend.candidate_counts(customers, sales, own).collect()}
    found = {r["customer_id"]: r for r in recommend.unpurchased_summary(customers, sales, own).collect()}
    assert counts == {c: r["n_candidates"] for c, r in found.items()}
    assert set(counts.values()) == {2, 3}
    assert {r["recommended_product"] for r in recommend.recommend_by_affinity(customers, sales, own).collect()} <= {"a", "b"}


def test_nearest_unseen_price_with_ties_and_gaps(spark):
    rng = random.Random(11)
    goods = [(f"P{i:03d}", f"N{rng.randrange(40):02d}-{i}", rng.choice("ABC"), rng.choice([None, *range(20)])) for i in range(60)]
    lines, want = [], {}
    for c in range(30):
        want[f"C{c}"] = rng.choice([None, 0.0, 3.5, 7.0, 10.25, 50.0])
        kinds = rng.choice(["", "A", "AB", "ABC"])
        for pid, name, category, price in goods:
            if category in kinds and (c % 3 == 0 or rng.random() < 0.6):
                lines.append((f"C{c}", "O", pid, category, Decimal(rng.choice([0, 1, 1, 5]))))
    schema = "product_id string, product_name string, category string, unit_price int"
    sales = spark.createDataFrame(lines, "customer_id string, order_id string, product_id string, category string, revenue decimal(18,2)")
    people = spark.createDataFrame(list(want.items()), "customer_id string, avg_order_value double")
    spent = Counter()
    for c, _, _, category, money in lines:
        spent[c, category] += money
    expected = {}
    for c, value in want.items():
        seen = {line[2] for line in lines if line[0] == c}
        options = [
            (-spent[c, k], 0.0 if price is None or value is None else abs(price - value), name)
            for pid, name, k, price in goods if pid not in seen
        ]
        expected[c] = min(options)[2] if options else "None"
    got = recommend.recommend_by_affinity(people, sales, spark.createDataFrame(goods, schema)).collect()
    assert {r["customer_id"]: r["recommended_product"] for r in got} == expected


def test_work_follows_the_baskets_in_a_large_catalogue(spark, customers, sales):
    n = 30_000
    own = spark.range(n).selectExpr(
        "concat('P', if(id < 10, '0', ''), id) product_id", "concat('N', lpad(id, 6, '0')) product_name",
        "cast(id % 50 as string) category", "cast(id % 997 as decimal(12,2)) unit_price",
    )
    own = materialize(own, "own")
    found = recommend.unpurchased_summary(customers, sales, own).collect()
    assert {r["n_candidates"] for r in found} <= set(range(n - 12, n + 1))
    pairs = recommend.training_pairs(sales, own)
    sizes = {r["label"]: r["count"] for r in pairs.groupBy("label").count().collect()}
    assert sizes[0] == sizes[1]
    assert recommend.recommend_by_affinity(customers, sales, own).where("recommended_product = 'None'").count() == 0


def test_affinity_of_many_categories(spark):
    rows = spark.range(10_001).selectExpr("'c' customer_id", "cast(id as string) category", "cast(1 as decimal(18,2)) revenue")
    got = affinity.category_affinity(rows)
    assert got.count() == 10_001 and got.agg(F.sum("category_affinity")).first()[0] == pytest.approx(1.0)


def test_no_step_of_the_draw_is_shuffled(sales):
    plan = recommend.training_pairs(sales)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "row_number" not in plan


def test_order_lines_are_joined_once_for_all_recommendations(spark, sf_dir, monkeypatch):
    joined, view = [], views.sales
    monkeypatch.setattr(stages, "_tables", {})
    people = stages.customer_table(spark, sf_dir)
    monkeypatch.setattr(views, "sales", lambda *args: joined.append(args) or view(*args))
    for name in ("negative_samples", "recommend_by_affinity", "dim_products"):
        assert QUERIES[name](spark, sf_dir).count() > 0
    assert stages.reco_split(spark, sf_dir).count() > 0 and len(joined) == 1
    got = recommend.recommend_by_affinity(people, view(spark, sf_dir))
    assert got.exceptAll(QUERIES["recommend_by_affinity"](spark, sf_dir)).count() == 0
