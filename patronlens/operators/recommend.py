"""Next-product recommendation: sampling, features, ranking model and the best products.

The candidates of a customer are the catalogue minus the basket. What can be told from the basket
alone is: counts and sums are totals minus the basket's, the first candidate is the first gap in
the basket's ranks, the nearest prices lie within the basket's size on both sides, and random candidates
come from a walk over the catalogue that is as long as the basket and the draw. Only the ranking
model looks at every candidate, because a score is asked for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronlens.operators.affinity import category_shares, product_dimension
from patronlens.operators.ranking import global_rank, running_totals
from patronlens.operators import trees
from patronlens.operators.sampling import stratified_split
from patronlens.operators.trees import Recipe, TreeEnsemble
from patronlens.workspace import materialize

# Products that one row carries while candidates are scored; larger catalogues take several rows a customer.
SHELF = 10_000
# Equal scores up to this many digits are ties.
SCORE_DIGITS = 12

# The ranker's inputs.
CUSTOMER_FEATURES = ["avg_order_value", "frequency", "RFM_total"]
RANKER_FEATURES = [
    "category_affinity", "avg_order_value", "frequency", "RFM_total",
    "unit_price", "price_diff_from_avg_order",
]


# The two settings of the ranker.
RANKERS = {
    "ranker": {"rounds": 150, "depth": 3, "rate": 0.1},
    "ranker_deep": {"rounds": 200, "depth": 4, "rate": 0.1},
}


def buyers(sales: DataFrame) -> DataFrame:
    return sales.select("customer_id").dropna().distinct()


def condensed(sales: DataFrame) -> DataFrame:
    """Spend per customer, product and category.

    Baskets, buyers and category shares come out of it as they would out of the lines.
    """
    keys = ["customer_id", "product_id", "category"]
    spent = sales.where(F.col("customer_id").isNotNull()).groupBy(*keys)
    return spent.agg(F.sum("revenue").alias("revenue"))


def condense(sales: DataFrame) -> DataFrame:
    """The condensed lines, written once."""
    return materialize(condensed(sales), "condensed")


def _catalogue(sales: DataFrame, products: DataFrame | None) -> DataFrame:
    """The products with `_rank`, their place by name."""
    found = product_dimension(sales) if products is None else products
    named = materialize(found.select("product_id", "product_name", "category", "unit_price"), "products")
    return materialize(global_rank(named, [("product_name", True), ("product_id", True)], "_rank"), "catalogue")


def _baskets(bought: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Distinct products of the catalogue that each customer bought."""
    pairs = bought.select("customer_id", "product_id").dropna().distinct()
    return pairs.join(catalogue, "product_id")


def candidate_counts(
    customers: DataFrame, sales: DataFrame, products: DataFrame | None = None
) -> DataFrame:
    """Catalogue size, number of its products in the basket, and of candidates per customer."""
    products = product_dimension(sales) if products is None else products
    baskets = sales.select("customer_id", "product_id").dropna().distinct()
    known = baskets.join(products.select("product_id"), "product_id", "left_semi")
    sizes = known.groupBy("customer_id").agg(F.count("*").alias("_n"))
    counted = customers.select("customer_id").join(sizes, "customer_id", "left")
    n_products = products.agg(F.count("*").alias("n")).scalar()
    n_bought = F.coalesce(F.col("_n"), F.lit(0))
    return counted.select(
        "customer_id",
        n_products.alias("n_products"),
        n_bought.alias("n_bought"),
        (n_products - n_bought).alias("n_candidates"),
    )


def never_bought(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Per product the number of customers that bought it and that never did."""
    known = customers.select("customer_id").distinct()
    n_customers = known.agg(F.count("*").alias("n")).scalar()
    pairs = sales.select("customer_id", "product_id").dropna().distinct()
    bought = pairs.join(known, "customer_id", "left_semi").groupBy("product_id").agg(
        F.count("*").alias("_n")
    )
    every = sales.select("product_id").dropna().distinct().join(bought, "product_id", "left")
    n_buyers = F.coalesce(F.col("_n"), F.lit(0))
    return every.select(
        "product_id", n_buyers.alias("n_buyers"), (n_customers - n_buyers).alias("n_never_bought")
    )


def unpurchased_summary(customers: DataFrame, sales: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Per customer the unpurchased products: how many, first and last name, sum of prices.

    A basket whose i-th product has rank i holds the first i of the catalogue, so the products
    for which that is so are the run before the first gap; from the other end likewise.
    """
    catalogue = _catalogue(sales, products)
    price = F.col("unit_price").cast("decimal(28,2)")
    whole = catalogue.agg(F.count("*").alias("n"), F.sum(price).alias("value")).first()
    n_products = F.lit(whole["n"]).cast("bigint")
    basket = _baskets(sales, catalogue).select("customer_id", "_rank", price.alias("_price"))
    up = F.row_number().over(Window.partitionBy("customer_id").orderBy("_rank"))
    down = F.row_number().over(Window.partitionBy("customer_id").orderBy(F.col("_rank").desc()))
    run = basket.withColumns({"_up": up, "_down": down}).groupBy("customer_id").agg(
        F.count("*").alias("_n"),
        F.sum("_price").alias("_spent"),
        F.sum((F.col("_rank") == F.col("_up")).cast("bigint")).alias("_head"),
        F.sum((n_products + 1 - F.col("_rank") == F.col("_down")).cast("bigint")).alias("_tail"),
    )
    per_customer = customers.select("customer_id").join(run, "customer_id", "left")
    left = n_products - F.coalesce("_n", F.lit(0))
    none = F.lit(None).cast("bigint")
    gaps = per_customer.select(
        "customer_id",
        left.alias("n_candidates"),
        F.when(left > 0, F.coalesce("_head", F.lit(0)) + 1).otherwise(none).alias("_first"),
        F.when(left > 0, n_products - F.coalesce("_tail", F.lit(0))).otherwise(none).alias("_last"),
        (F.lit(whole["value"] or 0).cast("decimal(28,2)") - F.coalesce("_spent", F.lit(0))).cast("decimal(28,2)").alias("candidate_value"),
    )
    first = catalogue.select(F.col("_rank").alias("_first"), F.col("product_name").alias("first_candidate"))
    last = catalogue.select(F.col("_rank").alias("_last"), F.col("product_name").alias("last_candidate"))
    named = gaps.join(first, "_first", "left").join(last, "_last", "left")
    return named.select("customer_id", "n_candidates", "first_candidate", "last_candidate", "candidate_value")


def _prime_from(n: int) -> int:
    """The smallest prime not below n (and not below 2)."""
    p = max(2, n)
    while any(p % d == 0 for d in range(2, int(p**0.5) + 1)):
        p += 1
    return p


def _drawn(basket: DataFrame, catalogue: DataFrame, seed: int) -> DataFrame:
    """For each customer as many unseen products as the basket has, or all there are.

    The walk start + j * stride modulo a prime visits every rank once; both come from
    md5(customer|seed). As many steps as basket, draw and the ranks beyond the catalogue hold
    enough unseen products. A customer's walk and basket are two arrays of one row, so no step is shuffled.
    """
    n = catalogue.count()
    prime = _prime_from(n)
    said = F.md5(F.concat_ws("|", F.col("customer_id").cast("string"), F.lit(str(seed))))

    def number(start: int) -> Column:
        return F.conv(F.substring(said, start, 15), 16, 10).cast("bigint")

    held = basket.groupBy("customer_id").agg(F.count("*").alias("_n"), F.collect_list("_rank").alias("_seen"))
    steps = F.least(F.lit(prime).cast("bigint"), F.col("_n") * 2 + F.lit(prime - n))
    walks = held.select("customer_id", "_n", "_seen", steps.alias("_steps"), (number(1) % prime).alias("_start"), (number(16) % (prime - 1) + 1).alias("_stride"))
    ranks = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("_steps") - 1), lambda j: (F.col("_start") + j * F.col("_stride")) % prime + 1)
    unseen = F.array_except(F.filter(ranks, lambda r: r <= n), "_seen")
    kept = walks.select("customer_id", F.explode(F.slice(unseen, F.lit(1), F.col("_n").cast("int"))).alias("_rank"))
    return kept.join(catalogue, "_rank")


def training_pairs(
    sales: DataFrame,
    products: DataFrame | None = None,
    seed: int = 42,
    features: DataFrame | None = None,
    bought: DataFrame | None = None,
) -> DataFrame:
    """Bought products (label 1) and as many unseen ones (label 0) per buyer.

    A buyer who has seen most of the catalogue gets all that is left. With `features`
    (customer_id and the three customer columns) every pair carries the ranker's features.
    `bought` are the condensed sales, if they are written already.
    """
    bought = condense(sales) if bought is None else bought
    catalogue = _catalogue(sales, products)
    basket = materialize(_baskets(bought, catalogue), "baskets")
    columns = ["customer_id", "product_id", "product_name", "category", "unit_price", "label"]
    pairs = basket.withColumn("label", F.lit(1)).select(*columns).unionByName(
        _drawn(basket, catalogue, seed).withColumn("label", F.lit(0)).select(*columns)
    )
    if features is None:
        return pairs.select("customer_id", "product_id", "label")
    people = features.select("customer_id", *CUSTOMER_FEATURES)
    described = pairs.join(people, "customer_id", "left").join(category_shares(bought), "customer_id", "left")
    return _described(described.withColumn("category_affinity", F.col("shares")[F.col("category")]).drop("shares"))


def _described(pairs: DataFrame) -> DataFrame:
    """Pairs with the customer's affinity to the category and the price distance, nulls as zero."""
    distance = F.abs(F.col("unit_price").cast("double") - F.col("avg_order_value"))
    return pairs.withColumns({
        "category_affinity": F.coalesce("category_affinity", F.lit(0.0)),
        "price_diff_from_avg_order": F.coalesce(distance, F.lit(0.0)),
        "unit_price": F.coalesce(F.col("unit_price").cast("double"), F.lit(0.0)),
    })


def _numeric(df: DataFrame) -> DataFrame:
    """Ranker features as doubles, nulls as zero."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in RANKER_FEATURES}
    )


def reco_features(
    sales: DataFrame, customers: DataFrame, products: DataFrame | None = None, seed: int = 42, bought: DataFrame | None = None
) -> DataFrame:
    """Training pairs with the six features of the ranker."""
    pairs = _numeric(training_pairs(sales, products, seed, customers, bought))
    return pairs.select("customer_id", "product_id", "label", *RANKER_FEATURES)


def pair_split(pairs: DataFrame, test: float = 0.2, seed: int = 42) -> DataFrame:
    return stratified_split(pairs, "label", ["customer_id", "product_id"], test, seed)


def fit_ranker(pairs: DataFrame, rounds: int = 150, depth: int = 3, rate: float = 0.1, seed: int = 42) -> TreeEnsemble:
    """Boosted trees over pairs; `RANKERS` names the settings. The fit depends on the pairs and the seed only."""
    recipe = Recipe(trees=rounds, depth=depth, rate=rate, seed=seed)
    return trees.fit(pairs, RANKER_FEATURES, ["customer_id", "product_id"], recipe)


def score_pairs(model: TreeEnsemble, pairs: DataFrame) -> DataFrame:
    """`pairs` with the ranker's probability as `score`."""
    return pairs.select(*pairs.columns, model.probability().alias("score"))


def _best_to_customers(customers: DataFrame, best: DataFrame) -> DataFrame:
    return (
        customers.select("customer_id")
        .join(best, "customer_id", "left")
        .na.fill("None", subset=["recommended_product"])
    )


def _candidates(customers: DataFrame, bought: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Every customer with every unseen product: customer features, product columns, `category`.

    A shelf is an array of at most `SHELF` products. The difference to the basket is taken inside the row.
    """
    shelf, position = F.floor((F.col("_rank") - 1) / SHELF).cast("int"), ((F.col("_rank") - 1) % SHELF + 1).cast("int")
    product = F.struct("product_name", "product_id", "category", "unit_price")
    stocked = materialize(
        catalogue.groupBy(shelf.alias("_shelf")).agg(F.sort_array(F.collect_list(product)).alias("_stock")), "shelves"
    )
    shelves = stocked.count()
    seen = _baskets(bought, catalogue).select("customer_id", shelf.alias("_shelf"), position.alias("_p"))
    seen = seen.groupBy("customer_id", "_shelf").agg(F.collect_list("_p").alias("_seen"))
    every = F.explode(F.sequence(F.lit(0), F.lit(max(1, shelves) - 1))).alias("_shelf")
    people = customers.select("customer_id", *CUSTOMER_FEATURES).join(category_shares(bought), "customer_id", "left")
    rows = people.select("*", every).join(seen, ["customer_id", "_shelf"], "left")
    # Rows are small before they are set against the shelf: a fixed number of tasks keeps them from being merged.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "customer_id", "_shelf").join(stocked, "_shelf")
    nothing = F.array().cast("array<int>")
    unseen = F.array_except(F.sequence(F.lit(1), F.size("_stock")), F.coalesce("_seen", nothing))
    offered = rows.select("customer_id", *CUSTOMER_FEATURES, "shares", F.explode(F.transform(unseen, lambda p: F.element_at("_stock", p))).alias("_product"))
    return offered.select("customer_id", *CUSTOMER_FEATURES, "_product.*", F.col("shares")[F.col("_product.category")].alias("category_affinity"))


def recommend(
    customers: DataFrame,
    sales: DataFrame,
    model: TreeEnsemble,
    products: DataFrame | None = None,
    top_n: int = 1,
    bought: DataFrame | None = None,
) -> DataFrame:
    """The `top_n` best-scored unpurchased products of every customer, ties by product name.

    Candidates leave the customer's row only to pass through the model in the same task; each task
    keeps a customer's best before anything is shuffled. With `top_n` above 1 there is a `rank`.
    """
    bought = condense(sales) if bought is None else bought
    candidates = _described(_candidates(customers, bought, _catalogue(sales, products)))
    scored = score_pairs(model, _numeric(candidates)).select("customer_id", "product_name", F.round("score", SCORE_DIGITS).alias("_score"))
    order = Window.partitionBy("customer_id").orderBy(F.col("_score").desc(), "product_name")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)
    best = best.select(
        "customer_id",
        F.col("product_name").alias("recommended_product"),
        F.bround("_score", 4).alias("recommendation_score"),
        *(["rank"] if top_n > 1 else []),
    )
    filled = _best_to_customers(customers, best).na.fill(0.0, subset=["recommendation_score"])
    return filled.na.fill(1, subset=["rank"]) if top_n > 1 else filled


def _price_lists(catalogue: DataFrame) -> DataFrame:
    """The catalogue in four orders, for every category and as a whole: `_place` numbers the lines of all lists.

    Lists: prices upward, prices downward, products without a price, all by name; names settle ties.
    """
    price = F.col("unit_price").cast("double")
    groups = F.filter(
        F.array(F.struct(F.lit(True).alias("_all"), F.lit("").alias("_group")), F.struct(F.lit(False).alias("_all"), F.col("category").alias("_group"))),
        lambda g: g["_group"].isNotNull(),
    )
    lists = F.array(
        F.when(price.isNotNull(), F.struct(F.lit("up").alias("_list"), price.alias("_sort"))),
        F.when(price.isNotNull(), F.struct(F.lit("down").alias("_list"), (-price).alias("_sort"))),
        F.when(price.isNull(), F.struct(F.lit("free").alias("_list"), F.lit(0.0).alias("_sort"))),
        F.struct(F.lit("name").alias("_list"), F.lit(0.0).alias("_sort")),
    )
    rows = catalogue.select("product_id", "product_name", price.alias("_price"), F.explode(groups).alias("_g"), F.filter(lists, lambda x: x.isNotNull()).alias("_lists"))
    rows = rows.select("product_id", "product_name", "_price", "_g.*", F.explode("_lists").alias("_l")).select("product_id", "product_name", "_price", "_all", "_group", "_l.*")
    order = [(c, True) for c in ("_list", "_all", "_group", "_sort", "product_name", "product_id")]
    return materialize(global_rank(rows, order, "_place"), "price_lists")


def _cheaper(asked: DataFrame, catalogue_prices: DataFrame) -> DataFrame:
    """`asked` (customer_id, _all, _group, _want) with the number of products of the group below the wanted price.

    Products and wants are put in one order of price; the running count of products is the answer.
    """
    points = catalogue_prices.select("_all", "_group", F.col("_price").alias("_x"), F.lit(1).cast("bigint").alias("_one"), "product_id")
    wants = asked.select("_all", "_group", F.col("_want").alias("_x"), F.lit(0).cast("bigint").alias("_one"), "customer_id")
    both = points.unionByName(wants, allowMissingColumns=True)
    order = [(c, True) for c in ("_all", "_group", "_x", "_one", "product_id", "customer_id")]
    counted = materialize(running_totals(both, order, {"_seen": "_one"}), "counted")
    start = counted.groupBy("_all", "_group").agg(F.min(F.col("_seen") - F.col("_one")).alias("_start"))
    found = counted.where("_one = 0").join(start, ["_all", "_group"])
    return found.select("customer_id", "_all", "_group", (F.col("_seen") - F.col("_start")).alias("_below"))


def recommend_by_affinity(
    customers: DataFrame, sales: DataFrame, products: DataFrame | None = None, bought: DataFrame | None = None
) -> DataFrame:
    """The best unpurchased product under a fixed ranking that needs no model.

    Highest category affinity, then smallest price distance, then product name. The group to look
    in is the category (or the tied ones) of highest affinity that has an unseen product, or else the
    whole catalogue. There the nearest unseen price is at most the basket's size away on either
    side. A category with a negative spend counts as one without.
    """
    bought = condense(sales) if bought is None else bought
    catalogue = _catalogue(sales, products)
    basket = materialize(_baskets(bought, catalogue), "baskets")
    lists = _price_lists(catalogue)
    people = materialize(customers.select("customer_id", F.col("avg_order_value").cast("double").alias("_want")), "people")

    shares = category_shares(bought).select("customer_id", F.explode("shares").alias("_group", "_share")).where("_share > 0")
    stock = catalogue.groupBy(F.col("category").alias("_group")).agg(F.count("*").alias("_n"))
    held = basket.groupBy("customer_id", F.col("category").alias("_group")).agg(F.count("*").alias("_held"))
    open_ = shares.join(stock, "_group").join(held, ["customer_id", "_group"], "left")
    open_ = open_.withColumn("_held", F.coalesce("_held", F.lit(0))).where(F.col("_held") < F.col("_n"))
    top = F.rank().over(Window.partitionBy("customer_id").orderBy(F.col("_share").desc()))
    liked = materialize(open_.withColumn("_r", top).where("_r = 1").select("customer_id", "_group", "_held"), "liked")
    sizes = basket.groupBy("customer_id").agg(F.count("*").alias("_held"))
    others = people.join(liked, "customer_id", "left_anti").join(sizes, "customer_id", "left").select(
        "customer_id", "_want", F.lit(True).alias("_all"), F.lit("").alias("_group"), F.coalesce("_held", F.lit(0)).alias("_held")
    )
    asked = people.join(liked, "customer_id").select("customer_id", "_want", F.lit(False).alias("_all"), "_group", "_held").unionByName(others)
    asked = materialize(asked.distinct(), "asked")

    below = _cheaper(asked.where("_want is not null"), lists.where("_list = 'up'"))
    ends = lists.groupBy("_all", "_group").pivot("_list", ["up", "down", "free", "name"]).agg(F.min("_place").alias("from"), F.count("_place").alias("n"))
    placed = asked.join(below, ["customer_id", "_all", "_group"], "left").join(ends, ["_all", "_group"])

    def reach(name: str, skipped: Column) -> Column:
        """The next places of a list, one more than the group's products in the basket, within the list."""
        first = F.col(f"{name}_from") + skipped
        last = F.least(first + F.col("_held"), F.col(f"{name}_from") + F.col(f"{name}_n") - 1)
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    nothing = F.lit(0).cast("bigint")
    priced = F.concat(reach("up", F.col("_below")), reach("down", F.col("up_n") - F.col("_below")), F.coalesce(reach("free", nothing), F.array().cast("array<bigint>")))
    only_free = F.coalesce(reach("free", nothing), F.array().cast("array<bigint>"))
    places = F.when(F.col("_want").isNull(), reach("name", nothing)).otherwise(F.coalesce(priced, only_free))
    near = placed.select("customer_id", "_want", F.explode(places).alias("_place")).join(lists.select("_place", "product_id", "product_name", "_price"), "_place")
    unseen = near.join(basket.select("customer_id", "product_id"), ["customer_id", "product_id"], "left_anti")
    distance = F.coalesce(F.abs(F.col("_price") - F.col("_want")), F.lit(0.0))
    best = unseen.groupBy("customer_id").agg(F.min(F.struct(distance.alias("d"), "product_name")).alias("_b"))
    return _best_to_customers(customers, best.select("customer_id", F.col("_b.product_name").alias("recommended_product")))
