"""What customers buy, by category and together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.columns import ratio
from patronlens.operators.features import top_by

# Baskets beyond this many products are paired tile by tile.
TILE = 2048


def product_dimension(sales: DataFrame) -> DataFrame:
    """One row per product: that of the earliest line (date, order, price, name, category)."""
    first = F.min(F.struct("order_date", "order_id", "unit_price", "product_name", "category"))
    return (
        sales.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(first.alias("_f"))
        .select("product_id", "_f.product_name", "_f.category", "_f.unit_price")
    )


def category_spend(sales: DataFrame) -> DataFrame:
    return (
        sales.dropna(subset=["customer_id", "category"])
        .groupBy("customer_id", "category")
        .agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"))
    )


def category_names(sales: DataFrame) -> list[str]:
    """The distinct categories; Spark's pivot limit bounds them."""
    limit = int(sales.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    names = sales.select("category").where(F.col("category").isNotNull()).distinct().limit(limit + 1)
    found = sorted(r["category"] for r in names.collect())
    if len(found) > limit:
        raise ValueError(f"more than {limit} categories cannot become columns")
    return found


def category_pivot(sales: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Revenue per customer with one column per category, 0 where nothing was bought."""
    categories = categories or category_names(sales)
    wide = category_spend(sales).groupBy("customer_id").pivot("category", categories).sum("revenue")
    return wide.na.fill(0, subset=categories)


def category_shares(sales: DataFrame) -> DataFrame:
    """Per customer a map from each category bought to its share of the customer's spend."""
    entries = F.collect_list(F.struct("category", F.col("revenue").cast("double").alias("revenue")))
    spent = category_spend(sales).groupBy("customer_id").agg(
        entries.alias("_e"), F.sum("revenue").cast("double").alias("_total")
    )
    shares = F.transform("_e", lambda e: F.struct(e["category"], ratio(e["revenue"], F.col("_total"))))
    return spent.select("customer_id", F.map_from_entries(shares).alias("shares"))


def category_affinity(sales: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Share of spend for every buyer and category, zero shares included: customers x categories rows by definition."""
    if categories is None:
        names = sales.select("category").where(F.col("category").isNotNull()).distinct()
        every = F.explode(names.agg(F.sort_array(F.collect_list("category"))).scalar()).alias("category")
    else:
        every = F.explode(F.lit(list(categories))).alias("category")
    long = category_shares(sales).select("customer_id", "shares", every)
    share = F.coalesce(F.col("shares")[F.col("category")], F.lit(0.0))
    return long.select("customer_id", "category", share.alias("category_affinity"))


def customer_baskets(sales: DataFrame, item: str = "product_name") -> DataFrame:
    """The set of products each customer bought, as distinct (customer, product) rows."""
    return sales.select("customer_id", item).dropna().distinct()


def item_cooccurrence(sales: DataFrame, item: str = "product_name", tile: int = TILE) -> DataFrame:
    """How many customers bought both `a` and `b`, counted in both directions.

    A basket larger than `tile` is cut into tiles of about that size and every pair of its
    tiles is a join key of its own. No key then meets more than about tile x tile pairs,
    the pairs of one big basket are spread over the cluster, and each task adds its pairs
    up before anything is shuffled.
    """
    baskets = customer_baskets(sales, item)
    large = (
        baskets.groupBy("customer_id")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > tile)
        .select("customer_id", F.ceil(F.col("_n") / tile).cast("int").alias("_large"))
    )
    tiles = F.coalesce(F.col("_large"), F.lit(1))
    tiled = baskets.join(large, "customer_id", "left").withColumn("_tiles", tiles)
    tiled = tiled.withColumn("_tile", F.pmod(F.xxhash64(item), F.col("_tiles")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    left = tiled.select("customer_id", F.col(item).alias("_x"), F.col("_tile").alias("_i"), each.alias("_j"))
    right = tiled.select("customer_id", F.col(item).alias("_y"), F.col("_tile").alias("_j"), each.alias("_i"))
    together = (
        left.join(right, ["customer_id", "_i", "_j"])
        .where(F.col("_x") < F.col("_y"))
        .groupBy("_x", "_y")
        .agg(F.count("*").alias("n"))
    )
    both_ways = F.explode(
        F.array(
            F.struct(F.col("_x").alias("a"), F.col("_y").alias("b")),
            F.struct(F.col("_y").alias("a"), F.col("_x").alias("b")),
        )
    )
    return together.select(both_ways.alias("_p"), "n").select("_p.a", "_p.b", "n")


def top_co_purchased(cooccurrence: DataFrame, n: int = 3) -> DataFrame:
    """The `n` products most often bought with each product, ties by name."""
    return top_by(cooccurrence, ["a"], [F.col("n").desc(), F.col("b").asc()], n)
