import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronlens.functions import columns as fn
from patronlens.operators import cleaning, features
from patronlens.operators.customer_table import CUSTOMER_COLUMNS, build_customer_table, rfm_scores
from patronlens.sources import schemas, views
from patronlens.workspace import materialize

AS_OF = datetime.date(2026, 8, 14)


def day(ago):
    return AS_OF - datetime.timedelta(days=ago)


def line(order, customer, ago, product="P1", category="A", qty=1, revenue="10.00", channel="Online"):
    return (order, customer, day(ago), product, product, category, qty, Decimal("10.00"),
            Decimal("0"), Decimal(revenue), channel)


@pytest.fixture(scope="module")
def sources(spark):
    def customer(key, signup, first="Ann", last="Lee"):
        return (key, first, last, "Europe", "Spain", "Individual", day(signup), "In-Store", 1)

    customers = [
        customer("C1", 900), customer("C2", 800), customer("C3", 130), customer("C4", 30),
        customer("C5", 700, last=None), customer("C1", 900), customer(None, 10),
    ]
    sales = [
        line("O1", "C1", 10, "P1", "A", 1, "10.00"), line("O1", "C1", 10, "P2", "B", 2, "30.00"),
        line("O1", "C1", 10, "P2", "B", 2, "30.00"), line("O2", "C1", 5, "P3", "A", 1, "20.00", "B2B Direct"),
        line("O3", "C1", 5, "P1", "A", 1, "0.00", "B2B Direct"),
        line("O4", "C2", 200, "P9", "Z", 1, "5.00", "Marketplace"), line("O5", "C2", 400, "P9", "Y", 1, "5.00"),
        line("O6", "C5", 400, "P1", "A", 1, "7.00"), line("O7", None, 1), line("O8", "C9", 1),
    ]
    web = [
        ("S1", "C1", day(3), 4, Decimal("2.50"), "phone", 1, "ads"), ("S2", "C1", day(9), 6, Decimal("3.50"), "phone", 0, "ads"),
        ("S3", "C3", day(125), 1, Decimal("1.00"), "web", 0, "mail"), ("S4", "C2", day(1), 1, Decimal("1.00"), "web", 0, "mail"),
    ]
    support = [
        ("T1", "C1", day(9), "x", Decimal("4.00"), 5, 0), ("T2", "C1", day(8), "x", Decimal("6.00"), 4, 1),
        ("T3", "C2", day(9), "x", Decimal("1.00"), 2, 0), ("T4", "C9", day(9), "x", Decimal("1.00"), 1, 0),
    ]
    marketing = [("M1", "C1", "k", "SMS", day(4), 1, 0), ("M2", "C1", "k", "SMS", day(3), 0, 0)]
    data = [customers, sales, web, support, marketing]
    return [spark.createDataFrame(rows, schema) for rows, schema in zip(data, schemas.SOURCES.values())]


@pytest.fixture(scope="module")
def table(spark, sources):
    built = materialize(build_customer_table(*sources, as_of=AS_OF), "test_customers")
    return {r["customer_id"]: r for r in built.collect()}


def test_columns_and_keys(table):
    assert list(table["C1"].asDict()) == CUSTOMER_COLUMNS and len(CUSTOMER_COLUMNS) == 40
    assert sorted(table) == ["C1", "C2", "C3", "C4", "C5"]


def test_purchases_after_cleaning(table):
    row = table["C1"]
    # The repeated line of O1 collapses: revenue 10 + 30 + 20 + 0 over four lines.
    assert (row["frequency"], row["monetary"], row["avg_order_value"]) == (3, Decimal("60.00"), 15.0)
    assert row["total_units"] == 5 and row["recency_days"] == 5
    # A and B both reach 30: the first by name. Two lines per channel: the first by name.
    assert (row["favorite_category"], row["top_purchase_channel"]) == ("A", "B2B Direct")
    # Latest day holds O2 and O3: the higher order id.
    assert row["last_product_purchased"] == "P1"
    assert row["clv_historical"] == row["monetary"]


def test_never_bought(table):
    row = table["C4"]
    assert (row["R_score"], row["F_score"], row["M_score"], row["RFM_total"]) == (1, 1, 1, 3)
    assert row["RFM_score"] is None and row["last_purchase_date"] is None
    assert row["recency_days"] == 30 and row["frequency"] == 0 and row["monetary"] == 0
    assert (row["favorite_category"], row["last_product_purchased"]) == ("None", "None")
    assert row["top_purchase_channel"] == "In-Store"
    assert row["clv_predicted"] == 0.0 and row["days_since_last_session"] is None


def test_missing_satisfaction_takes_the_mean_of_known_customers(table):
    # Means 4.5 and 2.0; the customer without a master row does not count.
    assert table["C3"]["avg_csat"] == pytest.approx(3.25)
    assert table["C2"]["avg_csat"] == 2.0


def test_scores_have_one_as_best(table):
    # One buyer without a master row was more recent; nobody bought more often or for more.
    assert table["C1"]["RFM_score"] == "211" and table["C1"]["RFM_total"] == 4
    assert table["C5"]["R_score"] == 5


def test_mirrored_scores(spark, sources):
    orders = materialize(features.order_features(sources[1].dropna(), AS_OF), "mirrored")
    plain = {r["customer_id"]: r for r in rfm_scores(orders).collect()}
    for row in rfm_scores(orders, best_score=5).collect():
        assert row["R_score"] == 6 - plain[row["customer_id"]]["R_score"]
        assert row["RFM_total"] == 18 - plain[row["customer_id"]]["RFM_total"]


def test_churn_rules(table):
    # Recent buyer; 200 days with low satisfaction; never bought, 130 days; new; 400 days.
    assert [table[c]["churned"] for c in ("C1", "C2", "C3", "C4", "C5")] == [0, 1, 1, 0, 1]


def test_each_churn_rule_alone(spark):
    rows = [
        (366, 3, 5.0, 1, day(900)), (365, 3, 5.0, 1, day(900)), (181, 3, 2.9, 1, day(900)),
        (181, 3, 3.0, 180, day(900)), (181, 3, 3.0, None, day(900)), (121, 0, 5.0, 121, day(121)),
        (121, 0, 5.0, 120, day(121)), (120, 0, 5.0, None, day(120)), (None, 0, None, None, None),
    ]
    df = spark.createDataFrame(
        rows, "recency_days int, frequency int, avg_csat double, days_since_last_session int, signup_date date"
    )
    flags = [r["f"] for r in df.select(fn.churn_flag(AS_OF).alias("f")).collect()]
    assert flags == [1, 0, 1, 0, 1, 1, 0, 0, 0]


def test_names_need_both_parts(table):
    assert table["C1"]["customer_name"] == "Ann Lee" and table["C5"]["customer_name"] is None


def test_tenure_floor_and_retention_bounds(spark):
    df = spark.createDataFrame([(day(1), 0), (day(1000), 5000)], "signup_date date, recency_days int")
    rows = df.withColumn("tenure_years", fn.tenure_years(AS_OF)).withColumn("keep", fn.retention_factor()).collect()
    assert rows[0]["tenure_years"] == 0.1 and rows[0]["keep"] == 0.95
    assert rows[1]["keep"] == pytest.approx(0.4)


def test_profile_equals_its_four_parts(spark, sf_dir):
    sales = cleaning.clean_source(views.sales(spark, sf_dir))
    parts = (
        features.order_features(sales, views.AS_OF)
        .join(features.favorite_category(sales), "customer_id", "left")
        .join(features.top_channel(sales), "customer_id", "left")
        .join(features.last_product(sales), "customer_id", "left")
    )
    whole = features.purchase_profile(sales, views.AS_OF).select(*parts.columns)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_audit_counts_null_keys_and_copies(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", 1)], "customer_id string, x int")
    audit = cleaning.cleaning_audit({"s": df, "empty": df.limit(0)}).collect()
    assert [tuple(r) for r in audit] == [("s", 4, 2, 2), ("empty", 0, 0, 0)]


def test_one_customer_with_a_third_of_the_lines(spark):
    lines = spark.range(6000).select(
        F.format_string("O%05d", "id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.format_string("C%d", F.col("id") % 50 + 1)).alias("customer_id"),
        F.date_sub(F.lit(AS_OF), (F.col("id") % 100).cast("int")).alias("order_date"),
        F.lit("P").alias("product_id"), F.format_string("P%d", F.col("id") % 9).alias("product_name"),
        F.format_string("K%d", F.col("id") % 4).alias("category"), F.lit(1).alias("quantity"),
        F.lit(Decimal("1.00")).alias("revenue"), F.lit("Online").alias("sales_channel"),
    )
    hot = features.purchase_profile(lines, AS_OF).where("customer_id = 'C0'").first()
    assert (hot["frequency"], hot["monetary"], hot["total_units"]) == (2000, Decimal("2000.00"), 2000)


def test_sales_are_dealt_by_order_and_cleaned_where_they_meet(spark, sf_dir, monkeypatch):
    plain = sorted(map(tuple, views.sales(spark, sf_dir).collect()))
    monkeypatch.setattr(views, "TASK_BYTES", 20_000)
    tasks = -(-views.stored_bytes(spark, f"{sf_dir}/lineitem.parquet") // 20_000)
    dealt = views.sales(spark, sf_dir)
    assert tasks > 1 and dealt.rdd.getNumPartitions() == tasks
    at = dealt.select("order_id", F.spark_partition_id().alias("p")).distinct()
    assert at.count() == at.select("order_id").distinct().count()
    assert sorted(map(tuple, dealt.collect())) == plain
    # Duplicates need no exchange of their own.
    assert cleaning.clean_source(dealt).rdd.getNumPartitions() == tasks
