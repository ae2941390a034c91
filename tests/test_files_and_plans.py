import datetime
import random
from decimal import Decimal
from multiprocessing.pool import ThreadPool
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from patronlens.functions.columns import line_revenue
from patronlens.plans import exports, measures, pipeline, stages
from patronlens.sources import files, schemas
from patronlens.workspace import clear_workspace, materialize, new_path, shared_folder, ship_package

AS_OF = datetime.date(2024, 6, 30)


def test_csv_keeps_types_and_the_text_none(spark):
    rows = [("C1", "None", Decimal("1.50"), datetime.date(2024, 1, 2)), ("C2", None, None, None)]
    df = spark.createDataFrame(rows, "id string, text string, money decimal(18,2), day date")
    path = new_path(spark, "test_csv")
    files.write_csv(df, path)
    back = files.read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_with_a_bad_value_fails(spark):
    path = new_path(spark, "test_bad_csv")
    files.write_csv(spark.createDataFrame([("x",)], "n string"), path)
    with pytest.raises(Exception, match="x"):
        files.read_csv(spark, path, "n int").collect()


def test_csv_with_other_columns_fails(spark):
    path = new_path(spark, "test_swapped_csv")
    files.write_csv(spark.createDataFrame([("x", "C1")], "name string, customer_id string"), path)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, path, "customer_id string, name string").collect()


def test_csv_doubles_quotes(spark):
    path = new_path(spark, "test_quoted_csv")
    rows = [('6" bolt, long', 'a\\"b'), ("plain", None)]
    df = spark.createDataFrame(rows, "name string, other string")
    files.write_csv(df, path)
    assert any('"6"" bolt, long"' in r[0] for r in spark.read.text(path).collect())
    assert sorted(map(tuple, files.read_csv(spark, path, df.schema).collect())) == sorted(rows)


def test_line_revenue_keeps_four_digits_of_the_discount(spark):
    df = spark.createDataFrame([(Decimal("100.00"), Decimal("0.1250"))], "gross decimal(12,2), discount decimal(5,4)")
    assert df.select(line_revenue("gross", "discount")).first()[0] == Decimal("87.50")


def test_enriching_twice_changes_nothing(spark):
    master = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, x int")
    added = spark.createDataFrame([("a", 9)], "customer_id string, y int")
    once = files.enrich_master(master, added)
    twice = files.enrich_master(once, added)
    assert sorted(map(tuple, twice.collect())) == [("a", 1, 9), ("b", 2, None)]
    assert once.columns == twice.columns


def test_stage_tables_live_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark).startswith(named)
    table = materialize(spark.range(3), "test_stage")
    assert table.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(shared_folder(spark).split("file:")[-1].lstrip("/"))


def test_dashboard_without_optional_columns(spark):
    rows = [(f"C{i}", "s", i, "Lost / Dormant", float(i), 0.39 + i / 10) for i in range(5)]
    df = spark.createDataFrame(
        rows, "customer_id string, customer_name string, segment int, segment_name string, clv_predicted double, churn_probability double"
    )
    board = exports.dashboard(materialize(df, "test_board"))
    assert board.columns == [
        "customer_id", "customer_name", "segment", "customer_value", "churn_probability", "churn_risk_band", "value_tier",
    ]
    got = {r["customer_id"]: (r["segment"], r["churn_risk_band"], r["value_tier"]) for r in board.collect()}
    assert got["C0"] == ("Lost / Dormant", "Low Risk", "Bronze")
    assert got["C1"] == ("Lost / Dormant", "Medium Risk", "Bronze")
    assert got["C4"][1:] == ("High Risk", "Platinum")


def test_null_groups_are_dropped(spark):
    sales = spark.createDataFrame(
        [(None, "O1", "C1", 5), (datetime.date(2024, 1, 5), "O2", "C1", 7), (datetime.date(2024, 1, 9), "O2", "C1", None)],
        "order_date date, order_id string, customer_id string, revenue int",
    )
    assert [tuple(r) for r in exports.monthly_revenue(sales).collect()] == [("2024-01", 7, 1, 1)]
    recommended = spark.createDataFrame([("a",), (None,), ("a",)], "recommended_product string")
    assert [tuple(r) for r in exports.times_recommended(recommended).collect()] == [("a", 2)]


def test_measures_of_an_empty_slice(spark, sf_dir):
    row = measures.measures(stages.dashboard(spark, sf_dir), {"region": ["nowhere"]}).first()
    assert row["total_revenue"] == 0 and row["churn_rate"] is None and row["high_risk_customers"] == 0


def test_totals_agree_between_exports(spark, sf_dir):
    board = stages.dashboard(spark, sf_dir)
    months = queries()["monthly_revenue"](spark, sf_dir).agg({"revenue": "sum"}).first()[0]
    products = queries()["dim_products"](spark, sf_dir)
    assert products.agg({"total_revenue": "sum"}).first()[0] == months
    assert exports.segment_summary(board).agg({"customer_count": "sum"}).first()[0] == board.count()
    told = exports.times_recommended(board).agg({"times_recommended": "sum"}).first()[0]
    assert told == board.count()


def board_input(spark, out):
    """The customer table of a finished run."""
    return files.stored_stage(spark, f"{out}/stages/customer_table")


def test_whole_run_from_files_to_files(spark):
    rng = random.Random(2)
    folder, out = new_path(spark, "test_sources"), new_path(spark, "test_out")
    products = [(f"P{i}", f"Name {i}", "ABC"[i % 3], Decimal(20 + i)) for i in range(8)]

    def day(limit):
        return AS_OF - datetime.timedelta(days=rng.randint(1, limit))

    customers, sales, web, support, marketing = [], [], [], [], []
    for i in range(120):
        key, quiet = f"C{i:03d}", i % 3 == 0
        customers.append((key, "A", f"B{i}", "Europe", "Spain", "Individual", AS_OF - datetime.timedelta(days=1000), "Online", i % 2))
        for n in range(0 if i % 10 == 0 else rng.randint(1, 6)):
            pid, name, category, price = rng.choice(products)
            when = AS_OF - datetime.timedelta(days=rng.randint(380, 900)) if quiet else day(150)
            sales.append((f"O{i}-{n}", key, when, pid, name, category, 1, price, Decimal(0), price, "Online"))
        for n in range(rng.randint(1, 3) if quiet else rng.randint(4, 8)):
            web.append((f"S{i}-{n}", key, day(30), rng.randint(1, 9), Decimal("3.10"), "phone", n % 2, "ads"))
        support.append((f"T{i}", key, day(30), "x", Decimal("2.00"), rng.randint(1, 5), 0))
        marketing.append((f"M{i}", key, "k", "SMS", day(30), i % 2, 0))
    for (name, schema), rows in zip(schemas.SOURCES.items(), (customers, sales, web, support, marketing)):
        files.write_csv(spark.createDataFrame(rows, schema), f"{folder}/{name}.csv")

    tables = pipeline.run(
        spark, folder, out, AS_OF, k=3, restarts=1, ks=[2, 3], ranker_params={"rounds": 3},
        churn_params={"rf": {"numTrees": 5}, "gbt": {"maxIter": 3}},
    )
    board = tables["customer_360_dashboard"]
    assert board.count() == 120 and len(board.columns) == 28
    written = spark.read.option("header", True).csv(f"{out}/customer_360_dashboard")
    assert written.count() == 120 and written.columns == board.columns
    models = spark.read.option("header", True).csv(f"{out}/model_comparison")
    assert [c for c in models.columns] == ["model", "accuracy", "precision", "recall", "f1_score", "roc_auc"]
    assert models.count() == 3
    bought = spark.createDataFrame(sales, schemas.SALES).selectExpr("customer_id", "product_name as recommended_product")
    assert board.join(bought, ["customer_id", "recommended_product"], "left_semi").count() == 0
    totals = {n: t.agg({c: "sum"}).first()[0] for n, t, c in (
        ("months", tables["monthly_revenue_trend"], "revenue"), ("products", tables["dim_products"], "total_revenue"),
    )}
    assert totals["months"] == totals["products"] == sum(row[9] for row in sales)
    rows_of = {n: spark.read.option("header", True).csv(f"{out}/{n}").count() for n in ("k_sweep", "cleaning_audit", "churn_rate", "ranker_auc")}
    assert rows_of == {"k_sweep": 2, "cleaning_audit": 5, "churn_rate": 1, "ranker_auc": 1}
    again = pipeline.score_churn(board_input(spark, out), out, kinds=("gbt_weighted",), scoring_model="gbt_weighted", params={"gbt_weighted": {"maxIter": 2}})
    assert again.count() == 120 and spark.read.option("header", True).csv(f"{out}/model_comparison").count() == 4
    profiles = spark.read.option("header", True).csv(f"{out}/segment_profiles")
    assert profiles.count() == 3 and "segment_name" in profiles.columns


def test_workspace_can_be_cleared():
    from patronlens.workspace import build_session

    session = build_session("local[8]")
    table = materialize(session.range(3), "test_gone")
    assert table.count() == 3
    clear_workspace(session)
    stages.reset()
    with pytest.raises(Exception):
        session.read.parquet(shared_folder(session)).count()


def test_a_broken_write_leaves_the_stage_before(spark, tmp_path):
    path = str(tmp_path / "stage")
    assert files.stored_stage(spark, path) is None
    files.write_stage(spark.range(3), path)
    # The new version may be made from the one that it replaces.
    doubled = files.write_stage(files.stored_stage(spark, path).selectExpr("id * 2 as id"), path)
    with pytest.raises(Exception, match="broken"):
        files.write_stage(files.stored_stage(spark, path).select(F.when(F.col("id") > 2, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")), path)
    assert sorted(r["id"] for r in files.stored_stage(spark, path).collect()) == sorted(r["id"] for r in doubled.collect()) == [0, 2, 4]
    files.write_stage(spark.range(1), path)
    assert files.stored_stage(spark, path).count() == 1 and len(list((tmp_path / "stage").iterdir())) == 2


def test_fits_side_by_side_send_the_package_once():
    sent = []
    context = SimpleNamespace(applicationId="test-side-by-side", addPyFile=sent.append)
    with ThreadPool(8) as pool:
        pool.map(ship_package, [SimpleNamespace(sparkContext=context)] * 8, chunksize=1)
    assert len(sent) == 1
