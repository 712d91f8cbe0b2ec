"""What must not grow faster than the rows: calls per key, numbers sent to the driver, joins that drop nothing."""

import datetime as dt
from collections import Counter

from pyspark import RDD

from martloom.operators import boosting
from martloom.operators.boosting import Boosting, Fit, boost
from martloom.operators.dense import dense_levels
from martloom.operators.keys import may_occur
from martloom.plans.marts import common, products
from martloom.plans.ml import sellers
from martloom.plans.pipeline import DETAIL, PROFILE, Marts
from martloom.session import cut
from martloom.sources import refresh
from martloom.streaming import checkout


def test_customers_of_one_group_are_numbered_apart(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    kinds = "order_id long, customer_unique_id long, at timestamp"
    customers = [None, *range(40)]
    events = [(n, customers[n % 41], start + dt.timedelta(minutes=(n * 37) % 500)) for n in range(410)]
    events += [(None, 3, start), (None, 4, start)]

    def run(rows):
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = checkout.read_checkouts(spark, f"{tmp_path}/in", kinds)
        numbered = checkout.numbered_checkouts(stream, "at", lateness="2 days", groups=3)
        checkout.start_sink(numbered, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()

    run(events[:250] + events[:20] + events[-2:])
    run(events[100:] + events[-2:])
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((r.order_id, r.customer_unique_id) for r in got) == Counter((o, c) for o, c, _ in events)
    for c in customers:
        own = [r for r in got if r.customer_unique_id == c]
        assert sorted(r.order_number for r in own) == list(range(1, len(own) + 1))
        early = sorted((r for r in own if r.order_id is not None and r.order_id < 250), key=lambda r: r.order_number)
        assert [r.at for r in early] == sorted(r.at for r in early)


def test_points_of_many_sellers_are_read_by_many_tasks(spark, monkeypatch):
    read = []

    def stub(points, starts):
        read.append(points.rdd.getNumPartitions())
        return original(points, starts[:1], iterations=2)

    original = sellers.kmeans
    monkeypatch.setattr(sellers, "kmeans", stub)
    many = spark.range(20_000).selectExpr(
        "id AS seller_id", "id * 1.0D AS total_revenue", "id % 5 * 1.0D AS avg_review_score", "id % 90 AS total_orders", "id % 7 AS unique_categories"
    )
    sellers.train_seller_model(many.coalesce(1))
    sellers.train_seller_model(many.limit(50).coalesce(1))
    assert read[0] > 1 == read[1]


def test_the_driver_gets_splits_and_no_sums(spark, monkeypatch):
    def no(*_):
        raise AssertionError("sums for the driver")

    monkeypatch.setattr(RDD, "treeReduce", no)
    monkeypatch.setattr(boosting, "ROWS", 64)
    rows = [(i, i * 7 % 5, i * 3 % 4, int(i * 7 % 5 > 2) ^ int(i % 11 == 0), 1.0 + i % 2, i % 3) for i in range(500)]
    df = cut(spark.createDataFrame(rows, "id long, a long, b long, z int, w double, fold int").repartition(3), "boosting-growth")
    fits, settings = [Fit((0, 1)), Fit((0, 1), 1)], Boosting(rounds=5, depth=3, rate=0.4, feature_share=1.0, logistic=True)
    every = boosting._combinations

    def grown(combinations, cells):
        monkeypatch.setattr(boosting, "_combinations", combinations)
        monkeypatch.setattr(boosting, "CELLS", cells)
        return boost(df, ["a", "b"], "z", "id", fits, settings, cut, "fold", "w", keep=["id"])

    by_kind, by_cell, by_level = (
        grown(every, 500), grown(lambda table, kinds=False: None if kinds else every(table), 500), grown(every, 3)
    )
    for other in (by_cell, by_level):
        for a, b in zip(by_kind.trees, other.trees, strict=True):
            assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and (a.leaf == b.leaf).all() and (a.cover == b.cover).all()
        assert {r.id: r.predictions for r in by_kind.rows.collect()} == {r.id: r.predictions for r in other.rows.collect()}
    assert by_kind.trees[0].gain.max() > 0


def test_a_first_refresh_joins_nothing_to_find_its_months(spark, monkeypatch, tmp_path):
    plans = []
    monkeypatch.setattr(refresh, "months_of", lambda rows, time: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()))
    for name, ddl in (("orders", "order_id long, order_purchase_timestamp timestamp_ntz"), ("paid", "order_id long"), ("items", "order_id long")):
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}")
    orders, paid, items = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("orders", "paid", "items"))
    refresh.changed_order_months(orders, [paid, items], None)
    refresh.changed_order_months(orders, [paid, items], dt.datetime(2024, 1, 1))
    assert "Join" not in plans[0] and plans[1].count("Join LeftSemi") == 1


def shop(spark, n=400):
    """Orders with hot, missing and repeated keys."""
    def rows(text):
        return spark.range(n).selectExpr(*text.split("; "))

    people = rows("if(id % 7 = 0, 5, id) AS customer_id; if(id % 11 = 0, NULL, id % 60) AS customer_unique_id; if(id % 5 = 0, NULL, concat('S', id % 3)) AS customer_state; 'x' AS customer_city")
    orders = rows(
        "if(id % 13 = 0, NULL, if(id % 17 = 0, 3, id)) AS order_id; if(id % 19 = 0, NULL, id % 150) AS customer_id; "
        "if(id % 4 = 0, 'canceled', 'delivered') AS order_status; timestamp_ntz'2024-01-01 00:00:00' AS order_purchase_timestamp"
    )
    payments = rows(
        "if(id % 3 = 0, 9, id) AS order_id; CAST(id % 6 AS INT) AS payment_installments; if(id % 23 = 0, NULL, id / 8) AS payment_value; "
        "CASE id % 5 WHEN 0 THEN 'boleto' WHEN 1 THEN 'voucher' WHEN 2 THEN 'other' WHEN 3 THEN 'credit_card' END AS payment_type"
    )
    items = rows("if(id % 9 = 0, NULL, id % 250) AS order_id; id % 8 AS product_id; id / 4 AS price; 0.25D AS freight_value")
    return {
        "customers": people,
        "orders": orders,
        "order_payments": payments,
        "order_items": items.unionByName(items.where("order_id % 3 = 0")),
        "order_reviews": rows("id AS review_id; id % 90 AS order_id; CAST(id % 5 + 1 AS INT) AS review_score"),
        "products": rows("id AS product_id; if(id % 3 = 0, NULL, concat('c', id % 3)) AS product_category_name").where("product_id < 7"),
        "category_translation": spark.createDataFrame([("c1", "one")], "product_category_name string, product_category_name_english string"),
    }


def test_payments_are_added_up_once_for_orders_and_customers(spark, monkeypatch):
    calls, original = [], common.payments_by_order

    def counted(payments):
        calls.append(payments)
        return original(payments)

    def table(df):
        return Counter(tuple(r) for r in df.collect())

    name = "mart_hv_category_preference"
    apart = Marts(shop(spark), cut, cut=cut)
    want = {PROFILE: table(apart.mart(PROFILE)), DETAIL: table(apart.mart(DETAIL))}
    want[name] = table(products.hv_category_preference(apart.mart(DETAIL), apart.mart(PROFILE), apart.raw["order_items"], apart.part("product_categories")))
    monkeypatch.setattr(common, "payments_by_order", counted)
    monkeypatch.setattr(products, "_THIN_FROM", 0)
    once = Marts(shop(spark), cut, cut=cut)
    got = {name: table(once.define(name)), PROFILE: table(once.mart(PROFILE)), DETAIL: table(once.mart(DETAIL))}
    assert len(calls) == 1
    assert got == want and all(want.values())


def test_only_items_of_wanted_orders_move(spark):
    for kind in ("id", "CAST(id AS INT)", "concat('o', id)"):
        many = spark.range(5000).selectExpr(f"if(id % 50 = 49, NULL, {kind}) AS k", "id AS v")
        some = many.where("v % 40 = 0")
        kept = {r.v for r in may_occur(many, some.unionByName(some).select("k"), "k").collect()}
        assert {r.v for r in some.where("k IS NOT NULL").collect()} <= kept and len(kept) < 1000
    other = some.selectExpr("CAST(v AS DOUBLE) AS k")
    assert may_occur(many, other, "k") is many
    assert may_occur(other, other, "k") is other
    assert may_occur(many, some.limit(0), "k").count() == 0


def test_levels_of_a_report_start_no_python(spark):
    counts = spark.range(3).selectExpr("concat('t', id) AS tier", "id AS n")
    df = dense_levels(counts, "tier", ["t2", "it's", "t0"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan
    assert {tuple(r) for r in df.collect()} == {("t2", 1, 2), ("it's", 2, None), ("t0", 3, 0)}
    assert dict(df.dtypes) == {"tier": "string", "level_order": "int", "n": "bigint"}
