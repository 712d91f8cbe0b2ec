"""Sketches, ranks in ranges, refreshed months, compacted versions, clusters and attributions against plain versions."""

import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.operators import boosting, clustering
from martloom.operators.clustering import Start, kmeans, silhouettes
from martloom.operators.quantiles import quantile
from martloom.operators.ranking import average_percentile_rank, percentile_rank_all, rank_all
from martloom.operators.sketches import distinct_counts, distinct_sketches, merge_quantiles, quantile_sketches, rank_error
from martloom.plans import monthly
from martloom.plans.marts import common, leads, orders, products
from martloom.session import cut
from martloom.sources.quality import default_rules, dq_report, load, passed
from martloom.sources.raw import read_all_typed, read_raw
from martloom.sources.refresh import read_months
from martloom.sources.versions import VersionedMart
import raw_fixture


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- sketches
def test_merged_quantiles_are_within_the_stated_error(spark):
    df = spark.range(60_000).selectExpr("id % 12 AS month", "id % 2 AS g", "double(pmod(id * 7919, 60000)) AS x").repartition(6)
    months = quantile_sketches(df, "x", ["month", "g"])
    got = {r.g: r for r in merge_quantiles(months, {"a": 0.1, "b": 0.5, "c": 0.99}, ["g"]).collect()}
    for g in (0, 1):
        values = np.sort([r.x for r in df.where(F.col("g") == g).collect()])
        assert got[g].n == len(values)
        for name, q in (("a", 0.1), ("b", 0.5), ("c", 0.99)):
            assert abs(np.searchsorted(values, got[g][name]) / len(values) - q) < 2 * rank_error()


def test_sketched_quantile_is_a_switch(spark):
    df = spark.range(500).selectExpr("double(id) AS x").unionByName(spark.createDataFrame([(None,)], "x double"))
    exact, near = (quantile(df, "x", 0.5, name="m", sketch=s).first() for s in (None, 1024))
    assert (exact.m, near.asDict().keys()) == (249.5, {"m"}) and abs(near.m - 249.5) <= 1
    odd = df.unionByName(spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double"))
    assert quantile_sketches(odd, "x", []).first().n == 500
    empty = df.where("x < 0")
    assert quantile(empty, "x", 0.5, sketch=200).first()[0] is None


def test_distinct_counts_from_monthly_sketches(spark):
    df = spark.range(90_000).selectExpr("id % 3 AS g", "id % 7 AS month", "id % 30000 AS few", "pmod(id, 50) AS tiny", "CAST(NULL AS LONG) AS none")
    months = cut(distinct_sketches(df, ["few", "tiny", "none"], ["month", "g"]), "sketches")
    got = {r.g: r for r in distinct_counts(months, {"few": "few", "tiny": "tiny", "none": "none"}, ["g"]).collect()}
    for g in range(3):
        assert got[g].none == 0 and got[g].tiny == df.where(F.col("g") == g).select("tiny").distinct().count()
        assert abs(got[g].few / 10_000 - 1) < 5 * 2**-6


# ---------------------------------------------------------------- ranks
def test_ranks_in_ranges_equal_windows(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5.0D WHEN id % 100 = 1 THEN NULL ELSE double(id % 40) END AS v").repartition(7)
    ranked = rank_all(df, "r", [F.desc("v"), F.asc("id")], cut)
    want = df.withColumn("r", F.row_number().over(Window.orderBy(F.desc("v"), F.asc("id"))))
    assert sorted(map(tuple, ranked.select("id", "r").collect())) == sorted(map(tuple, want.select("id", "r").collect()))
    share = percentile_rank_all(df, "v", "p", cut)
    want = df.where("v IS NOT NULL").withColumn("p", average_percentile_rank("v"))
    got = {r.id: r.p for r in share.collect()}
    for r in want.collect():
        assert got[r.id] == pytest.approx(r.p, abs=1e-15)
    assert [got[r.id] for r in df.where("v IS NULL").collect()] == [None] * df.where("v IS NULL").count()
    assert "SinglePartition" not in plan(ranked) + plan(share)


def test_ranks_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, v double")
    assert rank_all(empty, "r", [F.asc("id")], cut).collect() == [] == percentile_rank_all(empty, "v", "p", cut).collect()


# ---------------------------------------------------------------- load
def test_load_counts_while_it_writes(spark, tmp_path):
    (tmp_path / "shop").mkdir()
    shop = raw_fixture.write(tmp_path / "shop")
    typed = read_all_typed(spark, shop)
    want = sorted(map(tuple, dq_report(typed).collect()))
    raw = {name: sorted(map(str, read_raw(spark, shop, name).collect())) for name in typed}
    stored, report = load(spark, lambda session: read_all_typed(session, shop))
    for path in Path(shop).iterdir():  # nothing is read again
        path.rename(path.with_suffix(".gone"))
    assert sorted(map(tuple, report.select("table_name", "row_count", "rule", "violations", "passed").collect())) == want
    assert {name: sorted(map(str, df.collect())) for name, df in stored.items()} == raw
    assert passed(report) == {"orders": 8, "order_payments": 8, "customers": 7}
    assert set(default_rules()) == {r.table_name for r in report.collect()}


# ---------------------------------------------------------------- months
def shop_frames(spark):
    t = "CAST('2024-01-01' AS TIMESTAMP_NTZ) + make_interval(0, 0, 0, CAST(id % 120 AS INT))"
    return {
        "orders": spark.range(400).selectExpr(
            "id AS order_id", "id % 50 AS customer_id", "CASE WHEN id % 9 = 0 THEN 'canceled' ELSE 'delivered' END AS order_status",
            f"CASE WHEN id = 399 THEN NULL ELSE {t} END AS order_purchase_timestamp"),
        "order_payments": spark.range(600).selectExpr(
            "id % 400 AS order_id", "1 AS payment_sequential", "CASE WHEN id % 2 = 0 THEN 'boleto' ELSE 'credit_card' END AS payment_type",
            "1 AS payment_installments", "double(id) / 8 AS payment_value"),
        "order_items": spark.range(700).selectExpr("id % 400 AS order_id", "id % 20 AS product_id", "id % 5 AS seller_id", "double(id % 300) AS price", "1.5D AS freight_value"),
        "mql": spark.range(300).selectExpr("id AS mql_id", "date_add(DATE'2024-01-01', CAST(id % 90 AS INT)) AS first_contact_date", "CASE WHEN id % 4 = 0 THEN '' ELSE 'social' END AS origin"),
        "closed_deals": spark.range(0, 300, 7).selectExpr(
            "id AS mql_id", "id % 5 AS seller_id", "DATE'2024-06-01' AS won_date", "'pet' AS business_segment", "'online' AS lead_type",
            "'cat' AS lead_behaviour_profile", "'reseller' AS business_type", "1.0D AS declared_monthly_revenue"),
    }


def test_refresh_of_touched_months_equals_a_full_build(spark, tmp_path):
    frames = shop_frames(spark)
    small = {
        "customers": spark.range(50).selectExpr("id AS customer_id", "id % 40 AS customer_unique_id", "'SP' AS customer_state", "'x' AS customer_city"),
        "products": spark.range(20).selectExpr("id AS product_id", "CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS product_category_name"),
        "category_translation": spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string"),
    }
    # one day comes later; its orders are of February, so are the contacts
    day = {"mql": "first_contact_date = DATE'2024-02-10'", "closed_deals": "mql_id % 90 = 40"}
    day |= {n: "order_id % 120 = 40" for n in ("orders", "order_payments", "order_items")}

    def read():
        return {n: spark.read.schema(df.schema).parquet(f"{tmp_path}/raw/{n}") for n, df in frames.items()} | small

    for name, df in frames.items():
        df.where(f"NOT coalesce({day[name]}, false)").coalesce(2).write.parquet(f"{tmp_path}/raw/{name}")
    first, moment = monthly.refresh(read(), f"{tmp_path}/marts", None)
    assert set(first[monthly.REVENUE]) == {None, "2024-01", "2024-02", "2024-03", "2024-04"}
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "marts").rglob("*.parquet")}
    time.sleep(0.05)
    for name, df in frames.items():
        df.where(day[name]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw/{name}")
    again, later = monthly.refresh(read(), f"{tmp_path}/marts", moment)
    assert {n: set(m) for n, m in again.items()} == {n: {"2024-02"} for n in again} and later > moment
    kept = {p: m for p, m in files.items() if "year_month=2024-02" not in str(p)}
    assert kept and all(p.stat().st_mtime_ns == m for p, m in kept.items())
    assert monthly.refresh(read(), f"{tmp_path}/marts", later)[0] == {n: [] for n in again}

    paid = common.payments_by_order(frames["order_payments"])
    detail = orders.order_payment_detail(frames["orders"], paid, small["customers"], frames["order_items"])
    categories = common.product_categories(small["products"], small["category_translation"])
    whole = {
        monthly.REVENUE: orders.monthly_revenue(detail),
        monthly.PRICES: products.product_price_range(frames["order_items"], frames["orders"], categories),
        monthly.LEADS: leads.mql_monthly(frames["mql"], leads.seller_acquisition(frames["closed_deals"], frames["mql"])),
    }
    for name, df in whole.items():
        got = read_months(spark, name, f"{tmp_path}/marts")
        assert sorted(map(str, got.collect())) == sorted(map(str, df.select(*got.columns).collect())), name


# ---------------------------------------------------------------- versions
def repeat_rows(spark, n, days):
    return spark.range(n).selectExpr(
        "CAST(id AS STRING) AS customer_unique_id", "'SP' AS customer_state", "id AS total_orders", "1 AS is_repeat_customer",
        "current_date() AS first_order_date", "current_date() AS last_order_date", f"{days} AS days_active", "0 AS is_high_value")


def test_compaction_keeps_the_mart(spark, tmp_path, monkeypatch):
    stamp = lambda s: F.lit(f"2024-01-0{s} 00:00:00").cast("timestamp")
    mart = VersionedMart(spark, "mart_repeat_customer", str(tmp_path), "customer_unique_id", 4)
    with pytest.raises(FileNotFoundError):
        mart.read()
    mart.refresh(repeat_rows(spark, 100, 0), stamp(2))
    mart.append(repeat_rows(spark, 30, 5), stamp(3))
    mart.append(repeat_rows(spark, 10, 7), stamp(3))  # of equal stamps the last one
    mart.append(repeat_rows(spark, 120, 9), stamp(1))  # older, but for 20 new keys
    want = {str(i): 7 if i < 10 else 5 if i < 30 else 0 if i < 100 else 9 for i in range(120)}
    assert {r.customer_unique_id: r.days_active for r in mart.read().collect()} == want
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(mart.read())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    before = mart.parts()
    with monkeypatch.context() as broken:  # the new base is written, the pointer is not
        broken.setattr(VersionedMart, "_point", lambda self, parts: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            mart.compact()
    assert mart.parts() == before
    assert {r.customer_unique_id: r.days_active for r in mart.read().collect()} == want
    mart.compact()
    assert len(mart.parts()) == 1
    assert {r.customer_unique_id: r.days_active for r in mart.read().collect()} == want
    assert mart.clean() == [1, 2, 3, 4, 5] and mart.written() == [6]  # base, three versions, and what the lost run left
    spark.sql(f"DROP TABLE {mart.table}")  # another session has no catalog entry
    other = VersionedMart(spark, mart.name, mart.folder, mart.key, mart.buckets)
    assert other.read().count() == 120 and "Exchange" not in plan(other.read())
    other.append(repeat_rows(spark, 1, 11), stamp(4))
    assert {r.days_active for r in mart.read().where("customer_unique_id = '0'").collect()} == {11}


# ---------------------------------------------------------------- clusters
@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.4, (90, 3)) for c in ((0, 0, 0), (3, 0, 1), (0, 4, 2), (5, 5, 5))])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, features array<double>").repartition(5)
    return cut(df, "cloud"), x


def lloyd(x, centers):
    for _ in range(300):
        label = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[label == k].mean(0) if (label == k).any() else centers[k] for k in range(len(centers))])
        if ((new - centers) ** 2).sum(1).max() <= 1e-8:
            break
        centers = new
    return centers, ((x[:, None] - centers[None]) ** 2).sum(2).min(1).sum()


def test_all_starts_at_once_equal_single_runs(spark, cloud, monkeypatch):
    df, x = cloud
    starts = [Start(k, s) for k in (2, 4) for s in range(5)]
    passes = []
    original = clustering._pass
    monkeypatch.setattr(clustering, "_pass", lambda *a: passes.append(len(a[2])) or original(*a))
    found = kmeans(df, starts)
    together = len(passes)
    sample = np.array([r[0] for r in df.select("features").orderBy(F.xxhash64("features"), "features").collect()])
    for start, got in zip(starts, found, strict=True):
        centers, cost = lloyd(x, clustering._spread(sample, start))
        assert got.cost == pytest.approx(cost, rel=1e-6) and np.allclose(got.centers, centers, atol=1e-4)
    passes.clear()
    assert max(len(kmeans(df, [s])) for s in starts[:3]) == 1 and together <= 60
    assert min(found[5:], key=lambda c: c.cost).cost < min(found[:5], key=lambda c: c.cost).cost
    label = {r.id: r.c for r in df.select("id", found[7].nearest(F.col("features")).alias("c")).collect()}
    assert [label[i] for i in range(len(x))] == ((x[:, None] - found[7].centers[None]) ** 2).sum(2).argmin(1).tolist()


@pytest.mark.parametrize("tile", [2048, 50])
def test_silhouettes_equal_all_pairs(spark, cloud, tile):
    df, x = cloud
    labels = [F.col("id").cast("int") % 3, (F.col("id") / 90).cast("int"), F.when(F.col("id") == 5, 1).otherwise(0)]
    got = silhouettes(df, "id", labels, cut, tile=tile)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    i = np.arange(len(x))
    for value, label in zip(got, (i % 3, i // 90, (i == 5).astype(int)), strict=True):
        score = []
        for p in i:
            own = (label == label[p]) & (i != p)
            if not own.any():
                score.append(0.0)
                continue
            a = far[p, own].mean()
            b = min(far[p, label == c].mean() for c in set(label.tolist()) - {label[p]})
            score.append((b - a) / max(a, b))
        assert value == pytest.approx(np.mean(score), abs=1e-8)


# ---------------------------------------------------------------- attributions
def test_attributions_are_shapley_values(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(200, 4)), 1)
    x[::13, 2] = np.nan
    y = np.where(x[:, 0] > 0, 2.0, 0) + np.where((x[:, 1] > 0.2) & (x[:, 3] < 0.5), 3.0, 0) + np.nan_to_num(x[:, 2])
    rows = [(i, *(None if np.isnan(v) else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = cut(spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double"), "attributed")
    s = boosting.Boosting(rounds=6, depth=3, rate=0.4, feature_share=1.0)
    trees = boosting.boost(df, ["a", "b", "c", "d"], "y", "id", [boosting.Fit((0, 1, 2, 3))], s, cut).trees[0]

    def value(row, known, t, node=0):
        inner = trees.feature.shape[1]
        if node >= inner:
            return trees.leaf[t, node - inner]
        left, right = 2 * node + 1, 2 * node + 2
        f = trees.feature[t, node]
        if f in known or not np.isfinite(trees.threshold[t, node]):
            return value(row, known, t, right if row[f] > trees.threshold[t, node] else left)
        part = trees.cover[t, left] / trees.cover[t, node]
        return part * value(row, known, t, left) + (1 - part) * value(row, known, t, right)

    from itertools import combinations
    from math import factorial

    got = {r.id: r.attributions for r in trees.attribute(df).collect()}
    margins = trees.margins(x)
    for i in range(0, 200, 9):
        assert sum(got[i]) == pytest.approx(margins[i] - trees.expected(), abs=1e-9)
        for j in range(4):
            want = 0.0
            for size in range(4):
                for known in combinations([k for k in range(4) if k != j], size):
                    weight = factorial(size) * factorial(3 - size) / factorial(4)
                    want += weight * sum(value(x[i], {*known, j}, t) - value(x[i], set(known), t) for t in range(6))
            assert got[i][j] == pytest.approx(want, abs=1e-9)


# ---------------------------------------------------------------- stream with state
def test_stream_numbers_each_order_once(spark, tmp_path):
    import datetime as dt

    from martloom.streaming import checkout

    start, kinds = dt.datetime(2024, 1, 10, tzinfo=dt.UTC), "order_id string, customer_unique_id string, at timestamp"
    rng = np.random.default_rng(3)
    events = [(f"o{i}", f"c{i % 4}", start + dt.timedelta(minutes=int(m))) for i, m in enumerate(rng.permutation(120))]

    def arrive(rows):
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = checkout.read_checkouts(spark, f"{tmp_path}/in", kinds, files_per_batch=1)
        numbered = checkout.numbered_checkouts(stream, "at", lateness="1 day")
        checkout.start_sink(numbered, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()

    arrive(events[:50] + events[:10])
    arrive(events[30:70])
    run()
    arrive(events[20:120])  # after a restart from the checkpoint, with orders that came before
    arrive([("o500", "c0", start + dt.timedelta(days=3)), ("o501", "c0", None)])
    run()
    late = [("o600", "c1", start + dt.timedelta(days=1)), ("o3", "c3", events[3][2])]
    arrive(late + [("o601", "c1", start + dt.timedelta(days=3))])
    run()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r.order_id for r in got) == sorted([e[0] for e in events] + ["o500", "o601"])
    for c in range(4):
        numbers = sorted(r.order_number for r in got if r.customer_unique_id == f"c{c}")
        assert numbers == list(range(1, len(numbers) + 1))
    first = [r for r in got if r.order_id in {e[0] for e in events[:50]} and r.customer_unique_id == "c2"]
    at = {e[0]: e[2] for e in events}
    assert [r.order_id for r in sorted(first, key=lambda r: r.order_number)] == [r.order_id for r in sorted(first, key=lambda r: at[r.order_id])]
