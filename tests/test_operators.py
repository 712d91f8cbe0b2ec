"""Operators against brute force on small frames, including skewed ones."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.operators import quantiles
from martloom.operators.dense import dense_levels
from martloom.operators.encoding import apply_mapping, encode_out_of_fold, target_mapping
from martloom.operators.keys import completed, ensure_columns, exists_flag, latest_by_key
from martloom.operators.modes import group_with_mode
from martloom.operators.quantiles import exact_quantile
from martloom.operators.ranking import (
    average_percentile_rank,
    hash_fold,
    numbered,
    rank_rows,
    share_of_total,
    stratified_fold,
    top_n_per_group,
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_completed_keeps_three_statuses(frame):
    df = frame([(s,) for s in ("delivered", "shipped", "approved", "canceled", "invoiced", None)], "order_status string")
    assert sorted(r[0] for r in completed(df).collect()) == ["approved", "delivered", "shipped"]


def test_latest_by_key_limits_before_the_shuffle(spark, frame, rows):
    df = frame([(1, 1, "old"), (1, 2, "new"), (2, 5, "only")] + [(9, i, f"v{i}") for i in range(300)], "k int, v int, x string")
    latest = latest_by_key(df, ["k"], [F.desc("v")])
    assert rows(latest) == [(1, 2, "new"), (2, 5, "only"), (9, 299, "v299")]
    plan = plan_of(latest)
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # partial and final


def test_exists_flag_ignores_repeated_keys(frame, rows):
    left = frame([(1,), (2,), (3,)], "k int")
    right = frame([(1, "a"), (1, "b"), (3, "c"), (7, "d")], "k int, x string")
    assert rows(exists_flag(left, right, "k", "hit")) == [(1, 1), (2, 0), (3, 1)]


def test_ensure_columns_adds_only_what_is_missing(frame):
    df = ensure_columns(frame([(1, "x")], "a int, b string"), {"b": "", "c": 0.0, "d": ""})
    assert df.columns == ["a", "b", "c", "d"]
    assert df.first()[:] == (1, "x", 0.0, "")


@pytest.mark.parametrize("bins,levels", [(4096, 2), (3, 1)])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.75, 0.9, 1.0])
def test_exact_quantile_equals_array_quantile(spark, monkeypatch, bins, levels, q):
    monkeypatch.setattr(quantiles, "_BINS", bins)
    rng = np.random.default_rng(3)
    # a third of all values are equal; the rest is long-tailed
    values = np.concatenate([np.full(700, 12.5), rng.lognormal(3, 2, 1301)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
    got = exact_quantile(df, "x", q, accuracy=50, levels=levels).first()[0]
    assert got == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_exact_quantile_per_group_and_small_groups(spark):
    rng = random.Random(5)
    data = [("big", rng.gauss(0, 1)) for _ in range(900)] + [("one", 4.0), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: r.quantile for r in exact_quantile(df, "x", 0.5, by=["g"], accuracy=20).collect()}
    for g in ("big", "one", "two"):
        assert got[g] == pytest.approx(np.median([x for h, x in data if h == g]), rel=1e-12)


def test_exact_quantile_survives_a_sketch_that_misses(spark, monkeypatch):
    """A bracket that does not hold the rank falls back to the full range, which is then narrowed."""
    broken = quantiles._START.replace("percentile_approx(x, array({q_low}D, {q_high}D), {accuracy})", "array(min(x), min(x))")
    assert broken != quantiles._START
    monkeypatch.setattr(quantiles, "_START", broken)
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    assert exact_quantile(df, "x", 0.75).first()[0] == 75.0


def test_exact_quantile_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantile(empty, "x", 0.5).first()[0] is None


@pytest.mark.parametrize("listed", [["a", "b", "c"], ["a"], ["q"]])
def test_group_with_mode_equals_counting(spark, listed):
    rng = random.Random(11)
    data = [(1, rng.choice("abcxyz")) for _ in range(400)]  # one hot key
    data += [(k, rng.choice(["a", "b", "c", "x", "y", None])) for k in range(2, 80) for _ in range(rng.randint(1, 6))]
    data += [(99, None), (100, "x"), (100, "a"), (101, "b"), (101, "a"), (102, "y"), (102, "x")]
    df = spark.createDataFrame(data, "k int, v string")
    got = {r.k: (r.v, r.n) for r in group_with_mode(df, ["k"], "v", listed, [F.count("*").alias("n")]).collect()}
    groups = defaultdict(list)
    for k, v in data:
        groups[k].append(v)
    for k, values in groups.items():
        counts = Counter(v for v in values if v is not None)
        want = min(counts, key=lambda v: (-counts[v], v)) if counts else None
        assert got[k] == (want, len(values)), k


def test_ranks_and_shares(frame, rows):
    df = frame([("a", 3.0), ("b", 1.0), ("c", 3.0), ("d", 5.0)], "k string, v double")
    assert rows(rank_rows(df, "r", [F.desc("v"), F.asc("k")]).select("k", "r")) == [("a", 2), ("b", 4), ("c", 3), ("d", 1)]
    # equal values share the mean of ranks 2 and 3
    assert rows(df.select("k", average_percentile_rank("v"))) == [("a", 0.625), ("b", 0.25), ("c", 0.625), ("d", 1.0)]
    assert rows(df.select("k", share_of_total("v")))[3] == ("d", 5 / 12)


def test_top_n_per_group(frame, rows):
    df = frame([("a", i, float(i)) for i in range(6)] + [("b", 1, 2.0)], "g string, m int, v double")
    assert rows(top_n_per_group(df, ["g"], [F.desc("v"), F.asc("m")], 2).select("g", "m", "rank")) == [
        ("a", 4, 2),
        ("a", 5, 1),
        ("b", 1, 1),
    ]


def digest(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def test_hash_fold_is_reproducible_anywhere(spark):
    df = spark.range(50).select("id", hash_fold("id", 5, 42).alias("f"))
    assert {r.id: r.f for r in df.collect()} == {i: int(digest(42, i)[:8], 16) % 5 for i in range(50)}


def test_numbered_is_one_global_order(spark):
    got = {r.id: r.n for r in numbered(spark.range(997), "id", 3, "n").collect()}
    order = sorted(range(997), key=lambda i: digest(3, i))
    assert got == {key: i for i, key in enumerate(order)}


def test_stratified_fold_spreads_each_label_evenly(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    counts = Counter((r.y, r.fold) for r in stratified_fold(df, "id", "y", 5, 42).collect())
    for label in (0, 1):
        sizes = [counts[label, f] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert sum(counts.values()) == 1003


def test_a_missing_label_is_a_stratum(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 5 != 0, F.col("id") % 2).alias("y"))
    rows = stratified_fold(df, "id", "y", 5, 42).collect()
    assert len(rows) == 100 and Counter(r.fold for r in rows if r.y is None) == dict.fromkeys(range(5), 4)


def test_numbered_by_more_ranges(spark):
    got = {r.id: r.n for r in numbered(spark.range(50), "id", 3, "n", digits=1).collect()}
    assert got == {r.id: r.n for r in numbered(spark.range(50), "id", 3, "n", digits=5).collect()}


def test_dense_levels_lists_empty_ones_in_order(frame):
    df = dense_levels(frame([("b", 4)], "t string, n int"), "t", ["a", "b", "c"]).orderBy("level_order")
    assert [tuple(r) for r in df.select("t", "n").collect()] == [("a", None), ("b", 4), ("c", None)]


def test_out_of_fold_encoding_equals_brute_force(spark):
    rng = random.Random(2)
    data = [(i, "hot" if i % 3 == 0 else rng.choice("pqrs"), rng.randint(0, 90), rng.randint(0, 4)) for i in range(240)]
    data += [(900, "lonely", 10, 1)]
    df = spark.createDataFrame(data, "id int, c string, y int, fold int")
    mean = np.mean([y for _, _, y, _ in data])
    got = {r.id: r.c_enc for r in encode_out_of_fold(df, ["c"], "y", "fold", 10.0).collect()}
    for i, c, _, fold in data:
        others = [y for _, d, y, f in data if d == c and f != fold]
        want = (sum(others) + 10 * mean) / (len(others) + 10) if others else mean
        assert got[i] == pytest.approx(want, rel=1e-12)


def test_mapping_for_new_rows(spark):
    df = spark.createDataFrame([("a", 10), ("a", 20), ("b", 60)], "c string, y int")
    mapping = target_mapping(df, ["c"], "y", 10.0)
    new = spark.createDataFrame([("a",), ("new",)], "c string")
    got = {r.c: r.c_enc for r in apply_mapping(new, mapping, ["c"], F.lit(30.0)).collect()}
    assert got == {"a": (30 + 10 * 30) / 12, "new": 30.0}


def test_out_of_fold_encoding_leaves_rows_where_they_are(spark):
    df = spark.range(300).repartition(7).select(
        "id", (F.col("id") % 4).cast("string").alias("c"), F.col("id").alias("y"), (F.col("id") % 5).alias("fold"), F.spark_partition_id().alias("was")
    )
    df = spark.createDataFrame(df.collect(), df.schema).repartitionByRange(7, "id").withColumn("was", F.spark_partition_id())
    out = encode_out_of_fold(df, ["c"], "y", "fold", 1.0)
    assert out.where(F.col("was") != F.spark_partition_id()).count() == 0 and out.count() == 300


def test_out_of_fold_encoding_of_unseen_and_missing_categories(spark):
    rows = [(1, "a", 10.0, 0), (2, "a", 20.0, 1), (3, "only", 30.0, 0), (4, None, 40.0, 1)]
    df = spark.createDataFrame(rows, "id int, c string, y double, fold int")
    got = {r.id: r.c_enc for r in encode_out_of_fold(df, ["c"], "y", "fold", 0.0).collect()}
    assert got == {1: 20.0, 2: 10.0, 3: 25.0, 4: 25.0}
