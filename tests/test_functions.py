"""Rounding, banding, dates and aggregates on values where engines and libraries disagree."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.config import (
    CUSTOMER_TIERS,
    INSTALLMENT_BANDS,
    PRICE_BANDS,
    PRIORITY_BANDS,
    SELLER_REVENUE_BANDS,
    SEVERITY_TIERS,
)
from martloom.functions import aggregates as A
from martloom.functions import dates as D
from martloom.functions import numbers as N


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def out(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_half_even_equals_array_rounding(spark):
    values = [0.5, 1.5, 2.5, 6.45, 0.285, 0.295, 2.675, -0.5, -2.5, 12.349999, 1e9 + 0.125] + [
        random.Random(1).uniform(-1e4, 1e4) for _ in range(200)
    ]
    for places in (0, 1, 2, 4):
        assert out(column(spark, values), N.half_even("x", places)) == [float(np.round(v, places)) for v in values]


@given(st.lists(st.floats(0, 1e7).map(lambda v: round(v, 2)) | st.floats(0, 100), min_size=1, max_size=40))
@settings(max_examples=15, deadline=None)
def test_one_decimal_equals_text_formatting(spark, values):
    assert out(column(spark, values), N.one_decimal("x")) == [f"{v:.1f}" for v in values]


def test_one_decimal_known_ties(spark):
    values = [0.25, 29.55, 2.05, 5.35, 0.05, 0.15, 99.95, 17.0]
    assert out(column(spark, values), N.one_decimal("x")) == [f"{v:.1f}" for v in values]


@pytest.mark.parametrize(
    ("bands", "cases"),
    [
        (INSTALLMENT_BANDS, {0: "1", 1: "1", 2: "2-6", 6: "2-6", 7: "7-12", 12: "7-12", 13: "12+"}),
        (PRICE_BANDS, {50: "A. 0-50", 50.01: "B. 50-150", 150: "B. 50-150", 500: "C. 150-500", 500.01: "D. 500+"}),
        (SELLER_REVENUE_BANDS, {848: "Starter", 848.5: "Growth", 3520: "Growth", 3520.5: "Premium"}),
        (PRIORITY_BANDS, {0.0: "LOW", 0.4: "LOW", 0.41: "MEDIUM", 0.7: "MEDIUM", 1.0: "HIGH"}),
    ],
)
def test_bands_include_their_upper_edge(spark, bands, cases):
    assert out(column(spark, map(float, cases)), N.band("x", bands)) == list(cases.values())


@pytest.mark.parametrize(
    ("tiers", "cases"),
    [
        (CUSTOMER_TIERS, {5000: "Platinum", 4999.5: "Gold", 2000: "Gold", 500: "Silver", 499: "Bronze", -1: "Bronze"}),
        (SEVERITY_TIERS, {2000: "CRITICAL", 1999: "HIGH", 1000: "HIGH", 500: "MEDIUM", 1: "LOW"}),
    ],
)
def test_tiers_include_their_lower_edge(spark, tiers, cases):
    assert out(column(spark, map(float, cases)), N.tier("x", tiers)) == list(cases.values())


def test_unknown_counts_as_false_and_nan_never_passes(spark):
    df = column(spark, [200.0, None, float("nan"), 1.0])
    assert out(df, N.flag(N.finite("x") > 180.52)) == [1, 0, 0, 0]
    assert out(df, N.flag(F.col("x") > 180.52)) == [1, 0, 1, 0]  # why NaN is removed on load


def test_pct_below_guards_zero(spark):
    df = spark.createDataFrame([(0, 0.0, 160.99), (1, 148.1182254324392, 160.99), (2, 10.0, 0.0)], "i int, a double, n double")
    assert out(df, N.pct_below("a", F.col("n"))) == [0.0, 8.0, 0.0]


def test_elapsed_days_floor_24_hour_periods(spark):
    df = spark.createDataFrame(
        [
            (0, "2024-01-01 10:00:00", "2024-01-02 09:59:59"),
            (1, "2024-01-01 10:00:00", "2024-01-02 10:00:00"),
            (2, "2024-01-02 10:00:00", "2024-01-02 09:00:00"),
            (3, "2024-01-02 10:00:00", None),
        ],
        "i int, a string, b string",
    ).withColumns({c: F.to_timestamp_ntz(F.col(c)) for c in "ab"})
    assert out(df, D.elapsed_days("a", "b")) == [0, 1, -1, None]


def test_month_helpers(spark):
    df = spark.createDataFrame([(0, "2017-03"), (1, "2018-11")], "i int, ym string")
    assert out(df, D.month_of("ym")) == [3, 11]
    assert out(df, D.month_name(D.month_of("ym"))) == ["March", "November"]


def test_exact_sum_is_correctly_rounded_in_any_order(spark):
    rng = random.Random(7)
    values = [round(rng.uniform(-50, 1000), 2) for _ in range(5000)] + [0.1] * 1000
    want = math.fsum(values)
    for seed in range(3):
        shuffled = column(spark, values).orderBy(F.rand(seed)).repartition(7)
        assert shuffled.agg(A.exact_sum("x")).first()[0] == want


def test_exact_sum_and_mean_of_nothing(spark):
    df = column(spark, [None, None])
    assert df.agg(A.exact_sum("x"), A.exact_mean("x"), A.mean_of_positive("x")).first()[:] == (None, None, 0.0)


def test_exact_sum_keeps_tiny_amounts(spark):
    """Numbers count as they are written: a thousand times 4e-7 is 0.0004."""
    for values in ([4e-7] * 1000, [-4e-7] * 1000, [1e9, 1e-7, -1e9, 3e-7, -12.3456789, 12.3456789]):
        want = float(sum(Decimal(repr(v)) for v in values))
        assert column(spark, values).agg(A.exact_sum("x")).first()[0] == want


def test_exact_sum_skips_what_is_no_number(spark):
    df = column(spark, [1.5, float("nan"), None, 2.0, float("inf"), float("-inf")])
    assert df.agg(A.exact_sum("x"), A.exact_mean("x")).first()[:] == (3.5, 1.75)
    assert column(spark, [float("nan")]).agg(A.exact_sum("x"), A.exact_mean("x")).first()[:] == (None, None)


def test_exact_sum_of_large_totals(spark):
    df = spark.range(1000).select(F.lit(9.5e12).alias("x"))
    assert df.agg(A.exact_sum("x")).first()[0] == 9.5e15


def test_most_frequent_takes_smallest_on_ties_and_skips_null(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, "z"), (2, "z"), (2, "a"), (3, None)], "k int, v string"
    )
    got = dict(df.groupBy("k").agg(A.most_frequent("v")).collect())
    assert got == {1: "a", 2: "z", 3: None}


def test_first_by_skips_null(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 3, "later"), (1, 2, "first")], "k int, o int, v string")
    assert df.groupBy("k").agg(A.first_by("v", "o")).first()[1] == "first"


def test_mean_of_positive_and_share(spark):
    df = spark.createDataFrame([(0, 4.0), (1, 0.0), (2, None), (3, 8.0)], "i int, x double")
    assert df.agg(A.mean_of_positive("x")).first()[0] == 6.0
    assert df.agg(A.pct(F.col("x") > 5)).first()[0] == 25.0


def test_exact_mean_does_not_depend_on_the_order(spark):
    rng = random.Random(9)
    values = [rng.randint(1, 15) / rng.randint(1, 7) for _ in range(4000)]
    got = {
        column(spark, values).orderBy(F.rand(seed)).repartition(5).agg(A.exact_mean("x")).first()[0] for seed in range(3)
    }
    assert len(got) == 1
    assert got.pop() == pytest.approx(math.fsum(values) / len(values), rel=1e-12)
    assert column(spark, [None]).agg(A.exact_mean("x")).first()[0] is None


def test_fill_puts_columns_and_texts_into_a_template(spark):
    from martloom.functions.text import fill

    df = spark.createDataFrame([("SP", 3), (None, 4)], "state string, n int")
    got = [r[0] for r in df.select(fill("In {state}: {n} {what}.", state=F.col("state"), n=F.col("n").cast("string"), what="orders")).collect()]
    assert got == ["In SP: 3 orders.", None]
