"""Aggregate expressions; all of them combine before the shuffle, so a hot group stays small."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.numbers import as_col, finite

def decimal_sum(value) -> Column:
    """The sum of ``value`` as decimal(38,12): every number counts as it is written, to 12 places.

    Adding decimals is exact, so the sum does not depend on the order partial sums arrive in, and sums of sums are the
    sum. NaN, infinite and missing values are skipped. A total of 1e26 or more raises an error.
    """
    return F.sum(finite(value).cast("decimal(38,12)"))


def exact_sum(value) -> Column:
    """Sum that does not depend on the order partial sums arrive in; NULL where there is nothing to add.

    A plain double sum can change in its last digit when a task is retried or a shuffle
    is read in another order; a threshold taken from one pass would then misjudge the
    customer sitting exactly on it in the next.
    """
    return decimal_sum(value).cast("double")


def exact_mean(value) -> Column:
    """Mean over the values that are numbers, NULL where there are none."""
    return exact_sum(value) / F.nullif(F.count(finite(value)), F.lit(0))


def share(condition: Column) -> Column:
    """Share of rows for which ``condition`` holds; unknown counts as no."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))


def pct(condition: Column) -> Column:
    return share(condition) * 100


def mean_of_positive(value) -> Column:
    v = as_col(value)
    return F.coalesce(F.avg(F.when(v > 0, v)), F.lit(0.0))


def most_frequent(value) -> Column:
    """Most frequent non-null value, the smallest one on ties."""
    return F.mode(as_col(value), True)


def first_by(value, order) -> Column:
    """First non-null value in the given order."""
    v = as_col(value)
    return F.min_by(v, F.when(v.isNotNull(), as_col(order)))
