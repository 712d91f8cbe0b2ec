"""Rounding, banding and lookups as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_even(value, places: int = 0) -> Column:
    """Round half to even on the binary value, as array libraries do (0.5 -> 0, 6.45 -> 6.4)."""
    scale = float(10**places)
    return F.rint(as_col(value) * scale) / scale


def one_decimal(value) -> Column:
    """Text of a non-negative number with one decimal, rounded on its exact binary value.

    ``value * 10`` may land on a tie that the true product misses by less than one unit in
    the last place. The product is split into two exact parts, so the lost part is known
    and decides the tie.
    """
    v = as_col(value).cast("double")
    scaled = v * 10.0
    lost = v * 2.0 - (scaled - v * 8.0)
    tie = (scaled - F.floor(scaled)) == 0.5
    tenths = (
        F.when(tie & (lost > 0), F.ceil(scaled))
        .when(tie & (lost < 0), F.floor(scaled))
        .otherwise(F.rint(scaled).cast("bigint"))
    )
    return F.format_string("%d.%d", F.floor(tenths / 10).cast("bigint"), F.pmod(tenths, F.lit(10)).cast("bigint"))


def band(value, bands) -> Column:
    """First label whose upper edge is not below ``value``; a ``None`` edge takes the rest."""
    v = as_col(value)
    out = None
    for edge, label in bands:
        if edge is None:
            return out.otherwise(label)
        out = F.when(v <= edge, label) if out is None else out.when(v <= edge, label)
    return out


def tier(value, tiers) -> Column:
    """First label whose lower edge ``value`` reaches; the last label takes the rest."""
    v = as_col(value)
    out = None
    for edge, label in tiers[:-1]:
        out = F.when(v >= edge, label) if out is None else out.when(v >= edge, label)
    return out.otherwise(tiers[-1][1])


def lookup(key, table: dict, default=None) -> Column:
    """Constant dictionary as a ``CASE``; stays inside generated code."""
    k = as_col(key)
    out = None
    for name, value in table.items():
        out = F.when(k == name, value) if out is None else out.when(k == name, value)
    return out if default is None else out.otherwise(default)


def is_true(condition: Column) -> Column:
    """A condition where unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def flag(condition: Column) -> Column:
    """0/1 flag; unknown counts as 0."""
    return is_true(condition).cast("int")


def blank_to_unknown(value) -> Column:
    """NULL or blank text becomes ``unknown``."""
    v = as_col(value)
    return F.when(v != "", v).otherwise("unknown")


def pct_below(local, reference) -> Column:
    """Percent by which ``local`` lies below ``reference``, 2 decimals; 0 where either is 0."""
    loc, ref = as_col(local), as_col(reference)
    return F.when((ref == 0) | (loc == 0), F.lit(0.0)).otherwise(
        half_even((ref - loc) / F.nullif(ref, F.lit(0.0)) * 100, 2)
    )


def finite(value) -> Column:
    """NaN and infinite become NULL: Spark orders NaN above every number, which would pass any threshold."""
    v = as_col(value).cast("double")
    return F.when(F.abs(v) < float("inf"), v)
