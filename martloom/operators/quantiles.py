"""Exact interpolated quantiles without collecting the values anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from martloom.operators.sketches import merge_quantiles, quantile_sketches

#: Equal widths into which a bracket is cut when it is narrowed; so many rows per group are sorted at once.
_BINS = 4096

# v: the values; s: one row per group. Without groups s is a scalar subquery, which every
# task sees as a constant; with groups s is joined, and Spark's size check picks how.
_START = """
WITH v AS (SELECT {keys} CAST({value} AS DOUBLE) AS x FROM {{rows}} WHERE {value} IS NOT NULL),
sketch AS (
  SELECT {keys} count(*) AS n, min(x) AS low, max(x) AS high,
         percentile_approx(x, array({q_low}D, {q_high}D), {accuracy}) AS b, (count(*) - 1) * {q}D AS position
  FROM v {group}
),
bracket AS (
  SELECT {keys} n, low, high, CAST(floor(position) AS BIGINT) AS r, position - floor(position) AS t, b[0] AS lo, b[1] AS hi
  FROM sketch
),
counted AS (
  SELECT {keys} any_value(struct(n, r, t, low, high, lo, hi)) AS s, count_if(x < lo) AS below, count_if(x <= hi) AS upto
  FROM {v_with_bracket} {group}
),
level0 AS (
  SELECT {keys} s.n, s.r, s.t, if(holds, s.lo, s.low) AS lo, if(holds, s.hi, s.high) AS hi, if(holds, below, 0) AS below
  FROM (SELECT *, below <= s.r AND upto >= least(s.r + 2, s.n) AS holds FROM counted)
)"""
_NARROW = """,
bins{k} AS (
  SELECT {keys} bin, count(*) AS c, min(x) AS a, max(x) AS z, any_value(struct(n, r, t, below)) AS s
  FROM (SELECT *, if(hi > lo, CAST(least({bins} - 1, floor((x - lo) / (hi - lo) * {bins})) AS INT), 0) AS bin
        FROM {v_with_before} WHERE x BETWEEN lo AND hi)
  GROUP BY {keys} bin
),
sums{k} AS (SELECT *, s.below + sum(c) OVER ({partition} ORDER BY bin) AS upto FROM bins{k}),
level{k} AS (
  SELECT {keys} max(s.n) AS n, max(s.r) AS r, max(s.t) AS t,
         max(if(upto - c <= s.r AND s.r < upto, a, NULL)) AS lo,
         max(if(upto - c <= least(s.r + 1, s.n - 1) AND least(s.r + 1, s.n - 1) < upto, z, NULL)) AS hi,
         max(if(upto - c <= s.r AND s.r < upto, upto - c, NULL)) AS below
  FROM sums{k} {group}
)"""
_END = """,
inside AS (
  SELECT {keys} x, any_value(struct(n, r, t, below)) AS s, count(*) AS c FROM {v_with_last} WHERE x BETWEEN lo AND hi
  GROUP BY {keys} x
),
ranked AS (SELECT *, s.below + sum(c) OVER ({partition} ORDER BY x) AS upto FROM inside),
found AS (
  SELECT {keys} max(s.t) AS t,
         max(if(upto - c <= s.r AND s.r < upto, x, NULL)) AS a,
         max(if(upto - c <= least(s.r + 1, s.n - 1) AND least(s.r + 1, s.n - 1) < upto, x, NULL)) AS z
  FROM ranked {group}
)
SELECT {keys} a + (z - a) * t AS {name} FROM found
"""


def exact_quantile(
    df: DataFrame, value: str, q: float, by: Sequence[str] = (), name: str = "quantile", accuracy: int = 10_000, levels: int = 2
) -> DataFrame:
    """Exact ``q`` quantile with linear interpolation; one row, or one per group in ``by``.

    The built-in exact percentile holds every distinct value of a group in one buffer.
    Here a sketch brackets the wanted rank and a count verifies it; should it miss, the
    bracket is the full range. ``levels`` times the bracket is then cut into equal widths,
    the values in each counted, and the widths around the rank kept, so that what is left
    to sort is a small part of a ten-thousandth, whatever the number of rows. Every step
    is exact for any data. The quantile of NaN values is not defined; ``finite`` drops them.
    """
    margin = 2.0 / accuracy
    keys = ", ".join(by)

    def v_with(side: str) -> str:
        if by:
            return f"(SELECT * FROM v JOIN {side} USING ({keys}))"
        return f"(SELECT x, g.* FROM (SELECT x, (SELECT struct(*) FROM {side}) AS g FROM v))"

    fixed = {
        "keys": f"{keys}," if by else "",
        "value": value,
        "q": float(q),
        "q_low": max(q - margin, 0.0),
        "q_high": min(q + margin, 1.0),
        "accuracy": accuracy,
        "bins": _BINS,
        "group": f"GROUP BY {keys}" if by else "",
        "partition": f"PARTITION BY {keys}" if by else "",
        "name": name,
    }
    query = _START.format(**fixed, v_with_bracket=v_with("bracket"))
    for k in range(1, levels + 1):
        query += _NARROW.format(**fixed, k=k, v_with_before=v_with(f"level{k - 1}"))
    query += _END.format(**fixed, v_with_last=v_with(f"level{levels}"))
    return df.sparkSession.sql(query, rows=df)


def quantile(df: DataFrame, value: str, q: float, by: Sequence[str] = (), name: str = "quantile", sketch: int | None = None) -> DataFrame:
    """The exact quantile, or with ``sketch`` (a size) the one of a sketch: one pass, rank error as :func:`rank_error` says."""
    if sketch is None:
        return exact_quantile(df, value, q, by, name)
    found = merge_quantiles(quantile_sketches(df, value, by, sketch), {name: q}, by, sketch)
    return found.select(*by, name)
