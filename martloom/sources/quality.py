"""Input checks: one aggregation per table, violations as data."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.session import scratch_dir, tune
from martloom.sources.raw import BROKEN, normalize_strings


@dataclass(frozen=True)
class Rule:
    """``broken`` holds for a row that violates the rule."""

    name: str
    broken: Column


def not_null(column: str) -> Rule:
    """Neither missing nor blank: loading turns missing text into blank text."""
    blank = F.trim(F.col(column).cast("string")) == ""
    return Rule(f"{column} not null", F.col(column).isNull() | blank)


def readable(table: DataFrame) -> Rule:
    """No line that the declared types could not take; for tables read by ``read_typed``."""
    # all columns take part, as Spark only parses what a query needs
    parsed = F.pmod(F.xxhash64(*[c for c in table.columns if c != BROKEN]), F.lit(2)) >= 0
    return Rule("every line readable", F.col(BROKEN).isNotNull() & parsed)


def not_negative(column: str) -> Rule:
    # a missing amount does not satisfy "at least zero" either
    return Rule(f"{column} not negative", ~F.coalesce(F.col(column) >= 0, F.lit(False)))


def default_rules() -> dict[str, list[Rule]]:
    return {
        "orders": [not_null("order_id"), not_null("customer_id")],
        "order_payments": [not_negative("payment_value")],
        "customers": [],
    }


def dq_report(tables: dict[str, DataFrame], rules: dict[str, list[Rule]] | None = None) -> DataFrame:
    """One row per rule: rows seen, rows that break it, verdict. Every table is also checked for being empty."""
    rules = default_rules() if rules is None else rules
    reports = []
    for table, checks in rules.items():
        checks = [*checks, readable(tables[table])] if BROKEN in tables[table].columns else checks
        counts = tables[table].agg(
            F.count("*").alias("row_count"), *[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(checks)]
        )
        found = [F.struct(F.lit("not empty").alias("rule"), F.when(F.col("row_count") == 0, 1).otherwise(0).cast("bigint").alias("violations"))]
        found += [F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(checks)]
        reports.append(counts.select(F.lit(table).alias("table_name"), "row_count", F.inline(F.array(*found))))
    report = reduce(DataFrame.unionByName, reports)
    return report.withColumn("passed", (F.col("violations") == 0).cast("int"))


def load(
    spark: SparkSession,
    read: Callable[[SparkSession], dict[str, DataFrame]],
    rules: dict[str, list[Rule]] | None = None,
    concurrent: int = 4,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write every input once, repaired, and count what breaks the rules while it is written: gate and load are one scan.

    ``read`` gives the inputs of a session, as ``read_typed`` does, blanks still missing. Returns the stored tables and the rows
    of :func:`dq_report` for the inputs that have rules; see :func:`passed`. The counts are those of the rows written.

    Counting has a session of its own, since one that has observed anything can no longer be part of a task, as some
    fitted models make it.
    """
    rules = default_rules() if rules is None else rules
    folder, counting = f"{scratch_dir(spark)}/load-{uuid.uuid4().hex}", tune(spark.newSession())
    tables = read(counting)

    def write(item: tuple[str, DataFrame]) -> list[tuple]:
        name, df = item
        checks = list(rules.get(name, []))
        if name in rules and BROKEN in df.columns:
            # every column is written, so every line is parsed
            checks.append(Rule("every line readable", F.col(BROKEN).isNotNull()))
        counted = Observation(f"load {name}")
        seen = df.observe(counted, F.count(F.lit(1)).alias("row_count"), *[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(checks)])
        normalize_strings(seen.drop(BROKEN)).write.parquet(f"{folder}/{name}")
        if name not in rules:
            return []
        found = counted.get
        n = found["row_count"]
        broken = [("not empty", int(n == 0)), *((r.name, found[f"r{i}"]) for i, r in enumerate(checks))]
        return [(name, n, rule, count, int(count == 0)) for rule, count in broken]

    with ThreadPoolExecutor(concurrent) as pool:
        by_name = dict(zip(tables, pool.map(write, tables.items()), strict=True))
    stored = {name: spark.read.schema(normalize_strings(df.drop(BROKEN)).schema).parquet(f"{folder}/{name}") for name, df in tables.items()}
    rows = [row for name in rules for row in by_name[name]]
    report = spark.createDataFrame(rows, "table_name string, row_count long, rule string, violations long, passed int")
    return stored, report


def validate(tables: dict[str, DataFrame], rules: dict[str, list[Rule]] | None = None) -> dict[str, int]:
    """Raise on any violation, else return the row count per table (a handful of report rows)."""
    return passed(dq_report(tables, rules))


def passed(report: DataFrame) -> dict[str, int]:
    """The row count per table of a report, or an error that names every violation."""
    report = report.collect()
    failed = [f"{r.table_name}: {r.rule} ({r.violations})" for r in report if not r.passed]
    if failed:
        raise ValueError("data quality: " + "; ".join(failed))
    return {r.table_name: r.row_count for r in report}
