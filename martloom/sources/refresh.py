"""Marts by month, of which only the months are rebuilt that new files touch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.dates import year_month
from martloom.schemas import mart_schema
from martloom.sources.marts import publish

MONTH = "year_month"
Months = list[str | None]


def newest_file(*tables: DataFrame) -> dt.datetime | None:
    """When the youngest file of these tables was written; they must be read from files. Only listings are read."""
    found = [t.agg(F.max("_metadata.file_modification_time")).first()[0] for t in tables]
    return max((f for f in found if f is not None), default=None)


def since(moment: dt.datetime | None) -> Column:
    """Rows of files written after ``moment``; all rows without one."""
    return F.lit(True) if moment is None else F.col("_metadata.file_modification_time") > F.lit(moment)


def months_of(rows: DataFrame, time: str) -> Months:
    """The different months of ``rows``, a list that grows with the years and not with the rows."""
    return [r[0] for r in rows.select(year_month(time).alias(MONTH)).distinct().collect()]


def changed_order_months(orders: DataFrame, linked: list[DataFrame], moment: dt.datetime | None) -> Months:
    """Months of orders in new files, and of orders that new files of ``linked`` tables (by order_id) speak of.

    Without a moment all files are new, orders among them, so the linked ones cannot add a month.
    """
    own = orders.where(since(moment)).select("order_id", "order_purchase_timestamp")
    if moment is not None and linked:
        new = reduce(DataFrame.unionByName, [table.where(since(moment)).select("order_id") for table in linked])
        own = own.unionByName(orders.select("order_id", "order_purchase_timestamp").join(new.distinct(), "order_id", "left_semi"))
    return months_of(own, "order_purchase_timestamp")


def in_months(time: str, months: Months) -> Column:
    """Rows of these months; an unknown time is a month of its own."""
    month = year_month(time)
    named = [m for m in months if m is not None]
    wanted = month.isin(*named) if named else F.lit(False)
    return F.coalesce(wanted, F.lit(False)) | (month.isNull() if None in months else F.lit(False))


def write_months(df: DataFrame, name: str, folder: str) -> None:
    """Replace the months that ``df`` has; files of other months stay as they are."""
    out = publish(df, name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH)
    out.parquet(f"{folder.rstrip('/')}/{name}")


def read_months(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """The whole mart, columns in declared order."""
    schema = mart_schema(name)
    stored = spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}")
    return stored.select(*schema.names)


def refresh_months(name: str, folder: str, months: Months, build: Callable[[Months], DataFrame]) -> Months:
    """Build and write these months of a mart; months without rows now keep what they have. Returns the months."""
    if months:
        write_months(build(months), name, folder)
    return months
