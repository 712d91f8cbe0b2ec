"""Mart tables: publish with declared types, read back, export."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.keys import ensure_columns, latest_by_key
from martloom.schemas import mart_keys, mart_schema
from martloom.sources.raw import normalize_strings, read_csv


def publish(df: DataFrame, name: str, updated_at: Column | None = None) -> DataFrame:
    """Columns in declared order with declared numeric types, stamped with ``updated_at``.

    Key columns keep the type of the input: some sources use numeric ids.
    """
    typed = []
    for field in mart_schema(name).fields:
        c = F.col(field.name)
        typed.append(c if field.dataType.simpleString() == "string" else c.cast(field.dataType))
    stamp = F.current_timestamp() if updated_at is None else updated_at
    return df.select(*[c.alias(f.name) for c, f in zip(typed, mart_schema(name).fields)], stamp.alias("updated_at"))


def write_mart(df: DataFrame, name: str, folder: str) -> DataFrame:
    """Full refresh of one mart; running it again gives the same table."""
    path = f"{folder.rstrip('/')}/{name}"
    publish(df, name).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, folder: str, key: str, buckets: int, database: str | None = None) -> DataFrame:
    """Full refresh as a table bucketed and sorted by ``key``; tables with equal buckets join without a shuffle.

    Rows are dealt by the key first, so that each bucket is one file. ``database`` keeps the tables of different
    folders apart in the catalog.
    """
    spark = df.sparkSession
    table = f"{database}.{name}" if database else name
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    publish(df, name).repartition(buckets, key).write.mode("overwrite").option(
        "path", f"{folder.rstrip('/')}/{name}"
    ).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


#: Orders versions that carry the same stamp.
BATCH = "_batch"


def append_version(df: DataFrame, name: str, folder: str, updated_at: Column | None = None) -> None:
    """Add a newer version of some rows; :func:`read_latest` decides which one counts.

    Each call writes its batch number, one above the greatest there is. One writer at a time.
    """
    path = f"{folder.rstrip('/')}/{name}"
    spark = df.sparkSession
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    last = stored.agg(F.max(BATCH)).first()[0] if BATCH in stored.columns else None
    batch = F.lit((last or 0) + 1).alias(BATCH)
    publish(df, name, updated_at).select("*", batch).write.mode("append").parquet(path)


def read_latest(spark: SparkSession, name: str, folder: str, defaults: dict | None = None) -> DataFrame:
    """Latest version per key, of equal stamps the one appended last; files written before a column existed get its default."""
    stored = spark.read.option("mergeSchema", "true").parquet(f"{folder.rstrip('/')}/{name}")
    stored = ensure_columns(stored, {BATCH: 0}).na.fill(0, subset=[BATCH])
    current = latest_by_key(stored, mart_keys(name), [F.desc("updated_at"), F.desc(BATCH)]).drop(BATCH)
    current = ensure_columns(current, defaults or {})
    return current.na.fill(defaults) if defaults else current


def read_mart_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A mart exported as CSV, columns matched by header name."""
    schema = mart_schema(name)
    seen = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType.simpleString() for f in schema.fields} | {"updated_at": "timestamp_ntz"}
    # integers may have been exported as 1.0; read as text, cast below
    ddl = ", ".join(f"`{c}` string" for c in seen)
    text = read_csv(spark, path, ddl)

    def typed(c: str) -> Column:
        kind = types.get(c, "string")
        if kind in ("int", "bigint"):
            return F.col(c).cast("double").cast(kind).alias(c)
        return F.col(c).cast(kind).alias(c)

    return normalize_strings(text.select(*[typed(c) for c in seen]))


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV; list columns are written as ``[1, 2]``."""
    plain = [
        F.concat(F.lit("["), F.array_join(F.col(f.name).cast("array<string>"), ", "), F.lit("]")).alias(f.name)
        if f.dataType.typeName() == "array"
        else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*plain).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def parquet_writer(folder: str) -> Callable[[DataFrame, str], None]:
    return lambda df, name: df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def jdbc_writer(url: str, schema: str, properties: dict, partitions: int = 16) -> Callable[[DataFrame, str], None]:
    """Replace the table in a relational database; ``partitions`` bounds the open connections."""

    def write(df: DataFrame, name: str) -> None:
        # numPartitions is the writer's own bound; what computes the rows keeps its parallelism
        df.write.option("numPartitions", partitions).mode("overwrite").jdbc(url, f"{schema}.{name}", properties=properties)

    return write


def export_marts(marts: Iterable[tuple[str, DataFrame]], writer: Callable[[DataFrame, str], None]) -> list[str]:
    done = []
    for name, df in marts:
        writer(df, name)
        done.append(name)
    return done
