"""Key-wise operators: versions, membership, schema evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from martloom.config import COMPLETED_STATUSES


def completed(orders: DataFrame) -> DataFrame:
    """Orders that count as sales."""
    return orders.where(F.col("order_status").isin(*COMPLETED_STATUSES))


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter is applied before the shuffle as well, so each task sends at most
    one row per key however many versions a key has.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_version", F.row_number().over(w)).where("_version = 1").drop("_version")


def exists_flag(df: DataFrame, keys: DataFrame, on: str, name: str) -> DataFrame:
    """Add a 0/1 column telling whether the row's key occurs in ``keys``."""
    marks = keys.select(on).distinct().withColumn(name, F.lit(1))
    return df.join(marks, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


#: Words of 64 bits in which :func:`may_occur` marks keys.
_WORDS = 1 << 19


def may_occur(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows whose key occurs in ``keys``, and a few others: thins the large side of an inner join before it moves.

    Every key sets one of 2^25 bits, which are sent to all tasks, some MB however many keys there are; half of the
    others pass at 23 million different keys, all of them at many times that. Keys of different or other types (numbers
    may be equal and hash differently) thin nothing. Rows without a key may be missing, as an inner join has none.
    """
    kind = df.schema[on].dataType
    if kind != keys.schema[on].dataType or kind not in (IntegerType(), LongType(), StringType()):
        return df
    slot = F.pmod(F.xxhash64(on), F.lit(64 * _WORDS))
    word, bit = F.shiftright(slot, 6).alias("_word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("_bit")
    marks = keys.select(word, bit).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    marked = df.select("*", word, bit).join(F.broadcast(marks), "_word")
    return marked.where(F.getbit("_bits", "_bit") == 1).select(*df.columns)


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add the columns an older table lacks, filled with their defaults."""
    missing = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df
