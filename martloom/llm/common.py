"""What the operators share: reading tables, intermediate tables, columns of the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import cut, ship_package, tune

#: Rows and bytes of one Arrow batch; with texts of up to megabytes a batch has to stay small.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def prepared(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns the text operators read; a NULL text is an empty one."""
    prepared(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def text_digest() -> Column:
    """Tells the texts of rows apart; a NULL text is an empty one."""
    return F.md5(F.coalesce("text", F.lit("")))


__all__ = ["cut", "id_and_text", "prepared", "table", "text_digest"]
