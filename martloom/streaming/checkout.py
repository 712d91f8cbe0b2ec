"""Installment recommendations on a stream of checkout events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from martloom.config import Config
from martloom.plans.ml.installments import score_checkouts

CHECKOUT_SCHEMA = """order_id string, customer_state string, avg_order_value double, total_orders bigint,
    preferred_payment_type string, is_high_value int"""

#: Groups that numbered customers are dealt to.
GROUPS = 1 << 12


def checkout_events(detail: DataFrame, profile: DataFrame) -> DataFrame:
    """One event per order. A customer the profile does not know yet has this first order and is not of high value."""
    known = profile.select("customer_unique_id", "total_orders", "is_high_value")
    return detail.join(known, "customer_unique_id", "left").select(
        "order_id",
        "customer_state",
        F.col("total_payment_value").alias("avg_order_value"),
        F.coalesce("total_orders", F.lit(1).cast("bigint")).alias("total_orders"),
        F.col("payment_type").alias("preferred_payment_type"),
        F.coalesce("is_high_value", F.lit(0)).alias("is_high_value"),
    )


def read_checkouts(spark: SparkSession, folder: str, schema=CHECKOUT_SCHEMA, files_per_batch: int | None = None) -> DataFrame:
    """New event files in a folder; any other streaming source with these columns does as well."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def start_scoring(
    events: DataFrame, model: PipelineModel, out: str, checkpoint: str, cfg: Config = Config(), trigger: dict | None = None
) -> StreamingQuery:
    """Score events as they arrive. Scoring keeps no state."""
    return start_sink(score_checkouts(events, model, cfg), out, checkpoint, trigger)


def numbered_checkouts(
    events: DataFrame, time: str, customer: str = "customer_unique_id", lateness: str = "1 day", groups: int = GROUPS
) -> DataFrame:
    """Each order once, with ``order_number``, its place among the customer's orders that the stream has seen.

    An event of an order that came before is dropped. So is an event whose ``time`` (a timestamp) is more than ``lateness``
    behind the newest one of earlier batches, or missing: it neither counts nor is decided. Per customer the state holds a
    number and the orders that may still come again, those within ``lateness``. Orders of one batch are numbered by time.

    Customers are dealt to ``groups`` by hash. A call of Python numbers a whole group, so that calls do not number as many as
    customers; a group's state is written again when one of its customers comes, so it should hold some dozens of them. The
    number of groups stays as it is for the life of a checkpoint.
    """
    schema = events.schema
    names = schema.names

    def number(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        customers, numbers, owners, orders, times = state.get if state.exists else ([], [], [], [], [])
        seen = dict(zip(customers, numbers, strict=True))
        known = {(customers[i], order): t for i, order, t in zip(owners, orders, times, strict=True)}
        least = state.getCurrentWatermarkMs()
        found = pd.concat(list(frames), ignore_index=True)
        at = found[time].astype("int64") // 1_000_000 if str(found[time].dtype).startswith("datetime64[ns") else found[time].astype("datetime64[ms]").astype("int64")
        found = found.assign(_at=at)[found[time].notna() & (at >= least)]
        found = found.sort_values(["_at", "order_id"], kind="stable").drop_duplicates(["_customer", "_order"])
        order_numbers = []
        for c, order, t in zip(found["_customer"], found["_order"], found["_at"].tolist(), strict=True):
            fresh = (c, order) not in known
            if fresh:
                known[c, order] = t
                seen[c] = seen.get(c, 0) + 1
            order_numbers.append(seen[c] if fresh else 0)
        # what lies behind the watermark is late when it comes again
        kept, place = [(c, order, t) for (c, order), t in known.items() if t >= least], {c: i for i, c in enumerate(seen)}
        state.update((list(seen), list(seen.values()), [place[c] for c, _, _ in kept], [o for _, o, _ in kept], [t for _, _, t in kept]))
        found = found[names].assign(order_number=order_numbers)
        found = found[found["order_number"] > 0]
        if len(found):
            yield found

    out = StructType([*schema.fields, StructField("order_number", LongType())])
    held = "customers array<string>, numbers array<long>, owners array<int>, orders array<string>, times array<long>"

    def text(column: str) -> Column:
        """A key as text; a missing one is a value of its own."""
        return F.coalesce(F.col(column).cast("string"), F.lit("\0"))

    dealt = events.withColumns({"_customer": text(customer), "_order": text("order_id")})
    dealt = dealt.withColumn("_group", F.pmod(F.xxhash64("_customer"), F.lit(groups)))
    grouped = dealt.withWatermark(time, lateness).groupBy("_group")
    return grouped.applyInPandasWithState(number, out, held, "append", GroupStateTimeout.NoTimeout)


def start_sink(scored: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write a stream to files; the sink commits each batch exactly once."""
    return (
        scored.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
