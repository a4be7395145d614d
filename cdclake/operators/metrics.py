"""Latency statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: text format of event times, in UTC.
EVENT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def event_millis(column: Column) -> Column:
    """Epoch milliseconds of an event time text, null if it cannot be read."""
    return F.unix_millis(F.try_to_timestamp(F.concat(column, F.lit("Z")), F.lit(EVENT_TIME + "XXX")))


def observed_times(column: str) -> list[Column]:
    """What :func:`observed_latency` needs to know of event times, for an observation of a write."""
    millis = event_millis(F.col(column))
    return [
        F.min(millis).alias("first"), F.max(millis).alias("last"), F.sum(millis).alias("sum"),
        F.count(millis).alias("readable"), F.count(F.col(column)).alias("total_count"),
    ]


def observed_latency(seen: dict, now_ms: int) -> dict[str, int]:
    """:func:`latency_stats` from what a write has seen of event times."""
    if not seen["readable"]:
        return {"minimum": 0, "maximum": 0, "sum": 0, "total_count": 0}
    return {
        "minimum": now_ms - seen["last"], "maximum": now_ms - seen["first"],
        "sum": seen["readable"] * now_ms - seen["sum"], "total_count": seen["total_count"],
    }


def latency_stats(df: DataFrame, column: str, now_ms: int, *also: Column) -> DataFrame:
    """One row ``minimum, maximum, sum, total_count`` of ``now - event time`` in milliseconds.

    ``total_count`` counts non-null event times, readable or not. All four are 0 when no event
    time can be read. ``also`` lists further aggregates of the same pass.
    """
    latency = F.lit(now_ms).cast("long") - event_millis(F.col(column))
    stats = df.agg(
        F.min(latency).alias("minimum"),
        F.max(latency).alias("maximum"),
        F.sum(latency).alias("sum"),
        F.count(F.col(column)).alias("total_count"),
        *also,
    )
    zero = F.lit(0).cast("long")
    readable = F.col("minimum").isNotNull()
    names, others = stats.columns[:4], stats.columns[4:]
    return stats.select(*[F.when(readable, F.col(c)).otherwise(zero).alias(c) for c in names], *others)
