"""Counts of rows and changes in several stores, and their comparison within tolerances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdclake.contracts import DELETE, INSERT, OP, UPDATE
from cdclake.functions.columns import all_of, equal_within

_COUNTS = ("inserts", "updates", "deletes")

# Verdicts of a comparison.
MATCH = "MATCH"
WITHIN = "MATCH (within tolerance)"
MISMATCH = "MISMATCH"
NO_MATCH = "DOES NOT MATCH"

STATE_COUNTS = "current_state_counts"
CHANGE_COUNTS = "change_data_counts"
KEY_CHECK = "primary_key_reconciliation"
DEFAULT_CHECKS = (STATE_COUNTS, CHANGE_COUNTS)


# --- counts -----------------------------------------------------------------------------------

def count_by_op(changes: DataFrame, table: str | Column) -> DataFrame:
    """Inserts, updates and deletes per table in one pass; other operations are not counted.

    ``table`` is a column of a scan over several tables, or the name of the one table scanned.
    """
    op = F.col(OP)
    counts = [
        F.count_if(op == code).alias(name)
        for name, code in zip(_COUNTS, (INSERT, UPDATE, DELETE))
    ]
    if isinstance(table, Column):
        return changes.groupBy(table.alias("table")).agg(*counts)
    return changes.agg(*counts).select(F.lit(table).alias("table"), *_COUNTS)


def unknown_ops(changes: DataFrame, most: int = 20) -> DataFrame:
    """Operations that no count includes, the most frequent ones, for a report."""
    op = F.col(OP)
    other = changes.where(op.isNull() | ~op.isin(INSERT, UPDATE, DELETE))
    return other.groupBy(OP).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), OP).limit(most)


def no_changes(spark: SparkSession, table: str) -> DataFrame:
    """Counts of a table without any change files."""
    zeros = [F.lit(0).cast("long").alias(n) for n in _COUNTS]
    return spark.range(1).select(F.lit(table).alias("table"), *zeros)


def combine_counts(*counts: DataFrame) -> DataFrame:
    """Counts of several stores added up per table, such as raw files and their archive."""
    if not counts:
        raise ValueError("There are no counts to combine")
    rows = reduce(DataFrame.unionByName, counts)
    return rows.groupBy("table").agg(*[F.sum(n).alias(n) for n in _COUNTS])


def stats_counts(stats: DataFrame, tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(read, applied) change counts from replication statistics.

    ``stats`` has one row per replication task and source table: ``table_name, full_load_rows,
    inserts, updates, deletes, applied_inserts, applied_updates, applied_deletes``. ``tables`` holds
    the ``source, table`` pairs to report; the schema named in the statistics is not the source.
    Several tasks for one table are added up, unknown tables skipped.
    """
    known = stats.withColumn("table_name", F.lower("table_name")).join(
        tables.select("source", F.col("table").alias("table_name")).distinct(), "table_name"
    )
    named = known.withColumn("table", F.concat_ws(".", "source", "table_name"))

    def side(prefix: str) -> DataFrame:
        return named.groupBy("table").agg(
            F.sum(F.col(f"{prefix}inserts") + F.col("full_load_rows")).alias("inserts"),
            F.sum(f"{prefix}updates").alias("updates"),
            F.sum(f"{prefix}deletes").alias("deletes"),
        )

    return side(""), side("applied_")


def store_count(df: DataFrame | None, table: str, store: str, spark: SparkSession) -> DataFrame:
    """``table, store, n`` of one store; a store that could not be read (None) counts as 0."""
    if df is None:
        counted = spark.range(1).select(F.lit(0).cast("long").alias("n"))
    else:
        counted = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.lit(table).alias("table"), F.lit(store).alias("store"), "n")


def state_counts(counts: list[DataFrame]) -> DataFrame:
    """One row per table with the counts of its four stores.

    A store without a count row was skipped and is null, which only the mirror may be.
    """
    rows = reduce(DataFrame.unionByName, counts)

    def of(store: str) -> Column:
        return F.max(F.when(F.col("store") == store, F.col("n")))

    return rows.groupBy("table").agg(
        F.coalesce(of("source"), F.lit(0)).alias("source"),
        F.coalesce(of("structured"), F.lit(0)).alias("structured"),
        F.coalesce(of("curated"), F.lit(0)).alias("curated"),
        of("mirror").alias("mirror"),
    )


# --- reports ----------------------------------------------------------------------------------

def _verdict(exact: Column, close: Column, otherwise: str) -> list[Column]:
    return [
        F.coalesce(close, F.lit(False)).alias("matches"),
        F.when(exact, F.lit(MATCH)).when(close, F.lit(WITHIN)).otherwise(F.lit(otherwise)).alias("verdict"),
    ]


def state_report(counts: DataFrame, absolute: int = 0, relative: float = 0.0) -> DataFrame:
    """Do structured, source and mirror counts agree with the curated count?"""
    curated = F.col("curated")

    def agree(same) -> Column:
        mirror = F.col("mirror").isNull() | same(F.col("mirror"), curated)
        return same(F.col("structured"), curated) & same(F.col("source"), curated) & mirror

    exact = agree(lambda a, b: a == b)
    close = agree(lambda a, b: equal_within(a, b, absolute, relative))
    return counts.select("table", "source", "structured", "curated", "mirror", *_verdict(exact, close, MISMATCH))


def change_report(raw: DataFrame, read: DataFrame, applied: DataFrame,
                  absolute: int = 0, relative: float = 0.0) -> DataFrame:
    """Do change counts agree between raw files, changes read and changes applied?

    A table missing on any side does not match; ``missing_in_raw`` and ``missing_in_read`` say so.
    """
    sides = {"raw": raw, "read": read, "applied": applied}
    joined = reduce(
        lambda a, b: a.join(b, "table", "full_outer"),
        [
            df.select("table", *[F.col(n).alias(f"{side}_{n}") for n in _COUNTS], F.lit(True).alias(f"in_{side}"))
            for side, df in sides.items()
        ],
    )
    pairs = [(f"{a}_{n}", f"{b}_{n}") for n in _COUNTS for a, b in (("raw", "read"), ("read", "applied"))]
    everywhere = all_of([F.col(f"in_{s}").isNotNull() for s in sides])
    exact = everywhere & all_of([F.col(a) == F.col(b) for a, b in pairs])
    close = everywhere & all_of([equal_within(F.col(a), F.col(b), absolute, relative) for a, b in pairs])
    return joined.select(
        "table",
        *[f"{side}_{n}" for side in sides for n in _COUNTS],
        F.col("in_raw").isNull().alias("missing_in_raw"),
        F.col("in_read").isNull().alias("missing_in_read"),
        *_verdict(exact, close, NO_MATCH),
    )


def check_result(report: DataFrame, check: str) -> DataFrame:
    """``check, ok, tables, failing`` of a report with a ``matches`` column.

    A key check over no tables fails, the other checks pass.
    """
    return report.agg(
        F.coalesce(F.bool_and("matches"), F.lit(check != KEY_CHECK)).alias("ok"),
        F.count(F.lit(1)).alias("tables"),
        F.count_if(~F.col("matches")).alias("failing"),
    ).select(F.lit(check).alias("check"), "ok", "tables", "failing")


def overall_result(results: list[DataFrame]) -> DataFrame:
    """``ok, failing_checks`` over all check results."""
    return reduce(DataFrame.unionByName, results).agg(
        F.bool_and("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failing_checks")
    )


def with_overall(spark: SparkSession, results: list[DataFrame]) -> DataFrame:
    """All check results, each with the verdict over all of them; checks are few, rows as many."""
    empty = spark.createDataFrame([], "check string, ok boolean, tables long, failing long")
    rows = reduce(lambda a, b: a.unionByName(b.select(*empty.columns)), results, empty)
    return rows.withColumn("overall", F.bool_and("ok").over(Window.partitionBy(F.lit(1))))
