"""Primary-key projection and comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.contracts import TableContract
from cdclake.functions.columns import any_null, quoted


def key_projection(df: DataFrame, contract: TableContract) -> DataFrame:
    return df.select(*[quoted(k) for k in contract.keys])


def key_counts(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Rows per key on both sides that have no partner: ``keys, only_a, only_b``.

    One aggregation over both sides: partial counts are built before the shuffle, so repeated and
    skewed keys are cheap, and no join is needed. A null key never has a partner.
    """
    columns = [quoted(k) for k in keys]
    both = a.select(*columns, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(*columns, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    alone = any_null(keys)
    return (
        both.groupBy(*columns)
        .agg(F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b"))
        .select(
            *columns,
            F.when(alone | (F.col("in_b") == 0), F.col("in_a")).otherwise(0).alias("only_a"),
            F.when(alone | (F.col("in_a") == 0), F.col("in_b")).otherwise(0).alias("only_b"),
        )
        .where((F.col("only_a") > 0) | (F.col("only_b") > 0))
    )


#: Ranges that keys are divided into at each level of a comparison by digests, as bits of their hash.
_LEVELS = (10, 10)
_NULL_RANGE = -1


def in_differing_ranges(a: DataFrame, b: DataFrame, keys, levels: tuple[int, ...] = _LEVELS) -> tuple[DataFrame, DataFrame]:
    """Keys of both sides that :func:`key_counts` has to look at: those in hash ranges that are not alike.

    Each side is reduced to a count and a digest, which no order changes, of each range; ranges whose digests are
    equal hold the same keys. Those that differ are divided again, level by level. Only keys of ranges that differ on
    the last level are shuffled. A level has at most 2^10 rows for each range that differed before, which are
    broadcast; equal sides move nothing but their digests. Null keys never have a partner, so they always stay.
    """
    columns = [quoted(k) for k in keys]
    kinds = a.select(*columns).limit(0).unionByName(b.select(*columns).limit(0)).schema
    sides = [df.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields]) for df in (a, b)]
    place, bits = F.xxhash64(*columns, F.lit(1)), 0
    for more in levels:
        bits += more
        number = F.when(any_null(keys), F.lit(_NULL_RANGE)).otherwise(place.bitwiseAND(F.lit((1 << bits) - 1)))
        sides = [df.withColumn("__range", number) for df in sides]
        first, second = (_range_digests(df, columns, side) for df, side in zip(sides, "ab", strict=True))
        same = (F.col("n_a") == F.col("n_b")) & (F.col("low_a") == F.col("low_b")) & (F.col("high_a") == F.col("high_b"))
        differ = first.join(second, "__range", "full_outer").where(~F.coalesce(same, F.lit(False)) | (F.col("__range") == _NULL_RANGE))
        wanted = F.broadcast(differ.select("__range"))
        sides = [df.join(wanted, "__range", "left_semi").drop("__range") for df in sides]
    return sides[0], sides[1]


def _range_digests(df: DataFrame, columns, side: str) -> DataFrame:
    # Sums of both halves of a hash of its own: no overflow below 2^31 rows a range, and repeated keys count.
    digest, half = F.xxhash64(*columns, F.lit(2)), F.lit((1 << 32) - 1)
    return df.groupBy("__range").agg(
        F.count(F.lit(1)).alias(f"n_{side}"), F.sum(digest.bitwiseAND(half)).alias(f"low_{side}"),
        F.sum(F.shiftrightunsigned(digest, 32)).alias(f"high_{side}"),
    )


def key_diff(a: DataFrame, b: DataFrame, keys, table: str) -> DataFrame:
    """One row: rows whose key is only in ``a`` and only in ``b``."""
    return (
        key_counts(a, b, keys)
        .agg(
            F.coalesce(F.sum("only_a"), F.lit(0)).alias("only_a"),
            F.coalesce(F.sum("only_b"), F.lit(0)).alias("only_b"),
        )
        .select(F.lit(table).alias("table"), "only_a", "only_b")
    )


def key_sample(a: DataFrame, b: DataFrame, keys, n: int = 20) -> DataFrame:
    """Some of the mismatching keys, for a report."""
    return key_counts(a, b, keys).limit(n)


def key_report(diffs: list[DataFrame]) -> DataFrame:
    """All tables' key differences with a verdict per table.

    Without any table the report has no rows, which :func:`cdclake.operators.reconcile.check_result`
    reports as a failed check; otherwise the check passes if no table has a difference.
    """
    spark = SparkSession.active()
    rows = reduce(DataFrame.unionByName, diffs, spark.createDataFrame([], "table string, only_a long, only_b long"))
    return rows.withColumn("matches", (F.col("only_a") == 0) & (F.col("only_b") == 0))
