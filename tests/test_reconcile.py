import math

import pytest
from helpers import CONTRACT, changes, state, ts
from pyspark.sql import functions as F

from cdclake.functions.columns import check_tolerance, equal_within
from cdclake.operators import keys as kk
from cdclake.operators import reconcile as rec
from cdclake.operators.fields import declared_fields, field_diff, observed_fields
from cdclake.operators.metrics import latency_stats


@pytest.mark.parametrize(
    "a, b, absolute, relative, expected",
    [
        (5, 5, 0, 0.0, True), (5, 6, 0, 0.0, False), (5, 6, 1, 0.0, True), (6, 5, 1, 0.0, True),
        (100, 90, 0, 0.1, True), (90, 100, 0, 0.1, True), (100, 89, 0, 0.1, False), (100, 89, 11, 0.1, True),
        (0, 0, 0, 0.0, True), (0, 10, 0, 1.0, True), (0, 1, 0, 0.5, False),
    ],
)
def test_tolerance(spark, a, b, absolute, relative, expected):
    row = spark.range(1).select(equal_within(F.lit(a), F.lit(b), absolute, relative).alias("x")).first()
    assert row.x is expected


@pytest.mark.parametrize("absolute, relative", [(-1, 0.0), (0, -0.1), (0, 1.1), (0, math.nan)])
def test_bad_tolerances(absolute, relative):
    with pytest.raises(ValueError):
        check_tolerance(absolute, relative)


def test_negative_counts_fail(spark):
    bad = spark.range(1).select(equal_within(F.col("id") - 1, F.col("id")))
    with pytest.raises(Exception, match="negative"):
        bad.collect()


def test_counts_by_operation(spark):
    rows = changes(spark, (1, "a", "I", "1"), (2, "a", "I", "2"), (3, "a", "D", "3"), (4, "a", "X", "4"), (5, "a", None, "5"))
    counts = rec.count_by_op(rows, "s.t")
    assert state(counts, *counts.columns) == [("s.t", 2, 0, 1)]
    both = rec.combine_counts(counts, rec.no_changes(spark, "s.u").unionByName(counts))
    assert state(both, *both.columns) == [("s.t", 4, 0, 2), ("s.u", 0, 0, 0)]


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), "table string, inserts long, updates long, deletes long")


def test_change_report(spark):
    raw = counts(spark, ("same", 1, 2, 3), ("near", 100, 0, 0), ("far", 100, 0, 0), ("raw only", 1, 1, 1), ("no applied", 1, 1, 1))
    read = counts(spark, ("same", 1, 2, 3), ("near", 101, 0, 0), ("far", 110, 0, 0), ("read only", 1, 1, 1), ("no applied", 1, 1, 1))
    applied = counts(spark, ("same", 1, 2, 3), ("near", 101, 0, 0), ("far", 100, 0, 0), ("read only", 1, 1, 1))
    report = rec.change_report(raw, read, applied, absolute=2)
    assert state(report, "table", "verdict", "matches", "missing_in_raw", "missing_in_read") == [
        ("far", "DOES NOT MATCH", False, False, False),
        ("near", "MATCH (within tolerance)", True, False, False),
        ("no applied", "DOES NOT MATCH", False, False, False),
        ("raw only", "DOES NOT MATCH", False, False, True),
        ("read only", "DOES NOT MATCH", False, True, False),
        ("same", "MATCH", True, False, False),
    ]


def test_state_report(spark):
    data = [("ok", 5, 5, 5, 5), ("skipped", 5, 5, 5, None), ("near", 5, 6, 5, 5), ("mirror", 5, 5, 5, 9), ("none", 0, 0, 0, 0)]
    given = spark.createDataFrame(data, "table string, source long, structured long, curated long, mirror long")
    report = rec.state_report(given, absolute=1)
    assert state(report, "table", "verdict") == [
        ("mirror", "MISMATCH"), ("near", "MATCH (within tolerance)"), ("none", "MATCH"), ("ok", "MATCH"), ("skipped", "MATCH")]


def test_state_counts(spark):
    rows = [rec.store_count(spark.range(n), "t", s, spark) for s, n in (("source", 3), ("structured", 2))]
    rows.append(rec.store_count(None, "t", "curated", spark))
    got = rec.state_counts(rows)
    assert state(got, *got.columns) == [("t", 3, 2, 0, None)]


def test_statistics(spark):
    stats = spark.createDataFrame(
        [("ITEMS", 10, 1, 2, 3, 1, 2, 2), ("Items", 0, 4, 0, 0, 3, 0, 0), ("OTHER", 1, 1, 1, 1, 1, 1, 1)],
        "table_name string, full_load_rows long, inserts long, updates long, deletes long, applied_inserts long, "
        "applied_updates long, applied_deletes long")
    tables = spark.createDataFrame([("src", "items")], "source string, table string")
    read, applied = rec.stats_counts(stats, tables)
    assert state(read, *read.columns) == [("src.items", 15, 2, 3)]
    assert state(applied, *applied.columns) == [("src.items", 14, 2, 2)]


def test_check_results(spark):
    report = spark.createDataFrame([("a", True), ("b", False)], "table string, matches boolean")
    bad = rec.check_result(report, rec.KEY_CHECK)
    good = rec.check_result(report.where("matches"), rec.STATE_COUNTS)
    assert bad.first().asDict() == {"check": rec.KEY_CHECK, "ok": False, "tables": 2, "failing": 1}
    assert rec.check_result(report.limit(0), rec.KEY_CHECK).first().ok is False
    assert rec.check_result(report.limit(0), rec.CHANGE_COUNTS).first().ok is True
    assert tuple(rec.overall_result([bad, good]).first()) == (False, 1)


def test_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "pk int")
    b = spark.createDataFrame([(2,), (3,), (3,), (4,), (None,)], "pk int")
    assert state(kk.key_counts(a, b, ["pk"]), "pk", "only_a", "only_b") == sorted(
        [(1, 2, 0), (4, 0, 1), (None, 1, 1)], key=repr)
    report = kk.key_report([kk.key_diff(a, b, ["pk"], "x"), kk.key_diff(a.where("pk=2"), b.where("pk=2"), ["pk"], "y")])
    assert state(report, *report.columns) == [("x", 3, 2, False), ("y", 0, 0, True)]
    assert kk.key_sample(a, b, ["pk"], 2).count() == 2


def test_key_skew_is_reduced_before_the_shuffle(spark):
    plan = kk.key_counts(spark.range(9), spark.range(9), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_latency(spark):
    now = 1709287260000  # 2024-03-01 10:01:00
    rows = spark.createDataFrame([(ts(0),), (ts(5),), (ts(30),), (None,)], "at string")
    assert latency_stats(rows, "at", now).first().asDict() == {
        "minimum": 30000, "maximum": 60000, "sum": 145000, "total_count": 3}
    unreadable = rows.unionByName(spark.createDataFrame([("soon",)], "at string"))
    assert latency_stats(unreadable, "at", now).first().total_count == 4
    for none in (rows.where("at is null"), rows.limit(0), spark.createDataFrame([("soon",)], "at string")):
        assert tuple(latency_stats(none, "at", now).first()) == (0, 0, 0, 0)


def test_latency_does_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([(ts(0),)], "at string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert latency_stats(rows, "at", 1709287260000).first().minimum == 60000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_field_differences(spark):
    records = spark.createDataFrame([('{"pk": 1, "x": {"y": 1}}',), ('{"z": null}',)], "json string")
    got = field_diff(declared_fields(spark, CONTRACT), observed_fields(records, "json"))
    assert state(got, "field", "missing_in") == [("data", "record"), ("x", "contract"), ("z", "contract")]


def test_only_ranges_of_keys_that_differ_are_compared(spark):
    a = spark.range(50_000).select(F.col("id").cast("int").alias("k"), F.format_string("n%d", "id").alias("t"))
    b = a.where("k % 9973 != 7").select(F.col("k").cast("long").alias("k"), "t").union(spark.sql("SELECT 70000L, 'new'"))
    narrowed = kk.in_differing_ranges(a, b, ["k", "t"])
    # Each of the keys that differ brings the few of its range along.
    assert [df.count() < 60 for df in narrowed] == [True, True]
    assert state(kk.key_counts(*narrowed, ["k", "t"]), "k", "only_a", "only_b") == state(kk.key_counts(a, b, ["k", "t"]), "k", "only_a", "only_b")
    rows = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert kk.key_diff(*kk.in_differing_ranges(rows, rows, ["k"]), ["k"], "t").first()[1:] == (1, 1)
    twice = spark.createDataFrame([(1,)], "k int")
    assert kk.key_diff(*kk.in_differing_ranges(rows.where("k = 1"), twice, ["k"]), ["k"], "t").first()[1:] == (0, 0)


def test_equal_sides_shuffle_no_keys(spark):
    a = spark.range(20_000).withColumn("k", F.col("id") * 3)
    counts = kk.key_counts(*kk.in_differing_ranges(a.select("k"), a.select("k").repartition(3), ["k"]), ["k"])
    assert counts.collect() == []
    plan = counts._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert "hashpartitioning(k" not in final
