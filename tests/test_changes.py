import random

import pytest
from helpers import CONTRACT, ROW, changes, state, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import TableContract
from cdclake.operators import changes as ch
from cdclake.operators.mirror import mirror_shape
from cdclake.operators.validate import split_valid, validate


def current(spark, *rows):
    return spark.createDataFrame([(pk, data, "I", ts(0), "") for pk, data in rows], ROW)


# --- latest change ----------------------------------------------------------------------------

def test_latest_by_sequence_then_time(spark):
    long = "1" * 33
    rows = spark.createDataFrame([
        (1, "only", "I", ts(1), "5"),
        (2, "old", "I", ts(9), "1"), (2, "new", "U", ts(1), "2"),
        (3, "early", "I", ts(1), ""), (3, "late", "U", ts(2), ""),
        (4, "early", "I", ts(1), None), (4, "late", "U", ts(2), None),
        (5, "empty", "I", ts(9), ""), (5, "sequenced", "U", ts(1), "0"), (5, "null", "U", ts(10), None),
        (6, "a", "I", ts(1), long + "1"), (6, "b", "U", ts(1), long + "2"),
        (7, "null time", "I", None, ""), (7, "time", "U", ts(1), ""),
        (8, "null", "I", ts(9), None), (8, "empty", "U", ts(1), ""),
    ], ROW)
    assert state(ch.latest_records(rows, ["pk"])) == [
        (1, "only"), (2, "new"), (3, "late"), (4, "late"), (5, "sequenced"), (6, "b"), (7, "time"), (8, "empty"),
    ]


def test_latest_of_composite_key(spark):
    rows = changes(spark, (1, "a", "I", "1"), (1, "b", "I", "2"), (1, "a", "U", "3"))
    assert state(ch.latest_records(rows, ["pk", "data"]), "pk", "data", "Op") == [(1, "a", "U"), (1, "b", "I")]


def test_active_archive_drops_deleted_and_unknown(spark):
    rows = changes(spark, (1, "a", "I", "1"), (1, "a", "D", "2"), (2, "b", "D", "1"), (2, "c", "I", "2"),
                   (3, "d", None, "1"), (4, "e", "I", ""))
    assert state(ch.active_records(rows, ["pk"])) == [(2, "c"), (4, "e")]


# --- lake merge -------------------------------------------------------------------------------

CASES = [  # current data, change data, op, result
    ("c", "n", "I", "n"), ("c", "n", "U", "n"), ("c", "n", "D", None), ("c", "n", None, "c"), ("c", "n", "X", "c"),
    (None, "n", "I", "n"), (None, "n", "U", "n"), (None, "n", "D", None), (None, "n", None, None),
    (None, "n", "X", "n"),
]


def test_lake_merge_cases(spark):
    cur = current(spark, *[(i, c) for i, (c, _, _, _) in enumerate(CASES) if c], (99, "untouched"))
    new = changes(spark, *[(i, n, op, "1") for i, (_, n, op, _) in enumerate(CASES)])
    expected = sorted([(i, r) for i, (_, _, _, r) in enumerate(CASES) if r] + [(99, "untouched")])
    assert state(ch.apply_changes(cur, new, ["pk"])) == expected
    assert state(ch.merge_changes(cur, new, ["pk"], small=True).rows) == expected


def test_matched_insert_overwrites_all_columns(spark):
    got = ch.apply_changes(current(spark, (1, "old")), changes(spark, (1, None, "I", "7")), ["pk"]).first()
    assert (got.data, got.Op, got.checkpoint_col) == (None, "I", "7")


def test_columns_missing_or_new(spark):
    cur = current(spark, (1, "one"), (2, "two"))
    new = changes(spark, (1, "x", "U", "1"), (3, "y", "I", "1")).withColumnRenamed("data", "extra")
    got = ch.apply_changes(cur, new, ["pk"])
    assert state(got, "pk", "data", "extra") == [(1, "one", "x"), (2, "two", None), (3, None, "y")]


def test_null_keys_never_match(spark):
    cur = current(spark, (None, "c"), (1, "c"))
    new = changes(spark, (None, "n", "U", "1"), (None, "m", "U", "2"))
    assert state(ch.apply_changes(cur, new, ["pk"])) == sorted(
        [(None, "c"), (1, "c"), (None, "n"), (None, "m")], key=repr)


def test_duplicate_changes_fail(spark):
    new = changes(spark, (1, "a", "U", "1"), (1, "b", "U", "2"))
    with pytest.raises(Exception, match="Several changes for one key"):
        ch.apply_changes(current(spark, (1, "c")), new, ["pk"]).collect()


def test_repeated_rows_of_the_table_are_all_changed(spark):
    cur = current(spark, (1, "a"), (1, "b"), (2, "c"), (2, "d"))
    new = changes(spark, (1, "n", "U", "1"), (2, None, "D", "1"))
    assert state(ch.apply_changes(cur, new, ["pk"])) == [(1, "n"), (1, "n")]


def test_column_names_with_dots(spark):
    cur = current(spark, (1, "a")).withColumnRenamed("data", "my.data").withColumnRenamed("pk", "p.k")
    new = changes(spark, (1, "b", "U", "1")).withColumnRenamed("data", "my.data").withColumnRenamed("pk", "p.k")
    assert [tuple(r)[:2] for r in ch.apply_changes(cur, new, ["p.k"]).collect()] == [(1, "b")]


@pytest.mark.parametrize("seed", range(3))
def test_batches_equal_a_fold(spark, seed):
    """Random feed in batches: each merged batch equals replaying its changes one by one."""
    rng = random.Random(seed)
    table = current(spark, *[(k, "base") for k in range(0, 20, 2)])
    model = {k: "base" for k in range(0, 20, 2)}
    sequence = 0
    for _ in range(3):
        batch = []
        for _ in range(25):
            sequence += 1
            batch.append((rng.randrange(20), f"v{sequence}", rng.choice("IUUD"), f"{sequence:06d}"))
        last = {row[0]: row for row in batch}
        for key, data, op, _ in last.values():
            if op == "D":
                model.pop(key, None)
            else:
                model[key] = data
        rng.shuffle(batch)
        latest = ch.latest_records(changes(spark, *batch), ["pk"])
        table = spark.createDataFrame(ch.apply_changes(table, latest, ["pk"]).collect(), ROW)
    assert state(table) == sorted(model.items(), key=repr)


# --- update, append, mirror -------------------------------------------------------------------

def test_update_existing(spark):
    got = ch.update_existing(current(spark, (1, "a"), (2, "b")), changes(spark, (1, "n", "D", "1"), (3, "x", "I", "1")), ["pk"])
    assert state(got, "pk", "data", "Op") == [(1, "n", "D"), (2, "b", "I")]


def test_append_new(spark):
    rows = changes(spark, (1, "n", "I", "1"), (3, "x", "I", "1"), (3, "y", "I", "2"), (None, "z", "I", "3"))
    assert state(ch.append_new(None, rows, ["pk"])) == state(rows)
    got = ch.append_new(current(spark, (1, "a"), (2, "b")), rows, ["pk"])
    assert state(got) == sorted([(1, "a"), (2, "b"), (3, "x"), (3, "y"), (None, "z")], key=repr)


def test_mirror_merge_cases(spark):
    keep = {("c", "I"): "c", ("c", "U"): "n", ("c", "D"): None, ("c", "X"): "c", ("c", None): "c",
            (None, "I"): "n", (None, "U"): "n", (None, "D"): None, (None, "X"): None, (None, None): None}
    cases = list(enumerate(keep.items()))
    cur = mirror_shape(current(spark, *[(i, c) for i, ((c, _), _) in cases if c]))
    new = mirror_shape(changes(spark, *[(i, "n", op, "1") for i, ((_, op), _) in cases]), keep_op=True)
    assert new.columns == ["pk", "data", "op"]
    got = ch.mirror_changes(cur, new, CONTRACT)
    assert got.columns == ["pk", "data"]
    assert state(got) == [(i, r) for i, (_, r) in cases if r]


def test_mirror_of_keys_only(spark):
    contract = TableContract("s", "t", ("PK",), T.StructType([T.StructField("PK", T.IntegerType(), False)]))
    cur = spark.createDataFrame([(1,), (2,)], "pk int")
    new = spark.createDataFrame([(1, "U"), (2, "D"), (3, "I")], "pk int, op string")
    assert state(ch.mirror_changes(cur, new, contract), "pk") == [(1,), (3,)]


def test_mirror_shape(spark):
    rows = spark.createDataFrame([(1, "a\0b\0", 2.0, "I", ts(1), "1")],
                                 "ID int, Some_Text string, V double, Op string, _timestamp string, checkpoint_col string")
    assert mirror_shape(rows).columns == ["id", "some_text", "v"]
    got = mirror_shape(rows, keep_op=True)
    assert got.columns == ["id", "some_text", "v", "op"]
    assert got.first().some_text == "ab"


# --- skew and plans ---------------------------------------------------------------------------

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_after(df):
    df.count()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


def big(spark, n=30000):
    # A third of all rows hold one key.
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("int")
    return spark.range(0, n, 1, 12).select(
        key.alias("pk"), F.sha2(F.col("id").cast("string"), 256).alias("data"), F.lit("I").alias("Op"),
        F.lit(ts(0)).alias("_timestamp"), F.lpad(F.col("id").cast("string"), 9, "0").alias("checkpoint_col"))


def test_hot_key_of_the_table_is_split(skewed):
    new = changes(skewed, (7, "n", "U", "1"), (8, None, "D", "1"), (-1, "x", "I", "1"))
    merged = ch.apply_changes(big(skewed), ch.latest_records(new, ["pk"]), ["pk"], unique=True)
    plan, rows = plan_after(merged)
    assert "skew=true" in plan
    assert sum(r.data == "n" for r in rows) >= 10000


def test_hot_key_of_a_load_is_split(skewed):
    stored = skewed.range(10, 20).select(F.col("id").cast("int").alias("pk"))
    plan, rows = plan_after(ch.missing_rows(stored, big(skewed), ["pk"]))
    assert "skew=true" in plan
    assert len(rows) == big(skewed).where("pk not between 10 and 19").count()


def test_null_keys_spread(skewed):
    rows = big(skewed).withColumn("pk", F.when(F.col("pk") != 7, F.col("pk")))
    stored = skewed.range(10, 20).select(F.col("id").cast("int").alias("pk"))
    absent = ch.missing_rows(stored, rows, ["pk"])
    per_task = absent.where("pk is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 8
    assert sum(r["count"] for r in per_task) == 10001


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = ch.latest_records(big(spark), ["pk"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_small_changes_do_not_shuffle_the_table(spark):
    merged = ch.merge_changes(big(spark), changes(spark, (7, "n", "U", "1")), ["pk"], small=True)
    plan = merged.remaining._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_changes_are_shuffled_once(spark):
    rows = changes(spark, *[(i % 7, f"v{i}", "U", f"{i:03d}") for i in range(30)]).repartition(3)
    valid, _ = split_valid(validate(rows, CONTRACT), CONTRACT)
    latest = ch.latest_records(valid, ["pk"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = ch.apply_changes(big(spark, 300), latest, ["pk"], unique=True)
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan[:plan.index("Initial Plan")]


def test_null_keys_are_checked_where_they_are(spark):
    rows = changes(spark, *[(None, "a", "U", str(k)) for k in range(200)], (1, "a", "U", "1")).repartition(4)
    plan = ch.require_unique(rows, ["pk"])
    assert plan.where("pk IS NULL").groupBy(F.spark_partition_id()).count().count() >= 4
    with pytest.raises(Exception, match="Several changes"):
        ch.require_unique(rows.unionByName(changes(spark, (1, "b", "U", "2"))), ["pk"]).count()
