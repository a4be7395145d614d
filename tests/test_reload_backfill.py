import random
from datetime import datetime, timedelta, timezone

import pytest
from helpers import CONTRACT, ROW, changes, state
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import TableContract
from cdclake.operators import changes as ch
from cdclake.operators import reload as rl
from cdclake.operators.backfill import BackfillError, backfill
from cdclake.operators.reload import reload_diff, reload_stamp

STAMP = "20240301100000"


def load(spark, *rows):
    return changes(spark, *[(pk, data, "I", "") for pk, data in rows])


def diff(raw, archive):
    d = reload_diff(raw, archive, CONTRACT, STAMP)
    return tuple(state(df, "pk", "data", "Op", "checkpoint_col") for df in (d.inserts, d.updates, d.deletes))


def test_identical(spark):
    rows = load(spark, (1, "a"), (2, None))
    assert diff(rows, rows) == ([], [], [])


def test_empty_archive(spark):
    raw = load(spark, (1, "a"), (2, "b"))
    assert diff(raw, raw.limit(0)) == ([(1, "a", "I", STAMP), (2, "b", "I", STAMP)], [], [])


def test_all_kinds(spark):
    archive = changes(
        spark, (1, "same", "I", ""), (2, "old", "I", ""), (3, "gone", "I", ""), (4, "x", "I", ""),
        (4, "x", "D", "5"), (5, "first", "I", ""), (5, "second", "U", "3"), (6, None, "I", ""), (7, "v", "D", "1"),
    )
    raw = load(spark, (1, "same"), (2, "new"), (4, "back"), (5, "first"), (6, "filled"), (8, "fresh"))
    inserts, updates, deletes = diff(raw, archive)
    assert inserts == [(4, "back", "I", STAMP), (8, "fresh", "I", STAMP)]
    assert updates == [(2, "new", "U", STAMP), (5, "first", "U", STAMP), (6, "filled", "U", STAMP)]
    assert deletes == [(3, "gone", "D", STAMP)]


def test_metadata_differences_are_not_updates(spark):
    assert diff(load(spark, (1, "a")), changes(spark, (1, "a", "U", "9"))) == ([], [], [])


def test_columns_missing_from_the_metadata_are_added(spark):
    raw = load(spark, (1, "a")).drop("checkpoint_col")
    archive = load(spark, (2, "b"))
    d = reload_diff(raw, archive, CONTRACT, STAMP)
    assert d.inserts.columns == ["pk", "data", "Op", "_timestamp", "checkpoint_col"]
    assert d.inserts.first().checkpoint_col == STAMP


@pytest.mark.parametrize("seed", range(2))
def test_applying_the_diff_gives_the_snapshot(spark, seed):
    rng = random.Random(seed)
    history = [(rng.randrange(15), f"v{rng.randrange(4)}", rng.choice("IUD"), f"{i:04d}") for i in range(40)]
    archive = changes(spark, *history)
    raw = load(spark, *[(k, f"v{rng.randrange(4)}") for k in range(20) if rng.random() < 0.6])
    d = reload_diff(raw, archive, CONTRACT, STAMP)
    active = spark.createDataFrame(ch.active_records(archive, ["pk"]).collect(), ROW)
    changed = d.upserts.unionByName(d.deletes)
    assert state(ch.apply_changes(active, changed, ["pk"])) == state(raw)


def test_stamp_is_utc():
    moment = datetime(2024, 3, 1, 12, 0, tzinfo=timezone(timedelta(hours=2)))
    assert reload_stamp(moment) == "20240301100000"


def widened(*fields):
    return TableContract("s", "t", ("pk",), T.StructType([*CONTRACT.schema.fields, *fields]))


def test_backfill(spark):
    rows = load(spark, (1, "a"))
    got = backfill(rows, widened(
        T.StructField("n", T.IntegerType(), True),
        T.StructField("d", T.DateType(), False, {"default": "2020-01-02"}),
        T.StructField("i", T.LongType(), False, {"default": "12"}),
    ))
    assert got.columns == [*rows.columns, "n", "d", "i"]
    row = got.first()
    assert (row.n, str(row.d), row.i) == (None, "2020-01-02", 12)
    assert dict(got.dtypes)["i"] == "bigint"


def test_backfill_keeps_complete_rows(spark):
    rows = load(spark, (1, "a"))
    assert backfill(rows, CONTRACT).collect() == rows.collect()


@pytest.mark.parametrize("metadata", [None, {"default": 3}])
def test_required_column_needs_a_text_default(spark, metadata):
    with pytest.raises(BackfillError):
        backfill(load(spark, (1, "a")), widened(T.StructField("x", T.StringType(), False, metadata)))


def one_pass(raw, archive):
    sides = rl.compare_sides(raw, archive, CONTRACT)
    args = (sides, raw, archive, CONTRACT, STAMP)
    rows = rl.side_changes(*args).unionByName(rl.changes_of_repeated_keys(*args))
    return tuple(state(rows.where(F.col("kind") == k), "pk", "data", "Op", "checkpoint_col") for k in ("toInsert", "toUpdate", "toDelete"))


@pytest.mark.parametrize("seed", range(3))
def test_one_pass_gives_the_same_changes(spark, seed):
    rng = random.Random(seed)
    archive = changes(spark, *[
        (rng.choice([None, *range(25)]), rng.choice(["a", "b", None]), rng.choice(["I", "U", "D", None]), rng.choice([None, "1", "2", "3"]))
        for _ in range(80)
    ])
    raw = load(spark, *[(rng.choice([None, *range(35)]), rng.choice(["a", "b", None])) for _ in range(40)])
    assert one_pass(raw, archive) == diff(raw, archive)


def test_one_pass_with_columns_of_one_side(spark):
    raw = load(spark, (1, "a"), (2, "x")).withColumn("fresh", F.lit(1)).drop("_timestamp")
    archive = load(spark, (2, "b"), (3, "c")).withColumn("old", F.lit("o")).withColumn("pk", F.col("pk").cast("long"))
    rows = rl.side_changes(rl.compare_sides(raw, archive, CONTRACT), raw, archive, CONTRACT, STAMP)
    assert rows.columns == ["pk", "data", "Op", "checkpoint_col", "fresh", "_timestamp", "old", "kind"]
    assert state(rows, "pk", "data", "Op", "fresh", "old") == [(1, "a", "I", 1, None), (2, "x", "U", 1, None), (3, "c", "D", None, "o")]


def test_one_pass_has_one_shuffle(spark):
    raw, archive = load(spark, (1, "a")), load(spark, (1, "b"))
    rows = rl.side_changes(rl.compare_sides(raw, archive, CONTRACT), raw, archive, CONTRACT, STAMP)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan
