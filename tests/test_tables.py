import os
import threading

import pytest
from helpers import CONTRACT, changes, state
from pyspark.sql import functions as F

from cdclake.operators.validate import only_inserts, validate
from cdclake.sources import tables


@pytest.fixture
def path(root):
    return f"{root}/src/items"


def read(spark, path, *columns):
    return state(tables.read_table(spark, path), *(columns or ("pk", "data")))


def test_missing_table(spark, path):
    assert tables.read_table(spark, path).columns == []
    assert not tables.table_exists(spark, path) and not tables.has_records(spark, path)
    assert tables.update(spark, path, changes(spark, (1, "a", "U", "1")), ["pk"]) is False
    assert tables.compact(spark, path) is False
    assert tables.vacuum(spark, path) == 0


def test_append_new(spark, path):
    first = changes(spark, (1, "a", "I", ""), (1, "twice", "I", ""), (2, "b", "I", ""))
    assert tables.append_new(spark, path, first, ["pk"], buckets=3)
    assert read(spark, path) == [(1, "a"), (1, "twice"), (2, "b")]
    assert tables.append_new(spark, path, changes(spark, (2, "x", "I", ""), (3, "c", "I", "")), ["pk"])
    assert read(spark, path) == [(1, "a"), (1, "twice"), (2, "b"), (3, "c")]
    version = tables.table_state(spark, path)["version"]
    assert not tables.append_new(spark, path, first, ["pk"])
    assert tables.table_state(spark, path)["version"] == version


def test_empty_first_write_creates_nothing(spark, path):
    assert not tables.append_new(spark, path, changes(spark, (1, "a", "I", "")).limit(0), ["pk"])
    assert not tables.table_exists(spark, path)


def test_merge_creates_then_merges(spark, path):
    assert tables.merge(spark, path, changes(spark, (1, "a", "I", "1"), (2, "b", "D", "1")), ["pk"], buckets=4)
    assert read(spark, path) == [(1, "a")]
    tables.merge(spark, path, changes(spark, (1, "z", "U", "2"), (3, "c", "U", "2"), (4, "d", "D", "2")), ["pk"])
    assert read(spark, path) == [(1, "z"), (3, "c")]
    tables.merge(spark, path, changes(spark, (1, None, "D", "3"), (3, None, "D", "3")), ["pk"])
    assert read(spark, path) == [] and not tables.has_records(spark, path)
    tables.merge(spark, path, changes(spark, (9, "i", "I", "4")), ["pk"])
    assert read(spark, path) == [(9, "i")]


def test_large_changes_use_no_broadcast(spark, path):
    rows = spark.range(2000).select(
        F.col("id").cast("int").alias("pk"), F.lit("a").alias("data"), F.lit("I").alias("Op"),
        F.lit("t").alias("_timestamp"), F.lit("").alias("checkpoint_col"))
    tables.append_new(spark, path, rows, ["pk"], buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = rows.where("pk % 2 = 0").withColumns({"data": F.lit("b"), "Op": F.lit("U"), "pk": F.col("pk") + 1000})
        tables.merge(spark, path, new, ["pk"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    got = tables.read_table(spark, path).groupBy("data").count().collect()
    assert {r.data: r["count"] for r in got} == {"a": 1500, "b": 1000}


def test_only_touched_buckets_are_rewritten(spark, path):
    rows = changes(spark, *[(i, "a", "I", "") for i in range(50)])
    tables.append_new(spark, path, rows, ["pk"], buckets=8)
    before = tables.table_state(spark, path)
    tables.merge(spark, path, changes(spark, (1, "b", "U", "1")), ["pk"])
    after = tables.table_state(spark, path)
    (gen,) = before["live"]
    assert len(set(before["live"][gen]) - set(after["live"][gen])) == 1
    assert sum(len(b) for b in after["live"].values()) == 8


def test_a_grown_table_gets_more_buckets(spark, path, monkeypatch):
    tables.append(spark, path, changes(spark, *[(i, "a", "I", "") for i in range(30)]), ["pk"], buckets=1)
    monkeypatch.setattr(tables, "_BUCKET_BYTES", 200)
    tables.merge(spark, path, changes(spark, (1, "b", "U", "1"), (2, None, "D", "1"), (99, "n", "I", "1")), ["pk"])
    state_after = tables.table_state(spark, path)
    assert state_after["buckets"] >= 4
    assert len(state_after["live"]) == 1
    expected = {i: "a" for i in range(30)} | {1: "b", 99: "n"}
    del expected[2]
    assert read(spark, path) == sorted(expected.items(), key=repr)
    monkeypatch.undo()
    tables.merge(spark, path, changes(spark, (99, "m", "U", "2"), (3, None, "D", "2")), ["pk"])
    del expected[3]
    assert read(spark, path) == sorted((expected | {99: "m"}).items(), key=repr)
    assert tables.table_state(spark, path)["buckets"] == state_after["buckets"]


def test_scans_read_what_is_needed(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", "")), ["pk"])
    plan = tables.read_table(spark, path).select("pk")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<pk:int>" in plan
    raw = spark.read.parquet(tables.table_folders(tables.table_state(spark, path), path)[0])
    checked = validate(only_inserts(raw), CONTRACT)
    assert "EqualTo(Op,I)" in checked._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_applied_once(spark, path):
    for _ in range(2):
        tables.append(spark, path, changes(spark, (1, "a", "I", "")), ["pk"], batch=("q", 3))
    assert read(spark, path) == [(1, "a")]
    assert not tables.merge(spark, path, changes(spark, (1, "b", "U", "1")), ["pk"], batch=("q", 2))
    assert tables.merge(spark, path, changes(spark, (1, "b", "U", "1")), ["pk"], batch=("other", 0))
    assert read(spark, path) == [(1, "b")]
    assert tables.merge(spark, path, changes(spark, (1, "c", "U", "1")).limit(0), ["pk"], batch=("q", 4))
    assert tables.table_state(spark, path)["batches"] == {"q": 4, "other": 0}


def test_duplicate_changes_leave_the_table_alone(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", "")), ["pk"])
    with pytest.raises(Exception, match="Several changes"):
        tables.merge(spark, path, changes(spark, (1, "b", "U", "1"), (1, "c", "U", "2")), ["pk"])
    assert read(spark, path) == [(1, "a")]


def test_columns_may_be_added(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", "")), ["pk"])
    tables.append(spark, path, changes(spark, (2, "b", "I", "")).withColumn("extra", F.lit(5)), ["pk"])
    tables.merge(spark, path, changes(spark, (1, "n", "U", "1")).withColumnRenamed("data", "other"), ["pk"])
    assert read(spark, path, "pk", "data", "extra", "other") == [(1, "a", None, "n"), (2, "b", 5, None)]


def test_types_are_widened_or_refused(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", "")).withColumn("pk", F.col("pk").cast("long")), ["pk"], buckets=4)
    tables.merge(spark, path, changes(spark, (1, "b", "U", "1")), ["pk"])
    assert read(spark, path) == [(1, "b")]
    with pytest.raises(TypeError):
        tables.append(spark, path, changes(spark, (1, "b", "U", "1")).withColumn("data", F.lit(1)), ["pk"])


def test_update(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", ""), (2, "b", "I", "")), ["pk"])
    tables.update(spark, path, changes(spark, (1, "n", "D", "1"), (5, "x", "I", "1")), ["pk"])
    assert read(spark, path) == [(1, "n"), (2, "b")]


def test_second_writer_is_refused(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", "")), ["pk"])
    stale = tables.table_state(spark, path)
    tables.append(spark, path, changes(spark, (2, "b", "I", "")), ["pk"])
    with pytest.raises(tables.TableConflict):
        tables._commit(spark, path, stale, dict(stale))
    assert read(spark, path) == [(1, "a"), (2, "b")]


def test_compact_and_vacuum(spark, path):
    for i in range(4):
        tables.append(spark, path, changes(spark, (i, "a", "I", ""), (i + 10, "b", "I", "")), ["pk"], buckets=2)
    rows = read(spark, path)
    assert tables.compact(spark, path)
    assert all(n <= 2 for n in _files_per_bucket(spark, path))
    assert not tables.compact(spark, path)
    assert tables.compact(spark, path, full=True, buckets=3)
    assert tables.table_state(spark, path)["buckets"] == 3
    tables.merge(spark, path, changes(spark, (0, "z", "U", "1")), ["pk"])
    assert tables.vacuum(spark, path) == 0
    with pytest.raises(ValueError, match="force"):
        tables.vacuum(spark, path, retain_hours=0)
    assert tables.vacuum(spark, path, retain_hours=0, force=True) >= 5
    assert len(os.listdir(f"{path}/data")) == len(tables.table_state(spark, path)["live"])
    assert read(spark, path) == sorted([(0, "z")] + [r for r in rows if r[0] != 0], key=repr)


def _files_per_bucket(spark, path):
    folders = tables.table_folders(tables.table_state(spark, path), path)
    return [files for files, _ in tables._bucket_files(spark, folders).values()]


def test_failed_write_leaves_the_table(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", "")), ["pk"])
    bad = changes(spark, (2, "b", "I", "")).withColumn("data", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        tables.append(spark, path, bad, ["pk"])
    assert read(spark, path) == [(1, "a")]


def test_list_tables(spark, root):
    for name in ("a/x", "a/y", "b/deep/z"):
        tables.append(spark, f"{root}/{name}", changes(spark, (1, "a", "I", "")), ["pk"])
    assert tables.list_tables(spark, root) == [f"{root}/a/x", f"{root}/a/y"]
    assert len(tables.list_tables(spark, root, 3)) == 3


@pytest.mark.parametrize("gigabytes, cores, files", [(23.1, 4, 372), (1.0, 1, 16), (0.01, 4, 4), (0.0, 2, 1)])
def test_file_counts(gigabytes, cores, files):
    assert tables.sized_files(gigabytes, cores) == files


def test_overwrite_sized(spark, root):
    # One row makes one file, however large a table may be.
    assert tables.overwrite_sized(changes(spark, (1, "a", "I", "")), f"{root}/o") == 1
    assert tables.overwrite_sized(changes(spark, *[(k, "a", "I", "") for k in range(50)]), f"{root}/n", 0.2, 4) == 4
    tables.overwrite_sized(changes(spark, (2, "b", "I", "")), f"{root}/o")
    assert state(spark.read.parquet(f"{root}/o")) == [(2, "b")]


def test_frames_without_statistics_are_measured(spark, path):
    rows = spark.createDataFrame(changes(spark, (1, "a", "I", "")).rdd, changes(spark, (1, "a", "I", "")).schema)
    tables.append(spark, path, rows, ["pk"])
    assert tables.table_state(spark, path)["buckets"] == 1


def test_types_below_the_top_level(spark, path):
    tables.append(spark, path, spark.sql("SELECT 1 AS pk, named_struct('a', 1) AS s, array(1) AS l, CAST(1 AS DECIMAL(8,2)) AS d"), ["pk"])
    tables.append(spark, path, spark.sql("SELECT 2 AS pk, named_struct('b', 'x', 'a', 2) AS s, array(2) AS l, CAST(2 AS DECIMAL(6,1)) AS d"), ["pk"])
    for bad in ("CAST(3 AS DECIMAL(12,2)) AS d", "CAST(3 AS DECIMAL(8,3)) AS d", "array('x') AS l", "named_struct('a', 'x') AS s"):
        with pytest.raises(tables.SchemaConflict):
            tables.append(spark, path, spark.sql(f"SELECT 3 AS pk, {bad}"), ["pk"])
    got = tables.read_table(spark, path).orderBy("pk").selectExpr("pk", "s.a", "s.b", "l[0]", "CAST(d AS STRING)").collect()
    assert [tuple(r) for r in got] == [(1, 1, None, 1, "1.00"), (2, 2, "x", 2, "2.00")]
    later = spark.sql("SELECT 1 AS pk, named_struct('a', 9, 'c', 1.5D) AS s, 'U' AS Op")
    tables.merge(spark, path, later, ["pk"], unique=True)
    got = tables.read_table(spark, path).orderBy("pk").selectExpr("pk", "s.a", "s.b", "s.c").collect()
    assert [tuple(r) for r in got] == [(1, 9, None, 1.5), (2, 2, "x", None)]


def test_late_changes_and_deletes_change_nothing(spark, path):
    feed = [(1, "new", "U", "05"), (1, "old", "U", "03"), (2, None, "D", "04"), (2, "old", "I", "02"), (2, "again", "I", "06"),
            (3, "x", "I", "01"), (3, None, "D", "02"), (3, "late", "U", "01")]
    for k, row in enumerate(feed):
        tables.merge(spark, path, changes(spark, row), ["pk"], batch=("s/1", k), in_sequence=True)
    assert read(spark, path) == [(1, "new"), (2, "again")]
    assert tables.list_tables(spark, path) == [path]


def _results_of_any_cut(spark, root, feed, base, key_rows):
    """The table after the feed, in one batch and in orders of single changes."""
    import itertools

    from cdclake.operators.changes import latest_records

    results = []
    orders = list(itertools.permutations(range(len(feed))))
    for k, order in enumerate([None, *(orders if len(feed) < 3 else orders[1::2])]):
        path = f"{root}/cut{k}"
        if base:
            tables.append_new(spark, path, changes(spark, *base), ["pk"], buckets=1)
        parts = [feed] if order is None else [[feed[i]] for i in order]
        for n, part in enumerate(parts):
            rows = latest_records(changes(spark, *part), ["pk"])
            tables.merge(spark, path, rows, ["pk"], batch=("s/1", n), in_sequence=True, unique=True, buckets=1)
        results.append(read(spark, path, "pk", "data", "Op", "checkpoint_col"))
    assert results[0] == key_rows
    return results


@pytest.mark.parametrize("feed, base, rows", [
    # An ignored operation after an update leaves the row as it was before the feed, in either cut.
    ([(1, "u", "U", "05"), (1, "x", "X", "09")], [(1, "a", "I", "")], [(1, "a", "I", "")]),
    ([(1, "u", "U", "05"), (1, "x", "X", "09")], [], [(1, "x", "X", "09")]),
    ([(1, "u", "U", "05"), (1, None, "D", "07"), (1, "x", "X", "09")], [(1, "a", "I", "")], [(1, "a", "I", "")]),
    ([(1, "x", "X", "03"), (1, "u", "U", "05"), (1, "y", "Y", "04")], [(1, "a", "I", "")], [(1, "u", "U", "05")]),
    ([(1, "x", "X", "06"), (1, "u", "U", "05"), (1, None, "D", "07")], [(1, "a", "I", "")], []),
    ([(1, "x", "X", "06"), (1, None, "D", "05"), (1, "y", "Y", "07")], [], [(1, "y", "Y", "07")]),
])
def test_any_cut_of_a_feed_gives_one_result(spark, root, feed, base, rows):
    results = _results_of_any_cut(spark, root, feed, base, rows)
    assert all(r == rows for r in results)


def test_what_another_writer_has_made_of_a_row_stays(spark, path):
    tables.append_new(spark, path, changes(spark, (1, "a", "I", ""), (2, "b", "I", "")), ["pk"], buckets=1)
    tables.merge(spark, path, changes(spark, (1, "u", "U", "05"), (2, "u", "U", "05")), ["pk"], in_sequence=True)
    tables.merge(spark, path, changes(spark, (1, "reloaded", "U", "07")), ["pk"])
    tables.merge(spark, path, changes(spark, (1, "x", "X", "09"), (2, "x", "X", "09")), ["pk"], in_sequence=True)
    assert read(spark, path) == [(1, "reloaded"), (2, "b")]


def test_a_batch_that_died_between_memory_and_table(spark, path, monkeypatch):
    tables.append_new(spark, path, changes(spark, (1, "a", "I", "")), ["pk"], buckets=1)
    tables.merge(spark, path, changes(spark, (1, "u", "U", "05")), ["pk"], batch=("s/1", 0), in_sequence=True)
    commit = tables._commit

    def dying(session, target, before, after):
        if target == path:
            raise OSError("gone")
        commit(session, target, before, after)

    last = changes(spark, (1, "x", "X", "09"), (2, "n", "I", "08"))
    monkeypatch.setattr(tables, "_commit", dying)
    with pytest.raises(OSError, match="gone"):
        tables.merge(spark, path, last, ["pk"], batch=("s/1", 1), in_sequence=True)
    monkeypatch.undo()
    assert read(spark, path) == [(1, "u")]
    tables.merge(spark, path, last, ["pk"], batch=("s/1", 1), in_sequence=True)
    assert read(spark, path) == [(1, "a"), (2, "n")]


def _files(spark, path):
    return {"/".join(f.split("/")[-3:]) for f in tables.read_table(spark, path).inputFiles()}


def _many_files(spark, path, rows=400, buckets=2, target_mb=0.0008):
    made = spark.range(rows).select(
        F.col("id").cast("int").alias("pk"), F.repeat(F.col("id").cast("string"), 20).alias("data"), F.lit("I").alias("Op"),
        F.lit("t").alias("_timestamp"), F.lit("").alias("checkpoint_col"))
    tables.append_new(spark, path, made, ["pk"], buckets=buckets)
    tables.compact(spark, path, full=True, buckets=buckets, target_mb=target_mb)
    return _files(spark, path)


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_only_files_with_matched_keys_are_rewritten(spark, path, limit):
    before = _many_files(spark, path)
    assert len(before) >= 6
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        # Two updates and a delete within one range of keys, and keys that are new.
        tables.merge(spark, path, changes(spark, (3, "u", "U", "1"), (5, None, "D", "1"), (1000, "n", "I", "1"), (2000, "m", "U", "1")), ["pk"])
        after = _files(spark, path)
        assert len(before - after) <= 2
        assert tables.table_state(spark, path)["partial"]
        expected = {i: str(i) * 20 for i in range(400) if i != 5} | {3: "u", 1000: "n", 2000: "m"}
        assert read(spark, path) == sorted(expected.items(), key=repr)
        # Keys that the table lacks rewrite nothing.
        tables.merge(spark, path, changes(spark, (3000, "n", "I", "1"), (4000, None, "D", "1")), ["pk"])
        assert after <= _files(spark, path)
        tables.update(spark, path, changes(spark, (7, "v", "U", "1"), (5000, "w", "U", "1")), ["pk"])
        assert len(after - _files(spark, path)) == 1
        expected |= {3000: "n", 7: "v"}
        assert read(spark, path) == sorted(expected.items(), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
    held = sum(n.endswith(".parquet") for _, _, names in os.walk(f"{path}/data") for n in names)
    assert tables.vacuum(spark, path, retain_hours=0, force=True) > 0
    left = sum(n.endswith(".parquet") for _, _, names in os.walk(f"{path}/data") for n in names)
    assert left == len(_files(spark, path)) < held
    assert read(spark, path) == sorted(expected.items(), key=repr)
    assert tables.compact(spark, path, full=True) and not tables.table_state(spark, path)["partial"]
    assert read(spark, path) == sorted(expected.items(), key=repr)


def test_compaction_is_committed_group_by_group(spark, path, monkeypatch):
    for k in range(3):
        tables.append(spark, path, changes(spark, *[(i, f"r{k}", "I", "") for i in range(40)]), ["pk"], buckets=4)
    rows, version = read(spark, path), tables.table_state(spark, path)["version"]
    clustered, done = tables._clustered, []

    def meddled(session, target, state, chosen, count, files):
        out = clustered(session, target, state, chosen, count, files)
        done.append(chosen)
        if len(done) == 2:
            # Another writer takes the first bucket of the third group, and one that is done.
            tables.append(session, target, changes(session, *[(i, "new", "I", "") for i in range(40)]), ["pk"])
        return out

    monkeypatch.setattr(tables, "_clustered", meddled)
    with pytest.raises(tables.TableConflict, match="buckets being rewritten"):
        tables.compact(spark, path, group_bytes=1)
    monkeypatch.undo()
    assert [len(g) for g in done] == [1, 1]
    assert read(spark, path) == sorted(rows + [(i, "new") for i in range(40)], key=repr)
    assert tables.table_state(spark, path)["version"] == version + 2
    # Run again it goes on with the buckets that still have too many files.
    assert tables.compact(spark, path, group_bytes=1)
    assert all(n <= 2 for n in _files_per_bucket(spark, path))


def test_compaction_beside_a_writer_of_other_buckets(spark, path, monkeypatch):
    for k in range(3):
        tables.append(spark, path, changes(spark, *[(i, f"r{k}", "I", "") for i in range(40)]), ["pk"], buckets=4)
    clustered = tables._clustered

    def meddled(session, target, state, chosen, count, files):
        out = clustered(session, target, state, chosen, count, files)
        if chosen == {0}:
            other = next(i for i in range(40) if tables._buckets_of(changes(session, (i, "", "", "")), ["pk"], 4) == {3})
            tables.append(session, target, changes(session, (other, "beside", "I", "")), ["pk"])
        return out

    rows = read(spark, path)
    monkeypatch.setattr(tables, "_clustered", meddled)
    with pytest.raises(tables.TableConflict):
        tables.compact(spark, path, group_bytes=1)
    monkeypatch.undo()
    # The group of the bucket that was not written to is done, and so are those before the one that was.
    assert len(read(spark, path)) == len(rows) + 1
    assert tables.table_state(spark, path)["version"] >= 6


def test_files_are_narrow_in_every_key(spark, path):
    import pyarrow.parquet as pq

    rows = spark.range(4096).select(
        (F.col("id") % 64).cast("int").alias("a"), F.format_string("k%02d", (F.col("id") / 64).cast("int")).alias("b"), F.repeat(F.lit("x"), 50).alias("c"))
    tables.append(spark, path, rows, ["a", "b"], buckets=1)
    tables.compact(spark, path, full=True, buckets=1, target_mb=0.00005)
    files = tables.read_table(spark, path).inputFiles()
    assert len(files) >= 30

    def read_for(column, value):
        hit = 0
        for f in files:
            group = pq.read_metadata(f.removeprefix("file://")).row_group(0)
            stats = next(group.column(k).statistics for k in range(group.num_columns) if group.column(k).path_in_schema == column)
            hit += stats.min <= value <= stats.max
        return hit / len(files)

    # Sorted by the first key, a filter on the second would read every file.
    assert read_for("a", 17) <= 0.5 and read_for("b", "k40") <= 0.5
    assert tables.read_table(spark, path).distinct().count() == 4096


def test_a_conflict_is_tried_again(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", "")), ["pk"], buckets=2)
    commit, seen = tables._commit, []

    def busy(spark, target, before, after):
        if len(seen) < 2:
            seen.append(1)
            raise tables.TableConflict(target)
        return commit(spark, target, before, after)

    tables._commit = busy
    try:
        tables.with_retries(lambda: tables.merge(spark, path, changes(spark, (2, "b", "I", "1")), ["pk"]), seconds=0.001)
        assert read(spark, path) == [(1, "a"), (2, "b")]
        seen.clear()
        with pytest.raises(tables.TableConflict):
            tables.with_retries(lambda: tables.append(spark, path, changes(spark, (3, "c", "I", "1")), ["pk"]), 2, 0.001)
    finally:
        tables._commit = commit
    with pytest.raises(ValueError):
        tables.with_retries(lambda: None, 0)


def test_a_taken_version_is_refused(spark, root):
    from cdclake.sources import paths

    paths.write_text(spark, f"{root}/a", "1")
    paths.write_text(spark, f"{root}/b", "2")
    assert not paths.rename(spark, f"{root}/a", f"{root}/b")
    assert paths.rename(spark, f"{root}/a", f"{root}/c") and paths.read_text(spark, f"{root}/c") == "1"


def test_of_two_writers_at_once_one_takes_a_name(spark, root):
    from cdclake.sources import paths

    for k in range(40):
        won, start = [], threading.Barrier(2)

        def take(who, won=won, start=start, k=k):
            paths.write_text(spark, f"{root}/.{k}-{who}", who)
            start.wait()
            if paths.rename(spark, f"{root}/.{k}-{who}", f"{root}/{k}.json"):
                won.append(who)

        writers = [threading.Thread(target=take, args=(who,)) for who in "ab"]
        for writer in writers:
            writer.start()
        for writer in writers:
            writer.join()
        assert [paths.read_text(spark, f"{root}/{k}.json")] == won


def test_a_compaction_gives_way_to_a_refused_writer(spark, path):
    tables.append(spark, path, changes(spark, (1, "a", "I", "")), ["pk"], buckets=2)
    refused = []

    def write():
        for buckets in (2, 1):
            if refused:
                with pytest.raises(tables.TableConflict, match="waited for"):
                    tables.compact(spark, path, full=True, buckets=buckets)
        if not refused:
            refused.append(1)
            raise tables.TableConflict(path)

    tables.with_retries(write, seconds=0.001, table=(spark, path))
    assert tables.compact(spark, path, full=True, buckets=2)
    # That of a job that died holds for a time only.
    tables._announce(spark, path, None, 0.0)
    with pytest.raises(tables.TableConflict, match="waited for"):
        tables.compact(spark, path, full=True, buckets=2)
    now = tables.time.time()
    with pytest.MonkeyPatch.context() as later:
        later.setattr(tables.time, "time", lambda: now + 61)
        tables.let_writers_pass(spark, path)
        assert tables.compact(spark, path, full=True, buckets=2)
        tables.vacuum(spark, path)
    assert tables.compact(spark, path, full=True, buckets=2)
    assert read(spark, path) == [(1, "a")]
