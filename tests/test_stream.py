import os

import pytest
from helpers import CONTRACT, ROW, changes, state, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import TableContract, with_metadata
from cdclake.operators import changes as ch
from cdclake.plans import jobs
from cdclake.sources import paths, tables
from cdclake.sources.quarantine import quarantine_path, read_quarantine
from cdclake.sources.raw import committed_files, file_inventory, infer_schema
from cdclake.streaming import cdc

NAME = ("src", "items")
CONTRACTS = {NAME: CONTRACT}


@pytest.fixture
def zones(root):
    names = ("raw", "structured", "curated", "violations", "checkpoint", "metrics")
    return cdc.Zones(**{z: f"{root}/{z}" for z in names}, buckets=2)


def put(df, zones, name=NAME, order=0):
    """Write a frame as one change file, newer than those before."""
    folder = f"{zones.raw}/{name[0]}/{name[1]}"
    existing = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df.coalesce(1).write.mode("append").parquet(folder)
    for new in set(os.listdir(folder)) - existing:
        if new.startswith("part"):
            os.utime(f"{folder}/{new}", (1700000000 + order, 1700000000 + order))


def run(spark, zones, contracts=CONTRACTS, names=(NAME,), **options):
    for query in cdc.cdc_stream(spark, list(names), contracts, zones, seconds=None, **options):
        query.awaitTermination()
        assert query.exception() is None


def curated(spark, zones):
    rows = tables.read_table(spark, CONTRACT.path(zones.curated))
    return state(rows) if rows.columns else []


def violations(spark, zones, name=NAME):
    path = quarantine_path(zones.violations, "structured", *name)
    return sorted(r.error for r in read_quarantine(spark, path).collect()) if os.path.isdir(path) else []


def test_one_batch(spark, zones):
    put(changes(spark, (1, "a", "I", "01"), (1, "b", "U", "02"), (1, "c", "U", "03"), (2, "x", "I", "01"),
                (2, "x", "D", "02"), (3, "y", "U", "01"), (4, "z", "D", "01")), zones)
    run(spark, zones)
    assert curated(spark, zones) == [(1, "c"), (3, "y")]
    assert state(tables.read_table(spark, CONTRACT.path(zones.structured))) == [(1, "c"), (3, "y")]
    assert violations(spark, zones) == []
    metrics = spark.read.parquet(CONTRACT.path(zones.metrics)).first()
    assert (metrics.rows_in, metrics.rows_invalid, metrics.rows_curated, metrics.latency_total_count) == (7, 0, 4, 4)
    assert metrics.latency_minimum > 0 and metrics.took_ms > 0


def test_stream_equals_fold(spark, zones):
    feeds = [
        [(1, "a", "I", "01"), (2, "b", "I", "02")],
        [(1, "a2", "U", "03"), (2, "b", "D", "04"), (3, "c", "I", "05")],
        [(2, "back", "I", "06"), (3, "c2", "U", "07"), (1, "a", "D", "08")],
        [(1, "late", "U", "00")],
    ]
    expected = spark.createDataFrame([], ROW)
    for i, rows in enumerate(feeds):
        put(changes(spark, *rows), zones, order=i)
        latest = ch.latest_records(changes(spark, *rows), ["pk"])
        expected = spark.createDataFrame(ch.apply_changes(expected, latest, ["pk"]).collect(), ROW)
    # In the order of arrival; by sequence the last, late change would change nothing.
    one_at_a_time = cdc.Zones(**{**zones.__dict__, "max_files": 1, "in_sequence": False})
    run(spark, one_at_a_time)
    assert curated(spark, zones) == state(expected)
    assert spark.read.parquet(CONTRACT.path(zones.metrics)).count() == 4
    put(changes(spark, (9, "next", "I", "09")), zones, order=9)
    run(spark, one_at_a_time)
    assert (9, "next") in curated(spark, zones)


def test_a_repeated_batch_changes_nothing(spark, zones):
    put(changes(spark, (1, "a", "I", "01"), (None, "bad", "I", "02")), zones)
    run(spark, zones)
    before = tables.table_state(spark, CONTRACT.path(zones.curated))["version"]
    # The job dies after the writes and before the batch is recorded as done.
    checkpoint = zones.stream_checkpoint(*NAME)
    paths.delete(spark, f"{checkpoint}/commits/0")
    paths.delete(spark, f"{checkpoint}/commits/.0.crc")
    run(spark, zones)
    assert tables.table_state(spark, CONTRACT.path(zones.curated))["version"] == before
    assert violations(spark, zones) == ["Record does not have a primary key"]
    assert curated(spark, zones) == [(1, "a")]


def test_invalid_rows_are_set_aside(spark, zones):
    put(changes(spark, (1, "a", "I", "01"), (None, "b", "I", "02"), (2, "c", None, "03")), zones)
    run(spark, zones)
    assert curated(spark, zones) == [(1, "a")]
    assert violations(spark, zones) == ["Missing Op column", "Record does not have a primary key"]


def test_schema_mismatch_sets_the_batch_aside(spark, zones):
    put(changes(spark, (1, "a", "I", "01"), (2, "b", "I", "02")).withColumn("extra", F.lit(1)), zones)
    run(spark, zones)
    assert curated(spark, zones) == []
    assert violations(spark, zones) == ["Record does not match schema version v7"] * 2


def test_wider_type_is_set_aside(spark, zones):
    put(changes(spark, (1, "a", "I", "01")).withColumn("pk", F.col("pk").cast("long")), zones)
    run(spark, zones)
    assert violations(spark, zones) == [
        "Violation - some of the input data had incompatible types for column [pk]. Tried to use int but found INT64"]
    assert curated(spark, zones) == []


def test_type_clash_sets_only_this_batch_aside(spark, zones):
    put(changes(spark, (1, "a", "I", "01")), zones, order=0)
    put(changes(spark, (2, "b", "I", "02")).withColumn("pk", F.lit("two")), zones, order=1)
    put(changes(spark, (3, "c", "I", "03")), zones, order=2)
    run(spark, cdc.Zones(**{**zones.__dict__, "max_files": 1}))
    assert curated(spark, zones) == [(1, "a"), (3, "c")]
    (message,) = violations(spark, zones)
    assert message == ("Violation - some of the input data had incompatible types for column [pk]. "
                       "Tried to use int but found BINARY")
    raw = read_quarantine(spark, quarantine_path(zones.violations, "structured", *NAME)).first().raw
    assert '"pk":"two"' in raw


def test_files_of_one_batch_that_do_not_fit_together(spark, zones):
    put(changes(spark, (1, "a", "I", "01")), zones, order=0)
    put(changes(spark, (2, "b", "I", "02")).withColumn("pk", F.lit("two")), zones, order=1)
    run(spark, zones)
    assert curated(spark, zones) == []
    assert len(violations(spark, zones)) == 2


def test_other_errors_stop_the_stream(spark, zones):
    def fail(df, contract):
        raise RuntimeError("mirror is down")

    put(changes(spark, (1, "a", "I", "01")), zones)
    (query,) = cdc.cdc_stream(spark, [NAME], CONTRACTS, cdc.Zones(**{**zones.__dict__, "mirror": fail}), seconds=None)
    with pytest.raises(Exception, match="mirror is down"):
        query.awaitTermination()


def test_mirror_receives_its_shape(spark, zones):
    seen = []
    mirrored = cdc.Zones(**{**zones.__dict__, "mirror": lambda df, c: seen.append((df.columns, state(df)))})
    put(changes(spark, (1, "a", "I", "01"), (1, "b", "U", "02")), zones)
    run(spark, mirrored)
    assert seen == [(["pk", "data", "op"], [(1, "b")])]


def test_without_contract_rows_are_set_aside(spark, zones):
    other = ("src", "unknown")
    put(changes(spark, (1, "a", "I", "01"), (2, "b", "I", "02")), zones, other)
    put(changes(spark, (1, "a", "I", "01")), zones)
    run(spark, zones, names=[other, ("src", "nothing"), NAME])
    assert violations(spark, zones, other) == ["Schema does not exist for src/unknown"] * 2
    assert curated(spark, zones) == [(1, "a")]


def test_failed_write_goes_to_quarantine(spark, zones, monkeypatch):
    put(changes(spark, (1, "a", "I", "01")), zones)
    merge = tables.merge

    def conflicting(spark, path, *args, **kwargs):
        if path.startswith(zones.curated):
            raise tables.TableConflict(path)
        return merge(spark, path, *args, **kwargs)

    monkeypatch.setattr(tables, "merge", conflicting)
    run(spark, cdc.Zones(**{**zones.__dict__, "attempts": 2}))
    assert state(tables.read_table(spark, CONTRACT.path(zones.structured))) == [(1, "a")]
    kept = read_quarantine(spark, quarantine_path(zones.violations, "curated", *NAME)).collect()
    assert [r.error for r in kept] == ["Violation - Data storage service retries exceeded for src/items for curated"]
    assert spark.read.parquet(CONTRACT.path(zones.metrics)).first().rows_curated == 0


def test_compactions_without_end_do_not_keep_a_stream_from_writing(spark, zones, monkeypatch):
    put(changes(spark, (1, "a", "I", "01")), zones)
    run(spark, zones)
    put(changes(spark, (1, "b", "U", "02"), (2, "c", "I", "03")), zones, order=1)
    commit, within = tables._commit, []

    def busy(session, target, before, after):
        # A compaction is done just before each write is.
        if target == CONTRACT.path(zones.curated) and not within:
            within.append(1)
            try:
                tables.compact(session, target, full=True, buckets=before["buckets"])
            except tables.TableConflict:
                pass
            within.clear()
        return commit(session, target, before, after)

    monkeypatch.setattr(tables, "_commit", busy)
    run(spark, cdc.Zones(**{**zones.__dict__, "attempts": 4}))
    assert curated(spark, zones) == [(1, "b"), (2, "c")]


def test_new_nullable_contract_column(spark, zones):
    put(changes(spark, (1, "a", "I", "01")), zones)
    schema = T.StructType([*CONTRACT.schema.fields, T.StructField("extra", T.StringType(), True)])
    run(spark, zones, {NAME: TableContract(*NAME, ("pk",), schema, version="v8")})
    assert state(tables.read_table(spark, CONTRACT.path(zones.curated)), "pk", "data", "extra") == [(1, "a", None)]


def test_checkpoint_reset_reads_again(spark, zones):
    put(changes(spark, (1, "a", "I", "01")), zones)
    run(spark, zones)
    assert committed_files(spark, zones.stream_checkpoint(*NAME)).count() == 1
    run(spark, cdc.Zones(**{**zones.__dict__, "metrics": None}), reset_checkpoint=True)
    assert curated(spark, zones) == [(1, "a")]


def test_source_archiving_and_fallback(spark, zones, root):
    archive = f"{root}/processed"
    moving = cdc.Zones(**{**zones.__dict__, "archive_dir": archive, "max_files": 1})
    for i in range(3):
        put(changes(spark, (i, "a", "I", f"0{i}")), zones, order=i)
    run(spark, moving)
    assert curated(spark, zones) == [(0, "a"), (1, "a"), (2, "a")]
    kept = spark.read.option("recursiveFileLookup", True).parquet(archive)
    assert kept.count() >= 1
    schema = infer_schema(spark, f"{root}/nowhere", f"{archive}{zones.raw}/src/items", f"{root}/also nowhere")
    assert schema.names == ROW.replace(" int", "").replace(" string", "").split(", ")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        infer_schema(spark, f"{root}/nowhere", f"{root}/neither")


def test_source_log_with_compact_files(spark, zones):
    moving = cdc.Zones(**{**zones.__dict__, "max_files": 1, "metrics": None})
    for i in range(5):
        put(changes(spark, (i, "a", "I", f"{i:02d}")), zones, order=i)
    spark.conf.set("spark.sql.streaming.fileSource.log.compactInterval", "3")
    try:
        run(spark, moving)
    finally:
        spark.conf.unset("spark.sql.streaming.fileSource.log.compactInterval")
    folder = f"{zones.stream_checkpoint(*NAME)}/sources/0"
    assert any(n.endswith(".compact") for n in os.listdir(folder))
    with open(f"{folder}/99.tmp", "w") as out:
        out.write('v1\n{"path":"file:/x.parquet","timestamp":1,"batchId":99}')
    logged = committed_files(spark, zones.stream_checkpoint(*NAME))
    assert sorted(r.batchId for r in logged.collect()) == list(range(5))
    assert cdc.batch_files(spark, zones.stream_checkpoint(*NAME), 2) != []
    assert jobs.all_processed(spark, [NAME], moving)
    inventory = {r.path for r in file_inventory(spark, zones.raw, [NAME]).collect()}
    assert {r.path for r in logged.collect()} == inventory
    put(changes(spark, (99, "a", "I", "99")), zones, order=99)
    assert not jobs.all_processed(spark, [NAME], moving)
    assert len(curated(spark, zones)) == 5


def test_stream_schema_is_the_contract(spark, zones):
    put(changes(spark, (1, "a", "I", "01")), zones)
    stream, _ = cdc.plan_stream(spark, *NAME, CONTRACT, zones)
    assert stream.isStreaming and stream.columns == with_metadata(CONTRACT.schema).names
    assert ts(1) == "2024-03-01 10:00:01.000000"


def test_result_does_not_depend_on_the_cut_of_the_feed(spark, zones):
    rows = [(1, "b", "U", "09"), (1, "a", "U", "01"), (2, None, "D", "08"), (2, "x", "I", "02"), (3, "y", "I", "03")]
    for i, row in enumerate(rows):
        put(changes(spark, row), zones, order=i)
    run(spark, cdc.Zones(**{**zones.__dict__, "max_files": 1}))
    assert curated(spark, zones) == [(1, "b"), (3, "y")]


def test_checkpoint_reset_loses_nothing(spark, zones):
    for i in range(3):
        put(changes(spark, (i, "a", "I", f"0{i}"), (None, "bad", "I", f"0{i}")), zones, order=i)
    one = cdc.Zones(**{**zones.__dict__, "max_files": 1})
    run(spark, one)
    for name in os.listdir(f"{zones.raw}/{NAME[0]}/{NAME[1]}"):
        paths.delete(spark, f"{zones.raw}/{NAME[0]}/{NAME[1]}/{name}")
    put(changes(spark, (9, "new", "I", "09"), (None, "worse", "I", "09")), zones, order=9)
    run(spark, one, reset_checkpoint=True)
    assert curated(spark, zones) == [(0, "a"), (1, "a"), (2, "a"), (9, "new")]
    assert len(violations(spark, zones)) == 4
    assert spark.read.parquet(CONTRACT.path(zones.metrics)).count() == 4


def test_a_vanished_file_does_not_stop_the_stream(spark, zones, root):
    put(changes(spark, (1, "a", "I", "01")), zones)
    (file,) = [f for f in os.listdir(f"{zones.raw}/src/items") if f.startswith("part")]
    path = f"{zones.raw}/src/items/{file}"
    schema = spark.read.parquet(path).schema
    assert cdc.batch_schema(spark, [path, f"{path}x"], None, T.StructType()) == schema
    paths.write_text(spark, f"{root}/moved{path}", "")
    paths.delete(spark, f"{root}/moved{path}")
    assert paths.rename(spark, path, f"{root}/moved{path}")
    assert cdc.batch_schema(spark, [path], f"{root}/moved", T.StructType()) == schema
    assert cdc.batch_schema(spark, [path], None, schema) == schema


def test_values_that_do_not_fit_are_set_aside(spark, zones):
    tables.append(spark, CONTRACT.path(zones.structured), changes(spark, (1, "a", "I", "")).withColumn("data", F.lit(1)), ["pk"])
    put(changes(spark, (2, "b", "I", "01")), zones)
    run(spark, zones)
    path = quarantine_path(zones.violations, "structured", *NAME)
    assert [r.error for r in read_quarantine(spark, path).collect()] == ["Column data is string, stored as int"]
