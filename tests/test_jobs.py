from datetime import datetime, timedelta

import pytest
from helpers import CONTRACT, STRICT, changes, state
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import TableContract
from cdclake.operators import files as ff
from cdclake.operators import reconcile as rec
from cdclake.operators.backfill import BackfillError
from cdclake.plans import jobs, views
from cdclake.sources import catalog, jdbc, tables
from cdclake.sources.quarantine import (
    quarantine, quarantine_all, quarantine_files, quarantine_path, read_quarantine, readable_groups,
)
from cdclake.sources.raw import (
    IncompatibleSchemas, NoSchemaNoData, configured_tables, discover_files, discover_tables, file_inventory, read_raw,
    stream_raw_inferred,
)
from cdclake.streaming.cdc import Zones

NAME = ("src", "items")
CONTRACTS = {NAME: CONTRACT}


@pytest.fixture
def zones(root):
    names = ("raw", "structured", "curated", "violations", "checkpoint", "metrics")
    return Zones(**{z: f"{root}/{z}" for z in names}, buckets=2)


def load(spark, *rows):
    return changes(spark, *[(pk, data, "I", "") for pk, data in rows])


def put(df, root, file="LOAD0001.parquet", name=NAME):
    import os

    folder = f"{root}/{name[0]}/{name[1]}"
    os.makedirs(folder, exist_ok=True)
    df.toPandas().to_parquet(f"{folder}/{file}", schema=_arrow(df), coerce_timestamps="us")


def _arrow(df):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def violations(spark, zones, zone="structured"):
    return sorted(r.error for r in read_quarantine(spark, quarantine_path(zones.violations, zone, *NAME)).collect())


# --- sources ----------------------------------------------------------------------------------

def test_discovery(spark, root):
    put(load(spark, (1, "a")), root)
    put(load(spark, (1, "a")), root, "LOAD0002.parquet")
    put(load(spark, (1, "a")), root, "20240101-1.parquet")
    put(load(spark, (1, "a")), root, "20240101-1.parquet", ("src", "changes_only"))
    put(load(spark, (1, "a")), root, "LOAD0001.parquet", ("src", "not_configured"))
    names = [NAME, ("src", "changes_only"), ("src", "absent")]
    assert discover_tables(spark, root, names) == [NAME]
    listed = discover_files(spark, root, names)
    assert sorted(r.path.rsplit("/", 1)[1] for r in listed.collect()) == ["LOAD0001.parquet", "LOAD0002.parquet"]
    assert discover_files(spark, root, [("src", "absent")]).count() == 0
    inventory = file_inventory(spark, root, names)
    assert inventory.groupBy("table").count().where("table = 'items'").first()["count"] == 3
    assert file_inventory(spark, root, names, r".+/LOAD.+").count() == 2
    assert file_inventory(spark, root, names, older_than=datetime.now() - timedelta(hours=1)).count() == 0


def test_configured_tables(spark, root):
    for name, text in (("good", '{"tables": ["b/y",\n "a/x", "b/y"]}'), ("bad", '{"tables": ["a"]}')):
        with open(f"{root}/{name}.json", "w") as out:
            out.write(text)
    assert configured_tables(spark, f"{root}/good.json") == [("a", "x"), ("b", "y")]
    with pytest.raises(ValueError):
        configured_tables(spark, f"{root}/bad.json")


def test_schemas_are_merged_or_refused(spark, root):
    put(load(spark, (1, "a")), root)
    put(load(spark, (2, "b")).withColumn("extra", F.lit("x")), root, "LOAD0002.parquet")
    assert state(read_raw(spark, f"{root}/src/items"), "pk", "extra") == [(1, None), (2, "x")]
    put(load(spark, (3, "c")).withColumn("pk", F.lit("three")), root, "LOAD0003.parquet")
    with pytest.raises(IncompatibleSchemas):
        read_raw(spark, f"{root}/src/items")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw(spark, f"{root}/nowhere")
    with pytest.raises(NoSchemaNoData):
        stream_raw_inferred(spark, f"{root}/nowhere/*.parquet")


def test_quarantine_takes_any_schema(spark, root):
    path = f"{root}/v"
    assert quarantine_all(load(spark, (1, "a")), "one", path, "r1") == 1
    assert quarantine_all(load(spark, (1, "a")).withColumn("pk", F.lit("x")), "two", path, "r2") == 1
    assert quarantine_all(load(spark, (1, "b"), (2, "b")), "one", path, "r1") == 2
    assert quarantine(load(spark, (1, "a")).withColumn("error", F.lit("e")).limit(0), path, "r3") == 0
    assert sorted(r.error for r in read_quarantine(spark, path).collect()) == ["one", "one", "two"]


def test_files_are_set_aside_in_readable_groups(spark, root):
    for i in range(6):
        rows = load(spark, (i, "a"))
        put(rows if i < 4 else rows.withColumn("pk", F.lit(f"k{i}")), root, f"LOAD{i}.parquet")
    listed = sorted(r.path for r in discover_files(spark, root, [NAME]).collect())
    groups = readable_groups(spark, listed)
    assert [f for g in groups for f in g] == listed and len(groups) < 6
    assert quarantine_files(spark, listed, "bad", f"{root}/v") == 6
    keys = {r.raw.split(",")[0] for r in read_quarantine(spark, f"{root}/v").collect()}
    assert keys == {'{"pk":0', '{"pk":1', '{"pk":2', '{"pk":3', '{"pk":"k4"', '{"pk":"k5"'}


# --- full load --------------------------------------------------------------------------------

def test_full_load(spark, zones):
    put(changes(spark, (1, "a", "I", ""), (2, "b", "U", ""), (3, "c", "I", ""), (None, "d", "I", "")), zones.raw)
    seen = []
    zones = Zones(**{**zones.__dict__, "mirror": lambda df, c: seen.append((df.columns, state(df)))})
    assert jobs.full_load(spark, [NAME], CONTRACTS, zones) == [NAME]
    for root in (zones.structured, zones.curated):
        assert state(tables.read_table(spark, CONTRACT.path(root))) == [(1, "a"), (3, "c")]
    assert violations(spark, zones) == ["Record does not have a primary key"]
    assert seen == [(["pk", "data"], [(1, "a"), (3, "c")])]
    jobs.full_load(spark, [NAME], CONTRACTS, zones)
    assert state(tables.read_table(spark, CONTRACT.path(zones.curated))) == [(1, "a"), (3, "c")]


def test_full_load_without_tables(spark, zones):
    with pytest.raises(ValueError):
        jobs.full_load(spark, [NAME], CONTRACTS, zones)


DRIFT = {
    "extra column": lambda df: df.withColumn("extra", F.lit(1)),
    "missing required column": lambda df: df.drop("data"),
    "string for int": lambda df: df.withColumn("pk", F.lit("x")),
    "int for string": lambda df: df.withColumn("data", F.lit(1)),
    "long for int": lambda df: df.withColumn("pk", F.col("pk").cast("long")),
}


@pytest.mark.parametrize("kind", DRIFT)
def test_full_load_drift(spark, zones, kind):
    strict = {NAME: TableContract(*NAME, ("pk",), STRICT, version="v7")}
    put(DRIFT[kind](load(spark, (1, "a"), (2, "b"))), zones.raw)
    jobs.full_load(spark, [NAME], strict, zones)
    assert not tables.table_exists(spark, CONTRACT.path(zones.curated))
    assert violations(spark, zones) == ["Record does not match schema version v7"] * 2


def test_full_load_of_files_that_do_not_fit(spark, zones):
    put(load(spark, (1, "a")), zones.raw)
    put(load(spark, (2, "b")).withColumn("pk", F.lit("x")), zones.raw, "LOAD0002.parquet")
    jobs.full_load(spark, [NAME], CONTRACTS, zones)
    assert violations(spark, zones) == ["Violation - Incompatible schemas across multiple files for src.items"] * 2


def test_full_load_without_contract(spark, zones):
    put(load(spark, (1, "a")), zones.raw)
    jobs.full_load(spark, [NAME], {}, zones)
    assert violations(spark, zones) == ["Schema does not exist for src/items"]


# --- reload, backfill -------------------------------------------------------------------------

def test_reload_job(spark, root):
    put(load(spark, (1, "new"), (2, "b"), (4, "d")), f"{root}/raw")
    put(load(spark, (1, "old"), (2, "b"), (3, "c")), f"{root}/archive")
    put(load(spark, (7, "first")), f"{root}/raw", name=("src", "young"))
    young = TableContract("src", "young", ("pk",), CONTRACT.schema)
    contracts = {**CONTRACTS, ("src", "young"): young}
    jobs.reload_diff_job(spark, list(contracts), contracts, f"{root}/raw", f"{root}/archive", f"{root}/out",
                         datetime(2024, 3, 1, 10))
    got = {k: state(spark.read.parquet(f"{root}/out/{k}/src/items"), "pk", "Op", "checkpoint_col")
           for k in ("toInsert", "toUpdate", "toDelete")}
    stamp = "20240301100000"
    assert got == {"toInsert": [(4, "I", stamp)], "toUpdate": [(1, "U", stamp)], "toDelete": [(3, "D", stamp)]}
    assert state(spark.read.parquet(f"{root}/out/toInsert/src/young")) == [(7, "first")]
    with pytest.raises(LookupError):
        jobs.reload_diff_job(spark, [NAME], {}, f"{root}/raw", f"{root}/archive", f"{root}/out", datetime.now())


def test_backfill_job(spark, root):
    wider = TableContract(*NAME, ("pk",), T.StructType([*CONTRACT.schema.fields, T.StructField("n", T.IntegerType())]))
    put(load(spark, (1, "a")), f"{root}/archive")
    contracts = {NAME: wider, ("src", "not_archived"): wider}
    assert jobs.archive_backfill(spark, contracts, f"{root}/archive", f"{root}/out") == [NAME]
    assert state(spark.read.parquet(f"{root}/out/src/items"), "pk", "n") == [(1, None)]
    put(load(spark, (1, "a")).limit(0), f"{root}/empty")
    with pytest.raises(BackfillError):
        jobs.archive_backfill(spark, {NAME: wider}, f"{root}/empty", f"{root}/out")
    with pytest.raises(LookupError):
        jobs.archive_backfill(spark, {}, f"{root}/archive", f"{root}/out")


# --- reconciliation ---------------------------------------------------------------------------

def test_reconcile_job(spark, zones):
    put(load(spark, (1, "a"), (2, "b"), (3, "c")), zones.raw)
    put(changes(spark, (1, "a", "U", "1"), (2, "b", "D", "2")), zones.raw, "20240101-1.parquet")
    jobs.full_load(spark, [NAME], CONTRACTS, zones)

    def source(contract):
        return spark.createDataFrame([(1,), (2,), (4,)], "pk int")

    def unreachable(contract):
        raise ConnectionError("down")

    state_of = jobs.state_counts(spark, [CONTRACT], zones, source)
    assert state(state_of, *state_of.columns) == [("src.items", 3, 3, 3, None)]
    down = jobs.state_counts(spark, [CONTRACT], zones, unreachable, unreachable, {"src.items"})
    assert state(down, *down.columns) == [("src.items", 0, 3, 3, 0)]
    unmanaged = jobs.state_counts(spark, [CONTRACT], zones, source, unreachable, set())
    assert unmanaged.first().mirror is None
    raw = jobs.raw_change_counts(spark, [CONTRACT], zones.raw, zones.raw + "-archive")
    assert state(raw, *raw.columns) == [("src.items", 3, 1, 1)]
    reports = {
        rec.STATE_COUNTS: lambda: rec.state_report(state_of),
        rec.CHANGE_COUNTS: lambda: rec.change_report(raw, raw, raw),
        rec.KEY_CHECK: lambda: jobs.key_check(spark, [CONTRACT], zones, source),
    }
    assert state(jobs.reconcile(spark, reports), "check", "ok") == [(rec.CHANGE_COUNTS, True), (rec.STATE_COUNTS, True)]
    checks = (" Primary_Key_Reconciliation ", rec.STATE_COUNTS)
    got = jobs.reconcile(spark, reports, checks)
    assert state(got, "check", "ok") == [(rec.STATE_COUNTS, True), (rec.KEY_CHECK, False)]
    assert tuple(rec.overall_result([got]).first()) == (False, 1)
    assert reports[rec.KEY_CHECK]().first().asDict() == {
        "table": "src.items", "only_a": 1, "only_b": 1, "matches": False}
    with pytest.raises(jobs.ReconciliationFailed, match="primary_key"):
        jobs.reconcile(spark, reports, checks, fail=True)
    with pytest.raises(ValueError):
        jobs.reconcile(spark, reports, ("other",))


# --- files ------------------------------------------------------------------------------------

def test_file_plans(spark):
    now = datetime(2024, 3, 10, 12)
    files = spark.createDataFrame(
        [("a", now - timedelta(days=5)), ("b", now - timedelta(days=5)), ("c", now - timedelta(days=1)), ("d", now)],
        "path string, modificationTime timestamp")
    ledger = spark.createDataFrame([("a",), ("gone",)], "path string")
    committed = spark.createDataFrame([("a",), ("c",), ("a",)], "path string")
    plan = ff.archive_plan(files, ledger, committed, now)
    assert state(plan, "path", "to_copy", "to_delete") == [
        ("a", False, True), ("b", True, False), ("c", True, False), ("d", True, False)]
    ledger_after = ff.next_ledger(ledger, plan.where("to_copy"), plan.where("to_delete"))
    assert state(ledger_after, "path") == [("b",), ("c",), ("d",), ("gone",)]
    assert state(ff.unprocessed_files(files, committed), "path") == [("b",), ("d",)]


def test_maintenance(spark, root):
    for name in ("a", "b"):
        for i in range(2):
            tables.append(spark, f"{root}/src/{name}", load(spark, (i, "x")), ["pk"], buckets=1)
    assert jobs.maintain(spark, root, tables.compact) == 2

    def broken(session, path):
        if path.endswith("/a"):
            raise OSError("broken")

    with pytest.raises(RuntimeError, match="1 of 2"):
        jobs.maintain(spark, root, broken)


# --- catalog, database, views -----------------------------------------------------------------

def test_catalog(spark, zones):
    schema = T.StructType([*CONTRACT.schema.fields, T.StructField("Private", T.StringType(), True)])
    contract = TableContract(*NAME, ("pk",), schema, sensitive=("Private",))
    bad = TableContract("src", "Bad-Name", ("pk",), schema)
    names = {n: f"cat_{n}" for n in ("archive", "structured", "curated", "public")}
    for name in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    rows = load(spark, (1, "a")).withColumn("Private", F.lit("s"))
    put(rows, f"{zones.raw}-archive")
    for zone, value in ((zones.structured, "a"), (zones.curated, "c")):
        tables.append(spark, contract.path(zone), rows.withColumn("data", F.lit(value)), ["pk"], buckets=2)
    tables.merge(spark, contract.path(zones.curated), changes(spark, (2, "d", "I", "1")), ["pk"])
    roots = {"archive": f"{zones.raw}-archive", "structured": zones.structured, "curated": zones.curated}
    for _ in range(2):
        failures = catalog.publish_tables(spark, [contract, bad], roots, names)
        assert state(failures, "source", "table") == [("src", "Bad-Name")]
    assert state(spark.table("cat_archive.src_items"), "pk", "Op") == [(1, "I")]
    assert state(spark.table("cat_structured.src_items")) == [(1, "a")]
    assert state(spark.table("cat_public.src_items")) == [(1, "c"), (2, "d")]
    described = spark.sql("DESCRIBE cat_public.src_items").collect()
    assert [(r.col_name, r.comment) for r in described] == [("pk", "primary_key"), ("data", None), ("Private", None)]
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES cat_archive.src_items").collect()}
    assert properties["sensitive_columns"] == "['private']"
    assert properties["extraction_key"] == "_timestamp,checkpoint_col"
    assert properties["source_primary_key"] == "pk"
    assert catalog.switch_tables(spark, [contract], zones.structured, "cat_public").count() == 0
    assert state(spark.table("cat_public.src_items")) == [(1, "a")]
    assert catalog.switch_tables(spark, [contract, bad], zones.curated, "cat_public").count() == 1
    assert state(spark.table("cat_public.src_items")) == [(1, "c"), (2, "d")]


def test_published_tables_follow_a_load(spark, zones):
    contract = TableContract("src", "followed", ("pk",), CONTRACT.schema)
    names = {n: f"follow_{n}" for n in ("archive", "structured", "curated", "public")}
    for name in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    roots = {"archive": zones.raw, "structured": zones.structured, "curated": zones.curated}
    assert catalog.publish_tables(spark, [contract], roots, names).count() == 0
    zones = Zones(**{**zones.__dict__, "published": {"curated": ("follow_curated", "follow_public")}})
    for i in range(2):
        put(load(spark, (i, "a")), zones.raw, f"LOAD{i}.parquet", ("src", "followed"))
        jobs.full_load(spark, [("src", "followed")], {("src", "followed"): contract}, zones)
    assert state(spark.table("follow_public.src_followed")) == [(0, "a"), (1, "a")]
    assert spark.table("follow_structured.src_followed").count() == 0


def test_published_tables_follow_many_merges(spark, root):
    contract = TableContract("src", "merged", ("pk",), CONTRACT.schema)
    names = {n: f"merged_{n}" for n in ("archive", "structured", "curated", "public")}
    for name in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    roots = {n: f"{root}/{n}" for n in ("archive", "structured", "curated")}
    path = contract.path(roots["curated"])
    # Two files a bucket, so that merges take single files out of a folder.
    for k in range(2):
        tables.append(spark, path, load(spark, *[(i, "x") for i in range(40 * k, 40 * k + 40)]), ["pk"], buckets=4)
    tables.compact(spark, path, full=True, buckets=2, target_mb=0.001)
    assert catalog.publish_tables(spark, [contract], roots, names).count() == 0

    def location(side):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED merged_public.src_merged__{side}").collect()
        return next(r.data_type for r in rows if r.col_name == "Location")

    places = [location(s) for s in "ab"]
    before = {r[0] for r in spark.sql("SHOW PARTITIONS merged_public.src_merged__a").collect()}
    expected = {i: "x" for i in range(80)}
    for k in range(5):
        tables.merge(spark, path, changes(spark, (k * 11, f"y{k}", "U", "1"), (200 + k, "n", "I", "1")), ["pk"])
        expected |= {k * 11: f"y{k}", 200 + k: "n"}
        catalog.point_table(spark, "merged_public", contract, path)
        assert state(spark.table("merged_public.src_merged")) == sorted(expected.items(), key=repr)
    assert [location(s) for s in "ab"] == places
    units = {f"_gen={g}/_bucket={b}/_left={'some' if f else 'all'}" for g, b, f in tables.table_units(tables.table_state(spark, path))}
    assert {r[0] for r in spark.sql("SHOW PARTITIONS merged_public.src_merged__b").collect()} == units != before
    assert any(u.endswith("some") for u in units)
    # A view that was not moved on shows the version it was given, for as long as its files are there.
    assert spark.table("merged_curated.src_merged").count() == 80


def test_database_statements():
    schema = T.StructType([T.StructField("PK", T.IntegerType(), False), T.StructField("Data", T.StringType(), True)])
    contract = TableContract("src", "items", ("PK",), schema, namespace="lake")
    assert jdbc.merge_statement(contract, "loading.src_items", "lake.src_items").split("\n") == [
        "MERGE INTO lake.src_items destination",
        "USING loading.src_items source",
        "ON source.pk = destination.pk",
        "WHEN MATCHED AND source.op = 'D' THEN DELETE",
        "WHEN MATCHED AND source.op = 'U' THEN UPDATE SET data = source.data",
        "WHEN NOT MATCHED AND source.op IN ('I', 'U') THEN INSERT (pk, data) VALUES (source.pk, source.data)",
    ]
    keys_only = TableContract("src", "items", ("PK",), T.StructType(schema.fields[:1]))
    assert "UPDATE" not in jdbc.merge_statement(keys_only, "a", "b")
    assert jdbc.Database("jdbc:x", schema="shop", upper_case=True).table_name("items") == "SHOP.ITEMS"
    assert jdbc.partition_options(None, 1, 2, 3) == {}
    assert jdbc.partition_options("id", 1, 9, 4) == {"column": "id", "lowerBound": 1, "upperBound": 9, "numPartitions": 4}


def test_person_name_is_null_if_a_part_is(spark):
    bookings = spark.createDataFrame([(1, 10, 100), (2, 20, 200), (3, 30, 300)],
                                     "offender_book_id int, living_unit_id int, offender_id int")
    people = spark.createDataFrame(
        [(100, "n1", "Ann", None, None, "Lee", "1980-01-01", "F", "W8"),
         (200, "n2", None, "B", "C", "Day", "1981-01-01", "M", "O1")],
        "offender_id int, offender_id_display string, first_name string, middle_name string, middle_name_2 string, "
        "last_name string, birth_date string, sex_code string, race_code string")
    got = views.person(bookings, people)
    assert state(got, "id", "name", "racecode") == [(1, "Lee, A", "W3"), (2, None, "A4")]


def test_mirror_callbacks(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, db, table, truncate, batch_size: calls.append(
        (db.table_name(table), truncate, df.columns)))
    monkeypatch.setattr(jdbc, "run_statement", lambda session, db, *sql: calls.append(sql))
    contract = TableContract(*NAME, ("pk",), CONTRACT.schema, namespace="lake")
    db = jdbc.Database("jdbc:none")
    rows = spark.createDataFrame([(1, "a", "U")], "pk int, data string, op string")
    jdbc.merge_mirror(db, set())(rows, contract)
    assert calls == []
    jdbc.merge_mirror(db, {"src.items"})(rows, contract)
    assert calls[0] == ("loading.src_items", False, ["pk", "data", "op"])
    assert calls[1][0].startswith("MERGE INTO lake.src_items destination\nUSING loading.src_items source")
    assert calls[1][1] == "TRUNCATE TABLE loading.src_items"
    monkeypatch.setattr(jdbc, "read_jdbc", lambda *a, **k: None)
    jdbc.overwrite_mirror(db, {"src.items"})(rows.drop("op"), contract)
    assert calls[2] == ("lake.src_items", True, ["pk", "data"])
    monkeypatch.setattr(jdbc, "read_jdbc", lambda *a, **k: 1 / 0)
    with pytest.raises(jdbc.MirrorTableMissing):
        jdbc.overwrite_mirror(db, {"src.items"})(rows, contract)


def test_files_are_grouped_by_their_footers(spark, root):
    from cdclake.sources.quarantine import readable_groups

    rows = load(spark, (1, "a"))
    kinds = [rows, rows.withColumn("pk", F.lit("one")), rows.withColumn("extra", F.lit(1.5))]
    for k in range(12):
        put(kinds[k % 3], f"{root}/many", f"f{k:02d}.parquet")
    files = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{root}/many").select("path").collect()]
    groups = readable_groups(spark, files)
    # As many groups as schemas, however the files alternate.
    assert sorted(len(g) for g in groups) == [4, 4, 4] and sorted(f for g in groups for f in g) == sorted(files)
    assert all(len({spark.read.parquet(f).schema.simpleString() for f in g}) == 1 for g in groups)
    assert readable_groups(spark, []) == []
    assert readable_groups(spark, [f.removeprefix("file:") for f in files[:1]]) == [[files[0].removeprefix("file:")]]


def test_schema_of_files_wherever_they_are(spark, root):
    from cdclake.sources.raw import NoSchemaNoData, infer_schema

    put(load(spark, (1, "a")), f"{root}/raw", "a.parquet")
    put(load(spark, (2, "b")).withColumn("extra", F.lit(1)), f"{root}/old", "b.parquet")
    here = [r.path for f in ("raw", "old") for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{root}/{f}").select("path").collect()]
    # One file is where it was found, the other one where it has been moved to.
    schema = infer_schema(spark, [here[0], f"{root}/raw/gone.parquet"], [f"{root}/old/gone.parquet", here[1]])
    assert "extra" in schema.names
    with pytest.raises(NoSchemaNoData):
        infer_schema(spark, [f"{root}/none.parquet"], [f"{root}/no.parquet"])
