"""One query per operator over the sample tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import dataclasses
import json
import logging
import threading
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import (
    DEFAULT, VALIDATION_TYPE, TableContract, contracts_by_table, load_contracts, schemas_match, with_metadata,
)
from cdclake.functions.columns import equal_within
from cdclake.operators import changes as ch
from cdclake.operators import reconcile as rec
from cdclake.operators.backfill import BackfillError, backfill
from cdclake.operators.fields import declared_fields, field_diff, observed_fields
from cdclake.operators.files import next_ledger, unprocessed_files
from cdclake.operators.keys import in_differing_ranges, key_counts, key_diff, key_projection, key_report
from cdclake.operators.metrics import latency_stats
from cdclake.operators.mirror import mirror_shape
from cdclake.operators.reload import reload_diff
from cdclake.operators.validate import only_inserts, split_valid, validate, violation_rows
from cdclake.plans import jobs, views
from cdclake.plans import sample_inputs as inp
from cdclake.session import scratch_dir
from cdclake.sources import catalog, paths, tables
from cdclake.sources.quarantine import quarantine, quarantine_path, read_quarantine
from cdclake.sources.raw import committed_files, discover_files, file_inventory, listed_path
from cdclake.streaming.cdc import Zones, cdc_stream

log = logging.getLogger(__name__)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return validate(inp.feed(spark, sf), inp.FEED_CONTRACT)


def latest(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = split_valid(checked(spark, sf), inp.FEED_CONTRACT)
    return ch.latest_records(valid, inp.FEED_CONTRACT.keys)


# --- validation and quarantine ----------------------------------------------------------------

@query("validate_rows", f"WITH {inp.CHECKED_SQL} SELECT * FROM checked")
def validate_rows(spark, sf):
    return checked(spark, sf)


@query("valid_rows", f"WITH {inp.CHECKED_SQL} SELECT * EXCLUDE error FROM checked WHERE error IS NULL")
def valid_rows(spark, sf):
    return split_valid(checked(spark, sf))[0]


_PAYLOAD = T.StructType([f for f in inp.FEED_CONTRACT.schema.fields]).add("checkpoint_col", "string")


def _unpacked(rows: DataFrame) -> DataFrame:
    parsed = rows.select("error", F.from_json("raw", _PAYLOAD).alias("r"))
    return parsed.select("error", "r.pk", "r.data", "r.val", "r.tod", "r.checkpoint_col")


@query("quarantine_rows", f"""
WITH {inp.CHECKED_SQL}
SELECT error, pk, data, val, tod, checkpoint_col FROM checked WHERE error IS NOT NULL""")
def quarantine_rows(spark, sf):
    return _unpacked(violation_rows(split_valid(checked(spark, sf))[1]))


@query("quarantine_written", f"""
WITH {inp.CHECKED_SQL}
SELECT error, pk, data, val, tod, checkpoint_col FROM checked WHERE error IS NOT NULL""")
def quarantine_written(spark, sf):
    path = quarantine_path(scratch_dir(spark, "violations"), "structured", "shop", "activity")
    quarantine(split_valid(checked(spark, sf))[1], path, "batch-0")
    return _unpacked(read_quarantine(spark, path))


@query("schema_mismatch", f"""
WITH {inp.CHECKED_SQL}
SELECT concat_ws('; ', CASE WHEN tod IS NOT NULL AND NOT regexp_full_match(tod, '([01]\\d|2[0-3]):[0-5]\\d:[0-5]\\d')
                            THEN 'tod must have format HH:mm:ss' END,
                 'Record does not match schema version 3') AS error,
       checkpoint_col
FROM checked""")
def schema_mismatch(spark, sf):
    rows = inp.feed(spark, sf)
    narrower = rows.drop("data").schema
    return validate(rows, inp.FEED_CONTRACT, narrower).select("error", "checkpoint_col")


# --- latest change and merges -----------------------------------------------------------------

@query("latest_change", f"WITH {inp.LATEST_SQL} SELECT * FROM latest")
def latest_change(spark, sf):
    return latest(spark, sf)


_FEED_COLUMNS = ("pk", "data", "val", "tod", "Op", "_timestamp", "checkpoint_col")


def _taken(condition: str, names=_FEED_COLUMNS) -> str:
    return ", ".join(f'CASE WHEN {condition} THEN n."{c}" ELSE c."{c}" END AS "{c}"' for c in names)


_MERGED_ROWS = f"""
SELECT {_taken("""n."Op" IN ('I', 'U')""")}
FROM cur c LEFT JOIN latest n ON c.pk = n.pk
WHERE n."Op" IS DISTINCT FROM 'D'
UNION ALL
SELECT * FROM latest n WHERE n."Op" <> 'D' AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.pk = n.pk)"""
_MERGED_SQL = f"WITH {inp.LATEST_SQL}, {inp.CURRENT_SQL} {_MERGED_ROWS}"


@query("merge_changes", _MERGED_SQL)
def merge_changes(spark, sf):
    return ch.apply_changes(inp.current(spark, sf), latest(spark, sf), ["pk"], unique=True)


@query("merge_checked_keys", _MERGED_SQL)
def merge_checked_keys(spark, sf):
    return ch.apply_changes(inp.current(spark, sf), latest(spark, sf), ["pk"])


@query("merge_new_columns", f"""
WITH {inp.LATEST_SQL}, {inp.CURRENT_SQL}
SELECT c.pk, c.data, {_taken("n.\"Op\" IN ('I', 'U')", ("val", "tod", "Op", "_timestamp", "checkpoint_col"))},
       CASE WHEN n."Op" IN ('I', 'U') THEN n.data END AS channel
FROM cur c LEFT JOIN latest n ON c.pk = n.pk
WHERE n."Op" IS DISTINCT FROM 'D'
UNION ALL
SELECT n.pk, NULL, n.val, n.tod, n."Op", n._timestamp, n.checkpoint_col, n.data
FROM latest n WHERE n."Op" <> 'D' AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.pk = n.pk)""")
def merge_new_columns(spark, sf):
    changes = latest(spark, sf).withColumnRenamed("data", "channel")
    return ch.apply_changes(inp.current(spark, sf), changes, ["pk"], unique=True)


@query("append_new_rows", f"""
WITH {inp.CHECKED_SQL}, {inp.CURRENT_SQL}
SELECT * FROM cur
UNION ALL
SELECT * EXCLUDE error FROM checked n
WHERE error IS NULL AND "Op" = 'I' AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.pk = n.pk)""")
def append_new_rows(spark, sf):
    loaded = split_valid(validate(only_inserts(inp.feed(spark, sf)), inp.FEED_CONTRACT), inp.FEED_CONTRACT)[0]
    return ch.append_new(inp.current(spark, sf), loaded, ["pk"])


@query("update_existing_rows", f"""
WITH {inp.LATEST_SQL}, {inp.CURRENT_SQL}
SELECT {_taken("n.pk IS NOT NULL")} FROM cur c LEFT JOIN latest n ON c.pk = n.pk""")
def update_existing_rows(spark, sf):
    return ch.update_existing(inp.current(spark, sf), latest(spark, sf), ["pk"], unique=True)


@query("mirror_merge", f"""
WITH {inp.LATEST_SQL}, {inp.CURRENT_SQL}
SELECT c.pk, {_taken("n.\"Op\" = 'U'", ("data", "val", "tod"))}
FROM cur c LEFT JOIN latest n ON c.pk = n.pk
WHERE n."Op" IS DISTINCT FROM 'D'
UNION ALL
SELECT pk, data, val, tod FROM latest n
WHERE n."Op" IN ('I', 'U') AND NOT EXISTS (SELECT 1 FROM cur c WHERE c.pk = n.pk)""")
def mirror_merge(spark, sf):
    mirror = mirror_shape(inp.current(spark, sf))
    changes = mirror_shape(latest(spark, sf), keep_op=True)
    return ch.mirror_changes(mirror, changes, inp.FEED_CONTRACT, unique=True)


@query("mirror_rows", f"""
WITH {inp.FEED_SQL}
SELECT pk, replace(concat(substring(data, 1, 2), chr(0), substring(data, 3)), chr(0), '') AS data_text, val, tod
FROM feed""")
def mirror_rows(spark, sf):
    text = F.concat(F.substring("data", 1, 2), F.lit("\0"), F.substring("data", 3, 100))
    rows = inp.feed(spark, sf).withColumn("Data_Text", text).drop("data")
    return mirror_shape(rows.withColumnRenamed("pk", "PK").withColumnRenamed("val", "Val"))


# --- reload and backfill ----------------------------------------------------------------------

def _diff(spark, sf):
    return reload_diff(inp.snapshot(spark, sf), inp.archive(spark, sf), inp.ORDERS_CONTRACT, inp.STAMP)


_RELOAD = f"WITH {inp.SNAPSHOT_SQL}, {inp.ARCHIVE_SQL}"


def _stamped(alias: str, op: str) -> str:
    columns = ", ".join(f"{alias}.{c}" for c in ("id", "amount", "priority", "status"))
    return f"""SELECT {columns}, '{op}' AS "Op", {alias}._timestamp, '{inp.STAMP}' AS checkpoint_col"""


@query("active_archive", f"WITH {inp.ARCHIVE_SQL} SELECT * FROM active")
def active_archive(spark, sf):
    return ch.active_records(inp.archive(spark, sf), ["id"])


@query("reload_inserts", f"""{_RELOAD} {_stamped("s", "I")} FROM snapshot s
WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.id = s.id)""")
def reload_inserts(spark, sf):
    return _diff(spark, sf).inserts


@query("reload_deletes", f"""{_RELOAD} {_stamped("a", "D")} FROM active a
WHERE NOT EXISTS (SELECT 1 FROM snapshot s WHERE s.id = a.id)""")
def reload_deletes(spark, sf):
    return _diff(spark, sf).deletes


@query("reload_updates", f"""{_RELOAD} {_stamped("s", "U")} FROM snapshot s JOIN active a ON a.id = s.id
WHERE s.amount IS DISTINCT FROM a.amount OR s.priority IS DISTINCT FROM a.priority
   OR s.status IS DISTINCT FROM a.status""")
def reload_updates(spark, sf):
    return _diff(spark, sf).updates


@query("archive_backfill", f"""
WITH {inp.ARCHIVE_SQL}
SELECT *, CAST(NULL AS INTEGER) AS pieces, CAST('2.5' AS DOUBLE) AS weight, 'unknown' AS channel FROM archive""")
def archive_backfill(spark, sf):
    schema = T.StructType(list(inp.ORDERS_CONTRACT.schema.fields))
    schema = (
        schema.add("pieces", T.IntegerType(), True)
        .add("weight", T.DoubleType(), False, {DEFAULT: "2.5"})
        .add("channel", T.StringType(), False, {DEFAULT: "unknown"})
    )
    return backfill(inp.archive(spark, sf), TableContract("shop", "orders", ("id",), schema))


# --- reconciliation ---------------------------------------------------------------------------

_KEYS_SQL = """
WITH a AS (SELECT l_orderkey + l_linenumber AS k FROM lineitem), b AS (SELECT o_orderkey AS k FROM orders)"""
_LINE_KEYS = TableContract("shop", "lines", ("k",), T.StructType([T.StructField("k", T.LongType(), False)]))


def _key_sides(spark, sf):
    lines = inp.table(spark, sf, "lineitem").withColumn("k", F.col("l_orderkey") + F.col("l_linenumber"))
    orders = inp.table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    return key_projection(lines, _LINE_KEYS), key_projection(orders, _LINE_KEYS)


@query("key_mismatches", f"""{_KEYS_SQL},
a1 AS (SELECT k, count(*) AS n FROM a GROUP BY k), b1 AS (SELECT k, count(*) AS n FROM b GROUP BY k)
SELECT k, n AS only_a, CAST(0 AS BIGINT) AS only_b FROM a1 WHERE NOT EXISTS (SELECT 1 FROM b1 WHERE b1.k = a1.k)
UNION ALL
SELECT k, CAST(0 AS BIGINT), n FROM b1 WHERE NOT EXISTS (SELECT 1 FROM a1 WHERE b1.k = a1.k)""")
def key_mismatches(spark, sf):
    return key_counts(*in_differing_ranges(*_key_sides(spark, sf), ["k"]), ["k"])


@query("key_reconciliation", f"""{_KEYS_SQL}
SELECT *, only_a = 0 AND only_b = 0 AS matches FROM (
  SELECT 'shop.lines' AS "table",
         (SELECT count(*) FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = a.k)) AS only_a,
         (SELECT count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.k = a.k)) AS only_b
  UNION ALL
  SELECT 'shop.orders', 0, 0)""")
def key_reconciliation(spark, sf):
    lines, orders = _key_sides(spark, sf)
    pairs = {"shop.lines": (lines, orders), "shop.orders": (orders, orders)}
    return key_report([key_diff(*in_differing_ranges(*p, ["k"]), ["k"], name) for name, p in pairs.items()])


def _op_counts(alias: str) -> str:
    return ", ".join(
        f"""count(*) FILTER (WHERE "Op" = '{code}') AS {alias}{name}"""
        for name, code in (("inserts", "I"), ("updates", "U"), ("deletes", "D"))
    )


@query("counts_by_operation", f"""
WITH {inp.FEED_SQL} SELECT 'shop.' || data AS "table", {_op_counts("")} FROM feed GROUP BY data""")
def counts_by_operation(spark, sf):
    return rec.count_by_op(inp.feed(spark, sf), F.concat(F.lit("shop."), "data"))


@query("combined_counts", f"""
WITH {inp.FEED_SQL}, {inp.ARCHIVE_SQL},
both_sides AS (SELECT 'shop.activity' AS "table", "Op" FROM feed
               UNION ALL SELECT 'shop.orders', "Op" FROM archive UNION ALL SELECT 'shop.orders', 'I' FROM orders)
SELECT "table", {_op_counts("")} FROM both_sides GROUP BY "table" """)
def combined_counts(spark, sf):
    raw = rec.count_by_op(inp.feed(spark, sf), "shop.activity").unionByName(
        rec.count_by_op(inp.snapshot(spark, sf), "shop.orders")
    )
    return rec.combine_counts(raw, rec.count_by_op(inp.archive(spark, sf), "shop.orders"))


def _statistics(spark, sf):
    """Replication statistics as a tool would report them: per source table, names in upper case."""
    op = F.col("Op")
    return inp.feed(spark, sf).groupBy(F.upper("data").alias("table_name")).agg(
        F.count_if(op.isNull()).alias("full_load_rows"),
        F.count_if(op == "I").alias("inserts"), F.count_if(op == "U").alias("updates"),
        F.count_if(op == "D").alias("deletes"),
        F.count_if((op == "I") & F.col("val").isNotNull()).alias("applied_inserts"),
        F.count_if(op == "U").alias("applied_updates"), F.count_if(op == "D").alias("applied_deletes"),
    )


def _known_tables(spark, sf):
    rows = inp.table(spark, sf, "events").where(F.col("event_type") != "click")
    return rows.select(F.lit("shop").alias("source"), F.col("event_type").alias("table")).distinct()


_STATS_SQL = f"""
WITH {inp.FEED_SQL},
raw_counts AS (SELECT 'shop.' || data AS "table", {_op_counts("")} FROM feed GROUP BY data),
read_counts AS (
  SELECT 'shop.' || data AS "table", count(*) FILTER (WHERE "Op" = 'I' OR "Op" IS NULL) AS inserts,
         count(*) FILTER (WHERE "Op" = 'U') AS updates, count(*) FILTER (WHERE "Op" = 'D') AS deletes
  FROM feed WHERE data <> 'click' GROUP BY data),
applied_counts AS (
  SELECT 'shop.' || data AS "table",
         count(*) FILTER (WHERE ("Op" = 'I' AND val IS NOT NULL) OR "Op" IS NULL) AS inserts,
         count(*) FILTER (WHERE "Op" = 'U') AS updates, count(*) FILTER (WHERE "Op" = 'D') AS deletes
  FROM feed WHERE data <> 'click' GROUP BY data)"""


@query("statistics_read", f"{_STATS_SQL} SELECT * FROM read_counts")
def statistics_read(spark, sf):
    return rec.stats_counts(_statistics(spark, sf), _known_tables(spark, sf))[0]


@query("statistics_applied", f"{_STATS_SQL} SELECT * FROM applied_counts")
def statistics_applied(spark, sf):
    return rec.stats_counts(_statistics(spark, sf), _known_tables(spark, sf))[1]


def _near(a: str, b: str, absolute: int, relative: float) -> str:
    return f"abs({a} - {b}) <= greatest({absolute}.0, greatest({a}, {b}) * {relative})"


_PAIRS = [(f"{a}_{n}", f"{b}_{n}") for n in ("inserts", "updates", "deletes")
          for a, b in (("raw", "read"), ("read", "applied"))]


def _change_report(spark, sf):
    raw = rec.count_by_op(inp.feed(spark, sf), F.concat(F.lit("shop."), "data"))
    read, applied = rec.stats_counts(_statistics(spark, sf), _known_tables(spark, sf))
    return rec.change_report(raw, read, applied, absolute=5, relative=0.02)


@query("change_report", f"""{_STATS_SQL},
j AS (
  SELECT r."table",
         r.inserts AS raw_inserts, r.updates AS raw_updates, r.deletes AS raw_deletes,
         d.inserts AS read_inserts, d.updates AS read_updates, d.deletes AS read_deletes,
         a.inserts AS applied_inserts, a.updates AS applied_updates, a.deletes AS applied_deletes,
         FALSE AS missing_in_raw, d."table" IS NULL AS missing_in_read
  FROM raw_counts r LEFT JOIN read_counts d USING ("table") LEFT JOIN applied_counts a USING ("table"))
SELECT *,
  coalesce(NOT missing_in_read AND {" AND ".join(_near(a, b, 5, 0.02) for a, b in _PAIRS)}, FALSE) AS matches,
  CASE WHEN NOT missing_in_read AND {" AND ".join(f"{a} = {b}" for a, b in _PAIRS)} THEN 'MATCH'
       WHEN NOT missing_in_read AND {" AND ".join(_near(a, b, 5, 0.02) for a, b in _PAIRS)}
       THEN 'MATCH (within tolerance)' ELSE 'DOES NOT MATCH' END AS verdict
FROM j""")
def change_report(spark, sf):
    return _change_report(spark, sf)


def _state_counts(spark, sf):
    stores = {
        "source": inp.snapshot(spark, sf),
        "structured": inp.archive(spark, sf),
        "curated": ch.active_records(inp.archive(spark, sf), ["id"]),
    }
    counts = [rec.store_count(df, "shop.orders", name, spark) for name, df in stores.items()]
    customers = inp.table(spark, sf, "customer")
    counts += [rec.store_count(customers, "shop.customer", s, spark) for s in (*stores, "mirror")]
    return rec.state_counts(counts)


_STATE_SQL = f"""
WITH {inp.ARCHIVE_SQL},
counts AS (
  SELECT 'shop.orders' AS "table", (SELECT count(*) FROM orders) AS source,
         (SELECT count(*) FROM archive) AS structured, (SELECT count(*) FROM active) AS curated,
         CAST(NULL AS BIGINT) AS mirror
  UNION ALL
  SELECT 'shop.customer', count(*), count(*), count(*), count(*) FROM customer)"""


@query("state_counts", f"{_STATE_SQL} SELECT * FROM counts")
def state_counts(spark, sf):
    return _state_counts(spark, sf)


_STATE_NEAR = (
    f"{_near('structured', 'curated', 0, 0.25)} AND {_near('source', 'curated', 0, 0.25)} "
    f"AND (mirror IS NULL OR {_near('mirror', 'curated', 0, 0.25)})"
)


@query("state_report", f"""{_STATE_SQL}
SELECT *, {_STATE_NEAR} AS matches,
  CASE WHEN structured = curated AND source = curated AND (mirror IS NULL OR mirror = curated) THEN 'MATCH'
       WHEN {_STATE_NEAR} THEN 'MATCH (within tolerance)' ELSE 'MISMATCH' END AS verdict
FROM counts""")
def state_report(spark, sf):
    return rec.state_report(_state_counts(spark, sf), relative=0.25)


@query("reconcile_checks", f"""{_STATE_SQL},
{_KEYS_SQL.strip()[5:]},
keys AS (SELECT (SELECT count(*) FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = a.k))
              + (SELECT count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.k = a.k)) AS n),
state AS (SELECT {_STATE_NEAR} AS matches FROM counts)
SELECT 'current_state_counts' AS "check", bool_and(matches) AS ok, count(*) AS tables,
       count(*) FILTER (WHERE NOT matches) AS failing FROM state
UNION ALL
SELECT 'primary_key_reconciliation', n = 0, 1, CASE WHEN n = 0 THEN 0 ELSE 1 END FROM keys""")
def reconcile_checks(spark, sf):
    lines, orders = _key_sides(spark, sf)
    return jobs.reconcile(spark, {
        rec.STATE_COUNTS: lambda: rec.state_report(_state_counts(spark, sf), relative=0.25),
        rec.KEY_CHECK: lambda: key_report([key_diff(lines, orders, ["k"], "shop.lines")]),
    }, (rec.STATE_COUNTS, rec.KEY_CHECK)).drop("overall")


@query("reconcile_overall", f"""
WITH checks AS ({SQL["reconcile_checks"]}), changes AS ({SQL["change_report"]}),
every AS (
  SELECT * FROM checks
  UNION ALL
  SELECT 'change_data_counts', coalesce(bool_and(matches), true), count(*), count(*) FILTER (WHERE NOT matches) FROM changes)
SELECT *, (SELECT bool_and(ok) FROM every) AS overall FROM every""")
def reconcile_overall(spark, sf):
    lines, orders = _key_sides(spark, sf)
    return jobs.reconcile(spark, {
        rec.STATE_COUNTS: lambda: rec.state_report(_state_counts(spark, sf), relative=0.25),
        rec.CHANGE_COUNTS: lambda: _change_report(spark, sf),
        rec.KEY_CHECK: lambda: key_report([key_diff(lines, orders, ["k"], "shop.lines")]),
    }, (*rec.DEFAULT_CHECKS, rec.KEY_CHECK))


@query("tolerance", f"""
WITH per_day AS (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) FILTER (WHERE o_orderstatus = 'F') AS a,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS b
  FROM orders GROUP BY 1)
SELECT CAST(d AS VARCHAR) AS d, a, b, {_near('a', 'b', 1, 0.5)} AS near FROM per_day""")
def tolerance(spark, sf):
    status = F.col("o_orderstatus")
    per_day = inp.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").cast("string").alias("d")).agg(
        F.count_if(status == "F").alias("a"), F.count_if(status == "O").alias("b")
    )
    return per_day.withColumn("near", equal_within(F.col("a"), F.col("b"), 1, 0.5))


_NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
_NOW_MS = int(_NOW.timestamp() * 1000)


@query("latency", f"""
WITH {inp.FEED_SQL}
SELECT {_NOW_MS} - max(ms) AS minimum, {_NOW_MS} - min(ms) AS maximum,
       CAST(sum({_NOW_MS} - ms) AS BIGINT) AS sum, count(*) AS total_count
FROM (SELECT epoch_us(CAST(_timestamp AS TIMESTAMP)) // 1000 AS ms FROM feed WHERE _timestamp IS NOT NULL)""")
def latency(spark, sf):
    return latency_stats(inp.feed(spark, sf), "_timestamp", _NOW_MS)


# --- reporting views --------------------------------------------------------------------------

@query("view_establishment", "SELECT s_suppkey AS id, s_name AS name FROM supplier")
def view_establishment(spark, sf):
    places = inp.table(spark, sf, "supplier")
    return views.establishment(places.select(F.col("s_suppkey").alias("agy_loc_id"), F.col("s_name").alias("description")))


@query("view_living_unit", """
SELECT p_partkey AS id, p_brand AS code, p_size AS establishment_id, p_name AS name FROM part""")
def view_living_unit(spark, sf):
    return views.living_unit(inp.table(spark, sf, "part").select(
        F.col("p_partkey").alias("internal_location_id"), F.col("p_brand").alias("internal_location_code"),
        F.col("p_size").alias("agy_loc_id"), F.col("p_name").alias("description"),
    ))


@query("view_person", """
SELECT c_name AS number, o_orderkey AS id, o_custkey AS living_unit_reference, c_mktsegment AS firstname,
       CAST(NULL AS VARCHAR) AS middlename, o_orderpriority AS middename2, c_name AS lastname,
       concat(c_name, ', ', substring(c_mktsegment, 1, 1)) AS name,
       strftime(o_orderdate, '%Y-%m-%d') AS dob, o_orderstatus AS sexcode,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'W3' WHEN 'MACHINERY' THEN 'A4' ELSE c_mktsegment END AS racecode
FROM orders JOIN customer ON o_custkey = c_custkey""")
def view_person(spark, sf):
    bookings = inp.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("offender_book_id"), F.col("o_custkey").alias("living_unit_id"),
        F.col("o_custkey").alias("offender_id"), F.col("o_orderpriority").alias("middle_name_2"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("birth_date"), F.col("o_orderstatus").alias("sex_code"),
    )
    segment = F.col("c_mktsegment")
    code = F.when(segment == "BUILDING", "W8").when(segment == "MACHINERY", "O1").otherwise(segment)
    offenders = inp.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("offender_id"), F.col("c_name").alias("offender_id_display"),
        segment.alias("first_name"), F.lit(None).cast("string").alias("middle_name"),
        F.col("c_name").alias("last_name"), code.alias("race_code"),
    )
    return views.person(bookings, offenders)


@query("view_movement", """
SELECT concat(CAST(l_partkey AS VARCHAR), '.', CAST(l_linenumber AS VARCHAR)) AS id, l_partkey AS prisoner,
       strftime(l_shipdate, '%Y-%m-%d') AS date, strftime(l_shipdate, '%H:%M:%S') AS time,
       l_returnflag AS direction, l_linestatus AS type, l_suppkey AS origin_code, l_partkey AS destination_code,
       CAST(l_quantity AS VARCHAR) AS comment, l_tax AS escort,
       s.s_name AS origin, t.s_name AS destination, o_orderpriority AS reason, o_orderkey AS reason_code
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus
LEFT JOIN supplier s ON l_suppkey = s.s_suppkey LEFT JOIN supplier t ON l_partkey = t.s_suppkey""")
def view_movement(spark, sf):
    movements = inp.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("offender_book_id"), F.col("l_linenumber").alias("movement_seq"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("movement_date"),
        F.date_format("l_shipdate", "HH:mm:ss").alias("movement_time"),
        F.col("l_returnflag").alias("direction_code"), F.col("l_linestatus").alias("movement_type"),
        F.col("l_orderkey").alias("movement_reason_code"), F.col("l_suppkey").alias("from_agy_loc_id"),
        F.col("l_partkey").alias("to_agy_loc_id"), F.col("l_quantity").cast("string").alias("comment_text"),
        F.col("l_tax").alias("escort_code"),
    )
    reasons = inp.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("movement_type"), F.col("o_orderkey").alias("movement_reason_code"),
        F.col("o_orderpriority").alias("description"),
    )
    places = inp.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("agy_loc_id"), F.col("s_name").alias("description")
    )
    return views.movement(movements, reasons, places)


@query("field_differences", """
WITH observed AS (SELECT DISTINCT unnest(json_keys(props)) AS field FROM events),
declared AS (SELECT unnest(['pk', 'data', 'val', 'tod']) AS field)
SELECT field, 'record' AS missing_in FROM declared WHERE field NOT IN (SELECT field FROM observed)
UNION ALL
SELECT field, 'contract' FROM observed WHERE field NOT IN (SELECT field FROM declared)""")
def field_differences(spark, sf):
    observed = observed_fields(inp.table(spark, sf, "events"), "props")
    return field_diff(declared_fields(spark, inp.FEED_CONTRACT), observed)


# --- stored tables ----------------------------------------------------------------------------

def _stored(spark, sf, buckets: int = 4) -> str:
    path = scratch_dir(spark, "table")
    tables.append_new(spark, path, inp.current(spark, sf), ["pk"], buckets=buckets)
    return path


@query("stored_merge", _MERGED_SQL)
def stored_merge(spark, sf):
    path = _stored(spark, sf)
    tables.merge(spark, path, latest(spark, sf), ["pk"], unique=True)
    return tables.read_table(spark, path)


@query("stored_append_new", SQL["append_new_rows"])
def stored_append_new(spark, sf):
    path = _stored(spark, sf)
    loaded = split_valid(validate(only_inserts(inp.feed(spark, sf)), inp.FEED_CONTRACT), inp.FEED_CONTRACT)[0]
    tables.append_new(spark, path, loaded, ["pk"])
    return tables.read_table(spark, path)


@query("stored_append", f"""
WITH {inp.FEED_SQL}, {inp.CURRENT_SQL}
SELECT *, CAST(NULL AS VARCHAR) AS note FROM cur UNION ALL SELECT *, data FROM feed""")
def stored_append(spark, sf):
    path = _stored(spark, sf)
    tables.append(spark, path, inp.feed(spark, sf).withColumn("note", F.col("data")), ["pk"])
    return tables.read_table(spark, path)


@query("stored_update", SQL["update_existing_rows"])
def stored_update(spark, sf):
    path = _stored(spark, sf)
    tables.update(spark, path, latest(spark, sf), ["pk"], unique=True)
    return tables.read_table(spark, path)


@query("stored_compact", _MERGED_SQL)
def stored_compact(spark, sf):
    path = _stored(spark, sf)
    tables.merge(spark, path, latest(spark, sf), ["pk"], unique=True)
    tables.compact(spark, path)
    tables.compact(spark, path, full=True, buckets=2)
    tables.vacuum(spark, path, retain_hours=0, force=True)
    return tables.read_table(spark, path)


@query("overwrite_sized", f"WITH {inp.ARCHIVE_SQL} SELECT * FROM archive")
def overwrite_sized(spark, sf):
    path = scratch_dir(spark, "sized")
    tables.overwrite_sized(inp.archive(spark, sf), path, gigabytes=1.0, cores=4)
    return spark.read.parquet(path)


@query("sized_by_data", f"WITH {inp.ARCHIVE_SQL} SELECT * FROM archive")
def sized_by_data(spark, sf):
    path = scratch_dir(spark, "by_data")
    tables.overwrite_sized(inp.archive(spark, sf), path)
    return spark.read.parquet(path)


@query("stored_append_decimal", """
SELECT o_orderkey AS pk, CAST(CAST(o_totalprice AS DECIMAL(14, 4)) AS VARCHAR) AS price FROM orders
UNION ALL
SELECT -o_orderkey, CAST(CAST(CAST(o_totalprice AS DECIMAL(11, 2)) AS DECIMAL(14, 4)) AS VARCHAR) FROM orders""")
def stored_append_decimal(spark, sf):
    path = scratch_dir(spark, "decimal")
    orders = inp.table(spark, sf, "orders").select(F.col("o_orderkey").alias("pk"), "o_totalprice")
    price = lambda kind: F.col("o_totalprice").cast(kind).alias("price")
    tables.append(spark, path, orders.select("pk", price("decimal(14,4)")), ["pk"], buckets=4)
    tables.append(spark, path, orders.select((-F.col("pk")).alias("pk"), price("decimal(11,2)")), ["pk"])
    try:
        # Values that the column cannot hold are refused before anything is written.
        tables.append(spark, path, orders.select("pk", price("decimal(14,6)")), ["pk"])
    except tables.SchemaConflict:
        return tables.read_table(spark, path).withColumn("price", F.col("price").cast("string"))
    raise AssertionError("a decimal that does not fit was written")


@query("stored_append_struct", """
SELECT o_orderkey AS pk, o_orderstatus AS status, NULL AS priority FROM orders
UNION ALL
SELECT -o_orderkey, o_orderstatus, o_orderpriority FROM orders""")
def stored_append_struct(spark, sf):
    path = scratch_dir(spark, "struct")
    orders = inp.table(spark, sf, "orders")
    status = F.col("o_orderstatus").alias("status")
    old = orders.select(F.col("o_orderkey").alias("pk"), F.struct(status).alias("state"))
    new = orders.select((-F.col("o_orderkey")).alias("pk"), F.struct(F.col("o_orderpriority").alias("priority"), status).alias("state"))
    tables.append(spark, path, old, ["pk"], buckets=4)
    tables.append(spark, path, new, ["pk"])
    return tables.read_table(spark, path).select("pk", "state.status", "state.priority")


@query("stored_keys", f"WITH {inp.CURRENT_SQL} SELECT pk FROM cur")
def stored_keys(spark, sf):
    return key_projection(tables.read_table(spark, _stored(spark, sf)), inp.FEED_CONTRACT)


# --- jobs -------------------------------------------------------------------------------------

def _zones(spark, label: str) -> Zones:
    root = scratch_dir(spark, label)
    return Zones(**{z: f"{root}/{z}" for z in ("raw", "structured", "curated", "violations", "checkpoint", "metrics")},
                 glob="*.parquet", buckets=4)


_ORDERS = ("shop", "orders")
_ACTIVITY = ("shop", "activity")
_CONTRACTS = {_ORDERS: inp.ORDERS_CONTRACT, _ACTIVITY: inp.FEED_CONTRACT}


def _write_raw(df: DataFrame, root: str, name) -> None:
    df.write.mode("append").parquet(f"{root}/{name[0]}/{name[1]}")


def _loaded(spark, sf) -> Zones:
    zones = _zones(spark, "load")
    _write_raw(inp.feed(spark, sf), zones.raw, _ACTIVITY)
    jobs.full_load(spark, [_ACTIVITY, _ORDERS], _CONTRACTS, zones, glob="*.parquet")
    return zones


@query("full_load", f"""
WITH {inp.CHECKED_SQL} SELECT * EXCLUDE error FROM checked WHERE error IS NULL AND "Op" = 'I'""")
def full_load(spark, sf):
    return tables.read_table(spark, inp.FEED_CONTRACT.path(_loaded(spark, sf).curated))


@query("full_load_violations", f"""
WITH {inp.CHECKED_SQL}
SELECT error, pk, data, val, tod, checkpoint_col FROM checked WHERE error IS NOT NULL AND "Op" = 'I'""")
def full_load_violations(spark, sf):
    return _unpacked(read_quarantine(spark, quarantine_path(_loaded(spark, sf).violations, "structured", *_ACTIVITY)))


@query("no_contract_violations", f"""
WITH {inp.FEED_SQL}
SELECT 'Schema does not exist for shop/activity' AS error, pk, data, val, tod, checkpoint_col FROM feed""")
def no_contract_violations(spark, sf):
    zones = _zones(spark, "uncontracted")
    _write_raw(inp.feed(spark, sf), zones.raw, _ACTIVITY)
    jobs.full_load(spark, [_ACTIVITY], {}, zones, glob="*.parquet")
    return _unpacked(read_quarantine(spark, quarantine_path(zones.violations, "structured", *_ACTIVITY)))


@query("bad_files_violations", f"""
WITH {inp.FEED_SQL}, rows_of AS (SELECT checkpoint_col FROM feed UNION ALL SELECT checkpoint_col FROM feed)
SELECT 'Violation - Incompatible schemas across multiple files for shop.activity' AS error, checkpoint_col
FROM rows_of""")
def bad_files_violations(spark, sf):
    zones = _zones(spark, "incompatible")
    rows = inp.feed(spark, sf)
    _write_raw(rows, zones.raw, _ACTIVITY)
    _write_raw(rows.withColumn("val", F.col("val").cast("string")), zones.raw, _ACTIVITY)
    jobs.full_load(spark, [_ACTIVITY], _CONTRACTS, zones, glob="*.parquet")
    kept = read_quarantine(spark, quarantine_path(zones.violations, "structured", *_ACTIVITY))
    return kept.select("error", F.get_json_object("raw", "$.checkpoint_col").alias("checkpoint_col"))


def _streamed(spark, sf) -> Zones:
    """The feed as change files in a stored table that a full load of customers has filled."""
    zones = _zones(spark, "stream")
    for root in (zones.structured, zones.curated):
        tables.append_new(spark, inp.FEED_CONTRACT.path(root), inp.current(spark, sf), ["pk"], buckets=4)
    _write_raw(inp.feed(spark, sf), zones.raw, _ACTIVITY)
    _run_streams(spark, zones)
    return zones


@query("cdc_stream", _MERGED_SQL)
def cdc_stream_curated(spark, sf):
    return tables.read_table(spark, inp.FEED_CONTRACT.path(_streamed(spark, sf).curated))


_PARTS = 3


def _in_parts(spark, sf, label: str, between, **options) -> Zones:
    """The feed in parts by the number of its events, the last ones first; the stream takes in what there is after each."""
    zones = dataclasses.replace(_zones(spark, label), **options)
    for root in (zones.structured, zones.curated):
        tables.append_new(spark, inp.FEED_CONTRACT.path(root), inp.current(spark, sf), ["pk"], buckets=4)
    feed = inp.feed(spark, sf)
    part = F.col("checkpoint_col").cast("long") % _PARTS
    for k in reversed(range(_PARTS)):
        _write_raw(feed.where(part == k), zones.raw, _ACTIVITY)
        between(zones, k)
    _run_streams(spark, zones)
    return zones


def _run_streams(spark, zones: Zones, contracts=_CONTRACTS, **options) -> None:
    for stream in cdc_stream(spark, [_ACTIVITY], contracts, zones, seconds=None, **options):
        stream.awaitTermination()
        if stream.exception():
            raise stream.exception()


@query("cdc_stream_parts", _MERGED_SQL)
def cdc_stream_parts(spark, sf):
    zones = _in_parts(spark, sf, "parts", lambda zones, _: _run_streams(spark, zones))
    return tables.read_table(spark, inp.FEED_CONTRACT.path(zones.curated))


def _reset(spark, sf) -> Zones:
    """A stream takes a part in, loses its checkpoint, and goes on."""
    def once(zones: Zones, k: int) -> None:
        if k == 2:
            _run_streams(spark, zones)
        elif k == 1:
            _run_streams(spark, zones, reset_checkpoint=True)

    return _in_parts(spark, sf, "reset", once)


@query("cdc_stream_reset", _MERGED_SQL)
def cdc_stream_reset(spark, sf):
    return tables.read_table(spark, inp.FEED_CONTRACT.path(_reset(spark, sf).curated))


@query("cdc_stream_reset_violations", f"""
WITH q AS ({SQL['quarantine_rows']})
SELECT * FROM q UNION ALL SELECT * FROM q WHERE CAST(checkpoint_col AS BIGINT) % {_PARTS} = {_PARTS - 1}""")
def cdc_stream_reset_violations(spark, sf):
    # What was read before and after the reset is set aside by both streams.
    path = quarantine_path(_reset(spark, sf).violations, "structured", *_ACTIVITY)
    return _unpacked(read_quarantine(spark, path))


@query("cdc_stream_write_conflict", _MERGED_SQL)
def cdc_stream_write_conflict(spark, sf):
    """The table is compacted over and over while the stream writes to it."""
    done = threading.Event()

    def compact(zones: Zones) -> None:
        path = inp.FEED_CONTRACT.path(zones.curated)
        while not done.is_set():
            try:
                tables.compact(spark, path, full=True, buckets=4)
            except tables.TableConflict:
                log.info("The stream was quicker")
            done.wait(2)

    def begin(zones: Zones, k: int) -> None:
        if not workers:
            workers.append(threading.Thread(target=compact, args=(zones,)))
            workers[0].start()
        _run_streams(spark, zones)

    workers: list[threading.Thread] = []
    try:
        zones = _in_parts(spark, sf, "conflict", begin, attempts=20)
    finally:
        done.set()
        for worker in workers:
            worker.join()
    return tables.read_table(spark, inp.FEED_CONTRACT.path(zones.curated))


@query("cdc_stream_violations", SQL["quarantine_rows"])
def cdc_stream_violations(spark, sf):
    return _unpacked(read_quarantine(spark, quarantine_path(_streamed(spark, sf).violations, "structured", *_ACTIVITY)))


@query("cdc_stream_metrics", f"""
WITH {inp.LATEST_SQL}
SELECT 'shop' AS source, 'activity' AS "table", (SELECT count(*) FROM checked) AS rows_in,
       (SELECT count(*) FROM checked WHERE error IS NOT NULL) AS rows_invalid,
       (SELECT count(*) FROM latest) AS rows_structured, (SELECT count(*) FROM latest) AS rows_curated,
       (SELECT count(_timestamp) FROM latest) AS latency_total_count""")
def cdc_stream_metrics(spark, sf):
    metrics = spark.read.parquet(inp.FEED_CONTRACT.path(_streamed(spark, sf).metrics))
    return metrics.select("source", "table", "rows_in", "rows_invalid", "rows_structured", "rows_curated",
                          "latency_total_count")


def _reloaded(spark, sf, kind: str) -> DataFrame:
    root = scratch_dir(spark, "reload")
    _write_raw(inp.snapshot(spark, sf), f"{root}/raw", _ORDERS)
    _write_raw(inp.archive(spark, sf), f"{root}/archive", _ORDERS)
    jobs.reload_diff_job(spark, [_ORDERS], _CONTRACTS, f"{root}/raw", f"{root}/archive", f"{root}/out",
                         datetime(2025, 1, 1), glob="*.parquet")
    return spark.read.parquet(f"{root}/out/{kind}/shop/orders")


@query("reload_job_inserts", SQL["reload_inserts"])
def reload_job_inserts(spark, sf):
    return _reloaded(spark, sf, "toInsert")


@query("reload_job_updates", SQL["reload_updates"])
def reload_job_updates(spark, sf):
    return _reloaded(spark, sf, "toUpdate")


@query("reload_job_deletes", SQL["reload_deletes"])
def reload_job_deletes(spark, sf):
    return _reloaded(spark, sf, "toDelete")


@query("backfill_job", SQL["archive_backfill"].replace(", CAST('2.5' AS DOUBLE) AS weight, 'unknown' AS channel", ""))
def backfill_job(spark, sf):
    root = scratch_dir(spark, "backfill")
    _write_raw(inp.archive(spark, sf), f"{root}/archive", _ORDERS)
    schema = T.StructType(list(inp.ORDERS_CONTRACT.schema.fields)).add("pieces", T.IntegerType(), True)
    contract = TableContract("shop", "orders", ("id",), schema)
    jobs.archive_backfill(spark, {_ORDERS: contract}, f"{root}/archive", f"{root}/out", glob="*.parquet")
    return spark.read.parquet(f"{root}/out/shop/orders")


@query("published_table", f"""
WITH {inp.LATEST_SQL}, {inp.CURRENT_SQL}, merged AS ({_MERGED_ROWS})
SELECT pk, data, val, tod FROM merged""")
def published_table(spark, sf):
    zones = _streamed(spark, sf)
    names = {n: f"cdclake_{n}" for n in ("archive", "structured", "curated", "public")}
    for name in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    roots = {"archive": zones.raw, "structured": zones.structured, "curated": zones.curated}
    failures = catalog.publish_tables(spark, [inp.FEED_CONTRACT], roots, names)
    for failure in failures.collect():
        raise RuntimeError(failure.reason)
    return spark.table("cdclake_public.shop_activity")


def _public(spark, zones: Zones, prefix: str) -> str:
    names = {n: f"{prefix}_{n}" for n in ("archive", "structured", "curated", "public")}
    for name in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    roots = {"archive": zones.raw, "structured": zones.structured, "curated": zones.curated}
    for failure in catalog.publish_tables(spark, [inp.FEED_CONTRACT], roots, names).collect():
        raise RuntimeError(failure.reason)
    return names["public"]


@query("published_after_merges", f"""
WITH {inp.LATEST_SQL}, {inp.CURRENT_SQL}, merged AS ({_MERGED_ROWS})
SELECT pk, data, val, tod FROM merged""")
def published_after_merges(spark, sf):
    """The view follows merges of the feed's parts, each of which takes files out of folders."""
    zones = _zones(spark, "followed")
    path = inp.FEED_CONTRACT.path(zones.curated)
    tables.append_new(spark, path, inp.current(spark, sf), ["pk"], buckets=2)
    tables.compact(spark, path, full=True, buckets=2, target_mb=0.02)
    _write_raw(inp.feed(spark, sf), zones.raw, _ACTIVITY)
    database = _public(spark, zones, "cdclake_followed")
    rows = latest(spark, sf)
    for k in range(_PARTS):
        tables.merge(spark, path, rows.where(F.abs("pk") % _PARTS == k), ["pk"], unique=True)
        catalog.point_table(spark, database, inp.FEED_CONTRACT, path)
    return spark.table(f"{database}.shop_activity")


@query("switched_table", f"WITH {inp.CURRENT_SQL} SELECT pk, data, val, tod FROM cur")
def switched_table(spark, sf):
    """A public table is pointed to the tables below another root: here those from before the stream."""
    zones = _streamed(spark, sf)
    database = _public(spark, zones, "cdclake_switched")
    other = scratch_dir(spark, "other")
    tables.append_new(spark, inp.FEED_CONTRACT.path(other), inp.current(spark, sf), ["pk"], buckets=4)
    for failure in catalog.switch_tables(spark, [inp.FEED_CONTRACT], other, database).collect():
        raise RuntimeError(failure.reason)
    return spark.table(f"{database}.shop_activity")


@query("cdc_stream_no_contract", SQL["no_contract_violations"])
def cdc_stream_no_contract(spark, sf):
    """A table without contract: its schema is inferred, and the stream sets all of it aside."""
    zones = _zones(spark, "stream_uncontracted")
    _write_raw(inp.feed(spark, sf), zones.raw, _ACTIVITY)
    _run_streams(spark, zones, {})
    return _unpacked(read_quarantine(spark, quarantine_path(zones.violations, "structured", *_ACTIVITY)))


@query("cdc_stream_type_clash", f"""
SELECT 'Violation - some of the input data had incompatible types for column [val]. Tried to use double but found BINARY' AS error,
       lpad(CAST(event_id AS VARCHAR), 20, '0') AS checkpoint_col
FROM events WHERE event_id % {_PARTS} = 1""")
def cdc_stream_type_clash(spark, sf):
    """Files with another type of a column are set aside, and the stream goes on with those before and after."""
    zones = _zones(spark, "clash")
    feed = inp.feed(spark, sf)
    part = F.col("checkpoint_col").cast("long") % _PARTS
    for k in range(_PARTS):
        rows = feed.where(part == k)
        _write_raw(rows.withColumn("val", F.coalesce(F.col("val").cast("string"), F.lit("none"))) if k == 1 else rows, zones.raw, _ACTIVITY)
        _run_streams(spark, zones)
    stored = tables.read_table(spark, inp.FEED_CONTRACT.path(zones.curated))
    if stored.where(part == 1).limit(1).count() or not stored.where(part == 2).limit(1).count():
        raise AssertionError("the stream did not go on with the files that fit")
    kept = read_quarantine(spark, quarantine_path(zones.violations, "structured", *_ACTIVITY))
    kept = kept.where(F.col("error").startswith("Violation"))
    return kept.select("error", F.get_json_object("raw", "$.checkpoint_col").alias("checkpoint_col"))


@query("cdc_stream_archived", _MERGED_SQL)
def cdc_stream_archived(spark, sf):
    """Files that the stream has taken in are moved out of the raw zone meanwhile."""
    archive = scratch_dir(spark, "processed")
    zones = _in_parts(spark, sf, "archived", lambda zones, _: _run_streams(spark, zones), archive_dir=archive)
    return tables.read_table(spark, inp.FEED_CONTRACT.path(zones.curated))


_CONTRACT_FILE = {
    "service": "shop", "namespace": "lake", "name": "Activity_16", "version": "3", "type": "record", "fields": [
        {"name": "pk", "type": "long", "key": "primary"}, {"name": "data", "type": "string"}, {"name": "val", "type": ["double"]},
        {"name": "tod", "type": ["null", "string"], "nullable": True, "metadata": {VALIDATION_TYPE: "time"}},
    ],
}


@query("contracts_from_files", SQL["full_load"])
def contracts_from_files(spark, sf):
    """A full load under a contract read from its file."""
    zones = _zones(spark, "contracted")
    folder = scratch_dir(spark, "contracts")
    spark.createDataFrame([(json.dumps(_CONTRACT_FILE, indent=1),)], "value string").coalesce(1).write.text(folder)
    contracts = contracts_by_table(load_contracts(spark, f"{folder}/*.txt"), [_ACTIVITY])
    _write_raw(inp.feed(spark, sf), zones.raw, _ACTIVITY)
    jobs.full_load(spark, [_ACTIVITY], contracts, zones, glob="*.parquet")
    return tables.read_table(spark, inp.FEED_CONTRACT.path(zones.curated))


@query("schema_verdicts", """
SELECT variant, fits, (SELECT count(*) FROM orders) AS n FROM (VALUES
  ('as declared', TRUE), ('in another order', TRUE), ('no nullable column', TRUE), ('no required column', FALSE),
  ('a column more', FALSE), ('a column renamed', FALSE), ('text for a number', FALSE), ('short for int', TRUE), ('int for short', FALSE)
) v(variant, fits)""")
def schema_verdicts(spark, sf):
    """Do files fit a contract? Told by their schemas, for files of all orders."""
    root = scratch_dir(spark, "variants")
    rows = inp.snapshot(spark, sf)
    number = F.lit(1)
    declared = T.StructType([*with_metadata(inp.ORDERS_CONTRACT.schema).fields, T.StructField("n", T.IntegerType(), False)])
    small = T.StructType([*with_metadata(inp.ORDERS_CONTRACT.schema).fields, T.StructField("n", T.ShortType(), False)])
    rows = rows.withColumn("n", number)
    variants = {
        "as declared": rows, "in another order": rows.select(*reversed(rows.columns)), "no nullable column": rows.drop("priority"),
        "no required column": rows.drop("amount"), "a column more": rows.withColumn("more", number),
        "a column renamed": rows.withColumnRenamed("status", "Status"), "text for a number": rows.withColumn("amount", F.lit("1")),
        "short for int": rows.withColumn("n", F.col("n").cast("short")), "int for short": rows,
    }
    found = []
    for k, (name, variant) in enumerate(variants.items()):
        variant.write.parquet(f"{root}/{k}")
        files = spark.read.parquet(f"{root}/{k}")
        fits = schemas_match(files.schema, small if name == "int for short" else declared)
        found.append(files.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("variant"), F.lit(fits).alias("fits"), "n"))
    return reduce(DataFrame.unionByName, found)


@query("backfill_refused", f"""
WITH {inp.ARCHIVE_SQL}
SELECT 'nullable' AS column_kind, (SELECT count(*) FROM archive) AS n UNION ALL
SELECT 'required', NULL UNION ALL SELECT 'required with default', (SELECT count(*) FROM archive)""")
def backfill_refused(spark, sf):
    """Archived rows that can be brought to a contract with one column more; none if it is required and has no default."""
    kinds = {"nullable": (True, None), "required": (False, None), "required with default": (False, {DEFAULT: "none"})}
    found = []
    for kind, (nullable, metadata) in kinds.items():
        schema = T.StructType([*inp.ORDERS_CONTRACT.schema.fields, T.StructField("channel", T.StringType(), nullable, metadata)])
        try:
            rows = backfill(inp.archive(spark, sf), TableContract("shop", "orders", ("id",), schema))
            n = rows.agg(F.count(F.lit(1)).alias("n"))
        except BackfillError:
            n = spark.range(1).select(F.lit(None).cast("long").alias("n"))
        found.append(n.select(F.lit(kind).alias("column_kind"), "n"))
    return reduce(DataFrame.unionByName, found)


@query("state_counts_unreachable", f"""
WITH loaded AS ({SQL["full_load"]})
SELECT 'shop.activity' AS "table", CAST(0 AS BIGINT) AS source, (SELECT count(*) FROM loaded) AS structured,
       (SELECT count(*) FROM loaded) AS curated, CAST(NULL AS BIGINT) AS mirror""")
def state_counts_unreachable(spark, sf):
    """Counts of a source that is down are 0; the others are counted."""
    def down(contract: TableContract) -> DataFrame:
        raise ConnectionError(f"no source for {contract.full_name}")

    return jobs.state_counts(spark, [inp.FEED_CONTRACT], _loaded(spark, sf), down)


# --- file listings ----------------------------------------------------------------------------

def _rows_of(spark, zones: Zones, files: DataFrame) -> DataFrame:
    """Rows per table in the listed files, of all files in the raw zone."""
    folders = [f"{zones.raw}/{s}/{t}" for s, t in (_ACTIVITY, _ORDERS) if paths.exists(spark, f"{zones.raw}/{s}/{t}")]
    rows = spark.read.schema("Op string").parquet(*folders).select(F.col("_metadata.file_path").alias("path"))
    per_file = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).withColumn("path", listed_path("path"))
    table = F.regexp_extract("path", "/([^/]+)/([^/]+)/[^/]+$", 2)
    return per_file.join(files.select("path"), "path").groupBy(table.alias("table")).agg(F.sum("n").alias("n"))


_FILE_ROWS = "SELECT 'activity' AS \"table\", count(*) AS n FROM events UNION ALL SELECT 'orders', count(*) FROM orders"


def _raw_zone(spark, sf) -> Zones:
    zones = _zones(spark, "files")
    _write_raw(inp.feed(spark, sf), zones.raw, _ACTIVITY)
    _write_raw(inp.snapshot(spark, sf), zones.raw, _ORDERS)
    return zones


@query("discovered_files", _FILE_ROWS)
def discovered_files(spark, sf):
    zones = _raw_zone(spark, sf)
    return _rows_of(spark, zones, discover_files(spark, zones.raw, [_ACTIVITY, _ORDERS, ("shop", "none")], "*.parquet"))


@query("file_inventory", _FILE_ROWS)
def inventory(spark, sf):
    zones = _raw_zone(spark, sf)
    later = datetime.now() + timedelta(days=1)
    return _rows_of(spark, zones, file_inventory(spark, zones.raw, [_ACTIVITY, _ORDERS], older_than=later))


@query("committed_files", "SELECT 'activity' AS \"table\", count(*) AS n FROM events")
def committed(spark, sf):
    zones = _streamed(spark, sf)
    return _rows_of(spark, zones, committed_files(spark, zones.stream_checkpoint(*_ACTIVITY)))


@query("archive_plan", """
SELECT 'activity' AS "table", TRUE AS to_copy, TRUE AS to_delete, count(*) AS n FROM events
UNION ALL SELECT 'orders', TRUE, FALSE, count(*) FROM orders""")
def planned(spark, sf):
    zones = _streamed(spark, sf)
    _write_raw(inp.snapshot(spark, sf), zones.raw, _ORDERS)
    ledger = spark.createDataFrame([], "path string")
    later = datetime.now() + timedelta(days=3)
    plan = jobs.plan_archiving(spark, [_ACTIVITY, _ORDERS], zones, ledger, later)
    parts = []
    for to_delete in (True, False):
        chosen = plan.where(F.col("to_copy") & (F.col("to_delete") == to_delete))
        parts.append(_rows_of(spark, zones, chosen).select(
            "table", F.lit(True).alias("to_copy"), F.lit(to_delete).alias("to_delete"), "n"))
    return parts[0].unionByName(parts[1])


@query("next_ledger", "SELECT 'orders' AS \"table\", count(*) AS n FROM orders")
def ledger_after(spark, sf):
    zones = _raw_zone(spark, sf)
    files = file_inventory(spark, zones.raw, [_ACTIVITY, _ORDERS])
    deleted = files.where(F.col("table") == "activity")
    return _rows_of(spark, zones, next_ledger(files, files, deleted))


@query("unprocessed_files", "SELECT 'orders' AS \"table\", count(*) AS n FROM orders")
def unprocessed(spark, sf):
    zones = _streamed(spark, sf)
    _write_raw(inp.snapshot(spark, sf), zones.raw, _ORDERS)
    listed = file_inventory(spark, zones.raw, [_ACTIVITY, _ORDERS])
    return _rows_of(spark, zones, unprocessed_files(listed, jobs.committed_of(spark, [_ACTIVITY], zones)))
