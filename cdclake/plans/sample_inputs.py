"""Change feeds, snapshots and archives derived from the sample tables, in Spark and in SQL.

Every input uses all rows of the table it comes from. Faults of a feed (null keys, bad times ...)
are put where the second of the event time has a certain value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.contracts import VALIDATION_TYPE, TableContract

FEED_CONTRACT = TableContract(
    source="shop", table="activity", keys=("pk",), version="3",
    schema=T.StructType([
        T.StructField("pk", T.LongType(), False),
        T.StructField("data", T.StringType(), False),
        T.StructField("val", T.DoubleType(), False),
        T.StructField("tod", T.StringType(), True, {VALIDATION_TYPE: "time"}),
    ]),
)

ORDERS_CONTRACT = TableContract(
    source="shop", table="orders", keys=("id",), version="1",
    schema=T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("priority", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
    ]),
)

STAMP = "20250101000000"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _time_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of customers, one per event."""
    second = F.second("ts")
    event = F.col("event_type")
    op = (
        F.when(second == 13, F.lit(None)).when(second == 41, "X").when(event == "error", "D")
        .when(event == "signup", "I").otherwise("U")
    )
    return table(spark, sf, "events").select(
        F.when(second != 7, F.col("user_id") * 11).alias("pk"),
        event.alias("data"),
        F.when(second != 34, F.col("value")).alias("val"),
        F.when(second == 21, "24:00:00").otherwise(F.date_format("ts", "HH:mm:ss")).alias("tod"),
        op.alias("Op"),
        F.when(second != 55, _time_text("ts")).alias("_timestamp"),
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("checkpoint_col"),
    )


FEED_SQL = """
feed AS (
  SELECT CASE WHEN second(ts) <> 7 THEN user_id * 11 END AS pk,
         event_type AS data,
         CASE WHEN second(ts) <> 34 THEN value END AS val,
         CASE WHEN second(ts) = 21 THEN '24:00:00' ELSE strftime(ts, '%H:%M:%S') END AS tod,
         CASE WHEN second(ts) = 13 THEN NULL WHEN second(ts) = 41 THEN 'X'
              WHEN event_type = 'error' THEN 'D' WHEN event_type = 'signup' THEN 'I' ELSE 'U' END AS "Op",
         CASE WHEN second(ts) <> 55 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS _timestamp,
         lpad(CAST(event_id AS VARCHAR), 20, '0') AS checkpoint_col
  FROM events)"""

CHECKED_SQL = FEED_SQL + r""",
checked AS (
  SELECT *, nullif(concat_ws('; ',
      CASE WHEN tod IS NOT NULL AND NOT regexp_full_match(tod, '([01]\d|2[0-3]):[0-5]\d:[0-5]\d')
           THEN 'tod must have format HH:mm:ss' END,
      CASE WHEN pk IS NULL THEN 'Record does not have a primary key'
           WHEN "Op" IS NULL THEN 'Missing Op column'
           WHEN "Op" <> 'D' AND (data IS NULL OR val IS NULL OR _timestamp IS NULL)
           THEN 'Required column is null' END), '') AS error
  FROM feed)"""

LATEST_SQL = CHECKED_SQL + """,
latest AS (
  SELECT * EXCLUDE (rn, error) FROM (
    SELECT *, row_number() OVER (PARTITION BY pk
        ORDER BY checkpoint_col DESC NULLS LAST, _timestamp DESC NULLS LAST) AS rn
    FROM checked WHERE error IS NULL)
  WHERE rn = 1)"""


def current(spark: SparkSession, sf: str) -> DataFrame:
    """Stored table before the feed: one row per customer."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pk"), F.col("c_mktsegment").alias("data"),
        F.col("c_acctbal").alias("val"), F.lit("00:00:00").alias("tod"),
        F.lit("I").alias("Op"), F.lit("2023-12-31 00:00:00.000000").alias("_timestamp"),
        F.lit("").alias("checkpoint_col"),
    )


CURRENT_SQL = """
cur AS (
  SELECT c_custkey AS pk, c_mktsegment AS data, c_acctbal AS val, '00:00:00' AS tod, 'I' AS "Op",
         '2023-12-31 00:00:00.000000' AS _timestamp, '' AS checkpoint_col
  FROM customer)"""


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """New full load of orders; some rows differ from the archive."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(F.dayofmonth("o_orderdate") != 5, F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.lit("I").alias("Op"),
        _time_text("o_orderdate").alias("_timestamp"),
        F.lit("").alias("checkpoint_col"),
    )


SNAPSHOT_SQL = """
snapshot AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS amount,
         CASE WHEN day(o_orderdate) <> 5 THEN o_orderpriority END AS priority,
         o_orderstatus AS status, 'I' AS "Op",
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS _timestamp, '' AS checkpoint_col
  FROM orders)"""


def archive(spark: SparkSession, sf: str) -> DataFrame:
    """History of orders: a first version of each, a second one (or a delete) of the low priority ones.

    Orders of status P have other keys here than in the snapshot.
    """
    orders = table(spark, sf, "orders")
    key = F.when(F.col("o_orderstatus") == "P", -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey"))

    def version(rows: DataFrame, amount, op, sequence: str) -> DataFrame:
        return rows.select(
            key.alias("id"), amount.alias("amount"), F.col("o_orderpriority").alias("priority"),
            F.col("o_orderstatus").alias("status"), op.alias("Op"),
            _time_text("o_orderdate").alias("_timestamp"), F.lit(sequence).alias("checkpoint_col"),
        )

    price = F.col("o_totalprice")
    second = orders.where(F.col("o_orderpriority") == "5-LOW")
    deleted = F.when(F.col("o_orderstatus") == "O", "D").otherwise("U")
    return version(orders, price, F.lit("I"), "1").unionByName(version(second, price + 2, deleted, "2"))


ARCHIVE_SQL = """
archive AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS id,
         o_totalprice AS amount, o_orderpriority AS priority, o_orderstatus AS status, 'I' AS "Op",
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS _timestamp, '1' AS checkpoint_col
  FROM orders
  UNION ALL
  SELECT CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END, o_totalprice + 2,
         o_orderpriority, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN 'D' ELSE 'U' END,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), '2'
  FROM orders WHERE o_orderpriority = '5-LOW'),
active AS (
  SELECT * EXCLUDE rn FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY checkpoint_col DESC NULLS LAST) AS rn FROM archive)
  WHERE rn = 1 AND "Op" <> 'D')"""
