"""Differences between declared and observed field names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.contracts import TableContract


def declared_fields(spark, contract: TableContract) -> DataFrame:
    names = [(n,) for n in contract.schema.names]
    return spark.createDataFrame(names, "field string")


def observed_fields(records: DataFrame, json_column: str) -> DataFrame:
    """Names of the top-level fields occurring in JSON records."""
    return records.select(F.explode(F.json_object_keys(json_column)).alias("field")).distinct()


def field_diff(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """``field, missing_in`` for names only one side has."""
    return (
        declared.select("field", F.lit(True).alias("d"))
        .join(observed.select("field", F.lit(True).alias("o")), "field", "full_outer")
        .where(F.col("d").isNull() | F.col("o").isNull())
        .select("field", F.when(F.col("d").isNull(), "contract").otherwise("record").alias("missing_in"))
    )
