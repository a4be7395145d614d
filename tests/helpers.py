from pyspark.sql import types as T

from cdclake.contracts import TableContract, with_metadata

SCHEMA = T.StructType([T.StructField("pk", T.IntegerType(), False), T.StructField("data", T.StringType(), True)])
STRICT = T.StructType([T.StructField("pk", T.IntegerType(), False), T.StructField("data", T.StringType(), False)])
CONTRACT = TableContract("src", "items", ("pk",), SCHEMA, version="v7")
ROW = "pk int, data string, Op string, _timestamp string, checkpoint_col string"


def ts(second: int) -> str:
    return f"2024-03-01 10:00:{second:02d}.000000"


def changes(spark, *rows):
    """Rows of (pk, data, op, sequence); the event time follows the sequence."""
    full = [(pk, data, op, ts(int(seq or 0) % 60), seq) for pk, data, op, seq in rows]
    return spark.createDataFrame(full, ROW)


def state(df, *columns):
    columns = columns or ("pk", "data")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def declared(schema=SCHEMA):
    return with_metadata(schema)
