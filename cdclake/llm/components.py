"""Connected components of a graph of any size, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.tables import written


def _large_star(edges: DataFrame) -> DataFrame:
    # Every node links its larger neighbours to the smallest node it knows.
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Every node links its smaller neighbours, and itself, to the smallest of them.
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo")))


def _state(edges: DataFrame) -> tuple:
    # The hash keeps its high bits out of the sum, which must not overflow.
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").bitwiseAND(0xFFFFFFFF))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Rows (node, component): for each node of an edge the smallest node it reaches.

    Alternates two star contractions until nothing changes, a number of rounds that grows with the
    logarithm of the graph. Minima are aggregated before they are shuffled, so a node may have any
    number of neighbours; joins are plain equi-joins that adaptive execution can split. Each round ends
    in a table in the shared folder. Edges with a null end and loops link nothing; repeated edges count
    once. Without edges the result is empty.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    edges = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), (a != b).alias("apart"))
    edges = written(edges.filter("apart").select("hi", "lo").distinct(), "edges")
    before = None
    state = _state(edges)
    while state[0] and state != before:
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        before, state = state, _state(edges)
    members = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return members.union(roots)
