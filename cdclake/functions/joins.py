"""Equi-joins whose left side may be skewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.functions.columns import all_of, any_null, quoted, row_digest

_LEFT_SALT = "__left_salt"
_RIGHT_SALT = "__right_salt"
_NULL_PARTS = 1024


def _zero(names) -> Column:
    # 0, but computed from the key: the optimizer would remove a constant from the join keys. It is
    # never null, so no filter on it is pushed into one side, which would keep Spark from using a
    # shuffle of the same rows twice.
    return F.xxhash64(*[quoted(n) for n in names]).bitwiseAND(F.lit(0))


def spread_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str) -> DataFrame:
    """Join on pairs of columns; keys of ``right`` are unique, any share of ``left`` may hold one key.

    Rows of ``left`` with a null key match nothing. They get a salt, so they spread over tasks
    instead of meeting in one. The salt is a join key on the right as well, always 0 there: that
    makes both sides exchanges of this join, which adaptive execution needs to split a hot key.
    """
    keys = [a for a, _ in pairs]
    spread = F.pmod(row_digest(left), F.lit(_NULL_PARTS))
    left = left.withColumn(_LEFT_SALT, F.when(any_null(keys), spread).otherwise(_zero(keys)))
    right = right.withColumn(_RIGHT_SALT, _zero([b for _, b in pairs]))
    same = all_of([quoted(a) == quoted(b) for a, b in pairs])
    return left.join(right, same & (quoted(_LEFT_SALT) == quoted(_RIGHT_SALT)), how).drop(_LEFT_SALT, _RIGHT_SALT)
