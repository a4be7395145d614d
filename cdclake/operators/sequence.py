"""One feed in several parts: what it has done to each key, late changes, and changes that undo others.

The result of a feed is that of its newest change of each key, on the table as it was before the feed,
however the feed is cut into batches and in whatever order these arrive. For that a *memory* holds a
row for each key the feed has met: sequence and time of the newest change, whatever its operation, the
sequence of the change before that (:data:`LEFT`), and the row as it was before the feed (:data:`BASE`, null
if there was none). An operation that is neither insert,
update nor delete changes nothing; if earlier parts have changed the row, it has to be put back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.contracts import DELETE, INSERT, OP, SEQUENCE, TIMESTAMP, UPDATE
from cdclake.functions.columns import all_of, quoted
from cdclake.functions.joins import spread_join
from cdclake.functions.types import conform, nullable
from cdclake.operators.changes import Merged, merge_rows

BASE, LEFT = "base", "left_by"
#: What a change does to the table, sequence and time it is taken by, whether it puts a row back, and the
#: sequences that row may have: that of the newest change, or, if that was remembered but never merged, of the
#: one before.
_DOES, _MARK, _MARK_TIME, _UNDOES, _WAS, _LEFT = "__does", "__mark", "__mark_time", "__undoes", "__was", "__left"
#: Whether the memory knows the key, and its base.
_KNOWN, _BASE = "__known", "__base"
HELPERS = (_DOES, _MARK, _MARK_TIME, _UNDOES, _WAS, _LEFT, _KNOWN, _BASE)


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def _only_keys_of(df: DataFrame, changes: DataFrame, keys, small: bool) -> DataFrame:
    """Rows that a small set of changes can meet, before anything is shuffled."""
    if not small:
        return df
    wanted = changes.select(*[quoted(k).alias(f"__w_{k}") for k in keys])
    return df.join(F.broadcast(wanted), all_of([quoted(k) == quoted(f"__w_{k}") for k in keys]), "left_semi")


def in_sequence(changes: DataFrame, memory: DataFrame | None, keys, *, small: bool = False) -> DataFrame:
    """Changes, one per key, without those that are older than one of their key in an earlier part.

    Values are those to be merged: of a change that puts a row back they are the base's, or, if there was
    no row, its own. Adds the columns ``HELPERS`` for :func:`merge` and :func:`remembered`. ``small`` says
    that the size of ``changes`` has been checked to suit a broadcast.
    """
    time = F.col(TIMESTAMP) if TIMESTAMP in changes.columns else F.lit(None).cast("string")
    if memory is None:
        kind = nullable(changes.schema)
        known = changes.withColumns({
            _KNOWN: F.lit(False), _WAS: F.lit(None).cast("string"), _LEFT: F.lit(None).cast("string"),
            _BASE: F.lit(None).cast(kind)})
    else:
        kind = memory.schema[BASE].dataType
        seen = _only_keys_of(memory, changes, keys, small).select(
            *[quoted(k).alias(f"__m_{k}") for k in keys], F.lit(True).alias("__met"), F.col(SEQUENCE).alias(_WAS),
            F.col(LEFT).alias(_LEFT), F.col(TIMESTAMP).alias("__met_time"), F.col(BASE).alias(_BASE),
        )
        known = spread_join(changes, seen, [(k, f"__m_{k}") for k in keys], "left")
        known = known.withColumn(_KNOWN, F.col("__met").isNotNull())
        late = F.struct(_text(F.col(_WAS)), _text(F.col("__met_time"))) > F.struct(_text(F.col(SEQUENCE)), _text(time))
        known = known.where(~(F.col(_KNOWN) & late))
    undoes = F.col(_KNOWN) & ~F.col(OP).isin(INSERT, UPDATE, DELETE)
    before = {f.name: f.dataType for f in kind.fields}
    values = []
    for f in changes.schema.fields:
        value = quoted(f.name)
        if f.name not in keys:
            old = F.lit(None).cast(f.dataType)
            if f.name in before:
                old = conform(F.col(_BASE).getField(f.name), before[f.name], f.dataType)
            value = F.when(undoes & F.col(_BASE).isNotNull(), old).otherwise(value)
        values.append(value.alias(f.name))
    return known.select(
        *values, F.when(undoes, F.lit(UPDATE)).otherwise(F.col(OP)).alias(_DOES), F.col(SEQUENCE).alias(_MARK),
        time.alias(_MARK_TIME), undoes.alias(_UNDOES), _WAS, _LEFT, _KNOWN, _BASE,
    )


def merge(current: DataFrame, changes: DataFrame, keys, *, small: bool = False) -> Merged:
    """Merge changes of :func:`in_sequence`.

    None is taken that is older than the row it meets. A row is put back only while it is as the feed left
    it: what another writer has made of it since stays.
    """
    does = F.col(_DOES)
    stored = _text(F.col(SEQUENCE)) if SEQUENCE in current.columns else F.lit("")
    return merge_rows(
        current, changes, keys, small=small, replace=does.isin(INSERT, UPDATE), delete=does == DELETE,
        insert=does != DELETE, helpers=HELPERS,
        applies=lambda new: F.when(
            new(_UNDOES), stored.isin(_text(new(_WAS)), _text(new(_LEFT)))).otherwise(_text(new(_MARK)) >= stored),
    )


def first_rows(changes: DataFrame) -> DataFrame:
    """The rows of a table that begins with changes of :func:`in_sequence`."""
    return changes.where(F.col(_DOES) != DELETE).drop(*HELPERS)


def remembered(changes: DataFrame, current: DataFrame | None, keys, *, small: bool = False) -> DataFrame:
    """The memory's rows of changes from :func:`in_sequence`.

    Keys it knows keep their base, that of others is their row in ``current``, the table without the changes.
    """
    marks = [
        *[quoted(k) for k in keys], F.col(_MARK).alias(SEQUENCE), F.col(_MARK_TIME).alias(TIMESTAMP),
        F.when(F.col(_UNDOES), F.col(_WAS)).otherwise(F.col(_MARK)).alias(LEFT), F.lit(UPDATE).alias(OP),
    ]
    if current is None:
        return changes.select(*marks, F.col(_BASE).alias(BASE))
    rows = _only_keys_of(current, changes.where(~F.col(_KNOWN)), keys, small)
    rows = rows.select(*[quoted(k).alias(f"__b_{k}") for k in keys], F.struct(*[quoted(c) for c in current.columns]).alias("__row"))
    joined = spread_join(changes, rows, [(k, f"__b_{k}") for k in keys], "left")
    known = conform(F.col(_BASE), changes.schema[_BASE].dataType, rows.schema["__row"].dataType)
    return joined.select(*marks, F.when(F.col(_KNOWN), known).otherwise(F.col("__row")).alias(BASE))
