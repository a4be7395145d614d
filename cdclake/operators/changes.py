"""Latest change per key, and applying changes to a current table.

A merge is written as a left join from the current table plus the unmatched changes, not as a full
outer join:

* with the current table on the left, a small change set is broadcast and the table is not shuffled
  at all, and with a large one adaptive execution can split a hot key of the table (it can split
  neither side of a full outer join);
* the second look at the current table, for unmatched changes, reads its key columns only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.contracts import DELETE, INSERT, OP, SEQUENCE, TIMESTAMP, UPDATE, TableContract
from cdclake.functions.columns import all_of, any_null, quoted, row_digest
from cdclake.functions.joins import spread_join

_RANK = "__rank"
_TIE = "__tie"


@dataclass(frozen=True)
class Merged:
    """Result of a merge: rows of the current table that remain, and rows added to it."""

    remaining: DataFrame
    added: DataFrame | None

    @property
    def rows(self) -> DataFrame:
        return self.remaining if self.added is None else self.remaining.unionByName(self.added)


def _top_row(df: DataFrame, keys, *order: Column) -> DataFrame:
    # A row_number filtered to 1 lets Spark drop all but one row per key before the shuffle, so
    # a key holding a large share of the rows costs no more than any other.
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order, quoted(_TIE))
    return (
        df.withColumn(_TIE, row_digest(df))
        .withColumn(_RANK, F.row_number().over(window))
        .where(quoted(_RANK) == 1)
        .drop(_RANK, _TIE)
    )


def latest_records(df: DataFrame, keys) -> DataFrame:
    """The latest change of each key: highest sequence, then highest timestamp, nulls last."""
    return _top_row(df, keys, F.col(SEQUENCE).desc_nulls_last(), F.col(TIMESTAMP).desc_nulls_last())


def active_records(archive: DataFrame, keys) -> DataFrame:
    """State of a replayed archive: latest change of each key, unless that is a delete."""
    return _top_row(archive, keys, F.col(SEQUENCE).desc_nulls_last()).where(F.col(OP) != DELETE)


def require_unique(changes: DataFrame, keys) -> DataFrame:
    """Fail when two changes carry the same key. Null keys match nothing and may repeat.

    Rows stay where they are: keys are counted beside them, before the shuffle, without the null ones.
    """
    names = [quoted(k) for k in keys]
    counted = changes.where(~any_null(keys)).groupBy(*names).agg(F.count(F.lit(1)).alias(_RANK))
    message = F.concat(F.lit("Several changes for one key: "), F.to_json(F.struct(*names)))
    # Without a repeated key this part has no rows and nothing is raised. The error hangs on the count,
    # so it cannot be moved below it; and all columns do, or the optimizer would drop a part that a
    # later filter on known values empties.
    failure = F.when(quoted(_RANK) > 1, F.raise_error(message))
    failing = counted.where(F.coalesce(failure.cast("boolean"), F.lit(False)))
    values = [quoted(f.name) if f.name in keys else failure.cast(f.dataType).alias(f.name) for f in changes.schema.fields]
    return changes.unionByName(failing.select(*values))


def merge_rows(current: DataFrame, changes: DataFrame, keys, *, replace: Column, delete: Column | None,
               insert: Column | None, assign=None, out=None, small: bool = False, helpers: tuple[str, ...] = (),
               applies: Callable[[Callable[[str], Column]], Column] | None = None) -> Merged:
    """``current`` with ``changes`` applied.

    ``replace``, ``delete`` and ``insert`` are conditions over the change row. ``assign`` lists the
    columns a matched change overwrites, ``out`` the columns of the result, all of both unless given
    but for ``helpers``, which only serve conditions. ``small`` says that the size of ``changes`` has been
    checked to suit a broadcast. ``applies`` may refuse a change for the row it meets: it is given a function
    for the change's columns and makes a condition of them and of the row's.
    """
    carried = [c for c in changes.columns if c not in helpers]
    assign = set(carried) if assign is None else assign
    out = [*current.columns, *[c for c in carried if c not in current.columns]] if out is None else out
    incoming, existing = set(carried), set(current.columns)
    new = changes.select(
        *[quoted(c).alias(f"__n_{c}") for c in changes.columns],
        replace.alias("__replace"),
        (F.lit(False) if delete is None else delete).alias("__delete"),
    )
    pairs = [(k, f"__n_{k}") for k in keys]
    if small:
        joined = current.join(F.broadcast(new), all_of([quoted(a) == quoted(b) for a, b in pairs]), "left")
    else:
        joined = spread_join(current, new, pairs, "left")
    taken = F.lit(True) if applies is None else applies(lambda name: quoted(f"__n_{name}"))
    if delete is not None:
        joined = joined.where(~F.coalesce(quoted("__delete") & taken, F.lit(False)))
    columns = []
    for name in out:
        value = quoted(name) if name in existing else F.lit(None).cast(changes.schema[name].dataType)
        if name in incoming and name in assign:
            value = F.when(quoted("__replace") & taken, quoted(f"__n_{name}")).otherwise(value)
        columns.append(value.alias(name))
    matched = joined.select(*columns)
    if insert is None:
        return Merged(matched, None)
    stored = current.select(*[quoted(k) for k in keys])
    if small:
        # Keep matching keys only, before anything is shuffled.
        stored = stored.join(F.broadcast(changes.select(*[quoted(k) for k in keys])), list(keys), "left_semi")
    added = changes.where(insert).join(stored, list(keys), "left_anti")
    return Merged(matched, added.select(*[
        quoted(n) if n in incoming else F.lit(None).cast(current.schema[n].dataType).alias(n) for n in out
    ]))


def merge_changes(current: DataFrame, changes: DataFrame, keys, *, small: bool = False,
                  newer: str | None = None) -> Merged:
    """:func:`apply_changes` in two parts, for changes known to be unique."""
    op, text, applies = F.col(OP), F.lit(""), None
    if newer in current.columns and newer in changes.columns:
        def applies(new):
            return F.coalesce(new(newer), text) >= F.coalesce(quoted(newer), text)
    return merge_rows(
        current, changes, keys, small=small, applies=applies,
        replace=op.isin(INSERT, UPDATE), delete=op == DELETE, insert=op != DELETE,
    )


def apply_changes(current: DataFrame, changes: DataFrame, keys, *, unique: bool = False,
                  sequence_by: str | None = None) -> DataFrame:
    """Merge changes into a lake table.

    A matched insert or update overwrites all columns the change carries, a matched delete drops
    the row, an unmatched change is added unless it is a delete, anything else changes nothing.
    Columns the change lacks keep their value, columns new with the change are null in old rows.
    Fails on several changes for one key; pass ``unique=True`` after :func:`latest_records`.
    With ``sequence_by``, a matched change with a lower value there than the row's changes nothing.
    """
    changes = changes if unique else require_unique(changes, keys)
    return merge_changes(current, changes, keys, newer=sequence_by).rows


def mirror_changes(current: DataFrame, changes: DataFrame, contract: TableContract, *,
                   unique: bool = False) -> DataFrame:
    """Merge changes, in mirror shape, into a mirror table of the contract's columns.

    Differs from the lake merge: a matched insert changes nothing, an update sets non-key columns
    only, and an unmatched change is added only if it is an insert or update.
    """
    keys = [k.lower() for k in contract.keys]
    out = [n.lower() for n in contract.schema.names]
    changes = changes if unique else require_unique(changes, keys)
    op = F.col(OP.lower())
    return merge_rows(
        current, changes, keys,
        replace=op == UPDATE, delete=op == DELETE, insert=op.isin(INSERT, UPDATE),
        assign=set(out) - set(keys), out=out,
    ).rows


def merge_updates(current: DataFrame, updates: DataFrame, keys, *, small: bool = False) -> Merged:
    """:func:`update_existing` for updates known to be unique."""
    return merge_rows(current, updates, keys, small=small, replace=F.lit(True), delete=None, insert=None)


def update_existing(current: DataFrame, updates: DataFrame, keys, *, unique: bool = False) -> DataFrame:
    """Overwrite matched rows with all columns of the update; add nothing."""
    updates = updates if unique else require_unique(updates, keys)
    return merge_updates(current, updates, keys).rows


def missing_rows(current: DataFrame, df: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` whose key is not in ``current``, repeated ones included."""
    stored = current.select(*[quoted(k).alias(f"__s_{k}") for k in keys]).distinct()
    return spread_join(df, stored, [(k, f"__s_{k}") for k in keys], "left_anti")


def append_new(current: DataFrame | None, df: DataFrame, keys) -> DataFrame:
    """``current`` plus the rows of ``df`` with new keys; the first write takes all rows."""
    if current is None:
        return df
    return current.unionByName(missing_rows(current, df, keys), allowMissingColumns=True)
