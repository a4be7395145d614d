"""Difference between a new snapshot and the replayed archive."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.contracts import DELETE, INSERT, OP, SEQUENCE, UPDATE, TableContract
from cdclake.functions.columns import any_null, any_of, quoted, row_digest
from cdclake.functions.joins import spread_join
from cdclake.functions.types import nullable
from cdclake.operators.changes import active_records


@dataclass(frozen=True)
class ReloadDiff:
    """``upserts`` holds inserts and updates; both views filter it, so it may be persisted once."""

    upserts: DataFrame
    deletes: DataFrame

    @property
    def inserts(self) -> DataFrame:
        return self.upserts.where(F.col(OP) == INSERT)

    @property
    def updates(self) -> DataFrame:
        return self.upserts.where(F.col(OP) == UPDATE)


def reload_stamp(moment: datetime) -> str:
    """Sequence value of a reload: ``yyyyMMddHHmmss`` in UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return moment.strftime("%Y%m%d%H%M%S")


def reload_diff(raw: DataFrame, archive: DataFrame, contract: TableContract, stamp: str) -> ReloadDiff:
    """Changes that bring the archive, replayed, to the state of the snapshot ``raw``."""
    return diff_active(raw, active_records(archive, contract.keys), contract, stamp)


def diff_active(raw: DataFrame, active: DataFrame, contract: TableContract, stamp: str) -> ReloadDiff:
    """Changes that bring the active archive to the state of the snapshot ``raw``.

    Both results use ``active``, so a job persists it to replay the archive once.

    Inserts are snapshot rows with a key the archive lacks, updates are snapshot rows where any
    contract column differs (null-safely), deletes are archive rows with a key the snapshot lacks.
    One left join from the snapshot finds inserts and updates together.
    """
    keys = list(contract.keys)
    compared = contract.schema.names
    old = active.select(*[quoted(n).alias(f"__a_{n}") for n in compared], F.lit(True).alias("__hit"))
    differs = any_of([~quoted(n).eqNullSafe(quoted(f"__a_{n}")) for n in compared if n not in keys])
    op = F.when(quoted("__hit").isNull(), F.lit(INSERT)).when(differs, F.lit(UPDATE))
    stamped = {OP: quoted("__op"), SEQUENCE: F.lit(stamp)}
    upserts = (
        spread_join(raw, old, [(k, f"__a_{k}") for k in keys], "left")
        .withColumn("__op", op)
        .where(quoted("__op").isNotNull())
        .withColumns(stamped)
        .select(*[quoted(c) for c in _with(raw.columns, OP, SEQUENCE)])
    )
    raw_keys = raw.select(*[quoted(k) for k in keys]).distinct()
    deletes = (
        active.join(raw_keys, keys, "left_anti")
        .withColumns({OP: F.lit(DELETE), SEQUENCE: F.lit(stamp)})
        .select(*[quoted(c) for c in _with(active.columns, OP, SEQUENCE)])
    )
    return ReloadDiff(upserts, deletes)


# --- in one pass ------------------------------------------------------------------------------------

#: What a change is for, and the folders a job writes.
KIND = "kind"
_DELETE_KIND, _INSERT_KIND, _UPDATE_KIND = KINDS = ("toDelete", "toInsert", "toUpdate")
_NEW, _OLD, _TIMES, _ALONE = "__new", "__old", "__times", "__alone"


def compare_sides(raw: DataFrame, archive: DataFrame, contract: TableContract) -> DataFrame:
    """One row per key of either side: its row in the snapshot, how many it has there, its active row in the archive.

    One aggregation over the union of both sides: what a task has of a key is one row before the shuffle, so a key
    may hold any share of either side. Rows of the snapshot with a null key have no partner and stay apart.
    """
    keys = list(contract.keys)
    order = F.struct(F.col(SEQUENCE).isNotNull(), F.col(SEQUENCE), F.bitwise_not(row_digest(archive)))
    number = F.when(any_null(keys), F.monotonically_increasing_id())

    def side(df: DataFrame, alone: Column, new: Column, old: Column, rank: Column) -> DataFrame:
        return df.select(*[quoted(k).alias(f"__k_{k}") for k in keys], alone.alias(_ALONE), new.alias(_NEW), old.alias(_OLD), rank.alias("__order"))

    new, old = _row(raw), _row(archive)
    no_new, no_old = (F.lit(None).cast(nullable(df.select(r.alias("r")).schema["r"].dataType)) for df, r in ((raw, new), (archive, old)))
    no_order = F.lit(None).cast(nullable(archive.select(order.alias("o")).schema["o"].dataType))
    both = side(raw, number, new, no_old, no_order).unionByName(side(archive, F.lit(None).cast("long"), no_new, old, order))
    grouped = both.groupBy(*[quoted(f"__k_{k}") for k in keys], _ALONE).agg(
        F.first(_NEW, ignorenulls=True).alias(_NEW), F.count(_NEW).alias(_TIMES), F.max_by(_OLD, "__order").alias(_OLD),
    )
    active = F.col(_OLD).getField(OP) != DELETE
    return grouped.withColumn(_OLD, F.when(active, F.col(_OLD)))


def _row(df: DataFrame) -> Column:
    return F.struct(*[quoted(c) for c in df.columns])


def repeated_keys() -> Column:
    """Does the snapshot have a key of :func:`compare_sides` more than once?"""
    return F.col(_TIMES) > 1


def side_changes(sides: DataFrame, raw: DataFrame, archive: DataFrame, contract: TableContract, stamp: str) -> DataFrame:
    """Changes of :func:`reload_diff` with their ``kind``, but for keys that the snapshot repeats.

    Columns are those of the snapshot, then those that only the archive has; they are null in rows of the other side.
    """
    keys = list(contract.keys)
    new, old = (F.col(c) for c in (_NEW, _OLD))
    differs = any_of([
        ~new.getField(n).eqNullSafe(old.getField(n)) for n in contract.schema.names if n not in keys
    ])
    kind = (
        F.when((F.col(_TIMES) == 0) & old.isNotNull(), F.lit(_DELETE_KIND))
        .when((F.col(_TIMES) == 1) & old.isNull(), F.lit(_INSERT_KIND))
        .when((F.col(_TIMES) == 1) & differs, F.lit(_UPDATE_KIND))
    )
    gone = F.col(KIND) == _DELETE_KIND
    codes = {_DELETE_KIND: DELETE, _INSERT_KIND: INSERT, _UPDATE_KIND: UPDATE}
    op = reduce(lambda so_far, k: F.when(F.col(KIND) == k, F.lit(codes[k])).otherwise(so_far), KINDS, F.lit(None).cast("string"))
    columns = []
    for name in _with(_with(raw.columns, OP, SEQUENCE), *archive.columns):
        if name in (OP, SEQUENCE):
            value = op if name == OP else F.lit(stamp)
        elif name not in archive.columns:
            value = F.when(~gone, new.getField(name))
        elif name not in raw.columns:
            value = F.when(gone, old.getField(name))
        else:
            value = F.when(gone, old.getField(name)).otherwise(new.getField(name))
        columns.append(value.alias(name))
    return sides.withColumn(KIND, kind).where(F.col(KIND).isNotNull()).select(*columns, KIND)


def changes_of_repeated_keys(sides: DataFrame, raw: DataFrame, archive: DataFrame, contract: TableContract,
                             stamp: str) -> DataFrame:
    """The changes that :func:`side_changes` leaves out: each row of the snapshot with a key it has several times."""
    keys = list(contract.keys)
    repeated = sides.where(repeated_keys()).select(*[quoted(f"__k_{k}") for k in keys], _OLD)
    rows = raw.select(*[quoted(k) for k in keys], _row(raw).alias(_NEW))
    joined = spread_join(rows, repeated, [(k, f"__k_{k}") for k in keys], "inner")
    return side_changes(joined.select(_NEW, _OLD, F.lit(1).alias(_TIMES)), raw, archive, contract, stamp)


def _with(columns: list[str], *names: str) -> list[str]:
    return [*columns, *[n for n in names if n not in columns]]
