"""Set logic on file listings: what is new, processed, archived or due for deletion."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unprocessed_files(inventory: DataFrame, committed: DataFrame) -> DataFrame:
    """Listed files no stream has committed; none left means all are processed."""
    return inventory.join(committed.select("path").distinct(), "path", "left_anti")


def archive_plan(inventory: DataFrame, ledger: DataFrame, committed: DataFrame, now: datetime,
                 retention: timedelta = timedelta(days=2)) -> DataFrame:
    """Listed files with ``to_copy`` and ``to_delete``.

    A file is copied unless the ledger has it. It may be deleted, once all copies have succeeded,
    if it is older than the retention period and a stream has committed it.
    """
    done = ledger.select("path").distinct().withColumn("archived", F.lit(True))
    read = committed.select("path").distinct().withColumn("committed", F.lit(True))
    old = F.col("modificationTime") < F.lit(now - retention)
    return (
        inventory.join(done, "path", "left")
        .join(read, "path", "left")
        .withColumns({
            "to_copy": F.col("archived").isNull(),
            "to_delete": F.coalesce(F.col("committed"), F.lit(False)) & old,
        })
        .drop("archived", "committed")
    )


def next_ledger(ledger: DataFrame, copied: DataFrame, deleted: DataFrame) -> DataFrame:
    """Archived files still present in the raw zone: ledger and copied files without deleted ones."""
    return (
        ledger.select("path").unionByName(copied.select("path")).distinct()
        .join(deleted.select("path").distinct(), "path", "left_anti")
    )
