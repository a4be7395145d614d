"""Session settings and shared locations."""

from __future__ import annotations

import math
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_PARTITION_BYTES = 64 << 20
_MAX_PARTITIONS = 50_000

# Settings the jobs rely on. Shuffle sizing is left to adaptive execution: start with many
# partitions on a cluster (spark.sql.shuffle.partitions) and let it coalesce or split them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.scheduler.mode": "FAIR",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.broadcastTimeout": "300",
}


def build_session(name: str = "cdclake", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_sizing = threading.Lock()
_sized: dict[str, list] = {}


@contextmanager
def sized_shuffles(spark: SparkSession, size: int):
    """Run a job with enough shuffle partitions for ``size`` bytes.

    Adaptive execution merges partitions that turn out small but cannot add any, so a large job must
    start with many. Jobs of one session that overlap, in any threads, get the most that one of them
    asks for; the session's own setting comes back with the end of the last one. A higher setting of
    the session stays as it is.
    """
    setting = "spark.sql.shuffle.partitions"
    wanted = min(_MAX_PARTITIONS, math.ceil(size / _PARTITION_BYTES))
    session = str(spark._jsparkSession.hashCode())
    with _sizing:
        # [the session's own setting, what each running job asks for]
        own, asked = _sized.setdefault(session, [spark.conf.get(setting), []])
        asked.append(wanted)
        spark.conf.set(setting, str(max(int(own), *asked)))
    try:
        yield
    finally:
        with _sizing:
            asked.remove(wanted)
            spark.conf.set(setting, str(max([int(own), *asked])))
            if not asked:
                del _sized[session]


def plan_bytes(df: DataFrame) -> int:
    """Spark's size estimate of a frame, exact for one that has been persisted and computed."""
    return int(str(df.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, else, in local mode only, a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cdclake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared root."""
    return f"{shared_root(spark)}/cdclake/{label}-{uuid.uuid4().hex[:12]}"
