"""Where intermediate tables go, so that long plans begin anew from files."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a few hundred bytes up to which a table is sent to every executor.
SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint, but only after ``df`` has been counted and is within ``rows``; beyond
    it the same join is a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a checkpoint in the folder of ``spark.checkpoint.dir``: what follows plans
    and recovers from files that every executor sees.  Only a local master may go without the
    setting; then the folder is a temporary one."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="leafgrid-"))
    return df.checkpoint()
