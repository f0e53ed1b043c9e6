"""Run journal: which reports of a month are done, for which inputs.

One small JSON note per report under ``<sink>/_journal``, in the folder that all machines share. A note is
written when its report is, and taken away when the report is begun again, so a run that stops leaves
notes of whole reports only.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venue_analytics.operators.core import Tables
from venue_analytics.sources.sinks import remove

JOURNAL = "_journal"
_NOTE = "report string, month string, state string"


def _files(spark: SparkSession, df: DataFrame | None) -> list[str] | None:
    """Name, length and time of every file that a frame reads; None if it reads anything but files."""
    if df is None:
        return []
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    if any("LogicalRelation" not in leaves.apply(i).getClass().getName() for i in range(leaves.size())):
        return None
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = []
    for name in sorted(df.inputFiles()):
        at = path(name)
        status = at.getFileSystem(conf).getFileStatus(at)
        found.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return found


def fingerprint(spark: SparkSession, t: Tables, **parameters) -> str | None:
    """Digest of the input files and parameters of a run; None when an input isn't files, so that nothing tells
    whether it has changed."""
    files = [_files(spark, df) for df in (t.posts, t.places, t.merchants, t.audits, t.accounts)]
    if any(f is None for f in files):
        return None
    return hashlib.sha256(json.dumps([files, parameters], sort_keys=True).encode()).hexdigest()


class Journal:
    def __init__(self, spark: SparkSession, sink_base: str, month: str):
        self.spark, self.month, self.base = spark, month, f"{sink_base.rstrip('/')}/{JOURNAL}"

    def _path(self, report: str) -> str:
        return f"{self.base}/{self.month}/{report}"

    def done(self, report: str, state: str | None) -> bool:
        """True if the report was finished for this state of the inputs."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._path(report)}/_SUCCESS")
        if state is None or not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return False
        note = self.spark.read.schema(_NOTE).json(self._path(report)).first()
        return note is not None and note["state"] == state

    def begin(self, report: str) -> None:
        remove(self.spark, self._path(report))

    def finish(self, report: str, state: str | None) -> None:
        note = self.spark.range(1).select(F.lit(report).alias("report"), F.lit(self.month).alias("month"), F.lit(state).alias("state"))
        note.coalesce(1).write.mode("overwrite").json(self._path(report))

    def notes(self) -> DataFrame:
        """All notes of the month."""
        return self.spark.read.schema(_NOTE).json(f"{self.base}/{self.month}/*")
