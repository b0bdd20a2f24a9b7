"""Stage tables between the steps of a filing run (inventory A14, A15).

A stage writes one immutable Parquet folder for each run, and then one row of an append-only run log. The pointer to a stage's latest table is read off the
log: the completed run that ended last. A run that fails leaves a FAILED row, so it never moves the pointer, whatever it had written.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import latest_run, save_run

LOG = "stage string, run_id string, status string, completed_at double, rows long, path string, reason string"
_OWN: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """The shared folder that the session names for intermediate tables; a temporary one on a local master where it names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return _OWN.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="dossier-stages-"))


class Stages:
    """The stage tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log(self) -> DataFrame:
        """All runs so far: stage, run_id, status (COMPLETED or FAILED), completed_at, rows, path, reason."""
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.root}/runs")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], LOG)

    def _note(self, stage: str, run_id: str, status: str, rows: int | None, path: str | None, reason: str | None) -> None:
        row = [(stage, run_id, status, time.time(), rows, path, reason)]
        self.spark.createDataFrame(row, LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    def run(self, stage: str, build: Callable[[], DataFrame], run_id: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
        """Builds and writes the stage's table under a run id of its own, notes the run, and reads the table back. An id that was used is an error."""
        run_id = run_id or uuid.uuid4().hex
        try:
            path = save_run(build(), self.root, stage, run_id, partition_by)
            table = self.spark.read.parquet(path)
            rows = table.count()  # from the footers
        except Exception as e:
            self._note(stage, run_id, "FAILED", None, None, str(e)[:500])
            raise
        self._note(stage, run_id, "COMPLETED", rows, path, None)
        return table

    def pointer(self, stage: str, run_id: str | None = None) -> str | None:
        """The stated run if it completed, else the completed run that ended last; None without any."""
        done = self.log().where((F.col("stage") == stage) & (F.col("status") == "COMPLETED"))
        rows = latest_run(done, run_id).collect()  # one row
        return rows[0]["run_id"] if rows else None

    def read(self, stage: str, run_id: str | None = None) -> DataFrame:
        found = self.pointer(stage, run_id)
        if found is None:
            raise FileNotFoundError(f"no completed run of {stage}" + (f" named {run_id}" if run_id else ""))
        return self.spark.read.parquet(f"{self.root}/stage={stage}/run_id={found}")

    def ensure(self, stage: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's latest table, built first where there is none."""
        found = self.pointer(stage)
        return self.read(stage, found) if found else self.run(stage, build)


def kept(df: DataFrame, name: str, join: str | None = "merge") -> DataFrame:
    """df as a table of the workspace, read back: the steps after it don't plan or run those before it again.

    Joins with it sort both sides, unless `join` is None. The planner would go by the size of the files, where columns of repeated values take next to nothing, and gather millions of rows at the driver
    to broadcast them."""
    path = f"{workspace(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table.hint(join) if join else table
