"""Small shared pieces: reading tables and keeping intermediate tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where that is unset on one machine (tests) a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return _OWN.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="dossier-"))


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, which cuts its lineage."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def needed(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that extra columns can't clash with its own."""
    return df.select(*[F.col(f"`{n}`") for n in names])
