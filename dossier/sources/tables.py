"""Reading and writing tables (inventory A1, A7-A11, A14, A15, A17-A19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def scan_documents(spark: SparkSession, path: str, pattern: str = "*.pdf", max_bytes: int | None = None) -> DataFrame:
    """Files below path with size and SHA-256; files above max_bytes keep a null digest."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    digest = F.sha2("content", 256)
    return f.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("size_bytes"), (digest if max_bytes is None else F.when(F.col("length") <= max_bytes, digest)).alias("sha256"))


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, reject: bool = True) -> DataFrame:
    """One JSON object a line under a stated schema; a bad line stops the read, or is kept in `_corrupt_record`."""
    if reject:
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    full = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    return spark.read.schema(full.add("_corrupt_record", "string")).json(path, mode="PERMISSIVE")


def read_numbered_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows under the schema, rejected lines as file, line, text) of JSON lines; a byte-order mark is dropped, blank lines are passed over.

    A line's number is its place in its split and the lines of the file's splits before it, so files of any number of splits are read in parallel."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    t = spark.read.text(path).select("value", at.alias("at"), F.monotonically_increasing_id().alias("id")).select("value", "at.file", "at.block", "id")
    splits = t.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "block", "first", before.alias("before"))
    text = F.regexp_replace("value", "^\ufeff", "")
    parsed = F.from_json(text, f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    r = t.where(F.length(F.trim(text)) > 0).join(splits, ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), text.alias("text"), parsed.alias("row"))
    bad = F.col("row").isNull() | F.col("row._corrupt_record").isNotNull()
    return r.where(~bad).select("file", "line", "row.*").drop("_corrupt_record"), r.where(bad).select("file", "line", "text")


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """A8."""
    return spark.read.json(path, multiLine=True)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows with a header under a stated schema."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def write_jsonl(df: DataFrame, path: str) -> None:
    """A9."""
    df.write.mode("errorifexists").json(path)


def flat_columns(df: DataFrame, columns: list[str], separator: str | None = None) -> DataFrame:
    """The listed columns, missing ones null; nested values as JSON, or arrays of plain values joined."""
    out = []
    for c in columns:
        if c not in df.columns:
            out.append(F.lit(None).cast("string").alias(c))
            continue
        t = df.schema[c].dataType
        if separator is not None and isinstance(t, ArrayType) and not isinstance(t.elementType, (ArrayType, MapType, StructType)):
            out.append(F.array_join(F.transform(c, lambda x: x.cast("string")), separator).alias(c))
        elif isinstance(t, (ArrayType, MapType, StructType)):
            out.append(F.to_json(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def write_flat_csv(df: DataFrame, path: str, columns: list[str], separator: str | None = None) -> None:
    flat_columns(df, columns, separator).write.mode("errorifexists").option("escape", '"').csv(path, header=True)


def save_run(df: DataFrame, root: str, stage: str, run_id: str, partition_by: list[str] | None = None) -> str:
    """One immutable folder for each stage and run; a run that exists is an error."""
    path = f"{root}/stage={stage}/run_id={run_id}"
    df.write.mode("errorifexists").parquet(path, partitionBy=partition_by)
    return path


def latest_run(runs: DataFrame, run_id: str | None = None) -> DataFrame:
    """For each stage the stated run, else the one completed last (ties: the larger id)."""
    if run_id is not None:
        return runs.where(F.col("run_id") == run_id).select("stage", "run_id").distinct()
    return runs.groupBy("stage").agg(F.max(F.struct("completed_at", "run_id"))["run_id"].alias("run_id"))


def stage_metrics(df: DataFrame, stage: str, keys: list[str]) -> DataFrame:
    """Rows by key, with the stage's name."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), *keys, "n")


def require_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """All named inputs, or an error that lists the missing ones."""
    out, lost = {}, []
    for name, path in sorted(paths.items()):
        try:
            out[name] = spark.read.parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            lost.append(f"{name}: {path}")
    if lost:
        raise FileNotFoundError("missing inputs: " + "; ".join(lost))
    return out
