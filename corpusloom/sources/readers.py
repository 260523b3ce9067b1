"""Tables, folders of Python files and JSON lines as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.names import pick_name_column


def table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def source_rows(df: DataFrame, code: str = "nn_code", accuracy: str = "accuracy") -> DataFrame:
    """``(row_idx, name, code, accuracy)`` of a table whose name column is the first known one it has; without one names are empty."""
    name = pick_name_column(df.columns)
    acc = F.col(accuracy).cast("double") if accuracy in df.columns else F.lit(None).cast("double")
    order = F.col("row_idx") if "row_idx" in df.columns else F.monotonically_increasing_id()
    return df.select(order.cast("long").alias("row_idx"), (F.col(name).cast("string") if name else F.lit("")).alias("name"), F.col(code).cast("string").alias("code"), acc.alias("accuracy"))


def python_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, text)`` of all ``.py`` files under a folder; files that aren't UTF-8 are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.py").load(root)
    text = F.try_validate_utf8(F.col("content").cast("string"))
    return files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), text.alias("text")).filter("text is not null")


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Distinct sources named in JSON lines, as ``source_path``, ``meta.source_path`` or ``meta.source``; bad lines are skipped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    known = F.from_json("value", "source_path string, meta struct<source_path string, source string>", {"mode": "PERMISSIVE"})
    row = lines.select(known.alias("r"))
    return row.select(F.coalesce("r.source_path", "r.meta.source_path", "r.meta.source").alias("source")).filter("source is not null").distinct()
