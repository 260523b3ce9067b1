"""Records and exact duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import names
from corpusloom.operators.skew import attach
from corpusloom.workspace import Workspace


def make_records(rows: DataFrame, name: str = "name", code: str = "code", accuracy: str = "accuracy", order: str = "row_idx") -> DataFrame:
    """``(id, name, code, accuracy, code_hash, row_idx, family_tag, size)``; rows whose code is null or blank are left out.

    ``family_tag`` is decided by the name and else by the code; ``size`` is the code's length in characters.
    """
    digest = F.sha2(F.col(code), 256)
    shown = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return rows.filter(F.col(code).rlike(r"\S")).select(
        F.concat_ws("_", digest, F.col(order).cast("string")).alias("id"),
        shown.alias("name"),
        F.col(code).alias("code"),
        names.known_accuracy(F.col(accuracy).cast("double")).alias("accuracy"),
        digest.alias("code_hash"),
        F.col(order).cast("long").alias("row_idx"),
        names.family_of_model(shown, F.col(code)).alias("family_tag"),
        F.length(code).alias("size"),
    )


def quality_key(*before: Column) -> Column:
    """A struct whose minimum is the best record: what is given, then accuracy, code length and name, then row_idx."""
    acc = F.col("accuracy")
    parts = [*[c.alias(f"k{i}") for i, c in enumerate(before)], acc.isNull().alias("unknown"), (-acc).alias("acc"), (-F.col("size")).alias("long"), F.col("name").alias("by_name"), F.col("row_idx").alias("row_idx"), F.col("id").alias("best_id")]
    return F.struct(*parts)


def exact_groups(records: DataFrame, prefer_order: list[str], ws: Workspace | None = None) -> DataFrame:
    """``(id, name, code_hash, canonical, canonical_name, copies, first_row)`` for every record.

    The canonical record of a code is the least by prefix rank and quality. It is a minimum with map-side
    combining, so one code that a third of all rows share is no hot group, and what comes back is spread.
    To drop the result is to drop the table of canonical records that it reads.
    """
    ws = ws or Workspace(records.sparkSession)
    slim = records.withColumn("key", quality_key(names.prefix_rank(F.col("name"), prefer_order))).select("id", "name", "code_hash", "row_idx", "key")
    best = slim.groupBy("code_hash").agg(F.min("key").alias("key"), F.count("*").alias("copies"), F.min("row_idx").alias("first_row"))
    groups = ws.table(best.select("code_hash", F.col("key.best_id").alias("canonical"), F.col("key.by_name").alias("canonical_name"), "copies", "first_row"), "exact")
    out = attach(slim.select("id", "name", "code_hash"), groups, ["code_hash"], "copies")
    out._corpusloom_path = groups._corpusloom_path
    return out


def kept(groups: DataFrame) -> DataFrame:
    return groups.filter("id = canonical").select("id", F.when(F.col("copies") > 1, "canonical_of_exact_group").otherwise("unique").alias("reason"), F.col("first_row").alias("ord"))


def tombstones(groups: DataFrame) -> DataFrame:
    return groups.filter("id <> canonical").select("id", "canonical", F.lit("exact_duplicate").alias("reason"), "name", "canonical_name")
