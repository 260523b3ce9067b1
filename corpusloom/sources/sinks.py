"""Artifacts: JSON lines, tables of kept and removed records, weights, code files, manifest and report."""

from __future__ import annotations

import json
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import names
from corpusloom.operators.splits import NAMES, overlaps
from corpusloom.sources import files, readers


def _json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(rows: DataFrame, path: str) -> None:
    """A folder of files with one JSON object to a line, null fields included."""
    _json(rows).write.mode("overwrite").text(path)


def write_document(rows: DataFrame, path: str, key: str | None = None) -> None:
    """One JSON document for readers that want a single file: an array, or an object by ``key``.

    The rows pass through the driver one partition at a time and are never held there together.
    """

    def parts():
        yield "{" if key else "["
        shown = rows.select(F.to_json(F.struct(*[c for c in rows.columns if c != key]), {"ignoreNullFields": "false"}).alias("value"), *([key] if key else []))
        for n, row in enumerate(shown.toLocalIterator()):
            yield (",\n" if n else "\n") + (f"{json.dumps(row[key], ensure_ascii=False)}: " if key else "") + row.value
        yield "\n}\n" if key else "\n]\n"

    files.write_text(rows.sparkSession, path, parts())


def kept_records(kept: DataFrame) -> DataFrame:
    return kept.select("id", "name", "accuracy", "family_tag").orderBy("id")


def kept_counts(kept: DataFrame, includes: list[str]) -> DataFrame:
    """``(kind, value, records)``: kept records by family and by the first include prefix that their name begins with."""
    prefix = names.matched_prefix(F.col("name"), includes) if includes else F.lit(None).cast("string")
    kinds = F.array(F.struct(F.lit("family").alias("kind"), F.col("family_tag").alias("value")), F.struct(F.lit("prefix").alias("kind"), prefix.alias("value")))
    return kept.select(F.inline(kinds)).filter("value is not null").groupBy("kind", "value").agg(F.count("*").alias("records"))


def weights(kept: DataFrame, rules: list[tuple[str, float]]) -> DataFrame:
    return kept.select("id", "name", names.sampling_weight(F.col("name"), rules).alias("weight"))


def write_weights(kept: DataFrame, rules: list[tuple[str, float]], path: str) -> None:
    weights(kept, rules).write.mode("overwrite").option("header", True).csv(path)


def file_names(kept: DataFrame) -> DataFrame:
    """``(id, file_name)``: clashing names get a number, in the order of their ids."""
    base = F.concat(names.safe_filename(F.col("name")), F.lit("__"), F.substring("id", 1, 12))
    place = F.row_number().over(Window.partitionBy("_base").orderBy("id"))
    named = kept.select("id", base.alias("_base")).withColumn("_p", place)
    return named.select("id", F.concat("_base", F.when(F.col("_p") > 1, F.concat(F.lit("_"), (F.col("_p") - 1).cast("string"))).otherwise(""), F.lit(".py")).alias("file_name"))


def write_code(kept: DataFrame, folder: str) -> None:
    """One file to a record, written by the executors to the file system that the session writes to; a task that is run again writes the same."""
    uri = files.qualified(kept.sparkSession, folder)

    def write(rows) -> None:
        from pyarrow.fs import FileSystem

        system, root = FileSystem.from_uri(uri)
        system.create_dir(root, recursive=True)
        for row in rows:
            with system.open_output_stream(f"{root}/{row.file_name}") as f:
                f.write(row.code.encode("utf-8"))

    kept.join(file_names(kept), "id").select("file_name", "code").foreachPartition(write)


def manifest(rows: DataFrame, group: str = "group_key", family: str = "family", split: str = "split") -> DataFrame:
    """Per split and family: rows and distinct groups."""
    return rows.groupBy(split, family).agg(F.count("*").alias("rows"), F.count_distinct(group).alias("sources"))


def write_manifest(rows: DataFrame, config: dict, path: str) -> dict:
    """The manifest as one JSON file; what comes to the driver is a count for each split and family, the commonest family first."""
    found = {r.split: r for r in rows.groupBy("split").agg(F.count("*").alias("rows"), F.count_distinct("group_key").alias("sources")).collect()}
    families = rows.groupBy("split", "family").agg(F.count("*").alias("n")).orderBy("split", F.desc("n"), "family").collect()
    count = lambda s: found[s].rows if s in found else 0
    splits = {s: {"split": s, "count": count(s), "unique_sources": found[s].sources if s in found else 0, "family_distribution": {f.family: f.n for f in families if f.split == s}} for s in NAMES}
    shared = {k.removesuffix("_overlap"): v for k, v in overlaps(rows, "group_key", "split").first().asDict().items()}
    total = rows.select("group_key").distinct().count()
    summary = {"counts": {s: count(s) for s in NAMES}, "total_examples": sum(map(count, NAMES)), "unique_sources": total, "overlap": shared}
    out = {"summary": summary, "splits": splits, "config": config}
    files.write_text(rows.sparkSession, path, json.dumps(out, indent=2, ensure_ascii=False, default=str))
    return out


def written_manifest(spark: SparkSession, folder: str) -> dict:
    """Counts and shared sources of the three splits as they lie in a folder of JSON lines, also written there as manifest.json."""
    lines = {s: spark.read.text(f"{folder}/{s}.jsonl").filter(F.trim("value") != "") for s in NAMES}
    counts = {s: d.count() for s, d in lines.items()}
    sources = reduce(DataFrame.unionByName, [readers.read_sources(spark, f"{folder}/{s}.jsonl").select(F.lit(s).alias("split"), F.col("source").alias("group_key")) for s in NAMES])
    shared = {k.removesuffix("_overlap"): v for k, v in overlaps(sources, "group_key", "split").first().asDict().items()}
    summary = {"counts": counts, "total_examples": sum(counts.values()), "unique_sources": sources.select("group_key").distinct().count(), "overlap": shared}
    files.write_text(spark, f"{folder}/manifest.json", json.dumps({"summary": summary}, indent=2))
    return {"summary": summary}


def report(counts: dict, filters: dict, parameters: dict, tables: dict[str, dict]) -> str:
    """The curation report in Markdown."""
    lines = ["# Curation report", "", f"Made at {time.strftime('%Y-%m-%d %H:%M:%S')}."]
    for title, values in (("Counts", counts), ("Filters", filters), ("Parameters", parameters), *((f"Kept by {k}", v) for k, v in tables.items())):
        lines += ["", f"## {title}", "", *([f"- {k}: **{v}**" for k, v in values.items()] or ["- none"])]
    lines += ["", "A record that was removed and brought back counts in both; include prefixes match the beginnings of normalized names only."]
    return "\n".join(lines) + "\n"


EMPTY_REPORT = "# Curation report\n\nNo records are left after the filters.\n"
