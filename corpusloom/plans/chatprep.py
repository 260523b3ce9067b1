"""Stage 2: from source files to checked chat examples in disjoint splits."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.logs import logger
from corpusloom.operators import chat, splits
from corpusloom.sources import readers, sinks
from corpusloom.workspace import Workspace


@dataclass
class ChatPrep:
    source_dir: str = "curation_output/accepted_code"
    out_dir: str = "curation_output/chat_data"
    seed: int = 42
    ratios: tuple = splits.RATIOS
    infill: bool = True
    group_by_source: bool = True
    fix_fences: bool = True
    require_parse: bool = True
    require_module: bool = True
    drop_report: bool = True
    render: bool = False
    template: str = chat.TEMPLATE


def prepared(files: DataFrame, config: ChatPrep = ChatPrep(), ws: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, dropped)`` for files ``(path, text)``: rows have id, messages, meta, group_key, family and split; what was
    dropped is whole, with its reason in ``_drop_reason``; an unreadable file has its path for an id and no messages."""
    ws = ws or Workspace(files.sparkSession)
    examples, unreadable = chat.build_examples(files, config.infill, config.seed)
    seen = ws.table(chat.checked(examples, config.fix_fences, config.require_parse, config.require_module), "checked")
    dropped = seen.filter("drop_reason is not null").withColumnRenamed("drop_reason", "_drop_reason").unionByName(
        unreadable.select(F.col("path").alias("id"), F.col("reason").alias("_drop_reason")), allowMissingColumns=True
    )
    rows = seen.filter("drop_reason is null").drop("drop_reason")
    rows = ws.table(rows.withColumn("group_key", chat.group_key(F.col("meta"), F.col("id"))).withColumn("family", F.coalesce("meta.family", F.lit("unknown"))), "rows")
    if config.group_by_source:
        placed = rows.join(splits.grouped_split(rows, "group_key", "family", "id"), "group_key", "left")
    else:
        placed = rows.join(splits.item_split(rows, "id", "family"), "id", "left")
    placed = placed.withColumn("split", F.coalesce("split", F.lit("train")))
    return ws.table(splits.enforce_disjoint(placed, "group_key", "split"), "splits"), ws.table(dropped, "dropped")


def run(spark: SparkSession, config: ChatPrep) -> dict:
    """Writes the three splits, manifest and drop report; returns counts, paths, what was dropped, unique sources, the configuration and the check of overlaps."""
    rows, dropped = prepared(readers.python_files(spark, config.source_dir), config)
    shared = splits.overlaps(rows, "group_key", "split").first().asDict()
    if any(shared.values()):
        sinks.write_jsonl(rows.groupBy("group_key").agg(F.sort_array(F.collect_set("split")).alias("splits")).filter("size(splits) > 1"), f"{config.out_dir}/_overlap_groups.json")
        raise RuntimeError(f"groups are in more than one split: {shared}")
    paths: dict = {"rendered": {}}
    for name in splits.NAMES:
        own = rows.filter(F.col("split") == name)
        paths[name] = f"{config.out_dir}/{name}.jsonl"
        sinks.write_jsonl(own.select("id", "messages", "meta"), paths[name])
        if config.render:
            paths["rendered"][name] = f"{config.out_dir}/rendered/{name}.jsonl"
            sinks.write_jsonl(chat.rendered(own, config.template), paths["rendered"][name])
    paths["manifest"] = f"{config.out_dir}/manifest.json"
    n_dropped = dropped.count()
    if n_dropped and config.drop_report:
        paths["drop_report"] = f"{config.out_dir}/_drop_report.jsonl"
        sinks.write_jsonl(dropped, paths["drop_report"])
    manifest = sinks.write_manifest(rows, asdict(config), paths["manifest"])
    counts = manifest["summary"]["counts"]
    logger.info("examples: %s, dropped: %d", counts, n_dropped)
    return {
        "counts": {**counts, "total": sum(counts.values())},
        "paths": paths,
        "dropped": n_dropped,
        "unique_sources": {s: manifest["splits"][s]["unique_sources"] for s in splits.NAMES},
        "config": asdict(config),
        "overlap_verification": shared,
        "manifest": manifest,
    }
