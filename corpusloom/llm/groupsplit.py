"""Problem 6: train, validation and test splits that keep related rows together.

Method: iterative minimum-label propagation over the bipartite graph of rows and entities, then stratified
assignment of the groups that keeps every split's distribution of labels close to the whole's.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.names import resolved_path
from corpusloom.operators.components import bipartite_components
from corpusloom.operators.skew import attach
from corpusloom.workspace import Workspace

SPLITS = (("train", 0.8), ("dev", 0.1), ("test", 0.1))
#: Groups of one family and size class are put together by this many slots of their hash.
SLOTS = 64
#: Families too small to keep the shares are placed together in pools of about so many rows.
POOL_ROWS = 20_000


def entities(chat: DataFrame) -> DataFrame:
    """``(id, entity)``: the source and the group that each row names; a group key without a slash names none."""
    key = F.when(F.col("meta.group_key").rlike(r"[/\\]"), resolved_path(F.col("meta.group_key")))
    path = resolved_path(F.col("meta.source_path"))
    return chat.select("id", F.explode(F.array(F.concat(F.lit("p:"), path), F.concat(F.lit("g:"), key))).alias("entity")).filter("id is not null and entity is not null")


def related_groups(rows: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """``(id, first_id)`` for rows ``(id, entity)`` of which the related ones share the smallest id of their group.

    An entity that names a third of all rows is spread (see bipartite_components). Null ids and entities link
    nothing, repeated rows count once, and rows without an entity are in no group.
    """
    return bipartite_components(rows, "id", "entity", ws).select(F.col("row").alias("id"), F.col("component").alias("first_id"))


def assigned_splits(rows: DataFrame, groups: DataFrame, splits=SPLITS, ws: Workspace | None = None) -> DataFrame:
    """``(id, first_id, family, split)`` for rows ``(id, family)``; a row without a group is a group of its own.

    Every group gets one split and counts in the family that most of its rows have. Within a family, groups are put together by
    size class (powers of two) and by SLOTS hash slots, so a family has at most 64 * SLOTS units, whatever its size, and a
    large group is a unit of its own. Its units are placed by one task, the largest first, each where it adds least to the
    family's squared deviation from the shares; so a family deviates from the shares by no more than its smallest units, unless one group alone is too
    large. Families of fewer rows than one in the smallest share can't keep the shares and are placed together.
    Null and blank families are one family.
    """
    ws = ws or Workspace(rows.sparkSession)
    family = F.coalesce(F.nullif(F.lower(F.trim("family")), F.lit("")), F.lit("unknown"))
    # a row may be delivered twice
    base = rows.filter("id is not null").groupBy("id").agg(F.min(family).alias("family"), F.count("*").alias("weight"))
    table = ws.table(base.join(groups, "id", "left").select("id", F.coalesce("first_id", "id").alias("first_id"), "family", "weight"), "rows")
    per = table.groupBy("first_id", "family").agg(F.sum("weight").alias("n"), F.count("*").alias("ids"))
    facts = per.groupBy("first_id").agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"), F.max_by("family", F.struct("n", "family")).alias("stratum"))
    size_class = F.floor(F.log2("n")).cast("int")
    facts = ws.table(facts.withColumns({"class": size_class, "slot": F.pmod(F.xxhash64("first_id"), F.lit(SLOTS)).cast("int")}), "groups")
    units = facts.groupBy("stratum", "class", "slot").agg(F.sum("n").alias("n"))
    least = 1 / min(p for _, p in splits)
    whole = units.groupBy("stratum").agg(F.sum("n").alias("all"))
    units = ws.table(units.join(whole, "stratum").withColumn("h", F.xxhash64("stratum", "class", "slot")), "units")
    small = units.filter(F.col("all") < least).agg(F.sum("n")).first()[0] or 0
    # small families are placed together, about POOL_ROWS rows at a time
    pool = F.when(F.col("all") < least, F.pmod(F.xxhash64("stratum"), F.lit(1 + small // POOL_ROWS)))
    names, shares = [s for s, _ in splits], [p for _, p in splits]

    def place(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["n", "h"], ascending=[False, True])
        lack = [float(batch.n.sum()) * p for p in shares]
        out = []
        for n in batch.n.tolist():
            # squared deviation added, relative to what each split should hold
            best = min(range(len(names)), key=lambda i: ((n - 2 * lack[i]) / shares[i], i))
            lack[best] -= n
            out.append(names[best])
        return batch.assign(split=out)[["stratum", "class", "slot", "split"]]

    by = units.withColumn("pool", pool).withColumn("alone", F.when(F.col("pool").isNull(), F.col("stratum")))
    placed = by.groupBy("alone", "pool").applyInPandas(place, "stratum string, class int, slot int, split string")
    final = ws.table(facts.join(ws.table(placed, "placed"), ["stratum", "class", "slot"]).select("first_id", "ids", "split"), "splits")
    return attach(table, final, ["first_id"], "ids").select("id", "first_id", "family", "split")


def p6_found(spark, sf_dir: str) -> DataFrame:
    groups = related_groups(entities(spark.read.parquet(f"{sf_dir}/chat_examples.parquet")))
    return groups.filter("id <> first_id").select("first_id", "id")


def p6_splits(spark, sf_dir: str) -> DataFrame:
    chat = spark.read.parquet(f"{sf_dir}/chat_examples.parquet")
    ws = Workspace(spark)
    groups = ws.table(related_groups(entities(chat), ws), "groups")
    return assigned_splits(chat.select("id", F.col("meta.family").alias("family")), groups, ws=ws)
