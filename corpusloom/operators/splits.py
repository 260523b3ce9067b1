"""Five ways to split rows or groups, and the checks that no group is in two splits.

Where a shuffled order is wanted, it is the order of a seeded hash, so a run can be repeated at any parallelism.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
RATIOS = (0.8, 0.1, 0.1)
NAMES = ("train", "dev", "test")


def ordered_within(rows: DataFrame, key: str, stratum: str, seed: int = SEED) -> DataFrame:
    """Adds ``place`` (from 1) and ``n`` in the stratum, in the order of a seeded hash of the key.

    Places come from counts of hash ranges and a rank within each range, so a stratum that holds a third of all
    rows is spread over 4096 groups and not sorted by one task.
    """
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)
    hashed = rows.withColumn("_h", digest).withColumn("_r", F.substring("_h", 1, 3))
    sizes = hashed.groupBy(stratum, "_r").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(stratum)
    before = sizes.select(stratum, "_r", (F.sum("_c").over(whole.orderBy("_r")) - F.col("_c")).alias("_before"), F.sum("_c").over(whole).alias("n"))
    ranked = hashed.withColumn("_k", F.row_number().over(Window.partitionBy(stratum, "_r").orderBy("_h", key)))
    return ranked.join(before, [stratum, "_r"]).withColumn("place", F.col("_before") + F.col("_k")).drop("_h", "_r", "_k", "_before")


def by_rounding(place: Column, n: Column, ratios=RATIOS) -> Column:
    """Train and dev get their shares rounded half to even, test the rest."""
    train, dev = F.bround(n * ratios[0]), F.bround(n * ratios[1])
    return F.when(place <= train, "train").when(place <= train + dev, "dev").otherwise("test")


def by_floor(place: Column, n: Column, ratios=RATIOS) -> Column:
    """One group goes to train, two to train and test; more get floors, and test gets one at the cost of dev, or else train."""
    t, d = F.floor(n * ratios[0] + 1e-12), F.floor(n * ratios[1] + 1e-12)
    bare = n - t - d == 0
    dev = F.when(bare & (d > 1), d - 1).otherwise(d)
    train = F.when(bare & (d <= 1) & (t > 1), t - 1).otherwise(t)
    many = F.when(place <= train, "train").when(place <= train + dev, "dev").otherwise("test")
    return F.when(n == 1, "train").when(n == 2, F.when(place == 1, "train").otherwise("test")).otherwise(many)


def family_split(rows: DataFrame, id_col: str, family: str) -> DataFrame:
    """``(id, split)``: whole families, without strata."""
    families = rows.select(family).distinct().withColumn("_all", F.lit(0))
    assigned = ordered_within(families, family, "_all").select(family, by_rounding(F.col("place"), F.col("n")).alias("split"))
    return rows.select(id_col, family).join(assigned, family).select(id_col, "split")


def majority_family(rows: DataFrame, group: str, family: str, order: str) -> DataFrame:
    """``(group, family)``: the commonest family of each group, of equals the one seen first."""
    per = rows.groupBy(group, family).agg(F.count("*").alias("c"), F.min(order).alias("o"))
    return per.groupBy(group).agg(F.min(F.struct((-F.col("c")).alias("c"), "o", F.col(family).alias("f"))).alias("m")).select(group, F.col("m.f").alias(family))


def grouped_split(rows: DataFrame, group: str, family: str, order: str) -> DataFrame:
    """``(group, split)``: source groups, in strata of their majority family, with floors."""
    placed = ordered_within(majority_family(rows, group, family, order), group, family)
    return placed.select(group, by_floor(F.col("place"), F.col("n")).alias("split"))


def source_split(rows: DataFrame, group: str, family: str, order: str) -> DataFrame:
    """``(group, split)``: the same strata, with shares rounded."""
    placed = ordered_within(majority_family(rows, group, family, order), group, family)
    return placed.select(group, by_rounding(F.col("place"), F.col("n")).alias("split"))


def last_family_split(rows: DataFrame, group: str, family: str, order: str) -> DataFrame:
    """``(group, split)``: a group is drawn in every family it has; the last family by first appearance decides."""
    per = rows.groupBy(group, family).agg(F.min(order).alias("o"))
    first = rows.groupBy(family).agg(F.min(order).alias("fo"))
    placed = ordered_within(per.select(group, family), group, family).withColumn("split", by_rounding(F.col("place"), F.col("n")))
    return placed.join(first, family).groupBy(group).agg(F.max_by("split", "fo").alias("split"))


def item_split(rows: DataFrame, id_col: str, family: str) -> DataFrame:
    """``(id, split)``: single rows, in strata of their family, with shares rounded."""
    placed = ordered_within(rows.select(id_col, family), id_col, family)
    return placed.select(id_col, by_rounding(F.col("place"), F.col("n")).alias("split"))


def enforce_disjoint(rows: DataFrame, group: str, split: str) -> DataFrame:
    """Rows of a group that is in several splits stay only in the first of train, dev and test that it is in."""
    rank = F.array_position(F.array(*map(F.lit, NAMES)), F.col(split))
    first = rows.groupBy(group).agg(F.min(rank).alias("_first"))
    return rows.join(first, group).filter(rank == F.col("_first")).drop("_first")


def overlaps(rows: DataFrame, group: str, split: str) -> DataFrame:
    """One row: how many groups are in both splits of each pair."""
    has = lambda s: F.max((F.col(split) == s).cast("int"))
    per = rows.filter(F.col(group).isNotNull()).groupBy(group).agg(*[has(s).alias(s) for s in NAMES])
    both = lambda a, b: F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("long").alias(f"{a}_{b}_overlap")
    return per.agg(both("train", "dev"), both("train", "test"), both("dev", "test"))
