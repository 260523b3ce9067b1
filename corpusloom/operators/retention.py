"""Which records of groups of similar ones stay: the best K, one for each prefix, the structurally distinct, the rescued."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import names
from corpusloom.operators.components import connected_components
from corpusloom.operators.exact import quality_key
from corpusloom.operators.skew import attach
from corpusloom.workspace import Workspace

#: A component of up to so many similar pairs is scanned by one task; others go by rounds.
SCAN_PAIRS = 200_000
#: The first candidates that are compared at once, the factor by which further batches grow, and their bounds in rows and items.
FIRST_BATCH, GROWTH, MOST_ROWS, MOST_ITEMS = 64, 4, 4096, 4_000_000


def keep_best(records: DataFrame, components: DataFrame, k: int, prefixes: list[str], ws: Workspace | None = None) -> DataFrame:
    """``(id, component, reason, canonical)`` for records of components: the K best stay, and so does the best record of every
    prefix that none of those has. ``canonical`` is the component's best; ``reason`` is null for what stays.

    A record's prefix is the first of the list that its name begins with. Both choices are aggregates or ranks that
    Spark limits before the shuffle, so a component that holds a third of all rows is no hot group.
    """
    ws = ws or Workspace(records.sparkSession)
    prefix = names.matched_prefix(F.col("name"), prefixes) if prefixes else F.lit(None).cast("string")
    rows = records.join(components.withColumnRenamed("node", "id"), "id")
    rows = ws.table(rows.select("id", "component", quality_key().alias("key"), prefix.alias("prefix")), "members")
    place = F.row_number().over(Window.partitionBy("component").orderBy("key"))
    top = ws.table(rows.withColumn("place", place).filter(F.col("place") <= k).select("id", "component", "prefix"), "top")
    firsts = rows.filter("prefix is not null").groupBy("component", "prefix").agg(F.min("key").alias("key")).select("component", "prefix", F.col("key.best_id").alias("id"))
    missing = firsts.join(top.select("component", "prefix").distinct(), ["component", "prefix"], "left_anti")
    stay = top.select("id").unionByName(missing.select("id")).withColumn("stays", F.lit(True))
    best = ws.table(rows.groupBy("component").agg(F.min("key").alias("key"), F.count("*").alias("n")).select("component", F.col("key.best_id").alias("canonical"), "n"), "best")
    marked = attach(rows.select("id", "component"), best, ["component"], "n").join(stay, "id", "left")
    return marked.select("id", "component", F.when(F.col("stays").isNull(), "lexical_near_duplicate").alias("reason"), "canonical")


def structural_greedy(records: DataFrame, edges: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """``(id, canonical, similarity)`` removed by the ordered scan over similar pairs: of each pair still standing the worse goes, a tie keeps the earlier.

    ``records`` has ``(id, ord, quality)`` where quality is an ascending rank, equal for equals; ``edges`` has
    ``(a, b, similarity)``. A removal never reaches another component. One of up to SCAN_PAIRS pairs is scanned by one task;
    larger ones go by rounds, in which every row acts that has no earlier row left within two links of it. What it removes
    can't depend on any row that acts in the same round, so the result is that of the scan.
    """
    ws = ws or Workspace(records.sparkSession)
    left = records.select(F.col("id").alias("a"), F.col("ord").alias("oa"), F.col("quality").alias("qa"))
    right = records.select(F.col("id").alias("b"), F.col("ord").alias("ob"), F.col("quality").alias("qb"))
    known = edges.select("a", "b", "similarity").join(left, "a").join(right, "b")
    first = F.col("oa") < F.col("ob")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    ordered = known.select(pick("a", "b").alias("a"), pick("b", "a").alias("b"), pick("oa", "ob").alias("oa"), pick("ob", "oa").alias("ob"), pick("qa", "qb").alias("qa"), pick("qb", "qa").alias("qb"), "similarity")
    pairs = ws.table(ordered, "ordered")
    components = connected_components(pairs, "a", "b", ws)
    sized = pairs.join(components.withColumnRenamed("node", "a"), "a")
    sizes = ws.table(sized.groupBy("component").agg(F.count("*").alias("n")), "sizes")
    few = sized.join(sizes.filter(F.col("n") <= SCAN_PAIRS).select("component"), "component", "left_semi")
    id_type = edges.schema["a"].dataType.simpleString()
    schema = f"id {id_type}, canonical {id_type}, similarity double"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a component's pairs come one after the other, maybe over several batches
        gone, at = set(), None
        for batch in batches:
            out = []
            for component, a, b, qa, qb, s in batch.itertuples(index=False, name=None):
                if component != at:
                    gone, at = set(), component
                if a not in gone and b not in gone:
                    worse, better = (a, b) if qb < qa else (b, a)
                    gone.add(worse)
                    out.append((worse, better, s))
            yield pd.DataFrame(out, columns=["id", "canonical", "similarity"])

    in_order = few.repartition("component").sortWithinPartitions("component", "oa", "ob").select("component", "a", "b", "qa", "qb", "similarity")
    scanned = in_order.mapInPandas(scan, schema)
    if not sizes.filter(F.col("n") > SCAN_PAIRS).limit(1).count():
        return scanned
    many = sized.join(sizes.filter(F.col("n") > SCAN_PAIRS).select("component"), "component", "left_semi").drop("component")
    return scanned.unionByName(_greedy_by_rounds(ws.table(many, "pairs"), ws))


def _greedy_by_rounds(pairs: DataFrame, ws: Workspace) -> DataFrame:
    """``pairs`` are ``(a, b, oa, ob, qa, qb, similarity)``, a before b. Minima go along them with map-side combining."""
    removed = None
    while pairs.limit(1).count():
        # the earliest row that still has pairs to act on, at each row and then within two links of it
        ends = pairs.select(F.col("oa").alias("x"), F.col("oa").alias("m")).unionAll(pairs.select(F.col("ob").alias("x"), F.col("oa").alias("m")))
        near = ws.table(ends.groupBy("x").agg(F.min("m").alias("m"), F.count("*").alias("n")), "near")
        beyond = attach(pairs.select("oa", F.col("ob").alias("x")), near, ["x"], "n").select("oa", "m")
        own = near.select(F.col("x").alias("oa"), "m")
        ready = ws.table(beyond.unionAll(own).groupBy("oa").agg(F.min("m").alias("m")).filter("m = oa").select("oa").join(near.select(F.col("x").alias("oa"), "n"), "oa"), "ready")
        acting = ws.table(attach(pairs, ready, ["oa"], "n").drop("n"), "acting")
        # it goes by the first better one, and before that removes the worse
        loser = acting.filter("qb < qa").groupBy("oa").agg(F.min_by(F.struct(F.col("a").alias("id"), F.col("b").alias("canonical"), "similarity", F.col("oa").alias("x")), "ob").alias("r"), F.min("ob").alias("stop"))
        worse = acting.filter("qb >= qa").join(loser.select("oa", "stop"), "oa", "left").filter("stop is null or ob < stop")
        # a row that two remove in one round can't be: they'd be within two links of each other
        gone = ws.table(worse.select(F.col("b").alias("id"), F.col("a").alias("canonical"), "similarity", F.col("ob").alias("x")).unionByName(loser.select("r.*")), "gone")
        part = gone.drop("x")
        removed = part if removed is None else removed.unionByName(part)
        alive = ws.table(near.select("x", "n").join(gone.select("x"), "x", "left_anti"), "alive")
        waiting = alive.join(ready.select(F.col("oa").alias("x")), "x", "left_anti")
        left = attach(pairs, waiting.withColumnRenamed("x", "oa"), ["oa"], "n").drop("n")
        after = ws.table(attach(left, alive.withColumnRenamed("x", "ob"), ["ob"], "n").select(*pairs.columns), "pairs")
        ws.drop(pairs, near, ready, acting, alive)
        pairs = after
    return removed


def accept_diverse(pool: DataFrame, standing: DataFrame, need: int) -> list:
    """Up to ``need`` ids of ``pool``, best ``key`` first, none too similar to a row of ``standing`` or to one accepted before.

    Both have ``(id, shingles, bag, lexical, structural)``, arrays of distinct hashes and the similarities from which a row
    forbids another; empty sets are similar to nothing. The best candidates are taken in batches, each a query set of bounded size
    that is sent to all standing rows; what comes back is which of the batch are ruled out. Few batches are needed,
    as few rows are asked for; the last may go through the whole pool.
    """
    chosen: list = []
    after, size = None, FIRST_BATCH
    while len(chosen) < need:
        rest = pool if after is None else pool.filter(F.col("key") > F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(after, pool.schema["key"].dataType)]))
        head = rest.orderBy("key").select("key", "id", "lexical", "structural", F.size("shingles").alias("ns"), F.size("bag").alias("nb")).limit(size).collect()
        if not head:
            break
        fit = np.cumsum([r.ns + r.nb for r in head]) <= MOST_ITEMS
        head = head[: max(1, int(fit.sum()))]
        sets = {r.id: r for r in pool.filter(F.col("id").isin([r.id for r in head])).select("id", "shingles", "bag").collect()}
        batch = [(r.id, np.array(sets[r.id].shingles, np.int64), np.array(sets[r.id].bag, np.int64), r.lexical, r.structural) for r in head]
        ruled_out = _ruled_out(batch, standing)
        for i, (id_, shingles, bag, _, _) in enumerate(batch):
            if i in ruled_out or len(chosen) >= need:
                continue
            if not any(_similarity(shingles, s) >= lex or _similarity(bag, b) >= struct for _, s, b, lex, struct in chosen):
                chosen.append(batch[i])
        after = head[-1].key
        size = min(size * GROWTH, MOST_ROWS)
    return [c[0] for c in chosen]


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 0.0
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same / (len(a) + len(b) - same)


class _Batch:
    """Sets of a batch by item, so that a set is compared with all of them at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        items = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        order = np.argsort(items, kind="stable")
        self.owner = owner[order]
        self.items, starts = np.unique(items[order], return_index=True)
        self.bounds = np.append(starts, len(items))

    def similarities(self, other: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.items, other)
        at = at[(at < len(self.items)) & (self.items[np.minimum(at, len(self.items) - 1)] == other)] if len(self.items) else at[:0]
        n = self.bounds[at + 1] - self.bounds[at]
        flat = np.repeat(self.bounds[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(at) else np.zeros(0, np.int64)
        same = np.bincount(self.owner[flat.astype(np.int64)], minlength=len(self.sizes))
        return same / np.maximum(self.sizes + len(other) - same, 1)


def _ruled_out(batch: list[tuple], standing: DataFrame) -> set[int]:
    sent = standing.sparkSession.sparkContext.broadcast((_Batch([b[1] for b in batch]), _Batch([b[2] for b in batch])))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexical, structural = sent.value
        hit = np.zeros(len(lexical.sizes), bool)
        for rows in batches:
            for shingles, bag, lex, struct in zip(*(rows.column(c).to_pylist() for c in range(4))):
                hit |= lexical.similarities(np.array(shingles, np.int64)) >= lex
                if struct <= 1:
                    hit |= structural.similarities(np.array(bag, np.int64)) >= struct
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(hit).astype(np.int32))], names=["i"])

    # no more rows than the batch has from each task
    rows = standing.select("shingles", "bag", "lexical", "structural")
    return {r.i for r in rows.mapInArrow(compare, "i int").distinct().collect()}
