"""Problem 4: near-duplicate records, all of them, by PartEnum signatures.

Method: partition the feature domain and enumerate subsets of partitions, so that sufficiently similar sets of one
size band share a signature; candidates are then verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.partenum import signatures
from corpusloom.llm.shingles import chunks, set_key, shingle_sets
from corpusloom.operators import similarity, sketch
from corpusloom.operators.components import connected_components
from corpusloom.operators.skew import attach
from corpusloom.workspace import Workspace

_EPS = 1e-9
_KEYS = ["k1", "k2", "n"]
_PREFIX_BITS, _SIDE_BITS = 22, 2  # beside a set's size in one long


def set_keys(rows: DataFrame, k: int, n_bits: int, id_type: str = "long") -> DataFrame:
    """``(id, k1, k2, n)`` and parity bits for rows ``(id, text)`` that have a shingle, and the partial frequency sketches of 2^n_bits counters in ``(chunk, cells)``."""

    id_arrow = pa.int64() if id_type == "long" else pa.string()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << n_bits, np.uint32)
        names = ["id", "k1", "k2", "n", *sketch.PARITY, "chunk", "cells"]
        seen = False
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                offsets, hashes = shingle_sets(texts[a:b], k)
                sketch.count_into(cells, hashes)
                sizes = np.diff(offsets)
                have = np.flatnonzero(sizes)
                seen |= len(have) > 0
                keys = np.frombuffer(b"".join(set_key(hashes[offsets[i] : offsets[i + 1]]) for i in have), np.int64).reshape(-1, 2)
                parity = sketch.parity(offsets, hashes)[have]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).take(pa.array(have)), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(sizes[have]), *(pa.array(parity[:, i]) for i in range(sketch.PARITY_WORDS)), pa.nulls(len(have), pa.int32()), pa.nulls(len(have), pa.binary())], names=names
                )
        if seen:
            part = sketch.as_batch(cells)
            none = pa.nulls(part.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, id_arrow), *[none] * (3 + sketch.PARITY_WORDS), part.column(0), part.column(1)], names=names)

    return rows.mapInArrow(keyed, f"id {id_type}, k1 long, k2 long, n long, {', '.join(w + ' long' for w in sketch.PARITY)}, chunk int, cells binary")


def frequencies(first: DataFrame):
    """Broadcast of about how often hashes occur in all rows, from the sketches in :func:`set_keys`: at most 4 MB at any size."""
    return first.sparkSession.sparkContext.broadcast(sketch.frequencies(first.filter("chunk is not null").select("chunk", "cells")))


def only(rows: DataFrame, bits, inside: bool) -> DataFrame:
    """The rows ``(id, text)`` whose id may be in the filter, or those that surely aren't."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = sketch.passes(bits.value, np.asarray(batch.column(0)))
            yield batch.filter(pa.array(hit if inside else ~hit))

    return rows.mapInArrow(sift, rows.schema)


def _signature_rows(texts: DataFrame, sent, k: int, threshold: float) -> DataFrame:
    """``(sig, id, facts)``; a signature that many sets may share is split (see :func:`corpusloom.operators.sketch.split_within`).

    ``facts`` packs the set's size, the number of its signatures and the side of a split one.
    """
    block_rows = sketch.BLOCK_ROWS

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sent.value
        for batch in batches:
            ids, found = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            for a, b in chunks(found):
                offsets, hashes = shingle_sets(found[a:b], k)
                row, sig, prefix, rank = signatures(offsets, hashes, seen, threshold)
                own = ids[a:b][row]
                at, key, side = sketch.split_within(sig, own, seen.blocks(rank, block_rows))
                facts = (((np.diff(offsets)[row] << _PREFIX_BITS) + np.minimum(prefix, (1 << _PREFIX_BITS) - 1))[at] << _SIDE_BITS) + side
                own = own[at]
                for i in range(0, len(key), 200_000):
                    s = slice(i, i + 200_000)
                    yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(own[s]), pa.array(facts[s])], names=["sig", "id", "facts"])

    return texts.mapInArrow(signed, "sig long, id long, facts long")


def verified(pairs: DataFrame, k: int, threshold: float) -> DataFrame:
    """``(a, b, jaccard)`` of the pairs ``(a, b, text_a, text_b)`` that reach the threshold, by their whole shingle sets."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            ta, tb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            both = [x for p in zip(ta, tb) for x in p]
            # whole pairs to a chunk
            for a, b in chunks([x + y for x, y in zip(ta, tb)]):
                offsets, hashes = shingle_sets(both[2 * a : 2 * b], k)
                sims = np.zeros(b - a)
                for i in range(b - a):
                    x, y = hashes[offsets[2 * i] : offsets[2 * i + 1]], hashes[offsets[2 * i + 1] : offsets[2 * i + 2]]
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    sims[i] = same / max(len(x) + len(y) - same, 1)
                hit = np.flatnonzero(sims >= threshold - _EPS)
                yield pa.RecordBatch.from_arrays([pa.array(left[a:b][hit]), pa.array(right[a:b][hit]), pa.array(sims[hit])], names=["a", "b", "jaccard"])

    return pairs.mapInArrow(verify, "a long, b long, jaccard double")


def near_duplicates(records: DataFrame, id_col: str, text_col: str, k: int = 5, threshold: float = 0.8, ws: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: ``members`` has ``(id, class_id, copies)`` for every row with at least k words, where a
    class is what has one and the same set of k-word runs and class_id is its smallest id; ``links`` has
    ``(a, b, jaccard)``, a < b, for every two classes whose similarity reaches the threshold.

    No link is lost: signatures are exact (see :mod:`corpusloom.llm.partenum`), nothing is capped, and candidates are
    verified on their whole texts. Copies are joined to their class before anything is paired, so a text that a
    third of all rows share costs no more than another. Rows with a null id or text, and texts of fewer than k
    words, are in neither table. Ids must be unique longs. Other columns are not read.
    """
    spark = records.sparkSession
    ws = ws or Workspace(spark)
    rows = records.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null")
    first = ws.table(set_keys(rows, k, sketch.count_bits(records.count())), "sets")
    keyed = first.filter("chunk is null").select("id", *_KEYS)
    ranks = frequencies(first)
    classes = ws.table(keyed.groupBy(*_KEYS).agg(F.min("id").alias("class_id"), F.count("*").alias("copies")), "classes")
    copied = classes.filter("copies > 1")
    members = ws.table(
        attach(keyed, copied, _KEYS, "copies").select("id", "class_id", "copies").unionByName(classes.filter("copies = 1").select(F.col("class_id").alias("id"), "class_id", "copies")), "members"
    )
    # the first of each class stands for it; only what may be a further copy has to be looked up by a join
    extra = ws.table(members.filter("id <> class_id").select("id"), "further")
    further = spark.sparkContext.broadcast(sketch.id_filter(extra))
    sure = only(rows, further, False)
    unsure = only(rows, further, True).join(members.filter("id = class_id").select("id"), "id").select("id", "text")
    sigs = _signature_rows(sure, ranks, k, threshold).unionByName(_signature_rows(unsure, ranks, k, threshold))
    left, right = sigs.toDF("sig", "a", "fa"), sigs.toDF("sig", "b", "fb")
    part = lambda c, shift, bits: F.shiftright(F.col(c), shift).bitwiseAND((1 << bits) - 1)
    na, nb = (F.shiftright(F.col(c), _PREFIX_BITS + _SIDE_BITS) for c in ("fa", "fb"))
    pa_, pb = (part(c, _SIDE_BITS, _PREFIX_BITS) for c in ("fa", "fb"))
    side_a, side_b = (part(c, 0, _SIDE_BITS) for c in ("fa", "fb"))
    # sets that differ in at most d features agree on all but d of the signatures kept by either
    d = F.floor((na + nb) * ((1 - threshold) / (1 + threshold)) + _EPS)
    need = F.greatest(F.lit(1), F.least(pa_, pb) - d)
    size_ok = F.least(na, nb) >= F.greatest(na, nb) * threshold - _EPS  # the same columns on both sides, so one exchange serves both
    meet = (side_a == 2) | (side_b == 2) | (side_a != side_b)
    matched = left.join(right, "sig").filter((F.col("a") < F.col("b")) & size_ok & meet)
    found = matched.select("a", "b", need.cast("int").alias("need")).groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("need").alias("need"))
    close = sketch.by_parity(found.filter("shared >= need").select("a", "b"), first.filter("chunk is null").select("id", "n", *sketch.PARITY), threshold)
    candidates = ws.table(close, "candidates")
    links = ws.table(check_pairs(candidates, rows, k, threshold), "pairs")
    ws.drop(first, classes, extra, candidates)
    return members, links


def check_pairs(candidates: DataFrame, rows: DataFrame, k: int, threshold: float) -> DataFrame:
    """``(a, b, jaccard)`` of the candidates ``(a, b)``, a written table, that reach the threshold on their whole texts.

    A filter of bounded size keeps texts that no candidate needs from being shuffled.
    """
    ids = candidates.select(F.explode(F.array("a", "b")).alias("id"))
    wanted = rows.sparkSession.sparkContext.broadcast(sketch.id_filter(ids))
    text = only(rows, wanted, True)
    pairs = candidates.join(text.toDF("a", "text_a"), "a").join(text.toDF("b", "text_b"), "b")
    return verified(pairs.select("a", "b", "text_a", "text_b"), k, threshold)


def expanded(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(a, b)``, a < b, for all pairs of rows: of one class, and of every two linked classes; large classes are split."""
    return similarity.all_pairs(members, links.withColumnRenamed("jaccard", "similarity")).select("a", "b")


def _records(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/records.parquet")


def p4_found(spark, sf_dir: str) -> DataFrame:
    members, links = near_duplicates(_records(spark, sf_dir), "row_idx", "code", k=3, threshold=0.7)
    return expanded(members, links).select(F.col("a").alias("row_idx_a"), F.col("b").alias("row_idx_b"))


def grouped(members: DataFrame, links: DataFrame, ws: Workspace) -> DataFrame:
    """``(id, class_id, copies, links, group_id)`` for every row: its class, how many classes that is linked with,
    and the smallest id of all that it is linked with directly or through others."""
    degree = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    components = connected_components(links, "a", "b", ws).withColumnsRenamed({"node": "class_id", "component": "group_id"})
    classes = members.filter("id = class_id").select("class_id", "copies").join(degree, "class_id", "left").join(components, "class_id", "left")
    facts = ws.table(classes.select("class_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("group_id", "class_id").alias("group_id"), F.col("copies").alias("n")), "facts")
    return attach(members, facts, ["class_id"], "n").select("id", "class_id", "copies", "links", "group_id")


def p4_groups(spark, sf_dir: str) -> DataFrame:
    """Every record with its class, its number of links and its group, at five words and 0.8."""
    ws = Workspace(spark)
    members, links = near_duplicates(_records(spark, sf_dir), "row_idx", "code", ws=ws)
    return grouped(members, links, ws).withColumnRenamed("id", "row_idx")
