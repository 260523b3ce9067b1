"""Pairs of sets whose Jaccard similarity reaches a threshold: exactly, or retrieved by MinHash bands and verified.

Equal sets of one family are one class, so results are links between classes and the members of each class.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import sketch
from corpusloom.operators.skew import attach
from corpusloom.workspace import Workspace

_EPS = 1e-9
_KEYS = ["family", "k1", "k2", "n"]
#: Signature length, and the probability with which a pair just at the threshold is to be retrieved.
PERMUTATIONS, RECALL = 256, 0.99
#: Rows of prefixes that are joined at once, as far as so many slices of all keys allow.
SLICE_ROWS, MOST_SLICES = 2_000_000, 8


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats: 1 where both are empty, 0 where one is."""
    same = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(same / (F.size(a) + F.size(b) - same))


def _written(sets: DataFrame, ws: Workspace) -> DataFrame:
    # items become 64-bit hashes, which take less room and are compared faster. Filters on the items come after this:
    # pushed below, they would work the items out once more for each of their elements
    hashes = sets.schema["items"].dataType.simpleString() == "array<bigint>"
    items = F.array_sort(F.array_distinct(F.col("items") if hashes else F.transform("items", lambda x: F.xxhash64(x))))
    # a row's number takes the place of its id wherever pairs are shuffled
    numbered = sets.select("id", "family", items.alias("items"), F.monotonically_increasing_id().alias("number"))
    return ws.table(numbered.filter("id is not null and family is not null and items is not null"), "sets")


def _classes(sets: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """``members`` (id, family, class_id, copies) of the classes of equal sets, and the sets that stand for a class."""
    keyed = sets.select("id", "number", "family", F.xxhash64("items").alias("k1"), F.xxhash64(F.lit(1), "items").alias("k2"), F.size("items").alias("n"))
    keyed = ws.table(keyed, "keys")
    classes = ws.table(keyed.groupBy(*_KEYS).agg(F.min("id").alias("class_id"), F.count("*").alias("copies")), "classes")
    several = attach(keyed, classes.filter("copies > 1"), _KEYS, "copies").select("id", "family", "class_id", "copies")
    single = classes.filter("copies = 1").select(F.col("class_id").alias("id"), "family", "class_id", "copies")
    members = ws.table(several.unionByName(single), "members")
    # a table of its own, and of numbers, so that its size is known and a small one is broadcast instead of shuffling the sets
    further = ws.table(keyed.join(members.filter("id <> class_id").select("id"), "id", "left_semi").select("number"), "further")
    ws.drop(keyed, classes)
    return members, sets.join(further, "number", "left_anti")


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a column of lists of 64-bit hashes."""
    sizes = np.diff(np.asarray(column.offsets)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), np.asarray(column.flatten()).astype(np.int64).view(np.uint64)


def _facts(sets: DataFrame, ws: Workspace) -> tuple[DataFrame, Broadcast]:
    """``(id, n, *PARITY)`` of each set by one pass, and about how often items occur in all of them."""
    n_bits, id_type = sketch.count_bits(sets.count()), sets.schema["id"].dataType.simpleString()
    names = ["id", "n", *sketch.PARITY, "chunk", "cells"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, kind = np.zeros(1 << n_bits, np.uint32), None
        for batch in batches:
            offsets, hashes = _numbers(batch.column(1))
            sketch.count_into(cells, hashes)
            bits = sketch.parity(offsets, hashes)
            kind = batch.column(0).type
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets).astype(np.int32)), *(pa.array(np.ascontiguousarray(b)) for b in bits.T), pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())], names=names)
        if kind is not None:
            part = sketch.as_batch(cells)
            yield pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, kind), pa.nulls(part.num_rows, pa.int32()), *[pa.nulls(part.num_rows, pa.int64())] * sketch.PARITY_WORDS, part.column(0), part.column(1)], names=names)

    longs = ", ".join(f"{w} long" for w in sketch.PARITY)
    rows = ws.table(sets.select("id", "items").mapInArrow(count, f"id {id_type}, n int, {longs}, chunk int, cells binary"), "facts")
    sent = sets.sparkSession.sparkContext.broadcast(sketch.frequencies(rows.filter("chunk is not null").select("chunk", "cells")))
    return rows, sent


def _prefixes(sets: DataFrame, sent, threshold: float) -> DataFrame:
    """``(key, side, id, n, pos, *FOLDED)``: the rarest n - ceil(threshold * n) + 1 items of each set with their places, hot ones split.

    The family is in the key, so sets of two families meet only where hashes collide.
    """
    id_type = sets.schema["id"].dataType.simpleString()
    block_rows, names = sketch.BLOCK_ROWS, ["key", "side", "id", "n", "pos", *sketch.FOLDED]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sent.value
        for batch in batches:
            offsets, hashes = _numbers(batch.column(1))
            sizes = np.diff(offsets)
            folded = sketch.folded(sketch.parity(offsets, hashes))
            row = np.repeat(np.arange(len(sizes)), sizes)
            rank = seen.rank(hashes)
            order = np.lexsort((hashes, rank, row))
            place = np.arange(len(order)) - np.repeat(offsets[:-1], sizes)
            keep = place < np.repeat(sizes - np.ceil(threshold * sizes - _EPS).astype(np.int64) + 1, sizes)
            row, place, order = row[keep], place[keep], order[keep]
            own, family = (np.asarray(batch.column(c)).view(np.uint64) for c in (2, 3))
            keys = sketch.mix(hashes[order] ^ sketch.mix(family)[row])
            at, key, side = sketch.split_within(keys.view(np.int64), own[row], seen.blocks(rank[order], block_rows))
            row = row[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(side.astype(np.int8)), batch.column(0).take(pa.array(row)), pa.array(sizes[row].astype(np.int32)), pa.array(place[at].astype(np.int32)), *(pa.array(np.ascontiguousarray(b)) for b in folded[row].T)],
                names=names,
            )

    rows = sets.select("id", "items", F.xxhash64("id").alias("own"), F.xxhash64("family").alias("family"))
    return rows.mapInArrow(cut, f"key long, side tinyint, id {id_type}, n int, pos int, " + ", ".join(f"{w} long" for w in sketch.FOLDED))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float | Column) -> DataFrame:
    """Links between ids from ``pairs`` of the numbers of ``sets``; pairs of two families are left out."""
    left = sets.select(F.col("number").alias("a"), F.col("id").alias("x"), F.col("family").alias("family"), F.col("items").alias("left"))
    right = sets.select(F.col("number").alias("b"), F.col("id").alias("y"), F.col("family").alias("other"), F.col("items").alias("right"))
    both = pairs.join(left, "a").join(right, "b").filter("family = other and x <> y").withColumn("similarity", jaccard(F.col("left"), F.col("right")))
    return both.filter(F.col("similarity") >= threshold - _EPS).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "family", "similarity")


def similar_classes(sets: DataFrame, threshold: float, verify: Column | None = None, ws: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """``(members, links)`` for rows ``(id, family, items)``, by an exact prefix-filter join within each family.

    ``members`` has ``(id, family, class_id, copies)``: the class of equal sets of each row, by its smallest id; empty sets
    of a family are a class too. ``links`` has ``(a, b, family, similarity)``, a < b, for classes that reach the threshold.
    Items are hashed to 64 bits (arrays of longs are taken as they are) and ordered by how often they occur, the
    rarest first, for which a sketch will do: any order is right. Two sets that reach the threshold share one of their first
    n - ceil(threshold * n) + 1 items at places that leave room for the rest, so only those are joined; what they give is
    verified on whole sets. Parity bits rule most pairs out inside that join, so few are shuffled. An item that many sets may have is split into blocks. ``verify`` is a stricter threshold
    for some rows. Rows with a null family, id or set match nothing.
    """
    ws = ws or Workspace(sets.sparkSession)
    written = _written(sets, ws)
    members, reps = _classes(written, ws)
    reps = reps.filter("size(items) > 0")
    numbered = reps.select(F.col("number").alias("id"), "family", "items")
    facts, seen = _facts(numbered, ws)
    met = _met(ws.table(_prefixes(numbered, seen, threshold), "prefixes"), threshold, ws)
    pairs = reduce(DataFrame.unionAll, met).groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("need").alias("need")).filter("shared >= need").select("a", "b")
    candidates = ws.table(sketch.by_parity(pairs, facts.filter("chunk is null"), threshold), "candidates")
    links = ws.table(_verified(candidates, reps, F.lit(threshold) if verify is None else verify), "links")
    ws.drop(written, facts, candidates, *met)
    return members, links


def _met(prefix: DataFrame, threshold: float, ws: Workspace) -> list[DataFrame]:
    """Tables ``(a, b, shared, need)`` of pairs that meet, one for each slice of the keys of the written table ``prefix``, which is dropped.

    Rows of one slice after the other are shuffled, so the disk holds the shuffle of one slice at a time; each key is in one of them.
    """
    n = min(MOST_SLICES, -(-prefix.count() // SLICE_ROWS)) or 1
    slices = [prefix.filter(F.pmod(F.xxhash64("key"), F.lit(n)) == i) for i in range(n)] if n > 1 else [prefix]
    counted = (_meeting(s, threshold).groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("need").alias("need")) for s in slices)
    out = [ws.table(c, "met") for c in counted]
    ws.drop(prefix)
    return out


def _meeting(prefix: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, need)`` for each item that the prefixes of two sets share: how many such items they must share to reach the threshold.

    Pairs that lengths, places or folded parity bits rule out are left out here, before any pair is shuffled.
    """
    left, right = (prefix.toDF("key", f"s{x}", x, f"n{x}", place, *(f"{x}{w}" for w in sketch.FOLDED)) for x, place in (("a", "i"), ("b", "j")))
    na, nb, i, j = (F.col(c) for c in ("na", "nb", "i", "j"))
    required = F.ceil((na + nb) * (threshold / (1 + threshold)) - _EPS)
    near = (F.least(na, nb) >= F.greatest(na, nb) * threshold - _EPS) & (F.least(i, j) + F.least(na - i, nb - j) >= required)
    meet = (F.col("sa") == 2) | (F.col("sa") != F.col("sb"))
    # what two prefixes don't share must lie in the rest of one of them
    rest = lambda n: F.ceil(n * threshold - _EPS) - 1
    need = F.greatest(F.lit(1), required - F.greatest(rest(na), rest(nb))).cast("int")
    alike = sketch.flipped(sketch.FOLDED) <= sketch.most_flipped(na + nb, threshold)
    return left.join(right, "key").filter((F.col("a") < F.col("b")) & near & meet & alike).select("a", "b", need.alias("need"))


def chained(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(a, b)``: the links, and each member with its class; the graph whose components are groups of similar rows."""
    return links.select("a", "b").unionByName(members.filter("id <> class_id").select(F.col("class_id").alias("a"), F.col("id").alias("b")))


def _blocks(copies: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(copies / sketch.BLOCK_ROWS)).cast("int")


def across(links: DataFrame, left: DataFrame, right: DataFrame, left_sizes: DataFrame, right_sizes: DataFrame) -> DataFrame:
    """``links`` (a, b, ...) with ``x`` and ``y``: every row of class a in ``left`` with every one of class b in ``right``.

    Rows are ``(class_id, id, copies)``, sizes ``(class_id, copies)`` for each class. Large classes are split into blocks, so no
    task gets all pairs of two.
    """
    n = _blocks(F.col("copies"))
    rows = lambda side, c, own, id_: side.select(F.col("class_id").alias(c), F.pmod(F.xxhash64("id"), n).cast("int").alias(own), F.col("id").alias(id_))
    split = links.join(left_sizes.select(F.col("class_id").alias("a"), n.alias("_na")), "a").join(right_sizes.select(F.col("class_id").alias("b"), n.alias("_nb")), "b")
    split = split.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_na") - 1))).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return split.join(rows(left, "a", "_i", "x"), ["a", "_i"]).join(rows(right, "b", "_j", "y"), ["b", "_j"]).drop("_i", "_j", "_na", "_nb")


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """``(a, b, similarity)``, a < b, for all pairs of rows: of one class, and of every two linked classes.

    Large classes are split into blocks. For callers whose result is the pairs themselves.
    """
    n = _blocks(F.col("copies"))
    inside = members.filter("copies > 1").select("class_id", "id", n.alias("nb"), F.pmod(F.xxhash64("id"), n).cast("int").alias("own"))
    left = inside.select("class_id", F.col("id").alias("x"), F.col("own").alias("i"), F.explode(F.sequence(F.col("own"), F.col("nb") - 1)).alias("j"))
    right = inside.select("class_id", F.col("id").alias("y"), F.col("own").alias("j"), F.explode(F.sequence(F.lit(0), "own")).alias("i"))
    same = left.join(right, ["class_id", "i", "j"]).filter("i < j or x < y").select("x", "y", F.lit(1.0).alias("similarity"))
    rows, sizes = members.select("class_id", "id", "copies"), members.filter("id = class_id").select("class_id", "copies")
    both = same.unionByName(across(links.select("a", "b", "similarity"), rows, rows, sizes, sizes).select("x", "y", "similarity"))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")


def class_rows(members: DataFrame, links: DataFrame, ws: Workspace) -> DataFrame:
    """``(id, class_id, copies, links)`` for every row: its class and how many other classes that is linked with."""
    degree = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    heads = members.filter("id = class_id").select("class_id", F.col("copies").alias("k")).join(degree, "class_id", "left")
    heads = ws.table(heads.select("class_id", "k", F.coalesce("links", F.lit(0)).alias("links")), "heads")
    return attach(members, heads, ["class_id"], "k").select("id", "class_id", "copies", "links")


def banding(threshold: float) -> tuple[int, int]:
    """Bands and rows for a threshold: as many rows to a band as still retrieve a pair at the threshold with a probability of RECALL."""
    for rows in range(PERMUTATIONS, 1, -1):
        bands = PERMUTATIONS // rows
        if 1 - (1 - threshold**rows) ** bands >= RECALL:
            return bands, rows
    return PERMUTATIONS, 1


def minhash_bands(sets: DataFrame, threshold: float, seed: int = 1) -> DataFrame:
    """``(id, family, band, key)`` for sets of 64-bit hashes: MinHash signatures of PERMUTATIONS values in the bands that suit the threshold."""
    n_bands, n_rows = banding(threshold)
    draw = np.random.default_rng(seed)
    a = draw.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
    b = draw.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            offsets, values = _numbers(batch.column(2))
            for start, end in zip(offsets, offsets[1:]):
                h = values[start:end]
                low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(h), 4096):
                    low = np.minimum(low, (h[at : at + 4096, None] * a + b).min(0))
                with np.errstate(over="ignore"):
                    mixed = (low ^ (low >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
                    keys += np.add.reduce(mixed[: n_bands * n_rows].reshape(n_bands, n_rows) * (np.arange(n_rows, dtype=np.uint64) * 2 + 1), 1).view(np.int64).tolist()
            which = np.repeat(np.arange(batch.num_rows), n_bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which)), batch.column(1).take(pa.array(which)), pa.array(np.tile(np.arange(n_bands, dtype=np.int32), batch.num_rows)), pa.array(keys, pa.int64())],
                names=["id", "family", "band", "key"],
            )

    rows = sets.select("id", "family", "items")
    id_type = sets.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"id {id_type}, family string, band int, key long")


def bucket_pairs(bands: DataFrame, ws: Workspace) -> DataFrame:
    """``(a, b)``, a < b, of all ids that share a bucket ``(family, band, key)`` of a written table; large buckets are split into blocks."""
    keys = ["family", "band", "key"]
    sizes = ws.table(bands.groupBy(*keys).agg(F.count("*").alias("k")).filter("k > 1"), "buckets")
    nb = F.ceil(F.col("k") / sketch.BLOCK_ROWS).cast("int")
    rows = ws.table(attach(bands, sizes, keys, "k").select(*keys, "id", nb.alias("nb"), F.pmod(F.xxhash64("id"), nb).cast("int").alias("own")), "bucketed")
    left = rows.select(*keys, F.col("id").alias("x"), F.col("own").alias("i"), F.explode(F.sequence(F.col("own"), F.col("nb") - 1)).alias("j"))
    right = rows.select(*keys, F.col("id").alias("y"), F.col("own").alias("j"), F.explode(F.sequence(F.lit(0), "own")).alias("i"))
    return left.join(right, [*keys, "i", "j"]).filter("i < j or x < y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def lsh_classes(sets: DataFrame, threshold: float, verify: Column | None = None, ws: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """Like :func:`similar_classes`, but candidates are retrieved by MinHash bands, which misses some links (see RECALL); none is wrong.

    All pairs of classes in a bucket are verified.
    """
    ws = ws or Workspace(sets.sparkSession)
    written = _written(sets, ws)
    members, reps = _classes(written, ws)
    reps = reps.filter("size(items) > 0")
    bands = ws.table(minhash_bands(reps.select(F.col("number").alias("id"), "family", "items"), threshold), "bands")
    candidates = ws.table(bucket_pairs(bands, ws), "candidates")
    links = ws.table(_verified(candidates, reps, F.lit(threshold) if verify is None else verify), "links")
    ws.drop(written, bands, candidates)
    return members, links
