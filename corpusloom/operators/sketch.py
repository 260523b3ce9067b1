"""Sketches over whole tables: about how often hashes occur, which ids occur at all, and how hot keys are split by them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Counters of a frequency sketch: some for every row within these bounds (2^20 to 2^22). Executors get one byte for each counter.
LEAST_COUNT_BITS, MOST_COUNT_BITS, COUNTERS_PER_ROW = 20, 22, 4
#: Bits of an id filter: some for every id within these bounds (128 kB to 32 MB).
LEAST_FILTER_BITS, MOST_FILTER_BITS, BITS_PER_ID = 20, 28, 16
#: Keys that more rows than this may share are split into blocks of so many.
BLOCK_ROWS = 8192
#: Longs of parity bits of a set.
PARITY_WORDS = 8
PARITY = [f"w{i}" for i in range(PARITY_WORDS)]
#: Longs of parity bits that go with each row of a join.
FOLDED = ["u0", "u1"]
CHUNKS = 64
SCHEMA = "chunk int, cells binary"
_STEPS = 8  # of the logarithmic scale to a doubling

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """The ascending distinct hashes of all runs of ``k`` hashes; one run of all where there are fewer, none where there are none."""
    if not len(h):
        return np.zeros(0, np.uint64)
    n = max(len(h) - k + 1, 1)
    run = np.zeros(n, np.uint64)
    for j in range(min(k, len(h))):
        run = mix(run * _STEP + h[j : j + n] + np.uint64(j + 1))
    return np.unique(run)


def bits_for(n: int, each: int, least: int, most: int) -> int:
    return min(most, max(least, int(n * each).bit_length()))


def count_bits(rows: int) -> int:
    return bits_for(rows, COUNTERS_PER_ROW, LEAST_COUNT_BITS, MOST_COUNT_BITS)


def count_into(cells: np.ndarray, hashes: np.ndarray) -> None:
    cells += np.bincount((hashes & np.uint64(len(cells) - 1)).astype(np.int64), minlength=len(cells)).astype(cells.dtype)


def as_batch(cells: np.ndarray) -> pa.RecordBatch:
    parts = np.split(cells, CHUNKS)
    return pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["chunk", "cells"])


def merged(partials: DataFrame, dtype: type, combine: Callable = np.add, finish: Callable | None = None, out: type | None = None) -> np.ndarray:
    """The cells of all partial sketches ``(chunk, cells)`` together.

    Partials are merged as a stream, chunk by chunk, on the executors, and turned there into what is kept of them by ``finish``;
    what reaches the driver is one sketch, whose size has the bounds stated above.
    """
    out = out or dtype

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(cells, dtype)
                sums[chunk] = combine(sums[chunk], part) if chunk in sums else part.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(finish(v) if finish else v).tobytes() for v in sums.values()], pa.binary())], names=["chunk", "cells"])

    rows = partials.repartition(8, "chunk").mapInArrow(add_up, SCHEMA).collect()
    if not rows:
        return np.zeros(0, out)
    return np.concatenate([np.frombuffer(r.cells, out) for r in sorted(rows, key=lambda r: r.chunk)])


@dataclass
class Frequencies:
    """How often hashes occur, by cells on a logarithmic scale of one byte. ``mean`` is what a cell holds on average."""

    levels: np.ndarray
    mean: float

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """An order of hashes, the rarest first; any order is right for a prefix filter."""
        return self.levels[(hashes & np.uint64(len(self.levels) - 1)).astype(np.int64)]

    def blocks(self, ranks: np.ndarray, block_rows: int) -> np.ndarray:
        """Into how many blocks a key is split whose rarest hash has this rank: about one for each ``block_rows`` rows that can share it."""
        seen = np.exp2((ranks.astype(np.float64) + 1) / _STEPS) - self.mean
        return np.maximum(1, np.ceil(seen / block_rows)).astype(np.int64)


def frequencies(partials: DataFrame) -> Frequencies:
    """From partial sketches of uint32 counters."""
    add = lambda x, y: np.minimum(x.astype(np.uint64) + y, 2**32 - 1).astype(np.uint32)
    level = lambda counts: np.round(_STEPS * np.log2(counts.astype(np.float64) + 1)).astype(np.uint8)
    levels = merged(partials, np.uint32, add, level, np.uint8)
    if not len(levels):
        levels = np.zeros(1 << LEAST_COUNT_BITS, np.uint8)
    return Frequencies(levels, float((np.exp2(np.arange(256) / _STEPS) - 1)[levels].mean()))


def parity(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """PARITY_WORDS longs for each set; each item flips one of their bits."""
    sizes, width = np.diff(offsets), 64 * PARITY_WORDS
    bit = np.repeat(np.arange(len(sizes)), sizes) * width + (hashes >> np.uint64(64 - (width - 1).bit_length())).astype(np.int64)
    odd = (np.bincount(bit, minlength=len(sizes) * width) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(sizes), PARITY_WORDS)


def folded(bits: np.ndarray) -> np.ndarray:
    """FOLDED longs from all words of parity bits: each bit is the parity of several of theirs, so no more of them differ."""
    return np.stack([np.bitwise_xor.reduce(bits[:, i :: len(FOLDED)], axis=1) for i in range(len(FOLDED))], axis=1)


def flipped(words: list[str]) -> Column:
    """How many parity bits of a and b differ in these words."""
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a{w}").bitwiseXOR(F.col(f"b{w}"))) for w in words])


def most_flipped(both: Column, threshold: float) -> Column:
    """In how many items two sets of ``both`` items together may differ at a similarity of ``threshold``, and so in how many parity bits."""
    return F.floor(both * ((1 - threshold) / (1 + threshold)) + 1e-9)


def by_parity(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` of sets ``(id, n, *PARITY)`` that their parity bits don't rule out: sets that differ in d items differ in at most d bits."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), *(F.col(w).alias(f"{x}{w}") for w in PARITY))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(flipped(PARITY) <= most_flipped(F.col("n_a") + F.col("n_b"), threshold)).select("a", "b")


def split_within(keys: np.ndarray, ids: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Splits hot keys of a self-join, as ``(row, key, side)``.

    A row of a key of n blocks belongs to one of them by the hash of its id, and is repeated under n keys, one for each
    pair of blocks with its own. Rows of one key meet if their sides differ or are 2, so each pair of ids meets once
    (:func:`meets`), and no task gets more than two blocks of a key.
    """
    rows = np.repeat(np.arange(len(keys)), blocks)
    n = blocks[rows]
    own = (mix(ids.astype(np.uint64))[rows] % n.astype(np.uint64)).astype(np.int64)
    other = np.arange(len(rows)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low, high = np.minimum(own, other), np.maximum(own, other)
    pair = mix((low * n + high).astype(np.uint64) + np.uint64(1))
    key = np.where(n > 1, (keys[rows].view(np.uint64) ^ pair).view(np.int64), keys[rows].view(np.int64))
    return rows, key, np.where(own == other, 2, (own == high).astype(np.int64))


def meets(a: int, b: int) -> bool:
    return a == 2 or b == 2 or a != b


def split_across(keys: np.ndarray, ids: np.ndarray, blocks: np.ndarray, left: bool) -> tuple[np.ndarray, np.ndarray]:
    """Splits hot keys of a join of two sides, as ``(row, key)``: a row of block i of the left meets each block j of the right once."""
    rows = np.repeat(np.arange(len(keys)), blocks)
    n = blocks[rows]
    own = (mix(ids.astype(np.uint64))[rows] % n.astype(np.uint64)).astype(np.int64)
    other = np.arange(len(rows)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    pair = mix((np.where(left, own, other) * n + np.where(left, other, own)).astype(np.uint64) + np.uint64(1))
    return rows, np.where(n > 1, (keys[rows].view(np.uint64) ^ pair).view(np.int64), keys[rows].view(np.int64))


def _places(ids: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.view(np.uint64))
    mask = np.uint64(n_bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def id_filter(ids: DataFrame) -> np.ndarray:
    """Packed bits for the ids (one long column of a written table). It may let others pass and never misses one.

    Its size follows the number of ids up to MOST_FILTER_BITS. Where still more ids fill it, nearly all rows pass, which
    costs what a join without it does.
    """
    n_bits = 1 << bits_for(ids.count(), BITS_PER_ID, LEAST_FILTER_BITS, MOST_FILTER_BITS)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None
        for batch in batches:
            if batch.num_rows:
                bits = np.zeros(n_bits, bool) if bits is None else bits
                for at in _places(np.asarray(batch.column(0)), n_bits):
                    bits[at] = True
        if bits is not None:
            yield as_batch(np.packbits(bits))

    bits = merged(ids.mapInArrow(mark, SCHEMA), np.uint8, np.bitwise_or)
    return bits if len(bits) else np.zeros(n_bits // 8, np.uint8)


def passes(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    a, b = _places(ids, 8 * len(bits))
    one = lambda at: (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
    return (one(a) & one(b)).astype(bool)
