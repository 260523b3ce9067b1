"""Problem 7: containers of fixed capacity filled with documents.

Method: space-filling-curve order. Hashed document vectors are projected to few dimensions and range-sorted by their
Hilbert key, and neighbours along the curve are packed together.
"""

from __future__ import annotations

import base64
import bisect
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shingles import chunks, mix
from corpusloom.workspace import Workspace, ship

#: Where the public tokenizers' files lie, and which one measures the texts.
TOKENIZERS = os.environ.get("CORPUSLOOM_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary splits a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DIMENSIONS, BITS = 4, 8
#: Documents to a range along the curve; each range is packed by one task.
RANGE_ROWS = 50_000
#: Neighbours that are packed together, largest first.
WINDOW = 4_096
#: Containers that stay open for later neighbours.
OPEN = 512


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place along the Hilbert curve of each point (rows of integers under 2^bits), after Skilling (2004)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _projection(ids: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random direction, -1 or 1 in each dimension, for each token id."""
    h = mix(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return ((h[:, None] >> np.arange(DIMENSIONS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64) * 2 - 1


def load_tokenizer(folder: str = TOKENIZERS):
    import tiktoken

    with open(os.path.join(folder, TOKENIZER), "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def measured(documents: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``(doc_id, tokens, key)``: each whole text's size in tokens and its place along the curve.

    The vector of a text has the square root of each token's count; its projection, scaled to the vector's length,
    is near normal, so its distribution function spreads it evenly over the cells of each dimension.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(folder)
        directions = _projection(np.arange(tokenizer.n_vocab))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                sizes, cells = [], []
                for text in texts[a:b]:
                    ids_ = tokenizer.encode_ordinary(text)
                    tokens = np.fromiter(ids_, np.int64, len(ids_))
                    sizes.append(len(tokens))
                    found, counts = np.unique(tokens, return_counts=True)
                    z = np.sqrt(counts) @ directions[found] / max(np.sqrt(len(tokens)), 1.0)
                    cells.append(np.minimum((2**BITS) / (1 + np.exp(-1.702 * z)), 2**BITS - 1).astype(np.int64))
                keys = hilbert_keys(np.array(cells).reshape(-1, DIMENSIONS))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(keys)], names=["doc_id", "tokens", "key"])

    ship(documents.sparkSession)
    # blank texts take no room
    rows = documents.select(F.col("doc_id").cast("long"), "text").filter(r"doc_id is not null and regexp_like(text, '[^\\s\\p{Z}]')")
    return rows.mapInArrow(measure, "doc_id long, tokens long, key long")


class _Filler:
    """Containers of one capacity, filled best-fit; only the fullest OPEN that still have room are kept open."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.room: list[tuple[int, int]] = []  # (room left, container), ascending
        self.count = 0

    def put(self, size: int) -> int:
        at = bisect.bisect_left(self.room, (size, -1))
        if at < len(self.room):
            left, container = self.room.pop(at)
        else:
            left, container = self.capacity, self.count
            self.count += 1
        if left > size:
            bisect.insort(self.room, (left - size, container))
            if len(self.room) > OPEN:
                self.room.pop(0)  # the least useful one
        return container


def packed(sizes: DataFrame, capacities: list[tuple[str, int]]) -> DataFrame:
    """``(window_name, container, doc_id, part, first_token, n_tokens)`` for documents ``(doc_id, tokens, key)``.

    Documents are range-sorted by their key, ties by id, so equal texts are spread too. Along the curve, windows of
    neighbours are packed largest first, each into the open container with the least room that suffices. A document
    longer than the capacity fills whole containers, and its rest is packed like others; none else is split.
    A container is named by its range and a number in it. Capacities of nothing are refused.
    """
    if any(c is None or c <= 0 for _, c in capacities):
        raise ValueError("a capacity must be positive")
    n = sizes.count()
    ranges = max(1, -(-n // RANGE_ROWS))
    ordered = sizes.filter("tokens > 0").repartitionByRange(ranges, "key", "doc_id").sortWithinPartitions("key", "doc_id").withColumn("range", F.spark_partition_id())

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fillers = [_Filler(c) for _, c in capacities]
        held: list[tuple[int, int]] = []
        where = 0

        def flush() -> pa.RecordBatch:
            held.sort(key=lambda x: (-x[1], x[0]))
            rows = []
            for (name, capacity), filler in zip(capacities, fillers):
                rests = []
                for doc, size in held:
                    whole, rest = divmod(size, capacity)
                    if not rest and whole:
                        whole, rest = whole - 1, capacity
                    for part in range(whole):
                        rows.append((name, filler.count, doc, part, part * capacity, capacity))
                        filler.count += 1
                    rests.append((-rest, doc, whole))
                for rest, doc, part in sorted(rests):
                    rows.append((name, filler.put(-rest), doc, part, part * capacity, -rest))
            held.clear()
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0]),
                    pa.array([f"{where}-{k}" for k in cols[1]]),
                    pa.array(cols[2], pa.int64()),
                    pa.array(cols[3], pa.int32()),
                    pa.array(cols[4], pa.int64()),
                    pa.array(cols[5], pa.int64()),
                ],
                names=["window_name", "container", "doc_id", "part", "first_token", "n_tokens"],
            )

        for batch in batches:
            for doc, size, place in zip(*(batch.column(c).to_pylist() for c in range(3))):
                where = place
                held.append((doc, size))
                if len(held) == WINDOW:
                    yield flush()
        if held:
            yield flush()

    return ordered.select("doc_id", "tokens", "range").mapInArrow(fill, "window_name string, container string, doc_id long, part int, first_token long, n_tokens long")


def _filled(spark, sf_dir: str) -> DataFrame:
    windows = spark.read.parquet(f"{sf_dir}/context_windows.parquet")
    capacities = [(r.window_name, r.capacity_tokens) for r in windows.orderBy("capacity_tokens", "window_name").collect()]  # a handful
    sizes = Workspace(spark).table(measured(spark.read.parquet(f"{sf_dir}/documents.parquet")), "sizes")
    return packed(sizes, capacities)


def p7_containers(spark, sf_dir: str) -> DataFrame:
    """Every document's place in a container of each capacity."""
    return _filled(spark, sf_dir)


def p7_fill(spark, sf_dir: str) -> DataFrame:
    """Per capacity: tokens, containers used, the least number that could do, and the share of room filled."""
    windows = spark.read.parquet(f"{sf_dir}/context_windows.parquet").select("window_name", "capacity_tokens")
    per = _filled(spark, sf_dir).groupBy("window_name").agg(F.sum("n_tokens").alias("tokens"), F.count_distinct("container").alias("containers"))
    room = F.col("containers") * F.col("capacity_tokens")
    return per.join(windows, "window_name").select("window_name", "tokens", "containers", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"), (F.col("tokens") / room).alias("filled"))
