"""Sets of word runs as 64-bit hashes, computed for whole Arrow batches at a time."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

from corpusloom.operators.sketch import mix

_WORD = re.compile(r"[A-Za-z0-9_]+")
#: Texts are worked through in chunks of about this many characters, so a batch of very long ones needs no more memory.
CHUNK_CHARS = 4_000_000
_CACHE_WORDS = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Hashes of words seen by this worker; emptied when full, which changes no result."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return value


_hashes = _WordHashes()


def words(text: str) -> list[str]:
    """Runs of ASCII letters, digits and underscores, in lower case."""
    if text.isascii():
        return _WORD.findall(text.lower())
    return [w.lower() for w in _WORD.findall(text)]


def word_hashes(found: list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold about CHUNK_CHARS characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= CHUNK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of runs of ``k`` words of each text, as ``(offsets, hashes)``: text i has the ascending hashes
    ``hashes[offsets[i]:offsets[i + 1]]``. Null texts and those of fewer than k words have none."""
    flat: list[str] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            found = words(t)
            sizes[i] = len(found)
            flat += found
    h = word_hashes(flat)
    del flat
    n_runs = np.maximum(sizes - k + 1, 0)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    total = int(n_runs.sum())
    bounds = np.concatenate([[0], np.cumsum(n_runs)])
    at = np.arange(total) - np.repeat(bounds[:-1], n_runs) + np.repeat(starts, n_runs)
    run = np.zeros(total, np.uint64)
    for j in range(k):
        run = mix(run * _STEP + h[at + j] + np.uint64(j + 1))
    for i in range(len(texts)):
        if n_runs[i] > 1:
            run[bounds[i] : bounds[i + 1]].sort()
    keep = np.ones(total, bool)
    if total:
        keep[1:] = run[1:] != run[:-1]
        keep[bounds[:-1][n_runs > 0]] = True
    unique = np.add.reduceat(keep, bounds[:-1][n_runs > 0]) if total else np.zeros(0, np.int64)
    counts = np.zeros(len(texts), np.int64)
    counts[n_runs > 0] = unique
    return np.concatenate([[0], np.cumsum(counts)]), run[keep]


def set_key(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set of hashes."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
