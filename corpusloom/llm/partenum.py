"""Signatures for sets by partition and enumeration (Arasu, Ganti and Kaushik, VLDB 2006), for Jaccard thresholds."""

from __future__ import annotations

import numpy as np

from corpusloom.operators.sketch import Frequencies, mix

#: Sizes are put in bands [2 * 16^b, 2 * 16^(b+1)).
_BAND_LOW, _BAND_RATIO = 2, 16
#: Partitions of the feature domain for each feature of the largest set of a band.
PARTS_PER_FEATURE = 2
_EPS = 1e-9


def band(sizes: np.ndarray) -> np.ndarray:
    """The band of each size; smaller ones are in band 0 as well."""
    edges = _BAND_LOW * float(_BAND_RATIO) ** np.arange(1, 40)
    return np.searchsorted(edges, sizes, side="right")


def band_top(b: np.ndarray) -> np.ndarray:
    return _BAND_LOW * _BAND_RATIO ** (np.asarray(b, np.int64) + 1)


def signatures(offsets: np.ndarray, hashes: np.ndarray, seen: Frequencies, threshold: float, parts_per_feature: int = PARTS_PER_FEATURE):
    """``(row, signature, prefix, rank)`` arrays for sets given as offsets into ascending hashes.

    For each size band the feature domain is cut into n parts. Two sets of similarity t or more, sizes a <= b,
    differ in at most (a + b)(1 - t) / (1 + t) features, so in at most k parts, where k follows from the size of
    either and the sizes a partner may have. Of the one-part subsets enumerated, only the k + 1 with the rarest content
    need be kept as signatures: they must include one on which both agree, as in a prefix filter whose items
    are parts. A set joins its own band and, when a smaller partner can lie there, the band below. Sets with k
    nonempty parts or fewer also get one part for each feature, so parts that are empty in both never matter.
    ``prefix`` is the number of signatures kept in the instance, 0 where the count filter can't be used; ``rank`` is that of the rarest
    feature of the signature's content, which no more sets can share than have that feature.
    """
    sizes = np.diff(offsets)
    rows = np.arange(len(sizes))
    own = band(sizes)
    t = threshold
    below = (own > 0) & (sizes <= np.floor((band_top(own - 1) - 1) / t + _EPS))
    out = []
    for who, b, k in (
        (rows, own, np.floor(sizes * (1 / t - 1) + _EPS)),
        # here it is the larger one, and the smaller is below its band
        (rows[below], own[below] - 1, np.minimum(np.floor(sizes[below] * 2 * (1 - t) / (1 + t) + _EPS), np.floor((sizes[below] + band_top(own[below] - 1) - 1) * (1 - t) / (1 + t) + _EPS))),
    ):
        who, b, k = who[sizes[who] > 0], b[sizes[who] > 0], k[sizes[who] > 0].astype(np.int64)
        if len(who):
            few = _instance(offsets, hashes, seen, who, b, k, band_top(b) * parts_per_feature, out)
            if few.any():
                _instance(offsets, hashes, seen, who[few], b[few], k[few], None, out)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    return tuple(np.concatenate([o[i] for o in out]) for i in range(4))


def _instance(offsets, hashes, seen, who, b, k, n_parts, out):
    """Appends the signatures of one instance; returns which sets have k nonempty parts or fewer."""
    sizes = np.diff(offsets)[who]
    total = int(sizes.sum())
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    local = np.repeat(np.arange(len(who)), sizes)
    h = hashes[np.arange(total) - np.repeat(starts, sizes) + np.repeat(offsets[who], sizes)]
    rarity = seen.rank(h)
    if n_parts is None:
        tag = np.uint64(0xFA11) + b.astype(np.uint64)[local] * np.uint64(977)
        sig, rare, row = mix(h ^ mix(tag)), rarity, local
    else:
        n = n_parts.astype(np.uint64)[local]
        part = ((h >> np.uint64(33)) * n) >> np.uint64(31)
        cell = (local.astype(np.uint64) << np.uint64(40)) | part
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sig = np.add.reduceat(mix(h[order]), first)
        rare = np.minimum.reduceat(rarity[order], first)
        row = local[order][first]
        sig = mix(sig ^ mix(b.astype(np.uint64)[row] * np.uint64(0x10001) + np.uint64(1)))
    m = np.bincount(row, minlength=len(who))
    keep = np.minimum(k + 1, m)
    # ascending rarity within each set; ties by the signature, so both sides order alike
    order = np.lexsort((sig, rare, row))
    place = np.arange(len(order)) - np.repeat(np.concatenate([[0], np.cumsum(m)[:-1]]), m)
    chosen = order[place < keep[row[order]]]
    few = m <= k
    out.append((who[row[chosen]], sig[chosen].view(np.int64), np.where(few, 0, k + 1)[row[chosen]], rare[chosen]))
    return few if n_parts is not None else np.zeros(len(who), bool)
