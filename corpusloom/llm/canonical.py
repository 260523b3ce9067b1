"""Problem 1: records that are the same program text in another layout.

Method: canonicalize characters, case, white space, punctuation and field order, hash to 128 bits, and aggregate
counts with map-side combining and collision checks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.skew import attach
from corpusloom.workspace import Workspace

_TOKENS = re.compile(r"[A-Za-z0-9_]+|[=!<>:]=|[(){}\[\],=]")
_OPENER = {")": "(", "}": "{", "]": "["}
_SCHEMA = "id long, h1 long, h2 long, check long, n_words int"
_KEYS = ["h1", "h2", "check", "n_words"]


def _settle(frame: list) -> list[str]:
    """The words of a closed bracket pair; what may come in any order is sorted."""
    kind, entries, keyed = frame
    if kind == "{":
        entries = sorted(e for e in entries if e)
    elif kind == "(" and len(keyed) > 1:
        for slot, entry in zip(sorted(keyed), sorted(entries[i] for i in keyed)):
            entries[slot] = entry
    return [w for e in entries for w in e]


def canonical_words(text: str) -> list[str]:
    """The words of ``text`` (runs of ASCII letters, digits and underscores, in lower case) in canonical order.

    ``key=value`` arguments of one pair of parentheses are sorted among the places that such arguments take, and
    the entries of one pair of braces are sorted. Brackets that are never closed, or close nothing, sort nothing.
    """
    top: list = ["", [[]], set()]
    stack = [top]
    entries, keyed = top[1], top[2]
    for token in _TOKENS.findall(text):
        if token in "({[":
            stack.append([token, [[]], set()])
            entries, keyed = stack[-1][1], stack[-1][2]
        elif token == ",":
            entries.append([])
        elif token == "=":
            # a key is one word that stands alone before the sign
            if len(entries[-1]) == 1:
                keyed.add(len(entries) - 1)
        elif token in ")}]":
            opener = _OPENER[token]
            at = len(stack) - 1
            while at and stack[at][0] != opener:
                at -= 1
            if at:
                while len(stack) - 1 > at:  # never closed: in the order written
                    left = stack.pop()
                    stack[-1][1][-1].extend(w for e in left[1] for w in e)
                words = _settle(stack.pop())
                entries, keyed = stack[-1][1], stack[-1][2]
                entries[-1].extend(words)
        elif token[-1] != "=":
            entries[-1].append(token.lower())
    while len(stack) > 1:
        left = stack.pop()
        stack[-1][1][-1].extend(w for e in left[1] for w in e)
    return [w for e in top[1] for w in e]


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, h1, h2, check, n = [], [], [], [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = canonical_words(text) if text else None
            if words:
                d = hashlib.blake2b(" ".join(words).encode(), digest_size=24).digest()
                ids.append(i)
                h1.append(int.from_bytes(d[:8], "little", signed=True))
                h2.append(int.from_bytes(d[8:16], "little", signed=True))
                check.append(int.from_bytes(d[16:], "little", signed=True))
                n.append(len(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(check, pa.int64()), pa.array(n, pa.int32())],
            names=["id", "h1", "h2", "check", "n_words"],
        )


def canonical_hashes(records: DataFrame, id_col: str = "row_idx", text_col: str = "code") -> DataFrame:
    """``(id, h1, h2, check, n_words)``: 128 bits of hash and 64 further bits to check them by.

    Rows whose id or text is null, or whose text holds no word, give no row: they are nobody's copies. Only the
    two named columns are read, whatever else the table has.
    """
    rows = records.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null")
    return rows.mapInArrow(_hash_batches, _SCHEMA)


def copy_groups(hashes: DataFrame) -> DataFrame:
    """One row per canonical text: its hashes, ``first_id`` and ``copies``.

    The aggregation combines on the map side, so a text that a third of all rows share sends one row per task.
    Texts that share 128 bits but not the check or the number of words are kept apart; :func:`collisions` finds them.
    """
    return hashes.groupBy(*_KEYS).agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))


def collisions(groups: DataFrame) -> DataFrame:
    """Hash values that more than one canonical text has; none are expected."""
    return groups.groupBy("h1", "h2").agg(F.count("*").alias("texts")).filter("texts > 1")


def copies(records: DataFrame, id_col: str = "row_idx", text_col: str = "code", ws: Workspace | None = None) -> DataFrame:
    """``(first_id, id, copies)`` for every record of a group of at least two, its first included.

    Repeated ids count as repeated rows. An empty table, or one without copies, gives no rows.
    """
    ws = ws or Workspace(records.sparkSession)
    hashes = ws.table(canonical_hashes(records, id_col, text_col), "hashes")
    groups = ws.table(copy_groups(hashes).filter("copies > 1"), "groups")
    return attach(hashes, groups, _KEYS, "copies").select("first_id", "id", "copies")


def p1_found(spark, sf_dir: str) -> DataFrame:
    found = copies(spark.read.parquet(f"{sf_dir}/records.parquet"))
    return found.filter("id <> first_id").select(F.col("first_id").alias("first_row_idx"), F.col("id").alias("row_idx")).distinct()


def p1_groups(spark, sf_dir: str) -> DataFrame:
    """One record for each program text, also one that stands once, with its number of copies, whether its 128 bits collided, how
    many code_hash values tell the copies apart, and how many of those are out of date."""
    records = spark.read.parquet(f"{sf_dir}/records.parquet")
    ws = Workspace(spark)
    hashes = ws.table(canonical_hashes(records), "hashes")
    groups = ws.table(copy_groups(hashes), "groups")
    clash = collisions(groups).select("h1", "h2", F.lit(True).alias("clash"))
    flagged = ws.table(groups.join(clash, ["h1", "h2"], "left").select(*_KEYS, "first_id", "copies", F.col("clash").isNotNull().alias("collided")), "flagged")
    found = attach(hashes, flagged, _KEYS, "copies").select("first_id", "id", "copies", "collided")
    stored = records.select(
        F.col("row_idx").alias("id"),
        F.lower("code_hash").alias("stored"),
        (F.lower("code_hash") != F.sha2(F.col("code"), 256)).cast("int").alias("stale"),
    )
    return (
        found.join(stored, "id")
        .groupBy("first_id", "copies", "collided", "stored")
        .agg(F.sum("stale").alias("stale"), F.count("*").alias("n"))
        .groupBy(F.col("first_id").alias("first_row_idx"), "copies", "collided")
        .agg(F.count("stored").alias("stored_hashes"), F.coalesce(F.sum("stale"), F.lit(0)).alias("stale_hashes"))
    )
