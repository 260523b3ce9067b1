"""Problem 3: evaluation rows whose content also stands, exactly or almost, in a training row.

Method: exact prefix-filter bipartite join on rare shingles. Evaluation prefixes are the index, training prefixes
probe it with length and position filters, and what passes is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.neardup import _KEYS, frequencies, set_keys, verified
from corpusloom.llm.shingles import chunks, shingle_sets
from corpusloom.operators import similarity, sketch
from corpusloom.operators.skew import attach
from corpusloom.workspace import Workspace

_EPS = 1e-9


def split_name(c: Column) -> Column:
    """train, dev or test; validation is dev, and other words are null."""
    word = F.lower(F.regexp_replace(c, r"[\s\p{Z}]+", ""))
    return F.when(word.isin("train", "dev", "test"), word).when(word == "validation", "dev")


def assistant_content(messages: Column) -> Column:
    """The contents of the assistant's messages, wherever they stand, joined by a line break; null if there are none."""
    said = F.filter(messages, lambda m: F.lower(F.trim(m["role"])).eqNullSafe("assistant") & m["content"].isNotNull())
    return F.when(F.size(said) > 0, F.array_join(F.transform(said, lambda m: m["content"]), "\n"))


def _prefixes(texts: DataFrame, sent, k: int, threshold: float, index: bool) -> DataFrame:
    """``(shingle, cid, n, pos)``: the rarest n - ceil(threshold * n) + 1 shingles of each text with their places.

    A shingle that many texts may have is split, differently for the index and for what probes it, so that each pair meets once.
    """
    block_rows = sketch.BLOCK_ROWS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sent.value
        for batch in batches:
            ids, found = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            for a, b in chunks(found):
                offsets, hashes = shingle_sets(found[a:b], k)
                sizes = np.diff(offsets)
                row = np.repeat(np.arange(b - a), sizes)
                rank = seen.rank(hashes)
                order = np.lexsort((hashes, rank, row))
                place = np.arange(len(order)) - np.repeat(offsets[:-1], sizes)
                keep = place < np.repeat(sizes - np.ceil(threshold * sizes - _EPS).astype(np.int64) + 1, sizes)
                row, place, order = row[keep], place[keep], order[keep]
                at, key = sketch.split_across(hashes[order].view(np.int64), ids[a:b][row], seen.blocks(rank[order], block_rows), index)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ids[a:b][row[at]]), pa.array(sizes[row[at]].astype(np.int32)), pa.array(place[at].astype(np.int32))],
                    names=["shingle", "cid", "n", "pos"],
                )

    return texts.mapInArrow(cut, "shingle long, cid long, n int, pos int")


def cross_split_links(rows: DataFrame, k: int = 5, threshold: float = 0.8, ws: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """``(members, links)`` for rows ``(id string, held boolean, text)``.

    ``members`` has ``(cid, id, held)`` for every distinct row with at least k words, where cid is the class of the
    texts with one and the same shingle set; ``links`` has ``(eval_cid, train_cid, jaccard)`` for every class of
    held-out rows and class of training rows whose similarity reaches the threshold, one that holds both
    included. An id may stand on both sides, or with several texts; each of its rows counts. The join is exact: the order of
    shingles by frequency is a sketch of bounded size over all rows, and any order is right for a prefix filter. Rows with a
    null id, side or text have no part; nothing is capped.
    """
    spark = rows.sparkSession
    ws = ws or Workspace(spark)
    total = rows.count()
    # one id may stand on both sides, or more than once with other texts: side, text and id together tell rows apart
    name = F.concat(F.when(F.col("held"), "e").otherwise("t"), F.hex(F.xxhash64("text")), F.lit(":"), "id")
    rows = rows.select("id", "held", "text").dropna().withColumn("name", name)
    first = ws.table(set_keys(rows.select(F.col("name").alias("id"), "text"), k, sketch.count_bits(total), "string"), "sets")
    ranks = frequencies(first)
    keyed = ws.table(first.filter("chunk is null").select(F.col("id").alias("name"), *_KEYS).distinct(), "keys")
    held = F.substring("name", 1, 1) == "e"
    sides = keyed.groupBy(*_KEYS).agg(F.min("name").alias("rep"), F.max(held).alias("in_eval"), (~F.min(held)).alias("in_train"), F.count("*").alias("rows"))
    classes = ws.table(sides.withColumn("cid", F.monotonically_increasing_id()), "classes")
    own = F.expr("substring(name, locate(':', name) + 1)")
    members = attach(keyed, classes.select(*_KEYS, "cid", "rows"), _KEYS, "rows").select("cid", own.alias("id"), held.alias("held")).distinct()
    members = ws.table(members, "members")
    reps = classes.select(F.col("rep").alias("name"), "cid", "in_eval", "in_train")
    texts = _class_texts(rows, reps, ws)
    index = _prefixes(texts.filter("in_eval").select("cid", "text"), ranks, k, threshold, True).toDF("shingle", "a", "na", "i")
    probe = _prefixes(texts.filter("in_train").select("cid", "text"), ranks, k, threshold, False).toDF("shingle", "b", "nb", "j")
    na, nb, i, j = (F.col(c) for c in ("na", "nb", "i", "j"))
    required = F.ceil((na + nb) * (threshold / (1 + threshold)) - _EPS)
    rest = lambda n: n - (n - F.ceil(n * threshold - _EPS) + 1)
    short_enough = F.least(na, nb) >= F.greatest(na, nb) * threshold - _EPS
    in_place = F.least(i, j) + F.least(na - i, nb - j) >= required
    hits = index.join(probe, "shingle").filter((F.col("a") != F.col("b")) & short_enough & in_place)
    pairs = hits.select("a", "b", F.greatest(F.lit(1), required - F.greatest(rest(na), rest(nb))).cast("int").alias("need")).groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("need").alias("need"))
    candidates = ws.table(pairs.filter("shared >= need").select("a", "b"), "candidates")
    text = texts.select("cid", "text")
    with_text = candidates.join(text.toDF("a", "text_a"), "a").join(text.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    near = verified(with_text, k, threshold)
    same = classes.filter("in_eval and in_train").select(F.col("cid").alias("a"), F.col("cid").alias("b"), F.lit(1.0).alias("jaccard"))
    links = ws.table(near.unionByName(same).toDF("eval_cid", "train_cid", "jaccard"), "links")
    ws.drop(first, keyed, classes, texts, candidates)
    return members, links


def _class_texts(rows: DataFrame, reps: DataFrame, ws: Workspace) -> DataFrame:
    """``(cid, in_eval, in_train, text)``, one text for each class; a row that is repeated as a whole counts once."""
    found = rows.select("name", "text").join(reps, "name")
    return ws.table(found.dropDuplicates(["cid"]).select("cid", "in_eval", "in_train", "text"), "texts")


def _chat(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/chat_examples.parquet").select(
        "id", split_name(F.col("split")).alias("split"), F.col("meta.source_path").alias("source_path"), assistant_content(F.col("messages")).alias("text")
    )


def p3_found(spark, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    rows = _chat(spark, sf_dir).select("id", (F.col("split") != "train").alias("held"), "text")
    members, links = cross_split_links(rows, k=3, threshold=0.7, ws=ws)
    sides = []
    for side in ("held", "not held"):
        own = members.filter(side).select(F.col("cid").alias("class_id"), "id")
        sizes = ws.table(own.groupBy("class_id").agg(F.count("*").alias("copies")), "sizes")
        sides.append((attach(own, sizes, ["class_id"], "copies"), sizes))
    (held, held_sizes), (train, train_sizes) = sides
    both = similarity.across(links.select(F.col("eval_cid").alias("a"), F.col("train_cid").alias("b")), held, train, held_sizes, train_sizes)
    return both.filter("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def p3_report(spark, sf_dir: str) -> DataFrame:
    """Per split and source of the held-out rows: how many there are, and how many stand exactly or almost in training.

    Similarity is 0.7 on runs of three words, as the problem states. Copies are counted by their class, never paired.
    """
    chat = _chat(spark, sf_dir)
    ws = Workspace(spark)
    members, links = cross_split_links(chat.select("id", (F.col("split") != "train").alias("held"), "text"), k=3, threshold=0.7, ws=ws)
    best = links.groupBy(F.col("eval_cid").alias("cid")).agg(F.max("jaccard").alias("best"), F.count("*").alias("train_classes"))
    hit = members.filter("held").join(best, "cid").groupBy("id").agg(F.max("best").alias("best"))
    held = chat.filter("split in ('dev', 'test')").select("id", "split", "source_path").distinct()
    return held.join(hit, "id", "left").groupBy("split", "source_path").agg(
        F.count("*").alias("rows"),
        F.count(F.when(F.col("best") >= 1.0 - _EPS, 1)).alias("exact_rows"),
        F.count(F.when(F.col("best") < 1.0 - _EPS, 1)).alias("near_rows"),
    )
