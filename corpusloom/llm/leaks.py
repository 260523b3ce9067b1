"""Problem 8: evaluation passages inside corpus documents.

Method: a distributed positional inverted index. The postings of all terms of the corpus are written once; offset-adjusted
lists are intersected from each item's rarest terms, which gives exact phrase and proximity matches, and each match is verified.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.markup import TAG
from corpusloom.llm.neardup import only
from corpusloom.llm.shingles import chunks, word_hashes
from corpusloom.operators import sketch
from corpusloom.operators.sketch import mix
from corpusloom.operators.skew import attach
from corpusloom.workspace import Workspace

#: One word in so many may be altered, added or left out.
EDIT_EVERY = 10
#: An index term is a run of so many words.
TERM_WORDS = 3
#: Terms of one passage that must be found in place before it is verified.
HITS = 6
#: Test terms are broadcast up to this number (8 bytes each); beyond it the index is counted as a whole.
MOST_SENT_TERMS = 500_000
_WORD = re.compile(r"[^\W_]+")
_MARK = re.compile(r"[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")


def plain_words(text: str) -> list[str]:
    """Runs of letters and digits of any script, without regard to case, accents, punctuation and markup."""
    if "<" in text:
        text = TAG.sub(" ", text)
    if text.isascii():
        return _WORD.findall(text.lower())
    return _WORD.findall(_MARK.sub("", unicodedata.normalize("NFKD", text)).casefold())


def least_words(n: int) -> int:
    """At least half of the item's words."""
    return (n + 1) // 2


def gram(words: list[str]) -> int:
    """Words to a term: three, or fewer where half of the item has fewer."""
    return max(1, min(TERM_WORDS, least_words(len(words))))


def terms(words: list[list[str]], g: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, term)`` of every run of ``g`` words of each list, as 64-bit hashes."""
    sizes = np.array([len(w) for w in words], np.int64)
    h = word_hashes([w for ws in words for w in ws])
    n = np.maximum(sizes - g + 1, 0)
    row = np.repeat(np.arange(len(words)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = place + np.repeat(np.cumsum(sizes) - sizes, n)
    term = np.full(len(row), g, np.uint64)
    for j in range(g):
        term = mix(term * np.uint64(0x9E3779B97F4A7C15) + h[at + j] + np.uint64(j + 1))
    return row, place, term.view(np.int64)


def needed_hits(m: int, g: int) -> int:
    """Terms in place that any passage of an item of m words is sure to keep: each edit spoils at most g of its terms."""
    return max(1, min([HITS, *(n - g + 1 - g * (n // EDIT_EVERY) for n in range(least_words(m), m + 1))]))


def choose_anchors(m: int, g: int, frequency: list[int]) -> list[int]:
    """Places of the rarest terms of an item of ``m`` words, enough of them that every passage that counts keeps HITS unaltered.

    A passage of n words may have n / EDIT_EVERY edits, each of which spoils at most as many terms as a term has words.
    So each run of n words, n at least half of the item, gets that many anchors and HITS more, or all its terms. Of the
    lengths with equally many edits only the least matters: longer runs contain such a one.
    """
    rank = np.lexsort((np.arange(len(frequency)), np.array(frequency))).argsort()
    chosen = np.zeros(len(frequency), np.int64)
    low = least_words(m)
    for n in [low, *(n for n in range(low + 1, m + 1) if n % EDIT_EVERY == 0)]:
        span = n - g + 1
        need = min(span, g * (n // EDIT_EVERY) + HITS)
        while True:
            run = np.concatenate([[0], np.cumsum(chosen)])
            bad = np.flatnonzero(run[span:] - run[:-span] < need)
            if not len(bad):
                break
            start = int(bad[0])
            free = start + np.flatnonzero(chosen[start : start + span] == 0)
            chosen[free[np.argsort(rank[free])][: need - int(run[start + span] - run[start])]] = 1
    return np.flatnonzero(chosen).tolist()


def _reach(a: list, b: list, i: int, j: int, step: int, most: int) -> list[int]:
    """How many words of ``a`` beyond place i can be covered, in direction ``step``, with 0, 1, ... ``most`` edits against ``b`` beyond j."""
    n_a = len(a) - i if step > 0 else i + 1
    n_b = len(b) - j if step > 0 else j + 1
    far: dict[int, int] = {}
    out = []
    for e in range(most + 1):
        now: dict[int, int] = {}
        for d in range(-e, e + 1):  # d: words of b ahead of those of a
            if e == 0:
                x = 0
            else:
                x = max(far.get(d, -2) + 1, far.get(d - 1, -2), far.get(d + 1, -2) + 1)
            if x < 0:
                continue
            x = min(x, n_a, n_b - d)
            if x < 0 or x + d < 0:
                continue
            while x < n_a and x + d < n_b and a[i + step * x] == b[j + step * (x + d)]:
                x += 1
            now[d] = x
        if not now:
            break
        far = now
        out.append(max(now.values()))
        if out[-1] >= n_a:
            break
    return out


def _may_align(item: np.ndarray, doc: np.ndarray, shift: int, low: int, most: int) -> bool:
    """Whether some run of ``low`` or more item words finds nine in ten of its words near its place ``shift`` further on in ``doc``."""
    m = len(item)
    near = np.zeros(m, bool)
    for d in range(shift - most, shift + most + 1):
        a, b = max(0, -d), min(m, len(doc) - d)
        if a < b:
            near[a:b] |= item[a:b] == doc[a + d : b + d]
    score = np.concatenate([[0], np.cumsum(near * EDIT_EVERY - (EDIT_EVERY - 1))])
    ahead = np.maximum.accumulate(score[::-1])[::-1]
    return bool((ahead[low:] >= score[: m + 1 - low]).any())


def contains_passage(item: list, doc: list) -> bool:
    """Whether one stretch of ``doc`` has at least half of the item's words in order, with at most one in EDIT_EVERY edited.

    A passage with that few edits holds an unbroken run of some length; each such run is extended both ways by the
    furthest reach for each number of edits, which decides the question exactly.
    """
    m = len(item)
    low = least_words(m)
    if not m or not doc:
        return False
    most = m // EDIT_EVERY
    seed = min(-(-(n - n // EDIT_EVERY) // (n // EDIT_EVERY + 1)) for n in range(low, m + 1))
    starts: dict = {}
    for i in range(m - seed + 1):
        starts.setdefault(tuple(item[i : i + seed]), []).append(i)
    number = {w: n for n, w in enumerate(set(item))}
    a, b = np.array([number[w] for w in item]), np.array([number.get(w, -1) for w in doc])
    tried = set()
    aligned: dict[int, bool] = {}
    for j, words in enumerate(zip(*(doc[k:] for k in range(seed)))):
        for i in starts.get(words, ()):
            inside = (i - 1, j - 1) in tried  # of a run that was tried
            tried.add((i, j))
            if inside:
                continue
            if j - i not in aligned:
                aligned[j - i] = _may_align(a, b, j - i, low, 2 * most)
            if not aligned[j - i]:
                continue
            left = _reach(item, doc, i - 1, j - 1, -1, most) if i and j else [0]
            right = _reach(item, doc, i, j, 1, most)
            for el, x in enumerate(left):
                for er, y in enumerate(right):
                    if x + y >= low and EDIT_EVERY * (el + er) <= x + y:
                        return True
    return False


def postings(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """``(term, doc_id, pos)`` for every place of every term, of ``sizes`` words, of documents ``(id, text)``.

    The index is partitioned by documents: a part has the lists of its own ones, in runs sorted by term, so nothing is shuffled to build it.
    """

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                words = [plain_words(t) for t in texts[a:b]]
                for g in sizes:
                    row, place, term = terms(words, g)
                    order = np.argsort(term, kind="stable")
                    yield pa.RecordBatch.from_arrays([pa.array(term[order]), pa.array(ids[a:b][row[order]]), pa.array(place[order].astype(np.int32))], names=["term", "doc_id", "pos"])

    return docs.mapInArrow(post, "term long, doc_id long, pos int")


def _prepared(items: DataFrame) -> DataFrame:
    """``(item, item_id, words, g, terms)`` for items ``(item, item_id, text)`` that have words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [plain_words(t) for t in batch.column(2).to_pylist()]
            have = [i for i, w in enumerate(words) if w]
            grams = [gram(words[i]) for i in have]
            found = [terms([words[i]], g)[2] for i, g in zip(have, grams)]
            take = pa.array(have, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array([words[i] for i in have], pa.list_(pa.string())), pa.array(grams, pa.int32()), pa.array(found, pa.list_(pa.int64()))],
                names=["item", "item_id", "words", "g", "terms"],
            )

    return items.mapInArrow(read, "item long, item_id long, words array<string>, g int, terms array<long>")


def _anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """``(term, item, at, edits, need, n)``: each item's anchors, n being the length of the term's list."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, m, g, found in zip(*(batch.column(c).to_pylist() for c in range(4))):
                found = sorted((f["at"], f["term"], f["n"]) for f in found)
                for p in choose_anchors(m, g, [n for *_, n in found]):
                    rows.append((found[p][1], item, p, m // EDIT_EVERY, needed_hits(m, g), found[p][2]))
            cols = np.array(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([pa.array(cols[:, c].astype(np.int64 if c in (0, 1, 5) else np.int32)) for c in range(6)], names=["term", "item", "at", "edits", "need", "n"])

    # one item's terms make one row
    known = items.select("item", F.size("words").alias("m"), "g", F.posexplode("terms").alias("at", "term")).join(counts, "term", "left")
    rows = known.groupBy("item", "m", "g").agg(F.collect_list(F.struct("at", "term", F.coalesce("n", F.lit(0)).alias("n"))).alias("found"))
    return rows.mapInArrow(choose, "term long, item long, at int, edits int, need int, n long")


def _verified(candidates: DataFrame) -> DataFrame:
    """``(doc_id, item_id)`` of the candidates ``(doc_id, item_id, words, text)`` that hold the passage."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, []
        for batch in batches:
            docs, items = [], []
            for d, i, words, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if text != last:  # rows of one document mostly follow each other
                    last, found = text, plain_words(text)
                if contains_passage(words, found):
                    docs.append(d)
                    items.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64())], names=["doc_id", "item_id"])

    return candidates.select("doc_id", "item_id", "words", "text").mapInArrow(verify, "doc_id long, item_id long")


def leaked(documents: DataFrame, items: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """``(doc_id, item_id)`` for every document that contains a passage of an item.

    ``documents`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``. The corpus is read once for its index and once
    more for the texts of candidates, however many items there are; items and their anchors are tables and nothing of
    either comes to the driver. A term that very many places have is a hot key and is taken apart (:func:`corpusloom.operators.skew.attach`).
    Null ids and texts and texts without words match nothing; repeated rows give one result row; an id that has several
    texts stands for each of them.
    """
    spark = documents.sparkSession
    ws = ws or Workspace(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("id"), "text").filter("id is not null and text is not null")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna().distinct()
    asked = ws.table(_prepared(asked.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text")), "items")
    sizes = sorted(r.g for r in asked.select("g").distinct().collect())  # at most TERM_WORDS
    if not sizes:
        return spark.createDataFrame([], "doc_id long, item_id long")
    index = ws.table(postings(docs, sizes), "postings")
    wanted = ws.table(asked.select(F.explode("terms").alias("term")).distinct(), "terms")
    if wanted.count() <= MOST_SENT_TERMS:
        counts = index.join(F.broadcast(wanted), "term").groupBy("term").agg(F.count("*").alias("n"))
    else:
        counts = index.groupBy("term").agg(F.count("*").alias("n")).join(wanted, "term")
    probes = ws.table(_anchors(asked, ws.table(counts, "counts")), "anchors")
    hits = attach(index, probes, ["term"], "n").select("doc_id", "item", "need", "edits", (F.col("pos") - F.col("at")).alias("offset"))
    both = hits.groupBy("doc_id", "item").agg(F.count("*").alias("places"), F.first("need").alias("need")).filter("places >= need").select("doc_id", "item")
    pairs = ws.table(both, "pairs")
    # edits move the offset by one each, so all hits of a passage lie in one of two overlapping strips
    width = 2 * (F.col("edits") + 1)
    strips = F.explode(F.array(F.floor(F.col("offset") / width) * 2, F.floor((F.col("offset") + width / 2) / width) * 2 + 1))
    placed = hits.join(pairs, ["doc_id", "item"]).select("doc_id", "item", "need", strips.alias("strip"))
    found = placed.groupBy("doc_id", "item", "strip").agg(F.count("*").alias("places"), F.first("need").alias("need")).filter("places >= need")
    candidates = ws.table(found.select("doc_id", "item").distinct().join(asked.select("item", "item_id", "words"), "item"), "candidates")
    passing = spark.sparkContext.broadcast(sketch.id_filter(candidates.select("doc_id")))
    texts = only(docs, passing, True).withColumnRenamed("id", "doc_id")
    return _verified(candidates.join(texts, "doc_id")).distinct()


def p8_found(spark, sf_dir: str) -> DataFrame:
    return leaked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/eval_items.parquet"))


def p8_report(spark, sf_dir: str) -> DataFrame:
    """Per suite and split: items, leaked items and documents that hold one."""
    items = spark.read.parquet(f"{sf_dir}/eval_items.parquet")
    found = p8_found(spark, sf_dir)
    per = found.groupBy("item_id").agg(F.count("*").alias("documents"))
    return items.join(per, "item_id", "left").groupBy("suite", "split").agg(
        F.count("*").alias("items"), F.count("documents").alias("leaked_items"), F.coalesce(F.sum("documents"), F.lit(0)).alias("leaks")
    )
