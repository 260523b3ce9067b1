"""Problems 1, 2, 4 and 5 against brute force and on awkward rows."""

import itertools
import random
import re

import pytest

from corpusloom.llm import canonical, matches, neardup, partenum, representative
from corpusloom.llm.shingles import shingle_sets
from corpusloom.operators import sketch, skew
from corpusloom.operators.sketch import Frequencies
from corpusloom.workspace import Workspace

RECORD = "row_idx long, id string, name string, code string, accuracy double, code_hash string, family_tag string, fetched_at timestamp, loaded_at timestamp"


def records(spark, rows, extra=False):
    full = [(i, f"x_{i}", name, code, acc, None, None, None, None) for i, name, code, acc in rows]
    df = spark.createDataFrame(full, RECORD)
    if extra:  # columns whose names the operators use themselves
        for c in ("h1", "text", "first_id", "copies", "sig", "class_id", "vote", "n", "a"):
            df = df.selectExpr("*", f"'clash' AS {c}")
    return df


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("f(a=1, b=2)", "F( b = 2,\n a=1,)", True),
        ("f(x, a=1, b=2)", "f(x, b=2, a=1)", True),
        ("f(1, 2)", "f(2, 1)", False),
        ("d = {'a': 1, 'b': 2}", 'd={"b":2,"a":1}', True),
        ("{1, (2, 3)}", "{(3, 2), 1}", False),
        ("f(a=(1, 2), b={3, 4})", "f(b={4, 3}, a=(1, 2))", True),
        ("f(a=1, b=2", "f(b=2, a=1", False),  # never closed
        ("f(a == 1, b == 2)", "f(b == 2, a == 1)", False),
        ("[a, b]", "[b, a]", False),
        ("x;\r\ny", "x​  y", True),
        ("x1", "x 1", False),
        (")f(a=1, b=2)", "f(b=2, a=1)", True),
    ],
)
def test_canonical_words(a, b, same):
    assert (canonical.canonical_words(a) == canonical.canonical_words(b)) is same


def test_kelvin_sign_is_no_letter():
    assert canonical.canonical_words("aKb") == ["a", "b"]


def test_copies_on_awkward_rows(spark):
    rows = [(5, None, "f(a=1, b=2)", None), (3, "n", "f(b=2, a=1)", 1.0), (9, "n", "F(A=1,B=2)", 1.0), (4, "n", None, 1.0), (6, "n", "", 1.0), (7, "n", " ;() ", 1.0), (8, "n", "alone", 1.0)]
    rows += [(10, "n", "word " * 200_000, 1.0), (11, "n", "WORD\n" * 200_000, 1.0)]
    got = {tuple(r) for r in canonical.copies(records(spark, rows, extra=True)).collect()}
    assert got == {(3, 3, 3), (3, 5, 3), (3, 9, 3), (10, 10, 2), (10, 11, 2)}
    assert canonical.copies(records(spark, [])).count() == 0


def test_no_collisions_and_a_flagged_one(spark):
    df = spark.createDataFrame([(1, 7, 7, 1, 2), (2, 7, 7, 1, 2), (3, 7, 7, 9, 2)], "id long, h1 long, h2 long, check long, n_words int")
    groups = canonical.copy_groups(df)
    assert groups.count() == 2 and canonical.collisions(groups).count() == 1


def test_p1_groups_has_single_texts_and_the_flag(spark, tmp_path, monkeypatch):
    rows = [(3, "n", "f(b=2, a=1)", 1.0), (5, "n", "f(a=1, b=2)", None), (8, "n", "alone", 1.0), (9, "n", "other", 1.0), (10, "n", None, 1.0)]
    records(spark, rows).write.parquet(str(tmp_path / "records.parquet"))
    got = lambda: {(r.first_row_idx, r.copies, r.collided) for r in canonical.p1_groups(spark, str(tmp_path)).collect()}
    assert got() == {(3, 2, False), (8, 1, False), (9, 1, False)}
    hashed = spark.createDataFrame([(3, 7, 7, 1, 2), (5, 7, 7, 1, 2), (8, 7, 7, 9, 2), (9, 7, 8, 1, 2)], "id long, h1 long, h2 long, check long, n_words int")
    monkeypatch.setattr(canonical, "canonical_hashes", lambda *_: hashed)
    assert got() == {(3, 2, True), (8, 1, True), (9, 1, False)}


@pytest.mark.parametrize("hot_rows", [200_000, 3])
def test_match_groups(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    pairs = [("A_1", " 'b_1' "), ("b_1", "ghost"), ("GHOST", '"c_1"'), ("d_1", "d_1"), ("e_1", None), (None, "e_1"), ("f_1", " "), ("g_1", "h_1"), ("g_1", "h_1")]
    pairs += [(f"chain{i:03d}", f"chain{i + 1:03d}") for i in range(60)]  # longer than the breadth-first levels
    pairs += [(f"leaf{i:03d}", "chain010") for i in range(30)]  # a hub
    m = spark.createDataFrame(pairs, "id string, canonical string").selectExpr("*", "1 AS node", "1 AS component")
    ids = ["a_1", "b_1", "c_1", "d_1", "e_1", "f_1", "g_1", "h_1", "leaf007", *(f"chain{i:03d}" for i in range(0, 61, 7))]
    r = spark.createDataFrame([(i,) for i in ids], "id string").selectExpr("*", "2 AS node", "3 AS name")
    got = {tuple(x) for x in matches.consolidated(m, r).collect()}
    want = {("a_1", "a_1"), ("a_1", "b_1"), ("a_1", "c_1"), ("g_1", "g_1"), ("g_1", "h_1")} | {("chain000", i) for i in ids if i.startswith(("chain", "leaf"))}
    assert got == want
    assert matches.consolidated(m.limit(0), r).count() == 0 and matches.consolidated(m, r.limit(0)).count() == 0


def similar(codes, k, t):
    def runs(text):
        w = [x.lower() for x in re.findall(r"[A-Za-z0-9_]+", text or "")]
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    sets = {i: s for i, c in codes if (s := runs(c))}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}


def edited(rng, n_base, n_copies, words):
    out = []
    for _ in range(n_base):
        text = [rng.choice("abcdefghij") + str(rng.randrange(words)) for _ in range(rng.randrange(3, 90))]
        out.append(text)
        for _ in range(n_copies):
            t = list(text)
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(t))
                t[at : at + rng.randrange(2)] = [f"new{rng.randrange(50)}"] * rng.randrange(3)
            out.append(t)
    return [" ".join(t) for t in out]


@pytest.mark.parametrize("seed, k, t, words", [(1, 3, 0.7, 9), (2, 5, 0.8, 3), (3, 3, 0.5, 2)])
@pytest.mark.parametrize("block", [8192, 2])
def test_near_duplicates_against_brute_force(spark, monkeypatch, seed, k, t, words, block):
    monkeypatch.setattr(sketch, "BLOCK_ROWS", block)  # the second splits signatures and classes
    codes = list(enumerate(edited(random.Random(seed), 30, 4, words)))
    codes += [(500, None), (501, ""), (502, "one two"), (503, codes[0][1].upper()), (504, codes[0][1])]
    df = records(spark, [(i, "n", c, 0.5) for i, c in codes], extra=True)
    members, links = neardup.near_duplicates(df, "row_idx", "code", k=k, threshold=t)
    got = [tuple(r) for r in neardup.expanded(members, links).collect()]
    assert len(got) == len(set(got)) and set(got) == similar(codes, k, t)
    whole = neardup.grouped(members, links, Workspace(spark))
    assert whole.count() == members.count()


def test_near_duplicates_of_nothing_and_of_one_very_long_text(spark):
    members, links = neardup.near_duplicates(records(spark, []), "row_idx", "code")
    assert members.count() == links.count() == 0
    long = " ".join(f"w{i}" for i in range(60_000))
    members, links = neardup.near_duplicates(records(spark, [(1, "n", long, None), (2, "n", long + " end", None), (3, "n", "short one", None)]), "row_idx", "code")
    assert members.count() == 2 and [(r.a, r.b) for r in links.collect()] == [(1, 2)]


def test_signatures_miss_no_pair():
    rng = random.Random(5)
    texts = edited(rng, 40, 3, 4)
    offsets, hashes = shingle_sets(texts, 2)
    import numpy as np

    for levels in (np.zeros(16, np.uint8), np.arange(1024).astype(np.uint8)):
        row, sig, *_ = partenum.signatures(offsets, hashes, Frequencies(levels, 0.0), 0.6)
        has = {}
        for r, s in zip(row.tolist(), sig.tolist()):
            has.setdefault(r, set()).add(s)
        for a, b in similar(list(enumerate(texts)), 2, 0.6):
            assert has[a] & has[b]


def test_survivors(spark):
    code = "f(a=1, b=2)"
    rows = [
        (1, "b", code, 54.0),  # 0.54 as a percentage
        (2, "a", code + "   ", 0.54),  # longer
        (3, "", code + "   ", 0.54),  # blank names last
        (4, "a", code + "   ", float("nan")),
        (5, None, code, None),
        (6, "x", "other thing", float("nan")),
        (7, "y", "Other; thing", None),
        (8, "z", "third text here", 1.0),
        (9, "z", "third text here", 1.0),  # a tie: the smaller row_idx
    ]
    df = records(spark, rows, extra=True)
    built = {r.first_row_idx: r for r in representative.representatives(df, canonical.copies(df)).collect()}
    assert {k: r.survivor for k, r in built.items()} == {1: 2, 6: 7, 8: 8}
    assert built[1].accuracy == 0.54 and built[1].name in ("a", "b") and built[6].accuracy is None
    names = [(i, n, "one two three", 0.5) for i, n in enumerate(["b", "ab", "abc", "a b", "Z", "é"], 20)]
    tied = records(spark, names)
    assert representative.representatives(tied, canonical.copies(tied)).first().survivor == 24  # by bytes, capitals first
    tied = tied.filter("row_idx in (21, 22)")
    assert representative.representatives(tied, canonical.copies(tied)).first().survivor == 21  # a name before its continuation
    empty = records(spark, [])
    assert representative.representatives(empty, canonical.copies(empty)).count() == 0
