"""Problems 3 and 6."""

import pytest

from corpusloom.functions.names import resolved_path
from corpusloom.llm import crosssplit, groupsplit
from corpusloom.operators import sketch, skew


def rows(spark, data):
    return spark.createDataFrame(data, "id string, held boolean, text string").selectExpr("*", "1 AS cid", "2 AS n", "3 AS a")


@pytest.mark.parametrize("block", [8192, 2])
def test_cross_split_links_against_brute_force(spark, monkeypatch, block):
    import random

    monkeypatch.setattr(sketch, "BLOCK_ROWS", block)

    from .test_records import edited, similar

    texts = edited(random.Random(7), 25, 4, 6)
    data = [(f"i{n:03d}", n % 3 == 0, t) for n, t in enumerate(texts)]
    data += [("null", True, None), (None, True, texts[0]), ("short", False, "a b"), ("blank", True, ""), (data[0][0], data[0][1], data[0][2]), ("long", False, " ".join(f"w{i}" for i in range(40_000)))]
    members, links = crosssplit.cross_split_links(rows(spark, data), k=3, threshold=0.7)
    held = {(r.cid, r.id) for r in members.filter("held").collect()}
    train = {(r.cid, r.id) for r in members.filter("not held").collect()}
    got = {tuple(sorted((e, t))) for a, b in {(r.eval_cid, r.train_cid) for r in links.collect()} for c, e in held if c == a for d, t in train if d == b}
    side = {i: h for i, h, _ in data}
    want = {(a, b) for a, b in similar([(i, t) for i, _, t in dict.fromkeys(data) if i], 3, 0.7) if side[a] != side[b]}
    assert got == want and want


def linked(members, links):
    held, train = ([(r.cid, r.id) for r in members.filter(f).collect()] for f in ("held", "not held"))
    return {(e, t) for link in links.collect() for c, e in held if c == link.eval_cid for d, t in train if d == link.train_cid}


def test_ids_on_both_sides_and_with_several_texts(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    members, links = crosssplit.cross_split_links(rows(spark, [("1", True, one), ("1", False, two), ("2", True, two), ("2", True, three), ("3", False, one)]), k=3, threshold=0.7)
    assert linked(members, links) == {("1", "3"), ("2", "1")}
    assert {(r.id, r.held) for r in members.collect()} == {("1", True), ("1", False), ("2", True), ("3", False)}


def test_shared_ids_against_brute_force(spark):
    import random

    from .test_records import edited, similar

    rng = random.Random(12)
    data = [(f"i{rng.randrange(30)}", rng.random() < 0.4, t) for t in edited(rng, 20, 4, 6)]
    members, links = crosssplit.cross_split_links(rows(spark, data), k=3, threshold=0.7)
    near = similar([(n, t) for n, (_, _, t) in enumerate(data)], 3, 0.7)
    want = {(data[x][0], data[y][0]) for a, b in near for x, y in ((a, b), (b, a)) if data[x][1] and not data[y][1]}
    assert linked(members, links) == want and want


def test_cross_split_of_nothing(spark):
    members, links = crosssplit.cross_split_links(rows(spark, []))
    assert members.count() == links.count() == 0


def test_split_names_and_contents(spark):
    df = spark.createDataFrame([(" Train",), ("VALIDATION ",), ("te st",), ("other",), (None,)], "s string")
    assert [r[0] for r in df.select(crosssplit.split_name(df.s)).collect()] == ["train", "dev", "test", None, None]
    kind = "m array<struct<role string, content string>>"
    df = spark.createDataFrame([([("user", "u"), ("Assistant", "x"), ("assistant", None)],), ([("user", "u")],), ([],), (None,), ([None],)], kind)
    assert [r[0] for r in df.select(crosssplit.assistant_content(df.m)).collect()] == ["x", None, None, None, None]


@pytest.mark.parametrize(
    "path, want",
    [
        ("/data/a//b/./c.py/", "/data/a/b/c.py"),
        (" file:///data/a/../b ", "/data/b"),
        ("\\data\\a", "/data/a"),
        ("./x/y", "/data/x/y"),
        ("x", "/data/x"),
        ("/../..", "/"),
        ("../up", "/up"),
        ("  ", None),
        (None, None),
    ],
)
def test_resolved_path(spark, path, want):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(resolved_path(df.p)).first()[0] == want


@pytest.mark.parametrize("hot_rows", [200_000, 1])
def test_related_groups_and_splits(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    data = [("b", "p:1"), ("a", "p:1"), ("a", "g:1"), ("c", "g:1"), ("d", "p:2"), ("e", None), (None, "p:2"), ("d", "p:2")]
    data += [(f"z{i:02d}", f"l:{i}") for i in range(40)] + [(f"z{i + 1:02d}", f"l:{i}") for i in range(40)]
    groups = groupsplit.related_groups(spark.createDataFrame(data, "id string, entity string"))
    got = {r.id: r.first_id for r in groups.collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d"} | {f"z{i:02d}": "z00" for i in range(41)}
    base = spark.createDataFrame([(i, "Fam") for i in [*got, "e", "e"]] + [(None, "x"), ("q", None)], "id string, family string").selectExpr("*", "1 AS weight", "'x' AS split", "5 AS n")
    done = groupsplit.assigned_splits(base, groups).collect()
    assert sorted(r.id for r in done) == sorted({*got, "e", "q"})
    assert len({r.split for r in done if r.first_id == "z00"}) == 1


def test_every_family_keeps_its_proportions(spark):
    # 300 families, groups of 1 to 16 rows; and 400 families too small to be divided
    base = spark.range(60_000).selectExpr("cast(id AS string) AS id", "concat('f', id % 300) AS family").unionByName(spark.range(60_000, 60_800).selectExpr("cast(id AS string) AS id", "concat('s', id % 400) AS family"))
    groups = spark.range(60_000).selectExpr("cast(id AS string) AS id", "concat('g', id % 300, '-', cast(sqrt(id div 300) AS int)) AS first_id")
    done = groupsplit.assigned_splits(base, groups)
    assert done.count() == 60_800 and done.groupBy("first_id").agg({"split": "max", "family": "count"}).count() == done.select("first_id", "split").distinct().count()
    shares = {(r.family, r["split"]): r["count"] / 200 for r in done.filter("family like 'f%'").groupBy("family", "split").count().collect()}
    assert len(shares) == 900 and all(abs(v - dict(groupsplit.SPLITS)[s]) < 0.03 for (_, s), v in shares.items())
    small = {r["split"]: r["count"] / 800 for r in done.filter("family like 's%'").groupBy("split").count().collect()}
    assert abs(small["train"] - 0.8) < 0.02 and abs(small["dev"] - 0.1) < 0.02


def test_splits_keep_proportions(spark):
    base = spark.range(4000).selectExpr("cast(id AS string) AS id", "concat('f', id % 3) AS family")
    none = spark.createDataFrame([], "id string, first_id string")
    n = {r["split"]: r["count"] for r in groupsplit.assigned_splits(base, none).groupBy("split").count().collect()}
    assert abs(n["train"] - 3200) < 60 and abs(n["dev"] - 400) < 60 and abs(n["test"] - 400) < 60
    assert groupsplit.assigned_splits(base.limit(0), none).count() == 0
