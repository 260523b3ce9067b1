"""Core operators on small tables."""

import collections
import itertools
import json
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import names
from corpusloom.operators import chat, components, exact, retention, similarity, sketch, skew, splits
from corpusloom.operators.components import bipartite_components, connected_components
from corpusloom.plans import chatprep, curate
from corpusloom.sources import readers, sinks
from corpusloom.workspace import Workspace, spread

ROWS = "row_idx long, name string, code string, accuracy double"


def test_names(spark):
    df = spark.createDataFrame([("Res-Net 5",), ("resnext",), (None,), ("vgg",)], "name string")
    got = df.select(names.matched_prefix(df.name, ["Res", "ResNet"]), names.prefix_rank(df.name, ["ResNet", "Res"]), names.has_prefix(df.name, ["V.G.G"])).collect()
    assert [tuple(r) for r in got] == [("Res", 0, False), ("Res", 1, False), (None, 102, False), (None, 102, True)]
    files = spark.createDataFrame([(" a b/ü.py\t",), ("",), (None,), ("---",)], "name string")
    assert [r[0] for r in files.select(names.safe_filename(files.name)).collect()] == ["a_b.py", "model", "model", "---"]
    assert names.parse_upweights(["A:2", "B:x", "C:-1", "D", ":3", "e:f:0.5", "A:1e3", "A:inf", " F : .5 ", "G:0", "H:1.", "I:٣"]) == [("A", 2.0), ("F", 0.5)]
    assert names.pick_name_column(["file", "nn"]) == "nn" and names.pick_name_column(["x"]) is None
    fam = spark.createDataFrame([("ResNet1", ""), ("EfficientNet", "depthwise"), ("gpt", "x"), ("GPT", "")], "n string, c string")
    assert [r[0] for r in fam.select(names.family_of_model(fam.n, fam.c)).collect()] == ["resnet", "mobile", "generic", "transformer"]


def test_exact_groups(spark):
    rows = [(0, "a", "x", None), (1, "FractalNet", "x", 0.1), (2, "ResNet", "x", 0.9), (3, "b", "y", float("nan")), (4, "c", "y", 0.0), (5, "d", None, 1.0), (6, "d", " \n", 1.0), (7, "e", "z", 1.0)]
    groups = exact.exact_groups(exact.make_records(spark.createDataFrame(rows, ROWS)), ["FractalNet", "ResNet"])
    kept = {r.id.split("_")[1]: (r.reason, r.ord) for r in exact.kept(groups).collect()}
    assert kept == {"1": ("canonical_of_exact_group", 0), "4": ("canonical_of_exact_group", 3), "7": ("unique", 7)}
    assert {r.id.split("_")[1] for r in exact.tombstones(groups).collect()} == {"0", "2", "3"}
    assert exact.exact_groups(exact.make_records(spark.createDataFrame([], ROWS)), []).count() == 0
    one = {r.name: r.canonical_name for r in exact.tombstones(groups).collect()}
    assert one == {"a": "FractalNet", "ResNet": "FractalNet", "b": "c"}


def test_family_comes_from_the_name_first(spark):
    rows = [(0, "FractalNet-9", "x = 1", None), (1, "other", "x = FractalBlock()", None), (2, "other", "x = 1", None), (3, None, "vgg", None)]
    got = {r.row_idx: r.family_tag for r in exact.make_records(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == {0: "fractal", 1: "fractal", 2: "generic", 3: "vgg"}


def brute(data, t):
    """Pairs of rows (id, family, items) of one family; empty sets are all alike."""
    full = {(a[0], b[0]): 1.0 if not a[2] and not b[2] else len({*a[2]} & {*b[2]}) / len({*a[2]} | {*b[2]}) for a, b in itertools.combinations(data, 2) if a[1] == b[1] is not None and a[2] is not None and b[2] is not None}
    return {k for k, v in full.items() if v >= t}


SETS = "id long, family string, items array<string>"


def test_similar_classes_against_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    data = [(i, rng.choice("fg"), [f"t{x}" for x in rng.sample(range(14), rng.randrange(0, 9))]) for i in range(120)] + [(500, None, ["t1"]), (501, "f", None)]
    df = spark.createDataFrame(data, SETS)
    for block in (8192, 3):  # the second splits nearly every item and class
        monkeypatch.setattr(similarity.sketch, "BLOCK_ROWS", block)
        for t in (0.5, 0.8):
            members, links = similarity.similar_classes(df, t)
            got = [(r.a, r.b) for r in similarity.all_pairs(members, links).collect()]
            assert len(got) == len(set(got)) and set(got) == brute(data, t)
            rows = {r.id: r for r in similarity.class_rows(members, links, Workspace(spark)).collect()}
            assert set(rows) == {i for i, f, x in data if f and x is not None} and all(r.copies == sum(o.class_id == r.class_id for o in rows.values()) for r in rows.values())
    assert all(d.count() == 0 for d in similarity.similar_classes(df.limit(0), 0.5))


def test_pairs_are_ruled_out_before_they_are_shuffled(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(f"r{i:03d}", "f", [str(x) for x in rng.sample(range(100), 60)]) for i in range(300)]
    rows += [("s0", "f", [*rows[0][2][1:], "new"]), ("s1", "g", [*rows[1][2][1:], "new"])]
    whole, seen = similarity._meeting, []

    def meeting(prefix, threshold):
        out = whole(prefix, threshold)
        seen.append((prefix.groupBy("key").count().selectExpr("sum(count * (count - 1) div 2)").first()[0], out.count()))
        return out

    monkeypatch.setattr(similarity, "_meeting", meeting)
    _, links = similarity.similar_classes(spark.createDataFrame(rows, "id string, family string, items array<string>"), 0.9)
    assert [(r.a, r.b, r.family) for r in links.collect()] == [("r000", "s0", "f")]
    assert seen[0][0] > 5000 and seen[0][1] < 100


def test_lsh_gives_all_pairs_of_a_bucket(spark, monkeypatch):
    # near copies of one set, some of them equal, and empty sets; blocks are smaller than a bucket
    monkeypatch.setattr(similarity.sketch, "BLOCK_ROWS", 3)
    near = [[f"t{x}" for x in range(400) if x != k] for k in range(10)]
    data = [(i, "f", near[i % 10]) for i in range(14)] + [(20 + i, "fractal", near[i]) for i in range(4)] + [(30 + i, "f", []) for i in range(3)]
    df = spark.createDataFrame(data, SETS)
    rows = lambda pair: sorted((r.a, r.b) for r in similarity.all_pairs(*pair).collect())
    want = rows(similarity.similar_classes(df, 0.9))
    assert len(want) == 91 + 6 + 3 and rows(similarity.lsh_classes(df, 0.9)) == want
    strict = F.when(F.col("family") == "f", 0.999).otherwise(0.9)
    assert similarity.lsh_classes(df, 0.9, strict)[1].count() == 6


def test_lsh_recall_at_the_threshold(spark):
    # two sets of 99 that share 88 are alike to 0.8, those of 19 that share 18 to 0.9; no others share an item
    for t, shared, own in ((0.8, 88, 11), (0.9, 18, 1)):
        data = [(2 * i + side, "f", [f"{i}-{x}" for x in range(shared)] + [f"{i}-{side}-{x}" for x in range(own)]) for i in range(300) for side in (0, 1)]
        df = spark.createDataFrame(data, SETS)
        exact, lsh = ({(r.a, r.b) for r in f(df, t)[1].collect()} for f in (similarity.similar_classes, similarity.lsh_classes))
        assert len(exact) == 300 and lsh <= exact and len(lsh) >= 0.9 * len(exact)
    assert similarity.banding(0.8) == (32, 8) and all(b * r <= 256 for b, r in map(similarity.banding, (0.01, 0.5, 0.97, 1.0)))


def test_split_keys_meet_once():
    ids, blocks = np.arange(100, dtype=np.uint64), np.full(100, 7)
    keys = np.full(100, 42)
    row, key, side = sketch.split_within(keys, ids, blocks)
    by = collections.defaultdict(list)
    for r, k, s in zip(row.tolist(), key.tolist(), side.tolist()):
        by[k].append((r, s))
    met = collections.Counter((min(a, b), max(a, b)) for rows in by.values() for (a, sa), (b, sb) in itertools.combinations(rows, 2) if sketch.meets(sa, sb))
    assert met == dict.fromkeys(itertools.combinations(range(100), 2), 1)
    left, right = sketch.split_across(keys, ids, blocks, True), sketch.split_across(keys[:30], ids[:30], blocks[:30], False)
    met = collections.Counter((a, b) for a, k in zip(*map(np.ndarray.tolist, left)) for b, m in zip(*map(np.ndarray.tolist, right)) if k == m)
    assert met == dict.fromkeys(itertools.product(range(100), range(30)), 1)


@pytest.fixture(params=[200_000, 5])
def hot_rows(request, monkeypatch):
    """Components with and without hot nodes and labels."""
    monkeypatch.setattr(skew, "HOT_ROWS", request.param)
    return request.param


@pytest.mark.parametrize("keys", [50_000, 0])
def test_attach_with_hot_keys(spark, monkeypatch, keys):
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", keys)
    members = Workspace(spark).table(spark.createDataFrame([(i, "k" if i % 3 else f"k{i}") for i in range(300)] + [(300, None)], "id long, key string"))
    groups = Workspace(spark).table(members.groupBy("key").count().withColumnRenamed("count", "n"))
    assert sorted(r.id for r in skew.attach(members, groups, ["key"], "n", hot_rows=50).collect()) == list(range(300))


def test_components_agree_with_union_find(spark, hot_rows):
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 260)] + [(5, None), (7, 7)]
    edges += [(300, i) for i in range(301, 340)]  # a star
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    links = [(a, f"e{k}") for k, e in enumerate(edges) for a in e if e[1] is not None and e[0] != e[1]]
    rows = bipartite_components(spark.createDataFrame(links, "r long, e string"), "r", "e").collect()
    assert {r.row: r.component for r in rows} == got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_hot_label_is_shuffled(spark, monkeypatch):
    """With hot nodes and labels taken apart, what is joined by shuffle on a label leaves out the giant one."""
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    seen = []
    plain = components.attach

    def watched(members, groups, keys, count, hot_rows=None):
        out = plain(members, groups, keys, count, hot_rows)
        seen.append((keys, out._jdf.queryExecution().optimizedPlan().toString()))
        return out

    monkeypatch.setattr(components, "attach", watched)
    star = spark.createDataFrame([(0, i) for i in range(1, 60)], "a long, b long")
    assert {r.component for r in connected_components(star).collect()} == {0}
    assert {tuple(k) for k, _ in seen} == {("dst",), ("c",)} and all("LeftAnti" in plan and "strategy=broadcast" in plan for _, plan in seen)


def test_best_k_and_prefix_coverage(spark):
    rows = [(i, "ResNet" if i == 6 else "x", f"code {i}", 1 - i / 10) for i in range(8)]
    records = exact.make_records(spark.createDataFrame(rows, ROWS)).withColumn("id", F.col("row_idx"))
    comp = spark.createDataFrame([(i, 0) for i in range(8)], "node long, component long")
    got = {r.id: (r.reason, r.canonical) for r in retention.keep_best(records, comp, 5, ["ResNet", "VGG"]).collect()}
    assert {i for i, (r, _) in got.items() if r is None} == {0, 1, 2, 3, 4, 6} and {c for _, c in got.values()} == {0}
    assert {r for r, _ in got.values()} == {None, "lexical_near_duplicate"}


def test_coverage_goes_by_the_first_prefix(spark):
    # ResNet1 stays as the best; Res is the first match of ResX only, so no one that stays covers it
    rows = [(0, "ResNet1", "a", 0.9), (1, "ResX", "b", 0.5), (2, "ResNet2", "c", 0.1)]
    records = exact.make_records(spark.createDataFrame(rows, ROWS)).withColumn("id", F.col("row_idx"))
    comp = spark.createDataFrame([(i, 0) for i in range(3)], "node long, component long")
    kept = lambda prefixes: {r.id for r in retention.keep_best(records, comp, 1, prefixes).collect() if r.reason is None}
    assert kept(["ResNet", "Res"]) == {0, 1} and kept(["Res", "ResNet"]) == {0} and kept([]) == {0}


def test_ordered_greedy_differs_from_components(spark):
    # b is worse than a and goes first, so c, like b only, stays
    records = spark.createDataFrame([("a", 0, 0), ("b", 1, 2), ("c", 2, 3), ("d", 3, 1), ("e", 4, 1)], "id string, ord long, quality long")
    edges = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.95), ("e", "d", 1.0)], "a string, b string, similarity double")
    assert {tuple(r) for r in retention.structural_greedy(records, edges).collect()} == {("b", "a", 0.9), ("e", "d", 1.0)}


def test_greedy_by_rounds_is_the_ordered_scan(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(f"r{i}", i, rng.randrange(6)) for i in range(60)]
    pairs = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)} | {(0, i) for i in range(1, 20)} | set(itertools.combinations(range(40, 50), 2))
    gone = {}
    for i, j in sorted(pairs):
        if i not in gone and j not in gone:
            worse, better = (i, j) if rows[j][2] < rows[i][2] else (j, i)
            gone[worse] = better
    records = spark.createDataFrame(rows, "id string, ord long, quality long")
    edges = spark.createDataFrame([(f"r{max(p)}", f"r{min(p)}", 0.9) for p in pairs], "a string, b string, similarity double")
    for limit in (200_000, 0):
        monkeypatch.setattr(retention, "SCAN_PAIRS", limit)
        got = {r.id: r.canonical for r in retention.structural_greedy(records, edges).collect()}
        assert got == {f"r{a}": f"r{b}" for a, b in gone.items()}


def test_split_counts(spark):
    rows = [(f"{fam}{g}", fam, f"{fam}{g}-{i}") for fam, n in (("a", 1), ("b", 2), ("c", 3), ("d", 10)) for g in range(n) for i in range(2)]
    df = spark.createDataFrame(rows, "g string, family string, id string")
    count = lambda s: {(r.family, r.split): r.n for r in s.join(df.select("g", "family").distinct(), "g").groupBy("family", "split").agg(F.count("*").alias("n")).collect()}
    assert count(splits.grouped_split(df, "g", "family", "id")) == {
        ("a", "train"): 1, ("b", "train"): 1, ("b", "test"): 1, ("c", "train"): 2, ("c", "test"): 1, ("d", "train"): 8, ("d", "dev"): 1, ("d", "test"): 1,
    }
    assert count(splits.source_split(df, "g", "family", "id"))[("c", "train")] == 2
    mixed = spark.createDataFrame([(1, "g", "train"), (2, "g", "test"), (3, "h", "test")], "id long, g string, split string")
    assert {r.id for r in splits.enforce_disjoint(mixed, "g", "split").collect()} == {1, 3}
    assert tuple(splits.overlaps(mixed, "g", "split").first()) == (0, 1, 0) and tuple(splits.overlaps(mixed.limit(0), "g", "split").first()) == (0, 0, 0)


def test_chat_reasons(spark):
    good = "```python\nclass N(nn.Module):\n    pass\n```"
    said = lambda *m: list(zip(("system", "user", "assistant"), m))
    data = [("ok", said("s", "u", good)), ("len", said("s", "u")), ("roles", [("user", "u"), ("system", "s"), ("assistant", good)]), ("parse", said("s", "u", "```python\nx = (\n```")), ("module", said("s", "u", "x = 1")), ("null", None), ("none", said("s", "u", None))]
    df = spark.createDataFrame([(i, m, (f"/{i}.py", None, True, "vgg", 1, [], [], "full")) for i, m in data], chat.ROW)
    got = {r.id: r.drop_reason for r in chat.checked(df).collect()}
    assert got == {"ok": None, "len": "bad_schema_len", "roles": "bad_roles", "parse": "parse_fail", "module": "no_nn_module", "null": "bad_schema_len", "none": "no_nn_module"}
    assert {r.id: r.drop_reason for r in chat.checked(df, fix_fences=False).collect()}["module"] == "no_code_fence"


def test_both_stages(spark, tmp_path):
    from .test_code import MODULE

    rows = [(0, "ResNet-a", MODULE, 0.5), (1, "ResNet-b", MODULE, 0.9), (2, "VGG", "def (", None), (3, "FractalNet", "also (", 0.1), (4, "ResNet-c", MODULE.replace("16", "99").replace("Net", "Other"), 0.3)]
    out = curate.curate(spark.createDataFrame(rows, ROWS), curate.Curation(includes=["ResNet", "VGG", "FractalNet"]))
    kept = {r.id.split("_")[1]: r.reason for r in out["kept"].collect()}
    gone = {r.id.split("_")[1]: r.reason for r in out["tombstones"].collect()}
    assert set(kept) | set(gone) == {"0", "1", "2", "3", "4"} and kept["1"] == "canonical_of_exact_group" and gone["0"] == "exact_duplicate"
    assert gone["2"] == "structural_duplicate_exact" and kept["2"] in ("rescued_by_prefix", "diversity_topup")
    counts = curate.write_artifacts(out, str(tmp_path / "out"), curate.Curation(includes=["ResNet"]), [("res", 2.0)], "code", single_files=True)
    assert counts["rows"] == 5 and counts["kept"] == len(kept) and "**" in (tmp_path / "out" / "dedup_report.md").read_text()
    assert len(list((tmp_path / "out" / "code").glob("*.py"))) == len(kept)
    assert {r["id"] for r in json.loads((tmp_path / "out" / "kept_records.json").read_text())} == {r.id for r in out["kept"].collect()}
    stones = json.loads((tmp_path / "out" / "tombstones.json").read_text())
    assert {s["reason"] for s in stones.values()} <= {"exact_duplicate", "structural_duplicate_exact", "structural_duplicate_near", "lexical_near_duplicate"} and all(s["canonical_name"] is not None for s in stones.values())


def test_stage_two(spark, tmp_path):
    from .test_code import MODULE

    source = tmp_path / "src"
    source.mkdir()
    for i in range(12):
        (source / f"m{i}.py").write_text(MODULE.replace("Net", f"Net{i}"))
    (source / "bad.py").write_text("def (")
    (source / "latin.py").write_bytes(b"x = '\xff'")
    (source / "plain.py").write_text("x = 1")
    done = chatprep.run(spark, chatprep.ChatPrep(str(source), str(tmp_path / "chat"), render=True))
    assert done["dropped"] == 1 and done["counts"]["total"] == 24 and not any(done["overlap_verification"].values()) and done["config"]["seed"] == 42
    assert json.loads((tmp_path / "chat" / "manifest.json").read_text())["summary"]["total_examples"] == 24 and set(done["paths"]["rendered"]) == {"train", "dev", "test"}
    assert readers.read_sources(spark, str(tmp_path / "chat" / "train.jsonl")).count() == done["unique_sources"]["train"]
    dropped = [json.loads(line) for f in (tmp_path / "chat" / "_drop_report.jsonl").glob("part*") for line in f.read_text().splitlines()]
    assert [(r["_drop_reason"], r["messages"]) for r in dropped] == [("parse_fail", None)]
    again = sinks.written_manifest(spark, str(tmp_path / "chat"))
    assert again["summary"]["counts"] == done["manifest"]["summary"]["counts"] and again["summary"]["unique_sources"] == 12 and not any(again["summary"]["overlap"].values())


def test_drop_report_has_whole_rows(spark, tmp_path):
    files = spark.createDataFrame([("/a.py", "import torch\nclass N(torch.nn.Module):\n    def forward(self, x):\n        return x\n")], "path string, text string")
    rows, dropped = chatprep.prepared(files, chatprep.ChatPrep(fix_fences=False))
    got = dropped.collect()
    assert rows.count() == 1 and [(r._drop_reason, len(r.messages), r.meta.type) for r in got] == [("no_code_fence", 3, "infill")]


def test_both_commands_one_after_the_other(spark, tmp_path, monkeypatch):
    from corpusloom import cli

    from .test_code import MODULE

    monkeypatch.setattr(spark, "stop", lambda: None)
    rows = [(i, f"ResNet-{i}", MODULE.replace("Net", f"Net{i}") + f"\ny{i} = f{i}(g{i}())\n" * (i + 1), i / 10) for i in range(6)] + [(9, "VGG", "x = 1", 0.5)]
    spark.createDataFrame(rows, "row_idx long, name string, nn_code string, accuracy double").write.parquet(str(tmp_path / "records.parquet"))
    cli.main(["curate", str(tmp_path / "records.parquet"), "--include", "ResNet", "--out", str(tmp_path / "out"), "-v"])
    code = list((tmp_path / "out" / "accepted_code").glob("*.py"))
    assert code and "Kept by prefix" in (tmp_path / "out" / "dedup_report.md").read_text() and not (tmp_path / "out" / "sampling_weights.csv").exists()
    cli.main(["chat", str(tmp_path / "out" / "accepted_code"), "--out", str(tmp_path / "chat"), "--no-infill", "--drop-unparseable"])
    assert json.loads((tmp_path / "chat" / "manifest.json").read_text())["summary"]["total_examples"] == len(code)
    cli.main(["curate", str(tmp_path / "records.parquet"), "--include", "Nothing", "--out", str(tmp_path / "none")])
    assert "No records" in (tmp_path / "none" / "dedup_report.md").read_text()
    a = cli.parser().parse_args(["curate", "x", "--include", "A", "--include", "B"])
    assert curate.Curation(a.include, a.prefer or None).preferred == ["A", "B"]


def test_group_keys(spark):
    metas = [("/a/./b/../c.py", None), ("/a//c.py", ""), ("x/y.py", None), ("/data/x/y.py", " "), (None, None), ("p", "own//key")]
    rows = spark.createDataFrame([(f"i{n}", (p, g, True, "vgg", 1, [], [], "full")) for n, (p, g) in enumerate(metas)], f"id string, meta struct<{chat.META}>")
    got = [r[0] for r in rows.select(chat.group_key(F.col("meta"), F.col("id"))).collect()]
    assert got == ["/a/c.py", "/a/c.py", "/data/x/y.py", "/data/x/y.py", "NA::i4", "own//key"]


def test_fixed_answers(spark):
    said = [[("user", "```\nno\n```"), ("assistant", "a ```\nx\n``` ```python\ny = (\n```")], [("assistant", None)], [None], [], None]
    df = spark.createDataFrame([(str(i), m) for i, m in enumerate(said)], "id string, messages array<struct<role string, content string>>")
    got = {r.id: r.messages for r in chat.fixed_answers(df).collect()}
    assert [tuple(m) for m in got["0"]] == [("user", "```\nno\n```"), ("assistant", "```python\ny = (\n```")] and got["1"][0].content == "```python\n\n```" and got["2"] == [None] and got["3"] == [] and got["4"] is None


def test_spread_runs_nothing(spark):
    joined = spark.range(100).join(spark.range(50).repartition(3), "id")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = spread(joined)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before and out.count() == 50


def test_empty_input_of_stage_one(spark):
    out = curate.curate(spark.createDataFrame([], ROWS), curate.Curation(includes=["ResNet"]))
    assert out["kept"].count() == out["tombstones"].count() == out["splits"].count() == 0


def test_file_names_clash(spark):
    df = spark.createDataFrame([("aaaaaaaaaaaa1", "n"), ("aaaaaaaaaaaa2", "n"), ("b", None)], "id string, name string")
    assert sorted(r.file_name for r in sinks.file_names(df).collect()) == ["model__b.py", "n__aaaaaaaaaaaa.py", "n__aaaaaaaaaaaa_1.py"]


def test_workspace_keeps_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(setting)
    with Workspace(spark) as ws:
        table = ws.table(spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count())
        until = time.time() + 10
        while files() - before and time.time() < until:
            time.sleep(0.1)
        assert not files() - before and spark.conf.get(setting) == was
        assert table.count() == 97


@pytest.mark.parametrize("includes", [["ResNet"], []])
def test_stage_one_keeps_only_tables_that_are_read(spark, includes):
    code = "import torch.nn as nn\nclass A(nn.Module):\n    def __init__(self):\n        super().__init__()\n"
    rows = [(i, f"ResNet{i}", code + "".join(f"        self.l{j} = nn.Conv2d({2 ** ((i + j) % 9)}, 8, kernel_size={j % 5 + i % 3})\n" for j in range(i + 3)), 0.1 * i) for i in range(8)]
    with Workspace(spark) as ws:
        got = curate.curate(spark.createDataFrame(rows, ROWS), curate.Curation(includes=includes, topup_prefixes=includes), ws)
        left = {p.name.split("-")[1] for p in Path(ws.root.removeprefix("file:")).iterdir()}
        assert {"records", "features", "out", "tombstones"} <= left
        assert not left & {"seen", "standing", "single", "compared", "pool", "removed", "canonical", "sets", "facts", "candidates"}
        assert got["kept"].count() and got["splits"].count() == got["kept"].count()
        assert got["tombstones"].count() >= 0


def test_stage_one_writes_no_code_that_can_be_read_anew(spark, monkeypatch):
    plain, written = Workspace.table, []

    class Enough(Exception):
        pass

    def table(self, df, name="t"):
        written.append((name, "code" in df.columns))
        if name == "sets":
            raise Enough
        return plain(self, df, name)

    monkeypatch.setattr(Workspace, "table", table)
    rows = spark.createDataFrame([("A", "x = f()\n", 0.5), ("B", "x = f()\n", 0.6)], "name string, code string, accuracy double")
    # another reading could number rows anew by the second
    for row_idx, want in ((F.col("accuracy").cast("long"), []), (F.monotonically_increasing_id(), ["rows"])):
        written.clear()
        with pytest.raises(Enough):
            curate.curate(rows.withColumn("row_idx", row_idx))
        assert [n for n, code in written if code] == want and "features" in dict(written)


def test_prefixes_are_joined_slice_by_slice(spark, monkeypatch):
    rng = random.Random(5)
    bases = [[f"t{rng.randrange(300)}" for _ in range(60)] for _ in range(6)]
    data = [(i, "f", bases[i % 6][: 60 - i // 6]) for i in range(48)]
    links = lambda: sorted(tuple(r) for r in similarity.similar_classes(spark.createDataFrame(data, SETS), 0.9)[1].collect())
    want, whole, rows = links(), similarity._meeting, []

    def meeting(prefix, threshold):
        rows.append(prefix.count())
        return whole(prefix, threshold)

    monkeypatch.setattr(similarity, "_meeting", meeting)
    monkeypatch.setattr(similarity, "SLICE_ROWS", 100)
    assert links() == want and len(want) > 20
    assert 2 < len(rows) <= similarity.MOST_SLICES and max(rows) < sum(rows) / 2


def test_workspace_follows_the_session(spark, tmp_path):
    table = Workspace(spark).table(spark.range(3), "x")
    assert table.count() == 3
