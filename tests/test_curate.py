"""Stage 1 against a plain model of its rules, record by record, on a small table."""

import collections
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import names, pycode
from corpusloom.plans import curate

ROWS = "row_idx long, name string, code string, accuracy double"


def family(name, code):
    for cue, tag in names.NAME_CUES:
        if name.startswith(cue):
            return tag
    return next((tag for tag, cues in names.SOURCE_CUES if any(c in code.lower() for c in cues)), "generic")


def first_match(name, prefixes):
    return next((p for p in prefixes if names.normal_text(name).startswith(names.normal_text(p))), None)


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else float(not a and not b)


class Model:
    def __init__(self, rows, config):
        self.config = config
        self.records = {}
        for i, name, code, acc in rows:
            name = name or ""
            if code and code.strip() and (not config.includes or first_match(name, config.includes)):
                import hashlib

                digest = hashlib.sha256(code.encode()).hexdigest()
                tokens = pycode.normal_tokens(code)
                k = config.shingle
                runs = {tuple(tokens[j : j + k]) for j in range(max(len(tokens) - k + 1, 1))} if tokens else set()
                fp = pycode.fingerprint(code)
                self.records[f"{digest}_{i}"] = dict(row=i, name=name, code=code, acc=None if acc is None or math.isnan(acc) else acc, hash=digest, tag=family(name, code), runs=runs, bag=set(fp[1]) | {("=", *x) for x in fp[2]}, fp=pycode.fingerprint_hash(fp))

    def key(self, i, row=True):
        r = self.records[i]
        return (r["acc"] is None, -(r["acc"] or 0), -len(r["code"]), r["name"], *([r["row"]] if row else []))

    def run(self):
        c, recs = self.config, self.records
        gone, kept = {}, {}
        groups = collections.defaultdict(list)
        for i in recs:
            groups[recs[i]["hash"]].append(i)
        for ids in groups.values():
            rank = lambda i: next((n for n, p in enumerate(c.preferred) if names.normal_text(recs[i]["name"]).startswith(names.normal_text(p))), 999)
            best = min(ids, key=lambda i: (rank(i), self.key(i)))
            kept[best] = "canonical_of_exact_group" if len(ids) > 1 else "unique"
            gone |= {i: ("exact_duplicate", best, None) for i in ids if i != best}
        order = sorted(kept, key=lambda i: min(recs[j]["row"] for j in groups[recs[i]["hash"]]))
        near = lambda a, b: recs[a]["tag"] == recs[b]["tag"] and jaccard(recs[a]["runs"], recs[b]["runs"]) >= (c.lexical_fractal if recs[a]["tag"].startswith("fractal") else c.lexical)
        parent = {i: i for i in order}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in itertools.combinations(order, 2):
            if near(a, b):
                parent[find(b)] = find(a)
        comps = collections.defaultdict(list)
        for i in order:
            comps[find(i)].append(i)
        for ids in comps.values():
            if len(ids) > 1:
                ranked = sorted(ids, key=self.key)
                stay = set(ranked[: c.keep_per_family])
                has = {first_match(recs[i]["name"], c.includes) for i in stay}
                for p in {first_match(recs[i]["name"], c.includes) for i in ids} - has - {None}:
                    stay.add(next(i for i in ranked if first_match(recs[i]["name"], c.includes) == p))
                for i in ids:
                    if i not in stay:
                        gone[i] = ("lexical_near_duplicate", ranked[0], round(jaccard(recs[i]["runs"], recs[ranked[0]]["runs"]), 3))
                        del kept[i]
        prints = collections.defaultdict(list)
        for i in kept:
            prints[recs[i]["fp"]].append(i)
        for ids in prints.values():
            best = min(ids, key=self.key)
            for i in ids:
                if i != best:
                    gone[i] = ("structural_duplicate_exact", best, None)
                    del kept[i]
        left = [i for i in order if i in kept]
        for a, b in itertools.combinations(left, 2):
            s = jaccard(recs[a]["bag"], recs[b]["bag"]) if recs[a]["bag"] or recs[b]["bag"] else 0.0
            if a in kept and b in kept and s >= c.structural:
                worse, better = (b, a) if self.key(a, False) <= self.key(b, False) else (a, b)
                gone[worse] = ("structural_duplicate_near", better, round(s, 3))
                del kept[worse]
        alike = lambda a, b, f: jaccard(recs[a][f], recs[b][f]) if recs[a][f] and recs[b][f] else 0.0
        have = collections.Counter(first_match(recs[i]["name"], c.includes) for i in kept)
        for reason, p in [("rescued_by_prefix", p) for p in c.includes] + [("diversity_topup", p) for p in c.topups]:
            need = c.min_per_prefix - have[p] if reason == "rescued_by_prefix" else c.topup_per_prefix
            pool = [i for i in gone if first_match(recs[i]["name"], [p]) and recs[i]["hash"] not in {recs[j]["hash"] for j in kept}]
            for i in sorted(pool, key=self.key):
                if need <= 0:
                    break
                same = [j for j in kept if first_match(recs[j]["name"], [p])]
                if recs[i]["hash"] in {recs[j]["hash"] for j in kept}:
                    continue
                if reason == "rescued_by_prefix":
                    bad = any(alike(i, j, "runs") >= (c.lexical_fractal if recs[j]["tag"].startswith("fractal") else c.lexical) for j in same)
                else:
                    bad = any(alike(i, j, "runs") > c.topup_lexical or alike(i, j, "bag") > c.topup_structural for j in same)
                if not bad:
                    kept[i] = reason
                    need -= 1
        return kept, gone


def sources(rng, n):
    layers = ["nn.Conv2d(3, {}, kernel_size={})", "nn.Linear({}, {})", "nn.BatchNorm2d({})", "nn.ReLU()", "nn.MaxPool2d({})", "FractalBlock({})", "residual({}, depth={})"]
    bases = []
    for b in range(n):
        bases.append([f"        self.l{i} = " + rng.choice(layers).format(rng.randrange(1, 70), rng.randrange(1, 70)) for i in range(rng.randrange(4, 40))])
    out = []
    for _ in range(6 * n):
        body = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            at = rng.randrange(len(body))
            body[at : at + rng.randrange(2)] = [f"        self.x = nn.Linear({rng.randrange(9)}, 4)"] * rng.randrange(2)
        out.append("import torch.nn as nn\nclass Net(nn.Module):\n    def __init__(self):\n" + "\n".join(body or ["        pass"]) + "\n")
    return out


@pytest.mark.parametrize("seed, includes, k", [(1, ["ResNet", "Res", "VGG", "FractalNet"], 1), (2, [], 2), (3, ["FractalNet", "Other"], 5)])
def test_stage_one_is_the_model(spark, seed, includes, k):
    rng = random.Random(seed)
    rows = []
    for i, code in enumerate(sources(rng, 14)):
        rows.append((i, rng.choice(["ResNet-1", "resnext", "VGG16", "FractalNet-a", "fractal net b", "Other", None]), rng.choice([code] * 12 + ["def (", "# only\n", " ", None]), rng.choice([None, float("nan"), 0.5, 0.5, rng.random()])))
    rows += [(1000 + i, rng.choice(["ResNet-2", "VGG19", "FractalNet-a"]), rows[i][2], rng.random()) for i in range(20)]
    config = curate.Curation(includes=includes, prefer_order=["VGG"] if seed == 1 else None, keep_per_family=k, min_per_prefix=4, topup_per_prefix=3)
    want_kept, want_gone = Model(rows, config).run()
    out = curate.curate(spark.createDataFrame(rows, ROWS), config)
    assert {r.id: r.reason for r in out["kept"].collect()} == want_kept
    got = {r.id: (r.reason, r.canonical, r.struct_jaccard if r.reason == "structural_duplicate_near" else r.jaccard) for r in out["tombstones"].collect()}
    assert {i: v[:2] for i, v in got.items()} == {i: v[:2] for i, v in want_gone.items()}
    assert all(v[2] == pytest.approx(want_gone[i][2]) if v[2] is not None else want_gone[i][2] is None for i, v in got.items())
    assert out["tombstones"].filter(F.col("name").isNull() | F.col("canonical_name").isNull()).count() == 0
    assert len(set(v[0] for v in want_gone.values())) >= 2
