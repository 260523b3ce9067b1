"""Problems 7, 8 and 9."""

import os
import random

import numpy as np
import pytest

from corpusloom.llm import language, leaks, packing
from corpusloom.operators import skew

needs_tokenizers = pytest.mark.skipif(not os.path.isdir(packing.TOKENIZERS), reason="the public tokenizers' files aren't here")


def test_hilbert_neighbours_differ_by_one_step():
    side = 8
    points = np.array([(x, y) for x in range(side) for y in range(side)])
    keys = packing.hilbert_keys(points, 3)
    assert sorted(keys.tolist()) == list(range(side * side))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def check_packing(got, sizes, capacities):
    for name, capacity in capacities:
        rows = [r for r in got if r.window_name == name]
        load = {}
        parts = {}
        for r in rows:
            load[r.container] = load.get(r.container, 0) + r.n_tokens
            parts.setdefault(r.doc_id, []).append((r.part, r.first_token, r.n_tokens))
        assert max(load.values()) <= capacity
        assert set(parts) == {d for d, n in sizes.items() if n}
        for doc, ps in parts.items():
            ps.sort()
            assert len(ps) == -(-sizes[doc] // capacity)  # split only where longer than the capacity
            assert [p[1] for p in ps] == [i * capacity for i in range(len(ps))] and sum(p[2] for p in ps) == sizes[doc]
        yield sum(load.values()) / (len(load) * capacity)


def test_containers_hold_everything(spark):
    rng = random.Random(3)
    sizes = {i: rng.choice([0, 1, 5, 17, 64, 100, 250, 1000]) for i in range(3000)}
    df = spark.createDataFrame([(i, n, rng.randrange(5)) for i, n in sizes.items()], "doc_id long, tokens long, key long")
    capacities = [("small", 100), ("large", 128)]
    filled = list(check_packing(packing.packed(df, capacities).collect(), sizes, capacities))
    assert min(filled) > 0.9
    assert packing.packed(df.limit(0), capacities).count() == 0
    with pytest.raises(ValueError):
        packing.packed(df, [("none", 0)])


@needs_tokenizers
def test_measured_sizes(spark):
    texts = ["Hello world", "", "   \n", None, "<|endoftext|>", "long " * 50_000, "Hello world"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS tokens", "2 AS key")
    got = {r.doc_id: (r.tokens, r.key) for r in packing.measured(df).collect()}
    assert set(got) == {0, 4, 5, 6} and got[0] == got[6] and got[0][0] == 2 and got[4][0] > 1
    tokenizer = packing.load_tokenizer()
    assert tokenizer.decode(tokenizer.encode_ordinary(texts[5])) == texts[5]


def edit_distance_says(item, doc):
    """Plain dynamic programme over all stretches."""
    low, m = leaks.least_words(len(item)), len(item)
    for i in range(m):
        row = [0] * (len(doc) + 1)
        for n in range(1, m - i + 1):
            new = [row[0] + 1]
            for j, w in enumerate(doc, 1):
                new.append(min(row[j - 1] + (item[i + n - 1] != w), row[j] + 1, new[j - 1] + 1))
            row = new
            if n >= low and leaks.EDIT_EVERY * min(row) <= n:
                return True
    return False


def test_passages_against_dynamic_programme():
    rng = random.Random(11)
    seen = set()
    for _ in range(300):
        item = [rng.choice("abcdefgh") + str(rng.randrange(6)) for _ in range(rng.randrange(1, 40))]
        part = item[rng.randrange(len(item)) :][: rng.randrange(1, len(item) + 1)]
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(part) + 1)
            part[at : at + rng.randrange(2)] = ["x"] * rng.randrange(2)
        doc = ["y"] * rng.randrange(3) + part + [rng.choice(item) for _ in range(rng.randrange(5))]
        want = edit_distance_says(item, doc)
        assert leaks.contains_passage(item, doc) is want, (item, doc)
        seen.add(want)
    assert seen == {True, False}


@pytest.mark.parametrize("m", [1, 2, 5, 11, 20, 39, 90])
def test_anchors_survive_any_edits_of_a_passage(m):
    rng = random.Random(m)
    g = leaks.gram(["w"] * m)
    chosen = set(leaks.choose_anchors(m, g, [rng.randrange(9) for _ in range(m - g + 1)]))
    for n in range(leaks.least_words(m), m + 1):
        for start in range(0, m + 1 - n):
            inside = sum(start <= p <= start + n - g for p in chosen)
            assert inside >= min(n - g + 1, g * (n // leaks.EDIT_EVERY) + leaks.HITS)


@pytest.mark.parametrize(
    "text, want",
    [
        ("a <b>c</b> d", "a c d"),
        ('x <a href="http://u/v?w=1" title=\'y z\' class=k disabled>t</a >', "x t"),
        ("a <img alt='" + "w " * 5000 + "'/> b", "a b"),
        ("n <m, then more > text", "n m then more text"),
        ("if a <b and c[0] > d", "if a b and c 0 d"),
        ("<br/>a<hr />b", "a b"),
        ("<" * 50_000 + "a", "a"),
        ("<a " * 20_000, "a " * 20_000),
    ],
)
def test_markup_is_no_word(text, want):
    assert leaks.plain_words(text) == want.split()


def test_leaks(spark):
    rng = random.Random(4)
    item = [f"Wort{i}é" for i in range(60)]
    noise = lambda n: [f"n{rng.randrange(500)}" for _ in range(n)]
    changed = [w if i % 12 else "other" for i, w in enumerate(item)]
    docs = [
        (1, " ".join(noise(50) + item[:30] + noise(9))),
        (2, " ".join(item[:26])),  # not half, even with one word in ten left out
        (3, "\n> ".join(f"<b>{w.upper()}</b>" for w in changed)),
        (4, " ".join(w if i % 7 else "other" for i, w in enumerate(item))),  # too many edits
        (5, " ".join(w.replace("é", "é") for w in item)),
        (6, None),
        (7, ""),
        (8, " ".join(noise(100_000) + item)),
        (9, " ".join(reversed(item))),
        (1, " ".join(noise(50) + item[:30] + noise(9))),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS term", "3 AS items", "4 AS item_id")
    items = spark.createDataFrame([(100, " ".join(item)), (101, None), (102, "..."), (103, "two words"), (100, " ".join(item))], "item_id long, text string").selectExpr("*", "1 AS doc_id")
    assert {tuple(r) for r in leaks.leaked(d, items).collect()} == {(1, 100), (3, 100), (5, 100), (8, 100)}
    assert leaks.leaked(d.limit(0), items).count() == 0 and leaks.leaked(d, items.limit(0)).count() == 0


@pytest.mark.parametrize("sent, hot", [(500_000, 200_000), (0, 0)])
def test_many_items_and_hot_terms_give_the_same(spark, monkeypatch, sent, hot):
    monkeypatch.setattr(leaks, "MOST_SENT_TERMS", sent)
    monkeypatch.setattr(skew, "HOT_ROWS", hot)
    d = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i}") for i in range(40)] + [(90, "same words here as there")] * 3, "doc_id long, text string")
    items = d.withColumnRenamed("doc_id", "item_id").unionByName(spark.createDataFrame([(3, "a7 b7 c7 d7")], "item_id long, text string"))
    assert sorted(tuple(r) for r in leaks.leaked(d, items).collect()) == sorted([(i, i) for i in range(40)] + [(90, 90), (7, 3)])


def test_found_leaks_against_the_dynamic_programme(spark):
    rng = random.Random(21)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(40))
    items = [(i, [word() for _ in range(rng.choice([3, 8, 20, 45]))]) for i in range(12)]
    docs = []
    for n in range(80):
        part = list(rng.choice(items)[1])
        part = part[rng.randrange(len(part) // 2 + 1) :][: rng.randrange(len(part) // 3, len(part)) + 1]
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(part) + 1)
            part[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
        docs.append((n, [word() for _ in range(rng.randrange(60))] + part + [word() for _ in range(rng.randrange(60))]))
    table = lambda rows, name: spark.createDataFrame([(i, " ".join(w)) for i, w in rows], f"{name} long, text string")
    want = {(d, i) for d, dw in docs for i, iw in items if edit_distance_says(iw, dw)}
    assert {tuple(r) for r in leaks.leaked(table(docs, "doc_id"), table(items, "item_id")).collect()} == want and want


def test_sentences():
    text = (
        "# Heading here\n\nThis is the first full sentence here. And a second one\nthat goes over two lines!\n"
        "```python\nx = f(a)  # no sentence\n# Dies ist ein ganzer Satz im Kommentar.\n```\nstep 3 loss 0.2 lr 1e-3\n| a | b |\n> Une phrase citée dans le texte ?\nToo short."
    )
    found = language.sentences(text)
    assert [" ".join(w) for *_, w in found] == [
        "this is the first full sentence here",
        "and a second one that goes over two lines",
        "dies ist ein ganzer satz im kommentar",
        "une phrase citee dans le texte",
    ]
    assert text[found[2][0] : found[2][1]] == "Dies ist ein ganzer Satz im Kommentar."
    assert language.sentences("") == [] and language.sentences("...") == []
    wrapped = "x = f(1)\n    # The block is dropped here since it was\n    # never used again.\n    # Another heading like line\ny = 2\n# Title\nOne two three four (or five, as before) six seven.\n"
    assert [" ".join(w) for *_, w in language.sentences(wrapped)] == ["the block is dropped here since it was never used again", "one two three four or five as before six seven"]


def test_forward_sums_all_segmentations():
    pieces = language.Pieces(["▁", "▁a", "a", "b", "ab", "ba", "▁ab"])
    rng = np.random.default_rng(0)
    probs = rng.random((len(pieces), 2))

    def slow(w, lang):
        if not w:
            return 1.0
        return sum(probs[pieces.ids[w[:n]], lang] * slow(w[n:], lang) for n in range(1, len(w) + 1) if pieces.ids.get(w[:n], -1) > 0)

    words = ["a", "ab", "abab", "babba"]
    total = language.forward(pieces.arcs(words), probs)[1]
    assert np.allclose(total, [[slow("▁" + w, lang) for lang in range(2)] for w in words])
    arcs = pieces.arcs(words)
    beta = language.backward(arcs, probs)
    assert np.allclose(beta[:, 0], total)


LANGUAGES = [("en", "eng", "English", "English"), ("de", "deu", "German", "Deutsch"), ("fr", "fra", "French", "français")]
SAID = {
    "en": ["the training of the model {} was stopped without any warning", "every run with the block {} needs about an hour", "nobody could repeat the result of {} on the small card"],
    "de": ["das training des modells {} wurde ohne jede warnung beendet", "jeder lauf mit dem block {} braucht etwa eine stunde", "niemand konnte das ergebnis von {} auf der karte wiederholen"],
    "fr": ["le modèle {} a été arrêté sans aucun avertissement", "chaque essai avec le bloc {} demande une heure environ", "personne n'a pu répéter le résultat de {} sur la carte"],
}


def test_named_language(spark):
    langs = spark.createDataFrame(LANGUAGES, "lang string, lang3 string, english_name string, own_name string")
    labels = ["en", " EN-us ", "DEU", "german", "Français", "fr_FR", "und", "", None, "english"]
    df = spark.createDataFrame([(x,) for x in labels], "lang string")
    assert [r[0] for r in df.select(language.named_language(df.lang, langs)).collect()] == ["en", "en", "de", "de", "fr", "fr", None, None, None, "en"]


@needs_tokenizers
def test_languages_of_held_out_texts(spark):
    rng = random.Random(9)
    name = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    say = lambda lang: rng.choice(SAID[lang]).format(name()).capitalize() + "."
    rows, truth = [], {}
    for i in range(240):
        lang = rng.choice(list(SAID))
        label = lang if i % 8 else rng.choice([*SAID, "und", None])  # some labels are wrong
        text = " ".join(say(lang) for _ in range(4))
        truth[i] = {lang}
        if i % 10 == 0:
            other = rng.choice(list(SAID))
            text += "\n```\n# " + say(other) + "\n```"
            truth[i].add(other)
        rows.append((i, text.upper() if i % 9 == 0 else text, label))
    rows += [(900, None, "en"), (901, "", None), (902, "x = f(1)\nimport os", "en"), (903, say("de") * 3000, None), (None, say("fr"), None)]
    truth[903] = {"de"}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS named", "2 AS id", "3 AS label")
    langs = spark.createDataFrame(LANGUAGES, "lang string, lang3 string, english_name string, own_name string")
    got = {}
    found = language.segments(docs, langs).collect()
    assert all(0 < r.confidence <= 1 and r.start < r.stop for r in found)
    for r in found:
        if r.confidence >= language.LEAST_CONFIDENCE:
            got.setdefault(r.doc_id, set()).add(r.lang)
    assert got == truth
    assert language.segments(docs.limit(0), langs).count() == 0
    whole = {r.doc_id: r for r in language.document_languages(docs, langs).collect()}
    assert set(whole) == {r[0] for r in rows if r[0] is not None}
    assert sum(whole[i].lang in truth[i] for i in truth) == len(truth) and whole[903].confidence > 0.99 and whole[903].sentences == 1
    assert all((whole[i].lang, whole[i].confidence, whole[i].sentences) == (None, 0.0, 0) for i in (900, 901))
    assert whole[902].lang is not None and 0 < whole[902].confidence < 1 and whole[902].sentences == 0


@needs_tokenizers
def test_unsure_sentences_are_kept_apart(spark, monkeypatch):
    """A sentence that two languages could say has a row with its confidence, and lowers no other's."""
    langs = spark.createDataFrame(LANGUAGES, "lang string, lang3 string, english_name string, own_name string")
    say = lambda lang, n: SAID[lang][n % 3].format("x" * 90).capitalize() + "."
    rows = [(i, " ".join(say(lang, i + n) for n in range(3)), lang) for i, lang in enumerate(["en", "de", "fr"] * 10)]
    rows.append((99, say("en", 0) + " Zo ru ti mo ka. " + say("en", 1), "en"))
    got = [r for r in language.segments(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langs).collect() if r.doc_id == 99]
    sure = [r for r in got if r.confidence >= language.LEAST_CONFIDENCE]
    assert {r.lang for r in sure} == {"en"} and sum(r.stop - r.start for r in got) >= len(rows[-1][1]) - 4
