"""Problem 9: the languages of documents and of their sentences.

Method: segmentation-marginalised unigrams. Each language has a probability for every piece of a fixed public
vocabulary, and a forward algorithm sums over all segmentations of a word to score it.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.markup import TAG
from corpusloom.workspace import ship

#: Where the public tokenizers' files lie.
TOKENIZERS = os.environ.get("CORPUSLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "piece_bpe_32k.model"
#: The models are fitted on about so many documents of each label, drawn by a hash of their ids.
SAMPLE_DOCS = 250
ROUNDS, EM_STEPS = 3, 3
#: Share of the probability that every language gives to the pieces of all languages together.
BACKGROUND = 0.02
#: A sentence has at least so many words. A label is called missing or wrong if a sentence's language has at least so much of the posterior.
LEAST_WORDS = 5
LEAST_CONFIDENCE = 0.95
#: Longer runs of letters are read in parts of so many, all of which count.
PART_LETTERS = 40
_UNKNOWN = 1e-9
_CACHE_WORDS = 400_000

_MARK = re.compile(r"[̀-ͯ]")
_LETTERS = re.compile(r"[^\W\d_]+")
_END = re.compile(r"""[.?!…]+["'»”’*_)\]]*(?=\s|$)""")
_LEAD = re.compile(r"""^[\s>]*(?:(?:\#+|//+|[-*+•]|\d+[.)])\s+)?(?:[rRbBfFuU]?(?:\"\"\"|'''))?\s*""")
_QUOTES = re.compile(r"\"\"\"|'''")
_CODE_LINE = re.compile(r"^(?:```|\||import \w|from \S+ import\b|return\b|def \w|class \w+.*:\s*$|pip install|--\w|\[\d+/\d+\]|step \d+ loss|\w*(?:error|exception)\b\s*:|super\(|@\w|[A-Za-z]+_\w+\.\w+$)", re.I)
_SYMBOLS = re.compile(r"[=(){}\[\]|<>;\\^~]")
_ASIDE = re.compile(r"(?:(?<=\s)|^)\([^\W\d_][^()=\[\]{}]*\)")
_JOINED = re.compile(r"\w_\w")
_HASHES = re.compile(r"\s*(#*)")


def _lines(text: str) -> Iterator[tuple[int, str]]:
    """The lines of prose with their offsets, and an empty line for whatever separates stretches of it.

    Comment signs, quotation signs, bullets and quotes around a line don't matter. Lines of code, log lines, tables
    and fences hold no prose, nor do headings marked as such. A line that begins with # is a heading if it ends no
    sentence and neither of its neighbours begins alike: those are comments over several lines.
    """
    rows, at = [], 0
    for raw in re.split(r"(\r\n|\n|\r)", text):
        if raw not in ("\r\n", "\n", "\r"):
            rows.append((at, raw))
        at += len(raw)
    hashes = [0, *(len(_HASHES.match(line).group(1)) for _, line in rows), 0]
    for n, (start, line) in enumerate(rows, 1):
        if not line.strip():
            yield start, ""
            continue
        stripped = _QUOTES.sub("   ", line)
        lead = _LEAD.match(stripped).end()
        body = stripped[lead:].rstrip()
        heading = hashes[n] and hashes[n] not in (hashes[n - 1], hashes[n + 1]) and not _END.search(body)
        symbols, words = len(_SYMBOLS.findall(body)), body.count(" ") + 1
        if "(" in body:
            symbols -= 2 * len(_ASIDE.findall(body))
        if "_" in body:
            symbols += len(_JOINED.findall(body))
        if heading or _CODE_LINE.match(body) or symbols * 5 > words:
            yield start, ""
        else:
            yield start + lead, body


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """``(start, end, words)`` for the full sentences of a text: what runs to a full stop, question mark or
    exclamation mark over one or more lines of prose and has at least LEAST_WORDS words."""
    if "<" in text:
        text = TAG.sub(lambda m: " " * len(m.group()), text)
    if "**" in text:
        text = text.replace("**", "  ")
    out = []
    parts: list[str] = []
    begin = 0
    for at, line in [*_lines(text), (len(text), "")]:
        if not line:
            parts = []
            continue
        pos = 0
        for m in _END.finditer(line):
            piece = line[pos : m.end()]
            whole = " ".join([*parts, piece])
            start = begin if parts else at + pos
            found = folded_words(whole)
            if len(found) >= LEAST_WORDS:
                out.append((start, at + m.end(), found))
            parts = []
            pos = m.end()
        rest = line[pos:].strip()
        if rest:
            if not parts:
                begin = at + pos
            parts.append(rest)
    return out


def parts_of(word: str) -> list[str]:
    return [word] if len(word) <= PART_LETTERS else [word[k : k + PART_LETTERS] for k in range(0, len(word), PART_LETTERS)]


def folded_words(text: str) -> list[str]:
    """The words of a text (runs of letters) without case and accents."""
    if not text.isascii():
        text = _MARK.sub("", unicodedata.normalize("NFKD", text))
    return _LETTERS.findall(text.casefold())


class Pieces:
    """A fixed vocabulary, folded like the words, and all segmentations of words into its pieces."""

    def __init__(self, pieces: list[str]):
        folded = {}
        for p in pieces:
            q = _MARK.sub("", unicodedata.normalize("NFKD", p)).casefold()
            if q and not (q.startswith("<") and q.endswith(">")):
                folded.setdefault(q, len(folded) + 1)
        self.size = len(folded) + 1  # 0 is a letter outside the vocabulary
        # what only begins a piece has no number, so a search knows where to stop
        self.ids = {q[:n]: -1 for q in folded for n in range(1, len(q))} | folded

    def __len__(self) -> int:
        return self.size

    def arcs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(word, start, end, piece)`` of every piece that fits somewhere, ordered by end, and the words' lengths."""
        rows: list[int] = []
        get = self.ids.get
        for n, w in enumerate(words):
            w = "▁" + w
            size = len(w)
            for i in range(size):
                for j in range(i + 1, size + 1):
                    p = get(w[i:j])
                    if p is None:
                        if j == i + 1:
                            rows += (n, i, j, 0)
                        break
                    if p > 0:
                        rows += (n, i, j, p)
                    elif j == i + 1:
                        rows += (n, i, j, 0)
        table = np.array(rows, np.int64).reshape(-1, 4)
        table = table[np.lexsort((table[:, 0], table[:, 2]))]
        return table[:, 0], table[:, 1], table[:, 2], table[:, 3], np.array([len(w) + 1 for w in words])


def forward(arcs, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums over all segmentations: ``alpha[word, place, language]`` and each word's total.

    ``probs`` is pieces x languages. Words are short, so plain probabilities don't underflow.
    """
    word, start, end, piece, length = arcs
    n, most = len(length), int(length.max(initial=0))
    alpha = np.zeros((n, most + 1, probs.shape[1]))
    alpha[:, 0] = 1.0
    bounds = np.searchsorted(end, np.arange(1, most + 2))
    for j in range(1, most + 1):
        a, b = bounds[j - 1], bounds[j]
        if a < b:
            w = word[a:b]
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            alpha[w[first], j] = np.add.reduceat(alpha[w, start[a:b]] * probs[piece[a:b]], first)
    return alpha, alpha[np.arange(n), length]


def backward(arcs, probs: np.ndarray) -> np.ndarray:
    word, start, end, piece, length = arcs
    n, most = len(length), int(length.max(initial=0))
    beta = np.zeros((n, most + 1, probs.shape[1]))
    beta[np.arange(n), length] = 1.0
    order = np.lexsort((word, -start))
    word, start, end, piece = word[order], start[order], end[order], piece[order]
    bounds = np.searchsorted(-start, np.arange(-most, 2))
    for k in range(most + 1):
        a, b = bounds[k], bounds[k + 1]
        if a < b:
            w = word[a:b]
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            beta[w[first], start[a]] = np.add.reduceat(beta[w, end[a:b]] * probs[piece[a:b]], first)
    return beta


def fit(pieces: Pieces, counts: np.ndarray, words: list[str], probs: np.ndarray | None = None) -> np.ndarray:
    """Piece probabilities (pieces x languages) by expectation maximisation on word counts (words x languages)."""
    arcs = pieces.arcs(words)
    word, start, end, piece, _ = arcs
    if probs is None:
        probs = np.zeros((len(pieces), counts.shape[1]))
        np.add.at(probs, piece, counts[word] + 1e-3)
        probs /= probs.sum(0)
    for _ in range(EM_STEPS):
        alpha, total = forward(arcs, probs)
        beta = backward(arcs, probs)
        expected = alpha[word, start] * probs[piece] * beta[word, end] * (counts / np.maximum(total, 1e-300))[word]
        new = np.zeros_like(probs)
        for lang in range(probs.shape[1]):
            new[:, lang] = np.bincount(piece, weights=expected[:, lang], minlength=len(pieces))
        new /= np.maximum(new.sum(0), 1e-300)
        shared = new.mean(1, keepdims=True)
        probs = (1 - BACKGROUND) * new + BACKGROUND * shared + _UNKNOWN
        probs[0] = _UNKNOWN
    return probs


class Scorer:
    """Scores of words in all languages, remembered while there is room; forgetting changes no result."""

    def __init__(self, pieces: Pieces, probs: np.ndarray):
        self.pieces, self.probs = pieces, probs
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, self.probs.shape[1]))

    def _learn(self, words: list[str]) -> None:
        # a run of letters of any length is scored in parts, so the tables stay small
        cut = [parts_of(w) for w in words]
        logs = np.log(np.maximum(forward(self.pieces.arcs([c for cs in cut for c in cs]), self.probs)[1], 1e-300))
        scores = np.add.reduceat(logs, np.cumsum([0, *map(len, cut)])[:-1])
        n = len(self.place)
        while len(self.table) < n + len(words):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[n : n + len(words)] = scores
        self.place.update(zip(words, range(n, n + len(words))))

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.place) > _CACHE_WORDS:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        for i in range(0, len(new), 20_000):
            self._learn(new[i : i + 20_000])
        return self.table[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]

    def posteriors(self, found: list[list[str]], mean: bool = False) -> np.ndarray:
        """Sentences x languages; an empty sentence is undecided. With ``mean``, of an average word instead of all together."""
        n_lang = self.probs.shape[1]
        logs = np.zeros((len(found), n_lang))
        full = [i for i, ws in enumerate(found) if ws]
        if full:
            flat = self([w for i in full for w in found[i]])
            starts = np.cumsum([0, *(len(found[i]) for i in full)])[:-1]
            logs[full] = np.add.reduceat(flat, starts)
            if mean:
                logs[full] /= np.array([[len(found[i])] for i in full])
        p = np.exp(logs - logs.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def load_pieces(folder: str = TOKENIZERS) -> list[str]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, VOCABULARY))
    return [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]


def named_language(label: Column, languages: DataFrame) -> Column:
    """The code that a label names by any column of ``languages`` (a handful of rows), or null."""
    bare = lambda c: F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    names = [(r.lang, str(v).strip().lower()) for r in languages.collect() for v in r if v is not None]
    whole, short = bare(label), bare(F.regexp_extract(label, r"^([^-_]*)", 1))
    known = F.create_map(*[F.lit(x) for code, name in dict.fromkeys((c, n) for c, n in names) for x in (name, code)]) if names else F.lit(None).cast("map<string,string>")
    return F.coalesce(known[whole], known[short])


def train(documents: DataFrame, label: Column, codes: list[str], folder: str = TOKENIZERS, sample_docs: int = SAMPLE_DOCS) -> tuple[Pieces, np.ndarray]:
    """Fits the languages' models on about ``sample_docs`` labelled documents of each (all where there are fewer).

    Labels are wrong in part, so after the first fit each sentence of the sample counts for the language that the
    models themselves find, and they are fitted again. The vocabulary is public and fixed; it isn't trained.
    """
    rows = documents.select(F.col("doc_id").alias("id"), label.alias("label"), "text").filter("label is not null and text is not null")
    shares = {r["label"]: sample_docs / r["count"] for r in rows.groupBy("label").count().collect()}  # no more than there are languages
    share = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])[F.col("label")] if shares else F.lit(0.0)
    drawn = rows.filter((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0) < share).select("label", "text").collect()
    pieces = Pieces(load_pieces(folder))
    found = [(codes.index(r.label), [p for w in s for p in parts_of(w)]) for r in sorted(drawn, key=lambda r: (r.label, r.text)) for *_, s in sentences(r.text)]
    words = sorted({w for _, ws in found for w in ws})
    number = {w: n for n, w in enumerate(words)}

    def tally(of: list[int]) -> np.ndarray:
        counts = np.zeros((len(words), len(codes)))
        for lang, (_, ws) in zip(of, found):
            for w, n in Counter(ws).items():
                counts[number[w], lang] += n
        return counts

    if not words:
        return pieces, np.full((len(pieces), len(codes)), 1.0 / len(pieces))
    of = [lang for lang, _ in found]
    probs = None
    for _ in range(ROUNDS):
        probs = fit(pieces, tally(of), words)
        best = Scorer(pieces, probs).posteriors([ws for _, ws in found]).argmax(1).tolist()
        if best == of:
            break
        of = best
    return pieces, probs


def _models(documents: DataFrame, languages: DataFrame, folder: str, sample_docs: int):
    """The languages' codes, the column of what a label names, and a broadcast of the fitted models (one row for each piece of the vocabulary)."""
    ship(documents.sparkSession)
    codes = sorted(r.lang for r in languages.select("lang").dropna().distinct().collect())
    label = named_language(F.col("lang"), languages)
    return codes, label, documents.sparkSession.sparkContext.broadcast(train(documents, label, codes, folder, sample_docs))


def segments(documents: DataFrame, languages: DataFrame, folder: str = TOKENIZERS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``(doc_id, named, start, stop, lang, confidence)``: each run of sentences in one language, with its offsets.

    ``named`` is the code that the document's label names. The confidence of a run is the lowest posterior of its
    sentences; sentences under LEAST_CONFIDENCE are in runs of their own, so none is left out and none lowers another. Whole
    texts are read. Documents without a full sentence, with a null or empty text or a null id give no row here
    (see :func:`document_languages`); repeated rows repeat their result.
    """
    codes, label, sent = _models(documents, languages, folder, sample_docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*sent.value)
        for batch in batches:
            ids, names, texts = (batch.column(c).to_pylist() for c in range(3))
            for at in range(0, len(ids), 500):
                found = [(n, s) for n in range(at, min(at + 500, len(ids))) for s in sentences(texts[n])]
                post = score.posteriors([s[2] for _, s in found])
                best, sure = post.argmax(1), post.max(1)
                runs: list[list] = []
                for (n, (a, b, _)), lang, p in zip(found, best.tolist(), sure.tolist()):
                    kind = (n, lang, p >= LEAST_CONFIDENCE)
                    if runs and runs[-1][0] == kind:
                        runs[-1][2], runs[-1][3] = b, min(runs[-1][3], p)
                    else:
                        runs.append([kind, a, b, p])
                cols = list(zip(*runs)) if runs else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[n] for n, *_ in cols[0]], pa.int64()),
                        pa.array([names[n] for n, *_ in cols[0]], pa.string()),
                        pa.array(cols[1], pa.int32()),
                        pa.array(cols[2], pa.int32()),
                        pa.array([codes[k] for _, k, _ in cols[0]], pa.string()),
                        pa.array(cols[3], pa.float64()),
                    ],
                    names=["doc_id", "named", "start", "stop", "lang", "confidence"],
                )

    rows = documents.select(F.col("doc_id").cast("long"), label.alias("named"), "text").filter("doc_id is not null and text is not null")
    return rows.mapInArrow(find, "doc_id long, named string, start int, stop int, lang string, confidence double")


def document_languages(documents: DataFrame, languages: DataFrame, folder: str = TOKENIZERS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``(doc_id, named, lang, confidence, sentences)``: one row for each document that has an id.

    The language is that of most characters in full sentences, each weighted by its posterior, and the confidence is its
    share of all of them. A document without a full sentence is judged by all its words, headings and code included, with the
    posterior of an average word as a low confidence; one without any word has a null language and confidence 0.
    """
    codes, label, sent = _models(documents, languages, folder, sample_docs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*sent.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            langs, sure, counts = [], [], []
            for at in range(0, len(texts), 500):
                part = [t or "" for t in texts[at : at + 500]]
                found = [sentences(t) for t in part]
                post = score.posteriors([s[2] for ss in found for s in ss])
                bare = [i for i, ss in enumerate(found) if not ss]
                whole = [folded_words(part[i]) for i in bare]
                rough = dict(zip(bare, zip(map(bool, whole), score.posteriors(whole, mean=True))))
                n = 0
                for i, ss in enumerate(found):
                    own, n = post[n : n + len(ss)], n + len(ss)
                    if ss:
                        chars = np.array([b - a for a, b, _ in ss], float)
                        weight = np.zeros(len(codes))
                        np.add.at(weight, own.argmax(1), chars * own.max(1))
                        has, p = True, weight / chars.sum()
                    else:
                        has, p = rough[i]
                    langs.append(codes[int(p.argmax())] if has and codes else None)
                    sure.append(float(p.max()) if has and codes else 0.0)
                    counts.append(len(ss))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(sure, pa.float64()), pa.array(counts, pa.int32())], names=["doc_id", "named", "lang", "confidence", "sentences"])

    rows = documents.select(F.col("doc_id").cast("long"), label.alias("named"), "text").filter("doc_id is not null")
    return rows.mapInArrow(judge, "doc_id long, named string, lang string, confidence double, sentences int")


def _tables(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/languages.parquet")


def p9_found(spark, sf_dir: str) -> DataFrame:
    found = segments(*_tables(spark, sf_dir)).filter(F.col("confidence") >= LEAST_CONFIDENCE)
    return found.filter(~F.col("lang").eqNullSafe(F.col("named"))).select("doc_id", "lang").distinct()


def p9_segments(spark, sf_dir: str) -> DataFrame:
    return segments(*_tables(spark, sf_dir))


def p9_documents(spark, sf_dir: str) -> DataFrame:
    return document_languages(*_tables(spark, sf_dir))
