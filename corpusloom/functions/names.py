"""Names, prefixes, families and ranks as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cues in lower-case source text that decide a record's family, the first that is there.
SOURCE_CUES = (
    ("fractal", ("fractalblock", "fractalunit", "fractal_fn")),
    ("transformer", ("transformerencoderlayer", "multiheadattention")),
    ("mobile", ("depthwise", "mobilenet")),
    ("resnet", ("resnet", "residual")),
    ("densenet", ("densenet", "dense")),
    ("vgg", ("vgg",)),
)
# Beginnings of names that decide it before the text does, letter case included.
NAME_CUES = (
    ("Fractal", "fractal"),
    ("ResNet", "resnet"),
    ("VGG", "vgg"),
    ("DenseNet", "densenet"),
    ("MobileNet", "mobile"),
    ("Transformer", "transformer"),
    ("BERT", "transformer"),
    ("GPT", "transformer"),
    ("RAG", "generic"),
    ("Rag", "generic"),
    ("rag", "generic"),
)
NAME_COLUMNS = ("nn", "nn_name", "model", "model_name", "name", "file", "filename")
UNRANKED = 100


def normal_text(value: str | None) -> str:
    return "".join(ch for ch in (value or "").lower() if ch in "abcdefghijklmnopqrstuvwxyz0123456789")


def normalize_key(c: Column) -> Column:
    """Lower case, ASCII letters and digits only; null gives an empty key."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def has_prefix(name: Column, prefixes: list[str]) -> Column:
    key = normalize_key(name)
    return reduce(lambda a, b: a | b, [key.startswith(normal_text(p)) for p in prefixes], F.lit(False))


def matched_prefix(name: Column, prefixes: list[str]) -> Column:
    """The first prefix of the list that the normalized name begins with, or null."""
    key = normalize_key(name)
    return F.coalesce(*[F.when(key.startswith(normal_text(p)), F.lit(p)) for p in prefixes], F.lit(None).cast("string"))


def prefix_rank(name: Column, order: list[str]) -> Column:
    """The place of the matched prefix among those that normalize alike; far behind all where none matches."""
    key = normalize_key(name)
    normal = [normal_text(p) for p in order]
    return F.coalesce(*[F.when(key.startswith(n), F.lit(normal.index(n))) for n in normal], F.lit(len(order) + UNRANKED))


def known_accuracy(accuracy: Column) -> Column:
    """NaN is as unknown as null."""
    return F.when(~F.isnan(accuracy), accuracy)


def quality_order(name: str = "name", code: str = "code", accuracy: str = "accuracy") -> list[Column]:
    """Best first: highest accuracy (unknown last), longest code, name."""
    return [F.desc_nulls_last(known_accuracy(F.col(accuracy))), F.desc(F.length(F.coalesce(F.col(code), F.lit("")))), F.asc(F.coalesce(F.col(name), F.lit("")))]


def family_of_source(code: Column) -> Column:
    low = F.lower(code)
    found = [F.when(reduce(lambda a, b: a | b, [low.contains(cue) for cue in cues]), F.lit(tag)) for tag, cues in SOURCE_CUES]
    return F.coalesce(*found, F.lit("generic"))


def family_of_model(name: Column, code: Column) -> Column:
    return F.coalesce(*[F.when(name.startswith(cue), F.lit(tag)) for cue, tag in NAME_CUES], family_of_source(code))


def resolved_path(c: Column, base: str = "/data") -> Column:
    """A path in one spelling: no white space or ``file://`` around it, slashes for backslashes, absolute (relative
    ones are under ``base``), with ``.``, ``..``, repeated and trailing slashes resolved. Null and blank are null."""
    blank = r"^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$"
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, blank, ""), r"(?i)^file://", ""), blank, "")
    slashed = F.translate(bare, "\\", "/")
    whole = F.when(slashed.startswith("/"), slashed).otherwise(F.concat(F.lit(base + "/"), slashed))
    kept = F.aggregate(
        F.split(whole, "/"),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x.isin("", "."), acc).when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))),
    )
    return F.when(slashed != "", F.concat(F.lit("/"), F.array_join(kept, "/")))


def safe_filename(name: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(name, F.lit("model")), r"^\s+|\s+$", "")
    kept = F.regexp_replace(F.regexp_replace(bare, " ", "_"), "[^a-zA-Z0-9._-]+", "")
    return F.when(kept == "", "model").otherwise(kept)


def sampling_weight(name: Column, rules: list[tuple[str, float]]) -> Column:
    """The factor of the first rule whose raw prefix begins the name in any case, or 1."""
    low = F.lower(F.coalesce(name, F.lit("")))
    return F.coalesce(*[F.when(low.startswith(p.lower()), F.lit(float(f))) for p, f in rules], F.lit(1.0))


def pick_name_column(columns: list[str]) -> str | None:
    return next((c for c in NAME_COLUMNS if c in columns), None)


def parse_upweights(specs: list[str]) -> list[tuple[str, float]]:
    """``PREFIX:FACTOR`` rules, in which the factor is a plain decimal above 0 and the prefix has no colon; others are ignored."""
    rules = []
    for spec in specs:
        prefix, _, factor = spec.partition(":")
        factor = factor.strip()
        whole, _, rest = factor.rpartition(".")
        plain = rest.isascii() and rest.isdigit() and (not whole or (whole.isascii() and whole.isdigit()))
        if prefix and plain and float(factor) > 0:
            rules.append((prefix.strip(), float(factor)))
    return rules
