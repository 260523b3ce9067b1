"""Words and runs of words as array expressions inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def word_tokens(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores; null and blank texts have none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([a-z0-9_]+)"), F.lit(1))


def shingles(tokens: Column, k: int) -> Column:
    """The set of runs of k tokens; one run of all where there are fewer, none where there are none."""
    n = F.size(tokens)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, k), " "))
    return F.when(n > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def shingle_hashes(hashes: Column, k: int) -> Column:
    """The runs of :func:`shingles` as 64-bit hashes, from a column of the tokens' hashes, without building a text for each run."""
    n = F.size(hashes)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(hashes, i, k)))
    return F.when(n > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))
