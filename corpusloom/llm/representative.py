"""Problem 5: the best representative of each group of copies.

Method: unpivot the fields to long rows, sum source-trust times recency-decay votes per normalised value, choose
winners by max_by, and pivot back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.canonical import copies
from corpusloom.workspace import Workspace


@dataclass(frozen=True)
class Votes:
    """How much a record's word counts: trust of its source, halved every ``half_life_days`` of its age.

    A record whose code_hash is missing or out of date is trusted less. The age runs from ``fetched_at``
    (``loaded_at`` where that is null) to ``now``, a fixed moment, so that a run can be repeated.
    """

    half_life_days: float = 180.0
    now: str = "2025-01-01T00:00:00Z"
    stale_hash_trust: float = 0.5
    other_trust: float = 1.0
    record: float = 1.0


def fraction(accuracy: Column) -> Column:
    """Accuracy as a fraction to four decimals; percentages are divided, null and NaN are null."""
    known = F.when(~F.isnan(accuracy), accuracy)
    return F.round(F.when(known > 1, known / 100).otherwise(known), 4)


def _present(text: Column) -> Column:
    return F.when(F.regexp_like(text, F.lit(r"[^\s\p{Z}]")), text)


def representatives(records: DataFrame, groups: DataFrame, votes: Votes = Votes()) -> DataFrame:
    """One row per group: ``first_row_idx``, the ``survivor`` and the winning ``name``, ``accuracy`` and ``code_row_idx``.

    ``groups`` has ``(first_id, id)``. Each field of each record is a long row. Equal normalised values (name in
    lower case without separators, accuracy as a fraction, code by its hash) add up their votes before they are
    shuffled; the value with most votes wins by ``max_by``, and of equal ones that of the better record by the project's
    own order: accuracy, then code length, then name, then row_idx. Every field goes by this one key. The field ``record`` has
    one value per record and all have the same vote (``Votes.record``), since which record survives is that order's alone.
    Null, NaN and blank values have no vote; a field nobody fills is null in the result. No step gathers a group:
    all are aggregates with map-side combining, so the size of a group doesn't matter.
    """
    age = F.greatest(F.lit(0.0), (F.unix_timestamp(F.lit(votes.now).cast("timestamp")) - F.unix_timestamp(F.coalesce("fetched_at", "loaded_at"))) / 86400.0)
    stale = F.coalesce(F.lower("code_hash") != F.sha2("code", 256), F.lit(True))
    trust = F.when(stale, F.lit(votes.stale_hash_trust)).otherwise(F.lit(votes.other_trust))
    # what the votes need of a record is derived where it is read, so no code is shuffled
    r = records.select(
        "row_idx",
        _present(F.col("name")).alias("name"),
        fraction(F.col("accuracy")).alias("acc"),
        F.coalesce(F.length("code"), F.lit(0)).alias("len"),
        F.xxhash64("code").alias("code_key"),
        (trust * F.pow(F.lit(2.0), -F.coalesce(age, F.lit(3650.0)) / votes.half_life_days)).alias("vote"),
    ).join(groups.select(F.col("first_id").alias("first_row_idx"), F.col("id").alias("row_idx")), "row_idx")
    # the project's own order, the greater the better: names ascend, so their bytes are inverted, with a last sign that puts a name before its continuations
    inverted = F.concat(F.translate(F.hex(F.col("name")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    order = F.struct(F.col("acc").isNotNull().alias("known"), F.coalesce("acc", F.lit(0.0)).alias("acc"), F.col("len").alias("len"), F.coalesce(inverted, F.lit("")).alias("name"), (-F.col("row_idx")).alias("row"))
    none = F.lit(None)
    row = lambda field, value, shown, vote: F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), shown.cast("string").alias("shown"), vote.cast("double").alias("vote"))
    long = r.select(
        "first_row_idx",
        order.alias("order"),
        F.inline(
            F.array(
                row("record", F.col("row_idx"), F.col("row_idx"), F.lit(votes.record)),
                row("name", F.regexp_replace(F.lower("name"), r"[^\p{L}\p{N}]+", ""), F.trim("name"), F.col("vote")),
                row("accuracy", F.col("acc"), F.col("acc"), F.col("vote")),
                row("code", F.col("code_key"), F.col("row_idx"), F.when(F.col("len") > 0, F.col("vote"))),
            )
        ),
    ).filter("value is not null and vote is not null")
    # sums of votes are rounded, since the order in which they are added isn't fixed
    summed = long.groupBy("first_row_idx", "field", "value").agg(F.round(F.sum("vote"), 9).alias("votes"), F.max("order").alias("order"), F.max_by("shown", "order").alias("shown"))
    won = summed.groupBy("first_row_idx", "field").agg(F.max_by("shown", F.struct("votes", "order")).alias("winner"))
    wide = won.groupBy("first_row_idx").pivot("field", ["record", "name", "accuracy", "code"]).agg(F.first("winner"))
    return wide.select(
        "first_row_idx", F.col("record").cast("long").alias("survivor"), "name", F.col("accuracy").cast("double").alias("accuracy"), F.col("code").cast("long").alias("code_row_idx"), none.cast("string").alias("_")
    ).drop("_")


def _survivors(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    records = spark.read.parquet(f"{sf_dir}/records.parquet")
    ws = Workspace(spark)
    groups = ws.table(copies(records, ws=ws), "members")
    return records, representatives(records, groups)


def p5_found(spark, sf_dir: str) -> DataFrame:
    return _survivors(spark, sf_dir)[1].select("first_row_idx", F.col("survivor").alias("row_idx"))


def p5_built(spark, sf_dir: str) -> DataFrame:
    """The record built for each group: the winning name and accuracy, and the winning code's text."""
    records, built = _survivors(spark, sf_dir)
    code = records.select(F.col("row_idx").alias("code_row_idx"), "code")
    return built.join(code, "code_row_idx", "left").select("first_row_idx", "survivor", "name", "accuracy", F.sha2("code", 256).alias("code_hash"), "code")
