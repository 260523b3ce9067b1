"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more member rows than this is hot. Of N rows at most N / HOT_ROWS keys can be hot.
HOT_ROWS = 200_000
#: Hot keys are broadcast up to this number; beyond it they go through the salted join.
MAX_BROADCAST_KEYS = 50_000
SALTS = 64


def attach(members: DataFrame, groups: DataFrame, keys: list[str], count: str, hot_rows: int | None = None) -> DataFrame:
    """Inner join of many ``members`` with ``groups``, which has one row, or a few, for each key.

    ``groups[count]`` is the number of member rows of each key (an upper bound will do). Keys up to ``hot_rows``
    rows are joined by an ordinary shuffle, so no task gets more than that many rows of one key. Hot keys, at
    most N / hot_rows of them, are counted first and broadcast, or salted where there are too many. Null keys
    never match. Callers pass written tables: both are read more than once.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    hot = groups.filter(F.col(count) > hot_rows)
    n_hot = hot.count()
    if not n_hot:
        return members.join(groups, keys)
    cold_groups = groups.filter(F.col(count) <= hot_rows)
    if n_hot <= MAX_BROADCAST_KEYS:
        # rows of hot keys never reach the shuffle of the others
        cold = members.join(F.broadcast(hot.select(*keys).distinct()), keys, "left_anti").join(cold_groups, keys)
        return cold.unionByName(members.join(F.broadcast(hot), keys))
    salted = members.withColumn("_salt", F.pmod(F.xxhash64(*members.columns), F.lit(SALTS)).cast("int"))
    spread = hot.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    by = [*keys, "_salt"]
    cold = salted.join(spread.select(*by).distinct(), by, "left_anti").drop("_salt").join(cold_groups, keys)
    return cold.unionByName(salted.join(spread, by).drop("_salt"))


def any_hot(groups: DataFrame, count: str, hot_rows: int | None = None) -> bool:
    """Whether some key can have more than ``hot_rows`` member rows."""
    most = groups.agg(F.max(count)).first()[0]
    return (most or 0) > (HOT_ROWS if hot_rows is None else hot_rows)
