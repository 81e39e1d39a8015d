"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, share: int = 200, small: int = 200_000, how: str = "left") -> DataFrame:
    """Join ``facts`` with ``dim`` (at most one row per ``key``), however skewed ``facts`` is.

    A key is heavy when it owns more than 1/``share`` of the rows of ``facts``; by counting
    there are fewer than ``share`` heavy keys, so their ``dim`` rows are broadcast with that
    proven bound.  Every other key is light and meets its row in an ordinary shuffle join.
    Below ``small`` rows one task can take all rows of a key, and the count is spared.
    Null keys match nothing (kept by a left join, dropped by an inner one).

    The two branches are a union, so ``facts`` should be cheap to read twice
    (a checkpoint or a table).
    """
    total = facts.count()
    heavy = []
    if total > small:
        counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
        heavy = [r[0] for r in counts.where(F.col("_n") * share > total).select(key).take(share)]
    if not heavy:
        return facts.join(dim, key, how)
    is_heavy = F.col(key).isin(heavy)
    few = F.broadcast(dim.where(is_heavy))
    light = facts.where(F.coalesce(~is_heavy, F.lit(True))).join(dim.where(~is_heavy), key, how)
    return facts.where(is_heavy).join(few, key, how).unionByName(light)
