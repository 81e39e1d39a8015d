"""Texts put together from parts: each distinct part is spoken once, not once in every text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stenoloom.functions.spoken import spoken_form
from stenoloom.operators.skew import lookup_join
from stenoloom.plans.durable import cut


def spoken_parts(rows: DataFrame, parts: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(part, key, written, spoken) of the keys that the columns of ``parts`` (BIGINT) hold in ``rows``."""
    def keys(part: str, make: Callable[[Column], Column]) -> DataFrame:
        found = rows.select(F.col(part).alias("key")).where("key is not null").distinct()
        return found.select(F.lit(part).alias("part"), "key", make(F.col("key")).alias("written"))

    found = reduce(DataFrame.unionByName, [keys(*p) for p in parts.items()])
    # few bytes but slow to speak: by a number of partitions of its own, else they come together in one
    spread = found.repartition(rows.sparkSession.sparkContext.defaultParallelism, "part", "key")
    return spread.select("part", "key", "written", spoken_form(F.col("written")).alias("spoken"))


def spoken_texts(rows: DataFrame, source: DataFrame, parts: dict[str, Callable[[Column], Column]], small: int = 300_000) -> DataFrame:
    """(written, spoken) of each row: its parts in order, with a space between; null where a part is null.

    It holds for parts that no rule of the spoken form reaches across, as where a part ends with
    an ordinary word.  The keys are looked for in ``source``, which holds all those of ``rows``
    and is cheaper to read.  Parts with up to ``small`` keys are broadcast, others joined by shuffle.
    """
    spoken = cut(spoken_parts(source, parts))
    sizes = {r["part"]: r["count"] for r in spoken.groupBy("part").count().collect()}
    for n, part in enumerate(parts):
        one = spoken.where(F.col("part") == part).select(
            F.col("key").alias(part), F.col("written").alias(f"_w{n}"), F.when(F.col("spoken") == "", "").otherwise(F.concat(F.lit(" "), "spoken")).alias(f"_s{n}"))
        large = sizes.get(part, 0) > small
        rows = lookup_join(cut(rows), one, part) if large else rows.join(F.broadcast(one), part, "left")
    spaced = [c for n in range(len(parts)) for c in (F.lit(" "), F.col(f"_w{n}"))][1:]
    return rows.select(F.concat(*spaced).alias("written"), F.ltrim(F.concat(*[F.col(f"_s{n}") for n in range(len(parts))])).alias("spoken"))
