"""Consolidating pairwise matches into groups: deterministic Boruvka hooking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stenoloom.operators.skew import lookup_join
from stenoloom.plans.durable import cut, drop


def connected_groups(links: DataFrame, left: str, right: str, is_link=None) -> DataFrame:
    """(id, group_id): every id on either side of ``links`` with the smallest id of its group.

    Each round every component picks its smallest outgoing edge, ordered by (smaller label,
    larger label).  That order is total, so picks can form no cycle but two components
    picking the same edge; the smaller one then stays as root.  The trees collapse by pointer
    doubling, edges are relabelled and made distinct, and rounds go on until no edge is left.
    At least half of the touched components vanish each round, so there are O(log n) rounds,
    each of O(log depth) doublings.  By the order of edges a root is always the smallest label
    of its tree, so the final root is the smallest id of the group.

    ``is_link`` is a condition; rows where it is false or null link nothing but their ids
    still come out.  Null ids are skipped, an id linked with itself or with nobody is a group
    of its own, repeated and reversed links count once, an empty table gives no rows.  Other
    columns are not read.
    """
    ok = F.lit(True) if is_link is None else F.coalesce(is_link, F.lit(False))
    rows = links.select(F.col(left).alias("l"), F.col(right).alias("r"), ok.alias("ok"))
    ids = (
        rows.select(F.explode(F.array("l", "r")).alias("id"))
        .where("id is not null").distinct()
    )
    edges = cut(
        rows.where("ok and l is not null and r is not null and l <> r")
        .select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b"))
        .distinct()
    )
    #: Of every id that was ever an end of an edge: the component it is in.
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.explode(F.array(
            F.struct(F.col("a").alias("v"), F.struct("a", "b").alias("e")),
            F.struct(F.col("b").alias("v"), F.struct("a", "b").alias("e")))).alias("x"))
        picks = ends.groupBy("x.v").agg(F.min("x.e").alias("e"))
        hooks = cut(picks.select("v", F.when(F.col("e.a") == F.col("v"), F.col("e.b")).otherwise(F.col("e.a")).alias("p"), "e"))
        # two that picked the same edge: the smaller one is the root
        other = hooks.select(F.col("v").alias("p"), F.col("e").alias("pe"))
        root = (F.col("e") == F.col("pe")) & (F.col("v") < F.col("p"))
        forest = cut(lookup_join(hooks, other, "p").select("v", F.when(root, F.col("v")).otherwise(F.col("p")).alias("p")))
        drop(hooks)
        forest = _collapse(forest)
        half = cut(lookup_join(edges, forest.select(F.col("v").alias("a"), F.col("p").alias("ra")), "a").select("ra", "b"))
        relabelled = cut(
            lookup_join(half, forest.select(F.col("v").alias("b"), F.col("p").alias("rb")), "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
        drop(edges, half)
        edges = relabelled
        if labels is None:
            labels = forest.withColumnsRenamed({"v": "id", "p": "g"})
            labels._cut_path = forest._cut_path
            continue
        step = forest.select(F.col("v").alias("g"), F.col("p").alias("ng"))
        moved = cut(lookup_join(labels, step, "g").select("id", F.coalesce("ng", "g").alias("g")))
        drop(labels, forest)
        labels = moved
    if labels is None:
        return ids.select("id", F.col("id").alias("group_id"))
    return ids.join(labels, "id", "left").select("id", F.coalesce("g", "id").alias("group_id"))


def _collapse(forest: DataFrame) -> DataFrame:
    """Point every vertex straight at its root by pointer doubling; (v, p) as a written table."""
    while True:
        up = forest.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        seen = Observation()
        moved = F.sum((F.col("p") != F.col("pp")).cast("bigint")).alias("moved")
        higher = cut(lookup_join(forest, up, "p").observe(seen, moved).select("v", F.col("pp").alias("p")))
        drop(forest)
        forest = higher
        if not seen.get["moved"]:
            return forest
