"""Global ranks and running totals that never bring a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stenoloom.plans.durable import cut


def with_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with the 1-based row number over all rows by ``order``.

    Rows are range-partitioned and sorted; each gets its place in its partition, and the
    partitions' sizes (as many rows as partitions, whatever the data) give what lies before.
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part, at = F.shiftrightunsigned("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return placed.withColumn("_p", part).join(F.broadcast(before), "_p").withColumn(name, (F.col("_b") + at + 1).cast("bigint")).drop("_id", "_p", "_b")


def running_total(df: DataFrame, group: str, page: str, line: str, value: Column, name: str, block: int = 256) -> DataFrame:
    """``df`` with the total of ``value`` from the start of its group up to each row, in order of
    (page, line).

    Totals are taken over lines of a page, pages of a block and blocks of a group, each level
    being as many times smaller than the one below; so a group that holds a third of all rows
    is not sorted in one task.
    """
    rows = df.withColumn("_v", value.cast("bigint")).withColumn("_block", F.floor(F.col(page) / block))
    own = F.sum("_v").over(W.partitionBy(group, page).orderBy(line).rowsBetween(W.unboundedPreceding, 0))
    upto = lambda keys, by: F.coalesce(F.sum("_s").over(W.partitionBy(*keys).orderBy(by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    pages = rows.groupBy(group, "_block", page).agg(F.sum("_v").alias("_s"))
    blocks = pages.groupBy(group, "_block").agg(F.sum("_s").alias("_s"))
    blocks = blocks.select(group, "_block", upto([group], "_block").alias("_bb"))
    pages = pages.select(group, "_block", page, upto([group, "_block"], page).alias("_pb")).join(blocks, [group, "_block"])
    out = rows.withColumn("_own", own).join(pages.select(group, page, (F.col("_pb") + F.col("_bb")).alias("_before")), [group, page])
    return out.withColumn(name, F.col("_own") + F.col("_before")).drop("_v", "_block", "_own", "_before")


#: Operators after which the rows are in partitions of a shuffle and no more in splits of a scan.
_SHUFFLES = ("Aggregate", "Join", "Window", "Exchange", "Sort", "Coalesce")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for passes that cost much more
    than reading; a scan of many splits is left as it is, without a shuffle.

    Only the plan is looked at, no job is run: what comes out of a shuffle, whose partitions are
    not known before it ran, is shuffled again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().sparkPlan()
    if not any(word in line.split("(")[0].split("[")[0] for line in plan.toString().split("\n") for word in _SHUFFLES):
        leaves = plan.collectLeaves()
        if sum(leaves.apply(k).execute().getNumPartitions() for k in range(leaves.size())) >= cores:
            return df
    return df.repartition(cores)
