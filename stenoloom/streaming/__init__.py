"""Running turn statistics over a stream of page lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoloom.functions.regex import tokens
from stenoloom.operators.turns import BOILERPLATE, noise_type


def line_statistics(lines: DataFrame, time: str = "loaded_at", late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """(start, file_idx, kind, lines, words) of a batch or a stream of lines: layout lines by kind
    and lines of speech, in windows of the time they were delivered, closed by the watermark."""
    kind = F.coalesce(noise_type(F.col("line")), F.when(F.col("line").rlike(BOILERPLATE), "boilerplate"), F.lit("speech"))
    rows = lines.where("trim(line) <> ''").withColumn("kind", kind)
    if lines.isStreaming:
        rows = rows.withWatermark(time, late)
    return rows.groupBy(F.window(time, window).alias("w"), "file_idx", "kind").agg(
        F.count("*").alias("lines"), F.sum(F.size(tokens(F.col("line")))).alias("words")).select(F.col("w.start").alias("start"), "file_idx", "kind", "lines", "words")
