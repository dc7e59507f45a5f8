"""Runs and half-open index ranges: day runs, merged coverage, gaps.

A running maximum over all ranges would be one task's work. Ranges are therefore cut into buckets of starts, each task
merges its own, and only what spans the cuts is carried: the greatest end before each bucket, one number a bucket. A
bucket is a function of the start alone, so a recomputed task finds the same one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Index positions of a bucket; after ranges of equal start are merged a bucket has at most so many rows.
BUCKET = 1 << 16


def _carried(rows: DataFrame, by: list[str], start: str, value: str) -> DataFrame:
    """rows with `before`: the greatest `value` of all earlier rows of the same group in order of `start`, null if none."""
    cut = rows.withColumn("own_bucket", F.floor(F.col(start) / BUCKET))
    here = Window.partitionBy("own_bucket", *by).orderBy(start, value).rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy("own_bucket", *by).agg(F.max(value).alias("own_max"))
    earlier = Window.partitionBy(*by).orderBy("own_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("own_carry", F.max("own_max").over(earlier)).drop("own_max")
    out = cut.join(ends, ["own_bucket", *by])
    return out.withColumn("before", F.greatest(F.max(value).over(here), "own_carry")).drop("own_carry", "own_bucket")


def merge_ranges(ranges: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, start, end) of coalesced ranges: overlapping and adjacent ones are one; empty ones vanish."""
    rows = ranges.select(*by, "start", "end").where(F.col("end") > F.col("start")).groupBy(*by, "start").agg(F.max("end").alias("end"))
    rows = _carried(rows, list(by), "start", "end")
    # a range begins an island if nothing before reaches it; its end is what is reached before the next island
    opens = rows.withColumn("opens", F.when(F.col("before").isNull() | (F.col("before") < F.col("start")), F.col("start")))
    placed = _carried(opens.select(*by, "start", "end", "opens"), list(by), "start", "opens")
    island = F.coalesce("opens", "before")
    return placed.withColumn("island", island).groupBy(*by, "island").agg(F.max("end").alias("end")).select(*by, F.col("island").alias("start"), "end")


def gaps(merged: DataFrame, tree_size: int | None = None) -> DataFrame:
    """(start, end) of what merged ranges leave open, from 0 up to the tree size, or to the frontier without one."""
    rows = _carried(merged.select("start", "end"), [], "start", "end")
    inner = rows.select(F.coalesce("before", F.lit(0)).cast("long").alias("start"), F.col("start").alias("end"))
    if tree_size is not None:
        inner = inner.select("start", F.least("end", F.lit(tree_size)).cast("long").alias("end"))
        tail = merged.agg(F.coalesce(F.max("end"), F.lit(0)).cast("long").alias("start")).withColumn("end", F.lit(tree_size).cast("long"))
        inner = inner.union(tail)
    return inner.where(F.col("end") > F.col("start"))


def coverage(merged: DataFrame, tree_size: int = 0) -> DataFrame:
    """One row: stored, frontier, contiguous prefix from 0, tree size and percent; percent is 0 without a tree size."""
    one = merged.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("stored"), F.coalesce(F.max("end"), F.lit(0)).alias("frontier"), F.coalesce(F.max(F.when(F.col("start") == 0, F.col("end"))), F.lit(0)).alias("contiguous"))
    percent = F.col("stored") / tree_size * 100 if tree_size > 0 else F.lit(0.0)
    return one.withColumn("tree_size", F.lit(tree_size).cast("long")).withColumn("percent", percent)


def day_runs(entries: DataFrame, index: str = "index", day: str = "day") -> DataFrame:
    """(first, last, day, n): contiguous indices of one day; a day that comes again later is a run of its own.

    Within a day and a bucket a run is what shares index minus rank; runs that meet at a bucket's edge are merged as
    ranges of their day. Of an index with several days the first day counts.
    """
    rank = Window.partitionBy("day", "part").orderBy("i")
    rows = entries.groupBy(F.col(index).alias("i")).agg(F.min(day).alias("day")).withColumn("part", F.floor(F.col("i") / BUCKET))
    rows = rows.withColumn("island", F.col("i") - F.row_number().over(rank))
    parts = rows.groupBy("day", "part", "island").agg(F.min("i").alias("start"), (F.max("i") + 1).alias("end"))
    return merge_ranges(parts, ("day",)).select(F.col("start").alias("first"), (F.col("end") - 1).alias("last"), "day", (F.col("end") - F.col("start")).alias("n"))
