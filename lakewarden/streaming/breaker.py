"""A circuit breaker over the last results of a fetcher, as a running object and as a query over a history."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Results looked at, share of errors that opens, seconds it stays open.
SIZE, SHARE, PAUSE = 100, 0.3, 30.0
#: Positions of the order column that are numbered together.
BUCKET = 1 << 16


class Breaker:
    """Opens when more than a share of the last results are errors; places not yet filled count as successes, timeouts too."""

    def __init__(self, size: int = SIZE, share: float = SHARE, pause: float = PAUSE):
        self.size, self.share, self.pause = size, share, pause
        self.results: deque[bool] = deque(maxlen=size)
        self.until = 0.0

    def record(self, status: str, now: float) -> None:
        self.results.append(status == "error")
        if sum(self.results) > self.share * self.size:
            self.until = now + self.pause
            self.results.clear()

    def open(self, now: float) -> bool:
        return now < self.until


def error_share(history: DataFrame, by: str, order: str, status: str = "status", size: int = SIZE) -> DataFrame:
    """history with the errors among the last `size` results of a group, and whether they are over the limit.

    order is a number without ties. Results are numbered, and errors added up, by buckets of it with carried counts; the
    errors of a window are the difference of two sums, so no task holds a whole group.
    """
    bad = F.when(F.col(status) == "error", 1).otherwise(0)
    cut = history.withColumn("own_bucket", F.floor(F.col(order) / BUCKET)).withColumn("own_bad", bad)
    sizes = cut.groupBy(by, "own_bucket").agg(F.count("*").alias("n"), F.sum("own_bad").alias("b"))
    earlier = Window.partitionBy(by).orderBy("own_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    carried = sizes.select(by, "own_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("own_n"), F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("own_b"))
    here = Window.partitionBy(by, "own_bucket").orderBy(order)
    rows = cut.join(carried, [by, "own_bucket"]).withColumn("own_at", F.col("own_n") + F.row_number().over(here)).withColumn("own_sum", F.col("own_b") + F.sum("own_bad").over(here))
    before = rows.select(F.col(by), (F.col("own_at") + size).alias("own_at"), F.col("own_sum").alias("own_old"))
    errors = (F.col("own_sum") - F.coalesce("own_old", F.lit(0))).alias("errors")
    return rows.join(before, [by, "own_at"], "left").select(*history.columns, errors).withColumn("over", F.col("errors") > SHARE * size)
