"""Log lines of the ingest and fetch runners, and status classes of answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Forms of log lines.
INGEST_LINE = r"^\[metrics ([^\]]+)\] tree=(\d+) processed=(\d+) coverage=([\d.]+)% db_total=(.*)$"
FETCH_LINE = r"metrics: done=(\d+) rate=([\d.]+)/s ok=(\d+) nxd=(\d+) timeout=(\d+) err=(\d+)\([^)]+\) cb=(\S+)"
FEED_LINE = r"feed: \S+ → (\d+) domains queued"
RUNNER_START = r"\[\d{2}:\d{2}:\d{2}\] === (.+?) \(\s*([\d ]+)\s*domains\) ==="
RUNNER_DONE = r"\[\d{2}:\d{2}:\d{2}\] === done (\S+)"
COMPLETE_LINE = r"complete: total=(\d+)"
TIME = r"^(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"


def _part(pattern: str, k: int, kind: str = "long"):
    return F.regexp_extract("value", pattern, k).cast(kind)


def ingestion_metrics(lines: DataFrame) -> DataFrame:
    """Fields of the metrics lines of an ingestion log (value)."""
    rows = lines.where(F.col("value").rlike(INGEST_LINE))
    return rows.select(_part(INGEST_LINE, 1, "string").alias("updated_at"), _part(INGEST_LINE, 2).alias("tree"), _part(INGEST_LINE, 3).alias("processed"), _part(INGEST_LINE, 4, "double").alias("coverage"), F.trim(_part(INGEST_LINE, 5, "string")).alias("db_total"))


def fetch_metrics(lines: DataFrame) -> DataFrame:
    """(shard, at, done, rate, ok, nxdomain, timeout, error, breaker) of the metrics lines of shard logs (shard, value)."""
    names = (("done", "long"), ("rate", "double"), ("ok", "long"), ("nxdomain", "long"), ("timeout", "long"), ("error", "long"), ("breaker", "string"))
    rows = lines.where(F.col("value").rlike(FETCH_LINE))
    return rows.select("shard", F.try_to_timestamp(F.regexp_extract("value", TIME, 1), F.lit("yyyy/MM/dd HH:mm:ss")).alias("at"), *(_part(FETCH_LINE, k, t).alias(n) for k, (n, t) in enumerate(names, 1)))


def shard_log_state(lines: DataFrame) -> DataFrame:
    """(shard, status, total, done): the state that the last telling line (shard, line, value) gives, the first feed's
    total that isn't 0, and what a completed shard says it has done.
    """
    status = F.when(F.contains("value", F.lit("complete: total=")), "complete").when(F.contains("value", F.lit("finalized:")), "finalized").when(F.contains("value", F.lit("shutting down")), "interrupted")
    feed = F.when(F.col("value").rlike(FEED_LINE), _part(FEED_LINE, 1))
    complete = F.when(F.col("value").rlike(COMPLETE_LINE), _part(COMPLETE_LINE, 1))
    rows = lines.withColumn("s", status).withColumn("f", feed).withColumn("d", complete)
    first = F.min_by("f", F.when(F.col("f") > 0, F.col("line")))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line")))
    return rows.groupBy("shard").agg(F.coalesce(last("s"), F.lit("running")).alias("status"), first.alias("total"), last("d").alias("done"))


def runner_entries(lines: DataFrame) -> DataFrame:
    """(shard, first_line, total, status) of a runner log (line, value): the last start gives the total, the last line the status."""
    start, done = F.col("value").rlike(RUNNER_START), F.col("value").rlike(RUNNER_DONE)
    rows = lines.where(start | done).select(
        "line", start.alias("is_start"), F.when(start, F.trim(_part(RUNNER_START, 1, "string"))).otherwise(_part(RUNNER_DONE, 1, "string")).alias("shard"),
        F.when(start, F.regexp_replace(_part(RUNNER_START, 2, "string"), " ", "").cast("long")).alias("total"),
    )
    status = F.when(F.max_by("is_start", "line"), F.lit("running")).otherwise(F.lit("complete"))
    return rows.groupBy("shard").agg(F.min("line").alias("first_line"), F.max_by("total", F.when(F.col("is_start"), F.col("line"))).alias("total"), status.alias("status"))


def answer_class(status: int) -> str:
    """What an HTTP status means for a reader of a log."""
    if status in (403, 404):
        return "frontier"
    if status in (409, 429) or status >= 500:
        return "retry"
    return "fatal" if status >= 400 else "ok"
