"""Cursors of log runs, and the rows that monitors show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

META = ("description", "submission_url", "monitoring_url", "protocol", "operator", "state")
COUNTERS = ("next_entry_idx", "tree_size_at_start", "total_processed")


def merge_runs(runs: DataFrame, incoming: DataFrame, key: str = "log_id") -> DataFrame:
    """Runs after a refresh: metadata comes from incoming where it has any, counters from the old run; new runs start at 0."""
    meta = [c for c in META if c in runs.columns]
    counters = [c for c in COUNTERS if c in runs.columns]
    old, new = runs.alias("o"), incoming.alias("n")
    out = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    return out.select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), *(F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in meta), *(F.coalesce(f"o.{c}", F.lit(0)).cast("long").alias(c) for c in counters))


def advance(runs: DataFrame, steps: DataFrame, key: str = "log_id") -> DataFrame:
    """Runs with cursors moved by steps (key, next_entry_idx, processed, tree_size); the start size is set once."""
    out = runs.alias("r").join(steps.alias("s"), key, "left")
    start = F.when(F.coalesce("r.tree_size_at_start", F.lit(0)) == 0, F.coalesce("s.tree_size", "r.tree_size_at_start")).otherwise(F.col("r.tree_size_at_start"))
    changed = {"next_entry_idx": F.coalesce("s.next_entry_idx", "r.next_entry_idx"), "tree_size_at_start": start, "total_processed": F.coalesce("r.total_processed", F.lit(0)) + F.coalesce("s.processed", F.lit(0))}
    return out.select(*(changed[c].alias(c) if c in changed else F.col(c if c == key else f"r.{c}") for c in runs.columns))


def run_totals(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count("*").alias("runs"), F.coalesce(F.sum("total_processed"), F.lit(0)).alias("processed"), F.coalesce(F.sum("tree_size_at_start"), F.lit(0)).alias("tree_size"))


def panel(runs: DataFrame) -> DataFrame:
    """Monitor rows with their percent, unfinished first, then by operator and description."""
    from ..functions.certs import progress_percent

    percent = progress_percent(F.col("next_entry_idx"), F.col("tree_size_at_start"))
    return runs.withColumn("percent", percent).orderBy((F.col("percent") >= 100), "operator", "description")


def shard_status(metrics: DataFrame) -> DataFrame:
    """Latest metrics of each shard (shard, at, done, status); only the running shard heard last is running, others are interrupted."""
    latest = metrics.groupBy("shard").agg(F.max_by(F.struct("at", "done", "status"), F.struct("at", "done")).alias("m")).select("shard", "m.*")
    running = latest.where("status = 'running'").groupBy("at").agg(F.min("shard").alias("first")).agg(F.max_by("first", "at").alias("own_newest"))
    status = F.when((F.col("status") == "running") & (F.col("shard") != F.col("own_newest")), F.lit("interrupted")).otherwise(F.col("status"))
    return latest.join(F.broadcast(running)).withColumn("status", status).drop("own_newest")  # one row


def run_states(runs: DataFrame, sessions: DataFrame, target: int = 0, key: str = "log_id") -> DataFrame:
    """(log_id, session, cursor, tree_size, state, error) of an ingest: one of error, complete, caught_up and running.

    sessions is (log_id, processed, tree_size, error): what each log has taken in this session, its tree's size and
    what stopped it, if anything did. target is the session's cap of entries, 0 for none.
    """
    met = runs.select(key, F.col("next_entry_idx").alias("cursor")).join(sessions, key)
    done = F.lit(target > 0) & (F.col("processed") >= target)
    state = F.when(F.col("error").isNotNull(), "error").when(done, "complete").when(F.col("cursor") >= F.col("tree_size"), "caught_up").otherwise("running")
    return met.select(key, F.col("processed").alias("session"), "cursor", "tree_size", state.alias("state"), "error")


def last_metrics(lines: DataFrame) -> DataFrame:
    """(updated_at, tree, processed, coverage, db_total) of the last metrics line of an ingestion log."""
    from ..sources.logs import ingestion_metrics

    return ingestion_metrics(lines).orderBy(F.desc("updated_at"), F.desc("processed")).limit(1)
