"""Catalogues of logs from their JSON list, flat or by operator, and filters over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = (
    "description: string, log_id: string, key: string, url: string, submission_url: string, monitoring_url: string, mmd: long, "
    "state: map<string, struct<timestamp: string, final_tree_head: struct<tree_size: long>>>, temporal_interval: struct<start_inclusive: string, end_exclusive: string>"
)
SCHEMA = f"version string, log_list_timestamp string, operators array<struct<name: string, email: array<string>, logs: array<struct<{_LOG}>>, tiled_logs: array<struct<{_LOG}>>>>"


def _slash(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    return F.when((url == "") | F.endswith(url, F.lit("/")), url).otherwise(F.concat(url, F.lit("/")))


def read_log_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("multiLine", "true").json(path)


def flat_logs(lists: DataFrame) -> DataFrame:
    """One row a log. An id that isn't 32 bytes fails the job, as a list with such an id can't be trusted."""
    ops = lists.select(F.explode("operators").alias("o")).select(F.col("o.name").alias("operator"), F.col("o.logs").alias("logs"), F.col("o.tiled_logs").alias("tiled"))
    rows = ops.select("operator", F.lit("rfc6962").alias("protocol"), F.explode("logs").alias("l")).union(ops.select("operator", F.lit("static").alias("protocol"), F.explode("tiled").alias("l")))
    raw = F.unbase64("l.log_id")
    log_id = F.when(F.length(raw) == 32, raw).otherwise(F.raise_error(F.concat(F.lit("log_id is not 32 bytes: "), F.coalesce("l.log_id", F.lit("")))).cast("binary"))
    state = F.try_element_at(F.map_keys("l.state"), F.lit(1))
    entry = F.try_element_at(F.map_values("l.state"), F.lit(1))
    plain = F.col("protocol") == "rfc6962"
    return rows.select(
        log_id.alias("log_id"), F.col("l.description").alias("description"), "operator", "protocol", F.coalesce(state, F.lit("")).alias("state"), F.try_to_timestamp(entry["timestamp"]).alias("state_since"),
        _slash(F.when(plain, F.col("l.url")).otherwise(F.col("l.submission_url"))).alias("submission_url"), F.when(plain, F.lit("")).otherwise(_slash(F.col("l.monitoring_url"))).alias("monitoring_url"),
        F.coalesce("l.mmd", F.lit(0)).alias("mmd"), F.try_to_timestamp("l.temporal_interval.start_inclusive").alias("temporal_start"), F.try_to_timestamp("l.temporal_interval.end_exclusive").alias("temporal_end"),
        F.coalesce(entry["final_tree_head"]["tree_size"], F.lit(0)).alias("final_tree_size"),
    )


def nested_logs(logs: DataFrame) -> DataFrame:
    """(operator, logs): the flat rows by operator, times in milliseconds; an operator has few logs."""
    ms = lambda c: F.unix_millis(c).alias(c)
    row = F.struct("description", "log_id", "protocol", F.upper("state").alias("state"), ms("state_since"), "submission_url", "monitoring_url", "mmd", ms("temporal_start"), ms("temporal_end"), "final_tree_size")
    return logs.groupBy("operator").agg(F.array_sort(F.collect_list(row)).alias("logs"))


def usable(logs: DataFrame) -> DataFrame:
    return logs.where("state = 'usable'")


def select_logs(logs: DataFrame, protocols=(), operators=(), excluded=(), description: str = "") -> DataFrame:
    """Filters that apply if they are not empty; exclusion comes after inclusion."""
    if protocols:
        logs = logs.where(F.col("protocol").isin(*protocols))
    if operators:
        logs = logs.where(F.col("operator").isin(*operators))
    if excluded:
        logs = logs.where(~F.col("operator").isin(*excluded))
    return logs.where(F.contains("description", F.lit(description))) if description else logs


def with_log(rows: DataFrame, logs: DataFrame, key: str = "log_id") -> DataFrame:
    """rows with the catalogue's description, operator and protocol of their log; null where the catalogue has no such id."""
    return rows.join(logs.select(F.col("log_id").alias(key), "description", "operator", "protocol").dropDuplicates([key]), key, "left")


def cached(spark: SparkSession, path: str, max_age_seconds: float, refetch=None) -> DataFrame:
    """The snapshot if it is young enough, else what refetch gives; the old snapshot again if refetching fails."""
    import time

    def age() -> float | None:
        try:
            row = spark.read.format("binaryFile").load(path).agg(F.max("modificationTime").cast("double").alias("t")).first()
            return time.time() - row.t
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    known = age()
    if known is not None and known <= max_age_seconds or refetch is None:
        return read_log_list(spark, path)
    try:
        return refetch()
    except OSError:
        if known is None:
            raise
        return read_log_list(spark, path)
