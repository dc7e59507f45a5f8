"""Continuous ingest: captured pages stream into the deduplicated month archive.

Delivery is at least once and the sink is idempotent: a micro-batch that runs again finds its keys in the archive's
seen table. There is no watermark, for an old certificate simply lands in its old month, and no operator state, for
keys never expire; the seen table takes its place.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dedup import MonthArchive, upsert_ids
from ..operators.progress import advance
from ..schemas import ISSUERS, SUBJECTS
from ..session import drop_path
from ..sources.der import certificate
from ..sources.leaves import issuers_of, parse_leaves, subjects_of


def stream_subjects(spark: SparkSession, path: str, files_per_trigger: int = 128) -> DataFrame:
    """Subject rows from files that appear in a folder, so many a micro-batch."""
    return spark.readStream.schema(SUBJECTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def start_ingest(rows: DataFrame, archive: MonthArchive, checkpoint: str, every: str | None = None, seal: bool = False):
    """Start the stream: `every` is the rollover interval; without it everything there is now is taken, then it ends."""

    def take(batch: DataFrame, _: int) -> None:
        with persisted(batch) as batch:
            archive.flush(batch)
            if seal:
                months = [r.cert_month for r in MonthArchive.keyed(batch).select("cert_month").distinct().collect()]  # a few months
                archive.seal(months)

    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


@contextlib.contextmanager
def persisted(df: DataFrame):
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


class Versions:
    """A small table with a version for each micro-batch: a batch that runs again replaces its own, from the one before.

    The last KEEP versions stay; only the one before the running batch is ever read.
    """

    KEEP = 3

    def __init__(self, spark: SparkSession, path: str, schema, first: DataFrame | None = None):
        self.spark, self.path, self.schema, self.first = spark, path.rstrip("/"), schema, first

    def at(self, nth: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{nth}")

    def before(self, nth: int) -> DataFrame:
        """Rows before batch nth; a new checkpoint begins with the rows given first."""
        if nth:
            return self.at(nth - 1)
        return self.spark.createDataFrame([], self.schema) if self.first is None else self.first

    def put(self, nth: int, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.path}/v{nth}")
        if nth >= self.KEEP:
            drop_path(self.spark, f"{self.path}/v{nth - self.KEEP}")
        return self.at(nth)


def with_issuers(known: DataFrame, leaves: DataFrame, ders: DataFrame) -> DataFrame:
    """known issuers (ISSUERS), and those that the leaves name first in their chains, with ids that follow.

    ders is (fingerprint, der); an issuer whose certificate isn't there has empty names. Ids once given stay.
    """
    named = leaves.where("error is null").select(F.lower(F.hex(F.try_element_at("chain_fingerprints", F.lit(1)))).alias("fingerprint")).where("fingerprint is not null").distinct()
    fresh = named.join(known.select("fingerprint"), "fingerprint", "left_anti")
    found = ders.select(F.lower(F.hex("fingerprint")).alias("fingerprint"), "der").dropDuplicates(["fingerprint"])
    fresh = fresh.join(found, "fingerprint", "left").withColumn("m", certificate(F.col("der")))
    text = lambda c: F.coalesce(F.when(F.col("m.ok"), F.col(f"m.{c}")), F.lit("")).alias(c)
    return upsert_ids(known, fresh.select(F.lit(None).cast("long").alias("ca_id"), "fingerprint", text("common_name"), text("organization"), text("country")))


def numbered(pages: DataFrame, runs: DataFrame) -> DataFrame:
    """pages with the number of their log: log_no of runs, else its place among the runs' ids."""
    logs = runs.select("log_id", "log_no" if "log_no" in runs.columns else (F.row_number().over(Window.orderBy("log_id")) - 1).cast("int").alias("log_no"))
    return pages.join(F.broadcast(logs), "log_id")  # a row for each log, some hundreds


class LogSink:
    """What a micro-batch of log entries goes through: issuers, subjects, then cursors, each as a version of the batch.

    A batch that runs again starts from the versions before it, so issuers keep their ids, the archive knows the keys,
    and cursors are the same; they never run ahead of the data.
    """

    def __init__(self, archive: MonthArchive, path: str, runs: DataFrame, stored: DataFrame | None = None, sizes: DataFrame | None = None):
        spark = archive.spark
        self.archive, self.stored, self.sizes, self.first_runs = archive, stored, sizes, runs
        self.runs = Versions(spark, f"{path}/runs", runs.schema, runs)
        self.issuers = Versions(spark, f"{path}/issuers", ISSUERS)

    def take(self, leaves: DataFrame, nth: int) -> None:
        """leaves with log_id and log_no."""
        with persisted(leaves) as leaves:
            ders = issuers_of(leaves)
            if self.stored is not None:
                ders = ders.unionByName(self.stored.select("fingerprint", "der"))
            issuers = self.issuers.put(nth, with_issuers(self.issuers.before(nth), leaves, ders))
            self.archive.flush(subjects_of(leaves, issuers))
            steps = leaves.groupBy("log_id").agg((F.max("index") + 1).alias("next_entry_idx"), F.count("*").alias("processed"))
            steps = steps.withColumn("tree_size", F.lit(None).cast("long")) if self.sizes is None else steps.join(self.sizes.select("log_id", "tree_size"), "log_id", "left")
            before = self.runs.before(nth)
            steps = steps.join(before.select("log_id", F.col("next_entry_idx").alias("own_next")), "log_id")  # a late page doesn't move a cursor back
            steps = steps.withColumn("next_entry_idx", F.greatest("next_entry_idx", "own_next")).drop("own_next")
            self.runs.put(nth, advance(before, steps))


def start_logs(pages: DataFrame, archive: MonthArchive, path: str, runs: DataFrame, checkpoint: str, every: str | None = None, stored: DataFrame | None = None, sizes: DataFrame | None = None):
    """Stream captured rows (log_id, index, leaf_input, extra_data) of many logs into the archive.

    `runs` are the cursors to start from; after batch n they are version `path/runs/v<n>`, and the issuers that the
    subjects refer to `path/issuers/v<n>`. stored is (fingerprint, der) of issuers that chains only name; sizes is
    (log_id, tree_size). Rows of logs that runs lacks are left out.
    """
    sink = LogSink(archive, path, runs, stored, sizes)
    writer = pages.writeStream.foreachBatch(lambda batch, nth: sink.take(parse_leaves(numbered(batch, runs)), nth)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def rollup(events: DataFrame, time: str = "ts", window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Tumbling counts over event time, closed when the watermark passes."""
    return events.withWatermark(time, delay).groupBy(F.window(time, window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
