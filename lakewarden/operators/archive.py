"""The raw archive and its upkeep: single entries, summaries, resolving and mirroring certificates, pools, imports."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.certs import coverage_percent, entry_day
from ..schemas import SUBJECTS
from . import chains
from .dedup import MonthArchive, remap


def write_entries(entries: DataFrame, path: str, hour: bool = False) -> None:
    """Append records partitioned by log and UTC day, or hour, in order of index so that its bounds prune files."""
    rows = entries.withColumn("day", F.regexp_replace(entry_day(F.col("timestamp_ms"), hour), "/", "T"))
    by = [c for c in ("log", "day") if c in rows.columns]
    rows.repartitionByRange(*by, "index").sortWithinPartitions(*by, "index").write.mode("append").partitionBy(*by).parquet(path)


def find_entry(entries: DataFrame, index: int) -> DataFrame:
    """The archived record of one index; the condition reaches the file bounds."""
    return entries.where(F.col("index") == index).limit(1)


def summary(entries: DataFrame) -> DataFrame:
    """One row: entries, bytes of their leaves, first and last index."""
    return entries.agg(F.count("*").alias("entries"), F.coalesce(F.sum(F.length("leaf_input")), F.lit(0)).alias("bytes"), F.min("index").alias("first"), F.max("index").alias("last"))


def stored_bytes(files: DataFrame) -> DataFrame:
    """One row: number and total size of listed files (path, length)."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def check(runs: DataFrame, files: DataFrame) -> DataFrame:
    """Tree size, processed entries, percent and stored bytes of an ingest."""
    totals = runs.agg(F.coalesce(F.sum("tree_size_at_start"), F.lit(0)).alias("tree_size"), F.coalesce(F.sum("total_processed"), F.lit(0)).alias("processed"))
    return totals.join(stored_bytes(files)).withColumn("percent", coverage_percent(F.col("processed"), F.col("tree_size")))  # two single rows


def with_subjects(entries: DataFrame) -> DataFrame:
    """Records with the metadata of their certificate as struct `subject`; a record stays if its certificate can't be read."""
    from ..sources.der import certificate
    from ..sources.leaves import leaf_input

    def run(frames):
        for f in frames:
            certs = []
            for leaf, pre in zip(f["leaf_input"], f["precertificate"], strict=True):
                try:
                    certs.append(bytes(pre) if pre is not None else leaf_input(bytes(leaf))["certificate"])
                except (ValueError, TypeError):
                    certs.append(None)
            yield f.assign(certificate=certs)

    schema = ", ".join(f"{n} {t}" for n, t in entries.dtypes) + ", certificate binary"
    return entries.mapInPandas(run, schema).withColumn("subject", certificate(F.col("certificate")))


#: Fixed value: rows of an error sample.
ERROR_SAMPLE = 10


def fetch_errors(fetched: DataFrame) -> DataFrame:
    """(fingerprint, reason): a sample of fetched certificates that are missing or not true to their address."""
    true = F.col("fingerprint") == F.unhex(F.sha2("der", 256))
    reason = F.when(F.col("der").isNull(), "nothing fetched").otherwise("hash differs from address")
    return fetched.where(~F.coalesce(true, F.lit(False))).select("fingerprint", reason.alias("reason")).orderBy("fingerprint").limit(ERROR_SAMPLE)


def resolve_issuers(entries: DataFrame, stored: DataFrame, fetched: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Counts of referenced, present and missing issuers, and the fetched ones to append: missing, and true to their address.

    Without fetched certificates it is a dry run.
    """
    wanted = chains.referenced(entries)
    counts = chains.present_missing(wanted, stored)
    return counts, None if fetched is None else chains.put_if_absent(stored, fetched.join(wanted, "fingerprint", "left_semi"))


def mirror_roots(stored: DataFrame, offered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Root certificates to append, and counts of offered, present and new ones."""
    fresh = chains.put_if_absent(stored, offered)
    total = offered.dropDuplicates(["fingerprint"])
    counts = total.agg(F.count("*").alias("total")).join(total.join(stored, "fingerprint", "left_semi").agg(F.count("*").alias("present"))).join(fresh.agg(F.count("*").alias("stored")))
    return fresh, counts


def drain_pools(archive: MonthArchive, pools: list[DataFrame], seal: bool = False) -> None:
    """Flush leftover pools in order and, if asked, seal the months they touched."""
    months: set[str] = set()
    for pool in pools:
        archive.flush(pool)
        if seal:
            months |= {r.cert_month for r in MonthArchive.keyed(pool).select("cert_month").distinct().collect()}
    if months:
        archive.seal(sorted(months))


def repartition(rows: DataFrame, mapping: DataFrame, archive: MonthArchive) -> int:
    """Write rows of several sources (source, ...) to the month archive under global issuer ids; the count that no mapping has."""
    kept, skipped = remap(rows, mapping, ["source"], "ca_id", "global_id")
    archive.flush(kept.drop("source"))
    return skipped.first().skipped


def import_sqlite(spark: SparkSession, path: str, rows_at_a_time: int = 20_000) -> DataFrame:
    """Subjects of archived SQLite files `subjects.db` below a folder, a task a file; null texts count as empty.

    The files travel to the tasks as bytes, for only Spark reads the store they are in.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "subjects.db").load(path)
    columns = [c.split()[0] for c in SUBJECTS.split(", ")]
    texts = [c.split()[0] for c in SUBJECTS.split(", ") if c.endswith(" string")]

    def run(frames):
        import sqlite3

        for f in frames:
            for content in f["content"]:
                db = sqlite3.connect(":memory:")
                db.deserialize(bytes(content))
                there = {r[1] for r in db.execute("PRAGMA table_info(subjects)")}
                cursor = db.execute(f"SELECT {', '.join(c if c in there else f'NULL AS {c}' for c in columns)} FROM subjects ORDER BY id")
                while batch := cursor.fetchmany(rows_at_a_time):
                    out = pd.DataFrame(batch, columns=columns)
                    out[texts] = out[texts].where(out[texts].notna(), "")
                    yield out
                db.close()

    return files.select("content").mapInPandas(run, SUBJECTS)


def months_between(first: str, last: str) -> list[str]:
    """Month partitions of an inclusive range of `YYYY-MM`, for a condition that prunes partitions."""
    for m in (first, last):
        if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", m):
            raise ValueError(f"not a month: {m}")
    (y, m), (last_y, last_m) = (map(int, x.split("-")) for x in (first, last))
    out = []
    while (y, m) <= (last_y, last_m):
        out.append(f"{y:04}-{m:02}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out
