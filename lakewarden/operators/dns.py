"""The typed DNS record store: one table a type, one view over all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DNS_TYPES


def unified(tables: dict[str, DataFrame]) -> DataFrame:
    """(domain, type, ttl, fetched_at, value): the records of all given types, values as text."""
    arms = []
    for kind, (_, fields) in DNS_TYPES.items():
        if kind in tables:
            value = F.concat_ws(" ", *(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields))
            arms.append(tables[kind].select("domain", F.lit(kind.upper()).alias("type"), "ttl", "fetched_at", value.alias("value")))
    return reduce(DataFrame.unionByName, arms)


def dispatch(records: DataFrame, kind: str) -> DataFrame:
    """Rows of one type's table out of records with a `type` and a `fields` map; other types are left out."""
    columns = [c.split() for c in DNS_TYPES[kind][0].split(", ")]
    return records.where(F.upper("type") == kind.upper()).select("domain", "ttl", "fetched_at", *(F.col("fields")[n].cast(t.replace("long", "bigint")).alias(n) for n, t in columns))


def write_store(records: DataFrame, path: str) -> None:
    """Every type's rows to its own table; each write scans only the partitions of its type."""
    for kind in DNS_TYPES:
        dispatch(records, kind).write.mode("append").parquet(f"{path}/dns_records_{kind}")


def accept(results: DataFrame, records: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ledger rows and records to add: only of domains that the ledger does not have."""
    from .dedup import new_in_ledger

    fresh = new_in_ledger(results, ledger)
    return fresh, records.join(fresh.select("domain"), "domain", "left_semi")


def feed(domains: DataFrame, staging: DataFrame, finished: DataFrame) -> DataFrame:
    """Domains still to fetch: those the staging ledger lacks or, if it is empty, the finished one."""
    done = staging if staging.take(1) else finished
    return domains.join(done.select("domain"), "domain", "left_anti")


def batch(domains: DataFrame, size: int) -> tuple[DataFrame, bool]:
    """The first `size` domains in order, and whether more are waiting: the cap of a session is its feature."""
    rows = domains.select("domain").distinct().orderBy("domain")
    return rows.limit(size), rows.limit(size + 1).count() > size


def run_stats(ledger: DataFrame) -> DataFrame:
    """Counts by status, and the percent of errors."""
    one = ledger.agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "nxdomain", "timeout", "error")))
    return one.withColumn("error_pct", F.when(F.col("total") > 0, F.col("error") / F.col("total") * 100).otherwise(F.lit(0.0)))
