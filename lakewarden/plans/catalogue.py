"""The reporting queries over subjects and issuers. Every limited listing has a total order, so ties don't matter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import export


def counts(subjects: DataFrame, issuers: DataFrame) -> DataFrame:
    one = subjects.agg(F.count("*").alias("total_subjects"))
    return one.join(issuers.agg(F.count("*").alias("total_issuers")))  # two single rows


def _said(c: str):
    return F.coalesce(F.sum(F.when(F.col(c) != "", 1).otherwise(0)), F.lit(0))


def health(subjects: DataFrame) -> DataFrame:
    return subjects.agg(
        F.count("*").alias("total"), _said("organization").alias("has_org"), _said("country").alias("has_country"), _said("san_domains").alias("has_sans"), _said("san_ips").alias("has_ip_sans"),
        F.sum("is_wildcard").cast("long").alias("wildcard_certs"), F.avg("san_count").alias("avg_san_count"), F.max("san_count").alias("max_san_count"), F.count_if(F.col("entry_type") == "precert").alias("precerts"),
    )


def with_issuer(subjects: DataFrame, issuers: DataFrame, how: str = "inner") -> DataFrame:
    """Subjects with their issuer's names. Spark broadcasts the dimension while its size allows that."""
    dim = issuers.select("ca_id", F.col("common_name").alias("issuer"), F.col("organization").alias("issuer_org"), F.col("country").alias("issuer_country"))
    return subjects.join(dim, "ca_id", how)


def listing(subjects: DataFrame, issuers: DataFrame) -> DataFrame:
    return with_issuer(subjects, issuers).select("id", "common_name", "not_before", "not_after", "san_count", "is_wildcard", "country", "issuer", "issuer_org")


def top_issuers(subjects: DataFrame, issuers: DataFrame, n: int = 20) -> DataFrame:
    """Issuers by certificates: counted by id first, so the join meets one row an issuer."""
    per = subjects.groupBy("ca_id").agg(F.count("*").alias("cert_count"))
    return per.join(issuers, "ca_id").select("ca_id", "common_name", "organization", "country", "cert_count").orderBy(F.desc("cert_count"), "ca_id").limit(n)


def wildcards(subjects: DataFrame, n: int = 20) -> DataFrame:
    return subjects.where("is_wildcard = 1").select("id", "common_name", "san_domains", "not_after").orderBy(F.desc("not_after"), "id").limit(n)


def with_ips(subjects: DataFrame) -> DataFrame:
    return subjects.where("san_ips <> '' and san_ips is not null").select("id", "common_name", "san_ips", "san_domains")


def expiring(subjects: DataFrame, today: str, days: int = 30, n: int = 50) -> DataFrame:
    """Text comparison with two dates: a time on the last day sorts behind that day and is out."""
    last = F.date_format(F.date_add(F.to_date(F.lit(today)), days), "yyyy-MM-dd")
    return subjects.where((F.col("not_after") >= today) & (F.col("not_after") <= last)).select("id", "common_name", "not_after", "url").orderBy("not_after", "id").limit(n)


def many_names(subjects: DataFrame, more_than: int = 100) -> DataFrame:
    return subjects.where(F.col("san_count") > more_than).select("id", "common_name", "san_count", "url")


def by_entry_type(subjects: DataFrame) -> DataFrame:
    return subjects.groupBy("entry_type").agg(F.count("*").alias("n"))


def by_country(subjects: DataFrame, label: str = "(none)") -> DataFrame:
    """Grouped by the raw value, so null and empty text stay two rows of one label."""
    return subjects.groupBy("country").agg(F.count("*").alias("n")).select(F.coalesce(F.nullif(F.col("country"), F.lit("")), F.lit(label)).alias("country"), "n")


def by_organization(subjects: DataFrame, n: int = 30) -> DataFrame:
    rows = subjects.where("organization <> ''").groupBy("organization", "country").agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "organization", F.asc_nulls_first("country")).limit(n)


def per_tile(subjects: DataFrame) -> DataFrame:
    return subjects.where("tile_idx is not null").groupBy("tile_idx").agg(F.count("*").alias("entries"))


def top_names(subjects: DataFrame, n: int = 100) -> DataFrame:
    return export.split_counts(subjects).orderBy(F.desc("occurrences"), "fqdn").limit(n)


def per_issuer_between(subjects: DataFrame, issuers: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """Certificates by issuer over some months; on a month-partitioned table the condition prunes partitions."""
    from ..functions.certs import cert_month

    month = F.col("cert_month") if "cert_month" in subjects.columns else cert_month(F.col("not_before"))
    per = subjects.where(month.between(first_month, last_month)).groupBy("ca_id").agg(F.count("*").alias("n"))
    return per.join(issuers.select("ca_id", F.col("common_name").alias("issuer")), "ca_id").select("ca_id", "issuer", "n")


def top_parents(subjects: DataFrame, n: int = 20) -> DataFrame:
    return export.parent_counts(subjects).orderBy(F.desc("n"), "parent").limit(n)
