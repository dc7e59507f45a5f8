"""Host-name export: occurrences of each name, direct and as wildcard, merged over months and cut into shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.certs import split_list
from ..session import path_exists


def occurrences(subjects: DataFrame, sans: str = "san_domains") -> DataFrame:
    """(name): every name of every non-empty list; a name repeated in a certificate comes as often."""
    return subjects.where((F.col(sans) != "") & F.col(sans).isNotNull()).select(F.explode(split_list(F.col(sans))).alias("name"))


def dual_counts(found: DataFrame) -> DataFrame:
    """(domain, direct, wildcard) of the valid names."""
    low = F.regexp_replace("name", r"^\s+|\s+$", "")
    rows = found.select(names.normalize(names.strip_wildcard(low)).alias("domain"), names.is_wildcard_name(low).alias("w"))
    return rows.where("domain <> ''").groupBy("domain").agg(F.count_if(~F.col("w")).alias("direct"), F.count_if("w").alias("wildcard"))


def merge_counts(parts: DataFrame) -> DataFrame:
    """Partial counts summed by name."""
    return parts.groupBy("domain").agg(F.sum("direct").alias("direct"), F.sum("wildcard").alias("wildcard"))


#: Buckets of a table of partial counts.
BUCKETS = 64


def save_partial(counts: DataFrame, table: str, part: str, path: str, buckets: int = BUCKETS) -> bool:
    """Add partial counts, those of a month say, to a table of buckets, unless it has the part; whether it was added.

    A part's names are shuffled here, once, and never again by a merge. Only one writer may add to a table at a time.
    """
    spark = counts.sparkSession
    if spark.catalog.tableExists(table) and spark.table(table).where(F.col("part") == part).take(1):
        return False
    rows = counts.select("domain", "direct", "wildcard", F.lit(part).alias("part")).repartition(buckets, "domain")
    rows.write.mode("append").partitionBy("part").bucketBy(buckets, "domain").sortBy("domain").option("path", path).saveAsTable(table)
    return True


def merge_partials(spark, table: str) -> DataFrame:
    """All parts of a table summed by name: a bucket's files are read by one task, without a shuffle."""
    return merge_counts(spark.table(table))


def split_counts(subjects: DataFrame) -> DataFrame:
    """(fqdn, occurrences) with every `*.` taken out, as the reporting query counts them."""
    return occurrences(subjects).where("name <> ''").groupBy(F.lower(F.replace("name", F.lit("*."), F.lit(""))).alias("fqdn")).agg(F.count("*").alias("occurrences"))


def listing_counts(subjects: DataFrame) -> DataFrame:
    """(fqdn, n) in the stricter listing form."""
    return occurrences(subjects).select(names.listing_name(F.col("name")).alias("fqdn")).where("fqdn is not null").groupBy("fqdn").agg(F.count("*").alias("n"))


def parent_counts(subjects: DataFrame) -> DataFrame:
    """(parent, n) of every name's parent domain."""
    trimmed = F.regexp_replace("name", r"^\s+|\s+$", "")
    rows = occurrences(subjects).where(trimmed != "").select(names.parent_domain(F.col("name")).alias("parent"))
    return rows.where("parent <> ''").groupBy("parent").agg(F.count("*").alias("n"))


def with_shards(counts: DataFrame, rules: names.SuffixRules | None = None) -> DataFrame:
    """counts with tld and bucket, by the public-suffix rules."""
    keyed = names.with_suffix(counts, "domain", rules, "own_suffix", "own_reg").withColumn("own_key", names.export_shard(F.col("own_reg"), F.col("own_suffix")))
    return keyed.withColumn("tld", F.col("own_key.tld")).withColumn("bucket", F.col("own_key.bucket")).drop("own_key", "own_reg", "own_suffix")


def write_export(counts: DataFrame, path: str) -> None:
    """Four outputs: tab-separated shards, names seen directly, names seen only as wildcards, and counts by rank."""
    rows = with_shards(counts)
    tsv = {"sep": "\t", "emptyValue": "", "quote": ""}
    rows.repartitionByRange("tld", "bucket", "domain").sortWithinPartitions("tld", "bucket", "domain").write.mode("overwrite").partitionBy("tld", "bucket").options(**tsv).csv(f"{path}/shards")
    rows.where("direct > 0").select("domain").orderBy("domain").write.mode("overwrite").text(f"{path}/direct")
    rows.where("direct = 0").select("domain").orderBy("domain").write.mode("overwrite").text(f"{path}/wildcard_only")
    counts.orderBy(F.desc("direct"), "domain").write.mode("overwrite").options(**tsv).csv(f"{path}/counts")


def read_shards(spark, path: str, tld: str | None = None, bucket: str | None = None) -> DataFrame:
    """(domain, direct, wildcard, tld, bucket) of written shards, of one if it is named; lines of another form are left out."""
    rows = spark.read.schema("domain string, direct long, wildcard long, tld string, bucket string").option("sep", "\t").option("quote", "").option("mode", "DROPMALFORMED").csv(f"{path}/shards")
    for column, value in (("tld", tld), ("bucket", bucket)):
        rows = rows if value is None else rows.where(F.col(column) == value)
    return rows.where("domain is not null and direct is not null and wildcard is not null")


def shard_feed(spark, path: str, tld: str | None = None, bucket: str | None = None) -> DataFrame:
    """(tld, bucket, domains) of the shards that a fetcher takes up, in a mixed but fixed order, so that no zone is asked alone."""
    shards = read_shards(spark, path, tld, bucket).groupBy("tld", "bucket").agg(F.count("*").alias("domains"))
    return shards.orderBy(F.xxhash64("tld", "bucket"))  # one row a shard


def export_months(spark, subjects: DataFrame, path: str) -> DataFrame:
    """Partial counts of months not yet exported are written, one partition a month; returns all partials merged."""
    from ..functions.certs import cert_month

    done = spark.read.parquet(f"{path}/partials").select("cert_month").distinct() if path_exists(spark, f"{path}/partials") else None
    rows = subjects.withColumn("cert_month", cert_month(F.col("not_before")))
    if done is not None:
        rows = rows.join(F.broadcast(done), "cert_month", "left_anti")  # one row a month
    low = F.regexp_replace("name", r"^\s+|\s+$", "")
    parts = rows.where("san_domains is not null and san_domains <> ''").select("cert_month", F.explode(split_list(F.col("san_domains"))).alias("name"))
    parts = parts.select("cert_month", names.normalize(names.strip_wildcard(low)).alias("domain"), names.is_wildcard_name(low).alias("w")).where("domain <> ''")
    parts = parts.groupBy("cert_month", "domain").agg(F.count_if(~F.col("w")).alias("direct"), F.count_if("w").alias("wildcard"))
    parts.write.mode("append").partitionBy("cert_month").parquet(f"{path}/partials")
    return merge_counts(spark.read.schema("domain string, direct long, wildcard long").parquet(f"{path}/partials"))
