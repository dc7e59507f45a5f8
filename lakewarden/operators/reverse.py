"""Reverse indexes: addresses to names and names to certificates, their shards, and lookups."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ipkey, names
from ..functions.certs import split_list
from ..schemas import REV_IP, SAN_INDEX
from ..session import drop_path

#: The shard of the address bases that are too small for one of their own.
TAIL = "tail"
#: Rows that a task sorts when an index is written or read, about: their number makes the tasks, not a task's memory.
TASK_ROWS = 500_000


def address_union(a: DataFrame, aaaa: DataFrame) -> DataFrame:
    """(address, domain, fetched_at) of A and AAAA records."""
    return a.select(F.col("ipv4").alias("address"), "domain", "fetched_at").unionByName(aaaa.select(F.col("ipv6").alias("address"), "domain", "fetched_at"))


def rev_ip(addresses: DataFrame, v6: bool = True) -> DataFrame:
    """(ip, domain, ver, fetched_at): each pair once, with its latest fetch."""
    return ipkey.key16(addresses, v6=v6).groupBy("ip", "domain").agg(F.max("ver").alias("ver"), F.max("fetched_at").alias("fetched_at"))


def ip_shards(index: DataFrame, width: int = 1, split_min: int = 0, least_rows: int = 0) -> tuple[DataFrame, DataFrame]:
    """The index with its shard, and the shard counts: bases of at least split_min rows go one byte finer, those below
    least_rows together into one."""
    based = index.withColumn("base", ipkey.shard_name(F.col("ip"), F.col("ver"), width))
    counts = based.groupBy("base").agg(F.count("*").alias("rows")).withColumn("split", F.col("rows") >= split_min if split_min > 0 else F.lit(False))
    # at most 2 * 256 ** width bases
    out = based.join(F.broadcast(counts.select("base", "split", "rows")), "base")
    shard = F.when(F.col("split"), ipkey.shard_name(F.col("ip"), F.col("ver"), width + 1)).when(F.col("rows") < least_rows, F.lit(TAIL)).otherwise(F.col("base"))
    return out.withColumn("shard", shard).drop("base", "split", "rows"), counts


def shards_for(cidr: str, width: int, split: set[str]) -> list[str]:
    """Shards a CIDR overlaps: split bases are replaced by their finer shards that it overlaps."""
    out = []
    bases = ipkey.shard_names_of(cidr, width)
    fine = ipkey.shard_names_of(cidr, width + 1) if split.intersection(bases) else []
    for b in bases:
        out += [f for f in fine if f.startswith(b + ("_" if b.startswith("v4") else ""))] if b in split else [b]
    return out


def _parts(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def _ends(batches):
    """(file, least, most, rows) of each file that a task reads, batch by batch; nothing is sorted."""
    found: dict = {}
    for batch in batches:
        kinds = [("key", "min"), ("key", "max"), ("key", "count")]
        for row in pa.Table.from_batches([batch]).group_by("file").aggregate(kinds).to_pylist():
            least, most, n = found.get(row["file"], (row["key_min"], row["key_max"], 0))
            found[row["file"]] = min(least, row["key_min"]), max(most, row["key_max"]), n + row["key_count"]
    if found:
        columns = zip(*((f, *e) for f, e in found.items()), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["file", "least", "most", "rows"])


def _zones(stored: DataFrame, key: str) -> DataFrame:
    """(file, shard, least, most, rows) of the files of an index. A minimum of strings would make Spark sort all rows.

    Rows name their file by a hash; files of equal hashes would share the wider zone.
    """
    path = F.col("_metadata.file_path")
    ends = stored.select(F.xxhash64(path).alias("file"), F.col(key).alias("key")).mapInArrow(_ends, f"file long, least {stored.schema[key].dataType.simpleString()}, most {stored.schema[key].dataType.simpleString()}, rows long")
    ends = ends.groupBy("file").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("rows").alias("rows"))  # a row for each part of a file
    files = stored.select(path.alias("path"), "shard").distinct()
    return files.join(ends, F.xxhash64("path") == F.col("file")).select(F.col("path").alias("file"), "shard", "least", "most", "rows")


def _written_sorted(rows: DataFrame, path: str, key: str, then: tuple[str, ...], columns: str) -> None:
    """Shard folders sorted by key, and `zones`: file, shard, and the least and greatest key of each file.

    Rows are written once as they come and sorted from there, so that what makes them runs once. Ranges are cut within
    a key too, by the columns in `then`: a key with most of the rows is spread over as many tasks and files as it fills.
    """
    spark, staged = rows.sparkSession, f"{path}/staged"
    rows.write.mode("overwrite").parquet(staged)
    found, order = spark.read.schema(rows.schema).parquet(staged), ("shard", key, *then)
    found.repartitionByRange(_parts(found.count()), *order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("shard").parquet(f"{path}/shards")
    drop_path(spark, staged)
    stored = spark.read.schema(f"{columns}, shard string").option("basePath", f"{path}/shards").parquet(f"{path}/shards")
    _zones(stored, key).coalesce(1).write.mode("overwrite").parquet(f"{path}/zones")  # a row for each file


def zone_files(spark, path: str, kind: str, meets: Column) -> list[str]:
    """Files of a written index whose least and greatest key meet a condition; they are what a lookup opens."""
    return _met_zones(spark, path, kind, meets)[0]


def _met_zones(spark, path: str, kind: str, meets: Column) -> tuple[list[str], int]:
    """Files whose zones meet a condition, and how many tasks their rows make."""
    zones = spark.read.schema(f"file string, shard string, least {kind}, most {kind}, rows long").parquet(f"{path}/zones")
    rows = zones.where(meets).select("file", "rows").collect()
    return sorted(r.file for r in rows), _parts(sum(r.rows for r in rows))


def _distinct_in_order(rows: DataFrame, parts: int | None, *order: str) -> DataFrame:
    """Distinct rows in order; with a number of parts one shuffle by ranges serves both, and no task holds more than a part."""
    return (rows if parts is None else rows.repartitionByRange(parts, *order)).distinct().orderBy(*order)


def _stored(spark, files: list[str], columns: str) -> DataFrame:
    return spark.read.schema(columns).parquet(*files) if files else spark.createDataFrame([], columns)


def write_ip_index(index: DataFrame, path: str, width: int = 1, split_min: int = 0, least_rows: int = 0) -> None:
    """Parquet partitioned by shard and sorted by address, the shard counts as its manifest, and the zones of its files.

    Bases below least_rows share the shard `tail`, so that small ones don't become a file each.
    """
    rows, counts = ip_shards(index, width, split_min, least_rows)
    _written_sorted(rows.select("ip", "domain", "ver", "fetched_at", "shard"), path, "ip", ("domain",), REV_IP)
    counts.withColumn("width", F.lit(width)).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def lookup_cidr(index: DataFrame, cidr: str, shards: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """(ip, domain) in a CIDR, in order; shards prunes partitions, parts is a number of tasks for the result."""
    rows = index if shards is None else index.where(F.col("shard").isin(shards))
    return _distinct_in_order(rows.where(ipkey.in_cidr(F.col("ip"), cidr)).select("ip", "domain"), parts, "ip", "domain")


def read_ip_index(spark, path: str) -> DataFrame:
    """All rows of a written index."""
    return spark.read.schema(f"{REV_IP}, shard string").parquet(f"{path}/shards")


def lookup_written_cidr(spark, path: str, cidr: str) -> DataFrame:
    """lookup_cidr on a written index; only files whose zones the CIDR meets are opened, no folder is listed."""
    lo, hi, _ = ipkey.cidr_bounds(cidr)
    meets = (F.col("least") <= F.lit(bytearray(hi))) & (F.col("most") >= F.lit(bytearray(lo)))
    files, parts = _met_zones(spark, path, "binary", meets)
    return lookup_cidr(_stored(spark, files, REV_IP), cidr, parts=parts)


def lookup_written_ip(spark, path: str, address: str) -> DataFrame:
    """lookup_ip on a written index; only files whose zones hold the address are opened."""
    key = F.lit(bytearray(ipkey.cidr_bounds(address)[0]))
    files, parts = _met_zones(spark, path, "binary", (F.col("least") <= key) & (F.col("most") >= key))
    return lookup_ip(_stored(spark, files, REV_IP), address, parts)


def lookup_ip(index: DataFrame, address: str, parts: int | None = None) -> DataFrame:
    """Names of one address, in order."""
    lo, _, _ = ipkey.cidr_bounds(address)
    return _distinct_in_order(index.where(F.col("ip") == F.lit(bytearray(lo))).select("domain"), parts, "domain")


def join_cidrs(index: DataFrame, cidrs: list[str]) -> DataFrame:
    """(cidr, ip, domain) for many CIDRs: keys meet CIDRs on their common prefix of whole bytes, then on the bounds.

    The list of CIDRs is a parameter of the caller and joined by its distinct prefix lengths, at most 17 of them.
    """
    spark = index.sparkSession
    rows = []
    for c in cidrs:
        lo, hi, _ = ipkey.cidr_bounds(c)
        size = next((i for i in range(16) if lo[i] != hi[i]), 16)
        rows.append((c, lo.hex().upper(), hi.hex().upper(), size, lo[:size].hex().upper()))
    ranges = spark.createDataFrame(rows, "cidr string, lo string, hi string, size int, prefix string")
    sizes = sorted({r[3] for r in rows})
    keyed = index.withColumn("size", F.explode(F.array(*map(F.lit, sizes)))).withColumn("prefix", F.expr("hex(substring(ip, 1, size))"))
    met = keyed.join(ranges, ["size", "prefix"]).where(F.hex("ip").between(F.col("lo"), F.col("hi")))
    return met.select("cidr", "ip", "domain")


def san_index(subjects: DataFrame, key: str = "id", rules: names.SuffixRules | None = None, suffix: bool = False) -> DataFrame:
    """(san_domain, reg_domain, cert_id, is_wildcard) of every name; empty ones are skipped, invalid ones stay.

    suffix adds the public suffix of reg_domain, which is looked up with it.
    """
    rows = subjects.where("san_domains is not null and san_domains <> ''").select(F.col(key).alias("cert_id"), F.explode(split_list(F.col("san_domains"))).alias("san"))
    rows = rows.withColumn("n", names.norm_fqdn(F.col("san"))).where("n.name <> ''").select("cert_id", F.col("n.name").alias("san_domain"), F.col("n.wildcard").cast("int").alias("is_wildcard"))
    rows = names.with_suffix(rows, "san_domain", rules, "suffix", "reg")
    reg = F.coalesce("reg", F.lit(names.OTHER))
    out = rows.select("san_domain", reg.alias("reg_domain"), "cert_id", "is_wildcard", names.registrable_suffix(reg, F.col("suffix")).alias("suffix"))
    return out if suffix else out.drop("suffix")


def san_classes(index: DataFrame, dedicate_min: int = 0, split_min: int = 0, rules: names.SuffixRules | None = None) -> tuple[DataFrame, DataFrame]:
    """The index with its shard, and (suffix, rows, class): bucketed, then dedicated, then tail."""
    if "suffix" not in index.columns:
        index = names.with_suffix(index, "reg_domain", rules, "suffix", "own_reg").drop("own_reg").withColumn("suffix", names.registrable_suffix(F.col("reg_domain"), F.col("suffix")))
    counts = index.groupBy("suffix").agg(F.count("*").alias("rows"))
    bucketed = F.col("suffix").isin(*names.LARGE_SUFFIXES) | ((F.col("rows") >= split_min) if split_min > 0 else F.lit(False))
    dedicated = F.lit(True) if dedicate_min == 0 else F.col("rows") >= dedicate_min
    counts = counts.withColumn("class", F.when(bucketed, "bucketed").when(dedicated, "dedicated").otherwise("tail"))
    # only classes that few suffixes have, for their rows, are sent to the rows: nothing is shuffled by suffix
    usual = "dedicated" if dedicate_min == 0 else "tail"
    out = index.join(F.broadcast(counts.where(F.col("class") != usual).select("suffix", "class")), "suffix", "left")
    s, r = F.col("suffix"), F.col("reg_domain")
    return out.withColumn("shard", _san_shard(F.coalesce("class", F.lit(usual)), s, r)).drop("class"), counts


def _san_shard(kind: Column, suffix: Column, reg: Column) -> Column:
    bucketed = names.san_shard_name(suffix, names.label_bucket(reg, suffix))
    return F.when(kind == "bucketed", bucketed).when(kind == "dedicated", names.san_shard_name(suffix, F.lit("all"))).otherwise(names.tail_shard_name(suffix))


def write_san_index(subjects: DataFrame, path: str, dedicate_min: int = 0, split_min: int = 0, key: str = "id", rules: names.SuffixRules | None = None) -> None:
    """Name index of subjects in shard folders, sorted by name, with its classes as manifest, and the zones of its files.

    Within a shard names are sorted by registrable domain, then name, so that a domain's names are neighbours.
    """
    spark, named = subjects.sparkSession, f"{path}/named"
    index = san_index(subjects, key, rules, suffix=True)
    index.write.mode("overwrite").parquet(named)  # suffixes are looked up once
    rows, counts = san_classes(spark.read.schema(index.schema).parquet(named), dedicate_min, split_min)
    _written_sorted(rows.select("san_domain", "reg_domain", "cert_id", "is_wildcard", "shard"), path, "reg_domain", ("san_domain", "cert_id"), SAN_INDEX)
    counts.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    drop_path(spark, named)


def san_shards_for(spark, path: str, name: str, rules: names.SuffixRules | None = None) -> list[str] | None:
    """The shard of a written index that holds a name and all below it: none if the index lacks the suffix, None for all.

    All shards may hold names below a name that is a public suffix itself.
    """
    own = rules or names.suffix_rules()
    reg = own.registrable(name)
    if reg is None:
        return None
    kinds = spark.read.schema("suffix string, rows long, class string").json(f"{path}/manifest").where(F.col("suffix") == own.suffix(name))
    return [r.shard for r in kinds.select(_san_shard(F.col("class"), F.lit(own.suffix(name)), F.lit(reg)).alias("shard")).limit(1).collect()]


def lookup_written_san(spark, path: str, name: str, any_depth: bool = False, rules: names.SuffixRules | None = None) -> DataFrame:
    """lookup_san on a written index: its registrable domain says by the zones which files are opened, all for a suffix."""
    reg = (rules or names.suffix_rules()).registrable(name)
    meets = F.lit(True) if reg is None else (F.col("least") <= reg) & (F.col("most") >= reg)
    files, parts = _met_zones(spark, path, "string", meets)
    return lookup_san(_stored(spark, files, SAN_INDEX), name, any_depth, parts)


def lookup_san(index: DataFrame, name: str, any_depth: bool = False, parts: int | None = None) -> DataFrame:
    """Distinct (san_domain, is_wildcard, cert_id) at a name or, if it is registrable, under it; any_depth goes under any name.

    parts is a number of tasks for the result.
    """
    at = (F.col("san_domain") == name) | (F.col("reg_domain") == name)
    if any_depth:
        at |= F.endswith("san_domain", F.lit("." + name))
    return _distinct_in_order(index.where(at).select("san_domain", "is_wildcard", "cert_id"), parts, "san_domain", "cert_id")
