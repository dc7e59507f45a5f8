"""Queries over the driver's tables that stand in for certificate data, each with DuckDB SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import certs, ipkey, names, ranges
from ..operators import archive, chains, dedup, dns, enrich, export, intervals, progress, reverse
from ..schemas import SUBJECTS
from ..session import file_version, scratch_folder
from ..streaming import breaker
from . import catalogue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stand-in columns: name, expression of Spark, of DuckDB where it differs.
SUBJECT_COLUMNS = (
    ("id", "o_orderkey", None),
    ("ca_id", "o_custkey", None),
    ("common_name", "concat('cn', o_orderkey % 997, '.example.com')", None),
    ("organization", "CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN NULL ELSE concat('Org', o_custkey % 17) END", None),
    ("country", "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN '' ELSE concat('C', o_custkey % 9) END", None),
    ("not_before", "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')"),
    ("not_after", "date_format(o_orderdate + INTERVAL 90 DAYS, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", "strftime(o_orderdate + INTERVAL 90 DAY, '%Y-%m-%dT%H:%M:%SZ')"),
    ("san_domains", "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE concat('www.h', o_custkey % 50, '.example.com,*.H', o_orderkey % 30, '.Example.net, api.h', o_custkey % 20, '.co.uk.,bad name,*.h', o_custkey % 50, '.example.com') END", None),
    ("san_ips", "CASE WHEN o_orderkey % 7 = 0 THEN concat('10.', o_orderkey % 256, '.', o_custkey % 256, '.1') ELSE '' END", None),
    ("url", "concat('https://cn', o_orderkey % 997, '.example.com')", None),
    ("is_wildcard", "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS INT)", None),
    ("san_count", "CAST(coalesce(n, 0) AS INT)", None),
    ("entry_type", "CASE WHEN o_orderstatus = 'P' THEN 'precert' ELSE 'x509' END", None),
    ("tile_idx", "CAST(floor(o_orderkey / 256) AS BIGINT)", None),
    ("entry_idx", "o_orderkey % 256", None),
    ("cert_key", "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('k', o_orderkey % 5000) END", None),
)
WITH_SUBJECTS = f"""subjects AS (SELECT {", ".join(f"{d or s} AS {c}" for c, s, d in SUBJECT_COLUMNS)}
 FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey),
issuers AS (SELECT c_custkey AS ca_id, c_name AS common_name, c_mktsegment AS organization, n_name AS country FROM customer JOIN nation ON n_nationkey = c_nationkey),
sans AS (SELECT id, ca_id, not_before, unnest(string_split(san_domains, ',')) AS san FROM subjects WHERE san_domains <> ''),
dual AS (SELECT regexp_replace(trim(san), '^\\*\\.', '') AS d, starts_with(trim(san), '*.') AS w, not_before FROM sans),
valid AS (SELECT lower(d) AS domain, w, not_before FROM dual WHERE regexp_matches(lower(d), '^[a-z0-9_-][a-z0-9_.-]*$') AND contains(d, '.') AND NOT ends_with(d, '.')),
counts AS (SELECT domain, count(*) FILTER (NOT w) AS direct, count(*) FILTER (w) AS wildcard FROM valid GROUP BY 1),
fq AS (SELECT id, regexp_replace(lower(trim(san)), '\\.$', '') AS n FROM sans),
san_index AS (SELECT regexp_replace(n, '^\\*\\.', '') AS san_domain, id AS cert_id, CAST(starts_with(n, '*.') AS INT) AS is_wildcard FROM fq),
san_reg AS (SELECT *, CASE WHEN NOT contains(san_domain, '.') THEN '_other' WHEN ends_with(san_domain, '.co.uk') THEN concat_ws('.', string_split(san_domain, '.')[-3], 'co.uk')
 ELSE concat_ws('.', string_split(san_domain, '.')[-2], string_split(san_domain, '.')[-1]) END AS reg_domain FROM san_index)"""
WITH_ADDRESSES = """addresses AS (SELECT concat(user_id % 223 + 1, '.', user_id % 7, '.', event_id % 4, '.', user_id % 256) AS address, concat(event_type, user_id % 40, '.example.com') AS domain, CAST(floor(epoch(ts)) AS BIGINT) AS fetched_at, event_id FROM events),
octets AS (SELECT *, string_split(address, '.') AS o FROM addresses),
keyed AS (SELECT concat('00000000000000000000FFFF', upper(printf('%02x%02x%02x%02x', CAST(o[1] AS INT), CAST(o[2] AS INT), CAST(o[3] AS INT), CAST(o[4] AS INT)))) AS ip, domain, fetched_at, o FROM octets),
rev AS (SELECT ip, domain, CAST(4 AS INT) AS ver, max(fetched_at) AS fetched_at, any_value(o) AS o FROM keyed GROUP BY ip, domain)"""


def subjects(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = table(spark, sf_dir, "orders")
    return orders.join(n, orders.o_orderkey == n.l_orderkey, "left").selectExpr(*(f"{s} AS {c}" for c, s, _ in SUBJECT_COLUMNS))


def issuers(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.selectExpr("c_custkey AS ca_id", "c_name AS common_name", "c_mktsegment AS organization", "n_name AS country")


def addresses(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("concat(user_id % 223 + 1, '.', user_id % 7, '.', event_id % 4, '.', user_id % 256) AS address", "concat(event_type, user_id % 40, '.example.com') AS domain", "unix_timestamp(ts) AS fetched_at", "event_id")


def rev(spark, sf_dir) -> DataFrame:
    return reverse.rev_ip(addresses(spark, sf_dir), v6=False)


def log_ranges(spark, sf_dir) -> DataFrame:
    """Index ranges of stored entries: events that are not errors."""
    return table(spark, sf_dir, "events").where("event_type <> 'error' and event_id % 17 <> 3").selectExpr("event_id AS start", "event_id + 1 AS end")


WITH_RANGES = """ranges AS (SELECT event_id AS s, event_id + 1 AS e FROM events WHERE event_type <> 'error' AND event_id % 17 <> 3),
marked AS (SELECT s, e, CASE WHEN s <= max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM ranges),
grouped AS (SELECT s, e, sum(f) OVER (ORDER BY s, e) AS g FROM marked),
islands AS (SELECT min(s) AS "start", max(e) AS "end" FROM grouped GROUP BY g)"""


#: Rows from which on a shard of the address index is split, and below which a base shares the common shard.
IP_SPLIT, IP_LEAST = 1_000_000, 5_000
#: Rows from which on a suffix has a shard of its own in the name index, and from which on that is cut by first letters.
SAN_DEDICATE, SAN_SPLIT = 5_000, 100_000
#: The tables that each index is made of.
INDEXED = {"ip": ("events",), "san": ("orders", "lineitem")}
_written: dict[tuple[str, ...], str] = {}


def write_index(spark, sf_dir, kind: str) -> str:
    """Write an index of the tables in sf_dir; its path."""
    path = scratch_folder(spark, f"index-{kind}")
    if kind == "ip":
        reverse.write_ip_index(rev(spark, sf_dir), path, 1, IP_SPLIT, IP_LEAST)
    else:
        reverse.write_san_index(subjects(spark, sf_dir), path, SAN_DEDICATE, SAN_SPLIT)
    return path


def written(spark, sf_dir, kind: str) -> str:
    """Path of the index of the files as they are now: written when a session first asks for it, again if they change."""
    versions = (file_version(spark, f"{sf_dir}/{t}.parquet") for t in INDEXED[kind])
    key = (spark.sparkContext.applicationId, sf_dir, kind, *versions)
    if key not in _written:
        _written[key] = write_index(spark, sf_dir, kind)
    return _written[key]


def hexed(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.hex(c) for c in columns})


# catalogue
@query(f"WITH {WITH_SUBJECTS} SELECT (SELECT count(*) FROM subjects) AS total_subjects, (SELECT count(*) FROM issuers) AS total_issuers")
def agg01_counts(spark, sf_dir):
    return catalogue.counts(subjects(spark, sf_dir), issuers(spark, sf_dir))


@query(f"""WITH {WITH_SUBJECTS} SELECT count(*) AS total, CAST(sum(CASE WHEN organization <> '' THEN 1 ELSE 0 END) AS BIGINT) AS has_org, CAST(sum(CASE WHEN country <> '' THEN 1 ELSE 0 END) AS BIGINT) AS has_country,
CAST(sum(CASE WHEN san_domains <> '' THEN 1 ELSE 0 END) AS BIGINT) AS has_sans, CAST(sum(CASE WHEN san_ips <> '' THEN 1 ELSE 0 END) AS BIGINT) AS has_ip_sans, CAST(sum(is_wildcard) AS BIGINT) AS wildcard_certs,
avg(san_count) AS avg_san_count, max(san_count) AS max_san_count, count(*) FILTER (entry_type = 'precert') AS precerts FROM subjects""")
def agg02_health(spark, sf_dir):
    return catalogue.health(subjects(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT s.id, s.common_name, s.not_before, s.not_after, s.san_count, s.is_wildcard, s.country, i.common_name AS issuer, i.organization AS issuer_org FROM subjects s JOIN issuers i USING (ca_id)")
def jn01_subject_issuer(spark, sf_dir):
    return catalogue.listing(subjects(spark, sf_dir), issuers(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT ca_id, i.common_name, i.organization, i.country, count(*) AS cert_count FROM subjects s JOIN issuers i USING (ca_id) GROUP BY ALL ORDER BY cert_count DESC, ca_id LIMIT 20")
def agg03_top_ca(spark, sf_dir):
    return catalogue.top_issuers(subjects(spark, sf_dir), issuers(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT id, common_name, san_domains, not_after FROM subjects WHERE is_wildcard = 1 ORDER BY not_after DESC, id LIMIT 20")
def flt06_wildcard(spark, sf_dir):
    return catalogue.wildcards(subjects(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT id, common_name, san_ips, san_domains FROM subjects WHERE san_ips <> '' AND san_ips IS NOT NULL")
def flt06_ip_sans(spark, sf_dir):
    return catalogue.with_ips(subjects(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT id, common_name, not_after, url FROM subjects WHERE not_after BETWEEN '1997-03-01' AND '1997-03-31' ORDER BY not_after, id LIMIT 50")
def flt07_expiring(spark, sf_dir):
    return catalogue.expiring(subjects(spark, sf_dir), "1997-03-01")


@query(f"WITH {WITH_SUBJECTS} SELECT id, common_name, san_count, url FROM subjects WHERE san_count > 5")
def flt06_many_names(spark, sf_dir):
    return catalogue.many_names(subjects(spark, sf_dir), 5)


@query(f"WITH {WITH_SUBJECTS} SELECT entry_type, count(*) AS n FROM subjects GROUP BY 1")
def agg04_entry_type(spark, sf_dir):
    return catalogue.by_entry_type(subjects(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS}, g AS (SELECT country AS c, count(*) AS n FROM subjects GROUP BY 1) SELECT coalesce(nullif(c, ''), '(none)') AS country, n FROM g")
def agg05_country(spark, sf_dir):
    return catalogue.by_country(subjects(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT organization, country, count(*) AS n FROM subjects WHERE organization <> '' GROUP BY 1, 2 ORDER BY n DESC, organization, country NULLS FIRST LIMIT 30")
def agg06_org(spark, sf_dir):
    return catalogue.by_organization(subjects(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT tile_idx, count(*) AS entries FROM subjects WHERE tile_idx IS NOT NULL GROUP BY 1")
def agg07_tile(spark, sf_dir):
    return catalogue.per_tile(subjects(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT lower(replace(san, '*.', '')) AS fqdn, count(*) AS occurrences FROM sans WHERE san <> '' GROUP BY 1 ORDER BY occurrences DESC, fqdn LIMIT 100")
def agg08_fqdn_split(spark, sf_dir):
    return catalogue.top_names(subjects(spark, sf_dir))


@query(f"WITH {WITH_SUBJECTS} SELECT * FROM counts")
def agg09_dual_count(spark, sf_dir):
    return export.dual_counts(export.occurrences(subjects(spark, sf_dir)))


@query(f"WITH {WITH_SUBJECTS} SELECT * FROM counts")
def agg10_incremental_merge(spark, sf_dir):
    rows = subjects(spark, sf_dir)
    parts = [export.dual_counts(export.occurrences(rows.where(f"id % 3 = {k}"))) for k in range(3)]
    return export.merge_counts(parts[0].union(parts[1]).union(parts[2]))


@query(f"WITH {WITH_SUBJECTS} SELECT * FROM counts")
def agg10_saved_partials(spark, sf_dir):
    """Counts of three years' parts are saved in buckets and merged from there."""
    rows = subjects(spark, sf_dir)
    parts = {"early": "not_before < '1994'", "middle": "not_before >= '1994' and not_before < '1996'", "late": "not_before >= '1996' or not_before is null"}
    path = scratch_folder(spark, "partials")
    name = path.rpartition("/")[2].replace("-", "_")
    for part, where in parts.items():
        export.save_partial(export.dual_counts(export.occurrences(rows.where(where))), name, part, path, 8)
    return export.merge_partials(spark, name)


@query(f"WITH {WITH_SUBJECTS} SELECT ca_id, i.common_name AS issuer, count(*) AS n FROM subjects s JOIN issuers i USING (ca_id) WHERE substr(not_before, 1, 7) BETWEEN '1996-01' AND '1996-03' GROUP BY ALL")
def agg11_quarter(spark, sf_dir):
    return catalogue.per_issuer_between(subjects(spark, sf_dir), issuers(spark, sf_dir), "1996-01", "1996-03")


@query(f"WITH {WITH_SUBJECTS}, {WITH_ADDRESSES} SELECT concat('v4_', o[1]) AS base, count(*) AS rows, count(*) >= 5 AS split FROM rev GROUP BY 1")
def agg12_shard_counts(spark, sf_dir):
    return reverse.ip_shards(rev(spark, sf_dir), 1, 5)[1]


@query(f"""WITH {WITH_SUBJECTS}, p AS (SELECT string_split(regexp_replace(trim(san), '^\\*\\.', ''), '.') AS l FROM sans WHERE trim(san) <> ''),
q AS (SELECT CASE WHEN len(l) < 2 THEN l[1] WHEN concat_ws('.', l[-2], l[-1]) IN ('co.uk','com.au','org.uk','co.nz','com.br','co.jp','co.za','org.au','net.au','gov.uk','ac.uk','me.uk') AND len(l) >= 3 THEN concat_ws('.', l[-3], l[-2], l[-1]) ELSE concat_ws('.', l[-2], l[-1]) END AS parent FROM p)
SELECT parent, count(*) AS n FROM q WHERE parent <> '' GROUP BY 1 ORDER BY n DESC, parent LIMIT 20""")
def agg13_parent_topn(spark, sf_dir):
    return catalogue.top_parents(subjects(spark, sf_dir))


def chain_entries(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.unhex(F.sha2("text", 256)).alias("fp"))
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "fp"))).alias("c"))
    return rows.select(F.col("conv_id").alias("index"), F.lit("static").alias("source"), F.transform("c", lambda x: x["fp"]).alias("chain_fingerprints"))


def chain_store(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("conv_id % 5 <> 0").select(F.unhex(F.sha2("text", 256)).alias("fingerprint"), F.encode("text", "utf-8").alias("der")).dropDuplicates(["fingerprint"])


@query("SELECT DISTINCT upper(sha256(text)) AS fingerprint FROM conversations WHERE text IS NOT NULL")
def agg14_distinct_fp(spark, sf_dir):
    return hexed(chains.referenced(chain_entries(spark, sf_dir)), "fingerprint")


@query("WITH l AS (SELECT event_type AS t FROM events) SELECT count(*) AS total, count(*) FILTER (t = 'view') AS ok, count(*) FILTER (t = 'click') AS nxdomain, count(*) FILTER (t = 'purchase') AS timeout, count(*) FILTER (t = 'error') AS error, CAST(count(*) FILTER (t = 'error') AS DOUBLE) / count(*) * 100 AS error_pct FROM l")
def agg17_status(spark, sf_dir):
    status = F.expr("CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'nxdomain' WHEN 'purchase' THEN 'timeout' WHEN 'error' THEN 'error' END")
    return dns.run_stats(table(spark, sf_dir, "events").select(status.alias("status")))


@query(f"WITH {WITH_ADDRESSES} SELECT ip, count(DISTINCT domain) AS domains FROM rev GROUP BY 1 ORDER BY domains DESC, ip LIMIT 1")
def agg18_busiest_ip(spark, sf_dir):
    rows = rev(spark, sf_dir).groupBy("ip").agg(F.count_distinct("domain").alias("domains"))
    return hexed(rows.orderBy(F.desc("domains"), "ip").limit(1), "ip")


@query("SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def agg19_duplicates(spark, sf_dir):
    return dedup.duplicates(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key"), "key")


# scalar functions
@query(f"WITH {WITH_SUBJECTS} SELECT substr(not_before, 1, 7) AS month, count(*) AS n FROM subjects GROUP BY 1")
def fn02_month(spark, sf_dir):
    return subjects(spark, sf_dir).groupBy(certs.cert_month(F.col("not_before")).alias("month")).agg(F.count("*").alias("n"))


@query(f"""WITH {WITH_SUBJECTS}, l AS (SELECT id, common_name, CASE WHEN san_domains = '' THEN [] ELSE string_split(san_domains, ',') END AS a FROM subjects),
p AS (SELECT id, len(a) AS names, CAST(len(list_filter(a, lambda x: starts_with(x, '*.'))) > 0 AS INT) AS wild, coalesce(list_filter(a, lambda x: NOT starts_with(x, '*.'))[1], regexp_replace(a[1], '^\\*\\.', ''), common_name, '') AS n FROM l)
SELECT id, CASE WHEN n = '' THEN '' ELSE 'https://' || n END AS url, wild, CAST(names AS INT) AS names FROM p""")
def fn03_url(spark, sf_dir):
    rows = subjects(spark, sf_dir).withColumn("a", certs.split_list(F.col("san_domains")))
    return rows.select("id", certs.subject_url(F.col("a"), F.col("common_name")).alias("url"), certs.has_wildcard(F.col("a")).alias("wild"), certs.name_count(F.col("a")).alias("names"))


@query(f"WITH {WITH_SUBJECTS} SELECT domain, count(*) AS n FROM valid GROUP BY 1")
def fn08_normalize(spark, sf_dir):
    rows = export.occurrences(subjects(spark, sf_dir)).select(names.normalize(names.strip_wildcard(F.trim("name"))).alias("domain"))
    return rows.where("domain <> ''").groupBy("domain").agg(F.count("*").alias("n"))


@query(f"WITH {WITH_SUBJECTS} SELECT san_domain AS name, is_wildcard = 1 AS wildcard, count(*) AS n FROM san_index GROUP BY 1, 2")
def fn09_norm_fqdn(spark, sf_dir):
    rows = export.occurrences(subjects(spark, sf_dir)).select(names.norm_fqdn(F.col("name")).alias("x"))
    return rows.groupBy("x.name", "x.wildcard").agg(F.count("*").alias("n"))


@query(f"WITH {WITH_SUBJECTS}, l AS (SELECT regexp_replace(trim(lower(san)), '^\\*\\.', '') AS fqdn FROM sans) SELECT fqdn, count(*) AS n FROM l WHERE regexp_matches(fqdn, '^[a-z0-9._-]+\\.[a-z]{{2,}}$') GROUP BY 1")
def fn10_listing_names(spark, sf_dir):
    return export.listing_counts(subjects(spark, sf_dir))


@query(f"""WITH {WITH_SUBJECTS}, k AS (SELECT domain, CASE WHEN ends_with(domain, '.co.uk') THEN 'co.uk' ELSE string_split(domain, '.')[-1] END AS tld, string_split(domain, '.')[-2] AS label FROM counts)
SELECT domain, tld, CASE WHEN tld <> 'com' THEN 'exports' WHEN regexp_matches(label, '^[a-z]') THEN label[1] WHEN regexp_matches(label, '^[0-9]') THEN '0' ELSE '_other' END AS bucket FROM k""")
def fn15_shard_key(spark, sf_dir):
    return export.with_shards(export.dual_counts(export.occurrences(subjects(spark, sf_dir)))).select("domain", "tld", "bucket")


@query(f"WITH {WITH_ADDRESSES} SELECT DISTINCT address, ip, CAST(4 AS INT) AS ver FROM octets JOIN keyed USING (domain, fetched_at) WHERE keyed.o = octets.o")
def fn18_ipkey(spark, sf_dir):
    return hexed(ipkey.key16(addresses(spark, sf_dir).select("address").distinct(), v6=False), "ip")


#: IPv6 texts in every form, made of two numbers h and i by Spark and by DuckDB alike; the last ones are no addresses.
SIX_FORMS = (
    "concat('2001:db8::', {h}, ':', {i})", "concat('2001:DB8:0:0:1:', {h}, ':0:', {i})", "concat('::ffff:10.', {n} % 256, '.0.', {m} % 256)", "concat(' fe80::', {i}, '%eth0 ')",
    "concat({h}, ':', {i}, ':3:4:5:6:7::')", "concat('::', {h})", "concat('1:2:3:4:5:6:', {m} % 256, '.2.3.4')", "'::'",
    "concat('1:2:3:4:5:6:7:8:', {h})", "concat('1::2::', {h})", "concat('1:2:3:4:5:6:7::', {h})", "concat('12345::', {h})", "concat('::1.2.3.', 256 + {m} % 9)", "concat({h}, ':')",
)
_SIX = "CASE event_id %% %d %s END" % (len(SIX_FORMS), " ".join(f"WHEN {k} THEN {f}" for k, f in enumerate(SIX_FORMS)))
_SIX_SQL = _SIX.format(h="lower(to_base(user_id % 65536, 16))", i="lower(to_base(event_id % 65536, 16))", n="user_id", m="event_id")


@query(f"""WITH t AS (SELECT DISTINCT {_SIX_SQL} AS address FROM events), z AS (SELECT address, regexp_replace(trim(address), '%.+$', '') AS b FROM t),
q AS (SELECT address, CASE WHEN regexp_matches(b, ':[0-9.]+$') AND contains(b, '.') THEN CASE WHEN list_max(list_transform(string_split(string_split(b, ':')[-1], '.'), lambda o: CAST(o AS INT))) < 256 THEN
 concat(regexp_replace(b, '[^:]*$', ''), printf('%02x%02x:%02x%02x', CAST(string_split(string_split(b, ':')[-1], '.')[1] AS INT), CAST(string_split(string_split(b, ':')[-1], '.')[2] AS INT), CAST(string_split(string_split(b, ':')[-1], '.')[3] AS INT), CAST(string_split(string_split(b, ':')[-1], '.')[4] AS INT))) END ELSE b END AS p FROM z),
g AS (SELECT address, p, contains(p, '::') AS s, list_filter(string_split(CASE WHEN contains(p, '::') THEN split_part(p, '::', 1) ELSE p END, ':'), lambda x: x <> '' OR NOT contains(p, '::')) AS l,
 CASE WHEN contains(p, '::') THEN list_filter(string_split(substr(p, instr(p, '::') + 2), ':'), lambda x: x <> '' OR contains(substr(p, instr(p, '::') + 2), ':')) ELSE [] END AS r FROM q WHERE p IS NOT NULL),
k AS (SELECT address, upper(concat(array_to_string(list_transform(l, lambda x: lpad(x, 4, '0')), ''), repeat('0000', greatest(0, 8 - len(l) - len(r))), array_to_string(list_transform(r, lambda x: lpad(x, 4, '0')), ''))) AS ip FROM g
 WHERE (CASE WHEN s THEN len(l) + len(r) <= 7 ELSE len(l) = 8 END) AND len(list_filter(list_concat(l, r), lambda x: NOT regexp_matches(x, '^[0-9A-Fa-f]{{1,4}}$'))) = 0)
SELECT address, ip, CAST(CASE WHEN starts_with(ip, '00000000000000000000FFFF') THEN 4 ELSE 6 END AS INT) AS ver FROM k""")
def fn18_ipv6(spark, sf_dir):
    text = _SIX.format(h="lower(hex(user_id % 65536))", i="lower(hex(event_id % 65536))", n="user_id", m="event_id")
    return hexed(ipkey.key16(table(spark, sf_dir, "events").selectExpr(f"{text} AS address").distinct()), "ip")


@query(f"WITH {WITH_ADDRESSES} SELECT ip, domain, concat('v4_', o[1]) AS one, concat('v4_', o[1], '_', o[2]) AS two FROM rev")
def fn20_ip_shard(spark, sf_dir):
    c = (F.col("ip"), F.col("ver"))
    return hexed(rev(spark, sf_dir).select("ip", "domain", ipkey.shard_name(*c, 1).alias("one"), ipkey.shard_name(*c, 2).alias("two")), "ip")


@query("SELECT o_orderkey AS n, lower(to_base(o_orderkey, 36)) AS text, o_orderkey AS back FROM orders")
def fn22_base36(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"))
    return rows.withColumn("text", ranges.to_base36(F.col("n"))).withColumn("back", ranges.from_base36(F.col("text")))


@query("SELECT concat(lower(to_base(o_orderkey, 36)), '-', lower(to_base(o_orderkey + o_custkey, 36)), '.binpb') AS name, o_orderkey AS \"start\", o_orderkey + o_custkey + 1 AS \"end\" FROM orders")
def fn23_name_range(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(ranges.range_name(F.col("o_orderkey"), F.col("o_orderkey") + F.col("o_custkey")).alias("name"))
    return rows.select("name", ranges.parse_range_name(F.col("name")).alias("r")).select("name", "r.start", "r.end")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d/%H') AS hour FROM events")
def fn24_leaf_day(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", certs.entry_day(ms).alias("day"), certs.entry_day(ms, hour=True).alias("hour"))


@query("SELECT o_orderkey AS id, CASE WHEN o_custkey > 0 THEN least(CAST(o_orderkey AS DOUBLE) / o_custkey * 100, 100.0) ELSE 0.0 END AS percent FROM orders")
def fn27_progress(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), certs.progress_percent(F.col("o_orderkey"), F.col("o_custkey")).alias("percent"))


# joins
@query(f"WITH {WITH_SUBJECTS}, known AS (SELECT * FROM issuers WHERE ca_id % 3 <> 0) SELECT s.id, coalesce(k.ca_id, 0) AS ca_id FROM subjects s LEFT JOIN known k ON k.ca_id = s.ca_id")
def jn02_left_issuer(spark, sf_dir):
    known = issuers(spark, sf_dir).where("ca_id % 3 <> 0").select(F.col("ca_id").alias("k"))
    rows = subjects(spark, sf_dir)
    return rows.join(known, rows.ca_id == known.k, "left").select("id", F.coalesce("k", F.lit(0)).cast("long").alias("ca_id"))


@query(f"WITH {WITH_SUBJECTS}, seen AS (SELECT DISTINCT cert_key FROM subjects WHERE id % 2 = 0) SELECT id, cert_key FROM subjects s WHERE id % 2 = 1 AND (cert_key IS NULL OR NOT EXISTS (SELECT 1 FROM seen WHERE seen.cert_key = s.cert_key))")
def jn03_anti_seen(spark, sf_dir):
    rows = subjects(spark, sf_dir).select("id", "cert_key")
    return dedup.unseen(rows.where("id % 2 = 1"), rows.where("id % 2 = 0"), "cert_key").select("id", "cert_key")


@query(f"WITH {WITH_SUBJECTS}, m AS (SELECT ca_id, ca_id + 1000000 AS g FROM issuers WHERE ca_id % 4 <> 0) SELECT id, g AS ca_id FROM subjects JOIN m USING (ca_id)")
def jn05_remap(spark, sf_dir):
    mapping = issuers(spark, sf_dir).where("ca_id % 4 <> 0").select("ca_id", (F.col("ca_id") + 1_000_000).alias("global_id"))
    return dedup.remap(subjects(spark, sf_dir).select("id", "ca_id"), mapping, [], "ca_id", "global_id")[0]


@query("WITH w AS (SELECT DISTINCT sha256(text) AS f FROM conversations), s AS (SELECT DISTINCT sha256(text) AS f FROM conversations WHERE conv_id % 5 <> 0) SELECT count(*) AS referenced, count(s.f) AS present, count(*) - count(s.f) AS missing FROM w LEFT JOIN s USING (f)")
def jn06_present_missing(spark, sf_dir):
    return chains.present_missing(chains.referenced(chain_entries(spark, sf_dir)), chain_store(spark, sf_dir))


@query("""WITH s AS (SELECT DISTINCT sha256(text) AS f FROM conversations WHERE conv_id % 5 <> 0), j AS (SELECT conv_id, turn, c.text, s.f FROM conversations c LEFT JOIN s ON s.f = sha256(c.text))
SELECT conv_id AS "index", sha256(string_agg(CASE WHEN f IS NULL THEN '-' ELSE sha256(text) END, ',' ORDER BY turn, sha256(text))) AS chain, bool_and(f IS NOT NULL) AS complete FROM j GROUP BY 1""")
def jn07_ordered_chain(spark, sf_dir):
    rows = chains.ordered_chains(chain_entries(spark, sf_dir), chain_store(spark, sf_dir))
    text = F.array_join(F.transform("chain", lambda d: F.coalesce(F.sha2(d, 256), F.lit("-"))), ",")
    return rows.select("index", F.sha2(text, 256).alias("chain"), "complete")


@query("WITH d AS (SELECT DISTINCT user_id AS domain FROM events), l AS (SELECT DISTINCT user_id AS domain FROM events WHERE event_type = 'view' AND user_id % 2 = 0) SELECT domain FROM d ANTI JOIN l USING (domain)")
def jn10_feed_skip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    domains = events.select(F.col("user_id").alias("domain")).distinct()
    ledger = events.where("event_type = 'view' and user_id % 2 = 0").select(F.col("user_id").alias("domain"))
    return dns.feed(domains, ledger.where("false"), ledger)


CIDRS = ("10.0.0.0/8", "4.3.0.0/16", "6.5.2.0/23", "12.0.0.0/6", "9.1.2.0/24")


@query(f"""WITH {WITH_ADDRESSES}, c(cidr, lo, hi) AS (VALUES {", ".join(f"('{c}', '{ipkey.cidr_bounds(c)[0].hex().upper()}', '{ipkey.cidr_bounds(c)[1].hex().upper()}')" for c in CIDRS)})
SELECT cidr, ip, domain FROM rev JOIN c ON ip BETWEEN lo AND hi""")
def jn11_cidr_many(spark, sf_dir):
    return hexed(reverse.join_cidrs(rev(spark, sf_dir), list(CIDRS)), "ip")


#: Ranges of addresses, one inside the other: each customer's first byte, half of it, and a few addresses of its own.
_RANGES_SQL = """nets AS (SELECT DISTINCT concat('n', c_custkey % 223 + 1) AS value, (c_custkey % 223 + 1) * 16777216 AS lo, (c_custkey % 223 + 1) * 16777216 + 16777215 AS hi FROM customer
 UNION ALL SELECT DISTINCT concat('h', c_custkey % 223 + 1), (c_custkey % 223 + 1) * 16777216 + 131072, (c_custkey % 223 + 1) * 16777216 + 400000 FROM customer WHERE c_custkey % 3 = 0
 UNION ALL SELECT concat('c', c_custkey), (c_custkey % 50 + 1) * 16777216 + c_custkey % 7 * 65536 + c_custkey % 4 * 256, (c_custkey % 50 + 1) * 16777216 + c_custkey % 7 * 65536 + c_custkey % 4 * 256 + c_custkey % 300 FROM customer)"""


@query(f"""WITH {WITH_ADDRESSES}, {_RANGES_SQL}, p AS (SELECT DISTINCT ip, CAST(o[1] AS BIGINT) * 16777216 + CAST(o[2] AS BIGINT) * 65536 + CAST(o[3] AS BIGINT) * 256 + CAST(o[4] AS BIGINT) AS n FROM rev
 UNION ALL SELECT '00000000000000000000FFFF08000207', 8 * 16777216 + 2 * 256 + 7 FROM events WHERE user_id % 3 = 0),
j AS (SELECT ip, value FROM (SELECT DISTINCT ip, n FROM p) JOIN nets ON n BETWEEN lo AND hi QUALIFY row_number() OVER (PARTITION BY ip ORDER BY hi - lo, lo, value) = 1)
SELECT p.ip, value, count(*) AS n FROM p LEFT JOIN j USING (ip) GROUP BY 1, 2""")
def jn12_most_specific(spark, sf_dir):
    """Addresses, one of them a third of all rows, with the smallest of nested ranges."""
    six = lambda n: F.unhex(F.concat(F.lit(ipkey.V4_PREFIX), F.lpad(F.hex(n), 8, "0")))
    c, base = table(spark, sf_dir, "customer").select("c_custkey"), (F.col("c_custkey") % 223 + 1) * 16777216
    own = (F.col("c_custkey") % 50 + 1) * 16777216 + F.col("c_custkey") % 7 * 65536 + F.col("c_custkey") % 4 * 256
    rows = lambda df, name, lo, hi: df.select(name.alias("value"), six(lo).alias("lo"), six(hi).alias("hi"))
    nets = rows(c, F.concat(F.lit("n"), F.col("c_custkey") % 223 + 1), base, base + 16777215).distinct()
    nets = nets.union(rows(c.where("c_custkey % 3 = 0"), F.concat(F.lit("h"), F.col("c_custkey") % 223 + 1), base + 131072, base + 400000).distinct())
    nets = nets.union(rows(c, F.concat(F.lit("c"), "c_custkey"), own, own + F.col("c_custkey") % 300))
    hot = table(spark, sf_dir, "events").where("user_id % 3 = 0").select(F.lit(bytearray(ipkey.cidr_bounds("8.0.2.7")[0])).alias("ip"))
    found = enrich.most_specific(rev(spark, sf_dir).select("ip").distinct().union(hot), nets)
    return hexed(found.groupBy("ip", F.col("range_value").alias("value")).agg(F.count("*").alias("n")), "ip")


# windows and ranges
@query(f"WITH {WITH_SUBJECTS}, r AS (SELECT id, cert_key, row_number() OVER (PARTITION BY cert_key ORDER BY id) AS k FROM subjects) SELECT id, cert_key FROM r WHERE k = 1 OR cert_key IS NULL")
def win01_keep_first(spark, sf_dir):
    return dedup.keep_first(subjects(spark, sf_dir).select("id", "cert_key"), ["cert_key"], ["id"])


@query("""WITH e AS (SELECT event_id AS i, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_type <> 'error'), r AS (SELECT i, day, i - row_number() OVER (PARTITION BY day ORDER BY i) AS g FROM e)
SELECT min(i) AS "first", max(i) AS "last", day, count(*) AS n FROM r GROUP BY day, g""")
def win02_day_runs(spark, sf_dir):
    rows = table(spark, sf_dir, "events").where("event_type <> 'error'").select(F.col("event_id").alias("index"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return intervals.day_runs(rows)


@query(f"WITH {WITH_ADDRESSES} SELECT ip, domain, ver, fetched_at FROM rev")
def win03_freshest(spark, sf_dir):
    return hexed(rev(spark, sf_dir), "ip")


@query(f'WITH {WITH_RANGES} SELECT "start", "end" FROM islands')
def win04_islands(spark, sf_dir):
    return intervals.merge_ranges(log_ranges(spark, sf_dir))


@query(f"""WITH {WITH_RANGES}, n AS (SELECT "end" AS s, lead("start") OVER (ORDER BY "start") AS e FROM islands UNION ALL SELECT 0, min("start") FROM islands UNION ALL SELECT max("end"), (SELECT max(event_id) + 11 FROM events) FROM islands)
SELECT s AS "start", e AS "end" FROM n WHERE e > s""")
def win04_gaps(spark, sf_dir):
    size = table(spark, sf_dir, "events").agg(F.max("event_id") + 11).first()[0]
    return intervals.gaps(intervals.merge_ranges(log_ranges(spark, sf_dir)), size)


@query(f"""WITH {WITH_RANGES}, t AS (SELECT max(event_id) + 11 AS n FROM events) SELECT CAST(sum("end" - "start") AS BIGINT) AS stored, max("end") AS frontier, coalesce(max(CASE WHEN "start" = 0 THEN "end" END), 0) AS contiguous, (SELECT n FROM t) AS tree_size, CAST(sum("end" - "start") AS DOUBLE) / (SELECT n FROM t) * 100 AS percent FROM islands""")
def cov01_coverage(spark, sf_dir):
    size = table(spark, sf_dir, "events").agg(F.max("event_id") + 11).first()[0]
    return intervals.coverage(intervals.merge_ranges(log_ranges(spark, sf_dir)), size)


# sets and deduplication
def dns_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Typed records derived from events: every type, some of its columns from ids, the rest from its place."""
    from ..schemas import DNS_TYPES

    events = table(spark, sf_dir, "events")
    out = {}
    for k, (kind, (columns, _)) in enumerate(DNS_TYPES.items()):
        base = events.where(f"event_id % 19 = {k}")
        typed = [c.split() for c in columns.split(", ")]
        values = [(F.col("event_id") % (7 + j)).cast(t.replace("long", "bigint")).alias(n) if t != "string" else F.concat(F.lit(f"{n}"), F.col("user_id")).alias(n) for j, (n, t) in enumerate(typed)]
        out[kind] = base.select(F.concat(F.lit("d"), F.col("user_id")).alias("domain"), (F.col("event_id") % 3600).alias("ttl"), F.unix_timestamp("ts").alias("fetched_at"), *values)
    return out


def _dns_sql() -> str:
    from ..schemas import DNS_TYPES

    arms = []
    for k, (kind, (columns, shown)) in enumerate(DNS_TYPES.items()):
        typed = [c.split() for c in columns.split(", ")]
        text = {n: (f"CAST(event_id % {7 + j} AS VARCHAR)" if t != "string" else f"concat('{n}', user_id)") for j, (n, t) in enumerate(typed)}
        arms.append(f"SELECT concat('d', user_id) AS domain, '{kind.upper()}' AS type, event_id % 3600 AS ttl, CAST(floor(epoch(ts)) AS BIGINT) AS fetched_at, concat_ws(' ', {', '.join(text[f] for f in shown)}) AS value FROM events WHERE event_id % 19 = {k}")
    return " UNION ALL ".join(arms)


@query(_dns_sql())
def set01_dns_union(spark, sf_dir):
    return dns.unified(dns_tables(spark, sf_dir))


@query("SELECT concat('d', user_id) AS domain, event_id % 3600 AS ttl, CAST(floor(epoch(ts)) AS BIGINT) AS fetched_at, CAST(event_id % 7 AS INT) AS pref, concat('host', user_id) AS host FROM events WHERE event_id % 19 = 5")
def snk08_dispatch(spark, sf_dir):
    mx = dns_tables(spark, sf_dir)["mx"]
    records = mx.select("domain", F.lit("MX").alias("type"), "ttl", "fetched_at", F.create_map(F.lit("pref"), F.col("pref").cast("string"), F.lit("host"), F.col("host")).alias("fields"))
    return dns.dispatch(records, "mx")


@query(f"""WITH {WITH_SUBJECTS}, u AS (SELECT id, cert_key, 0 AS r FROM subjects WHERE id % 2 = 0 UNION ALL SELECT id, cert_key, 1 FROM subjects WHERE id % 2 = 1 OR id % 3 = 0),
k AS (SELECT id, cert_key, row_number() OVER (PARTITION BY cert_key ORDER BY r, id) AS n FROM u WHERE cert_key IS NOT NULL) SELECT id, cert_key FROM k WHERE n = 1""")
def set02_merge(spark, sf_dir):
    rows = subjects(spark, sf_dir).select("id", "cert_key").where("cert_key is not null")
    return dedup.merge_first(rows.where("id % 2 = 0"), rows.where("id % 2 = 1 or id % 3 = 0"), "cert_key", ["id"])


@query(f"WITH {WITH_SUBJECTS} SELECT DISTINCT san_domain, is_wildcard, cert_id FROM san_reg")
def set04_distinct(spark, sf_dir):
    return reverse.san_index(subjects(spark, sf_dir)).select("san_domain", "is_wildcard", "cert_id").distinct()


@query("SELECT domain, direct, wildcard, CASE WHEN direct > 0 THEN 'direct' ELSE 'wildcard_only' END AS class FROM counts".join([f"WITH {WITH_SUBJECTS} ", ""]))
def set05_split(spark, sf_dir):
    rows = export.dual_counts(export.occurrences(subjects(spark, sf_dir)))
    return rows.where("direct > 0").withColumn("class", F.lit("direct")).union(rows.where("direct = 0").withColumn("class", F.lit("wildcard_only")))


@query("""WITH d AS (SELECT DISTINCT sha256(text) AS f, doc_id FROM documents), known AS (SELECT f, row_number() OVER (ORDER BY f) AS ca_id FROM (SELECT DISTINCT f FROM d WHERE doc_id % 3 = 0)),
fresh AS (SELECT f, row_number() OVER (ORDER BY f) + (SELECT max(ca_id) FROM known) AS ca_id FROM (SELECT DISTINCT f FROM d WHERE f NOT IN (SELECT f FROM known))) SELECT f AS fingerprint, ca_id FROM known UNION ALL SELECT f, ca_id FROM fresh""")
def ded01_upsert(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("fingerprint"), "doc_id")
    none = spark.createDataFrame([], "fingerprint string, ca_id long")
    known = dedup.upsert_ids(none, rows.where("doc_id % 3 = 0").select("fingerprint"))
    return dedup.upsert_ids(known, rows.select("fingerprint"))


@query(f"WITH {WITH_SUBJECTS}, p AS (SELECT id, cert_key, row_number() OVER (PARTITION BY cert_key ORDER BY id) AS k FROM subjects WHERE id % 2 = 1 OR id % 3 = 0) SELECT id, cert_key FROM p WHERE (k = 1 AND cert_key NOT IN (SELECT cert_key FROM subjects WHERE id % 2 = 0 AND cert_key IS NOT NULL)) OR cert_key IS NULL")
def ded04_flush(spark, sf_dir):
    rows = subjects(spark, sf_dir).select("id", "cert_key")
    return dedup.flush(rows.where("id % 2 = 0 and cert_key is not null"), rows.where("id % 2 = 1 or id % 3 = 0"), "cert_key").select("id", "cert_key")


@query("WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS k FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2)) SELECT l_orderkey, l_linenumber, l_partkey FROM r WHERE k = 1")
def ded05_seal(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dedup.keep_first(rows, ["l_orderkey"], ["l_linenumber", "l_partkey"])


@query("WITH r AS (SELECT user_id AS domain, min(event_id) AS fetched_at FROM events WHERE event_type <> 'view' GROUP BY 1) SELECT domain, fetched_at FROM r WHERE domain NOT IN (SELECT user_id FROM events WHERE event_type = 'view' AND user_id % 2 = 0)")
def ded10_ledger(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("domain"), F.col("event_id").alias("fetched_at"), "event_type")
    fresh = dedup.new_in_ledger(events.where("event_type <> 'view'"), events.where("event_type = 'view' and domain % 2 = 0"))
    return fresh.select("domain", "fetched_at")


# indexes
@query(f"WITH {WITH_ADDRESSES}, b AS (SELECT concat('v4_', o[1]) AS base, count(*) AS n FROM rev GROUP BY 1) SELECT ip, domain, CASE WHEN n >= 5 THEN concat('v4_', o[1], '_', o[2]) ELSE base END AS shard FROM rev JOIN b ON base = concat('v4_', o[1])")
def idx02_split_shards(spark, sf_dir):
    return hexed(reverse.ip_shards(rev(spark, sf_dir), 1, 5)[0].select("ip", "domain", "shard"), "ip")


@query(f"WITH {WITH_SUBJECTS} SELECT san_domain, reg_domain, cert_id, is_wildcard FROM san_reg")
def idx03_san_index(spark, sf_dir):
    return reverse.san_index(subjects(spark, sf_dir))


@query(f"""WITH {WITH_SUBJECTS}, x AS (SELECT *, CASE WHEN reg_domain = '_other' THEN '_other' WHEN ends_with(reg_domain, '.co.uk') THEN 'co.uk' ELSE string_split(reg_domain, '.')[-1] END AS suffix FROM san_reg), n AS (SELECT suffix, count(*) AS rows FROM x GROUP BY 1),
c AS (SELECT suffix, rows, CASE WHEN suffix = 'com' OR rows >= 5000 THEN 'bucketed' WHEN rows >= 1000 THEN 'dedicated' ELSE 'tail' END AS class FROM n) SELECT suffix, rows, class FROM c""")
def idx04_san_classes(spark, sf_dir):
    index = reverse.san_index(subjects(spark, sf_dir))
    return reverse.san_classes(index, 1000, 5000)[1]


@query(f"WITH {WITH_ADDRESSES} SELECT DISTINCT domain FROM rev WHERE ip = '00000000000000000000FFFF{bytes([8, 0, 2, 7]).hex().upper()}'")
def idx05_ip_lookup(spark, sf_dir):
    return reverse.lookup_written_ip(spark, written(spark, sf_dir, "ip"), "8.0.2.7")


@query(f"WITH {WITH_ADDRESSES} SELECT ip, domain FROM rev WHERE ip BETWEEN '{ipkey.cidr_bounds('8.0.0.0/6')[0].hex().upper()}' AND '{ipkey.cidr_bounds('8.0.0.0/6')[1].hex().upper()}'")
def idx06_cidr_lookup(spark, sf_dir):
    return hexed(reverse.lookup_cidr(reverse.read_ip_index(spark, written(spark, sf_dir, "ip")), "8.0.0.0/6"), "ip")


@query(ORACLES["idx06_cidr_lookup"])
def idx07_routed_lookup(spark, sf_dir):
    return hexed(reverse.lookup_written_cidr(spark, written(spark, sf_dir, "ip"), "8.0.0.0/6"), "ip")


@query(f"WITH {WITH_SUBJECTS} SELECT DISTINCT san_domain, is_wildcard, cert_id FROM san_reg WHERE san_domain = 'example.com' OR reg_domain = 'example.com'")
def idx08_san_lookup(spark, sf_dir):
    return reverse.lookup_written_san(spark, written(spark, sf_dir, "san"), "example.com")


# progress and monitors
@query("""WITH o AS (SELECT c_custkey AS log_id, c_name AS description, c_mktsegment AS operator, c_custkey * 10 AS next_entry_idx FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey AS log_id, concat(c_name, '!') AS description, c_mktsegment AS operator FROM customer WHERE c_custkey % 2 = 1 OR c_custkey % 3 = 0)
SELECT coalesce(o.log_id, n.log_id) AS log_id, coalesce(n.description, o.description) AS description, coalesce(n.operator, o.operator) AS operator, coalesce(next_entry_idx, 0) AS next_entry_idx FROM o FULL JOIN n ON o.log_id = n.log_id""")
def prg01_merge_runs(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("log_id"), F.col("c_name").alias("description"), F.col("c_mktsegment").alias("operator"), (F.col("c_custkey") * 10).alias("next_entry_idx"))
    incoming = rows.where("log_id % 2 = 1 or log_id % 3 = 0").drop("next_entry_idx").withColumn("description", F.concat("description", F.lit("!")))
    return progress.merge_runs(rows.where("log_id % 2 = 0"), incoming)


@query("SELECT c_custkey AS id, c_mktsegment AS operator, c_name AS description, CASE WHEN c_custkey % 50 > 0 THEN least(CAST(c_custkey AS DOUBLE) / (c_custkey % 50) * 100, 100.0) ELSE 0.0 END AS percent FROM customer ORDER BY percent >= 100, operator, description LIMIT 40")
def srt05_monitor(spark, sf_dir):
    runs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("operator"), F.col("c_name").alias("description"), F.col("c_custkey").alias("next_entry_idx"), (F.col("c_custkey") % 50).alias("tree_size_at_start"))
    return progress.panel(runs).limit(40).select("id", "operator", "description", "percent")


@query("SELECT event_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS errors, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w > 30 AS over FROM events WINDOW w AS (PARTITION BY user_id % 8 ORDER BY event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)")
def str07_breaker(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 8).alias("shard"), F.col("event_type").alias("status"))
    return breaker.error_share(rows, "shard", "event_id").select("event_id", "errors", "over")


@query("""WITH l AS (SELECT user_id AS shard, max(event_id) AS seen, arg_max(event_type, event_id) AS t FROM events GROUP BY 1), s AS (SELECT shard, seen, CASE WHEN t IN ('view', 'click') THEN 'running' ELSE 'complete' END AS status FROM l)
SELECT shard, seen, CASE WHEN status = 'running' AND row_number() OVER (PARTITION BY status ORDER BY seen DESC, shard) > 1 THEN 'interrupted' ELSE status END AS status FROM s""")
def mon02_current(spark, sf_dir):
    status = F.when(F.col("event_type").isin("view", "click"), "running").otherwise("complete")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("shard"), F.col("event_id").alias("at"), F.col("event_id").alias("done"), status.alias("status"))
    return progress.shard_status(rows).select("shard", F.col("at").alias("seen"), "status")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def str06_daily_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))


# extras that are only planned elsewhere
@query(f"WITH {WITH_SUBJECTS} SELECT domain AS fqdn, substr(min(not_before), 1, 10) AS first_seen FROM valid GROUP BY 1")
def ext_seen_fqdns(spark, sf_dir):
    low = F.trim("name")
    rows = subjects(spark, sf_dir).where("san_domains <> ''").select("not_before", F.explode(certs.split_list(F.col("san_domains"))).alias("name"))
    rows = rows.select("not_before", names.normalize(names.strip_wildcard(low)).alias("fqdn")).where("fqdn <> ''")
    return rows.groupBy("fqdn").agg(F.substring(F.min("not_before"), 1, 10).alias("first_seen"))


@query("SELECT concat('host', user_id) AS host, concat('d', user_id) AS domain, CAST(event_id % 7 AS INT) AS pref FROM events WHERE event_id % 19 = 5 GROUP BY ALL")
def ext_mx_inverted(spark, sf_dir):
    return dns_tables(spark, sf_dir)["mx"].select("host", "domain", "pref").distinct()


# families that earlier had no graded query
#: Names of every kind of rule: bases, each below some labels, and the rules that they meet in the list.
SUFFIX_BASES = ("com", "example.com", "co.uk", "shop.co.uk", "ck", "www.ck", "city.kobe.jp", "kobe.jp", "github.io", "compute.amazonaws.com", "zz", "a..com", "blogspot.com")
SUFFIX_RULES = (
    ("com", "exact"), ("uk", "exact"), ("co.uk", "exact"), ("ck", "wild"), ("www.ck", "exception"), ("jp", "exact"), ("kobe.jp", "wild"), ("city.kobe.jp", "exception"),
    ("io", "exact"), ("github.io", "exact"), ("compute.amazonaws.com", "wild"), ("blogspot.com", "exact"),
)
SUFFIX_HEADS = ("", "a.", "www.b.", "x.y.z.")


@query(f"""WITH rules(rule, kind) AS (VALUES {", ".join(map(str, SUFFIX_RULES))}),
n AS (SELECT DISTINCT CASE o_orderkey % 5 WHEN 0 THEN concat('h', o_custkey, '.', b) ELSE concat(h, b) END AS name FROM (SELECT o_orderkey, o_custkey, {list(SUFFIX_HEADS)}[1 + o_custkey % {len(SUFFIX_HEADS)}] AS h, {list(SUFFIX_BASES)}[1 + o_orderkey % {len(SUFFIX_BASES)}] AS b FROM orders)),
l AS (SELECT name, string_split(name, '.') AS l, unnest(range(1, len(string_split(name, '.')) + 1)) AS d FROM n), t AS (SELECT name, d, array_to_string(l[-d:], '.') AS tail, array_to_string(l[-(d - 1):], '.') AS parent, len(l) AS k FROM l),
m AS (SELECT name, CASE WHEN r.kind = 'exception' THEN d - 1 ELSE d END AS labels, r.kind = 'exception' AS first, d FROM t JOIN rules r ON (r.kind <> 'wild' AND r.rule = tail) OR (r.kind = 'wild' AND d > 1 AND r.rule = parent)),
s AS (SELECT n.name, coalesce(arg_max(labels, d * 2 + CAST(first AS INT)), 1) AS labels, string_split(n.name, '.') AS l FROM n LEFT JOIN m USING (name) GROUP BY n.name)
SELECT name, array_to_string(l[-labels:], '.') AS suffix, CASE WHEN len(l) > labels AND NOT contains(name, '..') THEN array_to_string(l[-(labels + 1):], '.') END AS registrable FROM s""")
def fn11_public_suffix(spark, sf_dir):
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))
    base, head = pick(SUFFIX_BASES, F.col("o_orderkey") % len(SUFFIX_BASES)), pick(SUFFIX_HEADS, F.col("o_custkey") % len(SUFFIX_HEADS))
    name = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("h"), "o_custkey", F.lit("."), base)).otherwise(F.concat(head, base))
    return names.with_suffix(table(spark, sf_dir, "orders").select(name.alias("name")).distinct(), "name")


@query(f"WITH {WITH_SUBJECTS} SELECT DISTINCT san_domain AS name, CASE WHEN ends_with(san_domain, '.co.uk') THEN 'co.uk' WHEN contains(san_domain, '.') THEN string_split(san_domain, '.')[-1] ELSE san_domain END AS suffix, CASE WHEN reg_domain = '_other' THEN NULL ELSE reg_domain END AS registrable FROM san_reg")
def fn11_san_suffix(spark, sf_dir):
    rows = subjects(spark, sf_dir).where("san_domains <> ''").select(F.explode(certs.split_list(F.col("san_domains"))).alias("san")).select(names.norm_fqdn(F.col("san"))["name"].alias("name")).distinct()
    return names.with_suffix(rows, "name")


_BUCKET_SQL = "CASE WHEN regexp_matches(substr(reg_domain, 1, 1), '[a-z]') THEN substr(reg_domain, 1, 1) WHEN regexp_matches(substr(reg_domain, 1, 1), '[0-9]') THEN '0' ELSE '_other' END"


@query(f"WITH {WITH_SUBJECTS}, x AS (SELECT DISTINCT reg_domain, CASE WHEN reg_domain = '_other' THEN '_other' WHEN ends_with(reg_domain, '.co.uk') THEN 'co.uk' ELSE string_split(reg_domain, '.')[-1] END AS suffix FROM san_reg) SELECT reg_domain, concat('san_', suffix, '__', CASE WHEN suffix = 'com' THEN {_BUCKET_SQL} ELSE 'all' END) AS shard, concat('san__tail__', {_BUCKET_SQL.replace('reg_domain', 'suffix')}) AS tail FROM x")
def fn16_san_shards(spark, sf_dir):
    rows = reverse.san_index(subjects(spark, sf_dir), suffix=True).select("reg_domain", "suffix").distinct()
    rows = rows.withColumn("s", names.san_shard(F.col("reg_domain"), F.col("suffix")))
    return rows.select("reg_domain", names.san_shard_name(F.col("s.suffix"), F.col("s.bucket")).alias("shard"), names.tail_shard_name(F.col("s.suffix")).alias("tail"))


@query("SELECT event_id, concat('alpn=', lower(hex(encode(event_type))), ' port=', lower(hex(encode(CAST(user_id AS VARCHAR))))) AS params FROM events")
def fn25_svcb_params(spark, sf_dir):
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value"))
    params = F.array(pair("alpn", F.col("event_type")), pair("port", F.col("user_id").cast("string")))
    return table(spark, sf_dir, "events").select("event_id", certs.svcb_params(params).alias("params"))


@query("SELECT c_custkey, format('{:,}', CAST(c_custkey * 137 AS BIGINT)) AS grouped, CASE WHEN c_custkey < 90 THEN concat('~', c_custkey, 's') WHEN c_custkey < 5400 THEN concat('~', CAST(floor(c_custkey / 60.0 + 0.5) AS BIGINT), 'm') ELSE printf('~%.1fh', c_custkey / 3600.0) END AS eta FROM customer")
def fn28_texts(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", certs.thousands(key * 137).alias("grouped"), certs.eta_text(key.cast("double")).alias("eta"))


@query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 25.0 WHEN 1 THEN 1.0 WHEN 2 THEN 5.0 WHEN 3 THEN 5.0 ELSE 3.0 END AS rate FROM customer")
def fn29_request_rate(spark, sf_dir):
    kind = F.col("c_custkey") % 5
    operator = F.when(kind == 0, "Google").when(kind == 1, "Geomys").otherwise("someone")
    protocol = F.when(kind == 2, "static").when(kind == 3, "rfc6962").otherwise("other")
    return table(spark, sf_dir, "customer").select("c_custkey", certs.request_rate(operator, protocol).alias("rate"))


@query("SELECT count(*) AS entries, CAST(sum(octet_length(encode(html))) AS BIGINT) AS bytes, min(page_id) AS first, max(page_id) AS last FROM pages")
def agg15_summary(spark, sf_dir):
    return archive.summary(table(spark, sf_dir, "pages").select(F.col("page_id").alias("index"), F.col("html").cast("binary").alias("leaf_input")))


@query("SELECT count(*) AS files, CAST(sum(octet_length(encode(html))) AS BIGINT) AS bytes FROM pages")
def agg16_stored_bytes(spark, sf_dir):
    return archive.stored_bytes(table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.octet_length("html").cast("long").alias("length")))


_RUNS_SQL = "runs AS (SELECT c_custkey AS log_id, CAST(c_custkey * 10 AS BIGINT) AS next_entry_idx, CAST(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey * 20 END AS BIGINT) AS tree_size_at_start, CAST(c_custkey * 5 AS BIGINT) AS total_processed FROM customer), steps AS (SELECT o_custkey AS log_id, CAST(max(o_orderkey) AS BIGINT) AS next_entry_idx, count(*) AS processed, CAST(max(o_orderkey) * 2 AS BIGINT) AS tree_size FROM orders GROUP BY 1)"


def log_runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    runs = table(spark, sf_dir, "customer").selectExpr("c_custkey AS log_id", "CAST(c_custkey * 10 AS BIGINT) AS next_entry_idx", "CAST(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey * 20 END AS BIGINT) AS tree_size_at_start", "CAST(c_custkey * 5 AS BIGINT) AS total_processed")
    steps = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("log_id")).agg(F.max("o_orderkey").cast("long").alias("next_entry_idx"), F.count("*").alias("processed"), (F.max("o_orderkey") * 2).cast("long").alias("tree_size"))
    return runs, steps


@query(f"WITH {_RUNS_SQL} SELECT r.log_id, coalesce(s.next_entry_idx, r.next_entry_idx) AS next_entry_idx, CASE WHEN r.tree_size_at_start = 0 THEN coalesce(s.tree_size, 0) ELSE r.tree_size_at_start END AS tree_size_at_start, r.total_processed + coalesce(s.processed, 0) AS total_processed FROM runs r LEFT JOIN steps s USING (log_id)")
def prg02_advance(spark, sf_dir):
    return progress.advance(*log_runs(spark, sf_dir))


@query(f"WITH {_RUNS_SQL} SELECT count(*) AS runs, CAST(sum(total_processed) AS BIGINT) AS processed, CAST(sum(tree_size_at_start) AS BIGINT) AS tree_size FROM runs")
def prg03_totals(spark, sf_dir):
    return progress.run_totals(log_runs(spark, sf_dir)[0])


@query(f"WITH {_RUNS_SQL}, p AS (SELECT count(*) AS files, CAST(sum(octet_length(encode(html))) AS BIGINT) AS bytes FROM pages) SELECT CAST(sum(tree_size_at_start) AS BIGINT) AS tree_size, CAST(sum(total_processed) AS BIGINT) AS processed, max(files) AS files, max(bytes) AS bytes, CAST(sum(total_processed) AS DOUBLE) / sum(tree_size_at_start) * 100 AS percent FROM runs, p")
def cov02_check(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.octet_length("html").cast("long").alias("length"))
    return archive.check(log_runs(spark, sf_dir)[0], files)


@query(f"WITH {_RUNS_SQL} SELECT r.log_id, s.processed AS session, r.next_entry_idx AS cursor, s.tree_size, CASE WHEN s.processed % 4 = 1 THEN 'error' WHEN s.processed >= 12 THEN 'complete' WHEN r.next_entry_idx >= s.tree_size THEN 'caught_up' ELSE 'running' END AS state, CASE WHEN s.processed % 4 = 1 THEN 'gone' END AS error FROM runs r JOIN steps s USING (log_id)")
def str05_states(spark, sf_dir):
    runs, steps = log_runs(spark, sf_dir)
    sessions = steps.select("log_id", "processed", "tree_size", F.when(F.col("processed") % 4 == 1, "gone").alias("error"))
    return progress.run_states(runs, sessions, target=12)


@query("SELECT concat(user_id, '.0.0.1') AS address, concat('d', event_id) AS domain, event_id AS fetched_at FROM events WHERE event_type = 'view' UNION ALL SELECT concat('2001:db8::', user_id), concat('d', event_id), event_id FROM events WHERE event_type <> 'view'")
def set03_address_union(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "user_id", F.concat(F.lit("d"), F.col("event_id")).alias("domain"), F.col("event_id").alias("fetched_at"))
    a = rows.where("event_type = 'view'").withColumn("ipv4", F.concat("user_id", F.lit(".0.0.1")))
    return reverse.address_union(a, rows.where("event_type <> 'view'").withColumn("ipv6", F.concat(F.lit("2001:db8::"), F.col("user_id"))))


@query("SELECT c_custkey, concat('x', c_nationkey) AS log_id, n_name AS description, CASE WHEN n_name IS NOT NULL THEN concat('r', n_regionkey) END AS operator, CASE WHEN n_name IS NOT NULL THEN 'static' END AS protocol FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 5 > 0")
def jn13_log_lookup(spark, sf_dir):
    from ..sources.loglist import with_log

    logs = table(spark, sf_dir, "nation").where("n_nationkey % 5 > 0").select(F.concat(F.lit("x"), F.col("n_nationkey")).alias("log_id"), F.col("n_name").alias("description"), F.concat(F.lit("r"), F.col("n_regionkey")).alias("operator"), F.lit("static").alias("protocol"))
    return with_log(table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("x"), F.col("c_nationkey")).alias("log_id")), logs)


@query("SELECT DISTINCT concat('d', user_id) AS domain FROM events ORDER BY domain LIMIT 50")
def srt07_batch(spark, sf_dir):
    return dns.batch(table(spark, sf_dir, "events").select(F.concat(F.lit("d"), F.col("user_id")).alias("domain")), 50)[0]


def _pool(spark, sf_dir) -> DataFrame:
    own = {"cert_hash": F.encode("cert_key", "UTF-8"), "tile_idx": F.col("tile_idx"), "entry_idx": F.col("entry_idx").cast("long")}
    rows = subjects(spark, sf_dir)
    kinds = (c.split() for c in SUBJECTS.split(", "))
    return rows.select(*((own[n] if n in own else F.col(n) if n in rows.columns else F.lit(None)).cast(k).alias(n) for n, k in kinds))


_ARCHIVE_SQL = f"""WITH {WITH_SUBJECTS}, k AS (SELECT id, substr(not_before, 1, 7) AS cert_month, coalesce(cert_key, concat_ws(':', tile_idx, entry_idx)) AS key FROM subjects),
u AS (SELECT *, 0 AS r FROM k WHERE id % 2 = 0 UNION ALL SELECT *, 1 FROM k WHERE id % 2 = 1 OR id % 3 = 0), n AS (SELECT *, row_number() OVER (PARTITION BY cert_month, key ORDER BY r, id) AS nth FROM u) SELECT id, cert_month FROM n WHERE nth = 1"""


@query(_ARCHIVE_SQL)
def ded08_archive(spark, sf_dir):
    """Two overlapping pools are drained into a month archive, the second of them twice, and all months are sealed."""
    store = dedup.MonthArchive(spark, scratch_folder(spark, "archive"))
    rows = _pool(spark, sf_dir)
    second = rows.where("id % 2 = 1 or id % 3 = 0")
    archive.drain_pools(store, [rows.where("id % 2 = 0"), second, second], seal=True)
    return store.subjects().select("id", "cert_month")


@query(f"""WITH {WITH_SUBJECTS}, k AS (SELECT id, substr(not_before, 1, 7) AS cert_month, coalesce(cert_key, concat_ws(':', tile_idx, entry_idx)) AS key FROM subjects),
b AS (SELECT *, row_number() OVER (PARTITION BY cert_month, key ORDER BY id) AS nth FROM k WHERE id % 2 = 0), u AS (SELECT id, cert_month, key, 0 AS r FROM b WHERE nth = 1 UNION ALL SELECT *, 1 FROM k WHERE id % 2 = 1 OR id % 3 = 0),
a AS (SELECT *, row_number() OVER (PARTITION BY cert_month, key ORDER BY r, id) AS nth FROM u) SELECT 'before' AS read, id, cert_month FROM b WHERE nth = 1 UNION ALL SELECT 'after', id, cert_month FROM a WHERE nth = 1""")
def ded06_rebuild(spark, sf_dir):
    """Months are rebuilt under a reader, who still reads the version before."""
    store = dedup.MonthArchive(spark, scratch_folder(spark, "archive"))
    rows = _pool(spark, sf_dir)
    store.flush(rows.where("id % 2 = 0"))
    reader = store.subjects(store.manifest()[0])
    store.rebuild(rows.where("id % 2 = 1 or id % 3 = 0"))
    both = reader.select(F.lit("before").alias("read"), "id", "cert_month")
    return both.union(store.subjects().select(F.lit("after"), "id", "cert_month"))


@query(f"""WITH {WITH_SUBJECTS}, m AS (SELECT id, ca_id % 3 AS source, ca_id FROM subjects), g AS (SELECT DISTINCT source, ca_id, ca_id * 3 + source AS global_id FROM m WHERE ca_id % 11 > 0),
k AS (SELECT s.id, g.global_id AS ca_id, substr(s.not_before, 1, 7) AS cert_month, coalesce(s.cert_key, concat_ws(':', s.tile_idx, s.entry_idx)) AS key FROM subjects s JOIN g ON g.ca_id = s.ca_id AND g.source = s.ca_id % 3)
SELECT id, ca_id, cert_month FROM (SELECT *, row_number() OVER (PARTITION BY cert_month, key ORDER BY id) AS nth FROM k) WHERE nth = 1""")
def ded12_repartition(spark, sf_dir):
    store = dedup.MonthArchive(spark, scratch_folder(spark, "archive"))
    rows = _pool(spark, sf_dir).withColumn("source", F.col("ca_id") % 3)
    mapping = rows.where("ca_id % 11 > 0").select("source", "ca_id", (F.col("ca_id") * 3 + F.col("source")).alias("global_id")).distinct()
    archive.repartition(rows, mapping, store)
    return store.subjects().select("id", "ca_id", "cert_month")


@query(ORACLES["agg09_dual_count"])
def ded11_incremental(spark, sf_dir):
    """Months are exported in two goes; the second skips those that the first has written."""
    path = scratch_folder(spark, "export")
    rows = subjects(spark, sf_dir)
    export.export_months(spark, rows.where("not_before < '1997'"), path)
    return export.export_months(spark, rows, path)
