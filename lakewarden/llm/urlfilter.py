"""Operator 4 [native]: URL filters whose rules are indexed by their rarest literal token.

A rule is a site rule `host/path`, which fits the host and its subdomains if the URL's path starts with the rule's, or
a pattern, a regular expression over the whole lower-cased URL. The literal tokens of a rule are the runs of letters
and digits that a fitting URL must hold as whole tokens. Each rule is filed under the one of them that is rarest in the
URLs at hand; the tokens of a URL fetch the rules filed under them, and only those run their regular expressions. A
rule without such a token runs on every URL, so no rule is lost. Site rules go before patterns; among the fitting
rules of a kind the longest wins, ties by the smaller text.

Everything is DataFrame functions. The index is broadcast while it has at most BROADCAST_RULES rules, which bounds its
size; a longer one is joined by shuffle. Exploded tokens meet the index before anything is shuffled, so what is
grouped is one row per fitting rule, keyed by row and URL.

Defined results: a null URL, or one without `://`, has an empty host and path; only patterns can fit it. Repeated rows
keep their number, equal ids with different URLs are judged apart, other columns are never read. URLs are read whole however
long they are, each different token of them once. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_RULES = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = re.compile(r"[a-z0-9]+")

#: (rule, verdict)
SITE_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: (name, regular expression over the lower-cased URL, its literal tokens, verdict); the tokens stand whole in any match
PATTERN_RULES = (
    ("wordpress-admin", r"/wp-admin(?:/|$)", ("wp", "admin"), "block"),
    ("login", r"/(?:user/)?login(?:[/?.]|$)", ("login",), "block"),
    ("shopping-cart", r"/(?:shop/)?cart(?:[/?]|$)", ("cart",), "block"),
    ("casino-host", r"://(?:[^/?#]*\.)?casino\.", ("casino",), "block"),
    ("archive-file", r"^[^?#]*\.(?:zip|exe|iso|dmg)(?:[?#]|$)", (), "block"),
    ("session-id", r"[?&]phpsessid=", ("phpsessid",), "block"),
)


@dataclass(frozen=True)
class Rule:
    name: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str
    site: bool

    @staticmethod
    def of_site(text: str, verdict: str) -> Rule:
        """Host and path of `host/path`; the path's last run may go on in a URL, so it is no token."""
        host, slash, path = text.partition("/")
        host = host.translate(str.maketrans(UPPER, LOWER))
        cut = path[: len(path) - len(re.search(r"[A-Za-z0-9]*\Z", path)[0])]
        escaped = "".join("\\" + c if not (c.isalnum() or c in "_/- ") else c for c in slash + path)
        regex = r"\A(?:[^/]*\.)?" + "".join("\\" + c if not c.isalnum() else c for c in host) + (escaped or r"(?:/|\z)")
        return Rule(text, regex, tuple(sorted({*RUN.findall(host), *RUN.findall(cut.lower())})), verdict, True)


def rules_of(site_rules=SITE_RULES, pattern_rules=PATTERN_RULES) -> list[Rule]:
    return [Rule.of_site(t, v) for t, v in site_rules] + [Rule(n, r, tuple(sorted(t)), v, False) for n, r, t, v in pattern_rules]


RULE_TYPE = "array<struct<id: int, name: string, regex: string, tokens: array<string>, verdict: string, site: boolean>>"


def _rows(spark, rules: list[Rule]) -> DataFrame:
    data = json.dumps([{"id": i, "name": r.name, "regex": r.regex, "tokens": list(r.tokens), "verdict": r.verdict, "site": r.site} for i, r in enumerate(rules)])
    return spark.range(1).select(F.inline(F.from_json(F.lit(data), RULE_TYPE)))


def filter_urls(pages: DataFrame, rules: list[Rule] | None = None, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, method_rule): rule is the site rule that fits, else null."""
    rules = rules_of() if rules is None else rules
    spark = pages.sparkSession
    kind = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)
    parts = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"))
    after = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    parts = parts.withColumn("after", after)
    parts = parts.withColumn("raw", F.regexp_extract("after", r"\A[^/?#]*", 0))
    parts = parts.select("page_id", "url", F.translate("raw", UPPER, LOWER).alias("host"), F.regexp_extract(F.expr("substring(after, char_length(raw) + 1)"), r"\A[^?#]*", 0).alias("path"), F.translate("url", UPPER, LOWER).alias("low"))
    tokens = parts.select("page_id", "url", "host", "path", "low", F.explode(F.array_distinct(F.split("low", "[^a-z0-9]+"))).alias("token"))

    index = _rows(spark, [r for r in rules if r.tokens]) if any(r.tokens for r in rules) else None
    found = None
    if index is not None:
        filed = index.select("id", F.explode("tokens").alias("token"))
        counts = tokens.join(kind(filed.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("n"))
        rarest = filed.join(counts, "token", "left").groupBy("id").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
        index = index.drop("tokens").join(rarest, "id")
        found = tokens.join(kind(index), "token").where(F.expr("if(site, concat(host, path), low) rlike regex"))
        found = found.select("page_id", "url", F.struct((~F.col("site")).alias("kind"), (-F.length("name")).alias("size"), "name", "verdict").alias("fit"))
    always = [r for r in rules if not r.tokens]
    if always:
        tests = [F.when((F.concat("host", "path") if r.site else F.col("low")).rlike(r.regex), F.struct(F.lit(not r.site).alias("kind"), F.lit(-len(r.name)).alias("size"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))) for r in always]
        hits = parts.select("page_id", "url", F.explode(F.filter(F.array(*tests), lambda x: x.isNotNull())).alias("fit"))
        found = hits if found is None else found.union(hits)
    if found is None:
        best = parts.where("false").select("page_id", "url", F.lit(None).cast("struct<kind: boolean, size: int, name: string, verdict: string>").alias("fit"))
    else:
        best = found.groupBy("page_id", "url").agg(F.min("fit").alias("fit"))
    best = best.select(F.col("page_id").alias("k"), F.col("url").alias("u"), "fit")
    out = parts.join(best, parts.page_id.eqNullSafe(best.k) & parts.url.eqNullSafe(best.u), "left")
    site = ~F.col("fit.kind")
    return out.select("page_id", "host", "path", F.when(site, F.col("fit.name")).alias("rule"), F.coalesce("fit.verdict", F.lit(default)).alias("verdict"), F.when(~site, F.col("fit.name")).alias("method_rule"))


def _sql_regex(regex: str) -> str:
    return regex.replace("'", "''")


def oracle(rules: list[Rule] | None = None, default: str = "allow") -> str:
    """DuckDB SQL of filter_urls over `pages`, each rule tried on each URL."""
    rules = rules_of() if rules is None else rules
    order = sorted(rules, key=lambda r: (not r.site, -len(r.name), r.name))
    whens = " ".join(f"WHEN regexp_matches({'host || path' if r.site else 'low'}, '{_sql_regex(r.regex)}') THEN {i}" for i, r in enumerate(order))
    verdicts = " ".join(f"WHEN {i} THEN '{r.verdict}'" for i, r in enumerate(order))
    names = " ".join(f"WHEN {i} THEN '{r.name}'" for i, r in enumerate(order) if r.site)
    methods = " ".join(f"WHEN {i} THEN '{r.name}'" for i, r in enumerate(order) if not r.site)
    return f"""
WITH a AS (SELECT page_id, url, translate(url, '{UPPER}', '{LOWER}') AS low, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM a),
c AS (SELECT page_id, host, path, CASE {whens} END AS fit FROM b)
SELECT page_id, host, path, CASE fit {names or "WHEN -1 THEN ''"} END AS rule, CASE fit {verdicts or "WHEN -1 THEN ''"} ELSE '{default}' END AS verdict, CASE fit {methods or "WHEN -1 THEN ''"} END AS method_rule FROM c"""
