"""Host names: three normalisers, wildcard handling, buckets and shard keys, public suffixes."""

from __future__ import annotations

from functools import lru_cache
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OTHER = "_other"
#: Fixed value: suffixes that are always cut into buckets.
LARGE_SUFFIXES = ("com",)
#: Two-part suffixes under which a parent domain has three labels.
TWO_PART_SUFFIXES = ("co.uk", "com.au", "org.uk", "co.nz", "com.br", "co.jp", "co.za", "org.au", "net.au", "gov.uk", "ac.uk", "me.uk")


def _trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def strip_wildcard(c: Column) -> Column:
    """Without one leading `*.`."""
    return F.regexp_replace(c, r"^\*\.", "")


def is_wildcard_name(c: Column) -> Column:
    return F.startswith(c, F.lit("*."))


def normalize(c: Column) -> Column:
    """Export form: trimmed, lower case, only letters, digits, `_`, `.` and `-`, a dot inside; empty if not valid."""
    low = F.lower(_trimmed(c))
    valid = low.rlike(r"^[a-z0-9_-][a-z0-9_.-]*$") & F.contains(low, F.lit(".")) & ~F.endswith(low, F.lit("."))
    return F.when(valid, low).otherwise(F.lit(""))


def norm_fqdn(c: Column) -> Column:
    """Index form, struct(name, wildcard): trimmed, lower case, one final dot and a leading `*.` taken off; not validated."""
    low = F.regexp_replace(F.lower(_trimmed(c)), r"\.$", "")
    return F.struct(strip_wildcard(low).alias("name"), is_wildcard_name(low).alias("wildcard"))


def listing_name(c: Column) -> Column:
    """Listing form: lower case, trimmed, `*.` taken off, the last label of two letters or more; else null."""
    low = strip_wildcard(_trimmed(F.lower(c)))
    return F.when(low.rlike(r"^[a-z0-9._-]+\.[a-z]{2,}$"), low)


def parent_domain(c: Column) -> Column:
    """Last two labels, three under a known two-part suffix; a name of one label is its own parent."""
    name = strip_wildcard(_trimmed(c))
    two, three = F.substring_index(name, ".", -2), F.substring_index(name, ".", -3)
    return F.when(two.isin(*TWO_PART_SUFFIXES), three).otherwise(two)


def first_char_bucket(c: Column) -> Column:
    first = F.substring(c, 1, 1)
    return F.when(first.rlike("^[a-z]$"), first).when(first.rlike("^[0-9]$"), F.lit("0")).otherwise(F.lit(OTHER))


def _label_below(reg: Column, suffix: Column) -> Column:
    """The part of a registrable domain just below its suffix."""
    tail = F.concat(F.lit("."), suffix)
    return F.when(F.endswith(reg, tail), F.substring(reg, F.lit(1), F.length(reg) - F.length(tail))).otherwise(reg)


def export_shard(reg: Column, suffix: Column) -> Column:
    """struct(tld, bucket) of an export shard; reg is null for names without a registrable domain."""
    bucket = F.when(suffix.isin(*LARGE_SUFFIXES), first_char_bucket(_label_below(reg, suffix))).otherwise(F.lit("exports"))
    return F.when(reg.isNull() | (reg == OTHER) | suffix.isNull(), F.struct(F.lit(OTHER).alias("tld"), F.lit("exports").alias("bucket"))).otherwise(F.struct(suffix.alias("tld"), bucket.alias("bucket")))


def registrable_suffix(reg: Column, suffix: Column) -> Column:
    """Suffix of a registrable domain: `_other` stays, a name that is its own suffix too."""
    return F.when(F.coalesce(reg, F.lit("")).isin("", OTHER), F.lit(OTHER)).when(F.coalesce(suffix, F.lit("")) == "", reg).otherwise(suffix)


def label_bucket(reg: Column, suffix: Column) -> Column:
    label = _label_below(reg, suffix)
    return F.when(label == "", F.lit("all")).otherwise(first_char_bucket(label))


def san_shard(reg: Column, suffix: Column) -> Column:
    """struct(suffix, bucket): only large suffixes are cut into buckets."""
    own = registrable_suffix(reg, suffix)
    return F.struct(own.alias("suffix"), F.when(own.isin(*LARGE_SUFFIXES), label_bucket(reg, own)).otherwise(F.lit("all")).alias("bucket"))


def san_shard_name(suffix: Column, bucket: Column) -> Column:
    return F.concat(F.lit("san_"), suffix, F.lit("__"), bucket)


def tail_shard_name(suffix: Column) -> Column:
    return F.concat(F.lit("san__tail__"), first_char_bucket(suffix))


#: Kinds of a public-suffix rule, as bits: a suffix as it stands, one label more than it, an exception to the latter.
EXACT, WILD, EXCEPTION = 1, 2, 4
#: Rules that are sent to all executors at most; the public list has some 10,000.
MOST_RULES = 100_000


class SuffixRules:
    """Public-suffix rules: the longest that fits counts, an exception before a wildcard, `*` if none fits."""

    def __init__(self, text: str):
        self.kinds: dict[str, int] = {}
        for line in text.splitlines():
            rule = line.split()[0] if line.split() else ""
            if not rule or rule.startswith("//"):
                continue
            kind, rule = (EXCEPTION, rule[1:]) if rule[0] == "!" else (WILD, rule[2:]) if rule.startswith("*.") else (EXACT, rule)
            for form in {rule, rule if rule.isascii() else rule.encode("idna").decode()}:
                self.kinds[form] = self.kinds.get(form, 0) | kind
        if len(self.kinds) > MOST_RULES:
            raise ValueError(f"more than {MOST_RULES} public-suffix rules")
        self.depth = max((r.count(".") + 1 for r in self.kinds), default=1)

    def table(self, spark: SparkSession) -> DataFrame:
        """(rule, kinds): at most MOST_RULES rows."""
        return spark.createDataFrame(list(self.kinds.items()), "rule string, kinds int")

    def suffix(self, name: str) -> str:
        """Of one name, on the driver; with_suffix is for tables."""
        labels = name.split(".")
        for i in range(len(labels)):
            kind, parent = self.kinds.get(".".join(labels[i:]), 0), self.kinds.get(".".join(labels[i + 1 :]), 0)
            if kind & EXCEPTION:
                return ".".join(labels[i + 1 :])
            if kind & EXACT or parent & WILD:
                return ".".join(labels[i:])
        return labels[-1]

    def registrable(self, name: str) -> str | None:
        if not name or name[0] == "." or name[-1] == "." or ".." in name:
            return None
        suffix = self.suffix(name)
        if len(name) <= len(suffix):
            return None
        return name[: -len(suffix) - 1].rpartition(".")[2] + "." + suffix


@lru_cache(maxsize=1)
def suffix_rules() -> SuffixRules:
    """Rules of the list that is part of this package (data/README.md says where it is from)."""
    return SuffixRules((resources.files(__package__.rpartition(".")[0]) / "data" / "public_suffix_list.dat").read_text("utf-8"))


def read_suffix_rules(spark: SparkSession, path: str) -> SuffixRules:
    """Rules of a list of the caller's own, read by Spark; a list of more than MOST_RULES lines without remarks is refused."""
    lines = spark.read.text(path).where("trim(value) <> '' and not startswith(trim(value), '//')").limit(MOST_RULES + 1).collect()
    return SuffixRules("\n".join(r.value for r in lines))


def _label_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("."), F.lit(""))) + 1


def with_suffix(rows: DataFrame, name: str, rules: SuffixRules | None = None, suffix: str = "suffix", registrable: str = "registrable") -> DataFrame:
    """rows with the public suffix of a name and its registrable domain, null if it has none.

    The last 1, 2, ... labels of a name are each looked up among the rules by a broadcast join, as many joins as the
    longest rule has labels; rows aren't shuffled, and no Python worker runs.
    """
    own, c = rules or suffix_rules(), F.col(name)
    table, labels = own.table(rows.sparkSession), _label_count(c)
    tail = lambda d: F.substring_index(c, ".", -d)
    kept = rows.columns
    kinds = [F.lit(0)]
    for d in range(1, own.depth + 1):
        rows = rows.join(F.broadcast(table.toDF(f"own_rule{d}", f"own_kinds{d}")), F.when(labels >= d, tail(d)) == F.col(f"own_rule{d}"), "left")
        kinds.append(F.coalesce(F.col(f"own_kinds{d}"), F.lit(0)))
    kinds.append(F.lit(0))
    found = F.when(F.lit(False), c)
    for d in range(own.depth + 1, 0, -1):
        if d > 1:
            found = found.when(kinds[d].bitwiseAND(EXCEPTION) > 0, tail(d - 1))
        found = found.when((labels >= d) & ((kinds[d].bitwiseAND(EXACT) > 0) | (kinds[d - 1].bitwiseAND(WILD) > 0)), tail(d))
    rows = rows.select(*(F.col(f"`{k}`") for k in kept), found.otherwise(tail(1)).alias(suffix))
    own_suffix = F.col(suffix)
    has = ~F.startswith(c, F.lit(".")) & ~F.endswith(c, F.lit(".")) & ~F.contains(c, F.lit("..")) & (F.length(c) > F.length(own_suffix))
    return rows.withColumn(registrable, F.when(has, F.call_function("substring_index", c, F.lit("."), -(_label_count(own_suffix) + 1))))


def last_two_labels(c: Column) -> Column:
    """Registrable domain where every suffix has one label: a native stand-in for hosts known to be such."""
    return F.when(F.contains(c, F.lit(".")), F.substring_index(c, ".", -2)).otherwise(F.lit(OTHER))
