"""Columns derived from certificate metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"


def cert_month(not_before: Column) -> Column:
    """`YYYY-MM` of a text time; `unknown` if it is null or shorter than that."""
    return F.when(F.length(not_before) >= 7, F.substring(not_before, 1, 7)).otherwise(F.lit(UNKNOWN))


def split_list(text: Column) -> Column:
    """Items of a comma-joined list; empty for null and empty text."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def subject_url(sans: Column, common_name: Column) -> Column:
    """https address of the first name without `*.`, else of the first name without its `*.`, else of the common name."""
    plain = F.try_element_at(F.filter(sans, lambda x: ~F.startswith(x, F.lit("*."))), F.lit(1))
    first = F.regexp_replace(F.try_element_at(sans, F.lit(1)), r"^\*\.", "")
    name = F.coalesce(plain, first, common_name, F.lit(""))
    return F.when(name == "", F.lit("")).otherwise(F.concat(F.lit("https://"), name))


def has_wildcard(sans: Column) -> Column:
    return F.coalesce(F.exists(sans, lambda x: F.startswith(x, F.lit("*."))), F.lit(False)).cast("int")


def name_count(sans: Column) -> Column:
    return F.coalesce(F.size(sans), F.lit(0))


def cert_hash(der: Column) -> Column:
    return F.unhex(F.sha2(der, 256))


def dedup_key(cert_hash_: Column, tile: Column, entry: Column) -> Column:
    """The hash where there is one, else tile and entry; null if all are."""
    return F.coalesce(F.hex(cert_hash_), F.when(tile.isNotNull() & entry.isNotNull(), F.concat_ws(":", tile, entry)))


def entry_day(timestamp_ms: Column, hour: bool = False) -> Column:
    """UTC day, or day and hour, of epoch milliseconds."""
    return F.date_format(F.timestamp_millis(timestamp_ms), "yyyy-MM-dd/HH" if hour else "yyyy-MM-dd")


def coverage_percent(stored: Column, tree_size: Column) -> Column:
    return F.when(tree_size > 0, stored / tree_size * 100).otherwise(F.lit(0.0))


def progress_percent(done: Column, total: Column) -> Column:
    return F.when(total > 0, F.least(done / total * 100, F.lit(100.0))).otherwise(F.lit(0.0))


def one_decimal(x: Column) -> Column:
    """A number of 0 or more with one decimal as C and Go print it: its exact value decides, a tie goes to even.

    format_string rounds the shortest decimal text of a double half up: 1.65, a little less in truth, becomes 1.7. From
    2^48 on it is used all the same.
    """
    x = x.cast("double")
    twice = x * 16 + x * 4  # both terms are exact, so 20 x is exactly twice + rest
    rest = x * 4 - (twice - x * 16)
    tenths = F.floor(twice / 2)
    middle = tenths * 2 + 1
    up = (twice > middle) | ((twice == middle) & ((rest > 0) | ((rest == 0) & (tenths % 2 == 1))))
    tenths += up.cast("long")
    whole = ((tenths - tenths % 10) / 10).cast("long")
    return F.when(x >= 2.0**48, F.format_string("%.1f", x)).otherwise(F.concat(whole.cast("string"), F.lit("."), (tenths % 10).cast("string")))


def bytes_text(n: Column) -> Column:
    """Bytes with binary units, one decimal from KiB on."""
    out = F.concat(n.cast("string"), F.lit(" B"))
    for k, unit in enumerate("KMGTPE", 1):
        out = F.when(n >= 1024**k, F.concat(one_decimal(n / float(1024**k)), F.lit(f" {unit}iB"))).otherwise(out)
    return out


def thousands(n: Column) -> Column:
    """A whole number with a comma between its thousands."""
    return F.format_number(n, 0)


def eta_text(seconds: Column) -> Column:
    """`~Xs` below 90 seconds, `~Xm` below 90 minutes, else `~X.Xh`."""
    return F.when(seconds < 90, F.format_string("~%.0fs", seconds)).when(seconds < 5400, F.format_string("~%.0fm", seconds / 60)).otherwise(F.concat(F.lit("~"), one_decimal(seconds / 3600), F.lit("h")))


def svcb_params(params: Column) -> Column:
    """`key=hex` pairs joined with spaces, from array<struct<key, value: binary>>."""
    return F.array_join(F.transform(params, lambda p: F.concat(p["key"], F.lit("="), F.lower(F.hex(p["value"])))), " ")


#: Requests a second by log operator.
OPERATOR_RATE = {
    "Let's Encrypt": 30.0,
    "Google": 25.0,
    "Cloudflare": 15.0,
    "Geomys": 1.0,
    "IPng Networks": 4.0,
    "TrustAsia": 8.0,
    "DigiCert": 12.0,
    "Sectigo": 12.0,
}
#: Requests a second of other operators by protocol, and of all the rest.
PROTOCOL_RATE, OTHER_RATE = {"static": 5.0, "rfc6962": 5.0}, 3.0


def request_rate(operator: Column, protocol: Column) -> Column:
    """Rate of a log by its operator, else by its protocol, else the least one."""
    by = lambda c, rates: F.try_element_at(F.create_map([F.lit(x) for pair in rates.items() for x in pair]), c)
    return F.coalesce(by(operator, OPERATOR_RATE), by(protocol, PROTOCOL_RATE), F.lit(OTHER_RATE))
