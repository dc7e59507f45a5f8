"""Base-36 names of index ranges, and tile paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME = r"^([0-9a-z]+)-([0-9a-z]+)\.binpb(?:\.gz)?$"


def to_base36(n: Column) -> Column:
    return F.lower(F.conv(n.cast("string"), 10, 36))


def from_base36(text: Column) -> Column:
    """Null for anything but digits and lower-case letters within 63 bits."""
    n = F.conv(text, 36, 10).cast("long")
    return F.when(text.rlike("^[0-9a-z]{1,13}$"), n)


def range_name(first: Column, last: Column, gzip: bool = False) -> Column:
    return F.concat(to_base36(first), F.lit("-"), to_base36(last), F.lit(".binpb.gz" if gzip else ".binpb"))


def parse_range_name(name: Column) -> Column:
    """struct(start, end) with end exclusive; null for other names and for last < first."""
    first, last = (from_base36(F.regexp_extract(name, NAME, k)) for k in (1, 2))
    return F.when(name.rlike(NAME) & (last >= first), F.struct(first.alias("start"), (last + 1).alias("end")))


def tile_path(n: Column) -> Column:
    """Groups of three digits, all but the last with `x`: 1234067 is `x001/x234/067`."""
    digits = n.cast("string")
    padded = F.lpad(digits, (F.ceil(F.length(digits) / 3) * 3).cast("int"), F.lit("0"))
    return F.regexp_replace(padded, r"(\d{3})(?=\d)", "x$1/")
