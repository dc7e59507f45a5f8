"""IP addresses as 16-byte keys of one order, CIDR bounds, and shards of the key space."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
V4 = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
V4_PREFIX = "00000000000000000000FFFF"


def v4_key(text: Column) -> Column:
    """16-byte key of a dotted quad without leading zeros; null for anything else."""
    hexes = F.array_join(F.transform(F.split(text, r"\."), lambda o: F.lpad(F.hex(o.cast("int")), 2, "0")), "")
    return F.when(text.rlike(V4), F.unhex(F.concat(F.lit(V4_PREFIX), hexes)))


def v6_key(text: Column) -> Column:
    """16-byte key of an IPv6 address in any of its forms; null for anything else.

    Eight groups of up to four hex digits, or fewer around one `::`, which stands for one zero group at least. The last
    two may be a dotted quad. A zone after `%` is left out; an empty one is an error.
    """
    bare = F.regexp_replace(text, "%.+$", "")
    tail = F.substring_index(bare, ":", -1)
    octets = F.transform(F.split(tail, r"\."), lambda o: F.lpad(F.hex(o.cast("int")), 2, "0"))
    quad = F.concat(F.get(octets, F.lit(0)), F.get(octets, F.lit(1)), F.lit(":"), F.get(octets, F.lit(2)), F.get(octets, F.lit(3)))
    head = F.substring(bare, F.lit(1), F.length(bare) - F.length(tail))
    plain = F.when(~F.contains(bare, F.lit(".")), bare).when(F.contains(bare, F.lit(":")) & tail.rlike(V4), F.concat(head, quad))
    hexes = lambda a: F.array_join(F.transform(a, lambda g: F.lpad(g, 4, "0")), "")

    def halves(p: Column) -> Column:
        groups = lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ":"))
        short, at = F.contains(p, F.lit("::")), F.instr(p, "::")
        left = groups(F.when(short, F.substring(p, F.lit(1), at - 1)).otherwise(p))
        right = F.when(short, groups(F.substring(p, at + 2, F.length(p)))).otherwise(F.array().cast("array<string>"))
        return F.struct(short.alias("short"), left.alias("left"), right.alias("right"))

    def key(x: Column) -> Column:
        n = F.size(x["left"]) + F.size(x["right"])
        fits = F.when(x["short"], n <= 7).otherwise(n == 8) & F.forall(F.concat(x["left"], x["right"]), lambda g: g.rlike("^[0-9A-Fa-f]{1,4}$"))
        return F.when(fits, F.unhex(F.concat(hexes(x["left"]), F.repeat(F.lit("0000"), F.greatest(F.lit(0), 8 - n)), hexes(x["right"]))))

    # arrays of one value hold what several places use, so that it is evaluated once
    found = F.transform(F.transform(F.array(plain), halves), key)
    return F.when(F.contains(text, F.lit(":")), found[0])


def ip_version(key: Column) -> Column:
    """4 for keys of mapped addresses, else 6."""
    return F.when(F.hex(F.substring(key, 1, 12)) == V4_PREFIX, F.lit(4)).otherwise(F.lit(6))


def key16(addresses: DataFrame, text: str = "address", v6: bool = True, dropped: Observation | None = None) -> DataFrame:
    """addresses with ip and ver; rows that are no address are dropped, and counted as `dropped` of an observation."""
    trimmed = F.regexp_replace(F.col(text), r"^\s+|\s+$", "")
    rows = addresses.withColumn("ip_text", trimmed)
    key = v4_key(F.col("ip_text"))
    rows = rows.withColumn("ip", F.coalesce(key, v6_key(F.col("ip_text"))) if v6 else key).drop("ip_text")
    if dropped is not None:
        rows = rows.observe(dropped, F.count_if(F.col("ip").isNull()).alias("dropped"))
    return rows.where("ip is not null").withColumn("ver", ip_version(F.col("ip")))


def cidr_bounds(cidr: str) -> tuple[bytes, bytes, int]:
    """Inclusive least and greatest key of a CIDR, and its version; a mapped prefix counts as version 4."""
    net = ipaddress.ip_network(cidr, strict=False)
    if net.version == 6 and net.prefixlen >= 96 and net.network_address.ipv4_mapped:
        net = ipaddress.ip_network(f"{net.network_address.ipv4_mapped}/{net.prefixlen - 96}")
    pad = bytes(10) + b"\xff\xff" if net.version == 4 else b""
    return pad + net.network_address.packed, pad + net.broadcast_address.packed, net.version


def shard_name(ip: Column, ver: Column, width: int = 1) -> Column:
    """Name of the shard by the first `width` bytes of an address: `v4_a_b` or `v6_hhhh`."""
    byte = lambda at: F.conv(F.hex(F.substring(ip, at, 1)), 16, 10)
    four = F.concat(F.lit("v4"), *(F.concat(F.lit("_"), byte(13 + k)) for k in range(width)))
    six = F.concat(F.lit("v6_"), F.lower(F.hex(F.substring(ip, 1, width))))
    return F.when(ver == 4, four).otherwise(six)


def shard_names_of(cidr: str, width: int = 1) -> list[str]:
    """Names of all shards of a width that a CIDR overlaps."""
    lo, hi, ver = cidr_bounds(cidr)
    at = 12 if ver == 4 else 0
    first, last = (int.from_bytes(x[at : at + width], "big") for x in (lo, hi))
    parts = (n.to_bytes(width, "big") for n in range(first, last + 1))
    return ["v4_" + "_".join(map(str, p)) if ver == 4 else "v6_" + p.hex() for p in parts]


def in_cidr(ip: Column, cidr: str) -> Column:
    lo, hi, _ = cidr_bounds(cidr)
    return ip.between(F.lit(bytearray(lo)), F.lit(bytearray(hi)))
