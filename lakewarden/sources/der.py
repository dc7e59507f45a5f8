"""Metadata of X.509 certificates from DER, without a certificate library.

A small reader of tag, length, value. What can't be read is null; a broken extension leaves the rest.
"""

from __future__ import annotations

import ipaddress
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Object identifiers in DER.
NAMES = {bytes.fromhex("550403"): "common_name", bytes.fromhex("55040a"): "organization", bytes.fromhex("550408"): "state", bytes.fromhex("550406"): "country"}
ALT_NAMES = bytes.fromhex("551d11")

TEXTS = ("serial_number", "common_name", "organization", "state", "country", "not_before", "not_after")
SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in TEXTS]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in ("san_domains", "san_ips")]
    + [T.StructField(c, T.BinaryType()) for c in ("issuer_name", "subject_name")]
    + [T.StructField("ok", T.BooleanType())]
)


def read(data: bytes, at: int = 0) -> tuple[int, bytes, int]:
    """Tag, value and end of the element at a place."""
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 0 < n <= 4:
            raise ValueError("length")
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
    if at + size > len(data):
        raise ValueError("short")
    return tag, data[at : at + size], at + size


def children(data: bytes):
    at = 0
    while at < len(data):
        tag, value, at = read(data, at)
        yield tag, value


def _text(tag: int, value: bytes) -> str:
    return value.decode("utf-16-be" if tag == 0x1E else "utf-8" if tag == 0x0C else "latin-1", errors="replace")


def _time(tag: int, value: bytes) -> str:
    s = value.decode("ascii")
    if tag == 0x17:
        s = ("19" if int(s[:2]) >= 50 else "20") + s
    return datetime.strptime(s.rstrip("Z")[:14], "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _name(value: bytes) -> dict[str, str]:
    """First value of each attribute."""
    out: dict[str, str] = {}
    for _, group in children(value):
        for _, pair in children(group):
            (_, oid), (tag, text) = list(children(pair))[:2]
            if oid in NAMES:
                out.setdefault(NAMES[oid], _text(tag, text))
    return out


def parse(der: bytes) -> dict:
    """Metadata of a certificate or of a bare TBSCertificate."""
    out: dict = dict.fromkeys((*TEXTS, "issuer_name", "subject_name"))
    out |= {"san_domains": [], "san_ips": [], "ok": False}
    try:
        parts = list(children(read(der)[1]))
        if parts[0][0] == 0x30:  # a certificate: its first part is the TBSCertificate
            parts = list(children(parts[0][1]))
        if parts[0][0] == 0xA0:
            parts = parts[1:]
        out["serial_number"] = parts[0][1].lstrip(b"\0").hex()
        out["issuer_name"], out["subject_name"] = parts[2][1], parts[4][1]
        (t1, v1), (t2, v2) = list(children(parts[3][1]))[:2]
        out["not_before"], out["not_after"] = _time(t1, v1), _time(t2, v2)
        out |= _name(parts[4][1])
        out["ok"] = True
        for tag, value in parts[6:]:
            if tag == 0xA3:
                for _, ext in children(read(value)[1]):
                    fields = list(children(ext))
                    if fields[0][1] == ALT_NAMES:
                        for kind, name in children(read(fields[-1][1])[1]):
                            if kind == 0x82:
                                out["san_domains"].append(name.decode("ascii", errors="replace"))
                            elif kind == 0x87 and len(name) in (4, 16):
                                out["san_ips"].append(str(ipaddress.ip_address(name)))
    except (ValueError, IndexError, UnicodeDecodeError):
        pass
    return out


@F.pandas_udf(SCHEMA)
def certificate(der: pd.Series) -> pd.DataFrame:
    """struct of metadata of each DER value; ok is false where validity or subject can't be read."""
    return pd.DataFrame([parse(bytes(x)) if x is not None else parse(b"") for x in der], columns=SCHEMA.names)
