"""Partition files of raw records in protobuf wire form, plain or gzipped, and their names."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranges import parse_range_name
from ..schemas import RAW_ENTRIES

#: Field numbers of a record, of a batch, and names of its enumerations.
ENTRY_FIELDS = {1: "index", 2: "timestamp_ms", 3: "entry_type", 4: "source", 5: "leaf_input", 8: "precertificate", 9: "issuer_key_hash", 10: "chain_fingerprints"}
BATCH_LOG, BATCH_ENTRIES = 1, 2
ENTRY_TYPES = {0: "unspecified", 1: "x509", 2: "precert"}
SOURCES = {0: "unspecified", 1: "rfc6962", 2: "static"}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def fields(data: bytes):
    """(number, value) of the varint and length-delimited fields of a message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 0x7F) << shift
            if b < 0x80:
                return n
            shift += 7

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            if at + size > end:
                raise ValueError("short message")
            at += size
            yield key >> 3, data[at - size : at]
        else:
            raise ValueError(f"wire type {kind}")


def decode_entry(data: bytes) -> dict:
    out: dict = {"index": 0, "timestamp_ms": 0, "entry_type": 0, "source": 0, "chain_fingerprints": []}
    for number, value in fields(data):
        name = ENTRY_FIELDS.get(number)
        if name == "chain_fingerprints":
            out[name].append(value)
        elif name:
            out[name] = value - (1 << 64) if isinstance(value, int) and value >> 63 else value
    return out | {"entry_type": ENTRY_TYPES.get(out["entry_type"], "unspecified"), "source": SOURCES.get(out["source"], "unspecified")}


def encode_batch(entries: list[dict], log_id: bytes = b"") -> bytes:
    """A batch message; equal entries give equal bytes."""
    sized = lambda number, value: _varint(number << 3 | 2) + _varint(len(value)) + value
    kinds, sources = ({v: k for k, v in d.items()} for d in (ENTRY_TYPES, SOURCES))
    out = sized(BATCH_LOG, sized(1, log_id)) if log_id else b""
    for e in entries:
        body = b""
        for number, name in ENTRY_FIELDS.items():
            value = e.get(name)
            value = kinds.get(value, 0) if name == "entry_type" else sources.get(value, 0) if name == "source" else value
            if name == "chain_fingerprints":
                body += b"".join(sized(number, x) for x in value or ())
            elif isinstance(value, bytes) and value:
                body += sized(number, value)
            elif isinstance(value, int) and value:
                body += _varint(number << 3) + _varint(value)
        out += sized(BATCH_ENTRIES, body)
    return out


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Records of all partition files below a folder; a file that can't be read fails the job."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(parse_range_name(F.regexp_extract("path", "[^/]+$", 0)).isNotNull())
    names = [c.split()[0] for c in RAW_ENTRIES.split(", ")]

    def run(frames):
        for f in frames:
            for name, content in zip(f["path"], f["content"], strict=True):
                data = gzip.decompress(content) if name.endswith(".gz") else bytes(content)
                rows = [decode_entry(v) for n, v in fields(data) if n == BATCH_ENTRIES]
                yield pd.DataFrame([[r.get(c) for c in names] for r in rows], columns=names)

    return files.select("path", "content").mapInPandas(run, RAW_ENTRIES)


def partition_files(entries: DataFrame, compress: bool = False) -> DataFrame:
    """(day, name, content): one file for each contiguous run of indices within a UTC day, ready to be written.

    A run is cut at RUN_ROWS indices, so that no task holds more.
    """
    from ..functions.certs import entry_day
    from ..functions.ranges import range_name
    from ..operators.intervals import day_runs

    dated = entries.withColumn("day", entry_day(F.col("timestamp_ms"))).withColumn("part", F.floor(F.col("index") / RUN_ROWS))
    runs = day_runs(dated.withColumn("key", F.concat_ws("|", "day", "part")), "index", "key")
    runs = runs.select(F.split("day", r"\|")[0].alias("day"), F.split("day", r"\|")[1].cast("long").alias("part"), "first", "last")
    met = dated.join(runs, ["day", "part"]).where(F.col("index").between(F.col("first"), F.col("last")))

    def write(key, f):
        rows = f.sort_values("index").drop_duplicates("index").to_dict("records")
        data = encode_batch([{k: list(map(bytes, v)) if k == "chain_fingerprints" and v is not None else v for k, v in r.items()} for r in rows])
        if compress:
            data = gzip.compress(data, mtime=0)
        return pd.DataFrame([[key[0], int(key[1]), int(key[2]), data]], columns=["day", "first", "last", "content"])

    out = met.groupBy("day", "first", "last").applyInPandas(write, "day string, first long, last long, content binary")
    return out.select("day", range_name(F.col("first"), F.col("last"), compress).alias("name"), "content")


RUN_ROWS = 65_536


def file_ranges(files: DataFrame, path: str = "path") -> DataFrame:
    """(start, end) of the partition files among paths; other names are left out."""
    r = parse_range_name(F.regexp_extract(path, "[^/]+$", 0))
    return files.select(r.alias("r")).where("r is not null").select("r.start", "r.end")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below a folder; none if there is no such folder."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, length long")


