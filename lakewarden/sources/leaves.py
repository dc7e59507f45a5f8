"""Log entries from captured bytes: tiles, get-entries pages, leaf inputs, issuer chains."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILE = 256
LEAF = "index long, timestamp_ms long, entry_type string, certificate binary, issuer_key_hash binary, precertificate binary, chain_fingerprints array<binary>, chain array<binary>, leaf_input binary, error string"


class Short(ValueError):
    """Bytes end before an element does."""


class Cursor:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise Short(f"{n} bytes at {self.at} of {len(self.data)}")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self, size: int) -> int:
        return int.from_bytes(self.take(size), "big")

    def sized(self, size: int) -> bytes:
        return self.take(self.number(size))

    @property
    def more(self) -> bool:
        return self.at < len(self.data)


def _entry(c: Cursor) -> dict:
    """What a tile leaf and a Merkle leaf share: time, type, certificate or key hash and TBS, extensions."""
    time, kind = c.number(8), c.number(2)
    out = {"timestamp_ms": time, "issuer_key_hash": None, "precertificate": None}
    if kind == 0:
        out |= {"entry_type": "x509", "certificate": c.sized(3)}
    elif kind == 1:
        out |= {"entry_type": "precert", "issuer_key_hash": c.take(32), "certificate": c.sized(3)}
    else:
        raise ValueError(f"entry type {kind}")
    out["extensions"] = c.sized(2)
    return out


def merkle_leaf(entry: dict) -> bytes:
    """The leaf input that an entry stands for."""
    body = struct.pack(">BBQH", 0, 0, entry["timestamp_ms"], entry["entry_type"] == "precert")
    body += entry["issuer_key_hash"] or b""
    return body + len(entry["certificate"]).to_bytes(3, "big") + entry["certificate"] + len(entry["extensions"]).to_bytes(2, "big") + entry["extensions"]


def tile_leaves(data: bytes, max_entries: int = 0) -> Iterator[dict]:
    """Leaves of a data tile; the end of the bytes between leaves, or inside one, ends the tile quietly."""
    c, n = Cursor(data), 0
    while c.more and (max_entries <= 0 or n < max_entries):
        try:
            out = _entry(c)
            if out["entry_type"] == "precert":
                out["precertificate"] = c.sized(3)
            prints = c.sized(2)
        except Short:
            return
        out["chain_fingerprints"] = [prints[i : i + 32] for i in range(0, len(prints) - 31, 32)]
        out["leaf_input"] = merkle_leaf(out)
        yield out
        n += 1


def leaf_input(data: bytes) -> dict:
    """Entry of a version 0 Merkle tree leaf."""
    c = Cursor(data)
    version, kind = c.number(1), c.number(1)
    if version or kind:
        raise ValueError(f"leaf version {version}, type {kind}")
    return _entry(c)


def extra_data(data: bytes, entry_type: str) -> dict:
    """Precertificate, if it is one, and the chain with its fingerprints."""
    c = Cursor(data)
    out = {"precertificate": c.sized(3) if entry_type == "precert" else None}
    chain = Cursor(c.sized(3))
    out["chain"] = []
    while chain.more:
        out["chain"].append(chain.sized(3))
    out["chain_fingerprints"] = [hashlib.sha256(x).digest() for x in out["chain"]]
    return out


#: What names a leaf's log: its id, and a number below LOGS, which makes ids of entries unique across logs.
LOG, LOGS = ("log_id", "log_no"), 1024
COLUMNS = [c.split()[0] for c in LEAF.split(", ")]


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame([[r.get(c) for c in COLUMNS] for r in rows], columns=COLUMNS)


def _carried(rows: DataFrame) -> tuple[list[str], str]:
    """Columns that name a leaf's log, which readers pass on, and the schema with them."""
    kinds = dict(rows.dtypes)
    names = [c for c in LOG if c in kinds]
    return names, "".join(f", {c} {kinds[c]}" for c in names)


def leaves_of_tiles(files: DataFrame) -> DataFrame:
    """Leaves of rows (tile, content), with their index; log_id and log_no are passed on if there are any."""
    names, schema = _carried(files)

    def run(frames):
        for f in frames:
            for k, (tile, content) in enumerate(zip(f["tile"], f["content"], strict=True)):
                out = _frame([{**x, "index": tile * TILE + i} for i, x in enumerate(tile_leaves(bytes(content)))])
                yield out.assign(**{c: f[c].iloc[k] for c in names})

    return files.select("tile", "content", *names).mapInPandas(run, LEAF + schema)


def read_tiles(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Leaves of captured data tiles below a folder `.../tile/data/`, with their index; first and last cut the range, both included."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    digits = F.regexp_replace(F.regexp_extract("path", r"((?:x\d{3}/)*\d{3})(?:\.p/\d+)?$", 1), r"\D", "")
    files = files.withColumn("tile", digits.try_cast("long")).where("tile is not null")
    if first is not None:
        files = files.where(F.col("tile") >= first // TILE)
    if last is not None:
        files = files.where(F.col("tile") <= last // TILE)

    rows = leaves_of_tiles(files)
    if first is not None:
        rows = rows.where(F.col("index") >= first)
    return rows if last is None else rows.where(F.col("index") <= last)


def parse_leaves(pages: DataFrame) -> DataFrame:
    """Leaves of rows (index, leaf_input, extra_data); what can't be read keeps its index and an error.

    log_id and log_no are passed on if there are any.
    """
    names, schema = _carried(pages)

    def run(frames):
        for f in frames:
            rows = []
            for index, leaf, extra in zip(f["index"], f["leaf_input"], f["extra_data"], strict=True):
                row: dict = {"index": index, "leaf_input": leaf}
                try:
                    row |= leaf_input(bytes(leaf))
                    row |= extra_data(bytes(extra), row["entry_type"])
                except (ValueError, TypeError) as e:
                    row["error"] = str(e)
                rows.append(row)
            yield _frame(rows).assign(**{c: f[c].to_numpy() for c in names})

    return pages.select("index", "leaf_input", "extra_data", *names).mapInPandas(run, LEAF + schema)


def read_pages(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(index, leaf_input, extra_data) of captured get-entries pages, JSON files named by their first index; first and
    last cut the range, both included.
    """
    schema = "entries array<struct<leaf_input: string, extra_data: string>>"
    pages = spark.read.schema(schema).option("wholetext", "true").option("multiLine", "true").json(path).withColumn("start", F.regexp_extract(F.input_file_name(), r"(\d+)[^/]*$", 1).try_cast("long"))
    rows = pages.select("start", F.posexplode("entries").alias("pos", "e"))
    rows = rows.select((F.col("start") + F.col("pos")).alias("index"), F.unbase64("e.leaf_input").alias("leaf_input"), F.unbase64("e.extra_data").alias("extra_data"))
    rows = rows if first is None else rows.where(F.col("index") >= first)
    return rows if last is None else rows.where(F.col("index") <= last)


def checkpoint_size(text):
    """Tree size of a checkpoint: its second line."""
    return F.try_element_at(F.split(text, "\n"), F.lit(2)).cast("long")


def tree_head_size(text):
    """Tree size of a get-sth answer."""
    return F.from_json(text, "tree_size long")["tree_size"]


def raw_entries(leaves: DataFrame, source: str) -> DataFrame:
    """Stored records of leaves: the leaf verbatim or rebuilt, the chain as fingerprints."""
    return leaves.where("error is null").select("index", "timestamp_ms", "entry_type", F.lit(source).alias("source"), "leaf_input", "precertificate", "issuer_key_hash", "chain_fingerprints")


def issuers_of(leaves: DataFrame) -> DataFrame:
    """(fingerprint, der): each issuer certificate of the chains once."""
    return leaves.select(F.explode("chain").alias("der")).select(F.unhex(F.sha2("der", 256)).alias("fingerprint"), "der").dropDuplicates(["fingerprint"])


def subjects_of(leaves: DataFrame, issuers: DataFrame | None = None) -> DataFrame:
    """Subject rows of leaves; the precertificate stands for a precert; unreadable certificates are left out.

    The issuer is found by the first fingerprint of the chain; without a match ca_id is 0. With log_no ids are those of
    entries of all logs, in order of index, then log; without it they are the index in the one log.
    """
    from ..functions import certs
    from .der import certificate

    der = F.coalesce("precertificate", "certificate")
    rows = leaves.where("error is null").withColumn("der", der).withColumn("m", certificate(F.col("der"))).where("m.ok")
    rows = rows.withColumn("fingerprint", F.lower(F.hex(F.try_element_at("chain_fingerprints", F.lit(1)))))
    ids = F.lit(0).cast("long")
    if issuers is not None:
        rows = rows.join(issuers.select("fingerprint", F.col("ca_id").alias("own_ca")), "fingerprint", "left")
        ids = F.coalesce("own_ca", F.lit(0)).cast("long")
    sans = F.col("m.san_domains")
    text = lambda c: F.coalesce(F.col(f"m.{c}"), F.lit("")).alias(c)
    return rows.select(
        (F.col("index") * LOGS + F.col("log_no") if "log_no" in leaves.columns else F.col("index")).cast("long").alias("id"), ids.alias("ca_id"), text("serial_number"), text("common_name"), text("organization"), text("state"), text("country"), text("not_before"), text("not_after"),
        F.array_join(sans, ",").alias("san_domains"), F.array_join("m.san_ips", ",").alias("san_ips"), certs.subject_url(sans, F.col("m.common_name")).alias("url"), certs.has_wildcard(sans).alias("is_wildcard"),
        certs.name_count(sans).alias("san_count"), "entry_type", F.lit(None).cast("long").alias("tile_idx"), F.lit(None).cast("long").alias("entry_idx"), certs.cert_hash(F.col("der")).alias("cert_hash"), (F.col("log_id") if "log_id" in leaves.columns else F.lit(None)).cast("binary").alias("log_id"),
    )


def der_store(spark: SparkSession, path: str) -> DataFrame:
    """(fingerprint, der) of the `.der` files of a store that can be read as certificates."""
    from .der import certificate

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.der").option("recursiveFileLookup", "true").load(path)
    rows = files.select(F.unhex(F.sha2("content", 256)).alias("fingerprint"), F.col("content").alias("der")).dropDuplicates(["fingerprint"])
    return rows.where(certificate(F.col("der"))["ok"])
