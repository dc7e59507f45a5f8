"""Certificate chains: referenced and stored issuers, ordered reconstruction, verification of one entry."""

from __future__ import annotations

import base64
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATIC = "static"


def referenced(entries: DataFrame, static_only: bool = True) -> DataFrame:
    """(fingerprint): distinct chain fingerprints; chains of other sources are stored with their entries."""
    rows = entries.where(F.col("source") == STATIC) if static_only else entries
    return rows.select(F.explode("chain_fingerprints").alias("fingerprint")).distinct()


def present_missing(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: how many wanted fingerprints are there, are stored, are missing."""
    marked = wanted.join(stored.select("fingerprint", F.lit(True).alias("there")).dropDuplicates(["fingerprint"]), "fingerprint", "left")
    return marked.agg(F.count("*").alias("referenced"), F.count("there").alias("present"), (F.count("*") - F.count("there")).alias("missing"))


def put_if_absent(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Certificates to append to a content-addressed store: those whose hash is their address and that it lacks."""
    valid = incoming.where(F.col("fingerprint") == F.unhex(F.sha2("der", 256))).dropDuplicates(["fingerprint"])
    return valid.join(stored.select("fingerprint"), "fingerprint", "left_anti")


def ordered_chains(entries: DataFrame, store: DataFrame, key: str = "index") -> DataFrame:
    """(key, chain, complete): certificates of each entry's chain in order, nulls where the store has none."""
    links = entries.select(F.col(key), F.posexplode("chain_fingerprints").alias("pos", "fingerprint"))
    met = links.join(store.select("fingerprint", "der"), "fingerprint", "left")
    rows = met.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "der"))).alias("c"))
    return rows.select(key, F.transform("c", lambda x: x["der"]).alias("chain"), F.forall("c", lambda x: x["der"].isNotNull()).alias("complete"))


@dataclass
class Verdict:
    valid: bool = False
    anchor: str = ""
    within_validity: bool = False
    reason: str = ""


def verify_entry(spark, leaf: bytes, chain: list[bytes], roots: list[bytes], at_ms: int) -> Verdict:
    """Check one entry's chain link by link, and that its top is a root or signed by one, with the JVM's certificates.

    Only signatures decide; whether all were in force at the entry's time is reported beside it.
    """
    jvm = spark.sparkContext._jvm
    factory = jvm.java.security.cert.CertificateFactory.getInstance("X.509")

    def parse(der: bytes):
        raw = jvm.java.util.Base64.getDecoder().decode(base64.b64encode(der).decode())
        return factory.generateCertificate(jvm.java.io.ByteArrayInputStream(raw))

    def signed_by(cert, issuer) -> bool:
        try:
            cert.verify(issuer.getPublicKey())
            return True
        except Exception:
            return False

    name = lambda c: c.getSubjectX500Principal().getName()
    try:
        certs = [parse(x) for x in (leaf, *chain)]
    except Exception as e:
        return Verdict(reason=f"certificate can't be read: {str(e).splitlines()[0]}")
    for lower, upper in zip(certs, certs[1:], strict=False):
        if not signed_by(lower, upper):
            return Verdict(reason=f"broken link: {name(lower)} is not signed by {name(upper)}")
    out, top = Verdict(), certs[-1]
    if [leaf, *chain][-1] in set(roots):
        out.valid, out.anchor = True, name(top)
    else:
        for r in map(parse, roots):
            if signed_by(top, r):
                out.valid, out.anchor = True, name(r)
                break
    if not out.valid:
        out.reason = f"chain ends at {name(top)}, which is no accepted root"
        return out
    out.within_validity = all(c.getNotBefore().getTime() <= at_ms <= c.getNotAfter().getTime() for c in certs)
    return out
