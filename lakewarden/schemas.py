"""Explicit schemas of the stored tables; nothing is inferred."""

from __future__ import annotations

SUBJECTS = (
    "id long, ca_id long, serial_number string, common_name string, organization string, state string, country string, "
    "not_before string, not_after string, san_domains string, san_ips string, url string, is_wildcard int, san_count int, "
    "entry_type string, tile_idx long, entry_idx long, cert_hash binary, log_id binary"
)
ISSUERS = "ca_id long, fingerprint string, common_name string, organization string, country string"
LOG_RUNS = (
    "log_id binary, description string, submission_url string, monitoring_url string, protocol string, operator string, state string, "
    "next_entry_idx long, tree_size_at_start long, total_processed long, started_at string, updated_at string"
)
RAW_ENTRIES = "index long, timestamp_ms long, entry_type string, source string, leaf_input binary, precertificate binary, issuer_key_hash binary, chain_fingerprints array<binary>"
FETCH_LOG = "domain string, status string, fetched_at long"
REV_IP = "ip binary, domain string, ver int, fetched_at long"
SAN_INDEX = "san_domain string, reg_domain string, cert_id long, is_wildcard int"
EXPORT = "domain string, direct long, wildcard long"
STORED_DER = "fingerprint binary, der binary"

#: Type-specific columns of the DNS record tables, and the fields that make up a record's text value.
DNS_TYPES = {
    "a": ("ipv4 string", ("ipv4",)),
    "aaaa": ("ipv6 string", ("ipv6",)),
    "cname": ("target string", ("target",)),
    "dname": ("target string", ("target",)),
    "ns": ("host string", ("host",)),
    "mx": ("pref int, host string", ("pref", "host")),
    "txt": ("value string", ("value",)),
    "soa": ("ns string, mbox string, serial long, refresh long, retry long, expire long, min_ttl long", ("ns", "mbox", "serial", "refresh", "retry", "expire", "min_ttl")),
    "loc": ("version int, size int, horiz_pre int, vert_pre int, latitude long, longitude long, altitude long", ("latitude", "longitude", "altitude")),
    "hinfo": ("cpu string, os string", ("cpu", "os")),
    "rp": ("mbox string, txt string", ("mbox", "txt")),
    "afsdb": ("subtype int, hostname string", ("subtype", "hostname")),
    "naptr": ("ord int, preference int, flags string, service string, regexp string, replacement string", ("ord", "preference", "flags", "service", "regexp", "replacement")),
    "kx": ("preference int, exchanger string", ("preference", "exchanger")),
    "sshfp": ("algorithm int, fp_type int, fingerprint string", ("algorithm", "fp_type", "fingerprint")),
    "svcb": ("priority int, target_name string, params string", ("priority", "target_name", "params")),
    "https": ("priority int, target_name string, params string", ("priority", "target_name", "params")),
    "caa": ("flags int, tag string, value string", ("flags", "tag", "value")),
    "uri": ("priority int, weight int, target string", ("priority", "weight", "target")),
}


def dns_schema(kind: str) -> str:
    return f"domain string, ttl long, fetched_at long, {DNS_TYPES[kind][0]}"
