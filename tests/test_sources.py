import base64
import hashlib
import json
import shutil
import struct
import subprocess

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import chains, progress
from lakewarden.sources import der, leaves, loglist, logs, records


def u24(x):
    return len(x).to_bytes(3, "big") + x


def u16(x):
    return len(x).to_bytes(2, "big") + x


def tile_leaf(time, cert, prints=b"", key=None, pre=None, ext=b""):
    out = struct.pack(">QH", time, 0 if key is None else 1) + (key or b"") + u24(cert) + u16(ext)
    return out + (u24(pre) if pre is not None else b"") + u16(prints)


def element(tag, value):
    size = bytes([len(value)]) if len(value) < 128 else (b"\x81" + bytes([len(value)]) if len(value) < 256 else b"\x82" + len(value).to_bytes(2, "big"))
    return bytes([tag]) + size + value


def attribute(oid, text):
    return element(0x31, element(0x30, element(6, bytes.fromhex(oid)) + element(12, text.encode())))


def certificate(names=("a.com", "*.a.com"), ips=(b"\x0a\0\0\1",), serial=b"\0\xab\xcd", cn="a.com"):
    subject = element(0x30, attribute("550406", "US") + attribute("55040a", "TestOrg") + attribute("550403", cn) + attribute("550403", "second"))
    validity = element(0x30, element(0x17, b"250501000000Z") + element(0x18, b"20260501000000Z"))
    alt = element(0x30, b"".join(element(0x82, n.encode()) for n in names) + b"".join(element(0x87, i) for i in ips))
    ext = element(0xA3, element(0x30, element(0x30, element(6, der.ALT_NAMES) + element(4, alt))))
    tbs = element(0x30, element(0xA0, element(2, b"\2")) + element(2, serial) + element(0x30, b"") + element(0x30, b"") + validity + subject + element(0x30, b"") + ext)
    return element(0x30, tbs + element(0x30, b"") + element(3, b"\0"))


def test_der_metadata(spark):
    got = der.parse(certificate())
    assert (got["common_name"], got["organization"], got["country"], got["state"]) == ("a.com", "TestOrg", "US", None)
    assert (got["serial_number"], got["not_before"], got["not_after"]) == ("abcd", "2025-05-01T00:00:00Z", "2026-05-01T00:00:00Z")
    assert (got["san_domains"], got["san_ips"], got["ok"]) == (["a.com", "*.a.com"], ["10.0.0.1"], True)
    assert der.parse(b"junk")["ok"] is False and der.parse(certificate()[:60])["ok"] is False
    df = spark.createDataFrame([(certificate(),), (None,), (b"x",)], "d binary")
    assert [r.ok for r in df.select(der.certificate("d").alias("m")).select("m.ok").collect()] == [True, False, False]


def test_tiles(spark, tmp_path):
    prints = hashlib.sha256(b"i").digest() + b"tail"
    data = tile_leaf(5, b"cert", prints) + tile_leaf(6, b"tbs", b"", key=b"k" * 32, pre=b"pre")
    got = list(leaves.tile_leaves(data))
    assert [x["entry_type"] for x in got] == ["x509", "precert"] and got[0]["chain_fingerprints"] == [prints[:32]] and got[1]["precertificate"] == b"pre"
    assert len(list(leaves.tile_leaves(data, 1))) == 1 and len(list(leaves.tile_leaves(data[:-1]))) == 1 and list(leaves.tile_leaves(b"")) == []
    assert leaves.leaf_input(got[1]["leaf_input"])["issuer_key_hash"] == b"k" * 32
    (tmp_path / "tile").mkdir()
    (tmp_path / "tile/checkpoint").write_text("x")
    for path in ("tile/data/000", "tile/data/x001/234"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(data)
    rows = leaves.read_tiles(spark, str(tmp_path))
    assert sorted(r["index"] for r in rows.collect()) == [0, 1, 1234 * 256, 1234 * 256 + 1]
    assert [r["index"] for r in leaves.read_tiles(spark, str(tmp_path), 1, 600).collect()] == [1]


def test_pages_to_subjects(spark, tmp_path):
    chain = [b"issuer", b"root"]

    def entry(cert, ok=True):
        leaf = struct.pack(">BBQH", 0 if ok else 1, 0, 1000, 0) + u24(cert) + u16(b"")
        return {"leaf_input": base64.b64encode(leaf).decode(), "extra_data": base64.b64encode(u24(b"".join(map(u24, chain)))).decode()}

    (tmp_path / "page-512.json").write_text(json.dumps({"entries": [entry(certificate()), entry(b"broken"), entry(b"", ok=False)]}))
    parsed = leaves.parse_leaves(leaves.read_pages(spark, str(tmp_path)))
    got = {r["index"]: r for r in parsed.collect()}
    assert sorted(got) == [512, 513, 514] and "version 1" in got[514].error and [bytes(x) for x in got[512].chain] == chain
    issuers = spark.createDataFrame([(7, hashlib.sha256(b"issuer").hexdigest())], "ca_id long, fingerprint string")
    (s,) = leaves.subjects_of(parsed, issuers).collect()
    assert (s.id, s.ca_id, s.common_name, s.san_domains, s.san_ips, s.url, s.is_wildcard, s.san_count) == (512, 7, "a.com", "a.com,*.a.com", "10.0.0.1", "https://a.com", 1, 2)
    assert bytes(s.cert_hash) == hashlib.sha256(certificate()).digest()
    assert leaves.subjects_of(parsed).first().ca_id == 0 and leaves.issuers_of(parsed).count() == 2


def leaf_rows():
    """(index, leaf_input, extra_data) of three certificates."""
    chain = u24(b"".join(map(u24, (b"issuer", b"root"))))
    return [(100 + i, struct.pack(">BBQH", 0, 0, 1000, 0) + u24(certificate(serial=bytes([0, 7, i]))) + u16(b""), chain) for i in range(3)]


def test_range_of_pages(spark, tmp_path):
    page = [{"leaf_input": base64.b64encode(leaf).decode(), "extra_data": base64.b64encode(extra).decode()} for _, leaf, extra in leaf_rows()]
    (tmp_path / "page-100.json").write_text(json.dumps({"entries": page}))
    assert [r["index"] for r in leaves.read_pages(spark, str(tmp_path), 101, 101).collect()] == [101]
    assert leaves.read_pages(spark, str(tmp_path), 101).count() == 2 and leaves.read_pages(spark, str(tmp_path), last=99).count() == 0


def test_done_of_completed_shards(spark):
    lines = [("a", 1, "feed: x.tsv → 0 domains queued"), ("a", 2, "feed: x.tsv → 70 domains queued"), ("a", 3, "complete: total=68"), ("b", 1, "feed: y.tsv → 5 domains queued")]
    got = {r.shard: (r.status, r.total, r.done) for r in logs.shard_log_state(spark.createDataFrame(lines, "shard string, line int, value string")).collect()}
    assert got == {"a": ("complete", 70, 68), "b": ("running", 5, None)}


def test_sizes(spark):
    df = spark.createDataFrame([("origin\n12345\nroot", '{"tree_size": 9}')], "a string, b string")
    assert tuple(df.select(leaves.checkpoint_size(F.col("a")), leaves.tree_head_size(F.col("b"))).first()) == (12345, 9)


@pytest.mark.parametrize("compress", [False, True])
def test_partition_files(spark, tmp_path, compress):
    day = 86_400_000
    rows = [(10, day - 2, "x509", "static", b"l", None, None, [b"f" * 32]), (11, day - 1, "precert", "static", b"m", b"p", b"k", []), (12, day + 1, "x509", "rfc6962", b"n", None, None, [])]
    df = spark.createDataFrame(rows, "index long, timestamp_ms long, entry_type string, source string, leaf_input binary, precertificate binary, issuer_key_hash binary, chain_fingerprints array<binary>")
    files = records.partition_files(df, compress).collect()
    assert sorted((f.day, f.name) for f in files) == [("1970-01-01", "a-b.binpb" + ".gz" * compress), ("1970-01-02", "c-c.binpb" + ".gz" * compress)]
    for f in files:
        (tmp_path / f.day).mkdir()
        (tmp_path / f.day / f.name).write_bytes(f.content)
    (tmp_path / "notes.txt").write_text("x")
    back = {r["index"]: r for r in records.read_partitions(spark, str(tmp_path)).collect()}
    assert sorted(back) == [10, 11, 12] and back[11].entry_type == "precert" and bytes(back[11].precertificate) == b"p" and [bytes(x) for x in back[10].chain_fingerprints] == [b"f" * 32]
    assert sorted(tuple(r) for r in records.file_ranges(records.listed(spark, str(tmp_path))).collect()) == [(10, 12), (12, 13)]
    assert records.listed(spark, str(tmp_path / "none")).count() == 0


def test_partition_files_are_written_once_and_together(spark, tmp_path):
    from lakewarden.sources import partition_sink

    day, root = 86_400_000, tmp_path / "out"
    kinds = "index long, timestamp_ms long, entry_type string, source string, leaf_input binary, precertificate binary, issuer_key_hash binary, chain_fingerprints array<binary>"
    entries = spark.createDataFrame([(i, (i // 4) * day, "x509", "static", b"leaf %d" % i, None, None, [b"f" * 32]) for i in (*range(10, 30), *range(40, 44))], kinds).repartition(3)
    partition_sink.write_partitions(entries, str(root))
    want = {f"{f.day}/{f.name}": bytes(f.content) for f in records.partition_files(entries).collect()}
    there = lambda: {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert there() == want and "1970-01-03/a-b.binpb" in want and "1970-01-11/14-17.binpb" in want
    assert sorted(r["index"] for r in records.read_partitions(spark, str(root)).collect()) == [*range(10, 30), *range(40, 44)]
    more = entries.where("index < 20").union(spark.createDataFrame([(90, 90 * day, "x509", "static", b"l", None, None, [])], kinds))
    with pytest.raises(Exception, match="never change"):  # one of its files is there, so none is written
        partition_sink.write_partitions(more, str(root))
    assert there() == want
    bad = spark.range(40).selectExpr("'1980-01-01' AS day", "concat('f', id, '.binpb') AS name", "if(id = 33, cast(raise_error('lost') as binary), cast(id as string)) AS content").repartition(4)
    spark.dataSource.register(partition_sink.PartitionSink)
    with pytest.raises(Exception, match="lost"):
        bad.write.format("partition_files").option("root", str(root)).mode("append").save()
    assert there() == want


def log(name, state, **more):
    return {"description": name, "log_id": base64.b64encode(hashlib.sha256(name.encode()).digest()).decode(), "mmd": 86400, "state": state} | more


def test_log_list(spark, tmp_path):
    usable, old = {"usable": {"timestamp": "2024-01-01T00:00:00Z"}}, {"readonly": {"timestamp": "2024-02-01T00:00:00Z", "final_tree_head": {"tree_size": 65240567}}}
    data = {"version": "1", "operators": [{"name": "One", "logs": [log("a", usable, url="https://a"), log("b", old, url="https://b/")]}, {"name": "Two", "tiled_logs": [log("c", usable, submission_url="https://s", monitoring_url="https://m", temporal_interval={"start_inclusive": "2025-01-01T00:00:00Z", "end_exclusive": "2026-01-01T00:00:00Z"})]}]}
    (tmp_path / "l.json").write_text(json.dumps(data))
    flat = loglist.flat_logs(loglist.read_log_list(spark, str(tmp_path)))
    got = {r.description: r for r in flat.collect()}
    assert (got["a"].submission_url, got["c"].monitoring_url, got["b"].final_tree_size, got["c"].protocol) == ("https://a/", "https://m/", 65240567, "static")
    assert loglist.usable(flat).count() == 2 and loglist.select_logs(flat, ["rfc6962"]).count() == 2 and loglist.select_logs(flat, excluded=["One"], description="c").count() == 1
    assert {r.operator: len(r.logs) for r in loglist.nested_logs(flat).collect()} == {"One": 2, "Two": 1}
    data["operators"][0]["logs"][0]["log_id"] = "AAAA"
    (tmp_path / "l.json").write_text(json.dumps(data))
    with pytest.raises(Exception, match="not 32 bytes"):
        loglist.flat_logs(loglist.read_log_list(spark, str(tmp_path))).collect()


def test_log_lines(spark):
    lines = ["[metrics 2026-01-01T00:00:00Z] tree=10 processed=5 coverage=50.000000% db_total=1.0 KiB", "noise", "[metrics 2026-01-02T00:00:00Z] tree=10 processed=6 coverage=60.000000% db_total=2.0 KiB"]
    last = progress.last_metrics(spark.createDataFrame([(x,) for x in lines], "value string")).first()
    assert tuple(last) == ("2026-01-02T00:00:00Z", 10, 6, 60.0, "2.0 KiB")
    shard = [(0, "feed: com/a → 70 domains queued"), (1, "2026/01/01 10:00:00 metrics: done=7 rate=1.5/s ok=4 nxd=1 timeout=1 err=1(14.3%) cb=closed"), (2, "complete: total=70")]
    df = spark.createDataFrame([("s", *x) for x in shard], "shard string, line int, value string")
    assert tuple(logs.fetch_metrics(df).drop("at").first()) == ("s", 7, 1.5, 4, 1, 1, 1, "closed")
    assert tuple(logs.shard_log_state(df).first()) == ("s", "complete", 70, 70)
    runner = [(0, "[10:00:00] === com/a ( 1 234 domains) ==="), (1, "[11:00:00] === done com/a"), (2, "[11:00:01] === net/x (5 domains) ===")]
    got = logs.runner_entries(spark.createDataFrame(runner, "line int, value string")).collect()
    assert sorted(tuple(r) for r in got) == [("com/a", 0, 1234, "complete"), ("net/x", 2, 5, "running")]
    assert [logs.answer_class(s) for s in (200, 403, 404, 429, 409, 400, 503)] == ["ok", "frontier", "frontier", "retry", "retry", "fatal", "retry"]


@pytest.mark.skipif(not shutil.which("openssl"), reason="certificates are minted with openssl")
def test_verify_entry(spark, tmp_path):
    def run(*a):
        subprocess.run(["openssl", *a], check=True, cwd=tmp_path, capture_output=True)

    for name, signer in (("root", None), ("mid", "root"), ("leaf", "mid"), ("other", None)):
        if signer is None:
            run("req", "-x509", "-newkey", "ec", "-pkeyopt", "ec_paramgen_curve:P-256", "-nodes", "-keyout", f"{name}.key", "-out", f"{name}.pem", "-subj", f"/CN={name}", "-days", "2")
        else:
            run("req", "-newkey", "ec", "-pkeyopt", "ec_paramgen_curve:P-256", "-nodes", "-keyout", f"{name}.key", "-out", f"{name}.csr", "-subj", f"/CN={name}")
            run("x509", "-req", "-in", f"{name}.csr", "-CA", f"{signer}.pem", "-CAkey", f"{signer}.key", "-CAcreateserial", "-out", f"{name}.pem", "-days", "2")
        run("x509", "-in", f"{name}.pem", "-outform", "DER", "-out", f"{name}.der")
    import time

    d = {n: (tmp_path / f"{n}.der").read_bytes() for n in ("root", "mid", "leaf", "other")}
    now = int(time.time() * 1000) + 1000
    good = chains.verify_entry(spark, d["leaf"], [d["mid"]], [d["root"]], now)
    assert good.valid and good.within_validity and "root" in good.anchor
    assert chains.verify_entry(spark, d["leaf"], [d["mid"], d["root"]], [d["root"]], 0).within_validity is False
    assert not chains.verify_entry(spark, d["leaf"], [d["mid"]], [d["other"]], now).valid
    assert "broken link" in chains.verify_entry(spark, d["leaf"], [d["other"]], [d["root"]], now).reason
    assert "can't be read" in chains.verify_entry(spark, b"x", [], [], now).reason
    assert der.parse(d["leaf"])["common_name"] == "leaf"
