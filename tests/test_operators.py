import random

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import chains, dedup, dns, export, intervals, progress, reverse
from lakewarden.schemas import SUBJECTS


def subject(i, h, month="2025-05", **more):
    row = dict.fromkeys([c.split()[0] for c in SUBJECTS.split(", ")])
    return row | {"id": i, "cert_hash": h and h.encode(), "not_before": f"{month}-01T00:00:00Z", "common_name": f"n{i}"} | more


def subjects(spark, *rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SUBJECTS)


def test_flush_is_idempotent_and_seal_compacts(spark, tmp_path):
    a = dedup.MonthArchive(spark, str(tmp_path / "a"))
    a.flush(subjects(spark, subject(1, "A"), subject(2, "B")))
    pool = subjects(spark, *(subject(10 + i, h) for i, h in enumerate("BCDEEFA")))
    for _ in range(3):
        a.flush(pool)
    assert sorted(bytes(r.cert_hash).decode() for r in a.subjects().collect()) == list("ABCDEF")
    assert a.seen().count() == 6
    again = a.subjects().where(F.col("cert_hash") == b"C").withColumn("id", F.lit(99).cast("long"))  # as an archive from elsewhere may have it
    version, batches = a.manifest()
    for m in a._write("subjects", "stray", again):
        batches["subjects"][m].append("stray")
    assert a._commit(version, batches)
    assert dedup.duplicates(a.subjects(), "cert_hash").count() == 1
    for _ in range(2):
        a.seal(["2025-05"])
        assert a.subjects().count() == 6
    assert a.subjects().where("id = 99").count() == 0


def hashes(df):
    return sorted((bytes(r.cert_hash).decode(), r.id) for r in df.collect())


def test_readers_hold_to_a_version_while_months_are_rebuilt(spark, tmp_path, monkeypatch):
    a = dedup.MonthArchive(spark, str(tmp_path / "v"))
    assert a.subjects() is None and a.manifest()[0] == 0
    a.flush(subjects(spark, subject(5, "A"), subject(6, "B"), subject(7, "J", "2025-06")))
    a.flush(subjects(spark, subject(8, "C")))
    version = a.manifest()[0]
    reader = a.subjects(version)
    with monkeypatch.context() as m:  # a writer that ends before its version is made changes nothing
        m.setattr(a, "_commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            a.rebuild(subjects(spark, subject(1, "A"), subject(2, "D")))
    assert a.manifest()[0] == version and hashes(a.subjects()) == [("A", 5), ("B", 6), ("C", 8), ("J", 7)]
    a.rebuild(subjects(spark, subject(1, "A"), subject(2, "D"), subject(3, "D"), subject(4, "K", "2025-07")))
    assert hashes(reader) == hashes(a.subjects(version)) == [("A", 5), ("B", 6), ("C", 8), ("J", 7)]
    assert hashes(a.subjects()) == [("A", 5), ("B", 6), ("C", 8), ("D", 2), ("J", 7), ("K", 4)]
    assert len(a.manifest()[1]["subjects"]["2025-05"]) == 1 and a.seen().count() == 6
    a.seal(["2025-06", "2030-01"])
    assert hashes(a.subjects()) == [("A", 5), ("B", 6), ("C", 8), ("D", 2), ("J", 7), ("K", 4)] and hashes(reader) == [("A", 5), ("B", 6), ("C", 8), ("J", 7)]
    assert a.vacuum(keep=1) >= 3 and len(a.versions()) == 1 and hashes(a.subjects()) == [("A", 5), ("B", 6), ("C", 8), ("D", 2), ("J", 7), ("K", 4)]


def test_the_second_of_two_writers_begins_again(spark, tmp_path, monkeypatch):
    a, b = (dedup.MonthArchive(spark, str(tmp_path / "w")) for _ in range(2))
    a.flush(subjects(spark, subject(1, "A")))
    commit, raced = a._commit, []

    def late(version, batches):
        if not raced:
            raced.append(b.flush(subjects(spark, subject(2, "B"), subject(3, "C"))))
        return commit(version, batches)

    monkeypatch.setattr(a, "_commit", late)
    a.flush(subjects(spark, subject(4, "C"), subject(5, "D")))
    assert hashes(a.subjects()) == [("A", 1), ("B", 2), ("C", 3), ("D", 5)] and a.manifest()[0] == 3
    named = {x for own in a.manifest()[1]["subjects"].values() for x in own}
    assert {p.name.removeprefix("batch=") for p in (tmp_path / "w/subjects").iterdir()} == named
    a.flush(subjects(spark, subject(9, "D")))
    assert a.manifest()[0] == 3  # nothing new, no version


def test_legacy_key_and_months(spark, tmp_path):
    a = dedup.MonthArchive(spark, str(tmp_path / "b"))
    a.flush(subjects(spark, subject(1, None, tile_idx=3, entry_idx=4), subject(2, None, tile_idx=3, entry_idx=4), subject(3, "A", "2025-06"), subject(4, "B", "x")))
    assert sorted((r.id, r.cert_month) for r in a.subjects().select("id", "cert_month").collect()) == [(1, "2025-05"), (3, "2025-06"), (4, "x-01T00")]


def test_upsert_never_renumbers(spark):
    a, b, m, z = (c * 8 for c in "abcf")
    known = spark.createDataFrame([(m, 1), (z, 2)], "fingerprint string, ca_id long")
    out = dedup.upsert_ids(known, spark.createDataFrame([(b,), (a,), (m,), (a,), (None,)], "fingerprint string"))
    assert sorted(map(tuple, out.collect())) == [(a, 3), (b, 4), (m, 1), (z, 2)]
    with pytest.raises(Exception, match="not a hash in hex"):
        dedup.upsert_ids(known, spark.createDataFrame([("plain",)], "fingerprint string")).collect()


def test_flush_of_pools_without_keys(spark, tmp_path):
    a = dedup.MonthArchive(spark, str(tmp_path / "c"))
    assert a.flush(subjects(spark, subject(1, None)).where("false")) == 0 and a.subjects() is None
    assert a.flush(subjects(spark, subject(1, None), subject(2, None))) == 2 and a.subjects() is None
    assert a.flush(subjects(spark, subject(1, None), subject(3, "A"), subject(4, "B", "2025-07"))) == 1
    assert sorted(r.id for r in a.subjects().collect()) == [3, 4] and sorted(r.id for r in a.refused().collect()) == [1, 2]
    files = a.of_months("subjects", ["2025-07"]).inputFiles()
    assert files and all("cert_month=2025-07" in f for f in files) and a.of_months("subjects", ["2024-01"]) is None


def naive_merge(ranges):
    points = sorted({x for s, e in ranges for x in range(s, e)})
    out = []
    for p in points:
        if out and out[-1][1] == p:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [tuple(x) for x in out]


def test_merge_ranges_like_a_set(spark, monkeypatch):
    monkeypatch.setattr(intervals, "BUCKET", 50)
    rnd = random.Random(5)
    for n in (0, 1, 60):
        ranges = [(s := rnd.randrange(400), s + rnd.randrange(0, 9)) for _ in range(n)]
        df = spark.createDataFrame(ranges, "start long, end long")
        got = sorted(map(tuple, intervals.merge_ranges(df).collect()))
        assert got == naive_merge(ranges)


def test_coverage_and_gaps(spark):

    def summary(ranges, size):
        m = intervals.merge_ranges(spark.createDataFrame(ranges, "start long, end long"))
        c = intervals.coverage(m, size).first()
        return (c.stored, c.frontier, c.contiguous), sorted(map(tuple, intervals.gaps(m, size).collect()))

    assert summary([(1000, 2000), (0, 1000)], 5000) == ((2000, 2000, 2000), [(2000, 5000)])
    assert summary([(0, 1000), (2000, 3000)], 3000) == ((2000, 3000, 1000), [(1000, 2000)])
    assert summary([], 100) == ((0, 0, 0), [(0, 100)])


def test_day_runs_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(intervals, "BUCKET", 8)
    rnd = random.Random(9)
    days = {i: rnd.choice("ab") if rnd.random() < 0.2 else "a" for i in range(120) if rnd.random() < 0.9}
    rows = [*days.items(), *list(days.items())[:5], (3, "z")]
    want, runs = [], []
    for i, d in sorted({**days, 3: days.get(3, "z")}.items()):
        if runs and runs[-1][1] == i - 1 and runs[-1][2] == d:
            runs[-1][1] = i
        else:
            runs.append([i, i, d])
    want = sorted((f, e, d, e - f + 1) for f, e, d in runs)
    got = intervals.day_runs(spark.createDataFrame(rows, "index long, day string"))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_day_runs(spark):
    df = spark.createDataFrame([(10, "a"), (11, "a"), (12, "b"), (13, "a"), (20, "a")], "index long, day string")
    assert sorted(tuple(r) for r in intervals.day_runs(df).collect()) == [(10, 11, "a", 2), (12, 12, "b", 1), (13, 13, "a", 1), (20, 20, "a", 1)]


def test_merge_counts(spark):
    schema = "domain string, direct long, wildcard long"
    parts = spark.createDataFrame([("a", 3, 0), ("b", 1, 2)], schema).union(spark.createDataFrame([("a", 1, 1), ("c", 0, 5)], schema))
    assert sorted(map(tuple, export.merge_counts(parts).collect())) == [("a", 4, 1), ("b", 1, 2), ("c", 0, 5)]


def test_export_outputs_and_months(spark, tmp_path):
    rows = subjects(spark, subject(1, "A", san_domains="a.com,*.a.com,bad"), subject(2, "B", "2025-06", san_domains="*.b.net,a.com"))
    counts = export.export_months(spark, rows, str(tmp_path))
    assert sorted(map(tuple, counts.collect())) == [("a.com", 2, 1), ("b.net", 0, 1)]
    again = export.export_months(spark, rows, str(tmp_path))
    assert sorted(map(tuple, again.collect())) == [("a.com", 2, 1), ("b.net", 0, 1)]
    export.write_export(counts, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out/wildcard_only")).first().value == "b.net"
    assert (tmp_path / "out/shards/tld=com/bucket=a").exists()


def ip_index(spark):
    a = spark.createDataFrame([("203.0.113.7", "x.com", 100), ("203.0.113.7", "y.com", 100), ("203.0.113.9", "z.com", 1), ("198.51.100.1", "q.com", 1), ("203.0.113.7", "x.com", 200), ("203.0.113.7", "x.com", 150)], "ipv4 string, domain string, fetched_at long")
    six = spark.createDataFrame([("2001:db8::1", "v6.com", 1), ("nonsense", "n.com", 1)], "ipv6 string, domain string, fetched_at long")
    return reverse.rev_ip(reverse.address_union(a, six))


def test_lookups(spark):
    index = ip_index(spark)
    assert [r.domain for r in reverse.lookup_ip(index, "203.0.113.7").collect()] == ["x.com", "y.com"]
    assert [r.domain for r in reverse.lookup_cidr(index, "203.0.113.0/24").collect()] == ["x.com", "y.com", "z.com"]
    assert [r.domain for r in reverse.lookup_cidr(index, "2001:db8::/32").collect()] == ["v6.com"]
    assert index.where("domain = 'x.com'").first().fetched_at == 200
    many = reverse.join_cidrs(index, ["203.0.113.0/24", "198.0.0.0/7", "2001:db8::/32"])
    assert sorted((r.cidr, r.domain) for r in many.collect()) == [("198.0.0.0/7", "q.com"), ("2001:db8::/32", "v6.com"), ("203.0.113.0/24", "x.com"), ("203.0.113.0/24", "y.com"), ("203.0.113.0/24", "z.com")]


def test_routed_equals_unrouted(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(f"104.{rnd.randrange(4)}.{rnd.randrange(256)}.1", f"d{i}", i) for i in range(60)] + [("8.8.8.8", "g", 1)]
    index = reverse.rev_ip(spark.createDataFrame(rows, "address string, domain string, fetched_at long"))
    reverse.write_ip_index(index, str(tmp_path), 1, 3)
    stored = spark.read.parquet(str(tmp_path / "shards"))
    split = {r.base for r in spark.read.json(str(tmp_path / "manifest")).where("split").collect()}
    assert split == {"v4_104"}
    assert reverse.shards_for("104.2.0.0/16", 1, split) == ["v4_104_2"]
    for cidr in ("104.0.0.0/6", "104.0.0.0/8", "104.2.0.0/15", "104.2.0.0/16", "104.1.128.0/17", "8.8.8.8/32"):
        routed = reverse.lookup_cidr(stored, cidr, reverse.shards_for(cidr, 1, split)).collect()
        assert [tuple(r) for r in routed] == [tuple(r) for r in reverse.lookup_cidr(index, cidr).collect()]


def test_san_index_and_classes(spark):
    rows = spark.createDataFrame([(1, "example.com,*.example.com"), (2, "*.Example.com."), (3, "a.b.example.com"), (4, "other.net"), (5, ""), (6, "x.io,y.io,z.io")], "id long, san_domains string")
    index = reverse.san_index(rows)
    found = reverse.lookup_san(index, "example.com").collect()
    assert sorted({r.cert_id for r in found}) == [1, 2, 3] and {r.is_wildcard for r in found if r.cert_id == 2} == {1}
    assert reverse.lookup_san(index, "b.example.com").count() == 0 and reverse.lookup_san(index, "b.example.com", any_depth=True).count() == 1
    out, counts = reverse.san_classes(index, 2, 3)
    assert {r["suffix"]: r["class"] for r in counts.collect()} == {"com": "bucketed", "io": "bucketed", "net": "tail"}
    assert {r.shard for r in out.collect()} == {"san_com__e", "san_io__x", "san_io__y", "san_io__z", "san__tail__n"}


def test_written_index_routes_names(spark, tmp_path):
    sans = [f"a{i}.site{i % 40}.{tld}" for i in range(300) for tld in ("com", "co.uk", "io")] + ["x.example.net", "example.net", "nodots", "co.uk", "*.w.site7.com"]
    rows = spark.createDataFrame(list(enumerate(sans)), "id long, san_domains string")
    index, path = reverse.san_index(rows), str(tmp_path / "san")
    reverse.write_san_index(rows, path, 2, 200)
    assert not (tmp_path / "san" / "named").exists() and not (tmp_path / "san" / "staged").exists()
    for name, deep in (("site7.com", False), ("w.site7.com", True), ("site7.co.uk", False), ("a7.site7.io", True), ("example.net", False), ("absent.org", False), ("co.uk", True), ("nodots", False)):
        want = [tuple(r) for r in reverse.lookup_san(index, name, deep).collect()]
        assert [tuple(r) for r in reverse.lookup_written_san(spark, path, name, deep).collect()] == want, name
    assert reverse.san_shards_for(spark, path, "site7.com") == ["san_com__s"] and reverse.san_shards_for(spark, path, "absent.org") == [] and reverse.san_shards_for(spark, path, "com") is None
    stored = spark.read.parquet(f"{path}/shards")
    assert sorted(map(tuple, stored.select("san_domain", "reg_domain", "cert_id", "is_wildcard").collect())) == sorted(map(tuple, index.collect()))
    assert len(reverse.lookup_written_san(spark, path, "site7.com").inputFiles()) < len(stored.inputFiles())


def test_written_index_spreads_one_domain(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reverse, "TASK_ROWS", 100)
    rows = spark.createDataFrame([(i, f"a{i % 3}.hot.com,a{i % 3}.hot.com,b.s{i % 50}.org") for i in range(1000)], "id long, san_domains string")
    path = str(tmp_path / "san")
    reverse.write_san_index(rows, path)
    sizes = [r["count"] for r in spark.read.parquet(f"{path}/shards").where("reg_domain = 'hot.com'").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 400  # one domain fills many files, not one
    found = reverse.lookup_written_san(spark, path, "hot.com")
    assert [tuple(r) for r in found.collect()] == sorted((f"a{i % 3}.hot.com", 0, i) for i in range(1000))
    assert max(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()) <= 300
    zones = spark.read.parquet(f"{path}/zones").collect()
    stored = spark.read.parquet(f"{path}/shards").groupBy(F.col("_metadata.file_path").alias("file"), "shard").agg(F.min("reg_domain"), F.max("reg_domain"), F.count("*"))
    assert sorted(map(tuple, zones)) == sorted(map(tuple, stored.collect()))


def test_written_address_index(spark, tmp_path):
    index = ip_index(spark)
    path = str(tmp_path / "ip")
    reverse.write_ip_index(index, path, 1, 2)
    assert [r.domain for r in reverse.lookup_written_ip(spark, path, "203.0.113.7").collect()] == ["x.com", "y.com"]
    assert [r.domain for r in reverse.lookup_written_cidr(spark, path, "2001:db8::/32").collect()] == ["v6.com"]
    assert reverse.lookup_written_ip(spark, path, "1.2.3.4").count() == 0
    one = str(tmp_path / "one")
    reverse.write_ip_index(index, one, 1, 0, 1000)  # all bases are small
    assert [r.shard for r in spark.read.parquet(f"{one}/zones").select("shard").distinct().collect()] == [reverse.TAIL]
    assert [r.domain for r in reverse.lookup_written_cidr(spark, one, "203.0.113.0/24").collect()] == ["x.com", "y.com", "z.com"]
    assert sorted(map(tuple, reverse.read_ip_index(spark, one).drop("shard").collect())) == sorted(map(tuple, index.select("ip", "domain", "ver", "fetched_at").collect()))


def test_shards_read_back_and_fed(spark, tmp_path):
    counts = spark.createDataFrame([("a.com", 2, 0), ("b.com", 0, 1), ("x.co.uk", 1, 1), ("z.io", 5, 0)], "domain string, direct long, wildcard long")
    export.write_export(counts, str(tmp_path))
    back = export.read_shards(spark, str(tmp_path))
    assert sorted((r.domain, r.direct, r.wildcard, r.tld) for r in back.collect()) == [("a.com", 2, 0, "com"), ("b.com", 0, 1, "com"), ("x.co.uk", 1, 1, "co.uk"), ("z.io", 5, 0, "io")]
    (tmp_path / "shards/tld=io/bucket=exports/more.csv").write_text("broken line\n")
    assert export.read_shards(spark, str(tmp_path), "io").count() == 1
    assert {(r.tld, r.bucket, r.domains) for r in export.shard_feed(spark, str(tmp_path)).collect()} == {("com", "a", 1), ("com", "b", 1), ("co.uk", "exports", 1), ("io", "exports", 1)}
    batch, more = dns.batch(back, 3)
    assert [r.domain for r in batch.collect()] == ["a.com", "b.com", "x.co.uk"] and more and not dns.batch(back, 4)[1]


def test_errors_of_fetched_certificates(spark):
    import hashlib

    from lakewarden.operators import archive

    rows = [(hashlib.sha256(b"a").digest(), b"a"), (b"1" * 32, b"b"), (b"2" * 32, None)] + [(bytes([9, i]) * 16, b"c") for i in range(20)]
    got = archive.fetch_errors(spark.createDataFrame(rows, "fingerprint binary, der binary")).collect()
    assert len(got) == 10 and ("nothing fetched" in {r.reason for r in got}) == (b"2" * 32 in {bytes(r.fingerprint) for r in got}) and rows[0][0] not in {bytes(r.fingerprint) for r in got}


def test_dns_store(spark):
    records = spark.createDataFrame([("a.com", "MX", 60, 1, {"pref": "10", "host": "m"}), ("a.com", "LOC", 60, 1, {"latitude": "1", "longitude": "2", "altitude": "3", "size": "9"}), ("a.com", "WAT", 1, 1, {})], "domain string, type string, ttl long, fetched_at long, fields map<string,string>")
    view = dns.unified({k: dns.dispatch(records, k) for k in ("mx", "loc", "a")})
    assert sorted((r.type, r.value) for r in view.collect()) == [("LOC", "1 2 3"), ("MX", "10 m")]
    results = spark.createDataFrame([("a.com", "ok", 2), ("b.com", "ok", 1), ("b.com", "error", 5)], "domain string, status string, fetched_at long")
    fresh, kept = dns.accept(results, records, results.where("domain = 'a.com'"))
    assert [(r.domain, r.status) for r in fresh.collect()] == [("b.com", "ok")] and kept.count() == 0


def test_progress(spark):
    schema = "log_id string, description string, next_entry_idx long, tree_size_at_start long, total_processed long"
    runs = spark.createDataFrame([("a", "old", 5, 0, 7), ("b", "keep", 1, 9, 1)], schema)
    merged = progress.merge_runs(runs, spark.createDataFrame([("a", "new"), ("c", "fresh")], "log_id string, description string"))
    assert sorted(map(tuple, merged.collect())) == [("a", "new", 5, 0, 7), ("b", "keep", 1, 9, 1), ("c", "fresh", 0, 0, 0)]
    steps = spark.createDataFrame([("a", 8, 3, 100), ("b", 2, 1, 100)], "log_id string, next_entry_idx long, processed long, tree_size long")
    assert sorted(map(tuple, progress.advance(runs, steps).collect())) == [("a", "old", 8, 100, 10), ("b", "keep", 2, 9, 2)]


def test_chains(spark):
    import hashlib

    h = lambda x: hashlib.sha256(x).digest()
    entries = spark.createDataFrame([(1, "static", [h(b"i"), h(b"r")]), (2, "static", [h(b"gone")]), (3, "rfc6962", [h(b"z")])], "index long, source string, chain_fingerprints array<binary>")
    store = spark.createDataFrame([(h(b"i"), b"i"), (h(b"r"), b"r")], "fingerprint binary, der binary")
    assert tuple(chains.present_missing(chains.referenced(entries), store).first()) == (3, 2, 1)
    got = {r["index"]: ([x and bytes(x) for x in r.chain], r.complete) for r in chains.ordered_chains(entries, store).collect()}
    assert got[1] == ([b"i", b"r"], True) and got[2] == ([None], False)
    new = spark.createDataFrame([(h(b"n"), b"n"), (h(b"i"), b"i"), (h(b"bad"), b"other")], "fingerprint binary, der binary")
    assert [bytes(r.der) for r in chains.put_if_absent(store, new).collect()] == [b"n"]


def test_saved_partials_merge_without_a_shuffle(spark, tmp_path):
    from functools import reduce

    rnd = random.Random(8)
    parts = [spark.createDataFrame([(f"d{k}.com", rnd.randrange(9), rnd.randrange(3)) for k in rnd.sample(range(400), 250)], "domain string, direct long, wildcard long") for _ in range(4)]
    for _ in range(2):  # a part that is there isn't added again
        added = [export.save_partial(p, "partials_of_test", f"2025-0{k}", str(tmp_path / "partials"), 4) for k, p in enumerate(parts)]
    assert added == [False] * 4
    out = export.merge_partials(spark, "partials_of_test")
    want = export.merge_counts(reduce(lambda a, b: a.union(b), parts))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    spark.sql("DROP TABLE partials_of_test")


def test_most_specific_range_equals_brute_force(spark):
    from lakewarden.operators import enrich

    rnd = random.Random(12)
    byte = lambda n: n.to_bytes(2, "big")
    ranges = [(0, 65535, "all"), (7, 7, "one"), (9, 8, "none"), (100, 100, "b"), (100, 100, "a")]
    for k in range(300):  # nested, and some that only overlap
        lo = rnd.randrange(60_000)
        ranges.append((lo, lo + rnd.choice((0, 3, 40, 500, 5000)), f"r{k}"))
    keys = [rnd.randrange(65_536) for _ in range(3000)] + [100] * 2000 + [7] * 10
    df = spark.createDataFrame([(k, bytearray(byte(k))) for k in keys] + [(None, None)], "n int, ip binary").withColumn("value", F.lit("clash")).repartition(5)
    nets = spark.createDataFrame([(bytearray(byte(lo)), bytearray(byte(hi)), v) for lo, hi, v in ranges if hi < 65_536] + [(None, bytearray(b"zz"), "x")], "lo binary, hi binary, value string").repartition(3)
    want = {k: min(((hi - lo, lo, v) for lo, hi, v in ranges if lo <= k <= hi < 65_536), default=(0, 0, None))[2] for k in set(keys)}
    for parts in ("3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = enrich.most_specific(df, nets).collect()
        assert len(got) == len(keys) + 1 and all(r.range_value == want[r.n] for r in got if r.n is not None) and [r.range_value for r in got if r.n is None] == [None]
        bare = enrich.most_specific(df, nets.where("value = 'one'")).groupBy("range_value").count().collect()
        assert {r.range_value: r["count"] for r in bare} == {"one": keys.count(7), None: len(keys) + 1 - keys.count(7)}
    assert enrich.most_specific(df.where("false"), nets).count() == 0
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
