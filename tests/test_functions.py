import ipaddress

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakewarden.functions import certs, ipkey, names, ranges


def column(spark, values, kind, expr):
    """Results of an expression over column v."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalize(spark):
    got = column(spark, [" Example.COM\t", "*.x", "nodot", ".lead.com", "trail.com.", "in side.com", "a@b.com", "a-b.c_d.org", "a..b", None], "string", names.normalize)
    assert got == ["example.com", "", "", "", "", "", "", "a-b.c_d.org", "a..b", ""]


def test_norm_fqdn(spark):
    got = column(spark, ["*.Example.COM.", "  API.Example.com ", "a.b.."], "string", names.norm_fqdn)
    assert [tuple(x) for x in got] == [("example.com", True), ("api.example.com", False), ("a.b.", False)]


def test_listing_and_parent(spark):
    assert column(spark, ["*.A.com", "a.b1", "x", " y.org "], "string", names.listing_name) == ["a.com", None, None, "y.org"]
    assert column(spark, ["*.a.b.com", "x.y.co.uk", "co.uk", "one"], "string", names.parent_domain) == ["b.com", "y.co.uk", "co.uk", "one"]


def test_export_shard(spark):
    values = ["www.example.com", "subdomain.123start.com", "example.net", "foo.co.uk", "nodot"]
    df = spark.createDataFrame([(v, 1, 0) for v in values], "domain string, direct long, wildcard long")
    from lakewarden.operators.export import with_shards

    got = {r.domain: (r.tld, r.bucket) for r in with_shards(df).collect()}
    assert got == {"www.example.com": ("com", "e"), "subdomain.123start.com": ("com", "0"), "example.net": ("net", "exports"), "foo.co.uk": ("co.uk", "exports"), "nodot": ("_other", "exports")}


RULES = "com\n*.ck\n!www.ck\nco.uk\nuk\n// remark\nblog.com\na.b.c.d.e\nübung.de\n*.d.e"
NAMES = ("a.com", "x.y.ck", "www.ck", "w.www.ck", "y.ck", "ck", "a.co.uk", "a.zz", "q.blog.com", "com", "a..com", ".com", "com.", "", "x.a.b.c.d.e", "b.c.d.e", "one", "x.xn--bung-zra.de", "x.übung.de")


def test_suffix_rules():
    rules = names.SuffixRules(RULES)
    assert [rules.suffix(x) for x in ("a.com", "x.y.ck", "www.ck", "a.co.uk", "a.zz", "q.blog.com")] == ["com", "y.ck", "ck", "co.uk", "zz", "blog.com"]
    assert [rules.registrable(x) for x in ("a.b.com", "com", "w.www.ck", "x.y.ck", "y.ck", "a..com", ".com", "")] == ["b.com", None, "www.ck", "x.y.ck", None, None, None, None]


def test_suffixes_of_a_table_by_joins(spark, tmp_path):
    (tmp_path / "rules.dat").write_text(RULES + "\n\n")
    rules = names.read_suffix_rules(spark, str(tmp_path / "rules.dat"))
    df = spark.createDataFrame([(n, k) for k, n in enumerate((*NAMES, None, "a.com"))], "`the name` string, suffix2 int")
    out = names.with_suffix(df.withColumnRenamed("the name", "n"), "n", rules)
    got = {(r.n, r.suffix2): (r.suffix, r.registrable) for r in out.collect()}
    own = names.SuffixRules(RULES)
    assert got == {(n, k): ((own.suffix(n), own.registrable(n)) if n is not None else (None, None)) for k, n in enumerate((*NAMES, None, "a.com"))}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning" not in plan


def test_public_list_is_part_of_the_package(monkeypatch, tmp_path):
    import pyspark

    monkeypatch.setattr(pyspark, "__file__", str(tmp_path / "nowhere.py"))  # no jars beside it
    names.suffix_rules.cache_clear()
    rules = names.suffix_rules()
    assert len(rules.kinds) > 9000 and [rules.registrable(n) for n in ("a.b.co.uk", "x.github.io", "city.kobe.jp", "a.b.kobe.jp")] == ["b.co.uk", "x.github.io", "city.kobe.jp", "a.b.kobe.jp"]


def test_san_shard(spark):
    df = spark.createDataFrame([("example.com", "com"), ("ebay.com", "com"), ("9292.com", "com"), ("example.co.uk", "co.uk"), ("_other", "_other")], "r string, s string")
    got = [tuple(x.k) for x in df.select(names.san_shard(F.col("r"), F.col("s")).alias("k")).collect()]
    assert got == [("com", "e"), ("com", "e"), ("com", "0"), ("co.uk", "all"), ("_other", "all")]


def test_tile_path(spark):
    assert column(spark, [0, 1, 999, 1000, 1234, 1000000, 1234067], "long", ranges.tile_path) == ["000", "001", "999", "x001/000", "x001/234", "x001/x000/000", "x001/x234/067"]


def test_base36_and_names(spark):
    values = [0, 1, 9, 10, 61, 62, 63, 255, 2799999000, 2**62 - 1, 2**63 - 1]
    assert column(spark, values, "long", lambda v: ranges.from_base36(ranges.to_base36(v))) == values
    assert column(spark, ["a-b", "A", ""], "string", ranges.from_base36) == [None] * 3
    got = column(spark, ["a-c.binpb", "a-c.binpb.gz", "ac.binpb", "a-c.txt", "c-a.binpb"], "string", ranges.parse_range_name)
    assert [x and tuple(x) for x in got] == [(10, 13), (10, 13), None, None, None]


def test_months_and_urls(spark):
    assert column(spark, ["2025-05-01T00:00:00Z", "2025-0", None, ""], "string", certs.cert_month) == ["2025-05", "unknown", "unknown", "unknown"]
    urls = column(spark, [["*.a.com", "b.com"], ["*.a.com"], [], None], "array<string>", lambda v: certs.subject_url(v, F.lit("cn.org")))
    assert urls == ["https://b.com", "https://a.com", "https://cn.org", "https://cn.org"]
    assert column(spark, [["*.a"], ["a"], None], "array<string>", certs.has_wildcard) == [1, 0, 0]
    assert column(spark, [512, 2048, 5 * 1024**3], "long", certs.bytes_text) == ["512 B", "2.0 KiB", "5.0 GiB"]


def test_one_decimal_is_that_of_the_exact_value(spark):
    hours = [s / 3600 for s in range(5400, 200_000, 60)] + [0.0, 0.05, 0.25, 0.35, 0.95, 9.95, 99.95, 1.25e9 + 0.05, 2.0**47 + 0.25]
    assert column(spark, hours, "double", certs.one_decimal) == [f"{h:.1f}" for h in hours]
    assert column(spark, [5940.0, 9180.0, 5400.0, None], "double", certs.eta_text) == ["~1.6h", "~2.5h", "~1.5h", None]
    assert column(spark, [1280, 1792], "long", certs.bytes_text) == ["1.2 KiB", "1.8 KiB"]


def test_texts_equal_their_sql_at_many_keys(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from shared import rows_of

    from lakewarden.plans import driver

    spark.range(1, 90_001).withColumnRenamed("id", "c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert rows_of(driver.QUERIES["fn28_texts"](spark, str(tmp_path)).toPandas()) == rows_of(duck.execute(driver.ORACLES["fn28_texts"]).df())


@settings(max_examples=3, deadline=None)
@given(st.lists(st.ip_addresses(), min_size=5, max_size=40))
def test_keys_keep_order(spark, addresses):
    df = spark.createDataFrame([(str(a),) for a in addresses], "address string")
    got = {r.address: (bytes(r.ip), r.ver) for r in ipkey.key16(df).collect()}
    for a in addresses:
        six = a if a.version == 6 else ipaddress.IPv6Address(b"\0" * 10 + b"\xff\xff" + a.packed)
        assert got[str(a)] == (six.packed, 4 if six.ipv4_mapped else 6)


def test_bad_addresses_are_dropped(spark):
    df = spark.createDataFrame([("1.2.3",), ("01.2.3.4",), ("256.1.1.1",), ("x",), (None,), (" 1.2.3.4 ",), ("::1",)], "address string")
    assert sorted(r.address for r in ipkey.key16(df).collect()) == [" 1.2.3.4 ", "::1"]


@pytest.mark.parametrize(("cidr", "n"), [("10.1.2.0/24", 1), ("10.1.0.0/16", 1), ("10.0.0.0/15", 2), ("10.0.0.0/14", 4), ("10.0.0.0/8", 256), ("2001:db8::/32", 1), ("2001::/16", 1), ("2000::/12", 16)])
def test_shards_of_cidr(cidr, n):
    assert len(ipkey.shard_names_of(cidr, 2)) == n


ODD_ADDRESSES = (
    "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::8", "FE80::aB", "fe80::1%eth0", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.4", " 2001:db8::5 ",
    "1.2.3.4", "", ":", ":::", "1:::2", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7::8", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "12345::", "g::", "::1.2.3", "::1.2.3.256", "::01.2.3.4", "1.2.3.4::", "::1.2.3.4:5", "1:2:3:4:5:6:7:1.2.3.4", "fe80::1%", "x", None,
)


def test_six_byte_forms_natively_and_counted(spark):
    from pyspark.sql import Observation

    def key(x):
        try:
            if x is None or x.strip().endswith("%"):
                return None
            a = ipaddress.ip_address(x.strip().partition("%")[0])
        except ValueError:
            return None
        return a.packed if a.version == 6 else bytes(10) + b"\xff\xff" + a.packed

    seen = Observation()
    out = ipkey.key16(spark.createDataFrame([(a,) for a in ODD_ADDRESSES], "address string"), dropped=seen)
    assert {r.address: bytes(r.ip) for r in out.collect()} == {a: key(a) for a in ODD_ADDRESSES if key(a) is not None}
    assert seen.get["dropped"] == sum(key(a) is None for a in ODD_ADDRESSES)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
