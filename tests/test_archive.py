import hashlib
import sqlite3

from test_operators import subject, subjects
from test_sources import certificate, u16, u24

from lakewarden.operators import archive
from lakewarden.operators.dedup import MonthArchive
from lakewarden.schemas import RAW_ENTRIES


def h(x):
    return hashlib.sha256(x).digest()


def entries(spark):
    leaf = b"\0\0" + (1000).to_bytes(8, "big") + b"\0\0" + u24(certificate()) + u16(b"")
    rows = [(1, 1000, "x509", "static", leaf, None, None, [h(b"i"), h(b"j")]), (2, 86_400_001, "precert", "static", b"bad", certificate(cn="pre"), b"k" * 32, [h(b"i")]), (3, 5, "x509", "rfc6962", b"bad", None, None, [h(b"z")])]
    return spark.createDataFrame(rows, RAW_ENTRIES)


def test_entries_and_summaries(spark, tmp_path):
    df = entries(spark)
    archive.write_entries(df, str(tmp_path))
    stored = spark.read.parquet(str(tmp_path))
    assert archive.find_entry(stored, 2).first().entry_type == "precert" and archive.find_entry(stored, 9).count() == 0
    assert {str(r.day) for r in stored.collect()} == {"1970-01-01", "1970-01-02"}
    s = archive.summary(df).first()
    assert (s.entries, s.first, s.last) == (3, 1, 3)
    got = {r["index"]: r.subject for r in archive.with_subjects(df).collect()}
    assert got[1].common_name == "a.com" and got[2].common_name == "pre" and got[3].ok is False
    runs = spark.createDataFrame([(100, 25), (100, 25)], "tree_size_at_start long, total_processed long")
    c = archive.check(runs, spark.createDataFrame([("a", 7), ("b", 8)], "path string, length long")).first()
    assert (c.tree_size, c.processed, c.percent, c.files, c.bytes) == (200, 50, 25.0, 2, 15)


def test_resolve_and_mirror(spark):
    store = spark.createDataFrame([(h(b"i"), b"i")], "fingerprint binary, der binary")
    offered = spark.createDataFrame([(h(b"j"), b"j"), (h(b"z"), b"z"), (h(b"i"), b"i"), (h(b"q"), b"forged")], "fingerprint binary, der binary")
    counts, none = archive.resolve_issuers(entries(spark), store)
    assert tuple(counts.first()) == (2, 1, 1) and none is None
    _, fresh = archive.resolve_issuers(entries(spark), store, offered)
    assert [bytes(r.der) for r in fresh.collect()] == [b"j"]
    new, counts = archive.mirror_roots(store, offered)
    assert sorted(bytes(r.der) for r in new.collect()) == [b"j", b"z"] and tuple(counts.first()) == (4, 1, 2)


def test_pools_and_repartition(spark, tmp_path):
    a = MonthArchive(spark, str(tmp_path / "a"))
    archive.drain_pools(a, [subjects(spark, subject(1, "A"), subject(2, "B")), subjects(spark, subject(3, "B"), subject(4, "C"))], seal=True)
    assert sorted(r.id for r in a.subjects().collect()) == [1, 2, 4]
    from pyspark.sql import functions as F

    b = MonthArchive(spark, str(tmp_path / "b"))
    rows = subjects(spark, subject(1, "A", ca_id=1), subject(2, "B", ca_id=2)).withColumn("source", F.lit("s"))
    skipped = archive.repartition(rows, spark.createDataFrame([("s", 1, 77)], "source string, ca_id long, global_id long"), b)
    assert skipped == 1 and [(r.id, r.ca_id) for r in b.subjects().collect()] == [(1, 77)]


def test_import_sqlite(spark, tmp_path):
    (tmp_path / "2025-05").mkdir()
    db = sqlite3.connect(tmp_path / "2025-05/subjects.db")
    db.execute("CREATE TABLE subjects (id INTEGER PRIMARY KEY, ca_id INTEGER, common_name TEXT, san_count INTEGER, cert_hash BLOB)")
    db.executemany("INSERT INTO subjects VALUES (?, ?, ?, ?, ?)", [(1, 5, "a", 2, b"h"), (2, 6, None, 0, None)])
    db.commit()
    db.close()
    got = sorted((r.id, r.ca_id, r.common_name, r.san_count, r.cert_hash and bytes(r.cert_hash), r.country) for r in archive.import_sqlite(spark, str(tmp_path)).collect())
    assert got == [(1, 5, "a", 2, b"h", ""), (2, 6, "", 0, None, "")]


def test_months():
    assert archive.months_between("2024-11", "2025-02") == ["2024-11", "2024-12", "2025-01", "2025-02"]
