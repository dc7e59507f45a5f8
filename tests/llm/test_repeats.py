"""Periodic runs, ball k-means and suffix dedup against plain versions, and on odd inputs."""

import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from shared import SF

from lakewarden.llm import ballmeans, queries, runs, suffix


def plain_runs(words, least=6, exponent=4):
    """Every period tried at every place."""
    found = {}
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j + q), q)  # periods come in order, so the smallest stays
            i = j + 1
    return sorted(((i, j - i, q) for (i, j), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    dropped = {k for i, length, q in found for k in range(i + q, i + length)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{i},{length},{q}\n" for i, length, q in found).encode()
    return (len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], sha(lines), sha(b" ".join(w for k, w in enumerate(words) if k not in dropped)))


def of_digest(df):
    return [(r.doc_id, (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)) for r in df.collect()]


@pytest.mark.parametrize("least,exponent", [(6, 4), (2, 2), (8, 2), (9, 3), (30, 5)])
def test_main_lorentz_finds_every_run(least, exponent):
    rnd = random.Random(least)
    for _ in range(400):
        words = [b"%d" % rnd.randrange(rnd.choice((1, 2, 3, 8))) for _ in range(rnd.randrange(60))]
        for _ in range(rnd.randrange(3)):
            unit = [b"%d" % rnd.randrange(4) for _ in range(rnd.randrange(1, 9))]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = (unit * 7)[: rnd.randrange(len(unit) * 7 + 1)]
        assert runs.runs_of(words, least, exponent) == plain_runs(words, least, exponent)


def test_periodic_runs_query_equals_plain_version(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = of_digest(queries.op11_periodic_runs(spark, SF))
    assert len(got) == len(docs) and sum(r[0] > 0 for _, r in got) > 10
    for doc_id, row in got:
        if len((docs[doc_id] or "").split()) < 1500:
            assert row == plain_digest(doc_id, docs[doc_id]), doc_id


def test_periodic_runs_on_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a"), (5, "a " * 5), (6, "a " * 6), (7, "x " + "b c " * 4 + "b d"), (7, "x " + "b c " * 4 + "b d"), (None, "z " * 9), (8, "é é " * 8), (9, "A a " * 9 + "a " * 7)]
    texts += [(100 + k, " ".join(random.Random(k).choices("ab", k=80))) for k in range(40)] + [(200, "w1 w2 w3 w4 w5 " * 30_000 + "end")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("w", F.lit(1)).withColumn("h", F.lit(2)).repartition(3)
    got = sorted(of_digest(runs.digest(runs.find_runs(runs.planted(df)))), key=str)
    want = sorted([(i, plain_digest(i, t)) for i, t in texts if i != 200], key=str)
    assert [r for r in got if r[0] != 200] == want
    long = next(r for i, r in got if i == 200)
    assert long[:5] == (1, 0, 150_000, 5, 30_000_000)
    assert runs.digest(runs.find_runs(runs.planted(df.where("false")))).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(df, exponent=1)


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * np.float64(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and None not in v and np.isfinite(np.array(v, float)).all()]
    centres = [x for _, x in sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]]
    for step in range(rounds + 1):
        own = [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centres)) for _, x in kept]
        if step < rounds:
            for n in range(len(centres)):
                mine = [x for (_, x), (_, m) in zip(kept, own, strict=True) if m == n]
                if mine:
                    centres[n] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    sums = defaultdict(int)
    for d, n in own:
        sums[n] += d
    return sorted(((i, n, d, sums[n], sum(sums.values()), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, own, strict=True)), key=str)


def of_clusters(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=str)


def test_ball_kmeans_equals_plain_version_on_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(i % 5, 0.3, 64)).tolist()) for i in range(260)]
    rows += [(300 + i, [0.015625 * (i % 3)] * 64) for i in range(40)]  # ties
    rows += [(i, [1.0] * 64) for i in (400, 400, 401)] + [(500, None), (501, [1.0] * 63), (502, [float("nan")] * 64), (503, [float("inf")] * 64), (504, [None] + [1.0] * 63), (505, []), (None, [2.0] * 64)]
    rows += [(600, [-0.0] * 64), (601, [30000.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash")).withColumn("x", F.lit(1)).repartition(5)
    assert of_clusters(ballmeans.cluster_vectors(df)) == plain_clusters(rows)
    few = [r for r in rows if r[0] in (3, 4, 400)]
    assert of_clusters(ballmeans.cluster_vectors(spark.createDataFrame(few, "vec_id long, embedding array<double>"))) == plain_clusters(few)
    assert ballmeans.cluster_vectors(df.where("false")).count() == 0
    huge = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)], "vec_id long, embedding array<double>")
    assert ballmeans.cluster_vectors(huge).count() == 3


def test_balls_spare_distances():
    rng = np.random.default_rng(5)
    centres = rng.integers(-40, 40, (16, 64))
    x = (centres[rng.integers(0, 16, 4000)] + rng.integers(-6, 7, (4000, 64))).astype(np.int64)
    own, _, full = ballmeans.assign(x, None, centres, [])
    moved = centres + rng.integers(-2, 3, centres.shape)
    radii = [int(np.sqrt(((x[own == i] - moved[i]) ** 2).sum(axis=1).max(initial=0))) + 1 for i in range(16)]
    got, least, work = ballmeans.assign(x, own, moved, ballmeans.balls(moved, radii))
    d = ballmeans.distances(x, moved)
    assert (got == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert work < full / 4


def plain_removed(rows, length):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k : k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        if i is not None:
            for k in range(len(b) - length + 1):
                if first[b[k : k + length]] < i:
                    gone[k : k + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def of_removed(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_suffix_dedup_query_equals_plain_version(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = of_removed(queries.op13_suffix_dedup(spark, SF))
    assert got == plain_removed(rows, 50) and sum(r[2] > 0 for r in got) > 10


@pytest.mark.parametrize("length,block,chunk", [(50, 1 << 16, 1 << 20), (50, 200, 99), (7, 64, 50), (12, 33, 1000)])
def test_suffix_dedup_on_odd_rows(spark, monkeypatch, length, block, chunk):
    monkeypatch.setattr(suffix, "BLOCK", block)
    monkeypatch.setattr(suffix, "CHUNK", chunk)
    rnd = random.Random(length)
    word = lambda: "".join(rnd.choices("abé", k=rnd.randrange(1, 6)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * 300), (9, "x" * 300), (9, "x" * 300), (7, "ab" * 200), (5, "ab" * 100), (None, passages[0]), (None, passages[0]), (12, passages[1]), (12, passages[1] + "!"), (12, "other " + passages[1][3:])]
    for i in range(60):
        parts = [" ".join(word() for _ in range(rnd.randrange(30)))]
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            parts += [p[a : a + rnd.randrange(120)], word()]
        rows.append((100 + rnd.randrange(90), "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("tag", F.lit(1)).withColumn("a", F.lit(1)).repartition(5)
    found = suffix.remove_repeats(df, length)
    assert of_removed(found) == plain_removed(rows, length)
    for r in found.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed
    assert suffix.remove_repeats(df.where("false"), length).count() == 0


def test_written_tables_leave_no_shuffle_files(spark):
    import time

    from lakewarden.llm.common import END_SHUFFLES, materialize, release

    def files():
        names = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {n.rpartition("/")[2] for n in names.split(",") if "/shuffle_" in n}

    before, own = files(), spark.conf.get(END_SHUFFLES)
    out = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 5
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and out.count() == 7 and spark.conf.get(END_SHUFFLES) == own
    release(out)
