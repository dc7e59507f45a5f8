"""Top-k, near-duplicate, URL and PII operators and the pipeline against brute force, and on odd inputs."""

import hashlib
import random

import brute
import numpy as np
import pytest
from shared import SF, rows_of
from pyspark.sql import functions as F

from lakewarden.llm import common, embdedup, minhash, pii, queries, topk, urlfilter
from lakewarden.llm.common import connected_components


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_oracles(spark, duck, name):
    assert rows_of(queries.queries()[name](spark, SF).toPandas()) == rows_of(duck.execute(queries.oracle_sql()[name]).df())


def test_components(spark, monkeypatch):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 600)] + [(700, x) for x in range(701, 900)] + [(1, 1), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    nodes = {x for a, b in edges for x in (a, b) if a is not None and a != b}
    assert got == brute.components(nodes, [e for e in edges if None not in e])
    monkeypatch.setattr(common, "CONTRACT_ROWS", 20)  # in rounds to the end
    assert {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()} == got
    monkeypatch.setattr(common, "CONTRACT_ROWS", 560)  # in rounds, then in one step
    assert {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()} == got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(spark, rows):
    rows = [(i, v and [x if x is None else float(x) for x in v], lab) for i, v, lab in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("clash")).withColumn("x", F.lit(1))


def odd_vectors():
    rng = np.random.default_rng(7)
    out = [(i, (rng.integers(-3, 4, 6) / 4).tolist(), int(i % 3)) for i in range(120)]
    out += [(200 + i, [0.5, 0.25, 0, 0, 0, -0.5], 1) for i in range(30)]  # copies
    out += [(300, None, 1), (301, [1.0, None, 0, 0, 0, 0], 1), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 1), (304, [0.0] * 6, 1), (305, [1.0] * 6, None), (306, [1.0, 0.0], 1), (307, [2.0, 0.0], 1), (350, [], 1), (None, [1.0] * 6, 1)]
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    for name, n in (("BLOCK_ROWS", 37), ("QUERY_ROWS", 2), ("LEAST_ROWS", 20), ("LEAST_QUERIES", 1)):
        monkeypatch.setattr(topk, name, n)
    rows = odd_vectors()
    good = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all()]
    want = {}
    for q, x in good:
        if q % 10 == 0:
            found = sorted(((-int(x @ y), i) for i, y in good if i != q and len(y) == len(x)))[:5]
            want |= {(q, k): (i, -s) for k, (s, i) in enumerate(found, 1)}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(vectors(spark, rows), every=10).collect()}
    assert got == want
    assert topk.top_k(vectors(spark, rows).where("false")).count() == 0


def test_top_k_takes_large_components_and_every_row_of_an_id(spark):
    rows = [(50, [5000.0, 1.0, -2.0]), (50, [1.0, -70000.5, 3.0]), (51, [1e6, 1e6, -1e6]), (52, [-4096.0, 3.0, 1e7]), (53, [0.5, 0.25, 0.0]), (50, [1.0, -70000.5, 3.0]), (100, [1e5, -1e5, 7.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [[int(np.floor(256 * x)) for x in v] for _, v in rows]
    want = []
    for a, (q, _) in enumerate(rows):
        if q % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(whole[a], whole[b], strict=True)), rows[b][0]) for b in range(len(rows)) if b != a)[:5]
            want += [(q, k, i, -s) for k, (s, i) in enumerate(found, 1)]
    assert sorted(map(tuple, topk.top_k(df).collect())) == sorted(want)


def test_scores_beyond_a_long_end_at_its_end_in_every_block(spark, monkeypatch):
    for name, n in (("BLOCK_ROWS", 2), ("QUERY_ROWS", 1), ("LEAST_ROWS", 2), ("LEAST_QUERIES", 1)):
        monkeypatch.setattr(topk, name, n)
    rows = [(50, [1e18, 0.0]), (1, [1e18, 1.0]), (2, [9e17, 0.0]), (3, [-1e18, 0.0]), (4, [1.0, 1.0]), (5, [1e18, -5.0]), (7, [0.0, 0.0])]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    top = 2**63 - 1
    assert [(k, i, s) for _, k, i, s in got] == [(1, 1, top), (2, 2, top), (3, 4, top), (4, 5, top), (5, 7, 0)]


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embdedup, "BLOCK", 11)
    monkeypatch.setattr(embdedup, "PIVOT_ROWS", 8)
    rows = odd_vectors()
    good = {i: (np.array(v, float), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v) != 0)}
    links = [(a, b) for a in good for b in good if a != b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] / np.linalg.norm(good[a][0]) / np.linalg.norm(good[b][0]) >= 0.93]
    cosines = [good[a][0] @ good[b][0] / np.linalg.norm(good[a][0]) / np.linalg.norm(good[b][0]) for a in good for b in good if len(good[a][0]) == len(good[b][0])]
    assert min(abs(c - 0.93) for c in cosines) > 1e-9  # no borderline pairs
    comp = brute.components([r[0] for r in rows if r[0] is not None], links)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embdedup.link_vectors(vectors(spark, rows)).collect()}
    assert got.pop(None) == (0, None, True)
    assert got == {i: (sum(a == i for a, _ in links), c, c == i) for i, c in comp.items()}
    assert embdedup.link_vectors(vectors(spark, rows).where("false")).count() == 0


def near_texts():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    out = []
    for g in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randrange(30, 200))]
        for _ in range(rnd.randrange(1, 9)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append(" ".join(copy))
    dense = [rnd.choice(words) for _ in range(150)]
    for _ in range(260):  # a dense region: all alike, few linked
        copy = list(dense)
        for _ in range(rnd.randrange(0, 6)):
            copy[rnd.randrange(len(copy))] = rnd.choice(words)
        out.append(" ".join(copy))
    return [*out, *out[:20], "", None, "   \n", "one", "ONE", "one two three four", "One  Two\tthree four", "a b c d e", "é è", "x " * 20_000]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(spark, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 100)
    rows = list(enumerate(near_texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("size", F.lit(2)).withColumn("n", F.lit(3))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.link_documents(df, percent, region=20).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in brute.near_duplicates(rows, percent).items()}


def test_dense_regions_keep_their_links(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(280)]

    def changed(words, n):
        return [f"x{rnd.random()}" if i in at else w for at in [set(rnd.sample(range(280), n))] for i, w in enumerate(words)]

    own = [changed(base, 2) for _ in range(40)]  # all some 0.7 alike, each linked to its twin alone at little over 0.8
    rows = list(enumerate(" ".join(changed(words, 3)) for words in own for _ in range(2)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 80, region=1).collect()}
    want = brute.near_duplicates(rows, 80)
    assert sum(c != i for i, (_, c) in want.items()) == 40
    assert sum(got[i] != want[i] for i in want) == 0


def shuffled(spark, work) -> int:
    """Bytes that work writes to shuffles."""
    sc = spark.sparkContext
    doubles, statuses = sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList()

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = sc._jsc.sc().statusStore().stageList(None, False, False, doubles, statuses)
        return {x.stageId(): x.shuffleWriteBytes() for x in map(found.apply, range(found.size()))}

    before = stages()
    work()
    return sum(n for k, n in stages().items() if k not in before)


def test_regions_shuffle_no_whole_signatures(spark):
    from lakewarden.llm.common import Scratch

    rnd = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    dense = [" ".join([*base, f"x{k}"]) for k in range(30)]  # alike in most places: dense at every level
    rows = [*enumerate(dense), *((100 + i, " ".join(f"v{rnd.random()}" for _ in range(40))) for i in range(3000))]
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the ids are too many to be broadcast
    try:
        with Scratch() as tables:
            signed = tables.write(spark.createDataFrame(rows, "id long, text string").mapInArrow(minhash._sign, "id long, n long, k1 long, k2 long, sig binary"))
            reps = tables.write(signed.select("id", "n"))
            found = []
            size = shuffled(spark, lambda: found.extend(minhash.forest_regions(signed.select("id", "sig"), reps, tables, 20)))
            at_last = found[1].where(f"depth = {minhash.DEPTH}").select("id").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    assert at_last == len(dense)
    assert size < len(rows) * 2 * minhash.PLACES  # a signature of each document is more


def test_near_duplicates_on_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in minhash.link_documents(df).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (1, 1, True), (2, 1, False)]
    assert sorted(r.doc_id or -1 for r in minhash.keep_one(df).collect()) == [-1, -1, 1]
    assert minhash.link_documents(df.where("false")).count() == 0


def test_rows_of_an_id_with_different_texts_keep_their_links(spark):
    a, b = "one two three four five six seven", "alpha beta gamma delta epsilon zeta eta"
    rows = [(5, a), (5, b), (2, b), (7, a), (9, "nothing like these words here at all"), (9, "nothing like these words here at all"), (5, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in minhash.link_documents(df).collect())
    assert got == [(2, 2), (5, 2), (7, 2), (9, 9)]
    kept = sorted((r.doc_id, r.text) for r in minhash.keep_one(df).collect())
    assert kept == [(2, b), (7, a), (9, rows[4][1])]
    clash = df.selectExpr("doc_id", "text", "text as id", "1 as n", "2 as component", "3 as differ")
    assert minhash.keep_one(clash).columns == clash.columns and minhash.keep_one(clash).count() == 3


def test_ids_of_their_own_keep_away_from_real_ones(spark):
    base = "one two three four five six seven eight nine ten"
    rows = [(7, base), (7, "other words of the same id that are quite different from it all"), ((1 << 62) + 5, base + " eleven"), ((1 << 62) + (1 << 61) + 1, "alone"), ((1 << 62) + 9, base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert minhash._free_stretch(df) == 1 << 61
    got = {r.doc_id: (r.component_id, r.kept) for r in minhash.link_documents(df).collect()}
    assert got == {7: (7, True), (1 << 62) + 5: (7, False), (1 << 62) + 9: (7, False), (1 << 62) + (1 << 61) + 1: ((1 << 62) + (1 << 61) + 1, True)}


def test_filter_of_ids_and_join_give_the_same_sets(spark):
    from lakewarden.llm.common import Scratch

    texts = spark.createDataFrame([(i, f"text number {i} of some words") for i in range(50)], "id long, text string")
    need = texts.where("id % 5 = 0").select("id")
    with Scratch() as tables:
        by = [{r.id: r.shingles for r in minhash.full_sets(texts, need, tables, n).join(need, "id").collect()} for n in (1, 1000)]
    assert by[0] == by[1] and len(by[0]) == 10


def test_word_hashes_do_not_depend_on_parts(monkeypatch):
    import pyarrow as pa

    giant = "Q" * 9000
    text = " ".join([f"word{i}" for i in range(3000)] + [giant, "and", "more", giant + "x"] + [f"w{i}" for i in range(3000)])
    whole = list(minhash.sets_of(pa.array([text, "a b"])))
    monkeypatch.setattr(minhash, "CHUNK", 5000)
    parts = list(minhash.sets_of(pa.array([text, "a b", "", None])))
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all() and len(whole[0]) == len(brute.shingles(text)) and len(parts) == 4


def test_shingles_equal_plain_sets():
    import pyarrow as pa

    texts = ["A b C d e f", "x", "", None, "a b c d e a b c d e a b c d e", "é É ß", "a\x0bb\x0cc d e f"]
    for t, s in zip(texts, minhash.sets_of(pa.array(texts, pa.string())), strict=True):
        assert len(s) == len(brute.shingles(t))


def test_digitless_seeds_find_a_dashed_number(spark):
    names = ["anna", "bela", "cora", "dora", "edda", "fina", "gina", "hana", "inga", "jana", "kira", "lena"]
    rows = [(i, f"contact {n}@mail.org today") for i, n in enumerate(names)] + [(50, "contact 123-45-6789 today"), (51, "contact 1234567890123456 today")]
    got = {r.doc_id: r.spans for r in pii.find_entities(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == "id:8:19"
    assert got[51] == ""  # a failed card
    assert got[0] == "email:8:21"


RULES = urlfilter.rules_of(
    (("net/", "block"), ("example.net/en/", "allow"), ("b.org/de", "block"), ("plain.com", "block"), ("A.com/Case/", "block")),
    (("ads", r"/ads/", ("ads",), "block"), ("zip", r"\.zip$", (), "block")),
)
URLS = ["http://x.net/", "http://x.net", "HTTP://WWW.Example.NET/en/1?q#f", "http://example.net/english", "http://notnet/", "http://a.b.org/december", "http://plain.com", "http://sub.plain.com/x", "http://xplain.com/", "https://a.com/Case/x", "https://A.COM/case/x", "http://q.com/ads/1", "http://net.com/ads/a.zip", "http://q.com/A.ZIP", None, "", "no scheme/ads/", "http://", "http:///net/", "http://é.net/x", "a://b://c.net/"]


def test_url_filter_equals_each_rule_tried(spark):
    import duckdb

    rows = [(i, u) for i, u in enumerate(URLS)]
    rows += rows[:4] + [(0, "http://other.net/"), (None, "http://x.net/")]
    rows += [(900, "http://long.net/" + "a/" * 100_000), (901, "https://" + "sub." * 20_000 + "example.com/de/x"), (902, "http://c.org/?" + "q=1&" * 50_000 + "phpsessid=1")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("token", F.lit(1)).withColumn("name", F.lit("clash"))
    c = duckdb.connect()
    frame = df.select("page_id", "url").toPandas()
    c.register("frame", frame)
    c.execute("CREATE VIEW pages AS SELECT CAST(page_id AS BIGINT) AS page_id, url FROM frame")
    got = urlfilter.filter_urls(df, RULES).toPandas()
    plain = lambda f: rows_of(f.assign(page_id=f.page_id.fillna(-1).astype(int)))
    assert plain(got) == plain(c.execute(urlfilter.oracle(RULES)).df())
    rule = {u: r for u, r in zip(URLS, [next((x.rule for x in got.itertuples() if x.page_id == i), None) for i in range(len(URLS))], strict=True)}
    assert rule["http://x.net/"] == "net/" and rule["HTTP://WWW.Example.NET/en/1?q#f"] == "example.net/en/" and rule["http://a.b.org/december"] == "b.org/de"
    assert urlfilter.filter_urls(df, []).where("verdict <> 'allow'").count() == 0 and urlfilter.filter_urls(df.where("false")).count() == 0
    monkey = urlfilter.BROADCAST_RULES
    try:
        urlfilter.BROADCAST_RULES = 0
        assert plain(urlfilter.filter_urls(df, RULES).toPandas()) == plain(got)
    finally:
        urlfilter.BROADCAST_RULES = monkey


ODD_TEXTS = ["ip 10.0.0.1 x", "0.0.0.0 1.2.3.0000000000 99999999999.1.1.1 1.1.1.256 255.255.255.255 1.1.1.300", "٣.1.1.1 ١٢٣٤ 1.1.1.1", "x@y.z, a@b.c_d@e.f 1.2.3.4.5.6.7.8 300.1.1.1 4111 1111 1111 1111 4111-1111-1111-1111-1 +1 (23) 45678901 +1-2", "é💥 a.b@c-d.ef. 4111111111111111 4111111111111112 007.08.9.1 1.1.1.0256", "a@b", "@", "+", "1" * 5000, "a@" + "b." * 5000, "a@@b.c a@b..c", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "+1 2 3 4 5 6 7 8 9 + 1 x", None, "", "x" * 60_000, "1.1.1." * 200, "+(" * 300]


def test_base_entities_equal_plain_regexes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(10**6 + i, t) for i, t in enumerate(ODD_TEXTS)]
    df = docs.union(spark.createDataFrame([*rows, rows[0], (None, "a@b.c")], "doc_id long, text string")).withColumn("id", F.lit(0)).withColumn("spans", F.lit(""))
    texts = {r.doc_id: r.text for r in df.collect()}
    got = pii.find_entities(df).collect()
    assert len(got) == df.count()
    for r in got:
        found = brute.entities(texts[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in found[k])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(found[k]) for k in pii.KINDS]
        assert ",".join(p for p in r.spans.split(",") if not p.startswith("id:")) == text
    assert pii.find_entities(df.where("false")).count() == 0


def test_bootstrap_finds_identifiers_in_the_contexts_of_seeds(spark):
    rows = [(i, f"some words then account {k} and more") for i, k in enumerate([f"u{i}@mail.org" for i in range(30)] + ["AB12-9988-7766", "4111111111111112"])]
    rows += [(100 + i, f"version 2.{i} of AB12-0000-77{i:02} here") for i in range(40)]
    got = {r.doc_id: r for r in pii.find_entities(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[30].spans == "id:24:38" and got[31].n_id == 0 and all(got[i].n_id == 0 for i in range(100, 140))
    red = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert red[0] == "some words then account [EMAIL] and more" and red[30] == "some words then account [ID] and more" and red[100] == rows[32][1]


def test_bootstrap_equals_plain_version(spark):
    rnd = random.Random(2)
    rows = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    for i in range(60):
        rows.append(rnd.choice(["please write to {} soon", "member no {} of the club", "({}) ticket ref", "order {} was sent"]).format(rnd.choice([f"u{i}@mail.org", f"10.0.{i}.7", f"ZX-{i}-{7000 + i}", f"{i}88-11-22{i}", "4111 1111 1111 1111", "4111111111111112"])))
    rows += ["x" * 500 + " write to AB-1234-5678 soon", "", None, "member no QQ-9999-1111 of the club"]
    got = {r.doc_id: r.spans for r in pii.find_entities(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    want = brute.identifiers(rows)
    assert sum(map(len, want.values())) > 10
    for i in range(len(rows)):
        assert [p for p in got[i].split(",") if p.startswith("id:")] == [f"id:{a}:{b}" for a, b in want.get(i, [])], rows[i][:200]


def test_found_identifiers_seed_later_rounds(spark):
    rows = [(i, f"reach user at {k} ok") for i, k in enumerate([f"u{i}@mail.org" for i in range(20)] + [f"KX-{1000 + i}-22" for i in range(12)])]
    rows += [(100 + i, f"badge code {f'KX-{1000 + i}-22' if i < 12 else f'MM-{5000 + i}-33'} here") for i in range(15)]
    got = {r.doc_id: r.spans for r in pii.find_entities(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == "id:14:24" for i in range(20, 32)) and all(got[i] == "id:11:21" for i in range(100, 115))


def test_rounds_go_on_until_nothing_new_is_found(spark):
    """Seven families of identifiers, each found in the contexts of the one before."""
    rows, n = [], 0
    for k in range(8):  # family k stands in contexts k - 1 and k; family 0 are addresses
        for j in range(36):
            token = f"u{j}@mail.org" if k == 0 else f"{'ABCDEFGH'[k] * 2}-{1000 * k + j}-77"
            for c in (k - 1, k, k):
                if c >= 0:
                    rows.append((n, f"p{n} {'context' + 'abcdefgh'[c]} {token} q{n}"))
                    n += 1
    got = {r.doc_id: r.spans for r in pii.find_entities(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.identifiers([t for _, t in rows])
    found = {i for i, spans in got.items() if "id:" in spans}
    assert found == set(want) == {i for i, t in rows if "@" not in t}


def test_secrets_are_found_in_their_context(spark):
    rnd = random.Random(3)
    rows = [(i, f"w{'ab' * i} token = \"{rnd.getrandbits(160):040x}\" v{'cd' * i}") for i in range(40)]
    rows += [(100, 'beta token = "AB12-CD34-9" gamma'), (101, f"beta lone {rnd.getrandbits(160):040x} gamma"), (102, "beta version 1.2.3 of 2024-11-05 gamma")]
    got = {r.doc_id: r for r in pii.find_entities(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].n_id == 1 for i in range(40)) and got[100].n_id == 1 and got[101].n_id == got[102].n_id == 0


def test_personal_data_of_long_texts(spark):
    import time

    many = "💥 " + " ".join(f"{i % 250}.1.1.1" if i % 2 else f"a{i}@b.org," for i in range(4000)) + " end"
    rows = [(1, " ".join(str(i) for i in range(200_000))), (2, many), (3, "w" * 300 + " " + "y" * 50 + " 1.2.3.4")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    began = time.time()
    got = {r.doc_id: r for r in pii.find_entities(df).collect()}
    assert time.time() - began < 60 and got[2].n_email == got[2].n_ip == 2000 and got[3].spans == "ip:352:359"
    red = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert red[2] == "💥 " + " ".join("[IP]" if i % 2 else "[EMAIL]," for i in range(4000)) + " end" and red[1] == rows[0][1]


def test_pipeline_stages_on_odd_rows_and_none(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40)
    names = ("id", "n", "component", "differ", "score", "lang_pred", "own_key", "token", "spans", "start")
    clash = docs.union(docs.limit(6)).withColumns({c: F.lit(7) for c in names})
    for name, stage in P.STAGES:
        out = stage(spark, clash, SF)
        none = stage(spark, clash.where("false"), SF)
        if name != "packing":
            assert out.columns == none.columns == clash.columns, name
            kept = out.collect()
            assert {r.doc_id for r in kept} <= {r.doc_id for r in docs.collect()} and all(r[c] == 7 for r in kept for c in names)
            assert len(kept) > 20 and (name != "near_dedup" or len({r.doc_id for r in kept}) == len(kept))
        assert none.count() == 0, name


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (None, "And the of in to a clean text, with words in it.", "en", "s", 5), (10**6 + 1, "", "en", None, 0)], docs.schema)
    df = docs.union(extra)
    before = {r.doc_id: r.text for r in df.collect()}
    kept = df
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
        kept = P.materialize(kept)
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= set(before) and len(ids) > 0.5 * docs.count()
        if name == "near_dedup":
            groups = brute.near_duplicates([(i, before[i]) for i in ids if i is not None], 80)
            assert all(c == i for i, (_, c) in groups.items())
    for r in kept.collect():
        assert not any(brute.entities(r.text).values()) and r.n_chars == len(r.text)
    assert P.STAGES[-1][1](spark, kept, SF).count() >= kept.count()
    assert P.run(spark, SF).count() > 0
    assert [n for n, _ in P.STAGES] == ["language_id", "quality", "near_dedup", "pii", "packing"]
