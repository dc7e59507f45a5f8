"""Toxicity, quality, packing, language and piece operators against plain versions, and on odd inputs."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from shared import SF
from pyspark.sql import functions as F

from lakewarden.llm import langid, packing, piece, quality, queries, toxicity
from lakewarden.llm.common import crc_held_out

ODD = ["", None, " ", "\n\n", "a", "  two  spaces ", "tab\tand\nline", "é💥 ñ ß İ Σ", "▁▁x ▁", "word " * 30_000, "x" * 70_000, "1 2 3", "<|endoftext|> it's", "-- !!", "² ½ Ⅷ", "x² ½a"]


def odd(spark, *more):
    """Odd texts, each twice with one id, a null id, and columns whose names clash with results."""
    rows = [(i, t) for i, t in enumerate([*ODD, *more])]
    rows = [*rows, *rows[:3], (None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    return df.withColumn("score", F.lit("clash")).withColumn("start", F.lit(0)).withColumn("id", F.lit(1)), rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_pieces_equal_the_library(spark, docs):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    strange, rows = odd(spark, *(" " * k + "x\n" + " " * k for k in range(1, 36)), "\x00\x01", "<s></s><0x0A><unk>", "中文 かな العربية")
    for df in (strange, docs):
        texts = defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            ids = lib.encode(r.text or "", add_eos=True)
            texts[r.doc_id].append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
        got = defaultdict(list)
        for r in piece.encode_texts(df, path).collect():
            got[r.doc_id].append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    one = piece.encode_texts(strange.where("doc_id = 6"), path, keep_ids=True).first()
    assert piece.codec(path).decode(one.ids) == "tab\tand\nline"
    assert piece.encode_texts(strange.where("false"), path).count() == 0


def test_packing_holds_every_token_once(spark, docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    strange, _ = odd(spark)
    single = strange.dropDuplicates(["doc_id"])
    for df in (docs, single):
        want = {r.doc_id: np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in df.select("doc_id", "text").collect()}
        pieces = packing.pack_documents(df, path).collect()
        by_doc, by_seq = defaultdict(list), defaultdict(list)
        for p in pieces:
            ids = want[p.doc_id]
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) and p.length > 0
            by_doc[p.doc_id].append((p.start, p.length))
            by_seq[p.sequence_id].append((p.offset, p.length))
        assert by_doc.keys() == want.keys()
        for spans, size in [*((v, len(want[k])) for k, v in by_doc.items()), *((v, None) for v in by_seq.values())]:
            at = 0
            for start, n in sorted(spans):
                assert start == at
                at += n
            assert at == size if size is not None else at == packing.CAPACITY or at & (at - 1) == 0
    assert packing.pack_documents(strange.where("false"), path).count() == 0
    assert packing.pack_documents(strange, path).agg(F.sum("length")).first()[0] > 0


def test_packing_balances_cost():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1500, 900).tolist()
    cost = defaultdict(int)
    for _, _, n, seq, _ in packing.pack(lengths):
        cost[seq] += n * n
    full = sorted(cost.values())[20:]
    assert max(full) < 4 * np.median(full)


def plain_language(texts_by_lang, text):
    """Out-of-place distances with dictionaries."""
    from collections import Counter

    def ranks(text):
        c = Counter()
        for w in "".join(ch if ch.isalpha() else " " for ch in text.lower()).split():
            c.update(w)
            e = f" {w} "
            c.update(e[i : i + 2] for i in range(len(e) - 1))
            c.update(e[i : i + 3] for i in range(len(e) - 2) if e[i + 1] != " ")
        return c

    def key(g):
        k = 0
        for ch in g:
            k = k << 21 | ord(ch)
        return k

    def top(c):
        return [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], key(x[0])))[: langid.PROFILE]]

    profiles = {}
    for lang, texts in texts_by_lang.items():
        total = Counter()
        for t in texts:
            total.update(ranks(t))
        profiles[lang] = {g: i for i, g in enumerate(top(total))}
    own = top(ranks(text))
    if not own:
        return "und"
    return min(sorted(profiles), key=lambda lang: sum(abs(profiles[lang][g] - i) if g in profiles[lang] else langid.PROFILE for i, g in enumerate(own)))


def test_language_equals_plain_version(spark, docs):
    rows = docs.select("doc_id", "text", "lang").collect()
    learn = defaultdict(list)
    for r in rows:
        if not crc_held_out(r.doc_id):
            learn[r.lang].append(r.text)
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(got[r.doc_id].lang_pred == plain_language(learn, r.text) for r in rows[:60])
    assert langid.letter_words("x² ½a Ⅷ é_ß") == ["x", "a", "é", "ß"]
    held = [r for r in rows if crc_held_out(r.doc_id)]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held) and all(got[r.doc_id].held_out for r in held)
    strange, odd_rows = odd(spark)
    out = langid.predict(strange, model).collect()
    assert len(out) == len(odd_rows)
    und = {r.doc_id for r in out if r.lang_pred == "und"}
    assert und == {i for i, t in enumerate(ODD) if not t or not any(c.isalpha() for c in t)}
    assert all(0 <= r.score <= 1 for r in out)
    assert langid.keep_known(strange, model).columns == strange.columns and langid.identify(strange, model).count() == len(odd_rows)
    empty = langid.fit(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(strange, empty).collect()} == {"und"}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(out[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
    return out


def test_automaton_meets_trie():
    terms = {"idiot": 5.0, "stupid": 4.0, "clown": 3.0, "vile": 2.0}
    trie = toxicity.LexiconTrie(terms)
    for word in ("idiot", "idio", "idiott", "1diot", "idoit", "stupd", "stupidd", "clovn", "clowns", "clean", "vil", "vilex", "x"):
        want = {t for t in terms if plain_distance(word, t) <= 1}
        assert set(trie.intersect(word)) == want
        weight, fuzzy = trie.match(word)
        assert (weight > 0) == (word in terms or (len(word) >= toxicity.FUZZY_LENGTH and bool(want))) and fuzzy in (False, word not in terms)


def test_quoted_terms_count_less():
    trie = toxicity.LexiconTrie({"idiot": 5.0})
    abuse, quoted = toxicity.features(trie, "you are an idiot"), toxicity.features(trie, 'the word "idiot" was heard')
    assert abuse[0] > 0 and abuse[3] > 0 and quoted[0] == 0 and quoted[2] > 0 and toxicity.features(trie, "fine") is None


def plain_toxicity(terms, text):
    """Sums over hits by comparing every word with every term."""
    import math

    low = text.lower()
    words = [(m.group(), m.start()) for m in toxicity.WORDS.finditer(low)]
    marks = [m.start() for m in toxicity.QUOTES.finditer(low)]
    exact = fuzzy = quoted = addressed = top = 0.0
    for i, (w, at) in enumerate(words):
        weight = terms.get(w, 0.0)
        misspelled = not weight and len(w) >= toxicity.FUZZY_LENGTH
        if misspelled:
            weight = max((v for t, v in terms.items() if plain_distance(w, t) <= 1), default=0.0)
        if weight <= 0:
            continue
        before = sum(m < at for m in marks)
        if (before % 2 and before < len(marks)) or any(x in toxicity.REPORTING for x, _ in words[max(0, i - toxicity.WINDOW) : i]):
            quoted += weight
        elif misspelled:
            fuzzy += weight
        else:
            exact += weight
            addressed += weight * any(x in toxicity.ADDRESS for x, _ in words[max(0, i - toxicity.WINDOW) : i + toxicity.WINDOW + 1])
            top = max(top, weight)
    return [math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), math.log1p(addressed), top / 10, (exact + fuzzy) / max(1, len(words))]


def test_toxicity_equals_plain_version(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.join(labels.orderBy(F.desc("toxic"), "doc_id").limit(60), "doc_id", "left_semi").collect()}
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    hits = 0
    for i, text in texts.items():
        x = plain_toxicity(model.terms, text)
        hits += any(x)
        assert abs(got[i] - 1 / (1 + np.exp(-np.clip(model.weights[0] + np.dot(model.weights[1:], x), -30, 30)))) < 1e-9
    assert hits > 20
    assert toxicity.score(docs.where("false"), toxicity.fit(docs.where("false"), labels)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.9 * len(held)
    strange, rows = odd(spark)
    scored = toxicity.score(strange, model).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (0, 1, 2, 3)}) == 1
    none = toxicity.fit(docs, labels.where("false"))
    assert {r.score for r in toxicity.score(strange, none).collect()} == {0.0}


def test_quality_follows_the_labels_it_never_saw(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs)
    out = quality.score(docs, model).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in out) >= 0.97 * len(out)
    strange, rows = odd(spark)
    scored = quality.score(strange, model).collect()
    assert len(scored) == len(rows) and {r.score for r in scored if r.doc_id in (0, 1, 2, 3)} == {0.0}
    assert quality.keep_good(strange, model).columns == strange.columns
    assert quality.score(docs.where("false"), quality.fit(docs.where("false"))).count() == 0


def test_samples_of_null_and_repeated_ids(spark):
    """All ids null, or one id for all rows: junk is told apart as with ids of their own, and samples stay bounded."""
    good = spark.range(9000).selectExpr("concat_ws(' ', transform(sequence(1, 60), i -> element_at(array('the', 'river', 'of', 'time', 'and', 'stone', 'was', 'under', 'a', 'quiet', 'morning'), cast(1 + xxhash64(id, i) % 11 + if(xxhash64(id, i) < 0, 10, 0) as int))), '.') AS text", "true AS fine")
    junk = spark.range(9000).selectExpr("concat_ws(' ', transform(sequence(1, 40), i -> concat('$$', hex(xxhash64(id, i)), '%%'))) AS text", "false AS fine")
    both = good.union(junk).cache()
    for key in (F.lit(None).cast("long"), F.lit(7).cast("long")):
        docs = both.withColumn("doc_id", key)
        model = quality.fit(docs)
        kept = quality.keep_good(docs, model).groupBy("fine").count().collect()
        assert abs(model.weights).sum() > 0 and {r.fine: r["count"] for r in kept} == {True: 9000}
    both.unpersist()
    same = spark.range(50_000).selectExpr("7L AS doc_id", "'the same words again and again' AS text", "'en' AS lang", "1 AS toxic")
    quality.fit(same)
    model = toxicity.fit(same, spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, toxic int"), fit_rows=100)
    assert len(model.weights) == toxicity.FEATURES + 1
    assert langid.fit(same.withColumn("doc_id", F.lit(None).cast("long"))).langs == []


def test_tokenizers_of_other_rules_are_refused(tmp_path):
    import json

    from public_tokenizers import path

    spec = json.loads(open(path("word_bpe_49k.json")).read())
    packing.check_settings(spec)
    for part, other in (("normalizer", None), ("pre_tokenizer", {"type": "Whitespace"}), ("post_processor", {"type": "x"})):
        with pytest.raises(ValueError):
            packing.check_settings(spec | {part: other})


def test_quality_equals_plain_version(spark):
    """Scores from dictionaries of shapes, and posteriors by Bayes' rule, for a fitted model."""
    import math

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs)
    rows = docs.select("doc_id", "text").collect()[:80] + [(10**6, "A1-" * 30 + "x " + "A1-" * 30 + "yZ9")]
    df = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.score(df, model).collect()}
    for i, text in rows:
        m, words = quality.measures(text), text.split()
        share = defaultdict(float)
        for w in words:
            shape = w
            for pattern, sign in quality.SHAPES:
                shape = pattern.sub(sign, shape)
            share[zlib.crc32(f"shape {shape}".encode()) % quality.BUCKETS] += 1 / len(words)
        x = defaultdict(float, {k: math.sqrt(v) for k, v in share.items()})
        for name, value in m.items():
            level = int(10 * math.log2(1 + value)) if name in ("words", "length") else int(10 * value)
            x[zlib.crc32(f"{name} {level}".encode()) % quality.BUCKETS] += 0.5
        z = model.bias + sum(model.weights[k] * v for k, v in x.items())
        assert abs(got[i].score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9
        good, bad = model.good, 1 - model.good
        for j, (_, vote) in enumerate(quality.LABELLERS):
            good, bad = good * model.rates[j, 1, vote(m)], bad * model.rates[j, 0, vote(m)]
        assert abs(got[i].posterior - good / (good + bad)) < 1e-6


def test_expectation_maximisation_finds_the_rates():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.7
    right = np.array([0.9, 0.8, 0.85, 0.7])
    v = np.where(rng.random((len(good), 4)) < right, np.where(good, 2, 1)[:, None], np.where(good, 1, 2)[:, None])
    seen = defaultdict(int)
    for row in map(tuple, v.tolist()):
        seen[row] += 1
    share, rates = quality.expectation_maximisation(sorted(seen.items()))
    assert abs(share - 0.7) < 0.03 and np.allclose(rates[:, 1, 2], right, atol=0.03) and np.allclose(rates[:, 0, 1], right, atol=0.04)
