"""Operator 3: quality by a weak-label model.

Heuristic labellers each call a document good, bad, or abstain. Expectation-maximisation over the votes of all
documents estimates how often each labeller votes each way on good and on bad documents, and so the probability that a
document is good given its votes. These posteriors, not any hand-made label, train a linear scorer over hashed word
shapes and measures, whose score decides.

The votes of all documents are counted by pattern; there are at most 3 ** len(LABELLERS) patterns, so what reaches the
driver is bounded. The scorer is fitted on at most about FIT_ROWS documents, a bound that doesn't grow.

Defined results: a null text counts as empty; texts without words get no votes and score 0. Repeated rows and null ids
are scored row by row. An empty table gives an empty result. Other columns are never read; whole texts are.
"""

from __future__ import annotations

import math
import operator
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SAMPLE_SLACK, Recent, held_out, sample_place

FIT_ROWS = 4000
BUCKETS = 1024
CACHE_ROWS = 40_000
GOOD, BAD, ABSTAIN = 2, 1, 0
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
DIGIT, SPACE = bytes(range(48, 58)), bytes([32, *range(9, 14)])
PLAIN_MARKS = b".,;:?'\"()-"
OTHER_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in PLAIN_MARKS)


def measures(text: str) -> dict[str, float]:
    """Shares and counts that the labellers look at."""
    raw = text.encode()
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    upper, lower = count(UPPER), count(LOWER)
    solid = max(1, len(raw) - count(SPACE))
    return {
        "words": len(words),
        "marks": count(OTHER_MARKS) / solid,
        "upper": upper / max(1, upper + lower),
        "digits": count(DIGIT) / solid,
        "distinct": len(set(words)) / n,
        "repeats": sum(map(operator.eq, words, words[1:])) / n,
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
        "length": solid / n,
        "bars": words.count("|") / n,
        "stops": sum(count(c) for c in (b".", b",")) / n,
    }


def _bad_if(test) -> int:
    return BAD if test else ABSTAIN


#: (name, vote on measures). A labeller that knows one fault says nothing of documents without it.
LABELLERS = (
    ("marks", lambda m: _bad_if(m["marks"] > 0.05)),
    ("capitals", lambda m: _bad_if(m["upper"] > 0.3)),
    ("stutter", lambda m: _bad_if(m["repeats"] > 0.15)),
    ("few words", lambda m: _bad_if(m["words"] >= 20 and m["distinct"] < 0.3)),
    ("same lines", lambda m: _bad_if(m["lines"] > 0.5)),
    ("long words", lambda m: _bad_if(m["words"] >= 30 and m["length"] > 7.3)),
    ("tables", lambda m: _bad_if(m["bars"] > 0.12)),
    ("prose", lambda m: GOOD if m["marks"] <= 0.02 and m["upper"] <= 0.15 and (m["repeats"] <= 0.04 or m["repeats"] * m["words"] < 1.5) and m["bars"] <= 0.03 and m["lines"] <= 0.4 else ABSTAIN),
    ("sentences", lambda m: GOOD if m["words"] >= 4 and 0.02 <= m["stops"] <= 0.4 and m["marks"] <= 0.03 else ABSTAIN),
    ("varied", lambda m: GOOD if m["words"] >= 4 and m["distinct"] >= 0.45 and m["length"] <= 6.8 and m["bars"] <= 0.03 and m["marks"] <= 0.03 else ABSTAIN),
)
SHAPES = ((re.compile(r"[^\W\d_]*[^\W\d_A-ZÀ-ÞŒ][^\W\d_]*"), "a"), (re.compile(r"[^\W\d_]+"), "A"), (re.compile(r"\d+"), "0"))
_shape_of = Recent(CACHE_ROWS)


def shape_bucket(word: str) -> int:
    """Hash bucket of a word's shape: runs of letters and digits each become one sign, marks stay."""
    found = _shape_of.find(word)
    if found is None:
        shape = word
        for pattern, sign in SHAPES:
            shape = pattern.sub(sign, shape)
        found = zlib.crc32(f"shape {shape}".encode()) % BUCKETS
        if len(word) <= 64:
            _shape_of.keep(word, found)
    return found


def votes(m: dict[str, float]) -> tuple[int, ...]:
    return tuple(vote(m) for _, vote in LABELLERS) if m["words"] else (ABSTAIN,) * len(LABELLERS)


def hashed(text: str, m: dict[str, float]) -> np.ndarray:
    """Feature vector: square roots of the shares of word shapes, and hashed marks of each measure's tenth."""
    words = text.split()
    known = _shape_of
    at = np.array([known[w] if w in known else shape_bucket(w) for w in words], np.int64)
    x = np.sqrt(np.bincount(at, minlength=BUCKETS) / max(1, len(words)))
    for name, value in m.items():
        level = int(10 * math.log2(1 + value)) if name in ("words", "length") else int(10 * value)
        x[zlib.crc32(f"{name} {level}".encode()) % BUCKETS] += 0.5
    return x


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents, and rates [labeller, class, vote] with class 1 for good, from counted vote patterns.

    Abstaining is a vote like the others, in either step: that a labeller of one fault is silent tells a little. The
    classes are told apart by where it starts: good documents get good votes. Votes count as independent within a
    class; a rate has a weak prior of honest voting.
    """
    v = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    k = v.shape[1]
    prior = np.array([[1.0, 2.0, 0.5], [1.0, 0.5, 2.0]])
    rates = np.tile(np.array([[0.3, 0.5, 0.2], [0.3, 0.1, 0.6]]), (k, 1, 1))
    good = 0.8
    for _ in range(rounds):
        q = posterior(v, good, rates)
        fresh = (n @ q + 4) / (n.sum() + 5)
        for j in range(k):
            for c, w in enumerate((n * (1 - q), n * q)):
                total = np.bincount(v[:, j], weights=w, minlength=3) + prior[c]
                rates[j, c] = total / total.sum()
        if abs(fresh - good) < 1e-9:
            break
        good = fresh
    return good, rates


def posterior(v: np.ndarray, good: float, rates: np.ndarray) -> np.ndarray:
    """Probability of good for each row of votes."""
    log = np.log(rates)
    each = log[np.arange(v.shape[1])[None, :], :, v].sum(axis=1)
    odds = math.log(good) - math.log(1 - good) + each[:, 1] - each[:, 0]
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


class QualityModel:
    def __init__(self, good: float, rates: np.ndarray, bias: float, weights: np.ndarray):
        self.good, self.rates, self.bias, self.weights = good, rates, bias, weights

    def judge(self, text: str | None) -> tuple[float, float]:
        """Score of the scorer and posterior of the labellers."""
        text = text or ""
        m = measures(text)
        if not m["words"]:
            return 0.0, 0.0
        x = self.bias + float(hashed(text, m) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x)))), float(posterior(np.array([votes(m)]), self.good, self.rates)[0])


def train_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 2.0, ridge: float = 1e-4) -> tuple[float, np.ndarray]:
    """Logistic weights for soft targets by momentum descent over the whole sample."""
    w, b, vw, vb = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
        vw = 0.9 * vw - rate * (x.T @ error / len(y) + ridge * w)
        vb = 0.9 * vb - rate * error.mean()
        w, b = w + vw, b + vb
    return b, w


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", fit_rows: int = FIT_ROWS) -> QualityModel:
    """Fit rates on the votes of all documents and the scorer on a bounded sample of them."""
    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("text"))
    width = len(LABELLERS)

    def vote(batches):
        for batch in batches:
            found: dict[int, int] = {}
            for x in batch.column(0):
                code = 0
                for v in votes(measures(x.as_py() or "")):
                    code = 3 * code + v
                found[code] = found.get(code, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["code", "n"])

    counted = rows.select("text").mapInArrow(vote, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    total = sum(r.n for r in counted)
    if not total:
        return QualityModel(0.5, np.full((width, 2, 3), 1 / 3), 0.0, np.zeros(BUCKETS))
    patterns = [(tuple(r.code // 3 ** (width - 1 - j) % 3 for j in range(width)), r.n) for r in sorted(counted, key=lambda r: r.code)]
    good, rates = expectation_maximisation(patterns)

    def feature(batches):
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column(0)]
            found = [measures(t) for t in texts]
            x = [hashed(t, m).astype(np.float32).tobytes() for t, m in zip(texts, found, strict=True)]
            y = posterior(np.array([votes(m) for m in found]), good, rates) if found else []
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.float64())], ["x", "y"])

    sample = rows.where(sample_place("k", "text") <= fit_rows / total).select("text").mapInArrow(feature, "x binary, y double").limit(int(SAMPLE_SLACK * fit_rows)).collect()
    if not sample:
        return QualityModel(good, rates, 0.0, np.zeros(BUCKETS))
    x = np.array([np.frombuffer(r.x, np.float32) for r in sample], np.float64)
    bias, weights = train_scorer(x, np.array([r.y for r in sample]))
    return QualityModel(good, rates, bias, weights)


def score(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, posterior, predicted) of every row; predicted 1 is good."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [model.judge(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[i] for f in found], pa.float64()) for i in (0, 1))], [key, "score", "posterior"])

    out = docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"{key} {kind}, score double, posterior double")
    return out.select(key, held_out(key).alias("held_out"), "score", "posterior", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose score is at least `least`."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([model.judge(x.as_py())[0] >= least for x in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
