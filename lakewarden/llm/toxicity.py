"""Operator 1: toxicity by Levenshtein automata over a lexicon trie, with context windows.

The lexicon holds the words that labelled toxic documents have far more often than others. A document's word is looked
up in the trie of the lexicon; if it isn't there, the Levenshtein automaton of the word walks the trie and finds the
terms within one edit, so that misspelled terms count too. Each hit is judged by the words around it: inside quotation
marks or after words of reporting it counts as quotation, beside words of address as abuse. A logistic model over
these sums gives the score.

Defined results: null and empty texts get the score of a text without hits. Labels that are null or of null ids teach
nothing; of repeated labels of an id the greatest holds. Repeated rows are scored row by row; without any toxic label
every score is 0. Whole texts are scored; columns other than the text never enter a score. Ties need no rule, for a
word takes the greatest weight of the terms near it. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SAMPLE_SLACK, Recent, held_out

#: Most labelled documents that are fitted on; as a term is in some share of them, this bounds the lexicon too.
FIT_ROWS = 20_000
#: A term is in at least so many toxic documents and this share of them, with at least this log-odds ratio.
LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = 4, 0.004, 3.0
#: Shortest word that may match with one edit.
FUZZY_LENGTH = 5
#: Words on either side that count as a hit's context.
WINDOW = 6
WORDS = re.compile(r"[^\W\d_](?:[^\W_]|[*@$](?=[^\W_]))*")
QUOTES = re.compile("[\"“”„«»]")
REPORTING = frozenset("said says say called calls wrote word words term terms quote quoted quotes reported reports accused alleged dit écrit mot mots cité sagte wort wörter zitat dijo palabra palabras cita".split())
ADDRESS = frozenset("you your yours ur are is du dich dein bist ist tu toi vous es est eres tú usted".split())
CACHE_ROWS = 60_000
FEATURES = 6


class LevenshteinAutomaton:
    """The automaton of all words within some edits of a word: a state is the row of the edit table, cut off."""

    def __init__(self, word: str, edits: int = 1):
        self.word, self.edits = word, edits

    def start(self) -> tuple[int, ...]:
        return tuple(min(i, self.edits + 1) for i in range(len(self.word) + 1))

    def step(self, state: tuple[int, ...], char: str) -> tuple[int, ...]:
        out = [min(state[0] + 1, self.edits + 1)]
        for i, c in enumerate(self.word):
            out.append(min(out[i] + 1, state[i] + (c != char), state[i + 1] + 1, self.edits + 1))
        return tuple(out)

    def accepts(self, state: tuple[int, ...]) -> bool:
        return state[-1] <= self.edits

    def alive(self, state: tuple[int, ...]) -> bool:
        return min(state) <= self.edits


class LexiconTrie:
    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.root: dict = {}
        self.deletions: set[str] = set()
        for t in terms:
            node = self.root
            for c in t:
                node = node.setdefault(c, {})
            node[""] = t
            if len(t) >= FUZZY_LENGTH - 1:
                self.deletions.add(t)
                self.deletions.update(t[:i] + t[i + 1 :] for i in range(len(t)))
        self.known = Recent(CACHE_ROWS)

    def intersect(self, word: str) -> list[str]:
        """Terms within one edit of a word: the automaton walks the trie and leaves dead branches."""
        automaton, out = LevenshteinAutomaton(word), []
        todo = [(self.root, automaton.start())]
        while todo:
            node, state = todo.pop()
            for c, below in node.items():
                if c == "":
                    if automaton.accepts(state):
                        out.append(below)
                elif automaton.alive(following := automaton.step(state, c)):
                    todo.append((below, following))
        return out

    def match(self, word: str) -> tuple[float, bool]:
        """Weight of a word, and whether it is misspelled; weight 0 if no term is near."""
        found = self.known.find(word)
        if found is None:
            if word in self.terms:
                found = (self.terms[word], False)
            elif len(word) < FUZZY_LENGTH or not (word in self.deletions or any(word[:i] + word[i + 1 :] in self.deletions for i in range(len(word)))):
                found = (0.0, False)  # words one edit apart share a word with one letter taken out
            else:
                found = (max((self.terms[t] for t in self.intersect(word)), default=0.0), True)
            if len(word) <= 64:
                self.known.keep(word, found)
        return found


def features(trie: LexiconTrie, text: str) -> list[float] | None:
    """Sums over a text's hits; None without hits."""
    low = text.lower()
    known, match = trie.known, trie.match
    hits = {w for w in set(WORDS.findall(low)) if (known[w] if w in known else match(w))[0] > 0}
    if not hits:
        return None
    spans = [(m.group(), m.start()) for m in WORDS.finditer(low)]
    marks = [m.start() for m in QUOTES.finditer(low)]
    exact = fuzzy = quoted = addressed = top = 0.0
    inside = np.searchsorted(marks, [s for _, s in spans]) if marks else None
    for i, (w, _) in enumerate(spans):
        if w not in hits:
            continue
        weight, misspelled = match(w)
        near = {x for x, _ in spans[max(0, i - WINDOW) : i + WINDOW + 1]}
        is_quoted = (inside is not None and inside[i] % 2 == 1 and inside[i] < len(marks)) or bool(REPORTING & {x for x, _ in spans[max(0, i - WINDOW) : i]})
        if is_quoted:
            quoted += weight
        elif misspelled:
            fuzzy += weight
        else:
            exact += weight
            addressed += weight * bool(ADDRESS & near)
            top = max(top, weight)
    return [math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), math.log1p(addressed), top / 10, (exact + fuzzy) / len(spans)]


class ToxicityModel:
    def __init__(self, terms: dict[str, float], weights: list[float]):
        self.terms, self.weights = terms, weights
        self._trie = None

    @property
    def trie(self) -> LexiconTrie:
        if self._trie is None:
            self._trie = LexiconTrie(self.terms)
        return self._trie

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "_trie": None}

    def score(self, text: str | None) -> float:
        found = features(self.trie, text) if text and self.terms else None
        x = self.weights[0] + (sum(w * f for w, f in zip(self.weights[1:], found, strict=True)) if found else 0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) if self.terms else 0.0


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> list[float]:
    """Weights (intercept first) of a ridge logistic regression by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, keep = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn lexicon and weights from labelled documents outside the held-out fold, about fit_rows of them at most."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, fit_rows / max(1, own.count()))
    place = (F.xxhash64(F.col("doc_id").cast("string")).cast("double") + 2.0**63) / 2.0**64
    chosen = F.broadcast(own.where(place <= share))  # at most about fit_rows rows of two numbers
    train = docs.select("doc_id", "text").join(chosen, "doc_id").where("text is not null").select("toxic", "text")

    def count(batches):
        total: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        rows = [0, 0]
        for batch in batches:
            for toxic, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                k = int(toxic == 1)
                rows[k] += 1
                for w in set(WORDS.findall(value.as_py().lower())):
                    total[w][k] += 1
        total[""] = rows
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), *(pa.array([x[k] for x in total.values()], pa.int64()) for k in (0, 1))], ["term", "clean", "toxic"])

    counts = train.mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("n"), F.sum("toxic").alias("t"))
    counts = counts.where((F.col("t") >= LEAST_DOCS) | (F.col("term") == "")).persist()
    whole = counts.where("term = ''").first()
    if whole is None or not whole.t:
        counts.unpersist()
        return ToxicityModel({}, [0.0] * (FEATURES + 1))
    odds = F.log((F.col("t") + 0.5) / (whole.t - F.col("t") + 0.5)) - F.log((F.col("n") + 0.5) / (whole.n - F.col("n") + 0.5))
    top = counts.where((F.col("term") != "") & (F.col("t") >= LEAST_SHARE * whole.t)).withColumn("w", odds).where(F.col("w") >= LEAST_ODDS)
    terms = {r.term: r.w for r in top.orderBy(F.desc("w"), "term").collect()}
    counts.unpersist()
    if not terms:
        return ToxicityModel({}, [0.0] * (FEATURES + 1))

    def measure(batches):
        trie = LexiconTrie(terms)
        for batch in batches:
            found = [features(trie, x.as_py()) or [0.0] * FEATURES for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([int(x == 1) for x in batch.column(0).to_pylist()], pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["toxic", "x"])

    rows = train.mapInArrow(measure, "toxic long, x array<double>").limit(int(SAMPLE_SLACK * fit_rows)).collect()
    return ToxicityModel(terms, logistic(np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)))


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row in one narrow pass."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.score(x.as_py()) for x in batch.column(1)], pa.float64())], [key, "score"])

    out = docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"{key} {kind}, score double")
    return out.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
