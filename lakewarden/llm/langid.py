"""Operator 9: language identification by rank-order n-gram profiles.

Each language has a profile: its most frequent letter n-grams (one to three letters, word edges included) in order. A
document's own most frequent n-grams are compared with every profile by out-of-place distance: the sum of differences
in rank, and a fixed penalty for an n-gram that a profile lacks. The nearest language wins.

Defined results: a null text, or one without a letter, is `und` with score 0, as is every text if nothing was learned.
A letter is what str.isalpha takes for one. Ties of frequency go to the smaller n-gram, of distance to the language
first in order. Repeated rows, null ids and other columns make no difference; whole texts are read; an empty table
gives an empty result. The model holds PROFILE n-grams for each learned value of lang.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, sample_place

PROFILE = 400
#: Most labelled documents of a language that its profile is counted on.
FIT_ROWS = 3000
#: Languages that get a profile, those of most documents first.
MOST_LANGS = 1000
WORDS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"


def letter_words(text: str) -> list[str]:
    """Runs of letters; numbers that are not digits, such as superscripts and fractions, part them too."""
    words = WORDS.findall(text)
    if not words or "".join(words).isalpha():
        return words
    return [p for w in words for p in "".join([c if c.isalpha() else " " for c in w]).split()]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as integers, ascending, and their counts; empty without a letter."""
    words = letter_words(text.lower())
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    letter = codes != 32
    shift = np.uint64(21)
    two = codes[:-1] << shift | codes[1:]
    three = two[:-1] << shift | codes[2:]
    one = codes[letter]
    two = two[letter[:-1] | letter[1:]]
    three = three[letter[1:-1]]
    keys = np.concatenate([one, two, three])
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def ranked(keys: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order of frequency, ties by the smaller."""
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Rank of every profiled n-gram in each language, ready for whole-array distances."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        self.keys = np.array(sorted({k for p in profiles.values() for k in p}), np.uint64)
        self.rank = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            self.rank[np.searchsorted(self.keys, np.array(profiles[lang], np.uint64)), j] = np.arange(len(profiles[lang]))

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and score: the runner-up's share of the two least distances; 1 - distance if there is one language."""
        own = ranked(*grams(text)) if text and self.langs else ()
        if not len(own):
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.keys, own)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != own)] = len(self.keys)
        there = self.rank[at]
        apart = np.where(there >= 0, np.abs(there - np.arange(len(own))[:, None]), PROFILE).sum(axis=0)
        best = int(np.argmin(apart))
        near = float(apart[best])
        if len(self.langs) == 1:
            return self.langs[0], 1 - near / (PROFILE * len(own))
        second = float(np.partition(apart, 1)[1])
        return self.langs[best], second / (near + second) if near + second else 0.5


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", fit_rows: int = FIT_ROWS) -> Profiles:
    """Profiles of the languages of the documents that are not held out, on at most about fit_rows of each language."""
    known = docs.where(F.col(key).isNotNull() & ~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = known.groupBy(F.col(lang).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS)
    share = {r["lang"]: min(1.0, fit_rows / r["count"]) for r in counts.collect()}
    if not share:
        return Profiles({})
    pick = F.create_map([F.lit(x) for pair in share.items() for x in pair])
    chosen = known.where(sample_place(key, text) <= pick[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches):
        totals: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                into = totals[name]
                for k, n in zip(*(x.tolist() for x in grams(value.as_py())), strict=True):
                    into[k] += n
        for name, into in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(into), pa.string()), pa.array(list(into), pa.int64()), pa.array(list(into.values()), pa.int64())], ["lang", "gram", "n"])

    summed = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = summed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    profiles: dict[str, list[int]] = defaultdict(list)
    for r in sorted(top.collect(), key=lambda r: (r.lang, r.rank)):
        profiles[r.lang].append(r.gram)
    return Profiles(dict(profiles))


def identify(docs: DataFrame, model: Profiles, text: str = "text") -> DataFrame:
    """All columns of docs, with lang_pred and score; names that clash are replaced."""
    judged = docs.drop("lang_pred", "score")
    names = judged.columns
    at = names.index(text)

    def run(batches):
        for batch in batches:
            found = [model.judge(x.as_py()) for x in batch.column(at)]
            cols = [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, [*names, "lang_pred", "score"])

    from pyspark.sql import types as T

    schema = T.StructType([*judged.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return judged.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Profiles, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; the texts stay in the tasks."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [model.judge(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [key, "lang_pred", "score"])

    out = docs.select(key, F.col(text).cast("string").alias("text")).mapInArrow(run, f"{key} {kind}, lang_pred string, score double")
    return out.select(key, held_out(key).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, model: Profiles, text: str = "text", least: float = 0.502) -> DataFrame:
    """The rows of docs, all columns, whose language is told: not `und`, and with a score of at least `least`.

    Below that two profiles are equally near: a text half in one language and half in another.
    """
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            found = [model.judge(x.as_py()) for x in batch.column(at)]
            yield batch.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
