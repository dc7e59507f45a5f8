"""Operator 11: periodic runs of words, by repeated k-gram masking and Main-Lorentz on what is left.

A run is a maximal stretch of words with smallest period q whose length is at least max(LEAST, EXPONENT * q). Such a run
repeats all but its last q words at distance q, so every word of it lies in a k-gram that its document has twice, where k
is the least such overlap over all q: five words. Words outside such k-grams can't be in a run; what they leave are short
segments, and only those are searched. Main-Lorentz cuts a segment in halves and finds the runs across each cut from
longest common extensions of the halves (Z functions), in n log n steps.

Documents are judged one by one inside tasks, nothing is shuffled; a task holds one Arrow batch of bounded bytes.

Defined results: a null or empty text has no words and no runs, its collapsed text is empty. Rows are judged one by one,
whatever their ids: repeated rows give repeated rows, a null id stays null. Ties of the strongest run go to the smallest
start, then period. Very long texts are read whole. Other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, EXPONENT = 6, 4
SPACE = r"[\x20\x09-\x0D]+"


def overlap(least: int = LEAST, exponent: int = EXPONENT) -> int:
    """Words that any run repeats at the distance of its period, at least."""
    return min(max(least, exponent * q) - q for q in range(1, least + 1))


def z_function(s: list) -> list[int]:
    """z[i]: how many items of s from i on equal those from its beginning."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _across(u: list[int], v: list[int], least: int, exponent: int):
    """Stretches (start, end, period) of u + v that hold the first `period` items of v, or of u's end, and cross the cut.

    Extensions: how far v continues with period q (its own Z function), and how far back from v's q-th item the same
    period holds (Z function of the reversed halves).
    """
    n, m = len(u), len(v)
    longest = min(m, (n + m) // exponent)
    if longest < 1:
        return
    ahead = np.array([*z_function(v), 0], np.int64)
    back = u[::-1]
    behind = np.array(z_function([*back, -1, *v[::-1], *back])[n + 1 :], np.int64)
    q = np.arange(1, longest + 1)
    # v[:q] is a whole period; right of it the period goes on for ahead[q] items, left of the cut for behind[m - q]
    right, left = ahead[q], np.minimum(behind[m - q], n)
    for k in np.flatnonzero((left > 0) & (left + right + q >= np.maximum(least, exponent * q))).tolist():
        yield n - int(left[k]), n + int(q[k] + right[k]), int(q[k])


def main_lorentz(s: list[int], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """All runs (start, length, smallest period) of s, in order of start and period."""
    n, found, todo = len(s), {}, [(0, len(s))]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        mid = (a + b) // 2
        u, v = s[a:mid], s[mid:b]
        stretches = [(a + i, a + j, q) for i, j, q in _across(u, v, least, exponent)]
        # a run with less than a period right of the cut has one left of it: the same on the reversed part
        stretches += [(b - j, b - i, q) for i, j, q in _across(v[::-1], u[::-1], least, exponent)]
        for i, j, q in stretches:
            whole = (i == 0 or s[i - 1] != s[i - 1 + q]) and (j == n or s[j] != s[j - q])
            if whole and q < found.get((i, j), q + 1):  # a stretch with a period also has its multiples
                found[i, j] = q
        todo += [(a, mid), (mid, b)]
    return sorted(((i, j - i, q) for (i, j), q in found.items()), key=lambda r: (r[0], r[2]))


def segments(words: list[bytes], k: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Words as numbers, and the stretches (start, end) of words that lie in k-grams which the document repeats."""
    if len(words) <= k:
        return [], []
    code: dict[bytes, int] = {}
    ids = [code.setdefault(w, len(code)) for w in words]
    place: dict[tuple, int] = {}
    grams = list(zip(*(ids[i:] for i in range(k)), strict=False))
    names = [place.setdefault(g, len(place)) for g in grams]
    if len(place) == len(grams):
        return ids, []
    names = np.array(names)
    starts = np.flatnonzero(np.bincount(names)[names] > 1)
    step = np.zeros(len(ids) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + k, -1)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(step[:-1]) > 0).astype(np.int8), [0]))))
    return ids, list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def runs_of(words: list[bytes], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a document's words."""
    ids, parts = segments(words, overlap(least, exponent))
    return [(a + i, n, q) for a, b in parts for i, n, q in main_lorentz(ids[a:b], least, exponent)]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words without those that a run repeats: of each run its first period stays, unless another run drops it."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, runs, collapsed): every run of words as (start, length, period), and the text without the repeated words."""
    if exponent < 2 or least < exponent:
        raise ValueError("a run has at least two periods, and least is at least exponent")

    def run(batches):
        for batch in batches:
            ids, found, kept = batch.column(0), [], []
            for value in batch.column(1):
                words = (value.as_py() or "").encode("utf-8", "surrogatepass").split()
                runs = runs_of(words, least, exponent)
                found.append([{"start": i, "length": n, "period": q} for i, n, q in runs])
                kept.append(b" ".join(collapse(words, runs)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, RUN), pa.array(kept, pa.string())], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text) with periodic tails in about a tenth of the documents, as their ids' crc32 says; a null id has none."""
    h = F.crc32(F.col(key).cast("string"))
    words = F.filter(F.split(F.col(text), SPACE), lambda w: w != "")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), h.alias("h"), F.floor(h / 10).cast("long").alias("g"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.expr("g % n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    changed = F.transform("w", lambda w, i: F.when(i >= F.col("a"), F.element_at("w", (F.col("a") + (i - F.col("a")) % F.col("p") + 1).cast("int"))).otherwise(w))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the strongest run and digests of find_runs' result."""
    best = F.aggregate("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    sha: Column = F.sha2(F.array_join(lines, "").cast("binary"), 256)
    rows = found.withColumn("b", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "b.start", "b.length", "b.period",
        F.expr("1000 * b.length div b.period").alias("exponent_milli"), sha.alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
