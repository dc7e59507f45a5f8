"""Operator 5: cost-balanced packing of token sequences.

A document's cost is linear in its tokens plus quadratic for attention. Documents are taken in descending order and go
to the sequence of lowest cost that still has room for them; what fits nowhere whole is cut to fill the rest. A task
packs its own documents, a bounded number of tokens at a time, so nothing is shuffled: one pass reads, encodes, packs.
The sequences of a run of tokens have together exactly as many places as it has tokens: full ones, then powers of two,
so no place is padding.

Defined results: a null text counts as empty and gives the end id alone; ties of length go by arrival, of cost to the
first sequence. Rows with equal or null ids are packed one by one. An empty table gives no piece. A document longer
than a sequence is cut. Other columns are never read.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent

CAPACITY = 4096
END_ID = 2
#: Tokens a task packs at a time: bounds its memory, whatever the table's size.
RUN_TOKENS = 1 << 20
#: Cost of t tokens: LINEAR * t + t * t.
LINEAR = 2048
#: Newer half of what a worker keeps of chunks and of their parts.
CACHE_ROWS = 300_000


#: A chunk of these characters alone is cut into parts here; the tokenizer's own rules cut it at the same places.
PLAIN = re.compile(r"[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u017e]*")
PARTS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017e]+")


#: What the rules above presume of a tokenizer.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def check_settings(spec: dict) -> None:
    """Refuse a tokenizer whose rules differ from those that chunks and parts presume."""
    normalizer, cut, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    cuts = cut.get("pretokenizers") or [{}, {}]
    wrong = [
        name
        for name, bad in {
            "normalizers": normalizer.get("normalizers") != NORMALIZERS,
            "cuts": [c.get("type") for c in cuts] != ["Split", "ByteLevel"] or cuts[0].get("pattern") != {"Regex": SPLIT} or cuts[0].get("behavior") != "Removed" or not cuts[0].get("invert"),
            "bytes": bool(cuts[-1].get("add_prefix_space")) or bool(cuts[-1].get("use_regex")),
            "model": model.get("type") != "BPE" or bool(model.get("dropout")),
            "special ids": spec.get("post_processor") is not None or spec.get("truncation") is not None or spec.get("padding") is not None,
        }.items()
        if bad
    ]
    if wrong:
        raise ValueError(f"tokenizers with these settings are not supported: {', '.join(wrong)}")


class WordEncoder:
    """Ids of texts by the tokenizers library, each distinct chunk and part encoded once and then kept a while.

    The tokenizer drops white space and no rule of it looks past white space, so the ids of a text are those of its
    chunks in order. A plain chunk is lower-cased and cut into runs of letters, single digits and runs of the rest, as
    the tokenizer does; the library's model encodes parts not met lately.
    """

    def __init__(self, path: str, cache_rows: int = CACHE_ROWS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        check_settings(json.loads(self.tokenizer.to_str()))
        split = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.byte_level = {ord(c): split(c)[0][0] for c in map(chr, range(0x21, 0x180)) if PLAIN.fullmatch(c)}
        self.model = self.tokenizer.model
        self.chunks, self.parts = Recent(cache_rows), Recent(cache_rows)

    def _part(self, part: str) -> bytes:
        ids = self.parts.find(part)
        if ids is None:
            ids = array("I", [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.byte_level))]).tobytes()
            if len(part) <= 64:
                self.parts.keep(part, ids)
        return ids

    def _chunk(self, chunk: str) -> bytes:
        ids = self.chunks.older.get(chunk)
        if ids is None:
            if PLAIN.fullmatch(chunk) and "<|" not in chunk:
                ids = b"".join([self._part(p) for p in PARTS.findall(chunk.lower())])
            else:
                ids = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= 64:
            self.chunks.keep(chunk, ids)
        return ids

    def encode(self, text: str) -> np.ndarray:
        known, slow = self.chunks, self._chunk
        return np.frombuffer(b"".join([known[c] if c in known else slow(c) for c in text.replace("\n", " ").split(" ")]), np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str, cache_rows: int) -> WordEncoder:
    return WordEncoder(path, cache_rows)


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Places of the sequences for so many tokens: full ones, then the powers of two of the rest."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths."""
    room = capacities(sum(lengths), capacity)
    cost, used = [0] * len(room), [0] * len(room)
    pieces: list[tuple[int, int, int, int, int]] = []

    def put(doc: int, start: int, length: int, seq: int) -> None:
        pieces.append((doc, start, length, seq, used[seq]))
        used[seq] += length
        room[seq] -= length
        cost[seq] += LINEAR * length + length * length

    heads, full = [], 0
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= capacity:
            put(doc, start, capacity, full)
            full += 1
            start += capacity
        if start < n:
            heads.append((doc, start, n - start))
    heads.sort(key=lambda x: -x[2])
    heap = [(0, s) for s in range(full, len(room))]
    heapq.heapify(heap)
    left = []
    for doc, start, n in heads:
        skipped = []
        while heap:
            c, s = heapq.heappop(heap)
            if room[s] >= n:
                put(doc, start, n, s)
                if room[s]:
                    heapq.heappush(heap, (cost[s], s))
                break
            skipped.append((c, s))
            if len(skipped) >= 64 or not heap:
                fits = [(cost[t], t) for _, t in heap if room[t] >= n]
                if not fits:
                    left.append((doc, start, n))
                    break
                s = min(fits)[1]
                put(doc, start, n, s)
                heap = [(cost[t], t) for _, t in heap if room[t]]
                heapq.heapify(heap)
                break
        else:
            left.append((doc, start, n))
        for x in skipped:
            heapq.heappush(heap, x)
    holes = [s for s in range(full, len(room)) if room[s]]
    holes.sort(key=lambda s: (-room[s], s))
    at = 0
    for doc, start, n in left:
        while n:
            s = holes[at]
            take = min(n, room[s])
            put(doc, start, take, s)
            start, n = start + take, n - take
            at += not room[s]
    return pieces


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False, cache_rows: int = CACHE_ROWS) -> DataFrame:
    """Pieces of every document: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    cache_rows bounds what a worker keeps of encoded words, some 200 bytes each, four times over; it changes no result.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        enc = encoder(tokenizer_path, cache_rows)
        first_sequence = TaskContext.get().partitionId() << 32
        keys, ids, tokens = [], [], 0

        def flush():
            nonlocal first_sequence, keys, ids, tokens
            pieces = pack([len(x) for x in ids])
            cols = list(zip(*pieces, strict=True))
            doc = cols[0]
            crc = [zlib.crc32(ids[d][s : s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
            longs = (cols[1], cols[2], crc, [len(ids[d]) for d in doc], [first_sequence + s for s in cols[3]], cols[4])
            arrays = [pa.array([keys[d] for d in doc], key_type), *(pa.array(x, pa.int64()) for x in longs)]
            names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                arrays.append(pa.array([ids[d][s : s + n].astype(np.int32) for d, s, n, _, _ in pieces], pa.list_(pa.int32())))
                names.append("ids")
            first_sequence += max(cols[3]) + 1
            keys, ids, tokens = [], [], 0
            return pa.RecordBatch.from_arrays(arrays, names)

        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.append(enc.encode(value.as_py() or ""), np.uint32(END_ID))
                keys.append(k)
                ids.append(x)
                tokens += len(x)
                if tokens >= RUN_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    schema = f"{key} {kind}, {SCHEMA}" + ", ids array<int>" * keep_ids
    return docs.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
