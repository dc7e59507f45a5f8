"""Operator 10: SentencePiece encoding by exact backtracking, and decoding.

A text becomes words with their space marks, which no piece of the vocabulary spans. An Aho-Corasick automaton gives
the longest pieces of a word from left to right. Two adjacent pieces are compatible if merging their joined string
again gives just these two; a sequence in which all neighbours are compatible is the encoding, and there is only one.
Where the longest pieces hold an incompatible pair, the encoder backs up from there: it tries the next shorter piece,
takes back pieces from which nothing goes on and marks their ends in a bitfield, and goes on with the longest pieces
as soon as it meets them again. Characters without a piece become byte pieces.

Defined results: a null text counts as empty; an empty text gives the end id alone and decodes to ''. Repeated rows are
encoded row by row, other columns are never read, and an empty table gives an empty result. Whole texts are encoded,
however long. Models whose settings differ from those handled here are refused when they are loaded.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent

SPACE = "▁"
#: Pairs of pieces whose compatibility a worker keeps, some 130 bytes each.
PAIRS = 300_000
#: Slots, by hash, of the compatible pairs met last, which whole arrays of pairs are compared with.
SLOT_BITS, SPREAD = 19, np.uint64(0x9E3779B97F4A7C15)
#: Newer half of the words that a worker keeps encoded, some 300 bytes each; longer words are not kept.
CACHE_ROWS, CACHE_LENGTH = 200_000, 40


def check_settings(model) -> None:
    """Refuse a model that is no plain BPE model: only such are encoded here as the library does."""
    normalizer, trainer = model.normalizer_spec, model.trainer_spec
    kinds = {p.type for p in model.pieces}
    wrong = [
        name
        for name, bad in {
            "model type": trainer.model_type != 2,
            "normalization": bool(normalizer.precompiled_charsmap),
            "no dummy prefix": not normalizer.add_dummy_prefix,
            "white space removed": normalizer.remove_extra_whitespaces,
            "white space kept": not normalizer.escape_whitespaces,
            "white space as suffix": trainer.treat_whitespace_as_suffix,
            "no bytes": not trainer.byte_fallback,
            "user-defined or unused pieces": bool(kinds - {1, 2, 3, 6}),
            "pieces of several words": any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces if p.type == 1),
        }.items()
        if bad
    ]
    if wrong:
        raise ValueError(f"models with these settings are not supported: {', '.join(wrong)}")


class PieceCodec:
    """Encoder and decoder of one BPE model file of the sentencepiece library."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        check_settings(model)
        normal, byte = 1, 6
        self.piece = [p.piece for p in model.pieces]
        self.score = {p.piece: p.score for p in model.pieces if p.type == normal}
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == normal}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == byte}
        self.end_id = model.trainer_spec.eos_id
        self.bytes = [b""] * len(model.pieces)
        for i, p in enumerate(model.pieces):
            if p.type == normal:
                self.bytes[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == byte:
                self.bytes[i] = bytes([int(p.piece[3:5], 16)])
        self.text = [str(i) for i in range(len(model.pieces))]
        self.size = [len(p) for p in self.piece]
        self.first = [p[:1] == SPACE for p in self.piece]
        #: Ids of the pieces that come out of merging their own characters; no others are ever in an encoding.
        self.id = {p: i for p, i in ids.items() if self.merge(p) == [p]}
        self.most = max(map(len, self.id), default=1)
        #: The next shorter piece that a piece begins with, or -1.
        self.shorter = [-1] * len(model.pieces)
        for p, i in self.id.items():
            self.shorter[i] = next((self.id[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id), -1)
        letters = "".join(re.escape(p) for p in self.id if len(p) == 1)
        self.unknown = re.compile(f"[^{letters}]+")
        #: The parts of a word: up to the first character without a piece, then such characters and what follows them.
        self.parts = re.compile(f"^[{letters}]+|[^{letters}]+[{letters}]*")
        self.matcher = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.matcher.add_word(p, i)
        self.matcher.make_automaton()
        self._good: set[tuple[int, int]] = set()
        self._bad: set[tuple[int, int]] = set()
        self._seen = np.full(1 << SLOT_BITS, -1, np.int64)
        self._words, self._parts = Recent(CACHE_ROWS), Recent(CACHE_ROWS // 2)

    def merge(self, text: str) -> list[str]:
        """Merge the best-scored adjacent pair, leftmost first, until none is a piece."""
        parts, find, none = list(text), self.score.get, float("-inf")
        scores = [find(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == none:
                break
            i = scores.index(best)
            new = parts[i] = parts[i] + parts.pop(i + 1)
            del scores[i]
            if i:
                scores[i - 1] = find(parts[i - 1] + new, none)
            if i < len(scores):
                scores[i] = find(new + parts[i + 1], none)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether two adjacent pieces stay as they are when their joined string is merged again."""
        pair = left, right
        if pair in self._good:
            return True
        if pair in self._bad:
            return False
        if len(self._good) + len(self._bad) >= PAIRS:
            self._good.clear()
            self._bad.clear()
        a, b = self.piece[left], self.piece[right]
        fits = self.merge(a + b) == [a, b]
        (self._good if fits else self._bad).add(pair)
        return fits

    def longest(self, text: str, at: int) -> int:
        """The longest piece at a place."""
        find, rest = self.id.get, text[at : at + self.most]
        for k in range(self.matcher.longest_prefix(rest), 0, -1):
            found = find(rest[:k])
            if found is not None:
                return found
        return -1

    def encode_known(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        ids, broken = self.scan(text)
        return self.backtrack(text, ids, broken) if broken else ids

    def scan(self, text: str) -> tuple[list[int], list[int]]:
        """The longest pieces, and the places k where pieces k and k + 1 are incompatible."""
        ids = [i for _, i in self.matcher.iter_long(text)]
        at = np.array(ids, np.int64)
        pairs = at[:-1] * len(self.piece) + at[1:]
        slots = (pairs.astype(np.uint64) * SPREAD) >> np.uint64(64 - SLOT_BITS)
        broken = []
        for k in np.flatnonzero(self._seen[slots] != pairs).tolist():
            if self.compatible(ids[k], ids[k + 1]):
                self._seen[slots[k]] = pairs[k]
            else:
                broken.append(k)
        return ids, broken

    def backtrack(self, text: str, ids: list[int], broken: list[int]) -> list[int]:
        """Mend a sequence of longest pieces; broken: the places k of incompatible ids k and k + 1, ascending."""
        size, shorter, compatible = self.size, self.shorter, self.compatible
        good, bad = self._good, self._bad
        start = [0, *accumulate([size[i] for i in ids])]
        failed = bytearray((len(text) >> 3) + 1)
        out = ids[: broken[0] + 1]
        at, nth, follow = start[broken[0] + 1], 1, broken[0] + 1
        piece = shorter[ids[follow]]
        while True:
            if piece < 0:  # nothing goes on from here
                failed[at >> 3] |= 1 << (at & 7)
                if not out:  # by the method's proof some sequence is valid; the plain way finds it all the same
                    return [self.id[p] for p in self.merge(text)]
                piece = out.pop()
                at -= size[piece]
                piece = shorter[piece]
                continue
            end = at + size[piece]
            if failed[end >> 3] >> (end & 7) & 1:
                piece = shorter[piece]
                continue
            if out:
                pair = out[-1], piece
                if pair not in good and (pair in bad or not compatible(*pair)):
                    piece = shorter[piece]
                    continue
            out.append(piece)
            at = end
            if at == len(text):
                return out
            while start[follow] < at:
                follow += 1
            if start[follow] == at and compatible(out[-1], ids[follow]):
                # the longest pieces again, up to the next break
                while nth < len(broken) and broken[nth] < follow:
                    nth += 1
                if nth == len(broken):
                    out += ids[follow:]
                    return out
                out += ids[follow : broken[nth] + 1]
                follow = broken[nth] + 1
                at = start[follow]
                piece = shorter[ids[follow]]
            else:
                piece = self.longest(text, at)

    @staticmethod
    def words(text: str) -> list[str]:
        """A text's words; a space mark in front is left out if it is a single one."""
        if text[0] != " " and "  " not in text and SPACE not in text:
            return text.split(" ")
        out, runs = [], (SPACE + text.replace(" ", SPACE)).split(SPACE)
        marks = 0
        for word in runs[1:]:
            marks += 1
            if word:
                out.append(word if marks == 1 else SPACE * marks + word)
                marks = 0
        if marks:
            out.append("" if marks == 1 else SPACE * marks)
        return out

    def _done(self, ids: list[int]) -> tuple[str, bytes]:
        """Ids as text and their decoded bytes."""
        return " ".join([self.text[i] for i in ids]), b"".join([self.bytes[i] for i in ids])

    def _part(self, part: str) -> tuple[str, bytes]:
        """Characters without a piece and what follows them."""
        known = self._parts.find(part)
        if known is None:
            end = self.unknown.match(part).end()
            ids = [self.byte_id[b] for b in part[:end].encode()]
            known = self._done(ids + self.encode_known(part[end:]) if end < len(part) else ids)
            if len(part) <= CACHE_LENGTH:
                self._parts.keep(part, known)
        return known

    def _odd_word(self, word: str) -> tuple[str, bytes]:
        """A word that is empty, has more marks in front or characters without a piece."""
        marked = word if word[:1] == SPACE else SPACE + word
        if self.unknown.search(marked) is None:
            return self._done(self.encode_known(marked))
        head, *rest = self.parts.findall(marked)
        known = None if head[1:2] == SPACE else self._words.find(head[1:])
        found = [known or self._done(self.encode_known(head)), *map(self._part, rest)]
        return " ".join([x[0] for x in found]), b"".join([x[1] for x in found])

    def _learn(self, words: set[str]) -> dict[str, tuple[str, bytes]]:
        """Encode words that are not among the newer half of those kept; plain ones all at once."""
        out, todo, unknown = {}, [], self.unknown.search
        find, keep = self._words.older.get, self._words.keep
        for w in words:
            known = find(w)
            if known is None:
                if w and w[0] != SPACE and unknown(w) is None:
                    todo.append(w)
                    continue
                known = self._odd_word(w)
            out[w] = known
            if len(w) <= CACHE_LENGTH:
                keep(w, known)
        if todo:
            text = SPACE + SPACE.join(todo)
            ids, broken = self.scan(text)
            starts = [k for k, i in enumerate(ids) if self.first[i]]
            starts.append(len(ids))
            mended, at = {}, 0
            while at < len(broken):
                w = bisect_right(starts, broken[at]) - 1
                low, high = starts[w], starts[w + 1]
                own = []
                while at < len(broken) and broken[at] < high:
                    own.append(broken[at] - low)
                    at += 1
                mended[w] = self.backtrack(SPACE + todo[w], ids[low:high], own)
            for k, w in enumerate(todo):
                out[w] = known = self._done(mended.get(k) or ids[starts[k] : starts[k + 1]])
                if len(w) <= CACHE_LENGTH:
                    keep(w, known)
        return out

    def encode_decode(self, text: str) -> tuple[str, bytes, int]:
        """Ids with the end id as decimal text, the decoded text in UTF-8, and the number of ids."""
        if not text:
            return self.text[self.end_id], b"", 1
        words, known = self.words(text), self._words
        found = [known.get(w) for w in words]
        if None in found:
            new = self._learn({w for w, x in zip(words, found, strict=True) if x is None})
            found = [x or new[w] for w, x in zip(words, found, strict=True)]
        found.append((self.text[self.end_id], b""))
        ids = " ".join([x[0] for x in found])
        decoded = b"".join([x[1] for x in found])
        return ids, decoded[1:] if decoded[:1] == b" " else decoded, ids.count(" ") + 1

    def encode(self, text: str) -> list[int]:
        """Ids of a text, the end id last."""
        return [int(x) for x in self.encode_decode(text)[0].split(" ")]

    def decode_bytes(self, ids) -> bytes:
        """UTF-8 of the decoded text: the mark that encoding adds in front goes."""
        data = b"".join(map(self.bytes.__getitem__, ids))
        return data[1:] if data[:1] == b" " else data

    def decode(self, ids) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode(errors="replace")


@lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    return PieceCodec(model_path)


def encode_texts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row, in one narrow pass over two columns."""

    def run(batches):
        enc = codec(model_path)
        for batch in batches:
            n, a, b, kept = [], [], [], []
            for value in batch.column(1):
                ids, decoded, size = enc.encode_decode(value.as_py() or "")
                n.append(size)
                a.append(hashlib.sha256(ids.encode()).hexdigest())
                b.append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    kept.append([int(x) for x in ids.split(" ")])
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
