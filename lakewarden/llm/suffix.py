"""Operator 13: repeated byte strings, by distributed prefix doubling on sampled positions.

A byte goes if some string of LENGTH bytes over it also starts in a document of a smaller id. Doubling over every position
would shuffle each byte of the corpus as a row several times, more than twenty times the input. But of the grams of two
fifths of its length that a string of LENGTH bytes holds, one has the smallest hash, wherever the string occurs: its
anchor. A sixteenth of the positions are anchors, and only what can still match goes on:

1. Offset 0. Ranks of anchors. Spark sorts (rank, document); ranks of one document alone are unique, done.
2. Regions. The strings that an anchor stands for start side by side. Where all of them recur together (inside of a
   copied passage) one sorted name for the region settles them at once; of equal regions the first goes on, and that
   only if its anchor's rank has other regions as well.
3. Offset of a quarter. Starts left and right of the anchor's middle go on apart, if what their side adds to the rank is
   another region's too.
4. Offset of half a length. Of those, each start makes the pair (rank of its first half, rank of its second half). Spark
   sorts the pairs and ranks anew; the length is LENGTH now, past the threshold.

Ranks are 64-bit hashes of content: places in an order are as good as any names of equal strings. In each task equal keys
are combined first: of a key's rows those of the smallest document go to the key's partition, the others are known to
come later and are spread by document. So a key has the rows of one document there for each chunk of a task, however hot
it is. Every sorted partition is read as a stream.

Defined results: null and empty texts, and those below LENGTH bytes, keep all bytes. Rows with a null id are returned as
they are, match nothing and take no bytes from others. Rows of an equal id take nothing from each other; if their texts
differ, each is judged by itself (ids are taken to be those of documents: the ranks of an id are one list). Very long texts are read whole. Other columns are never read; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LENGTH = 50
#: Rows that a task combines at a time.
CHUNK = 1 << 20
#: Bytes that are hashed at a time, of several short texts or of a part of a long one: they fit a processor's cache.
BLOCK = 1 << 16

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    h = x * _B + (y ^ (y >> np.uint64(29))) * _C
    h ^= h >> np.uint64(32)
    h *= _A
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """For each size a hash of every so many bytes, by doubling: strings of 1, 2, 4, ... bytes are joined to it."""
    power, length = data.astype(np.uint64) + np.uint64(1), 1
    out: list = [(None, 0)] * len(sizes)
    while True:
        for i, size in enumerate(sizes):
            if size & length:
                grams, done = out[i]
                n = len(data) - done - length + 1
                out[i] = power if grams is None else _mix(grams[:n], power[done : done + n]), done + length
        if length * 2 > max(sizes):
            return [grams for grams, _ in out]
        power = _mix(power[:-length], power[length:])
        length *= 2


def sizes_of(length: int) -> tuple[int, int, int]:
    """Bytes of an anchor, of half a string, and how far a string may begin before its anchor."""
    k = 2 * length // 5
    return k, (length + 1) // 2, length - k


def anchors(data: np.ndarray, length: int, begins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor grams, half grams, ranks, first start, last start): each start of `length` bytes belongs to one anchor.

    begins: where the texts begin that data is made of, if it is several; no start reaches from one into the next.
    """
    k, half, slack = sizes_of(length)
    grams, halves = gram_hashes(data, k, half)
    least, size, width = grams, 1, slack + 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = len(data) - length + 1
    least = np.minimum(least[:n], least[width - size : width - size + n])
    head = np.ones(n + 1, bool)
    head[1:n] = least[1:] != least[:-1]
    if begins is not None and len(begins) > 1:
        head[begins[1:]] = True
        out = begins[1:] - length + 1  # from here on starts reach into the next text
        head[out] = True
    at = np.flatnonzero(head)
    first, last = at[:-1], at[1:] - 1
    if begins is not None and len(begins) > 1:
        nth = np.searchsorted(begins, first, "right")
        inside = first <= np.append(begins[1:], len(data))[nth - 1] - length
        first, last = first[inside], last[inside]
    if (last - first).max() >= width:  # the rank comes again before its anchor is passed: parts of the usual length
        parts = (last - first) // width + 1
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, last = np.repeat(first, parts) + nth * width, np.repeat(last, parts)
        last = np.minimum(last, first + width - 1)
    return grams, halves, least[first], first, last


def _long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)


#: Ranks: rank, document, flags: whether a document of the same chunk comes before it, and whether the chunk has several.
RANK = "a long, doc long, flags tinyint"
#: Regions and pairs: key (a, b), document (doc, tag), place; a place known to come later is negative, -1 - place.
ROW = "a long, b long, doc long, tag int, place long"
#: Bits of a place below its start: number of starts less one, way to the anchor, whether the rank comes twice, and a few
#: bits of what stands left and right of the anchor.
WIDTH, WAY, TWICE, SIDE = 6, 6, 1, 9
LOW = WIDTH + WAY + TWICE + 2 * SIDE
#: Strings of at most so many bytes.
MOST = 1 << WIDTH


def _places(grams: np.ndarray, halves: np.ndarray, rank: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, offset: int) -> np.ndarray:
    """Where regions are, where their anchors stand in them, and some bits of what is left and right of the anchors."""
    _, half, slack = sizes_of(length)
    steps = np.arange(2 * slack + 1)
    same = (grams[np.minimum(first[:, None] + steps, len(grams) - 1)] == rank[:, None]) & (steps <= (last - first + slack)[:, None])
    way, twice = same.argmax(axis=1), same.sum(axis=1) > 1
    mid, anchor = (slack + 1) // 2, first + way
    left = halves[np.maximum(anchor - mid, 0)] >> np.uint64(64 - SIDE)
    right = halves[np.minimum(anchor + length - mid + 1 - half, len(halves) - 1)] >> np.uint64(64 - SIDE)
    low = (last - first).astype(np.int64)
    for bits, value in ((WAY, way), (TWICE, twice), (SIDE, left), (SIDE, right)):
        low = low << bits | value.astype(np.int64)
    return (first + offset).astype(np.int64) << LOW | low


def _heads(*keys: np.ndarray) -> np.ndarray:
    """True where a sorted key begins."""
    out = np.ones(len(keys[0]), bool)
    out[1:] = False
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def _combined(parts: list[tuple], ranks: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk, in order of key and document, each marked as the first of its key or known to come later."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.lexsort((columns[1], columns[0]) if ranks else (columns[2], columns[1], columns[0]))
    columns = [x[order] for x in columns]
    if ranks:  # a document needs to be told of a rank but once
        keep = _heads(columns[0], columns[1])
        columns = [x[keep] for x in columns]
    doc, head = (columns[1], _heads(columns[0])) if ranks else (columns[2], _heads(columns[0], columns[1]))
    at = np.flatnonzero(head)
    size = np.diff(np.concatenate((at, [len(doc)])))
    known = doc > np.repeat(doc[at], size)
    if ranks:
        many = np.repeat(doc[at + size - 1] > doc[at], size)
        columns, names = [_long(columns[0]), doc, (known + 2 * many).astype(np.int8)], ["a", "doc", "flags"]
    else:
        a, b, doc, tag, place = columns
        columns, names = [_long(a), _long(b), doc, tag.astype(np.int32), np.where(known, -1 - place, place)], ["a", "b", "doc", "tag", "place"]
    for i in range(0, len(doc), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in columns], names)


def _rows(length: int, step: str):
    """Anchors' rows of texts. Columns: doc, tag, text, and for later steps what of the document still counts."""
    half = length - sizes_of(length)[1]

    def of_block(pieces: list[tuple]) -> tuple:
        docs, tags, offsets = (np.array([p[k] for p in pieces]) for k in range(3))
        texts = [p[3] for p in pieces]
        begins = np.cumsum([0, *map(len, texts[:-1])])
        grams, halves, rank, first, last = anchors(np.concatenate(texts), length, begins)
        of = np.searchsorted(begins, first, "right") - 1
        if step == "ranks":
            return rank, docs[of]
        if step == "regions":  # a rank that one document shares with others is alive in all that have it
            alive = np.isin(_long(rank), np.concatenate([p[4] for p in pieces]))
            rank, first, last, of = rank[alive], first[alive], last[alive], of[alive]
            name = _mix(_mix(halves[first], halves[first + half]), _mix(halves[last], halves[last + half]) + (last - first).astype(np.uint64))
            return rank, name, docs[of], tags[of], _places(grams, halves, rank, first, last, length, offsets[of] - begins[of])
        starts = [p[4][(p[4] >= p[2]) & (p[4] <= p[2] + len(p[3]) - length)] for p in pieces]
        of = np.repeat(np.arange(len(pieces)), [len(x) for x in starts])
        start = np.concatenate(starts)
        at = start + (begins - offsets)[of]
        return halves[at], halves[at + half], docs[of], tags[of], start << LOW

    def run(batches):
        parts, n, pieces, size = [], 0, [], 0
        for batch in batches:
            docs, tags, texts = batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), batch.column("text")
            for i, (doc, tag) in enumerate(zip(docs, tags, strict=True)):
                data, counts = np.frombuffer(texts[i].as_buffer(), np.uint8), None
                if step == "regions":
                    counts = batch.column("alive")[i].values.to_numpy()
                elif step == "pairs":
                    places = batch.column("places")[i].values
                    start, width = (places.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                    counts = np.repeat(start - (np.cumsum(width) - width), width) + np.arange(width.sum())
                for at in range(0, len(data) - length + 1, BLOCK):
                    pieces.append((doc, tag, at, data[at : at + BLOCK + length - 1], counts))
                    size += len(pieces[-1][3])
                    if size >= BLOCK:
                        parts.append(of_block(pieces))
                        n, pieces, size = n + len(parts[-1][0]), [], 0
                    if n >= CHUNK:
                        yield from _combined(parts, step == "ranks")
                        parts, n = [], 0
        if pieces:
            parts.append(of_block(pieces))
        if sum(len(p[0]) for p in parts):
            yield from _combined(parts, step == "ranks")

    return run


def _dealt(rows: DataFrame, known: str, *key: str) -> DataFrame:
    """Rows in partitions by key; rows known to come later stay spread by document."""
    return rows.repartition(F.when(F.expr(known), F.xxhash64("doc", *key)).otherwise(F.xxhash64(*key)))


def _column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _alive(batches):
    """(doc, rank) where more than one document has a rank; batches are sorted by rank."""

    def judged(rank, doc, flags):
        at = np.flatnonzero(_heads(rank))
        size = np.diff(np.concatenate((at, [len(rank)])))
        shared = np.repeat(np.logical_or.reduceat(flags > 1, at) | (np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)), size)
        return pa.RecordBatch.from_arrays([pa.array(doc[shared]), pa.array(rank[shared])], ["doc", "rank"])

    kept = None
    for batch in batches:
        now = [_column(batch, c) for c in ("a", "doc", "flags")]
        if kept is not None:
            now = [np.concatenate(x) for x in zip(kept, now, strict=True)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))  # the last rank may go on: a row for each chunk at most
        if cut:
            yield judged(*(x[:cut] for x in now))
        kept = [x[cut:] for x in now]
    if kept is not None and len(kept[0]):
        yield judged(*kept)


def _judged(batches):
    """Batches sorted by key and document, whether a smaller document has the key of each row (`gone`), and its place."""
    key, first = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, doc, place = (_column(batch, c) for c in ("a", "b", "doc", "place"))
        head = _heads(a, b)
        head[0] = key != (a[0], b[0])
        at = np.flatnonzero(head)
        firsts = np.full(len(a), first)
        if len(at):
            firsts[at[0] :] = np.repeat(doc[at], np.diff(np.concatenate((at, [len(a)]))))
        key, first = (a[-1], b[-1]), firsts[-1]
        yield batch, (place < 0) | (doc > firsts), np.where(place < 0, -1 - place, place)


MET = "gone boolean, a long, b long, doc long, tag int, place long"


def _settled(batches):
    """Each region, and whether it is gone."""
    for batch, gone, place in _judged(batches):
        keys = [pa.array(_column(batch, c), mask=gone) for c in ("a", "b")]  # nobody asks for those of rows that are settled
        yield pa.RecordBatch.from_arrays([pa.array(gone), *keys, batch.column("doc"), batch.column("tag"), pa.array(place)], ["gone", "a", "b", "doc", "tag", "place"])


def _late(batches):
    """The starts that are gone."""
    for batch, gone, place in _judged(batches):
        at = pa.array(np.flatnonzero(gone))
        yield pa.RecordBatch.from_arrays([batch.column("doc").take(at), batch.column("tag").take(at), pa.array((place[gone] >> LOW).astype(np.int32)), pa.array(np.ones(len(at), np.int32))], ["doc", "tag", "start", "width"])


def _removed(length: int, texts_too: bool):
    def run(batches):
        for batch in batches:
            texts, spans, out = batch.column("text"), batch.column("spans"), []
            for i in range(batch.num_rows):
                data = np.frombuffer((texts[i].as_buffer() if texts[i].is_valid else None) or b"", np.uint8)
                gone = np.zeros(len(data), bool)
                if spans[i].is_valid:
                    word, bits = (spans[i].values.field(k).to_numpy() for k in (0, 1))
                    starts = np.zeros(len(data) // 64 + 2, np.int64)
                    starts[word] = bits
                    n = np.cumsum(np.unpackbits(starts.view(np.uint8), bitorder="little")[: len(data)], dtype=np.int32)
                    n[length:] -= n[:-length].copy()  # starts that reach here
                    gone = n > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                kept = data[~gone].tobytes()
                whole = [{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)]
                out.append((len(data), int(gone.sum()), len(whole), hashlib.sha256(kept).hexdigest(), whole, kept if texts_too else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
            arrays = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id", texts_too: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept): what repeats an earlier document, and the rest.

    kept are the remaining bytes, null without texts_too; a cut may fall inside a character.
    """
    if not 4 <= length <= MOST:
        raise ValueError(f"strings of 4 to {MOST} bytes")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    again = rows.where("doc is not null").groupBy("doc").count().where("count > 1").limit(1).count()
    rows = rows.withColumn("tag", F.hash("text") if again else F.lit(0))  # tells rows of an equal id apart, if there are any
    with Scratch() as tables:
        spans = _repeats(rows.where("doc is not null").where(F.octet_length("text") >= length), length, tables)
        spans = spans.groupBy("doc", "tag").agg(F.collect_list(F.struct("word", "bits")).alias("spans"))  # a bit for each byte
        found = rows.join(spans, ["doc", "tag"], "left").select("doc", "text", "spans")
        out = found.mapInArrow(_removed(length, texts_too), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>, kept binary")
        return tables.keep(out if texts_too else out.drop("kept"))


def _start_and_width() -> tuple[Column, Column]:
    return F.shiftright("place", LOW).cast("int").alias("start"), (F.shiftright("place", LOW - WIDTH) % MOST + 1).cast("int").alias("width")


def _as_bits(spans: DataFrame) -> DataFrame:
    """(doc, tag, word, bits): starts as bits of 64-bit words, each word once; combined before they are shuffled."""
    at, mask = F.col("start") % 64, F.expr("shiftleft(1L, width) - 1")
    low = F.struct(F.floor(F.col("start") / 64).cast("int").alias("word"), F.call_function("shiftleft", mask, at).alias("bits"))
    high = F.struct((F.floor(F.col("start") / 64) + 1).cast("int").alias("word"), F.when(at > 0, F.call_function("shiftrightunsigned", mask, 64 - at)).otherwise(F.lit(0)).cast("long").alias("bits"))
    words = spans.select("doc", "tag", F.explode(F.filter(F.array(low, high), lambda x: x["bits"] != 0)).alias("x")).select("doc", "tag", "x.word", "x.bits")
    return words.groupBy("doc", "tag", "word").agg(F.bit_or("bits").alias("bits"))


def _repeats(rows: DataFrame, length: int, tables: Scratch) -> DataFrame:
    """(doc, tag, word, bits): starts of strings that an earlier document has as well, in a table of its own."""
    ranks = _dealt(rows.mapInArrow(_rows(length, "ranks"), RANK), "flags % 2 = 1", "a").sortWithinPartitions("a")
    alive = tables.write(ranks.mapInArrow(_alive, "doc long, rank long"))
    of_doc = alive.groupBy("doc").agg(F.collect_list("rank").alias("alive"))  # no more than the document has anchors
    regions = rows.join(of_doc, "doc").mapInArrow(_rows(length, "regions"), ROW)
    met = tables.write(_dealt(regions, "place < 0", "a", "b").sortWithinPartitions("a", "b", "doc").mapInArrow(_settled, MET))
    tables.drop(alive)
    shared = tables.write(_shared_ranks(met.where("not gone")))
    places = tables.write(_open_places(shared, length))
    tables.drop(shared)
    # of regions only bits stay: what is settled is narrow before the pairs are shuffled
    settled = tables.write(_as_bits(met.where("gone").select("doc", "tag", *_start_and_width())))
    tables.drop(met)
    places_of = places.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "width")).alias("places"))
    pairs = rows.join(places_of, ["doc", "tag"]).mapInArrow(_rows(length, "pairs"), ROW)
    late = _dealt(pairs, "place < 0", "a", "b").sortWithinPartitions("a", "b", "doc").mapInArrow(_late, "doc long, tag int, start int, width int")
    late = tables.write(_as_bits(late))
    tables.drop(places)
    spans = tables.write(settled.union(late).groupBy("doc", "tag", "word").agg(F.bit_or("bits").alias("bits")))
    tables.drop(settled)
    tables.drop(late)
    return spans


def _shared_ranks(first: DataFrame) -> DataFrame:
    """First regions whose rank has other regions as well, their places taken apart; read three times, so in a table."""
    bits = lambda shift, size: F.shiftright("place", shift) % (1 << size)
    first = first.select("a", "b", "doc", "tag", *_start_and_width(), bits(2 * SIDE + TWICE, WAY).cast("int").alias("way"), (bits(2 * SIDE, TWICE) == 1).alias("twice"), bits(SIDE, SIDE).cast("int").alias("left"), bits(0, SIDE).cast("int").alias("right"))
    several = first.groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most"), F.max("twice").alias("any")).where("least <> most").select("a", "any")
    return first.join(several, "a")


def _open_places(met: DataFrame, length: int) -> DataFrame:
    """(doc, tag, start, width) of the starts in such regions that other regions may have too.

    Offset of a quarter: the starts of a region before its anchor's middle share with any other region of the rank what
    stands left of the anchor, the others what stands right of it. Sides whose rank pair no other region has are done.
    """
    mid = (sizes_of(length)[2] + 1) // 2
    cut = F.greatest(F.lit(0), F.least(F.col("width"), F.col("way") - mid + 1))  # so many starts are left ones
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("near"), F.col("start").alias("start"), cut.alias("width")), F.struct(F.lit(1).alias("side"), F.col("right").alias("near"), (F.col("start") + cut).alias("start"), (F.col("width") - cut).alias("width")))
    sided = met.where("not any").select("a", "b", "doc", "tag", F.explode(F.filter(sides, lambda x: x["width"] > 0)).alias("s")).select("a", "b", "doc", "tag", "s.*")
    open_sides = sided.groupBy("a", "side", "near").agg(F.min("b").alias("least"), F.max("b").alias("most")).where("least <> most").select("a", "side", "near")
    return sided.join(open_sides, ["a", "side", "near"]).select("doc", "tag", "start", "width").union(met.where("any").select("doc", "tag", "start", "width"))
