"""Operator 8: near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds its distinct five-word shingles. Documents of equal sets count as one. Each tree of the forest
orders the signatures by its own hash functions; documents that share a prefix of a tree's key form a region.

The depth adapts to each region. With LEVELS[0] a region is a prefix of two places in 12 trees. The documents of a
region that is too dense there go on to longer prefixes, in as many more trees as make up for them: a pair of the
similarity asked for shares a region of the level it is compared on in some tree, but for a chance of 3e-7 at 0.85 and
5e-6 at 0.8, whatever its density. A region that is dense at the last level too is compared as a whole, in blocks.

Candidates are confirmed on full sets in two rounds. In the first, each document meets its neighbours in some of the
sorted orders, which share the longest prefixes with it; the best of them that are confirmed join most groups. The
second compares the documents of each region that the first left in different components: by signatures first, then,
for documents that have a candidate left, on full sets. That happens inside blocks of bounded size, which return a
forest of their links and never a row for each pair. Blocks of one component never meet.

Defined results: documents without words have an empty set and link with nothing; fewer words than a shingle make one
shingle of the whole sequence. Rows of equal doc_id are one document, whose links are those of any of its rows, and
n_shingles that of its largest set. A null doc_id links with nothing. Ties go to the smaller id. Columns other than
id and text are never read, and may have any names; whole texts are read, a bounded part at a time. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, connected_components

SHINGLE = 5
#: (places of a prefix, trees), by density; a tree's key has the places of the last.
LEVELS = ((2, 12), (4, 24), (6, 48))
DEPTH, TREES = LEVELS[-1]
PLACES = DEPTH * TREES
#: Documents of a region from which on it is too dense for its level.
REGION = 1024
#: Sorted orders in which neighbours are looked for in the first round, and how many rows before a row.
ORDERS, BEFORE = 4, 8
#: A pair is confirmed if its signatures agree in at least the threshold less this share of places, over 4 standard errors.
SLACK = 0.1
#: Documents and shingles of a block, on average.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
#: Bits of the filter of candidate ids for each id, hashes of an id, and the ids from which on a join takes its place.
ID_BITS, FILTER_HASHES, FILTER_IDS = 16, 3, 1 << 24
#: Bytes of text hashed at a time.
CHUNK = 400_000

U = np.uint64
_rng = np.random.default_rng(20240501)
BASE = U(0x9E3779B97F4A7C15 | 1)
MULTIPLY = _rng.integers(0, 2**32, PLACES, dtype=np.uint32) | np.uint32(1)
TWIST = _rng.integers(0, 2**32, PLACES, dtype=np.uint32)
PLACE = _rng.integers(0, 2**64, SHINGLE, dtype=U) | U(1)
LOWER = np.arange(256, dtype=U)
LOWER[65:91] += U(32)
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit of the input moves every bit of the output."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Powers of BASE for the places in a word, and their step for words longer than that.
STEP = 1 << 12
POWERS = np.cumprod(np.concatenate([np.ones(1, U), np.full(STEP - 1, BASE, U)]))
FAR = U(pow(int(BASE), STEP, 2**64))


def _weights(places: np.ndarray) -> np.ndarray:
    """BASE to the power of each place."""
    out = POWERS[places & (STEP - 1)]
    for k in range(1, int(places.max(initial=0)) // STEP + 1):
        out[places >= k * STEP] *= FAR
    return out


def _finish(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return mix(sums + sizes.astype(U) * U(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of UTF-8 bytes, A-Z taken as a-z."""
    gap = SPACE[data]
    edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1), append=np.int8(1)))
    first, last = edge[::2], edge[1::2]
    if not len(first):
        return np.empty(0, U), first
    inside = ~gap
    letters = LOWER[data[inside]] + U(1)
    sizes = last - first
    starts = np.cumsum(sizes) - sizes
    places = np.arange(len(letters)) - np.repeat(starts, sizes)
    return _finish(np.add.reduceat(letters * _weights(places), starts), sizes), first


def long_word(data: np.ndarray) -> np.ndarray:
    """The hash of one word, a part at a time."""
    total, factor = U(0), U(1)
    with np.errstate(over="ignore"):
        for at in range(0, len(data), STEP):
            part = data[at : at + STEP]
            total += ((LOWER[part] + U(1)) * POWERS[: len(part)]).sum(dtype=U) * factor
            factor *= FAR
    return _finish(np.array([total], U), np.array([len(data)]))


def text_hashes(raw: bytes) -> np.ndarray:
    """Hashes of a long text's words, a bounded part at a time."""
    data, at, out = np.frombuffer(raw, np.uint8), 0, [np.empty(0, U)]
    while at < len(data):
        part = data[at : at + CHUNK]
        if at + CHUNK < len(data):
            gaps = np.flatnonzero(SPACE[part])
            if not len(gaps):  # one word fills the part: take it whole
                end = at + CHUNK
                while end < len(data) and not SPACE[data[end : end + CHUNK]].any():
                    end += CHUNK
                end = min(len(data), end + int(np.argmax(SPACE[data[end : end + CHUNK]]))) if end < len(data) else len(data)
                out.append(long_word(data[at:end]))
                at = end
                continue
            part = part[: gaps[-1] + 1]
        out.append(word_hashes(part)[0])
        at += len(part)
    return np.concatenate(out)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Distinct shingle hashes in ascending order."""
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        return mix(np.array([(words * PLACE[:n]).sum() + U(n)], U))
    total = words[: n - SHINGLE + 1] * PLACE[0]
    for k in range(1, SHINGLE):
        total += words[k : n - SHINGLE + 1 + k] * PLACE[k]
    return np.unique(mix(total))


def sets_of(texts: pa.Array):
    """Shingle sets of a column of texts, hashed a bounded number of bytes at a time; a null text has an empty set."""
    at, raw = 0, texts.cast(pa.binary())
    while at < len(raw):
        part, size = [], 0
        while at < len(raw) and (not part or size < CHUNK):
            x = raw[at].as_py() or b""
            if part and size + len(x) > CHUNK:
                break
            part.append(x)
            size += len(x) + 1
            at += 1
        if len(part[0]) > CHUNK:
            yield shingle_set(text_hashes(part[0]))
            continue
        hashes, first = word_hashes(np.frombuffer(b"\n".join(part), np.uint8))
        starts = np.cumsum([0] + [len(x) + 1 for x in part])
        cuts = np.searchsorted(first, starts)
        for i in range(len(part)):
            yield shingle_set(hashes[cuts[i] : cuts[i + 1]])


def signature(shingles: np.ndarray) -> bytes:
    """Of the least value under each hash function 16 bits, in order of trees."""
    least = np.full(PLACES, np.iinfo(np.uint32).max, np.uint32)
    short = (shingles >> U(32)).astype(np.uint32)
    for i in range(0, len(short), 128):
        np.minimum(least, ((short[i : i + 128, None] ^ TWIST) * MULTIPLY).min(axis=0), out=least)
    return (mix(least.astype(U)) >> U(48)).astype(">u2").tobytes()


def places(signatures_: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures_), np.uint16).reshape(len(signatures_), -1)


def _longs(columns) -> list[pa.Array]:
    return [pa.array(c, pa.int64()) for c in columns]


def _sign(batches):
    for batch in batches:
        size, one, two, sig = [], [], [], []
        for s in sets_of(batch.column(1)):
            size.append(len(s))
            one.append(int(np.bitwise_xor.reduce(mix(s)).astype(np.int64)) if len(s) else 0)
            two.append(int(mix(s ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=U).astype(np.int64)) if len(s) else 0)
            sig.append(signature(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), *_longs((size, one, two)), pa.array(sig, pa.binary())], ["id", "n", "k1", "k2", "sig"])


def id_filter(ids: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter over a column `id` with a number of bits in proportion to the count; its words are or-ed by Spark."""
    bits = 1 << max(12, (ID_BITS * count).bit_length())
    spots = F.explode(F.array(*(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(bits)) for k in range(FILTER_HASHES))))
    bit = F.expr("shiftleft(1L, cast(p % 64 as int))")
    words = ids.select(spots.alias("p")).groupBy(F.floor(F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(bit).alias("b"))
    out = np.zeros(bits // 64, U)
    for w, b in words.toLocalIterator():
        out[w] = U(b & 0xFFFFFFFFFFFFFFFF)
    return out


def _picked(rows: DataFrame, need: DataFrame, filter_ids: int) -> tuple[DataFrame, np.ndarray]:
    """rows (id, ...) with FILTER_HASHES places, last, in a filter of the distinct ids in the table need, and that filter.

    Where there are more ids than a filter of 64 MB serves, rows are joined with them, and the filter lets all through.
    """
    count = need.count()
    if count > filter_ids:
        zeros = [F.lit(0).cast("long").alias(f"p{k}") for k in range(FILTER_HASHES)]
        return rows.join(need, "id", "left_semi").select(*rows.columns, *zeros), np.full(1, 1, U)
    words = id_filter(need, count)
    return rows.select("*", *(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(64 * len(words))).alias(f"p{k}") for k in range(FILTER_HASHES))), words


def _there(batch: pa.RecordBatch, words: np.ndarray) -> pa.RecordBatch:
    """The rows of a batch whose last columns are places that the filter has."""
    found = np.ones(batch.num_rows, bool)
    for column in batch.columns[-FILTER_HASHES:]:
        p = column.to_numpy(zero_copy_only=False).astype(U)
        found &= (words[p >> U(6)] >> (p & U(63)) & U(1)).astype(bool)
    return batch.filter(pa.array(found))


def some_signatures(sigs: DataFrame, need: DataFrame, tables: Scratch, filter_ids: int = FILTER_IDS) -> DataFrame:
    """(id, sig) of the ids in need, and a few more: a join with need then shuffles little else."""
    return _signatures_in(sigs, tables.write(need.distinct()), filter_ids)


def _signatures_in(sigs: DataFrame, need: DataFrame, filter_ids: int = FILTER_IDS) -> DataFrame:
    """some_signatures for a table of distinct ids."""
    rows, words = _picked(sigs.select("id", "sig"), need, filter_ids)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_there(batch, words).columns[:2], ["id", "sig"])

    return rows.mapInArrow(run, "id long, sig binary")


def full_sets(texts: DataFrame, need: DataFrame, tables: Scratch, filter_ids: int = FILTER_IDS) -> DataFrame:
    """(id, shingles) of the rows of texts (id, text) whose id is in need, and of a few more; no text is shuffled."""
    rows, words = _picked(texts.select("id", "text"), tables.write(need.distinct()), filter_ids)

    def run(batches):
        for batch in batches:
            at, size = 0, 256  # sets of so many texts leave at a time
            batch = _there(batch, words)
            while at < batch.num_rows:
                part = batch.slice(at, size)
                sets = [s.astype(np.int64) for s in sets_of(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])
                at += size

    return tables.write(rows.mapInArrow(run, "id long, shingles array<long>"))


def fits(n: np.ndarray, m: int, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be as similar as asked for."""
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _neighbours(percent: int):
    """For each row of a sorted order the most alike of the rows shortly before it in its region."""

    def run(batches):
        before: list[tuple] = []
        for batch in batches:
            found = []
            for region, i, n, sig in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if before and before[-1][0] != region:
                    before = []
                near = [x for x in before if 100 * min(x[2], n) >= percent * max(x[2], n)]
                if near:
                    alike = (places([x[3] for x in near]) == np.frombuffer(sig, np.uint16)).mean(axis=1)
                    best = int(np.argmax(alike))
                    if alike[best] >= percent / 100 - SLACK:
                        found.append((max(i, near[best][1]), min(i, near[best][1])))
                before = [*before[1 - BEFORE :], (region, i, n, sig)]
            yield pa.RecordBatch.from_arrays(_longs([[f[k] for f in found] for k in (0, 1)]), ["a", "b"])

    return run


#: Columns of a row in a block: whether it is on the left or the right side, its id, size, component, and leaf trees.
SIDED = ("region", "i", "j", "tree", "depth", "l", "r", "id", "n", "c", "mask")


class BlockPair:
    """The rows of two blocks, or of one that meets itself: those of the left are compared with those of the right."""

    def __init__(self, rows: list[tuple], percent: int):
        self.tree, self.depth = rows[0][3:5]
        self.left, self.right, self.ids, self.n, self.c, self.mask = (np.array([r[k] for r in rows]) for k in range(5, 11))
        self.sigs, self.percent = places([r[11] for r in rows]), percent
        self.keys = self.sigs.reshape(len(rows), TREES, DEPTH)[:, : self.tree, : self.depth]

    def candidates(self, x: int, others: np.ndarray) -> np.ndarray:
        """Rows that the left row x may link with, of those marked in others.

        Those that share a region of an earlier tree with it are left to that tree.
        """
        near = others & self.right & (self.c != self.c[x]) & fits(self.n, self.n[x], self.percent)
        near &= ~self.left | (self.ids < self.ids[x])
        at = np.flatnonzero(near)
        if self.tree and len(at):
            leaf = (self.mask[x] >> np.arange(self.tree) & 1).astype(bool)
            at = at[~((self.keys[at] == self.keys[x]).all(axis=2) & leaf).any(axis=1)]
        if len(at):
            at = at[(self.sigs[at] == self.sigs[x]).mean(axis=1) >= self.percent / 100 - SLACK]
        return at

    def undecided(self) -> np.ndarray:
        """Marks the rows with a candidate."""
        out, everyone = np.zeros(len(self.ids), bool), np.ones(len(self.ids), bool)
        for x in np.flatnonzero(self.left):
            at = self.candidates(x, everyone)
            if len(at):
                out[x] = True
                out[at] = True
        return out

    def links(self, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """A forest of the links: each joins what no link before it has joined."""
        ends = np.cumsum([0] + [len(s) for s in sets])
        _, data = np.unique(np.concatenate(sets), return_inverse=True)
        marked = np.zeros(len(data) + 1, bool)
        label = self.c.copy()
        out = []
        for x in np.flatnonzero(self.left):
            at = self.candidates(x, label != label[x])
            if not len(at):
                continue
            own = data[ends[x] : ends[x + 1]]
            marked[own] = True
            for y in at:
                if label[y] != label[x]:
                    both = int(np.count_nonzero(marked[data[ends[y] : ends[y + 1]]]))
                    if 100 * both >= self.percent * (int(self.n[x]) + int(self.n[y]) - both):
                        out.append((int(self.ids[x]), int(self.ids[y])))
                        label[label == label[y]] = label[x]
            marked[own] = False
        return out


def _by_block(make, names: list[str]):
    """Apply make to the rows of each block pair; rows come sorted by their first three columns."""

    def run(batches):
        key, rows = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                columns = [c.to_pylist() if not pa.types.is_list(c.type) else [x.values.to_numpy(zero_copy_only=False) for x in c] for c in batch.slice(at, 512).columns]
                for row in zip(*columns, strict=True):
                    if row[:3] != key:
                        if len(rows) > 1:
                            yield from make(rows)
                        key, rows = row[:3], []
                    rows.append(row)
        if len(rows) > 1:
            yield from make(rows)

    return run


def _undecided(percent: int):
    def make(rows):
        chosen = [rows[k][:11] for k in np.flatnonzero(BlockPair(rows, percent).undecided())]
        if chosen:
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), *(pa.int64(),) * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*chosen, strict=True), kinds, strict=True)], list(SIDED))

    return _by_block(make, list(SIDED))


def _linked(percent: int):
    def make(rows):
        found = BlockPair(rows, percent).links([r[12] for r in rows])
        if found:
            yield pa.RecordBatch.from_arrays(_longs(zip(*found, strict=True)), ["a", "b"])

    return _by_block(make, ["a", "b"])


def forest_regions(sigs: DataFrame, reps: DataFrame, tables: Scratch, region: int = REGION) -> tuple[DataFrame, DataFrame]:
    """(region, tree, id, n) of the first level, and (region, tree, depth, id, n, mask) to be compared, of all levels.

    mask has a bit for each tree in which the row's region of that level is compared. Regions of one are left out.
    sigs has (id, sig) of all documents, reps is a table of (id, n) of those that take part. Of a signature only the
    prefixes of a level are shuffled, and at the levels after the first only those of documents in dense regions.
    """
    first = compared = None
    members = reps
    for depth, trees in LEVELS:
        known = sigs if first is None else _signatures_in(sigs, members)
        prefixes = [F.expr(f"substring(sig, {2 * DEPTH * t + 1}, {2 * depth})") for t in range(trees)]
        # not a semi join, which Spark moves below the prefixes, to whole signatures
        rows = known.select("id", F.concat(*prefixes).alias("prefixes")).join(members, "id").select("id", "n", "prefixes", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        region_of = F.concat(F.expr(f"unhex(lpad(hex(tree * 8 + {depth}), 4, '0'))"), F.expr(f"substring(prefixes, tree * {2 * depth} + 1, {2 * depth})"))
        rows = rows.select(region_of.alias("region"), "id", "n", "tree")
        size = rows.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
        rows = tables.write(rows.join(size, "region").select("region", "id", "n", "size", "tree"))
        first = rows if first is None else first
        last = depth == DEPTH
        leaf = rows if last else rows.where(F.col("size") <= region)
        mask = leaf.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("mask"))
        leaf = leaf.join(mask, "id").select("region", "tree", F.lit(depth).alias("depth"), "id", "n", "mask")
        compared = leaf if compared is None else compared.union(leaf)
        if last:
            return first, compared
        members = tables.write(rows.where(F.col("size") > region).select("id", "n").distinct())
        if not members.take(1):
            return first, compared


def in_blocks(placed: DataFrame) -> DataFrame:
    """SIDED of every row of (region, tree, depth, id, n, c, mask) in each pair of blocks it is met in.

    A component that would fill a block or more of a region has blocks of its own, which meet those of others only; the
    rest share blocks by id. So the work follows the pairs of different components. Regions of one are left out.
    """
    share = F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)
    held = placed.groupBy("region", "c").agg(share.alias("m"))
    big = F.when(F.col("m") >= 1, F.struct("c", F.ceil("m").cast("int").alias("nb")))
    met = held.groupBy("region").agg(F.count("*").alias("cs"), F.sum(F.when(F.col("m") < 1, F.col("m")).otherwise(0)).alias("few"), F.array_sort(F.collect_list(big)).alias("big"))
    met = met.where("cs > 1").withColumn("mixed", F.ceil("few").cast("int"))
    met = met.withColumn("own", F.expr("transform(big, (x, p) -> struct(x.c as c, x.nb as nb, mixed + aggregate(slice(big, 1, p), 0, (a, y) -> a + y.nb) as at))"))
    met = met.select("region", "mixed", "own", F.expr("mixed + aggregate(big, 0, (a, y) -> a + y.nb)").alias("blocks"))
    rows = placed.join(met, "region").withColumn("own", F.expr("get(filter(own, x -> x.c = c), 0)"))
    rows = rows.withColumn("k", F.expr("cast(coalesce(own.at, 0) + pmod(xxhash64(id), coalesce(own.nb, mixed)) as int)"))
    others = "filter(sequence(0, blocks - 1), j -> own is null or j < own.at or j >= own.at + own.nb)"
    sides = F.expr(f"transform({others}, j -> struct(least(j, k) as i, greatest(j, k) as j, k <= j as l, k >= j as r))")
    return rows.withColumn("s", F.explode(sides)).select("region", "s.i", "s.j", "tree", "depth", "s.l", "s.r", "id", "n", "c", "mask")


def near_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b")
    met = met.withColumn("both", F.size(F.array_intersect("sa", "sb")))
    return met.where(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b")


def link_sets(texts: DataFrame, percent: int, tables: Scratch, region: int = REGION, unique: bool = True) -> tuple[DataFrame, DataFrame]:
    """(id, n) and (id, component) of rows (id, text) with ids that are not null; rows of equal id have equal texts.

    The second has the ids that link or share their set; the component is the smallest id reached.
    """
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    signed = texts.mapInArrow(_sign, "id long, n long, k1 long, k2 long, sig binary")
    signed = tables.write(signed if unique else signed.dropDuplicates(["id"]))
    copies = signed.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"))
    reps = tables.write(copies.select(F.col("rep").alias("id"), "n"))
    sigs = signed.select("id", "sig")
    first, compared = forest_regions(sigs, reps, tables, region)

    order = first.where(F.col("tree") < ORDERS)
    order = order.join(some_signatures(sigs, order.select("id"), tables), "id")
    order = order.withColumn("key", F.expr(f"substring(sig, tree * {2 * DEPTH} + 1, {2 * DEPTH})"))
    sorted_ = order.repartitionByRange(tasks, "region", "key", "id").sortWithinPartitions("region", "key", "id").select("region", "id", "n", "sig")
    pairs = tables.write(sorted_.mapInArrow(_neighbours(percent), "a long, b long").where("a <> b").distinct())
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    sets = full_sets(texts, ends, tables)
    links = tables.write(near_pairs(pairs, sets if unique else sets.dropDuplicates(["id"]), percent))
    tables.drop(sets)
    groups = tables.adopt(connected_components(links))

    parts = groups.select(F.col("node").alias("id"), F.col("component").alias("c"))
    placed = compared.join(parts, "id", "left").withColumn("c", F.coalesce("c", "id"))
    blocks = tables.write(in_blocks(placed))
    blocks = blocks.join(some_signatures(sigs, blocks.select("id"), tables), "id").select(*SIDED, "sig").repartition(tasks, "region", "i", "j").sortWithinPartitions("region", "i", "j")
    kinds = "region binary, i int, j int, tree int, depth int, l boolean, r boolean, id long, n long, c long, mask long"
    rest = tables.write(blocks.mapInArrow(_undecided(percent), kinds))
    if rest.take(1):
        sets = full_sets(texts, rest.select("id"), tables)
        blocks = rest.join(some_signatures(sigs, rest.select("id"), tables), "id").join(sets if unique else sets.dropDuplicates(["id"]), "id").select(*SIDED, "sig", "shingles").repartition(tasks, "region", "i", "j").sortWithinPartitions("region", "i", "j")
        late = tables.write(blocks.mapInArrow(_linked(percent), "a long, b long"))
        if late.take(1):
            groups = tables.adopt(connected_components(links.union(late)))
    kept = groups.select(F.col("node").alias("rep"), "component")
    member = signed.where("n > 0").select("id", "n", "k1", "k2").join(copies, ["n", "k1", "k2"]).join(kept, "rep", "left")
    return signed.select("id", "n"), member.select("id", F.coalesce("component", "rep").alias("component")).distinct()


#: Ids are cut into 2 ** 3 stretches; ids of a row's own come from one in which no document's id is.
STRETCH = 61


def _own_id(doc_id, text, differ, base: int):
    """An id of its own for a row whose doc_id has other texts too, in the free stretch of ids that begins at base."""
    return F.when(differ, F.lit(base) + F.shiftrightunsigned(F.xxhash64(doc_id, text), 64 - STRETCH)).otherwise(doc_id)


def _free_stretch(own: DataFrame) -> int:
    """Where ids of rows' own begin: above all usual ids, if that stretch is free."""
    used = {r.k for r in own.select(F.shiftright("doc_id", STRETCH).alias("k")).distinct().collect()}  # eight at most
    free = next((k for k in (2, 3, 1, -1, -2, -3, -4, 0) if k not in used), None)
    if free is None:
        raise ValueError("ids of documents reach into every eighth of the long numbers, and some ids have several texts")
    return free << STRETCH


def distinct_ids(docs: DataFrame, key: str, text: str, tables: Scratch) -> tuple[DataFrame, DataFrame | None, int]:
    """(id, text, doc_id) of the rows whose id is not null, so that rows of an id have equal texts, and the doc_ids of
    several rows as (doc_id, differ), None if there is none. differ: their texts differ. Last where own ids begin.
    """
    own = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    again = tables.write(own.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if not again.take(1):
        return own.select(F.col("doc_id").alias("id"), "text", "doc_id"), None, 0
    h = F.xxhash64("text")
    again = tables.write(own.join(again, "doc_id", "left_semi").groupBy("doc_id").agg((F.min(h) < F.max(h)).alias("differ")))
    rows, base = own.join(again, "doc_id", "left"), _free_stretch(own)
    return rows.select(_own_id(F.col("doc_id"), F.col("text"), F.coalesce("differ", F.lit(False)), base).alias("id"), "text", "doc_id"), again, base


def link_documents(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text", region: int = REGION) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per document with the smallest doc_id it reaches by links."""
    with Scratch() as tables:
        rows, again, _ = distinct_ids(docs, key, text, tables)
        sizes, member = link_sets(rows.select("id", "text"), percent, tables, region, again is None)
        if again is not None:
            names = tables.write(rows.join(again, "doc_id", "left_semi").select("id", "doc_id").distinct())
            sizes = sizes.join(names, "id", "left").groupBy(F.coalesce("doc_id", "id").alias("id")).agg(F.max("n").alias("n"))
            member = tables.write(member)
            own = member.join(names, "id", "left").select(F.coalesce("doc_id", "id").alias("id"), "component")
            merged = tables.adopt(connected_components(own.select(F.col("id").alias("a"), F.col("component").alias("b"))))
            member = merged.select(F.col("node").alias("id"), "component")
        found = sizes.join(member, "id", "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
        nothing = docs.where(F.col(key).isNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        nothing = nothing.mapInArrow(_sign, "id long, n long, k1 long, k2 long, sig binary").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
        out = found.union(nothing).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        return tables.keep(out)


def keep_one(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text", region: int = REGION) -> DataFrame:
    """The rows of docs, all columns, of one document of each component: that with the smallest id.

    Rows with a null id stay. Of equal rows of a doc_id one stays. Rows of a doc_id with different texts are told
    apart by their texts and count after those of other ids. The columns of docs may have any names.
    """
    with Scratch() as tables:
        rows, again, base = distinct_ids(docs, key, text, tables)
        _, member = link_sets(rows.select("id", "text"), percent, tables, region, again is None)
        gone = tables.keep(member.where("id <> component").select(F.col("id").alias("lw:id")))
        repeated = None if again is None else tables.keep(again.select(F.col("doc_id").alias("lw:id"), F.col("differ").alias("lw:differ")))
    own = F.col(key).cast("long")
    if repeated is None:  # by a shuffle at every size: how many documents go isn't bounded
        return docs.join(gone.hint("merge"), own == F.col("lw:id"), "left_anti")
    one = docs.join(repeated, own == F.col("lw:id")).withColumn("lw:own", _own_id(own, F.col(text).cast("string"), F.col("lw:differ"), base)).drop("lw:id", "lw:differ")
    one = one.dropDuplicates(["lw:own"]).join(gone, F.col("lw:own") == F.col("lw:id"), "left_anti").drop("lw:own")
    return docs.join(repeated.select("lw:id").union(gone), own == F.col("lw:id"), "left_anti").union(one)
