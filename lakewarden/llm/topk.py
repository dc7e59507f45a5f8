"""Operator 2: exact top-k inner products over a bit-sliced index.

Components become integers, floor(256 * x). A block of rows is indexed by bit slices: for each component and each bit
of its value a bitmap over the block's rows. A query's inner product with all rows of a block is a sum of shifted
slices, formed by carry-save adders on whole bitmaps: each set bit of a query component adds that component's slices.
The slices of the sum are then read from the most significant downward to keep the k highest rows, and rows that tie
at the boundary are taken by smaller id. Query blocks meet candidate blocks; each pair is one group of two rows.

Defined results: vectors that are null, hold null or non-finite components or have a null id take no part. Vectors
meet only vectors of as many components. Rows of an equal id are vectors of their own, and candidates of each other. A
query without candidates has no row. Other columns are never read; an empty table gives an empty result. Finite values
of any size take part; a score beyond the range of a long counts as its end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SCALE = 256
#: Most rows of an index block and queries of a group; fewer while there are fewer pairs of them than tasks.
BLOCK_ROWS, QUERY_ROWS = 65_536, 16_384
LEAST_ROWS, LEAST_QUERIES = 8192, 128
LEAST, MOST = -(2**63), 2**63 - 1


def build_slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bitmaps [component, bit, word] of values less their least per component, that least, and the number of bits."""
    n, dims = values.shape
    low = values.min(axis=0)
    above = values.astype(np.uint64) - low.astype(np.uint64)
    bits = max(1, int(above.max()).bit_length())
    words = -(-n // 64)
    out = np.zeros((dims, bits, words * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits(((above >> np.uint64(b)) & np.uint64(1)).astype(bool).T, axis=1, bitorder="little")
        out[:, b, : packed.shape[1]] = packed
    return out.view(np.uint64), low, bits


def add_slices(slices: np.ndarray, rows: np.ndarray, bits: int, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of the sum over components of |q| * x, x taken upside down where q < 0; the constant left out is returned."""
    weight: dict[int, list[np.ndarray]] = {}
    size = np.where(query < 0, -(query.astype(np.uint64)), query.astype(np.uint64))
    for shift in range(int(size.max()).bit_length() if len(size) else 0):
        for negative in (False, True):
            chosen = np.flatnonzero((size >> np.uint64(shift) & np.uint64(1)).astype(bool) & ((query < 0) == negative))
            for b in range(bits if len(chosen) else 0):
                part = slices[chosen, b]
                weight.setdefault(shift + b, []).append(~part & rows if negative else part)
    out, level = [], 0
    carry: list[np.ndarray] = []
    while carry or any(k >= level for k in weight):
        stack = [*weight.get(level, []), *carry]
        carry = []
        maps = np.concatenate(stack) if stack else np.zeros((1, len(rows)), np.uint64)
        while len(maps) > 1:
            third = len(maps) // 3
            if third:
                a, b, c = maps[:third], maps[third : 2 * third], maps[2 * third : 3 * third]
                half = a ^ b
                carry.append(a & b | c & half)
                maps = np.concatenate([half ^ c, maps[3 * third :]])
            else:
                carry.append(maps[:1] & maps[1:])
                maps = maps[:1] ^ maps[1:]
        out.append(maps[0])
        level += 1
    full = (1 << bits) - 1
    return out, sum(size[query < 0].tolist()) * full


def highest(slices: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k rows of highest sum, ties by position; all rows if there are no more."""
    sure, open_rows = np.zeros_like(rows), rows.copy()
    for s in reversed(slices):
        both = open_rows & s
        n = int(np.bitwise_count(sure | both).sum())
        if n > k:
            open_rows = both
        else:
            sure |= both
            open_rows &= ~s
            if n == k:
                return _positions(sure)
    first = _positions(open_rows)[: max(0, k - int(np.bitwise_count(sure).sum()))]
    return np.concatenate([_positions(sure), first])


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def block_top(ids: np.ndarray, uids: np.ndarray, slices: np.ndarray, low: np.ndarray, bits: int, query_ids: np.ndarray, query_uids: np.ndarray, queries: np.ndarray, k: int):
    """(query_id, row, vec_id, score) of the k best rows of a block for each query; rows must be in order of id."""
    everyone = np.zeros(slices.shape[-1] * 8, np.uint8)
    packed = np.packbits(np.ones(len(ids), bool), bitorder="little")
    everyone[: len(packed)] = packed
    everyone = everyone.view(np.uint64)
    lows = low.tolist()
    for q, own, query in zip(query_ids.tolist(), query_uids.tolist(), queries, strict=True):
        rows = everyone.copy()
        first, last = np.searchsorted(ids, [q, q + 1])
        for at in range(first, last):
            if uids[at] == own:
                rows[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
        sums, turned = add_slices(slices, everyone, bits, query)
        base = sum(a * b for a, b in zip(query.tolist(), lows, strict=True)) - turned
        for at in highest(sums, rows, k).tolist():
            value = sum((int(s[at >> 6]) >> (at & 63) & 1) << w for w, s in enumerate(sums))
            # upside down slices give full - x instead of -x, which `base` takes back
            yield q, own, int(ids[at]), min(MOST, max(LEAST, value + base))


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dims, q): integer components of the vectors that take part."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), x.alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return rows.select("id", F.size("x").alias("dims"), F.transform("x", lambda v: F.floor(v * SCALE).cast("long")).alias("q"))


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False) if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64)


def _index(table: pa.Table) -> pa.Table:
    """One row of bit slices for a block's rows."""
    ids, uids, values = table["id"].to_numpy(), table["row"].to_numpy(), _matrix(table["q"])
    order = np.lexsort([uids, ids])
    slices, low, bits = build_slices(values[order])
    binary = [pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in (ids[order], uids[order], low)]
    return pa.table([table["block"][:1].combine_chunks(), table["dims"][:1].combine_chunks(), *binary, pa.array([bits], pa.int32()), pa.array([slices.tobytes()], pa.binary())], ["block", "dims", "ids", "uids", "low", "bits", "slices"])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, the k highest inner products."""
    with Scratch() as tables:
        # rows are numbered, and keep their numbers as they are written
        rows = tables.write(quantised(vectors, key, vector).withColumn("row", F.monotonically_increasing_id()))
        return tables.keep(_ranked(rows, k, every))


def _ranked(rows: DataFrame, k: int, every: int) -> DataFrame:
    asked = rows.where(F.col("id") % every == 0)
    n, q = rows.count(), asked.count()
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    blocks = max(1, -(-n // BLOCK_ROWS), min(-(-n // LEAST_ROWS), tasks))
    groups = max(1, -(-q // QUERY_ROWS), min(-(-q // LEAST_QUERIES), -(-tasks // blocks)))
    place = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    index = place.groupBy("block", "dims").applyInArrow(_index, "block int, dims int, ids binary, uids binary, low binary, bits int, slices binary")
    asked = asked.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int"))
    parts = min(blocks * groups, 2000)
    left = index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(parts, "block", "grp", "dims")
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(parts, "block", "grp", "dims")

    def meet(block: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and queries.num_rows:
            ids, uids, low = (np.frombuffer(block[c][0].as_py(), np.int64) for c in ("ids", "uids", "low"))
            bits = block["bits"][0].as_py()
            slices = np.frombuffer(block["slices"][0].as_py(), np.uint64).reshape(len(low), bits, -1)
            found = list(block_top(ids, uids, slices, low, bits, queries["id"].to_numpy(), queries["row"].to_numpy(), _matrix(queries["q"]), k))
        return pa.table({c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate(("query_id", "row", "vec_id", "score"))})

    keys = ("block", "grp", "dims")
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
