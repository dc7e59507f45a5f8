"""Operator 6: embedding near-duplicates by an exact metric range join.

Vectors of a label are scaled to unit length, so cosine >= c is a distance of at most r = sqrt(2 - 2 c). Pivots cut a
label's vectors into cells, each vector at home with its nearest pivot. By the triangle inequality a vector can only
link with one of another cell if it lies within r of the plane between the two pivots; then the lower cell of the two
gets a copy of it. So each pair meets in exactly one cell, and cells join independently. A cell is joined in blocks
of bounded size, and a block pair returns the link counts of its vectors and a spanning forest of its links, never all
pairs. Exact copies are one vector with a weight.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those with a null label
or id, link with nothing and are their own component. Vectors of a label meet only vectors of as many components. Rows
of equal id are counted as different vectors; a null id has a null component and is kept. Ties of the nearest pivot go to the first. Other columns are never read;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, connected_components

COSINE = 0.93
#: Vectors of a label for each of its pivots, the most pivots of a label, and vectors of a block.
PIVOT_ROWS, PIVOTS, BLOCK = 3000, 64, 2048
#: Vectors of a label that are placed at a time.
CHUNK = 32_768
#: For rounding: distances are compared with so much to spare, links are not.
SPARE = 1e-6
#: Vectors whose cosine is compared in double precision at a time.
STRIP = 512


def _unit(table_column) -> np.ndarray:
    flat = table_column.combine_chunks() if isinstance(table_column, pa.ChunkedArray) else table_column
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(table_column), -1)
    return x


def _forest(linked: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what a block of links joins: linked[i, j] links rows[i] with cols[j]."""
    out, row_open, col_open = [], linked.any(axis=1), linked.any(axis=0)
    while row_open.any():
        start = int(np.argmax(row_open))
        row_open[start] = False
        frontier = [start]
        while frontier:
            reached = np.flatnonzero(linked[frontier].any(axis=0) & col_open)
            col_open[reached] = False
            out += [(int(rows[start]), int(cols[j])) for j in reached]
            found = np.flatnonzero(linked[:, reached].any(axis=1) & row_open) if len(reached) else []
            row_open[found] = False
            out += [(int(rows[start]), int(rows[i])) for i in found]
            frontier = list(found)
    return out


def join_blocks(left: tuple, right: tuple | None, cosine: float):
    """Link counts and forest edges of one block with another, or with itself if right is None.

    A block is (ids, weights, unit vectors). Yields (id, other, n): n links of id if other is null, else an edge.
    """
    ids, weight, x = left
    other_ids, other_weight, y = left if right is None else right
    forest: list[tuple[int, int]] = []
    count, other_count = np.zeros(len(ids), np.int64), np.zeros(len(other_ids), np.int64)
    for at in range(0, len(ids), STRIP):
        linked = x[at : at + STRIP] @ y.T >= cosine
        if right is None:
            k = np.arange(at, min(at + STRIP, len(ids)))
            linked[k - at, k] = False
        count[at : at + STRIP] = linked @ other_weight
        if right is not None:
            other_count += weight[at : at + STRIP] @ linked
        if linked.any():
            forest += _forest(linked, ids[at : at + STRIP], other_ids)
    for i in np.flatnonzero(count):
        yield int(ids[i]), None, int(count[i])
    for j in np.flatnonzero(other_count):
        yield int(other_ids[j]), None, int(other_count[j])
    for a, b in forest:
        if a != b:
            yield a, b, 0


def link_vectors(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors."""
    radius = math.sqrt(max(0.0, 2 - 2 * cosine)) + SPARE
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.transform(F.col(vector), lambda v: v.cast("double")).alias("x"), F.col(label).cast("string").alias("label"))
    valid = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
    valid &= F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    # -0.0 and 0.0 are the same component
    with Scratch() as tables:
        return tables.keep(_linked(rows, cosine, radius, tables))


def _place(radius: float):
    """Cells of the vectors of a chunk: each row at home with its nearest pivot, copies in the lower cells within reach."""

    def run(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        names = ("space", "cell", "home", "id", "weight", "x")
        kinds = (pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.float64()))
        out: list[list] = [[] for _ in names]
        if rows.num_rows and pivots.num_rows:
            pivots = pivots.sort_by("slot")
            p, x = _unit(pivots["x"]), _unit(rows["x"])
            apart = np.sqrt(np.maximum(0, (p**2).sum(axis=1)[:, None] + (p**2).sum(axis=1) - 2 * p @ p.T))
            ids, weights, space = rows["id"].to_numpy(), rows["weight"].to_numpy(), rows["space"][0].as_py()
            for at in range(0, len(ids), STRIP):
                part = x[at : at + STRIP]
                square = (part**2).sum(axis=1)[:, None] + (p**2).sum(axis=1) - 2 * part @ p.T
                home = square.argmin(axis=1)
                here = np.arange(len(part))
                near = square - square[here, home][:, None] <= 2 * radius * apart[home] + SPARE
                near &= np.arange(len(p)) < home[:, None]
                near[here, home] = True
                for i, cell in np.argwhere(near).tolist():
                    for column, v in zip(out, (space, cell, cell == home[i], int(ids[at + i]), int(weights[at + i]), part[i]), strict=True):
                        column.append(v)
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], list(names))

    return run


def _linked(rows: DataFrame, cosine: float, radius: float, tables: Scratch) -> DataFrame:
    # -0.0 and 0.0 are the same component
    some = rows.where("valid").select("vec_id", F.transform("x", lambda v: v + F.lit(0.0)).alias("x"), "label")
    some = some.select("vec_id", "x", F.concat_ws(":", F.size("x"), "label").alias("space"), F.xxhash64("label", "x").alias("h1"), F.xxhash64(F.lit(1), "x", "label").alias("h2"))
    reps = some.groupBy("space", "h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("x").alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    top = F.array_max(F.transform("x", lambda v: F.abs(v)))  # first scaled by the largest, so that no square overflows
    reps = reps.withColumn("x", F.transform("x", lambda v: v / top)).withColumn("norm", norm)
    reps = tables.write(reps.select("id", "weight", "space", "h1", "h2", F.expr("transform(x, v -> v / norm)").alias("x")))

    sizes = reps.groupBy("space").agg(F.count("*").alias("n"))
    sizes = sizes.select("space", F.least(F.lit(PIVOTS), F.ceil(F.col("n") / PIVOT_ROWS)).cast("int").alias("pivots"), F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    slots = reps.join(sizes, "space").withColumn("slot", F.pmod(F.xxhash64("id"), F.col("pivots")).cast("int")).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(5)), F.col("chunks")).cast("int"))
    pivots = tables.write(slots.groupBy("space", "slot").agg(F.min_by("x", F.xxhash64("id", F.lit(7))).alias("x")))
    pivots = pivots.join(sizes, "space").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("space", "chunk", "slot", "x")
    placed = slots.select("space", "chunk", "id", "weight", "x").groupBy("space", "chunk").cogroup(pivots.groupBy("space", "chunk"))
    dealt = tables.write(placed.applyInArrow(_place(radius), "space string, cell int, home boolean, id long, weight long, x array<double>"))
    counts = dealt.groupBy("space", "cell").agg(F.count_if("home").alias("h"), F.count_if(~F.col("home")).alias("g"))
    counts = counts.where("h > 0").select("space", "cell", F.greatest(F.lit(1), F.ceil(F.col("h") / BLOCK)).cast("int").alias("hb"), F.ceil(F.col("g") / BLOCK).cast("int").alias("gb"))
    blocks = dealt.join(counts, ["space", "cell"]).withColumn("b", F.pmod(F.xxhash64("id", F.lit(3)), F.when(F.col("home"), F.col("hb")).otherwise(F.greatest("gb", F.lit(1)))).cast("int"))
    # pairs of blocks: home with home, each once, and home with guest; a block takes the left or the right side
    sides = F.expr("""case when home then concat(
        transform(sequence(b, hb - 1), j -> struct(b as i, j as j, true as l)),
        transform(filter(sequence(0, b), i -> i < b), i -> struct(i as i, b as j, false as l)),
        transform(filter(sequence(0, gb), j -> j < gb), j -> struct(b as i, hb + j as j, true as l)))
      else transform(sequence(0, hb - 1), i -> struct(i as i, hb + b as j, false as l)) end""")
    sided = blocks.withColumn("s", F.explode(sides)).select("space", "cell", "s.i", "s.j", "s.l", "id", "weight", "x")

    def join_pair(part: pa.Table) -> pa.Table:
        own = part["l"].to_numpy(zero_copy_only=False)
        ids, weight, x = part["id"].to_numpy(), part["weight"].to_numpy(), _unit(part["x"])
        same = part["i"][0].as_py() == part["j"][0].as_py()
        left, right = (ids[own], weight[own], x[own]), None if same else (ids[~own], weight[~own], x[~own])
        found = list(join_blocks(left, right, cosine)) if len(left[0]) and (same or len(right[0])) else []
        return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate(("a", "b", "n"))})

    found = tables.write(sided.groupBy("space", "cell", "i", "j").applyInArrow(join_pair, "a long, b long, n long"))
    degree = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    groups = tables.adopt(connected_components(found.where("b is not null").select("a", "b"))).toDF("id", "component")

    facts = reps.select("id", "weight", "space", "h1", "h2").join(degree, "id", "left").join(groups, "id", "left")
    facts = facts.select("space", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    member = some.select("vec_id", "space", "h1", "h2").join(facts, ["space", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return member.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
