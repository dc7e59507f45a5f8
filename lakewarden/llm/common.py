"""Helpers shared by the training-data operators: shared-folder tables and connected components."""

from __future__ import annotations

import contextlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: Documents with this remainder of crc32(doc_id as text) mod 5 are held out from every fit.
HELD_OUT_MOD = 5


#: Bytes of an Arrow batch: a worker's memory then follows bytes, however long the texts of its rows are.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """From here on the session's Arrow batches hold at most BATCH_BYTES, or the session's own limit if it is lower."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = int(spark.conf.get(key).rstrip("b"))
    if own <= 0 or own > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """True for the fold that no model learns from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT_MOD == 0, F.lit(False))


def crc_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % HELD_OUT_MOD == 0


def sample_place(key: str, text: str):
    """Place of a row between 0 and 1 by its id and text, for samples: rows without an id have places of their own too."""
    return (F.xxhash64(F.col(key).cast("string"), F.col(text).cast("string"), F.lit(1)).cast("double") + 2.0**63) / 2.0**64


#: A sample has at most so many times the rows that are asked for, even if one row is repeated without end.
SAMPLE_SLACK = 1.25


#: Spark's setting that a query's shuffle files go as soon as it ends; else they go when the driver's collector finds them.
END_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends at files that outlive executors.

    What the write has shuffled is deleted with its end: nothing reads it again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lw-{uuid.uuid4().hex}"
    own = spark.conf.get(END_SHUFFLES, "false")
    spark.conf.set(END_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(END_SHUFFLES, own)
    out = spark.read.schema(df.schema).parquet(path)
    out._lw_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing will read again."""
    path = getattr(df, "_lw_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        with contextlib.suppress(Exception):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables in the shared folder that go when the work is done; those that a result still reads are named to keep()."""

    def __init__(self):
        self.tables: list[DataFrame] = []

    def __enter__(self):
        return self

    def write(self, df: DataFrame) -> DataFrame:
        self.tables.append(materialize(df))
        return self.tables[-1]

    def adopt(self, df: DataFrame) -> DataFrame:
        """Take charge of a table that something else wrote."""
        self.tables.append(df)
        return df

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing reads again."""
        self.tables = [t for t in self.tables if t is not df]
        release(df)

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a result, which outlives the other tables."""
        return materialize(df)

    def __exit__(self, *_):
        for t in self.tables:
            release(t)
        self.tables = []


class Recent(dict):
    """A cache of bounded size: when it is full its rows become the older half, and those asked for again come back."""

    def __init__(self, rows: int):
        super().__init__()
        self.rows, self.older = rows, {}

    def find(self, key):
        found = self.get(key)
        if found is None:
            found = self.older.get(key)
            if found is not None:
                self.keep(key, found)
        return found

    def keep(self, key, value) -> None:
        if len(self) >= self.rows:
            self.older = dict(self)
            self.clear()
        self[key] = value


#: Edges that one task contracts at a time.
CONTRACT_ROWS = 200_000


def _contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the same components as the edges (a, b); each root is the smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        m = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], m)
        np.minimum.at(label, label[v], m)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            break
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def contract_batches(batches):
    """Reduce the edges of each run of batches to stars before anything is shuffled."""
    a, b, n = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        a.append(batch.column(0).to_numpy(zero_copy_only=False))
        b.append(batch.column(1).to_numpy(zero_copy_only=False))
        n += batch.num_rows
        if n >= CONTRACT_ROWS:
            u, v = _contract(np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["a", "b"])
            a, b, n = [], [], 0
    if n:
        u, v = _contract(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as edges (a, b) of longs.

    Returns (node, component): each node that has an edge, with the smallest node it reaches. Edges are first
    contracted inside each task, then large-star and small-star rounds run until no edge changes; every round is
    written to the shared folder. A star's centre is met by partial aggregation and a join that Spark can split,
    so one huge component does not gather in one task. At most CONTRACT_ROWS edges, as many as a task contracts at a
    time anyway, are done in one step; the result is the same. Self loops and null ends are ignored.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null and a <> b")
    current = materialize(edges.mapInArrow(contract_batches, "a long, b long").distinct())
    seen = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    while seen.n:
        if seen.n <= CONTRACT_ROWS:
            done = materialize(current.coalesce(1).mapInArrow(contract_batches, "a long, b long"))
            release(current)
            current = done
            break
        sym = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = sym.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        following = materialize(small.where("a <> b").distinct())
        now = following.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        release(current)
        current = following
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    out = current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
    out._lw_path = current._lw_path
    return out
