"""Most specific range of each key: a range join with both sides of any size, nested and overlapping ranges included.

Keys and starts of ranges are sorted together and dealt in stretches; keys of an equal address may fall in several. Ranges
that go on beyond their stretch are carried into those that they reach: with nested ranges that is the depth of nesting
for each stretch. Each stretch is then swept by itself, holding only the ranges that are open.
"""

from __future__ import annotations

import heapq
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, scratch_folder


def _sweep(batches):
    """The open range of least size for each key; rows come by stretch, key, ranges first."""
    stretch, open_ranges = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("stretch", "k", "kind", "hi", "value")]
        lo_hi = list(zip(batch.column("lo").to_pylist(), columns[3], strict=True))
        keep, found = [], []
        for i, (s, k, kind, hi, value) in enumerate(zip(*columns, strict=True)):
            if s != stretch:
                stretch, open_ranges = s, []
            if kind == 0:
                lo = lo_hi[i][0]
                heapq.heappush(open_ranges, (int.from_bytes(hi, "big") - int.from_bytes(lo, "big"), lo, value, hi))
            else:
                while open_ranges and open_ranges[0][3] < k:
                    heapq.heappop(open_ranges)  # keys only grow
                keep.append(i)
                found.append(open_ranges[0] if open_ranges else (None, None, None, None))
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("row").take(at), *(pa.array([f[j] for f in found], t) for j, t in ((1, pa.binary()), (3, pa.binary()), (2, pa.string())))], ["row", "range_lo", "range_hi", "range_value"])


def most_specific(keys: DataFrame, ranges: DataFrame, key: str = "ip") -> DataFrame:
    """keys with range_lo, range_hi and range_value of the smallest range (lo, hi, value; both ends included) that holds
    the key, null if none does.

    Keys and ends are binary, of one length, compared byte by byte. Of ranges of a size the one that begins first counts,
    then the smaller value. Rows with a null key keep their place; ranges with a null end or hi < lo hold nothing.
    """
    spark, path = keys.sparkSession, scratch_folder(keys.sparkSession, f"ranges-{uuid.uuid4().hex}")
    numbered = keys.withColumn("own_row", F.monotonically_increasing_id())
    numbered.write.parquet(f"{path}/keys")  # rows keep their numbers
    numbered = spark.read.schema(numbered.schema).parquet(f"{path}/keys")
    none = F.lit(None)
    points = numbered.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.lit(1).alias("kind"), F.col("own_row").alias("row"), none.cast("binary").alias("lo"), none.cast("binary").alias("hi"), none.cast("string").alias("value"))
    valid = ranges.where("lo is not null and hi is not null and lo <= hi").select("lo", "hi", F.col("value").cast("string").alias("value")).where("value is not null")
    events = points.unionByName(valid.select(F.col("lo").alias("k"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("row"), "lo", "hi", "value"))
    # ranges before keys of an equal address, which a hot address may have in several stretches
    events.repartitionByRange("k", "kind", F.xxhash64("row")).withColumn("stretch", F.spark_partition_id()).write.parquet(f"{path}/events")
    events = spark.read.schema("k binary, kind int, row long, lo binary, hi binary, value string, stretch int").parquet(f"{path}/events")
    edges = events.groupBy("stretch").agg(F.min("k").alias("first"), F.max("k").alias("last"))
    edges.write.parquet(f"{path}/edges")  # a row for each stretch
    edges = F.broadcast(spark.read.schema("stretch int, first binary, last binary").parquet(f"{path}/edges"))
    every = edges.agg(F.array_sort(F.collect_list(F.struct("stretch", "first"))).alias("all"))
    going_on = events.where("kind = 0").join(edges.select("stretch", "last"), "stretch").where("hi >= last").join(F.broadcast(every))  # one row
    reached = F.filter("all", lambda e: (e["stretch"] > F.col("stretch")) & (e["first"] <= F.col("hi")))
    carried = going_on.select(F.explode(reached).alias("e"), "lo", "hi", "value").select(F.col("e.first").alias("k"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("row"), "lo", "hi", "value", F.col("e.stretch").alias("stretch"))
    swept = events.unionByName(carried).repartition("stretch").sortWithinPartitions("stretch", "k", "kind")
    found = swept.mapInArrow(_sweep, "row long, range_lo binary, range_hi binary, range_value string")
    found.write.parquet(f"{path}/found")
    drop_path(spark, f"{path}/events")
    found = spark.read.schema("row long, range_lo binary, range_hi binary, range_value string").parquet(f"{path}/found")
    return numbered.join(found.withColumnRenamed("row", "own_row"), "own_row", "left").drop("own_row")
