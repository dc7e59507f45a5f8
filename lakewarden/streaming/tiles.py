"""Sessions over captured tiles: a streaming source whose offsets are tile indexes, and what becomes of each log.

A micro-batch is a range of tiles for each log, WINDOW at most, and only tiles that all those before them have come with:
so entries arrive in order of index however the files do, and a restart goes on at the tile after the last range. The
source gives out names of tiles alone; tasks read and parse them.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.dedup import MonthArchive
from ..operators.progress import run_states
from ..sources.leaves import TILE, leaves_of_tiles
from .ingest import LogSink, Versions, numbered

#: Tiles of a log in one micro-batch at most.
WINDOW = 128


def tile_name(n: int) -> str:
    """Groups of three digits, all but the last with `x`."""
    digits = str(n).zfill(-(-len(str(n)) // 3) * 3)
    groups = [digits[i : i + 3] for i in range(0, len(digits), 3)]
    return "/".join([*(f"x{g}" for g in groups[:-1]), groups[-1]])


class TileRanges(SimpleDataSourceStreamReader):
    """Offsets {log: next tile}; a range ends before the first tile that isn't there yet, or at the session's cap."""

    def __init__(self, options):
        self.root, self.logs = options["root"].rstrip("/"), json.loads(options["logs"])  # {log: first tile}
        self.window, self.entries = int(options.get("window", WINDOW)), int(options.get("entries", 0))
        self.given = dict.fromkeys(self.logs, 0)

    def initialOffset(self) -> dict:
        return dict(sorted(self.logs.items()))

    def _there(self, log: str, first: int, most: int) -> int:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(self.root if "://" in self.root else f"file://{self.root}")
        found = files.get_file_info([f"{base}/{log}/tile/data/{tile_name(n)}" for n in range(first, first + most)]) if most else []
        return next((k for k, f in enumerate(found) if f.type != fs.FileType.File), len(found))

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end, rows = dict(start), []
        for log in start:
            most = self.window
            if self.entries:
                most = max(0, min(most, -(-self.entries // TILE) - self.given.get(log, 0)))
            n = self._there(log, start[log], most)
            rows += [(log, t) for t in range(start[log], start[log] + n)]
            end[log] += n
            self.given[log] = self.given.get(log, 0) + n
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(log, t) for log in start for t in range(start[log], end[log])])

    def commit(self, end: dict) -> None:
        """Nothing is kept for ranges that are done."""


class TileSource(DataSource):
    """Streaming source `log_tiles`. Options: root, a folder of logs as `<log>/tile/data/...` that the driver can look
    into; logs, JSON of the first tile of each; window; entries, the cap of a session, 0 for none."""

    @classmethod
    def name(cls) -> str:
        return "log_tiles"

    def schema(self) -> str:
        return "log_id string, tile long"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return TileRanges(self.options)


def stream_tiles(spark: SparkSession, root: str, first_tiles: dict[str, int], window: int = WINDOW, entries: int = 0) -> DataFrame:
    """(log_id, tile) of complete tiles below root, in order for each log."""
    spark.dataSource.register(TileSource)
    options = {"root": root, "logs": json.dumps(dict(sorted(first_tiles.items()))), "window": str(window), "entries": str(entries)}
    return spark.readStream.format("log_tiles").options(**options).load()


def tile_contents(spark: SparkSession, root: str, tiles: DataFrame) -> DataFrame:
    """(log_id, tile, content) of the tiles of one micro-batch; the names of a batch are a window for each log."""
    named = [(f"{root.rstrip('/')}/{r.log_id}/tile/data/{tile_name(r.tile)}", r.log_id, r.tile) for r in tiles.collect()]
    if not named:
        return spark.createDataFrame([], "log_id string, tile long, content binary")
    files = spark.read.format("binaryFile").load([p for p, _, _ in named]).select("path", "content")
    at = F.regexp_extract("path", r"([^/]+)/tile/data/(.+)$", 1), F.regexp_replace(F.regexp_extract("path", r"/tile/data/(.+)$", 1), r"\D", "")
    return files.select(at[0].alias("log_id"), at[1].cast("long").alias("tile"), "content")


class Session(StreamingQueryListener):
    """Follows a stream of tiles by the metrics it observes: heartbeats, and how each log's session ends.

    States go to the table `path/states` as rows (log_id, session, cursor, tree_size, state, error, at in microseconds), a heartbeat
    whenever a log has taken `beat` entries more. A log is complete at the session's cap, caught_up at its tree's last
    full tile or when nothing more comes, and error if the stream fails.
    """

    SCHEMA = "log_id string, session long, cursor long, tree_size long, state string, error string, at long"

    def __init__(self, spark: SparkSession, path: str, cursors: dict[str, int], sizes: dict[str, int], entries: int = 0, beat: int = 50_000):
        self.spark, self.path, self.sizes, self.entries, self.beat = spark, f"{path}/states", sizes, entries, beat
        self.cursor, self.session = dict(cursors), dict.fromkeys(cursors, 0)
        self.beaten, self.state, self.at = dict.fromkeys(cursors, 0), dict.fromkeys(cursors, "running"), -1
        self.name, self.over, self.error = "", threading.Event(), None

    def observed(self, tiles: DataFrame) -> DataFrame:
        """tiles with the metrics that the session lives on: number and greatest tile of each log."""
        each = []
        for k, log in enumerate(sorted(self.cursor)):
            own = F.col("log_id") == log
            each += [F.count_if(own).alias(f"n{k}"), F.max(F.when(own, F.col("tile"))).alias(f"t{k}")]
        return tiles.observe("session", *each)

    def _write(self, logs: list[str]) -> None:
        sessions = [(log, self.session[log], self.sizes.get(log), self.error) for log in logs]
        met = run_states(self.spark.createDataFrame([(log, self.cursor[log]) for log in logs], "log_id string, next_entry_idx long"), self.spark.createDataFrame(sessions, "log_id string, processed long, tree_size long, error string"), self.entries)
        ended = F.create_map(*(F.lit(x) for log in logs for x in (log, self.state[log])))
        state = F.when(F.col("state") == "running", ended[F.col("log_id")]).otherwise(F.col("state"))
        met.withColumn("state", state).withColumn("at", F.lit(time.time_ns() // 1000)).coalesce(1).write.mode("append").parquet(self.path)

    def _end(self, log: str) -> None:
        if self.entries and self.session[log] >= self.entries:
            self.state[log] = "complete"
        elif log in self.sizes and self.cursor[log] >= self.sizes[log] // TILE * TILE:
            self.state[log] = "caught_up"

    def onQueryStarted(self, event) -> None:
        """Nothing to follow yet."""

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name or "session" not in progress.observedMetrics:
            return
        row, news = progress.observedMetrics["session"], []
        if progress.batchId <= self.at and progress.numInputRows:
            return
        self.at = max(self.at, progress.batchId)
        for k, log in enumerate(sorted(self.cursor)):
            if row[f"n{k}"]:
                self.session[log] += row[f"n{k}"] * TILE
                self.cursor[log] = (row[f"t{k}"] + 1) * TILE
            before = self.state[log]
            self._end(log)
            if self.state[log] != before or self.session[log] - self.beaten[log] >= self.beat:
                self.beaten[log] = self.session[log]
                news.append(log)
        if news:
            self._write(news)
        self._finish()

    def onQueryIdle(self, event) -> None:
        if str(event.runId) != self.run_id:
            return
        waiting = [log for log, s in self.state.items() if s == "running"]
        for log in waiting:
            self._end(log)
            if self.state[log] == "running":  # the tiles that its tree has next aren't there
                self.state[log] = "caught_up"
        if waiting:
            self._write(waiting)
        self._finish()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) != self.run_id:
            return
        if event.exception:
            self.error = event.exception.splitlines()[0]
            waiting = [log for log, s in self.state.items() if s == "running"]
            self.state |= dict.fromkeys(waiting, "error")
            if waiting:
                self._write(waiting)
        self.over.set()

    def _finish(self) -> None:
        if all(s != "running" for s in self.state.values()):
            self.over.set()

    run_id = None


def ingest_tiles(root: str, archive: MonthArchive, path: str, runs: DataFrame, checkpoint: str, sizes: dict[str, int] | None = None, entries: int = 0, window: int = WINDOW, beat: int = 50_000, stored: DataFrame | None = None, seconds: float = 3600) -> DataFrame:
    """Run one session over the captured tiles of the logs that runs names, until every log has ended; the states written.

    runs is (log_id, next_entry_idx, tree_size_at_start, total_processed, ...), a row for each log. Cursors and issuers
    are versions below path, as start_logs keeps them; sizes are the logs' tree sizes. A session goes on where the
    checkpoint's last ended.
    """
    spark, sizes = archive.spark, sizes or {}
    rows = runs.select("log_id", "next_entry_idx").collect()  # a row for each log
    table = spark.createDataFrame(list(sizes.items()), "log_id string, tree_size long")
    sink = LogSink(archive, path, runs, stored, table)
    session = Session(spark, path, {r.log_id: r.next_entry_idx for r in rows}, sizes, entries, beat)
    session.name = f"tiles-{id(session)}"
    tiles = session.observed(stream_tiles(spark, root, {r.log_id: r.next_entry_idx // TILE for r in rows}, window, entries))

    def take(batch: DataFrame, nth: int) -> None:
        sink.take(leaves_of_tiles(numbered(tile_contents(spark, root, batch), runs)), nth)

    spark.streams.addListener(session)
    try:
        query = tiles.writeStream.queryName(session.name).foreachBatch(take).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
        session.run_id = str(query.runId)
        session.over.wait(seconds)
        query.stop()
    finally:
        spark.streams.removeListener(session)
    return spark.read.schema(Session.SCHEMA).parquet(session.path)


def latest_states(states: DataFrame) -> DataFrame:
    """The last state of each log."""
    return states.groupBy("log_id").agg(F.max_by(F.struct("session", "cursor", "tree_size", "state", "error"), F.struct("at", F.col("state") != "running", "cursor")).alias("s")).select("log_id", "s.*")


__all__ = ["Session", "TileSource", "Versions", "ingest_tiles", "latest_states", "stream_tiles", "tile_contents", "tile_name"]
