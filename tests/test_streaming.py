from test_operators import subject, subjects

from lakewarden.operators.dedup import MonthArchive
from lakewarden.streaming import ingest
from lakewarden.streaming.breaker import Breaker, error_share


def test_stream_into_archive_twice(spark, tmp_path):
    source, archive = str(tmp_path / "in"), MonthArchive(spark, str(tmp_path / "archive"))
    subjects(spark, subject(1, "A"), subject(2, "B")).write.mode("append").parquet(source)
    for k in range(2):  # a second checkpoint delivers everything again
        q = ingest.start_ingest(ingest.stream_subjects(spark, source, 1), archive, str(tmp_path / f"check{k}"), seal=k == 1)
        q.awaitTermination(120)
    subjects(spark, subject(3, "B"), subject(4, "C", "2025-06")).write.mode("append").parquet(source)
    q = ingest.start_ingest(ingest.stream_subjects(spark, source), archive, str(tmp_path / "check0"))
    q.awaitTermination(120)
    assert sorted(bytes(r.cert_hash).decode() for r in archive.subjects().collect()) == ["A", "B", "C"]


def test_breaker(spark):
    b = Breaker()
    for i in range(30):
        b.record("error", i)
    assert not b.open(30)
    b.record("timeout", 30)
    assert not b.open(30)
    b.record("error", 31)
    assert b.open(60) and not b.open(61.5)
    rows = spark.createDataFrame([("s", i, "error" if i < 31 else "ok") for i in range(140)], "shard string, i int, status string")
    over = {r.i: r.over for r in error_share(rows, "shard", "i").collect()}
    assert not over[29] and over[30] and over[99] and not over[101]


def test_pages_of_logs_stream_to_subjects_and_cursors(spark, tmp_path):
    import hashlib
    import struct

    from test_sources import certificate, leaf_rows, u16, u24

    source, archive = str(tmp_path / "pages"), MonthArchive(spark, str(tmp_path / "archive"))
    schema = "log_id string, index long, leaf_input binary, extra_data binary"
    rows = leaf_rows()
    other = (7, struct.pack(">BBQH", 0, 0, 1000, 0) + u24(certificate(serial=b"\0\x09")) + u16(b""), u24(u24(certificate(cn="Other CA"))))
    parts = [("x", rows[:1]), ("y", rows), ("y", [other])]  # both logs have the first certificate
    for name, part in parts:
        spark.createDataFrame([(name, *r) for r in part], schema).coalesce(1).write.mode("append").parquet(source)
    runs = spark.createDataFrame([("x", 0, 0, 0), ("y", 0, 0, 0), ("z", 5, 9, 5)], "log_id string, next_entry_idx long, tree_size_at_start long, total_processed long")
    sizes = spark.createDataFrame([("x", 101), ("y", 200)], "log_id string, tree_size long")

    def run(out, check, seen_archive):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.start_logs(stream, seen_archive, str(tmp_path / out), runs, str(tmp_path / check), sizes=sizes).awaitTermination(120)
        last = max(int(p.name[1:]) for p in (tmp_path / out / "runs").iterdir())
        got = {r.log_id: (r.next_entry_idx, r.tree_size_at_start, r.total_processed) for r in spark.read.parquet(f"{tmp_path}/{out}/runs/v{last}").collect()}
        assert got == {"x": (101, 101, 1), "y": (103, 200, 4), "z": (5, 9, 5)}
        assert len(list((tmp_path / out / "runs").iterdir())) <= ingest.Versions.KEEP
        return {r.fingerprint: (r.ca_id, r.common_name) for r in spark.read.parquet(f"{tmp_path}/{out}/issuers/v{last}").collect()}

    issuers = run("state", "check", archive)
    first, named = hashlib.sha256(b"issuer").hexdigest(), hashlib.sha256(certificate(cn="Other CA")).hexdigest()
    assert set(issuers) == {first, named} and issuers[first][1] == "" and issuers[named][1] == "Other CA"
    assert {i for i, _ in issuers.values()} == {1, 2}
    got = {r.serial_number: r for r in archive.subjects().collect()}
    assert len(got) == 4 and {r.ca_id for k, r in got.items() if k != "09"} == {issuers[first][0]} and got["09"].ca_id == issuers[named][0]
    assert len({r.id for r in got.values()}) == 4 and {bytes(r.log_id) for r in got.values()} <= {b"x", b"y"}
    assert got["09"].id == 7 * 1024 + 1
    assert run("state2", "check2", archive) == issuers and archive.subjects().count() == 4  # everything again changes nothing


def put_tiles(root, log, *tiles, size=256):
    from test_sources import certificate, tile_leaf

    from lakewarden.streaming.tiles import tile_name

    for n in tiles:
        path = root / log / "tile/data" / tile_name(n)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"".join(tile_leaf(5, certificate(serial=bytes([0, n % 250 + 1, k]), cn=log), b"i" * 32) for k in range(size)))


def tile_runs(spark, **cursors):
    return spark.createDataFrame([(log, n, 0, n) for log, n in cursors.items()], "log_id string, next_entry_idx long, tree_size_at_start long, total_processed long")


def test_tiles_come_in_order_whatever_their_files_do(spark, tmp_path):
    from lakewarden.streaming import tiles

    root = tmp_path / "logs"
    put_tiles(root, "a", 5, 2, 0, 1, size=2)  # 3 and 4 are late
    put_tiles(root, "b", 1000, size=1)
    seen: list[list] = []

    def run(cap=0):
        stream = tiles.stream_tiles(spark, str(root), {"a": 0, "b": 1000}, window=2, entries=cap)
        query = stream.writeStream.foreachBatch(lambda df, _: seen.append(sorted(map(tuple, df.collect())))).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()

    run()
    assert [b for b in seen if b] == [[("a", 0), ("a", 1), ("b", 1000)], [("a", 2)]]
    put_tiles(root, "a", 4, size=2)
    run()  # 3 isn't there yet: nothing is skipped
    assert sum(map(len, seen)) == 4
    put_tiles(root, "a", 3, 6, 7, 8, 9, size=2)
    run(cap=3 * 256)  # a session takes three tiles
    run()
    flat = [t for b in seen for log, t in b if log == "a"]
    assert flat == list(range(10)) and [len([x for x in b if x[0] == "a"]) for b in seen if b][2:] == [2, 1, 2, 2]


def test_sessions_over_tiles_end_complete_caught_up_or_in_error(spark, tmp_path):
    from lakewarden.streaming import tiles

    root, archive = tmp_path / "logs", MonthArchive(spark, str(tmp_path / "archive"))
    put_tiles(root, "a", 0, 1, 2)
    put_tiles(root, "b", 0)
    runs, args = tile_runs(spark, a=0, b=0), (str(tmp_path / "state"), )
    states = tiles.ingest_tiles(str(root), archive, *args, runs, str(tmp_path / "check"), {"a": 800, "b": 300}, entries=512, window=1, beat=256, seconds=120)
    last = {r.log_id: (r.state, r.session, r.cursor) for r in tiles.latest_states(states).collect()}
    assert last == {"a": ("complete", 512, 512), "b": ("caught_up", 256, 256)}
    assert [(r.session, r.state) for r in states.where("log_id = 'a'").orderBy("at").collect()] == [(256, "running"), (512, "complete")]
    assert archive.subjects().count() == 768 and archive.subjects().select("id").distinct().count() == 768
    kept = max(int(p.name[1:]) for p in (tmp_path / "state/runs").iterdir())
    runs = spark.read.parquet(f"{tmp_path}/state/runs/v{kept}")
    assert {r.log_id: (r.next_entry_idx, r.tree_size_at_start) for r in runs.collect()} == {"a": (512, 800), "b": (256, 300)}

    class Broken(MonthArchive):
        def flush(self, pool):
            raise OSError("disk is full")

    states = tiles.ingest_tiles(str(root), Broken(spark, str(tmp_path / "archive")), *args, runs, str(tmp_path / "check"), {"a": 800, "b": 300}, window=1, seconds=120)
    last = {r.log_id: (r.state, r.cursor) for r in tiles.latest_states(states).collect()}
    assert last["a"] == ("error", 512)
    states = tiles.ingest_tiles(str(root), archive, *args, runs, str(tmp_path / "check"), {"a": 800, "b": 300}, window=1, seconds=120)  # the failed batch again
    last = {r.log_id: (r.state, r.cursor) for r in tiles.latest_states(states).collect()}
    assert last == {"a": ("caught_up", 768), "b": ("caught_up", 256)} and archive.subjects().count() == 1024
