"""Deduplication and incremental upkeep of month partitions: first wins, appends are idempotent, seals compact."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.certs import cert_month, dedup_key
from ..session import drop_path, list_names, path_exists, put_if_absent, read_text


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`; rows with a null key all stay.

    The choice is an aggregate, min_by over a struct, so that rows of a hot key are combined before the shuffle.
    """
    there = F.lit(True)
    for k in keys:
        there &= F.col(k).isNotNull()
    whole = F.struct(*rows.columns)
    first = rows.where(there).groupBy(*keys).agg(F.min_by(whole, F.struct(*order)).alias("own_row")).select("own_row.*")
    return first.unionByName(rows.where(~there))


def unseen(incoming: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in seen; null keys bypass the set."""
    return incoming.join(seen.select(key), key, "left_anti")


def flush(archive_keys: DataFrame, pool: DataFrame, key: str = "cert_hash", order: tuple[str, ...] = ("id",)) -> DataFrame:
    """Rows of a pool that an archive lacks, each key once and its first row: what an append-only flush writes."""
    return unseen(keep_first(pool, [key], list(order)), archive_keys, key)


def merge_first(existing: DataFrame, incoming: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Union by key where existing rows win over incoming ones, and earlier over later."""
    both = existing.withColumn("own_rank", F.lit(0)).unionByName(incoming.withColumn("own_rank", F.lit(1)))
    return keep_first(both, [key] if isinstance(key, str) else key, ["own_rank", *order]).drop("own_rank")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that more than one row has."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def upsert_ids(known: DataFrame, incoming: DataFrame, key: str = "fingerprint", id_column: str = "ca_id") -> DataFrame:
    """known, and the new keys of incoming with ids that follow the greatest known one in order of key.

    Ids never change once given. Keys must be hashes in hex, which is checked: then their first three characters cut
    them into even buckets of the same order; each bucket is numbered by itself and only the buckets' counts, at most
    4096, meet in one task.
    """
    fresh = incoming.where(F.col(key).isNotNull()).join(known.select(key), key, "left_anti").dropDuplicates([key])
    hexed = F.when(F.col(key).rlike("^[0-9a-fA-F]{8,}$"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("not a hash in hex: "), F.col(key))))
    cut = fresh.withColumn("own_part", F.substring(hexed, 1, 3))
    numbered = cut.withColumn("own_at", F.row_number().over(Window.partitionBy("own_part").orderBy(key)))
    sizes = cut.groupBy("own_part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("own_before", F.coalesce(F.sum("n").over(Window.orderBy("own_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    last = known.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long").alias("own_last"))
    out = numbered.join(before, "own_part").join(F.broadcast(last))  # one row
    out = out.withColumn(id_column, (F.col("own_last") + F.col("own_before") + F.col("own_at")).cast("long"))
    return known.unionByName(out.select(*known.columns))


def remap(rows: DataFrame, mapping: DataFrame, keys: list[str], old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a mapped id in place of their local one, and the number of rows that no mapping has."""
    on = [*keys, old]
    kept = rows.join(mapping.select(*on, new), on).drop(old).withColumnRenamed(new, old).select(*rows.columns)
    return kept, rows.join(mapping.select(*on), on, "left_anti").agg(F.count("*").alias("skipped"))


class MonthArchive:
    """A deduplicated archive of subjects in month partitions, with the keys seen, as versions of one manifest.

    Writers put files of a batch aside and then name them in the next version, which is made only if nobody else has made
    it: what a failed writer leaves is in no version, and a writer that comes second begins again on what the first has
    added. A reader holds to the version it began with; files of old versions stay until vacuum().
    """

    TABLES = ("subjects", "keys")

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.path}/manifest")
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json") and n[1:-5].isdigit())

    def manifest(self, version: int | None = None) -> tuple[int, dict[str, dict[str, list[str]]]]:
        """Number of a version, of the current one without a number, and its batches by table and month; 0 is empty."""
        version = max(self.versions(), default=0) if version is None else version
        return version, json.loads(read_text(self.spark, f"{self.path}/manifest/v{version}.json")) if version else {t: {} for t in self.TABLES}

    def _commit(self, version: int, batches: dict) -> bool:
        """Make the version after `version`, unless it has been made."""
        return put_if_absent(self.spark, f"{self.path}/manifest/v{version + 1}.json", json.dumps(batches, sort_keys=True))

    def of_months(self, name: str, months: list[str] | None = None, version: int | None = None) -> DataFrame | None:
        """The stored rows of some months, or of all; folders of other months aren't even listed."""
        batches = self.manifest(version)[1][name]
        paths = [f"{self.path}/{name}/batch={b}/cert_month={m}" for m in sorted(batches if months is None else set(months) & set(batches)) for b in batches[m]]
        return self.spark.read.option("basePath", f"{self.path}/{name}").parquet(*paths).drop("batch").withColumn("cert_month", F.col("cert_month").cast("string")) if paths else None

    def subjects(self, version: int | None = None) -> DataFrame | None:
        return self.of_months("subjects", version=version)

    def seen(self, version: int | None = None) -> DataFrame | None:
        return self.of_months("keys", version=version)

    @staticmethod
    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("cert_month", cert_month(F.col("not_before"))).withColumn("key", dedup_key(F.col("cert_hash"), F.col("tile_idx"), F.col("entry_idx")))

    def refused(self) -> DataFrame | None:
        """Rows that came without any key, each of them once."""
        return self.spark.read.parquet(f"{self.path}/refused").distinct() if path_exists(self.spark, f"{self.path}/refused") else None

    def flush(self, pool: DataFrame) -> int:
        """Add the pool's new rows month by month with their keys; a repeated flush adds nothing.

        Only the months of the pool are read. Rows without any key would be added again by a repeat: they go to
        `refused/`, and their number is returned.
        """
        rows = self.keyed(pool).persist()
        try:
            found = rows.groupBy("cert_month").agg(F.count("key").alias("keyed"), F.count("*").alias("n")).collect()  # a pool has few months
            refused = sum(r.n - r.keyed for r in found)
            if refused:
                rows.where("key is null").drop("key").write.mode("append").partitionBy("cert_month").parquet(f"{self.path}/refused")
            months = sorted(r.cert_month for r in found if r.keyed)
            if months:
                self._retried(lambda version, batches: self._added(rows.where("key is not null"), months, version, batches))
            return refused
        finally:
            rows.unpersist()

    def _retried(self, change) -> None:
        """Make a change of the current version; if another writer is first, drop what was written and begin again."""
        while True:
            version, batches = self.manifest()
            batch = change(version, batches)
            if batch is None or self._commit(version, batches):
                return
            for t in self.TABLES:
                drop_path(self.spark, f"{self.path}/{t}/batch={batch}")

    def _write(self, name: str, batch: str, rows: DataFrame) -> list[str]:
        """Months that the rows of a batch turn out to have."""
        path = f"{self.path}/{name}/batch={batch}"
        rows.write.partitionBy("cert_month").parquet(path)
        return [unquote(n.removeprefix("cert_month=")) for n in list_names(self.spark, path) if n.startswith("cert_month=")]

    def _added(self, rows: DataFrame, months: list[str], version: int, batches: dict) -> str | None:
        on, batch = ["cert_month", "key"], uuid.uuid4().hex
        seen = self.of_months("keys", months, version)
        fresh = keep_first(rows, on, ["id"])
        if seen is not None:
            fresh = fresh.join(seen, on, "left_anti")
        there = self._write("subjects", batch, fresh)
        if not there:
            drop_path(self.spark, f"{self.path}/subjects/batch={batch}")
            return None
        own = self.spark.read.parquet(f"{self.path}/subjects/batch={batch}")
        self._write("keys", batch, own.select(F.col("cert_month").cast("string"), "key"))
        for t in self.TABLES:
            for m in there:
                batches[t].setdefault(m, []).append(batch)
        return batch

    def _replaced(self, months: list[str], make) -> None:
        """Give some months anew what make(rows of a version) says, in order of name, all of them at once."""

        def change(version: int, batches: dict) -> str | None:
            batch, rows = uuid.uuid4().hex, make(version)
            if rows is None:
                return None
            there = self._write("subjects", batch, rows.repartitionByRange("cert_month", "common_name", "id").sortWithinPartitions("cert_month", "common_name", "id"))
            self._write("keys", batch, self.spark.read.parquet(f"{self.path}/subjects/batch={batch}").select(F.col("cert_month").cast("string"), "key"))
            for t in self.TABLES:
                batches[t] |= {m: [batch] for m in there}
            return batch

        self._retried(change)

    def seal(self, months: list[str]) -> None:
        """Compact some months to one batch, duplicate keys to the lowest id, each month in order of name."""
        there = self.manifest()[1]["subjects"]
        months = [m for m in months if m in there]
        if months:
            self._replaced(months, lambda version: keep_first(self.of_months("subjects", months, version), ["cert_month", "key"], ["id"]))

    def rebuild(self, incoming: DataFrame) -> None:
        """Merge rows into their months from the ground up: what is stored wins, then the lowest id; all months at once."""
        rows = self.keyed(incoming).where("key is not null")
        months = sorted(r.cert_month for r in rows.select("cert_month").distinct().collect())  # a pool has few months

        def make(version: int) -> DataFrame | None:
            stored = self.of_months("subjects", months, version)
            return merge_first(rows.limit(0) if stored is None else stored.select(*rows.columns), rows, ["cert_month", "key"], ["id"])

        if months:
            self._replaced(months, make)

    def vacuum(self, keep: int = 2) -> int:
        """Delete batches that none of the last `keep` versions names, and older versions; the number of batches.

        To be run while nobody writes: a batch that is being written is in no version yet.
        """
        versions = self.versions()
        kept = {b for v in versions[-keep:] for t in self.TABLES for own in self.manifest(v)[1][t].values() for b in own}
        gone = {n.removeprefix("batch=") for t in self.TABLES for n in list_names(self.spark, f"{self.path}/{t}") if n.startswith("batch=")} - kept
        for b in gone:
            for t in self.TABLES:
                drop_path(self.spark, f"{self.path}/{t}/batch={b}")
        for v in versions[:-keep]:
            drop_path(self.spark, f"{self.path}/manifest/v{v}.json")
        return len(gone)


def new_in_ledger(incoming: DataFrame, ledger: DataFrame, key: str = "domain", order: tuple[str, ...] = ("fetched_at",)) -> DataFrame:
    """Ledger rows to add: each key once, none that the ledger has; records are written for these alone."""
    return flush(ledger, incoming, key, order)
