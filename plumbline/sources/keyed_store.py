"""Records by key: reading one reads its bucket only, and compaction is swapped in at once.

Every write is a folder of its own (so that writers share nothing), parted by a hash of the key. A
read of one key lists and reads one bucket of each folder. ``compact`` writes the newest version of each
living record as a base, then appends a pointer that names the base and the writes it took in; readers
follow the newest pointer, so they see either the old base with all writes, or the new one with the
writes since, never both. What a base has taken in is removed by ``drop_taken`` once no reader needs it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.functions.columns import ref
from plumbline.sources.readers import read_path
from plumbline.sources.records import EXPIRY_DAYS, WRITE, append_record, expire, latest_by_key

BUCKET, BUCKETS = "key_bucket", 64


class KeyedStore:
    """Versions of records in a folder, found by ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets

    def bucket(self, *values: Column) -> Column:
        """The bucket of a key, the same whatever the type it is given in."""
        return F.pmod(F.xxhash64(*[v.cast("string") for v in values]), F.lit(self.buckets)).cast("int")

    def append(self, records: DataFrame, written_at: datetime | None = None) -> None:
        """Adds a version of one or more records."""
        named = records.withColumn(BUCKET, self.bucket(*map(ref, self.key)))
        append_record(named, f"{self.path}/writes", written_at, [BUCKET])

    def _pointer(self):
        pointers = read_path(self.spark, f"{self.path}/pointers")
        return None if pointers is None else pointers.orderBy(F.desc("number"), "id").first()

    def _versions(self, pointer, pruned: Column | None = None, only: Sequence[str] | None = None) -> DataFrame | None:
        """All versions that a reader of this pointer sees; of some buckets, or of the base and some writes only."""
        base = read_path(self.spark, pointer["base"]) if pointer else None
        writes = read_path(self.spark, f"{self.path}/writes")
        if writes is not None:
            if only is not None:
                writes = writes.where(F.col(WRITE).isin(list(only)))
            elif pointer:
                writes = writes.where(~F.col(WRITE).isin(list(pointer["taken"])))
            writes = (writes if pruned is None else writes.where(pruned)).drop(WRITE)
        if base is not None and pruned is not None:
            base = base.where(pruned)
        if base is None or writes is None:
            return base if writes is None else writes
        return base.unionByName(writes, allowMissingColumns=True)

    def read(self) -> DataFrame | None:
        """All versions of all records; None when nothing has been written."""
        versions = self._versions(self._pointer())
        return None if versions is None else versions.drop(BUCKET)

    def newest(self) -> DataFrame | None:
        """The newest version of every record."""
        versions = self.read()
        return None if versions is None else latest_by_key(versions, self.key)

    def get(self, *values: object) -> DataFrame | None:
        """The newest version of one record: one bucket is read."""
        number = self.spark.range(0, 1, 1, 1).select(self.bucket(*map(F.lit, values))).first()[0]
        versions = self._versions(self._pointer(), F.col(BUCKET) == number)
        if versions is None:
            return None
        for name, value in zip(self.key, values):
            versions = versions.where(ref(name).eqNullSafe(F.lit(value)))
        return latest_by_key(versions.drop(BUCKET), self.key)

    def compact(self, as_of: Column | datetime | None = None, days: int = EXPIRY_DAYS) -> None:
        """Takes all writes so far into a new base, the newest version of each record that still lives."""
        pointer = self._pointer()
        writes = read_path(self.spark, f"{self.path}/writes")
        if writes is None:
            return
        before = set(pointer["taken"]) if pointer else set()
        new = {r[0] for r in writes.select(WRITE).distinct().collect()} - before  # a row per write
        versions = self._versions(pointer, only=sorted(new))
        living = expire(versions, F.current_timestamp() if as_of is None else as_of, days)
        newest = latest_by_key(living, [*self.key, BUCKET])
        self._swap_in(newest, self.path, pointer["number"] + 1 if pointer else 1, sorted(before | new))

    def _swap_in(self, versions: DataFrame, path: str, number: int, taken: list[str]) -> None:
        base = f"{path}/bases/{uuid.uuid4().hex}"
        versions.repartition(BUCKET).write.partitionBy(BUCKET).parquet(base)
        pointer = self.spark.createDataFrame([(number, base, taken)], "number bigint, base string, taken array<string>")
        pointer.coalesce(1).write.parquet(f"{path}/pointers/id=p-{uuid.uuid4().hex}")

    def copy_to(self, path: str, as_of: Column | datetime | None = None, days: int = EXPIRY_DAYS) -> None:
        """Writes all versions still alive to a new store."""
        versions = self._versions(self._pointer())
        if versions is not None:
            self._swap_in(expire(versions, F.current_timestamp() if as_of is None else as_of, days), path, 1, [])

    def drop_taken(self) -> int:
        """Removes the writes that the newest base has taken in, and older bases; their readers must be done."""
        pointer = self._pointer()
        if not pointer:
            return 0
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        gone = 0

        def drop(folder: str, keep) -> None:
            nonlocal gone
            place = jvm.org.apache.hadoop.fs.Path(folder)
            files = place.getFileSystem(conf)
            for status in files.listStatus(place) if files.exists(place) else []:
                if not keep(status.getPath().getName()):
                    gone += bool(files.delete(status.getPath(), True))

        taken = {f"{WRITE}={t}" for t in pointer["taken"]}
        drop(f"{self.path}/writes", lambda name: name not in taken)
        own = pointer["base"].rsplit("/", 1)[-1]
        drop(f"{self.path}/bases", lambda name: name == own)
        return gone
