"""The result cache as a table bucketed by key.

Rows lie in one file a bucket and batch, by the hash of ``cache_key``, sorted by it. So a
lookup never moves the cache:

* a few keys (``PRUNE_KEYS`` at most) become a filter on the bucketed column; only their
  buckets are read, and in these only the row groups that may hold them;
* more keys are shuffled to the buckets of the table and joined there bucket by bucket
  (a storage-partitioned join); the cache itself is not shuffled.

Each batch writes its own partition (``batch_id``), which a replay of the batch replaces.
``compact`` merges the partitions of settled batches into one, as a new version of the
whole table: a folder that counts once it is complete. A reader sees the old version or
the new one, never a mixture; the version before the current one stays until the next
compaction, for readers that still use it.
"""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift import schema as S

PRUNE_KEYS = 1000
NO_BATCH = -1                # the partition of rows that belong to no batch, or to settled ones
MANY_BATCHES = 16            # lying apart, before ``compact_if_many`` merges them
COLUMNS = [f.name for f in S.CACHE.fields]


class Version(NamedTuple):
    number: int
    buckets: int

    @property
    def folder(self) -> str:
        return f"v{self.number}_b{self.buckets}"


class KeyedCache:
    """Cache table under ``path``, a folder shared by driver and executors.

    ``buckets``: of versions written from now on; None: the session's number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # ---- versions ----------------------------------------------------------------------------------------

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, folder: str = "") -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[Version]:
        """The complete versions, oldest first."""
        names = set(self._names())
        found = [re.fullmatch(r"v(\d+)_b(\d+)", n) for n in names if f"_{n}" in names]
        return sorted(Version(int(m[1]), int(m[2])) for m in found if m)

    def _begin(self) -> Version:
        """An empty version after the last one; it counts once ``_end`` marks it."""
        versions = self.versions()
        version = Version(versions[-1].number + 1 if versions else 1, self.buckets)
        self._fs().delete(self._path(version.folder), True)         # what an interrupted run left
        self._fs().mkdirs(self._path(version.folder))
        return version

    def _end(self, version: Version) -> None:
        self._fs().create(self._path(f"_{version.folder}"), True).close()

    def _drop(self, versions: list[Version]) -> None:
        for version in versions:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(version)}")
            self._fs().delete(self._path(f"_{version.folder}"), False)
            self._fs().delete(self._path(version.folder), True)

    def _name(self, version: Version) -> str:
        return f"docsift_cache_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}_{version.folder}"

    def _table(self, version: Version) -> str:
        """The version as a bucketed table of the session's catalog, with the partitions that lie there now."""
        name = self._name(version)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.CACHE.fields)
            self.spark.sql(f"CREATE TABLE {name} ({columns}, batch_id BIGINT) USING parquet PARTITIONED BY (batch_id) "
                           f"CLUSTERED BY (cache_key) SORTED BY (cache_key) INTO {version.buckets} BUCKETS "
                           f"LOCATION '{self.path}/{version.folder}'")
        self.spark.catalog.recoverPartitions(name)
        return name

    # ---- reading -----------------------------------------------------------------------------------------

    def rows(self, but_batch: int | None = None) -> DataFrame | None:
        """All cache rows, without those of ``but_batch``; None where there is no cache yet."""
        versions = self.versions()
        if not versions:
            return None
        stored = self.spark.table(self._table(versions[-1]))
        if but_batch is not None:
            stored = stored.filter(F.col("batch_id") != but_batch)
        return stored.select(*COLUMNS)

    def rows_for(self, keys: DataFrame, but_batch: int | None = None) -> DataFrame | None:
        """The cache rows that a join on ``cache_key`` with ``keys(cache_key)``, a stored table, has to see."""
        stored = self.rows(but_batch)
        if stored is None:
            return None
        few = [r["cache_key"] for r in keys.select("cache_key").limit(PRUNE_KEYS + 1).collect()]
        return stored.filter(F.col("cache_key").isin(few)) if len(few) <= PRUNE_KEYS else stored

    def lookup(self, but_batch: int | None = None):
        """The cache as ``extract(cache=...)`` takes it; ``but_batch``: rows of that batch are not seen."""
        return lambda keys: self.rows_for(keys, but_batch)

    # ---- writing -----------------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, version: Version, batch_id: int | None = None) -> None:
        """Adds to the version, one file a bucket and batch; with ``batch_id``, in place of that batch's rows."""
        table = self._table(version)
        into = f"INTO {table}" if batch_id is None else f"OVERWRITE {table} PARTITION (batch_id = {batch_id})"
        rows = rows.select(*COLUMNS, *([] if batch_id is not None else ["batch_id"]))
        self.spark.sql(f"INSERT {into} SELECT * FROM {{rows}}", rows=rows.repartition(version.buckets, "cache_key"))

    def append(self, new_rows: DataFrame, batch_id: int = NO_BATCH) -> None:
        """Adds rows whose keys the cache lacks; a batch's rows replace those that it wrote before.

        Rows without a batch are merged with the others of that kind; where a key is stored, its row stays.
        """
        if not self.versions():
            self._end(self._begin())
        version = self.versions()[-1]
        if batch_id != NO_BATCH:
            self._write(new_rows, version, batch_id)
        elif not self._names(version.folder):
            self._write(new_rows, version, NO_BATCH)
        else:
            stored = self.spark.table(self._table(version))
            added = new_rows.join(stored.select("cache_key"), "cache_key", "left_anti")
            self._new_version(stored.unionByName(added.select(*COLUMNS, F.lit(NO_BATCH).cast("bigint").alias("batch_id"))))

    def _new_version(self, rows: DataFrame) -> None:
        older = self.versions()[:-1]
        version = self._begin()
        self._write(rows, version)
        self._end(version)
        self._drop(older)                                           # the last one may still be read

    def batches(self) -> int:
        """How many batches lie apart."""
        versions = self.versions()
        return sum(n.startswith("batch_id=") for n in self._names(versions[-1].folder)) if versions else 0

    def compact(self, before_batch: int) -> None:
        """Merges the rows of all batches before ``before_batch``; none of them may run again."""
        if versions := self.versions():
            settled = F.when(F.col("batch_id") < before_batch, F.lit(NO_BATCH)).otherwise(F.col("batch_id"))
            stored = self.spark.table(self._table(versions[-1]))
            self._new_version(stored.withColumn("batch_id", settled.cast("bigint")))

    def compact_if_many(self, before_batch: int) -> None:
        if self.batches() > MANY_BATCHES:
            self.compact(before_batch)

    def clear(self) -> None:
        """An empty cache, as a new version."""
        older = self.versions()
        self._end(self._begin())
        self._drop(older)
