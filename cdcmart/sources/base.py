"""Keyed tables kept in hash buckets and merged incrementally.

A store is a folder of immutable Parquet files and a manifest per version, a small text that names for
every bucket (``slot``) the folder that holds it and appears as a whole. A merge joins the incoming rows with the
buckets that they fall into, writes those buckets anew and commits a manifest; all other
buckets keep their files. Readers of an older version are not disturbed, since no file is
changed or removed before ``drop_unreferenced``.

The table that a version is read through is declared as bucketed, so a join or an aggregation by the
bucket's columns moves none of the stored rows, and ``slot`` prunes folders.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.operators.state import current_state
from cdcmart.session import released

_ADDED_AT_ONCE = 1000
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

#: From a full outer join of a stored row ``old`` and an incoming one ``new``, either of which may
#: be missing, to the columns of the merged row.
Resolve = Callable[[list[str], Column], list[Column]]


def newest_wins(version: str | Sequence[str] = "_version") -> Resolve:
    """The row of the higher version; equal versions are the same change, delivered again."""
    names = [version] if isinstance(version, str) else list(version)

    def resolve(columns: list[str], stored: Column) -> list[Column]:
        order = [F.struct(*[F.col(f"{side}.{name}") for name in names]) for side in ("old", "new")]
        keeps = stored & (F.col("new._present").isNull() | (order[0] >= order[1]))
        return [F.when(keeps, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in columns]

    return resolve


def added(sums: Sequence[str]) -> Resolve:
    """Sums of both rows; the other columns are the same in both."""

    def resolve(columns: list[str], stored: Column) -> list[Column]:
        found = []
        for c in columns:
            old, new = F.col(f"old.{c}"), F.col(f"new.{c}")
            value = F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0)) if c in sums else F.when(stored, old).otherwise(new)
            found.append(value.alias(c))
        return found

    return resolve


class Store:
    """A keyed table at ``path``: at most one row per ``keys``, in ``buckets`` by hash of ``by``.

    ``by`` (default: the keys) are some of the keys and must not be null. Rows that are looked for by another column than
    their own id, like lines by their order, are kept by that column; it must then never change for an id.
    With fewer buckets than ``spark.sql.shuffle.partitions`` Spark moves the stored rows all the same.
    Versions are numbered by the batch that made them.
    """

    def __init__(self, spark: SparkSession, path: str, *, buckets: int, keys: Sequence[str] = ("id",), by: Sequence[str] | None = None):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.keys, self.by = list(keys), list(by or keys)
        self._manifests: dict[int, tuple[dict[int, str], T.StructType]] = {}
        if not set(self.by) <= set(self.keys):
            raise ValueError("rows are bucketed by some of their keys")

    # versions

    def _hadoop(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _names(self, path: str) -> list[str]:
        system, target = self._hadoop(path)
        return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []

    def versions(self) -> list[int]:
        return sorted(int(name[:-5]) for name in self._names("manifests") if name.endswith(".json"))

    def manifest(self, version: int) -> dict[int, str]:
        """Folder of each bucket that has rows; there are at most ``buckets``."""
        if version not in self._manifests:
            system, target = self._hadoop(f"manifests/{version}.json")
            stream = system.open(target)
            told = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
            folders = {slot: folder for folder, slots in told["folders"].items() for slot in slots}
            self._manifests[version] = folders, T.StructType.fromJson(told["schema"])
        return self._manifests[version][0]

    def schema(self, version: int) -> T.StructType:
        self.manifest(version)
        return self._manifests[version][1]

    def _pick(self, upto: int | None, before: int | None) -> int | None:
        found = [v for v in self.versions() if (upto is None or v <= upto) and (before is None or v < before)]
        return found[-1] if found else None

    def slot(self) -> Column:
        """The bucket of a row, as Spark's bucketed writer numbers it."""
        return F.pmod(F.hash(*self.by), F.lit(self.buckets))

    def slots_of(self, rows: DataFrame, by: Sequence[str] | None = None) -> list[int]:
        """Buckets that rows with the columns ``by`` fall into."""
        renamed = rows.select(*[F.col(theirs).alias(ours) for theirs, ours in zip(by or self.by, self.by, strict=True)])
        with released(self.spark):
            return [row[0] for row in renamed.select(self.slot()).distinct().collect()]

    def exists(self, *, upto: int | None = None, before: int | None = None) -> bool:
        return self._pick(upto, before) is not None

    # reading

    def read(self, *, upto: int | None = None, before: int | None = None, slots: Iterable[int] | None = None) -> DataFrame:
        """Rows of a version (default: the newest), of all buckets or of some."""
        version = self._pick(upto, before)
        if version is None:
            raise ValueError(f"nothing is stored in {self.path}")
        rows = self.spark.table(self._declared(version))
        if slots is not None:
            rows = rows.where(F.col("slot").isin(sorted(slots)))
        return rows.drop("slot")

    def _name(self, version: int) -> str:
        return f"store_{hashlib.md5(self.path.encode()).hexdigest()[:16]}_{version}"

    def _declared(self, version: int) -> str:
        """The catalog table of a version: external, bucketed, a partition per bucket."""
        name = self._name(version)
        if self.spark.catalog.tableExists(name):
            return name
        folders = self.manifest(version)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(version))
        by = ", ".join(f"`{c}`" for c in self.by)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, slot INT) USING parquet PARTITIONED BY (slot) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/declared'"
        )
        parts = [f"PARTITION (slot={slot}) LOCATION '{self.path}/{folder}/slot={slot}'" for slot, folder in sorted(folders.items())]
        for at in range(0, len(parts), _ADDED_AT_ONCE):
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts[at : at + _ADDED_AT_ONCE])}")
        return name

    # writing

    def _write(self, rows: DataFrame) -> str:
        """Files of rows that lie by bucket already; the folder."""
        folder = f"files/{uuid.uuid4().hex}"
        name = f"store_{folder[6:]}"
        writer = rows.withColumn("slot", self.slot()).write.format("parquet").option("compression", "zstd").partitionBy("slot")
        with released(self.spark):
            writer.bucketBy(self.buckets, *self.by).sortBy(*self.by).option("path", f"{self.path}/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # its files stay
        return folder

    def _commit(self, batch_id: int, folders: dict[int, str], schema: T.StructType) -> None:
        slots: dict[str, list[int]] = {}
        for slot, folder in sorted(folders.items()):
            slots.setdefault(folder, []).append(slot)
        system, written = self._hadoop(f"manifests/{uuid.uuid4().hex}.part")
        stream = system.create(written, False)
        stream.write(bytearray(json.dumps({"schema": schema.jsonValue(), "folders": slots}).encode()))
        stream.close()
        system.rename(written, self._hadoop(f"manifests/{batch_id}.json")[1])

    def _written(self, folder: str) -> list[int]:
        return [int(name[5:]) for name in self._names(folder) if name.startswith("slot=")]

    def create(self, rows: DataFrame, batch_id: int = 0) -> bool:
        """The first version, from rows with one row per key; False if the batch is there."""
        if batch_id in self.versions():
            return False
        folder = self._write(rows.repartition(self.buckets, *self.by))
        self._commit(batch_id, dict.fromkeys(self._written(folder), folder), rows.schema)
        return True

    def merge(self, rows: DataFrame, batch_id: int, resolve: Resolve, keep: Column | None = None) -> bool:
        """A new version with ``rows`` (one per key) merged in; False if the batch is there. ``rows`` are computed twice.

        Only buckets that a row falls into are read and written. Stored rows are not moved: the
        incoming ones come to them, and a task writes the bucket that it has read. Merged rows
        for which ``keep`` does not hold are left out.
        """
        if batch_id in self.versions():
            return False
        version = self._pick(None, batch_id)
        if version is None:
            return self.create(rows if keep is None else rows.where(keep), batch_id)
        folders = self.manifest(version)
        touched = self.slots_of(rows)
        if touched:
            merged = self._joined(self.read(upto=version, slots=touched), rows, resolve)
            with self._in_place():
                folder = self._write(merged if keep is None else merged.where(keep))
            folders = {slot: name for slot, name in folders.items() if slot not in set(touched)}
            folders |= dict.fromkeys(self._written(folder), folder)
        self._commit(batch_id, folders, self.schema(version))
        return True

    @contextmanager
    def _in_place(self) -> Iterator[None]:
        """While a join is run: rows that lie by some of its keys (``by``) are not moved to lie by all of them."""
        before = self.spark.conf.get(_ALL_KEYS)
        self.spark.conf.set(_ALL_KEYS, "false")
        try:
            yield
        finally:
            self.spark.conf.set(_ALL_KEYS, before)

    def _joined(self, stored: DataFrame, rows: DataFrame, resolve: Resolve) -> DataFrame:
        columns = stored.columns
        old = stored.withColumn("_present", F.lit(True)).alias("old")
        new = rows.select(*columns).withColumn("_present", F.lit(True)).hint("merge").alias("new")
        on = [F.col(f"old.{key}") == F.col(f"new.{key}") for key in self.keys]
        merged = old.join(new, on, "full_outer").select(*resolve(columns, F.col("old._present").isNotNull()))
        return merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema])

    def merge_changes(self, changes: DataFrame, batch_id: int, version: str | Sequence[str] = "_version") -> bool:
        """Incremental compaction: the newest change per key meets the stored row of its key.

        Tombstones stay, so a change that comes late cannot bring a deleted row back.
        """
        newest = current_state(changes, self.keys, version, include_deleted=True)
        return self.merge(newest, batch_id, newest_wins(version))

    # housekeeping

    def drop_unreferenced(self, keep: int, before: dt.datetime) -> list[str]:
        """Delete folders that none of the newest ``keep`` versions names and that were written
        ``before`` (a merge that runs now has not committed its folder yet)."""
        named = {folder for version in self.versions()[-keep:] for folder in self.manifest(version).values()}
        system, root = self._hadoop("files")
        dropped = []
        for status in system.listStatus(root) if system.exists(root) else []:
            folder = f"files/{status.getPath().getName()}"
            if folder not in named and status.getModificationTime() < before.timestamp() * 1000:
                system.delete(status.getPath(), True)
                dropped.append(folder)
        return sorted(dropped)

    def discard(self) -> None:
        """Forget all versions and delete the files: for stores of one run."""
        for version in self.versions():
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(version)}")
        system, root = self._hadoop(".")
        system.delete(root.getParent() if root.getName() == "." else root, True)
