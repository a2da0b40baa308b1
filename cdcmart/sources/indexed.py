"""An append-only log whose files are found by offset and time.

A batch is laid out in ranges of (topic, partition, offset), so a file holds one stretch of few topics, however
uneven topics are. Beside the files lies an index, itself a table: for each file and topic partition the first and last
offset, the oldest and newest time and the number of rows. A replay from an offset opens only the files that reach it.

A version of the log is a manifest, a small text that names the parts of the index and appears as a whole.
Retention drops files that lie wholly before the limit without reading them, writes anew those that cross it, and
commits a manifest. Files are never changed, so a reader that has begun keeps its version whole until
``drop_unreferenced``. One writer at a time; batch numbers rise.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions.time import within_days

PLACE = ["topic", "kafka_partition", "kafka_offset"]
_INDEX = (
    "path string, topic string, kafka_partition int, first_offset bigint, last_offset bigint, "
    "oldest timestamp, newest timestamp, undated bigint, n_rows bigint"
)


class IndexedLog:
    """The log at ``path``; ``time`` is the column by which it expires.

    Batches have the columns ``topic``, ``kafka_partition``, ``kafka_offset`` and ``time`` and any others. A null topic,
    partition or offset is kept and read back, but no replay of a topic finds it. Rows without a time expire at once.
    """

    def __init__(self, spark: SparkSession, path: str, time: str = "ingested_at"):
        self.spark, self.path, self.time = spark, path.rstrip("/"), time

    # versions

    def _hadoop(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _names(self, path: str) -> list[str]:
        system, target = self._hadoop(path)
        return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []

    def versions(self) -> list[int]:
        return sorted(int(name[:-5]) for name in self._names("manifests") if name.endswith(".json"))

    def _manifest(self, version: int | None = None) -> dict:
        found = self.versions()
        if version is None:
            if not found:
                return {"version": -1, "batch": -1, "index": [], "schema": None}
            version = found[-1]
        system, target = self._hadoop(f"manifests/{version}.json")
        stream = system.open(target)
        told = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        return told

    def _commit(self, manifest: dict) -> int:
        version = manifest["version"] + 1
        system, written = self._hadoop(f"manifests/{uuid.uuid4().hex}.part")
        stream = system.create(written, False)
        stream.write(bytearray(json.dumps(manifest | {"version": version}).encode()))
        stream.close()
        system.rename(written, self._hadoop(f"manifests/{version}.json")[1])
        return version

    # writing

    def _write(self, rows: DataFrame) -> DataFrame:
        """Index of the files that hold ``rows``, read back from their key and time columns."""
        folder = f"files/{uuid.uuid4().hex}"
        rows.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE).write.parquet(f"{self.path}/{folder}")
        at = F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name")).alias("path")
        told = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}").select(at, *PLACE, F.col(self.time).alias("time"))
        bounds = told.groupBy("path", *PLACE[:2]).agg(
            F.min("kafka_offset").alias("first_offset"),
            F.max("kafka_offset").alias("last_offset"),
            F.min("time").alias("oldest"),
            F.max("time").alias("newest"),
            F.count_if(F.col("time").isNull()).alias("undated"),
            F.count("*").alias("n_rows"),
        )
        return bounds.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(_INDEX)])

    def _save_index(self, index: DataFrame) -> str:
        part = f"index/{uuid.uuid4().hex}"
        index.write.parquet(f"{self.path}/{part}")
        return part

    def append(self, rows: DataFrame, batch_id: int) -> bool:
        """Add a batch; False if it is there already. ``rows`` are computed twice, once for the bounds of the ranges."""
        told = self._manifest()
        if batch_id <= told["batch"]:
            return False
        schema = told["schema"] or rows.schema.jsonValue()
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromJson(schema)])
        part = self._save_index(self._write(rows))
        self._commit(told | {"batch": batch_id, "schema": schema, "index": [*told["index"], part]})
        return True

    # reading

    def index(self, version: int | None = None) -> DataFrame:
        """A row per file and topic partition."""
        parts = [f"{self.path}/{part}" for part in self._manifest(version)["index"]]
        reader = self.spark.read.schema(_INDEX)
        return reader.parquet(*parts) if parts else self.spark.createDataFrame([], _INDEX)

    def _open(self, files: DataFrame, version: int | None) -> DataFrame:
        """Rows of the listed files. As with any scan, their names (not their rows) pass the driver."""
        schema = self._manifest(version)["schema"]
        if schema is None:
            raise ValueError(f"nothing is stored in {self.path}")
        paths = [f"{self.path}/{row.path}" for row in files.select("path").distinct().collect()]
        fields = T.StructType.fromJson(schema)
        return self.spark.read.schema(fields).parquet(*paths) if paths else self.spark.createDataFrame([], fields)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version (default: the newest)."""
        return self._open(self.index(version), version)

    def replay(self, topic: str, partition: int, since: int, until: int | None = None, version: int | None = None) -> DataFrame:
        """Events of a topic partition from offset ``since`` on, before ``until``; other files are not opened."""
        own = (F.col("topic") == topic) & (F.col("kafka_partition") == partition)
        files = self.index(version).where(own & (F.col("last_offset") >= since))
        rows = own & (F.col("kafka_offset") >= since)
        if until is not None:
            files, rows = files.where(F.col("first_offset") < until), rows & (F.col("kafka_offset") < until)
        return self._open(files, version).where(rows)

    def during(self, since: dt.datetime, until: dt.datetime, topics: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """Events of ``since`` <= time < ``until``, of all topics or some."""
        files = self.index(version).where((F.col("newest") >= F.lit(since)) & (F.col("oldest") < F.lit(until)))
        rows = (F.col(self.time) >= F.lit(since)) & (F.col(self.time) < F.lit(until))
        if topics is not None:
            files, rows = files.where(F.col("topic").isin(*topics)), rows & F.col("topic").isin(*topics)
        return self._open(files, version).where(rows)

    # retention

    def expire(self, days: int, now: dt.datetime) -> int | None:
        """Only events not older than ``days`` stay; the new version, or None if nothing expires.

        Files wholly inside the period keep their names, those wholly before it are left out unread.
        """
        told = self._manifest()

        def inside(name: str) -> Column:
            return F.coalesce(within_days(F.col(name), days, F.lit(now)), F.lit(False))

        files = self.index().groupBy("path").agg(F.min("oldest").alias("oldest"), F.max("newest").alias("newest"), F.sum("undated").alias("undated"))
        state = F.when(~inside("newest"), "gone").when(inside("oldest") & (F.col("undated") == 0), "kept").otherwise("cut")
        files = files.select("path", state.alias("state"))
        if files.where("state <> 'kept'").isEmpty():
            return None
        index = self.index().join(files.where("state = 'kept'"), "path", "left_semi")
        cut = files.where("state = 'cut'")
        if not cut.isEmpty():
            index = index.unionByName(self._write(self._open(cut, None).where(inside(self.time))))
        return self._commit(told | {"index": [self._save_index(index)]})

    def drop_unreferenced(self, keep: int, before: dt.datetime) -> int:
        """Delete folders of files and index parts that none of the newest ``keep`` versions names and that were written
        ``before`` (a batch being written has no manifest yet); how many. A folder goes when its last file has."""
        kept = self.versions()[-keep:]
        named = {part for version in kept for part in self._manifest(version)["index"]}
        for version in kept:
            folders = self.index(version).select(F.substring_index("path", "/", 2).alias("folder")).distinct()
            named |= {row.folder for row in folders.collect()}
        dropped = 0
        for kind in ("files", "index"):
            system, root = self._hadoop(kind)
            for status in system.listStatus(root) if system.exists(root) else []:
                if f"{kind}/{status.getPath().getName()}" not in named and status.getModificationTime() < before.timestamp() * 1000:
                    system.delete(status.getPath(), True)
                    dropped += 1
        return dropped

    def discard(self) -> None:
        """Delete everything: for logs of one run."""
        system, root = self._hadoop("files")
        system.delete(root.getParent(), True)
