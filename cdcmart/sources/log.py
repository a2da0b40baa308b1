"""Tables out: append-only logs, retention, versioned publishing, bucketed copies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.functions.time import month_key, within_days

COMMITS = "_commits"


def write_log(log: DataFrame, path: str, time_column: str, batch_id: int) -> None:
    """One batch of an append-only log, by month, in (topic, partition, offset) order.

    Within a month every batch owns a folder, so a batch that is run again after a failure
    replaces its own files and nothing else, and a month is one folder to drop.
    """
    (
        log.withColumns({"month": month_key(F.col(time_column)), "batch_id": F.lit(batch_id)})
        .sortWithinPartitions("month", "topic", "kafka_partition", "kafka_offset")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "batch_id")
        .parquet(path)
    )


def expire(log: DataFrame, time_column: str, days: int, now: Column) -> DataFrame:
    """The events still inside the retention period.

    On a month-partitioned log whole months are skipped without being read; only the
    boundary month is filtered row by row.
    """
    kept = log.where(within_days(F.col(time_column), days, now))
    if "month" in log.columns:
        kept = kept.where(F.col("month") >= month_key(now - F.make_dt_interval(F.lit(days))))
    return kept


def drop_expired(spark: SparkSession, path: str, days: int, now: dt.datetime) -> list[int]:
    """Delete the months of a log that lie wholly before the retention period; their keys.

    Only folders go, no file is read or written anew. Readers that apply ``expire``, as they
    must for the boundary month, never look into such a folder, so they are not
    disturbed. Run again, it finds nothing.
    """
    oldest = now - dt.timedelta(days=days)
    boundary = oldest.year * 100 + oldest.month
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in system.listStatus(root) if system.exists(root) else []:
        name = status.getPath().getName()
        if name.startswith("month=") and name[6:].isdigit() and int(name[6:]) < boundary:
            system.delete(status.getPath(), True)
            dropped.append(int(name[6:]))
    return sorted(dropped)


def publish(
    frames: Mapping[str, DataFrame], path: str, batch_id: int, accept: Callable[[], None] | None = None
) -> bool:
    """Write several tables as one unit: readers see all of them or none.

    Data goes to ``<path>/<table>/batch_id=<n>``; the commit record is written last.
    A batch that is already committed is left alone, so a rerun changes nothing. ``accept`` is called
    before the commit record; if it raises, nothing becomes visible.
    """
    spark = next(iter(frames.values())).sparkSession
    if _committed(spark, path, batch_id):
        return False
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
    if accept is not None:
        accept()
    spark.range(batch_id, batch_id + 1).select(F.col("id").alias("batch_id")).write.mode("append").parquet(
        f"{path}/{COMMITS}"
    )
    return True


def read_published(spark: SparkSession, path: str, table: str, *, newest_only: bool = False) -> DataFrame:
    """The committed batches of a table; ``newest_only`` for tables replaced as a whole,
    where only the newest batch's folder is read."""
    commits = spark.read.schema("batch_id bigint").parquet(f"{path}/{COMMITS}")
    if newest_only:
        newest = commits.agg(F.max("batch_id")).first()[0]
        return spark.read.parquet(f"{path}/{table}/batch_id={newest}")
    rows = spark.read.parquet(f"{path}/{table}")
    return rows.join(commits.distinct(), "batch_id", "left_semi").drop("batch_id")


def _committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    if not _exists(spark, f"{path}/{COMMITS}"):
        return False
    commits = spark.read.schema("batch_id bigint").parquet(f"{path}/{COMMITS}")
    return not commits.where(F.col("batch_id") == batch_id).isEmpty()


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def save_bucketed(table: DataFrame, name: str, key: str, buckets: int) -> None:
    """A catalog table hashed and sorted by ``key``.

    Orders bucketed by id and lines bucketed by order id (same bucket count) join and
    allocate without moving either table again.
    """
    table.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
