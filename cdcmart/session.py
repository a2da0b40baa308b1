"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings: all can be changed on a session somebody else created.
#  * UTC session zone: business dates are derived from UTC instants.
#  * ANSI: an overflowing money column must fail, not turn into NULL.
#  * Duplicate JSON keys: legal JSON, must not be mistaken for a broken payload.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# The versions in a scan task's part of a change table are sorted by key before they move. Of 8 MB of Parquet
# (half a million to a million lines, several versions each) that fits a task's memory, of Spark's 128 MB it does not and is spilled.
SCAN_PART = "spark.sql.files.maxPartitionBytes"
SCAN_BYTES = 8 << 20


# Known from Spark 4.1 on; other versions take no notice of it.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def size_bytes(text: str) -> int:
    """A size setting such as 128m or 134217728b."""
    text = text.lower().rstrip("b")
    return int(text.rstrip("kmg")) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session. Smaller scan parts than ours are left."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    if size_bytes(spark.conf.get(SCAN_PART)) > SCAN_BYTES:
        spark.conf.set(SCAN_PART, str(SCAN_BYTES))
    return spark


def build_session(app: str = "cdcmart", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session. Cluster sizing (executors, memory) stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession, *, scratch: bool = False) -> str:
    """The shared checkpoint folder named by the cluster.

    A folder that is not named is refused: a stream that is started again would not find its
    progress. Only for data of one run (``scratch``) does a session on one machine get a
    folder of its own.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if not path:
        one_machine = context.master == "local" or context.master.startswith("local[")
        if not (scratch and one_machine):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="cdcmart-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of frames that are made or written herein go as soon as what is run on them has ended.

    Otherwise they stay until the driver happens to collect its garbage, so a job of many steps keeps those of all.
    """
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of this run."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
