"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cdcmart
from cdcmart.session import checkpoint_dir, released

SLICE = 256  # rows per Arrow batch that leaves a Python stage


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may have no copy of it.

    Must come before the first Python stage is planned: a stage keeps the files known then.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(cdcmart.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="cdcmart-")) / "cdcmart-package.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def empty_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def text_key(text: Column) -> Column:
    """128-bit key of a text; equal texts have equal keys, null counts as empty.

    Declared to be never null: joins then add no filters, which would make plans that
    group the same texts differ, and texts would be moved once more.
    """
    return F.coalesce(F.unhex(F.md5(empty_if_null(text))), F.lit(b""))


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read back; what was shuffled for it goes."""
    ship(frame.sparkSession)
    checkpoint_dir(frame.sparkSession, scratch=True)
    with released(frame.sparkSession):
        return frame.select("*").checkpoint()


def map_rows(
    frame: DataFrame,
    work: Callable[[dict], Iterator[tuple]] | Callable[[list[dict]], Iterator[tuple]],
    schema: str,
    slice_rows: int = SLICE,
    slice_bytes: int = 1 << 22,
    together: int = 0,
) -> DataFrame:
    """``work`` turns each input row into result rows; both leave Python in small Arrow batches.

    A batch is closed after ``slice_rows`` rows, or earlier when its strings, bytes and
    arrays reach ``slice_bytes``, so a task's memory does not follow the length of texts.
    With ``together``, ``work`` takes lists of up to so many rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(frame.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def closed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(column, type=field.type) for column, field in zip(columns, arrow, strict=True)], schema=arrow
            )

        for batch in source:
            for at in range(0, batch.num_rows, together or 64):
                part = batch.slice(at, together or 64).to_pylist()
                for given in [part] if together else part:
                    for out in work(given):
                        rows.append(out)
                        size += sum(len(x) for x in out if isinstance(x, str | bytes | list | np.ndarray))
                        if len(rows) >= slice_rows or size >= slice_bytes:
                            yield closed()
                            rows, size = [], 0
        if rows:
            yield closed()

    return frame.mapInArrow(batches, schema)


#: Keys that may be broadcast as hubs, and the rows from which a key can be one.
HEAVIEST, HEAVY = 1_000, 1_000


def heaviest(found: DataFrame) -> DataFrame | None:
    """The rows of ``found`` (with n_rows, the rows of their key elsewhere) whose keys hold a 1,000th of all rows and more.

    So they are 1,000 at most, whatever the number of rows, and no other key makes a task's share much larger. None if there are
    none: what is joined then needs no branch for them, whose broadcast the driver would build and keep.
    """
    most, every = found.agg(F.max("n_rows"), F.sum("n_rows")).first()
    least = max(HEAVY, -(-(every or 0) // HEAVIEST))
    return None if (most or 0) < least else found.where(F.col("n_rows") >= least).drop("n_rows")


def join_spread(rows: DataFrame, found: DataFrame, keys: list[str], heavy: DataFrame | None) -> DataFrame:
    """``rows`` joined with ``found``, which holds each key once: rows of the ``heaviest`` keys stay where they lie."""
    if heavy is None:
        return merged(rows, found, keys)
    hubs = F.broadcast(heavy)
    return merged(rows.join(hubs, keys, "left_anti"), found, keys).unionByName(rows.join(hubs, keys))


def merged(rows: DataFrame, found: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``found``, which holds each key once, by sorting: nothing passes through the driver, and adaptive
    execution splits the partitions of heavy keys."""
    return rows.join(found.hint("merge"), keys, how)


def components(edges: DataFrame, least: str = "a", other: str = "b") -> DataFrame:
    """Connected components: (node, root) of every node that has an edge, root the least node.

    Alternates the two star operations (each node's larger neighbours, then its smaller
    ones, move to the least node in sight), so rounds grow with the logarithm of the
    longest path. Minima are aggregated before they are joined; no neighbour list is built, and
    the pairs of hubs are not moved to be joined. What a step reads more than once is written first: one plan
    of a whole round has so many stages that the driver's memory follows the number of partitions.
    """
    pairs = edges.select(F.greatest(least, other).alias("u"), F.least(least, other).alias("v")).where("u <> v")
    pairs = cut_lineage(pairs.distinct())
    seen = None
    while True:
        upward = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))  # in all pairs v is the lesser
        both = pairs.unionByName(upward)
        low = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n_rows")))
        large = join_spread(upward, low.drop("n_rows"), ["u"], heaviest(low)).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = cut_lineage(large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        low = cut_lineage(down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n_rows")))
        moved = join_spread(down, low.drop("n_rows"), ["u"], heaviest(low)).select(F.col("v").alias("u"), F.col("m").alias("v"))
        roots = low.select("u", F.col("m").alias("v"))
        pairs = cut_lineage(moved.unionByName(roots).where("u <> v").distinct())
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


# --- polynomial hashes of byte ranges ---------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        size = max(1024, 1 << int(n + 1).bit_length())
        known = np.empty(size, np.uint64)
        known[0] = 1
        filled = 1
        while filled < size:
            step = np.uint64(pow(base, filled, 1 << 64))
            more = min(filled, size - filled)
            known[filled : filled + more] = known[:more] * step
            filled += more
        if size <= 1 << 22:
            _powers[base] = known
    return known[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for each pair; equal bytes give equal hashes."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n)[:n], out=prefix[1:])
    back = _power(_INVERSE, n)
    return mix((prefix[ends] - prefix[starts]) * back[starts])


def uniform(hashes: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((hashes >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def add_columns(
    frame: DataFrame, names: list[str], work: Callable[[list[dict]], list[tuple]], schema: str, slice_rows: int = SLICE
) -> DataFrame:
    """``frame`` with more columns, computed for small groups of rows from the columns ``names``.

    Columns of ``frame`` that are called like a new one are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    ship(frame.sparkSession)
    new = _parse_datatype_string(schema)
    kept = frame.select(*[F.col(f"`{c}`") for c in frame.columns if c not in new.fieldNames()])
    if set(names) & set(new.fieldNames()):
        raise ValueError("a new column must not be called like one it is computed from")
    arrow = to_arrow_schema(new)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                rows = part.select(names).to_pylist()
                columns = list(zip(*work(rows), strict=True))
                arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)]
                fields = [part.schema.field(i) for i in range(part.num_columns)] + list(arrow)
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], schema=pa.schema(fields))

    return kept.mapInArrow(batches, StructType(kept.schema.fields + new.fields))
