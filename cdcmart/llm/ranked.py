"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are indexed in blocks. A block is a grid with a row per distinct term, the frequent
terms first, and a column per document; a point of the grid is a term's impact in a document. The
grid is halved in both directions again and again (in the longer one alone until both are equal), and the
cells that hold a point form a tree: a byte of child bits per cell, and per cell the maximum
of its impacts, stored as the difference from the cell above. The levels are compressed.

A search follows one path per term of an item: the cells that hold the term's row. All the paths of
an item descend together over ranges of documents. A range's bound is the sum over terms of weight times the
cell's maximum; ranges are taken best first, in small groups, until no bound reaches the
k-th score found. The last cells are single points, so there the bound is the score. Scores
from a few blocks are a lower bound to begin with everywhere.

Terms are told apart by 64-bit hashes of their bytes: among 100 million distinct terms two
share a hash with a chance of 3 in 10,000, and one of a thousand searched terms with one of the others
with a chance of 1 in 100 million.

Null texts and texts without a term are in no grid and are never found; items without a
term find nothing. Keys must be integers; a null key is a key like any other and sorts first. Repeated rows
are documents of their own. Extra columns are set aside. A text of any length is indexed whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcmart.llm.common import cut_lineage, empty_if_null, range_hashes, ship, table

K = 50
#: A block is closed at so many documents or distinct terms per document.
BLOCK_DOCS, BLOCK_POINTS = 8192, 2_000_000
#: Bytes of text whose terms are hashed at once, unless one term is longer.
PIECE = 1 << 20
#: Ranges of documents that descend at once.
GROUP = 128
#: Blocks, about, that give the first lower bounds.
SEEDS = 4
#: Distinct (item, term) pairs that are sent to the tasks at once; more are searched in turns.
PAIRS = 1_000_000
#: Parts in which an item's finds are ranked first.
SALTS = 32
_NULL = np.iinfo(np.int64).min

# Terms are maximal runs of these bytes; only A-Z become small. Fixed values of the query.
_LETTERS = np.arange(256, dtype=np.uint8)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _LETTERS[_low : _high + 1] = 0
_LETTERS[ord("A") : ord("Z") + 1] += 32


# --- terms --------------------------------------------------------------------------------


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each text begins (and the last one ends)."""
    held = pa.concat_arrays([texts]).cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = held.buffers()
    at = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1]
    found = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return found[at[0] : at[-1]], at - at[0]


def _runs(letters: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each term; none goes on from one text to the next."""
    inside = letters != 0
    first = np.zeros(len(letters) + 1, bool)
    first[begins] = True
    starts = np.flatnonzero(inside & (first[:-1] | ~np.r_[False, inside[:-1]]))
    ends = np.flatnonzero(inside & (first[1:] | ~np.r_[inside[1:], False])) + 1
    return starts, ends


def terms(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, term hash, times) of a column of texts, a bounded number of bytes at a time."""
    data, begins = _bytes(texts)
    letters = _LETTERS[data]
    starts, ends = _runs(letters, begins)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        low = starts[at]
        hashes = range_hashes(letters[low : ends[to - 1]], starts[at:to] - low, ends[at:to] - low)
        owner = np.searchsorted(begins, starts[at:to], "right") - 1
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        yield owner[new], hashes[new], np.diff(np.r_[new, to - at])
        at = to


def totals(documents: DataFrame, text: str = "text") -> tuple[int, int]:
    """Documents with at least one term, and all terms with their repeats."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                data, begins = _bytes(batch.column(0).slice(at, 64))
                starts, _ = _runs(_LETTERS[data], begins)
                size += len(starts)
                held += len(np.unique(np.searchsorted(begins, starts, "right")))
        yield pa.RecordBatch.from_pydict({"held": pa.array([held], pa.int64()), "size": pa.array([size], pa.int64())})

    ship(documents.sparkSession)
    row = documents.select(text).mapInArrow(work, "held bigint, size bigint").agg(F.sum("held"), F.sum("size")).first()
    return row[0] or 0, row[1] or 0


# --- one block ----------------------------------------------------------------------------


@dataclass
class Treap:
    """``splits`` has the halved directions of each level (1: documents, 2: terms, 3: both); ``bits``
    and ``first`` lead from a cell to its children, ``most`` are the maxima of a level's children."""

    splits: list[int]
    bits: list[np.ndarray]
    most: list[np.ndarray]

    def __post_init__(self) -> None:
        # One more cell at the end of each level stands for "no such cell".
        self.first = [np.r_[0, np.cumsum(_COUNT[b])].astype(np.int32) for b in self.bits]
        self.bits = [np.r_[b, np.uint8(0)] for b in self.bits]
        self.most = [np.r_[m, np.int64(0)].astype(np.int64) for m in self.most]


_COUNT = np.array([bin(i).count("1") for i in range(16)], np.int32)
#: Children of a cell that come before child ``c``, by its bits.
_BEFORE = np.array([[bin(bits & ((1 << c) - 1)).count("1") for c in range(4)] for bits in range(16)], np.int32)


def build(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, n_rows: int, n_columns: int) -> Treap:
    """The tree of the given points, each at another place."""
    wide, high = max(n_columns - 1, 1).bit_length(), max(n_rows - 1, 1).bit_length()
    both = min(wide, high)
    splits = [2 if high > wide else 1] * abs(high - wide) + [3] * both
    code = (rows >> both if high > wide else columns >> both).astype(np.int64) << (2 * both)
    for bit in range(both):
        code |= ((rows >> bit & 1).astype(np.int64) << (2 * bit + 1)) | ((columns >> bit & 1).astype(np.int64) << (2 * bit))
    order = np.argsort(code, kind="stable")
    code, value = code[order], impacts[order].astype(np.int64)
    bits, most = [], []
    for split in reversed(splits):
        width = 2 if split == 3 else 1
        above = code >> width
        new = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
        most.append(value)
        bits.append(np.bitwise_or.reduceat((1 << (code & (1 << width) - 1)).astype(np.uint8), new))
        code, value = above[new], np.maximum.reduceat(value, new)
    return Treap(splits, bits[::-1], most[::-1])


def pack(treap: Treap) -> bytes:
    """Levels from the top: child bits, then each child's maximum as what it lacks to that of its cell."""
    parts, above = [], None
    for bits, most in zip(treap.bits, treap.most, strict=True):
        bits, most = bits[:-1], most[:-1]
        if above is None:
            above = np.array([most.max()], np.int64)
            parts.append(above.tobytes())
        parts += [bits.tobytes(), (np.repeat(above, _COUNT[bits]) - most).astype(np.uint32).tobytes()]
        above = most
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(packed: bytes, splits: list[int]) -> Treap:
    data = zstandard.ZstdDecompressor().decompress(packed)
    bits, most, at, cells = [], [], 8, 1
    above = np.frombuffer(data, np.int64, 1)
    for _ in splits:
        own = np.frombuffer(data, np.uint8, cells, at)
        at, count = at + cells, _COUNT[own]
        cells = int(count.sum())
        above = np.repeat(above, count) - np.frombuffer(data, np.uint32, cells, at).astype(np.int64)
        at += 4 * cells
        bits.append(own)
        most.append(above)
    return Treap(splits, bits, most)


class Best:
    """The k highest scores so far, equal ones by ascending key."""

    def __init__(self, k: int, least: int = 1):
        self.k, self.least = k, least
        self.scores, self.keys = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        self.scores, self.keys = np.r_[self.scores, scores], np.r_[self.keys, keys]
        if len(self.scores) > self.k:
            order = np.lexsort((self.keys, -self.scores))[: self.k]
            self.scores, self.keys = self.scores[order], self.keys[order]
        if len(self.scores) >= self.k:
            self.least = max(self.least, int(self.scores.min()))


def search(treap: Treap, rows: np.ndarray, weights: np.ndarray, keys: np.ndarray, best: Best, group: int = GROUP) -> int:
    """Put the documents with the highest scores into ``best``; the number of ranges looked at.

    ``rows`` are the rows of an item's terms in the block; ``keys`` the block's documents.
    """
    if not len(rows):
        return 0
    depth, looked = len(treap.splits), 0
    left = sum(split >= 2 for split in treap.splits)
    #: Waiting ranges of each level: bounds, first document (in ranges of that level), cells.
    waiting: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in range(depth + 1)]
    waiting[0] = [(np.array([np.iinfo(np.int64).max]), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int32))]
    tops = np.full(depth + 1, -1, np.int64)
    tops[0] = np.iinfo(np.int64).max
    bit_at = np.cumsum([split >= 2 for split in treap.splits])
    while tops.max() >= best.least:
        level = int(tops.argmax())
        bounds, places, cells = (np.concatenate(x) for x in zip(*waiting[level], strict=True))
        alive = bounds >= best.least
        if not alive.all():
            bounds, places, cells = bounds[alive], places[alive], cells[alive]
        if level == depth:
            best.add(bounds, keys[places])
            waiting[level], tops[level] = [], -1
            continue
        if len(bounds) > group:
            order = np.argpartition(-bounds, group)
            taken, rest = order[:group], order[group:]
            waiting[level], tops[level] = [(bounds[rest], places[rest], cells[rest])], bounds[rest].max()
            places, cells = places[taken], cells[taken]
        else:
            waiting[level], tops[level] = [], -1
        looked += len(places)
        split, bits, first, most = treap.splits[level], treap.bits[level], treap.first[level], treap.most[level]
        child = (rows >> (left - int(bit_at[level])) & 1) * (2 if split == 3 else 1) if split >= 2 else np.zeros(len(rows), np.int64)
        held, start = bits[cells], first[cells]
        for half in (0, 1) if split & 1 else (0,):
            at = child + half
            there = held >> at.astype(np.uint8) & 1
            below = np.where(there == 1, start + _BEFORE[held, at], np.int32(len(most) - 1))
            bound = most[below] @ weights
            alive = bound >= best.least
            if alive.any():
                place = places[alive] * (2 if split & 1 else 1) + half
                waiting[level + 1].append((bound[alive], place, below[alive].astype(np.int32)))
                tops[level + 1] = max(tops[level + 1], bound[alive].max())
    return looked


# --- frames -------------------------------------------------------------------------------

_BLOCK = "docs binary, terms binary, held binary, splits binary, treap binary"


def index(documents: DataFrame, key: str = "doc_id", text: str = "text", counted: tuple[int, int] | None = None) -> DataFrame:
    """A row per block: keys, term hashes by row, documents that hold each term, and the treap."""
    n, size = totals(documents, text) if counted is None else counted
    docs_limit, points_limit = BLOCK_DOCS, BLOCK_POINTS

    def closed(keys: list, parts: list) -> pa.RecordBatch:
        owner, hashes, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((owner, hashes))
        owner, hashes, times = owner[order], hashes[order], times[order].astype(np.int64)
        # A long text comes in pieces; its points are joined here.
        new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        owner, hashes, times = owner[new], hashes[new], np.add.reduceat(times, new)
        names, number, held = np.unique(hashes, return_inverse=True, return_counts=True)
        by_count = np.argsort(-held, kind="stable")
        row = np.empty(len(names), np.int64)
        row[by_count] = np.arange(len(names))
        length = np.bincount(owner, times, len(keys)).astype(np.int64)
        m = 50 + (50 * length * n) // size
        impact = (1_000_000_000 * times) // (1000 * times + 20 * m[owner])
        treap = build(row[number], owner, impact, len(names), len(keys))
        found = np.array(keys, np.int64).tobytes(), names[by_count].tobytes(), held[by_count].astype(np.uint32).tobytes()
        values = (*found, bytes(treap.splits), pack(treap))
        return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], ["docs", "terms", "held", "splits", "treap"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        parts: list[tuple] = []
        points = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                own = some.column(0).fill_null(_NULL).to_numpy(zero_copy_only=False)
                numbers = np.full(len(own), -1, np.int64)
                for owner, hashes, times in terms(some.column(1)):
                    for i in np.unique(owner):
                        if numbers[i] < 0:
                            numbers[i] = len(keys)
                            keys.append(int(own[i]))
                    parts.append((numbers[owner], hashes, times))
                    points += len(owner)
                if len(keys) > docs_limit - 64 or points >= points_limit:
                    yield closed(keys, parts)
                    keys, parts, points = [], [], 0
        if keys:
            yield closed(keys, parts)

    ship(documents.sparkSession)
    return documents.select(F.col(key).cast("long"), empty_if_null(F.col(text))).mapInArrow(work, _BLOCK)


def _item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, terms): each item's distinct term hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                found = np.unique(np.concatenate([np.empty(0, np.uint64), *[hashes for _, hashes, _ in terms(row.column(1))]]))
                if len(found):
                    yield pa.RecordBatch.from_arrays([row.column(0), pa.array([found.tobytes()], pa.binary())], ["item", "terms"])

    ship(items.sparkSession)
    told = items.select(F.col(key).alias("item"), empty_if_null(F.col(text)))
    return told.mapInArrow(work, f"item {items.schema[key].dataType.simpleString()}, terms binary")


def _frequencies(blocks: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """Documents that hold each of the wanted (sorted) terms."""
    shared = blocks.sparkSession.sparkContext.broadcast(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for names, held in zip(batch.column(0), batch.column(1), strict=True):
                names, held = np.frombuffer(names.as_py(), np.uint64), np.frombuffer(held.as_py(), np.uint32)
                at = np.searchsorted(shared.value, names)
                at[at == len(total)] = 0
                known = shared.value[at] == names
                total[at[known]] += held[known]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(shared.value[some].view(np.int64)), pa.array(total[some])], ["term", "held"])

    told = blocks.select("terms", "held").mapInArrow(work, "term bigint, held bigint")
    return {row.term: row.held for row in told.groupBy("term").agg(F.sum("held").alias("held")).collect()}


def _finds(blocks: DataFrame, asked: list[tuple], k: int, least: list[int], schema: str) -> DataFrame:
    """(item, key, score): the k best of each task, for items (key, sorted terms, weights)."""
    shared = blocks.sparkSession.sparkContext.broadcast((asked, least))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least = shared.value
        best = [Best(k, floor) for floor in least]
        for batch in batches:
            for row in range(batch.num_rows):
                docs, names, _, splits, packed = (column[row].as_py() for column in batch.columns)
                names, keys = np.frombuffer(names, np.uint64), np.frombuffer(docs, np.int64)
                treap = unpack(packed, list(splits))
                order = np.argsort(names)
                for (_, own, weights), found in zip(asked, best, strict=True):
                    at = np.searchsorted(names, own, sorter=order)
                    at[at == len(names)] = 0
                    known = names[order[at]] == own
                    search(treap, order[at[known]], weights[known], keys, found)
        schema = pa.schema([("number", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])
        for at, found in enumerate(best):
            if len(found.scores):
                doc = pa.array(found.keys, mask=found.keys == _NULL)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), at)), doc, pa.array(found.scores)], schema=schema)

    return blocks.mapInArrow(work, schema)


def ranked(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", k: int = K
) -> DataFrame:
    """(item, rank, key, score): the k documents with the highest scores of each item."""
    spark = documents.sparkSession
    n, size = totals(documents, text)
    kind = items.schema[item].dataType
    empty = spark.createDataFrame([], f"`{item}` {kind.simpleString()}, rank int, `{key}` bigint, score bigint")
    if not n:
        return empty
    blocks = cut_lineage(index(documents, key, text, (n, size)))
    told = cut_lineage(_item_terms(items, item, text).withColumn("number", F.monotonically_increasing_id()))
    pairs = told.agg(F.sum(F.octet_length("terms") / 8)).first()[0] or 0
    turns = max(1, math.ceil(pairs / PAIRS))
    stored = blocks.count()
    found = empty
    schema = "number bigint, doc bigint, score bigint"
    for turn in range(turns):
        some = told.where(F.pmod(F.xxhash64("number"), F.lit(turns)) == turn).collect()
        if not some:
            continue
        own = [np.frombuffer(row.terms, np.uint64) for row in some]
        held = _frequencies(blocks, np.unique(np.concatenate(own)))
        asked = []
        for hashes in own:
            df = np.array([held.get(int(h), 0) for h in hashes.view(np.int64)], np.int64)
            weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
            asked.append((None, hashes[df > 0], weights[df > 0]))
        # Drawn where they lie: a limit would bring blocks of every task to one.
        some_blocks = blocks.sample(SEEDS / stored, 7) if stored > SEEDS else blocks
        seeds = _finds(some_blocks, asked, k, [1] * len(asked), schema).groupBy("number").agg(F.sort_array(F.collect_list("score"), False).alias("s"))
        least = [1] * len(asked)
        for row in seeds.collect():
            best = sorted(row.s, reverse=True)
            if len(best) >= k:
                least[row.number] = max(1, best[k - 1])
        finds = _finds(blocks, asked, k, least, schema)
        salted = W.partitionBy("number", F.pmod(F.xxhash64("doc"), F.lit(SALTS))).orderBy(F.desc("score"), "doc")
        finds = finds.withColumn("place", F.row_number().over(salted)).where(F.col("place") <= k)
        finds = finds.withColumn("rank", F.row_number().over(W.partitionBy("number").orderBy(F.desc("score"), "doc"))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(at, row["item"]) for at, row in enumerate(some)], f"number bigint, item {kind.simpleString()}")
        named = finds.join(F.broadcast(names), "number").select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score")
        found = named if turn == 0 and turns == 1 else found.unionByName(named)
    return found


def op13_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that rank highest for each benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
