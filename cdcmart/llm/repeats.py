"""Removal of long repeated byte strings with suffix arrays.

Every byte that lies in a ``LENGTH``-byte string which also starts anywhere else, in the
same text or another, is removed. Matches never cross texts.

Texts are sharded by content, so that each shard can be sorted alone: of every
``LENGTH``-byte window the least hashed ``ANCHOR``-byte string is its anchor, and equal windows
have equal anchors at equal places. Anchors that occur once are dropped; of the others, the
windows that have this anchor go to the shard of its hash, as one string. Equal strings are
repeats as a whole and are kept once per shard, the others are cut to what they may share. A shard's
strings are concatenated with unique separators, sorted by induced sorting, and all windows
that share a common prefix of ``LENGTH`` with a neighbour at another place are repeats.

Equal texts are one text that counts twice: all of it is a repeat when it has ``LENGTH`` bytes.
An anchor with more than ``HOT`` occurrences is not gathered in one shard: the windows around
its distinct surroundings are keyed by their full hash and counted.

Null texts count as empty, shorter texts than ``LENGTH`` stay as they are, a null key is a key
like any other, and repeated rows are copies of each other. Extra columns are set aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcmart.llm.common import cut_lineage, empty_if_null, map_rows, range_hashes, table, text_key
from cdcmart.llm.suffix import permuted_prefixes, suffix_array

LENGTH, ANCHOR = 400, 64
HOT = 20_000
SHARD_BYTES = 1 << 20  # sorted at once, unless the strings of one anchor are longer
_SEGMENT = 1 << 20

# --- one text ---------------------------------------------------------------------------


def anchors(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, places, first, last) of the anchors of a text: ``first`` and ``last`` are the
    starts of the windows whose anchor it is, which follow each other."""
    wide = length - anchor + 1  # anchor places in a window
    found = []
    for at in range(0, max(0, len(data) - length + 1), _SEGMENT):
        part = data[at : at + _SEGMENT + length - 1]
        starts = np.arange(len(part) - anchor + 1)
        hashes = range_hashes(part, starts, starts + anchor)
        # The place in the low bits makes the leftmost of equal strings the least.
        mask = np.uint64((1 << 21) - 1)
        packed = (hashes & ~mask) | starts.astype(np.uint64)
        blocks = np.full((-(-len(packed) // wide), wide), ~np.uint64(0))
        blocks.ravel()[: len(packed)] = packed
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(part) - length + 1
        places = (np.minimum(behind[:windows], ahead[wide - 1 : wide - 1 + windows]) & mask).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        last = np.append(first[1:], windows) - 1
        found.append((hashes[places[first]], places[first] + at, first + at, last + at))
    if not found:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if not n or a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


def trims(strings: list[bytes], places: list[int]) -> list[tuple[int, int]]:
    """(low, high) of each string: the part that any other may share with it around the anchor.

    ``places`` are those of the anchor, where equal windows of two strings lie over each
    other. So no such window reaches further than the longest common prefix, from the
    anchor on, with any other string, nor than the longest common suffix before it.
    """
    ends = [0] * len(strings), [0] * len(strings)
    sides = [s[:p][::-1] for s, p in zip(strings, places, strict=True)], [s[p:] for s, p in zip(strings, places, strict=True)]
    for reach, parts in zip(ends, sides, strict=True):
        order = sorted(range(len(parts)), key=parts.__getitem__)
        for i, j in zip(order, order[1:], strict=False):
            both = _common(parts[i], parts[j])
            reach[i], reach[j] = max(reach[i], both), max(reach[j], both)
    return [(p - before, p + after) for p, before, after in zip(places, *ends, strict=True)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint spans; touching spans become one."""
    found: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if found and low <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], high))
        else:
            found.append((low, high))
    return found


# --- one shard --------------------------------------------------------------------------


class Shard:
    """Surroundings of anchors, gathered until they are worth sorting."""

    def __init__(self, length: int):
        self.length, self.size = length, 0
        self.strings: list[bytes] = []
        self.places: list[tuple[bytes, int]] = []  # text and start of each string
        self.twice: list[bool] = []

    def add(self, body: bytes, tid: bytes, start: int, twice: bool) -> None:
        self.strings.append(body)
        self.places.append((tid, start))
        self.twice.append(twice)
        self.size += len(body) + 1

    def repeats(self) -> Iterator[tuple[bytes, int, int]]:
        """(text, low, high) of the repeated parts of strings that were seen once."""
        if len(self.strings) < 2:
            return
        sizes = np.array([len(x) for x in self.strings])
        starts = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        joined = np.empty(self.size, np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes + 1)
        joined[starts + sizes] = 256 + np.arange(len(sizes))
        inside = np.ones(self.size, bool)
        inside[starts + sizes] = False
        joined[inside] = np.frombuffer(b"".join(self.strings), np.uint8)
        sa = suffix_array(joined)
        common = permuted_prefixes(joined, sa)[sa] >= self.length
        # Windows in one run are equal. Strings of one text overlap: only another place counts.
        run = np.cumsum(~common)
        texts = {tid: i for i, tid in enumerate(dict.fromkeys(tid for tid, _ in self.places))}
        number = np.array([texts[tid] for tid, _ in self.places], np.int64)
        start = np.array([x for _, x in self.places], np.int64)
        own = owner[sa]
        place = (number[own] << 40) + start[own] + sa - starts[own]
        heads = np.flatnonzero(np.r_[True, ~common[1:]])
        apart = np.minimum.reduceat(place, heads) != np.maximum.reduceat(place, heads)
        counts = np.diff(np.r_[heads, len(sa)])
        many = np.maximum.reduceat(np.array(self.twice)[own], heads) & (counts > 1)
        flagged = np.zeros(self.size + 1, np.int64)
        flagged[:-1][sa[(apart | many)[run - run[0]]]] = 1
        # A byte is covered if a flagged window starts at most LENGTH - 1 bytes before it.
        sums = np.cumsum(flagged[:-1])
        covered = sums - np.r_[np.zeros(self.length, np.int64), sums[: -self.length]][: self.size] > 0
        edges = np.diff(np.r_[0, covered.astype(np.int8), 0])
        for low, high in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            at = owner[low]
            if not self.twice[at]:
                shift = int(start[at] - starts[at])
                yield self.places[at][0], int(low) + shift, int(high) + shift


# --- frames -----------------------------------------------------------------------------


def _anchored(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(h, tid, hit); ``hit`` packs the anchor's place and the reach of its windows to both sides."""

    def work(row: dict) -> Iterator[tuple]:
        hashes, places, first, last = anchors(np.frombuffer(row["body"], np.uint8), length, anchor)
        hits = (places << 24) | ((places - first) << 12) | (last + length - places)
        for h, hit in zip(hashes.view(np.int64).tolist(), hits.tolist(), strict=True):
            yield h, row["tid"], hit

    long = texts.where(F.octet_length("body") >= length)
    return map_rows(long.select("tid", "body"), work, "h bigint, tid binary, hit bigint", slice_rows=1 << 14)


def _surroundings(texts: DataFrame, hits: DataFrame, length: int) -> DataFrame:
    """(h, c, body, place, tid, start, n, own, seen): distinct surroundings of a text's repeated anchors.

    The surroundings are the windows whose anchor it is; ``place`` is that of the anchor in
    ``body`` and ``c`` the digest of ``body``. ``n`` is 2 when the text holds it more than
    once. ``own`` has the merged spans of all its places, ``seen`` is how often the anchor
    occurs. ``body`` is null where the same task has given it before.
    """
    given: set[tuple] = set()
    own = hits.groupBy("tid").agg(F.collect_list(F.struct("h", "hit", "n")).alias("hits"))

    def work(row: dict) -> Iterator[tuple]:
        body, found = row["body"], {}
        for x in row["hits"]:
            at, before, after = x["hit"] >> 24, (x["hit"] >> 12) & 4095, x["hit"] & 4095
            low, high = at - before, at + after
            part = body[low:high]
            found.setdefault((x["h"], before, hashlib.md5(part).digest(), x["n"]), []).append((low, high))
        for (h, place, c, seen), places in found.items():
            low, high = places[0]
            part = None if (h, c) in given else body[low:high]
            given.add((h, c))
            yield h, c, part, place, row["tid"], low, min(2, len(places)), [list(span) for span in merged(places)], seen

    schema = "h bigint, c binary, body binary, place int, tid binary, start int, n int, own array<array<int>>, seen bigint"
    # All columns of the texts, so that they are grouped once for this and for what is kept of them.
    return map_rows(texts.join(own, "tid"), work, schema, slice_rows=1024)


def _sorted_shards(dealt: DataFrame, length: int, hot: int) -> DataFrame:
    """(tid, low, high) of repeats around anchors that are not hot.

    A task reads its surroundings in order of anchor and digest. Equal ones are repeats as
    a whole and are kept once. Those of one anchor are cut to what they may share, then
    they are gathered for sorting.
    """

    def cover(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(length)
        out: list[tuple] = []
        group: list[dict] = []  # distinct surroundings of one anchor; "n" > 1 if seen again

        def whole(row: dict) -> list[tuple]:
            return [(row["tid"], low, high) for low, high in row["own"]]

        def gather() -> None:
            cuts = trims([row["body"] for row in group], [row["place"] for row in group])
            seen: dict[bytes, list] = {}
            for row, (low, high) in zip(group, cuts, strict=True):
                if row["n"] > 1:
                    out.extend(whole(row))
                    low, high = 0, len(row["body"])
                if high - low >= length:
                    alike = seen.setdefault(row["body"][low:high], [])
                    alike.append((row["tid"], row["start"] + low, row["n"] > 1))
            for body, places in seen.items():
                twice = len(places) > 1 or places[0][2]
                if len(places) > 1:
                    out.extend((tid, start, start + len(body)) for tid, start, _ in places)
                if len(seen) > 1:
                    shard.add(body, places[0][0], places[0][1], twice)

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = pa.binary(), pa.int32(), pa.int32()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["tid", "low", "high"])

        for part in source:
            for row in part.filter(pc.less_equal(part.column("seen"), hot)).to_pylist():
                if group and row["h"] != group[0]["h"]:
                    gather()
                    group = []
                    if shard.size >= SHARD_BYTES:
                        out.extend(shard.repeats())
                        shard = Shard(length)
                if group and row["c"] == group[-1]["c"]:
                    # Equal surroundings elsewhere: both are repeats as a whole.
                    group[-1]["n"] = 2
                    out.extend(whole(row))
                else:
                    group.append(row)
                if len(out) > 4096:
                    yield batch()
        if group:
            gather()
        out.extend(shard.repeats())
        if out:
            yield batch()

    ordered = dealt.sortWithinPartitions("h", "c", F.col("body").isNull())
    return ordered.mapInArrow(cover, "tid binary, low int, high int")


def _counted_windows(dealt: DataFrame, length: int, hot: int) -> DataFrame:
    """(tid, low, high) of repeats around hot anchors, window by window."""

    def only_hot(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in source:
            yield part.filter(pc.greater(part.column("seen"), hot))

    # Filtered here and not in the plan, so that both paths read what was moved once.
    rows = dealt.mapInArrow(only_hot, dealt.schema)
    alike = W.partitionBy("h", "c")
    marked = rows.withColumn("all", F.sum("n").over(alike)).withColumn("first", F.row_number().over(alike.orderBy(F.col("body").isNull(), "tid", "start")))
    whole = marked.where("all > 1").select("tid", F.explode("own").alias("s"))
    whole = whole.select("tid", F.col("s")[0].alias("low"), F.col("s")[1].alias("high"))

    def windows(row: dict) -> Iterator[tuple]:
        for at in range(len(row["body"]) - length + 1):
            yield hashlib.md5(row["body"][at : at + length]).digest(), row["tid"], row["start"] + at, row["twice"]

    once = marked.where("first = 1").select("body", "tid", "start", (F.col("all") > 1).alias("twice"))
    each = map_rows(once, windows, "w binary, tid binary, at int, twice boolean", slice_rows=4096)
    place = F.struct("tid", "at")
    found = each.groupBy("w").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("twice").alias("twice"))
    single = each.join(found.where("a <> b OR twice").select("w"), "w")
    return whole.unionByName(single.select("tid", F.col("at").alias("low"), (F.col("at") + length).alias("high")))


def spans(rows: DataFrame, texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(tid, low, high): repeated parts of ``texts``, the distinct ones of (tid, body) ``rows``.

    Parts may overlap. Anchors are taken from the rows as they lie, so that no text is moved for
    them; those of copies are dropped where the anchors meet.
    """
    if not 0 < anchor <= length < 4096:
        raise ValueError("a window must hold its anchor and have less than 4096 bytes")
    found = _anchored(rows, length, anchor).repartition("h").dropDuplicates(["h", "tid", "hit"])
    found = found.withColumn("n", F.count("*").over(W.partitionBy("h"))).where("n > 1")
    hits = cut_lineage(found)
    rows = _surroundings(texts, hits, length)
    # The surroundings of an anchor meet in one task; those of a hot one are spread.
    spread = F.when(F.col("seen") > hot, F.pmod(F.xxhash64("c"), F.lit(1024))).otherwise(F.lit(-1))
    dealt = rows.repartition("h", spread)
    done = _sorted_shards(dealt, length, hot)
    if not hits.where(F.col("n") > hot).isEmpty():
        done = done.unionByName(_counted_windows(dealt, length, hot))
    return done


def _to_characters(body: bytes, low: int, high: int) -> tuple[int, int]:
    """The part of a span that consists of whole UTF-8 characters."""
    while low < high and body[low] & 0xC0 == 0x80:
        low += 1
    while low < high < len(body) and body[high] & 0xC0 == 0x80:
        high -= 1
    return low, high


def kept_parts(rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT, characters: bool = False) -> DataFrame:
    """(tid, kept, n_bytes, n_removed, n_spans) of each distinct text of (tid, body) rows.

    With ``characters`` a character goes only if all its bytes are repeats, so that what is
    kept is a text again.
    """
    texts = rows.groupBy("tid").agg(F.first("body").alias("body"), F.count("*").alias("copies"))
    own = spans(rows, texts, length, anchor, hot).groupBy("tid").agg(F.collect_list(F.array("low", "high")).alias("spans"))
    joined = texts.join(own, "tid", "left")

    def work(row: dict) -> Iterator[tuple]:
        body = row["body"]
        gone = [(0, len(body))] if row["copies"] > 1 and len(body) >= length else merged([tuple(x) for x in row["spans"] or []])
        if characters:
            gone = [span for span in (_to_characters(body, *x) for x in gone) if span[0] < span[1]]
        ends = [0, *[at for span in gone for at in span], len(body)]
        kept = b"".join(body[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
        yield row["tid"], kept, len(body), len(body) - len(kept), len(gone)

    return map_rows(joined, work, "tid binary, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")


def _keyed(documents: DataFrame, key: str, text: str) -> DataFrame:
    return documents.select(F.col(key).alias("id"), text_key(F.col(text)).alias("tid"), empty_if_null(F.col(text)).cast("binary").alias("body"))


def removed(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(key, kept, n_bytes, n_removed, n_spans) of every row: its remaining bytes, concatenated."""
    rows = _keyed(documents, key, text)
    done = kept_parts(rows.select("tid", "body"), length, anchor, hot)
    return rows.select(F.col("id").alias(key), "tid").join(done, "tid").drop("tid")


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what long repeats leave of it, digested and as text (a character cut in two is replaced)."""
    rows = _keyed(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = kept_parts(rows.select("tid", "body"))
    named = rows.select("id", "tid").join(found, "tid")
    kept = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return named.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), kept)
