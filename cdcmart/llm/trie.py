"""Prefix trie of conversations by van Emde Boas recursion.

All sequences are cut at half the depth (a power of two), and the cut prefix is named. Sequences
up to the cut make the upper trie, what follows each cut prefix makes a lower forest, and both
are cut again, all parts of a level in one job, until parts are ``LEAF`` turns deep. So a
sequence of n turns takes about log n rounds, not n:

* up: contents of aligned parts are named from their two halves;
* down: the name of each part's start is that of its upper part's start with the left half added;
* in a part of ``LEAF`` turns, prefixes are named one by one, and subtree totals are summed within the part;
* graft: level by level, the total of the forest below a cut prefix is added to all nodes above it
  in the upper part, which its smallest member's sequence lists.

Names are 128-bit digests. Nodes, members and totals are aggregated by name, partly before rows
move, so a prefix that a third of all conversations share costs a row per task. A turn's text is
replaced by its digest and size before anything is moved.

A node's digest of the members that end there needs their ids in order. Ids are first gathered in
chunks of a bounded range; a node's chunks then stream in order through SHA-256, which can only
be computed from front to back, in constant memory.

Turns are ordered by turn number (null first), turns of equal number by role and then by the digest
of the text. Null roles and texts are empty. Rows without a conversation id belong to no conversation. Ids and turn
numbers are 64-bit integers. A repeated row is a further turn. A node needs a member, so an empty table has
no node, not even the root. Extra columns are set aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcmart.llm.common import cut_lineage, empty_if_null, map_rows, ship, table

#: Turns of the smallest part, in which prefixes are named one after the other.
LEAF = 8
#: A conversation's turn numbers are ranked in slices of 2 to this power; ids are gathered in chunks of a range.
SLICE_BITS, CHUNK = 12, 4096
#: Conversations share turns in groups of ``SHARERS`` and at most ``SHARED - 1`` turns.
SHARERS, SHARED = 5, 9
_EMPTY = hashlib.sha256(b"").hexdigest()
_ROOT = hashlib.md5(b"").digest()


# --- sequences ----------------------------------------------------------------------------


def ordered(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """(c, pos, turn_key, size): each turn with its place from 1, a digest of role and text, and the text's bytes.

    A conversation is ranked in slices of turn numbers: places count up from the number of
    rows in earlier slices, so a long conversation is not sorted in one task.
    """
    role, text = empty_if_null(F.col("role")), empty_if_null(F.col("text"))
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("c"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("turn_key"),
        F.octet_length(text).cast("long").alias("size"),
        F.coalesce(F.shiftright(F.col("turn").cast("long"), SLICE_BITS), F.lit(-(1 << 62))).alias("slice"),
    )
    sizes = rows.groupBy("c", "slice").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(W.partitionBy("c").orderBy("slice").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("c", "slice", F.coalesce(earlier, F.lit(0)).alias("offset"))
    place = F.row_number().over(W.partitionBy("c", "slice").orderBy(F.asc_nulls_first("turn"), "role", "turn_key"))
    ranked = rows.withColumn("place", place).join(offsets, ["c", "slice"])
    return ranked.select("c", (F.col("offset") + F.col("place")).alias("pos"), "turn_key", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (c, depth, turn_key, size) and conversations (c, n) after a shared start: the first h turns of
    the first conversation of each group, then the own turns after the h-th; h is 0 to 8 by the id."""
    lengths = turns.groupBy("c").agg(F.max("pos").alias("own"))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % SHARED
    each = lengths.select("c", "own", h.alias("h"), (F.col("c") - F.col("c") % SHARERS).alias("source"))
    starts = lengths.select(F.col("c").alias("source"), F.col("own").alias("given"))
    each = each.join(starts, "source", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0))))
    each = cut_lineage(each.withColumn("n", F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    first = turns.where(F.col("pos") < SHARED).withColumnRenamed("c", "source").join(each.select("c", "source", "given"), "source")
    first = first.where("pos <= given").select("c", F.col("pos").alias("depth"), "turn_key", "size")
    own = turns.join(each.select("c", "h", "given"), "c").where("pos > h")
    own = own.select("c", (F.col("pos") - F.col("h") + F.col("given")).alias("depth"), "turn_key", "size")
    return first.unionByName(own), each.select("c", "n")


# --- names --------------------------------------------------------------------------------


def _join(*names: str) -> Column:
    return F.unhex(F.md5(F.concat(*[F.col(name) for name in names])))


def _half(name: str) -> Column:
    return F.shiftright(F.col(name), 1)


def starts(parts: DataFrame, rounds: int) -> DataFrame | None:
    """(c, part, start): the name of the prefix before each part of a sequence that has several."""
    # Up: a row per pair of halves. Sequences of one part are not carried on.
    keys = F.array_join(F.transform("keys", F.hex), "")
    level = parts.where("parts > 1").select("c", "part", "parts", F.unhex(F.md5(keys)).alias("content"))
    pairs = []
    for _ in range(rounds):
        left, right = (F.max(F.when(F.col("part") % 2 == side, F.col("content"))) for side in (0, 1))
        level = level.groupBy("c", _half("part").alias("part"), (_half("parts") + F.col("parts") % 2).alias("parts"))
        level = cut_lineage(level.agg(left.alias("left"), right.alias("right")))
        pairs.append(level)
        level = level.where("parts > 1").select("c", "part", "parts", F.coalesce(_join("left", "right"), "left").alias("content"))
    # Down: each half's start; that of a lower half is its upper half's start with the upper half added.
    found = None
    for pair in reversed(pairs):
        upper = F.struct((F.col("part") * 2).alias("part"), F.col("start").alias("start"))
        lower = F.struct((F.col("part") * 2 + 1).alias("part"), _join("start", "left").alias("start"))
        halves = F.when(F.col("right").isNull(), F.array(upper)).otherwise(F.array(upper, lower))
        found = cut_lineage(_started(pair, found).select("c", F.explode(halves).alias("half")).select("c", "half.*"))
    return found


def _started(parts: DataFrame, known: DataFrame | None) -> DataFrame:
    """Parts with the names of their starts; the first part of a sequence starts at the root."""
    if known is None:
        return parts.withColumn("start", F.lit(_ROOT))
    joined = parts.join(known, ["c", "part"], "left")
    return joined.withColumn("start", F.coalesce("start", F.lit(_ROOT)))


def paths(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, int]:
    """(c, part, last, above, names, sizes) and the number of rounds.

    For each part of ``LEAF`` turns of a sequence the names of its prefixes, the sizes of their
    last turns, the prefix before the part, and whether the sequence ends in it. Every
    member has a first part, which may be empty.
    """
    deep = turns.select("c", F.expr(f"(depth - 1) div {LEAF}").alias("part"), F.struct("depth", "turn_key", "size").alias("t"))
    gathered = deep.groupBy("c", "part").agg(F.array_sort(F.collect_list("t")).alias("t"))
    parts = members.select("c", F.greatest(F.expr(f"(n + {LEAF - 1}) div {LEAF}"), F.lit(1)).alias("parts"))
    blank = members.where("n = 0").select("c", F.lit(0).cast("long").alias("part"), F.lit([]).cast(gathered.schema["t"].dataType).alias("t"))
    rows = gathered.unionByName(blank).join(parts, "c")
    rows = cut_lineage(rows.select("c", "part", "parts", F.col("t.turn_key").alias("keys"), F.col("t.size").alias("sizes")))
    rounds = ((rows.agg(F.max("parts")).first()[0] or 1) - 1).bit_length()

    def work(row: dict) -> Iterator[tuple]:
        name, names = row["start"], []
        for turn in row["keys"]:
            name = hashlib.md5(name + turn).digest()
            names.append(name)
        yield row["c"], row["part"], row["part"] == row["parts"] - 1, names, row["sizes"]

    schema = "c bigint, part bigint, last boolean, names array<binary>, sizes array<bigint>"
    named = map_rows(_started(rows, starts(rows, rounds)), work, schema, slice_rows=4096)
    if not rounds:
        return cut_lineage(named.withColumn("above", F.lit(_ROOT))), rounds
    named = cut_lineage(named)
    # The prefix before a part is the last one of the part above it.
    ends = named.where(~F.col("last")).select("c", (F.col("part") + 1).alias("part"), F.element_at("names", -1).alias("above"))
    return cut_lineage(named.join(ends, ["c", "part"], "left").withColumn("above", F.coalesce("above", F.lit(_ROOT)))), rounds


def _prefixes(rows: DataFrame, *more: str) -> DataFrame:
    """(name, depth, parent, size, c, at, ...) of every prefix in path rows, that of the root included; ``at`` counts from 0 in a part, the root is -1."""
    parent = F.when(F.col("at") == 0, F.col("above")).otherwise(F.get("names", F.col("at") - 1))
    some = rows.select("*", F.posexplode("names").alias("at", "name")).select(
        "name", (F.col("part") * LEAF + F.col("at") + 1).alias("depth"), parent.alias("parent"), F.get("sizes", F.col("at")).alias("size"), "c", "part", "at", *more
    )
    none = F.lit(None).cast("binary")
    top = rows.where("part = 0").select(
        F.lit(_ROOT).alias("name"), F.lit(0).cast("long").alias("depth"), none.alias("parent"), F.lit(0).cast("long").alias("size"), "c", "part", F.lit(-1).alias("at"), *more
    )
    return some.unionByName(top)


# --- totals -------------------------------------------------------------------------------


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name").agg(
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.min("c").alias("c"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )


def grafted(nodes: DataFrame, walks: DataFrame, rounds: int) -> DataFrame:
    """(name, leaves, saved): subtree totals of ``nodes`` (name, c, depth, part, at, leaf, own).

    ``c`` is a node's smallest member, so a node lies on the path of ``c``, and a part of that path has
    all its ancestors of that part.
    """
    held = nodes.groupBy("c", "part").agg(F.collect_list(F.struct("at", "leaf", "own")).alias("held"))
    within = _prefixes(walks.join(held, ["c", "part"]), "held")
    below = F.filter("held", lambda x: x["at"] >= F.col("at"))
    within = within.select(
        "name", "depth", "parent", "c",
        F.aggregate(below, F.lit(0).cast("long"), lambda total, x: total + x["leaf"]).alias("leaves"),
        F.aggregate(below, F.lit(0).cast("long"), lambda total, x: total + x["own"]).alias("saved"),
    )
    totals = cut_lineage(_summed(within.where("leaves > 0 OR saved <> 0")))
    for level in range(rounds):
        # What hangs below the cuts of this level, in the middle of parts twice as deep ...
        span = LEAF << level
        forests = totals.where((F.col("depth") - 1) % (2 * span) == span).groupBy("parent").agg(
            F.first("depth").alias("depth"), F.min("c").alias("c"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        )
        cut = F.expr(f"(depth - 1) div {LEAF}")
        forests = forests.select("c", "leaves", "saved", F.explode(F.sequence(cut - (1 << level), cut - 1)).alias("part"))
        # ... is added to all nodes above it in the upper half.
        added = _prefixes(walks.join(forests, ["c", "part"]), "leaves", "saved")
        totals = totals.unionByName(_summed(added))
        totals = cut_lineage(_summed(totals))
    return totals.select("name", "leaves", "saved")


def ends(last: DataFrame) -> DataFrame:
    """(name, ends_sha256) of names with members (name, c) that end there."""
    chunks = last.groupBy("name", F.expr(f"c div {CHUNK}").alias("chunk")).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    chunks = chunks.select("name", "chunk", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            names, digests = [], []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != name:
                    if name is not None:
                        names.append(name)
                        digests.append(digest.hexdigest())
                    name, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], ["name", "ends_sha256"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])], ["name", "ends_sha256"])

    ship(last.sparkSession)
    streamed = chunks.repartition("name").sortWithinPartitions("name", "chunk").select("name", "ids")
    return streamed.mapInArrow(work, "name binary, ends_sha256 string")


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of sequences (c, depth, turn_key, size) of members (c, n)."""
    walks, rounds = paths(turns, members)
    every = _prefixes(walks, "last", F.size("names").alias("turns"))
    nodes = every.groupBy("name").agg(
        F.min("c").alias("c"), F.count("*").alias("n_convs"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.first("size").alias("size"), F.first("part").alias("part"), F.first("at").alias("at"),
    )
    nodes = cut_lineage(nodes)
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = cut_lineage(nodes)
    own = nodes.select("name", "c", "depth", "part", "at", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("own"))
    totals = grafted(own, walks, rounds)
    ended = ends(every.where(F.col("last") & (F.col("at") == F.col("turns") - 1)).select("name", "c"))
    above = nodes.select(F.col("name").alias("parent"), F.col("c").alias("parent_conv_id"))
    done = nodes.join(totals, "name").join(ended, "name", "left").join(above, "parent", "left")
    return done.select(
        F.col("c").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return trie(*rebuilt(ordered(table(spark, sf_dir, "conversations"))))
