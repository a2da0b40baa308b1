"""Benchmark decontamination: BM25 over test items with block-max pruning, then verified overlap.

Every test item is in an inverted index; impacts are BM25 contributions divided by the
item's score for its own text, so 1 is a full match. A document is cut into passages of two
steps each, a step being as long as the longest item, so that any occurrence lies within a
passage. Items are grouped into blocks, and per word the largest impact within each block is
kept. All passages of a document are scored against these maxima together: a block whose sum stays below
the threshold holds no item to retrieve and is skipped for that passage, which is the
pivot test of block-max WAND taken for many passages at once. The items of the other blocks
are scored exactly through their postings, and all above the threshold are verified:
of the words of the question and of the answer, most must be held in order by one stretch of the
passage about as long as the item. An answer of few words may lack ``EDITS``, but not all.

An item's last fifth of words is its answer, the rest its question. Words are compared in
lower case without punctuation. Null, empty and wordless texts match nothing; items without
words are never matched. Repeated items match each by itself, repeated documents likewise.

The index reaches tasks in parts of ``PART_BYTES`` of item text; more items mean more
passes over the documents, never a larger broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.llm.common import add_columns, map_rows, table

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, EDITS = 0.5, 0.8, 2
#: Items in a block. Passages hold common words of most items, so maxima over more items than
#: a few come close to the threshold anywhere and skip nothing.
BLOCK = 2
PART_BYTES = 256 << 10
_WORDS = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


@dataclass(frozen=True)
class Index:
    """One part of the inverted index; term and item numbers count from 0."""

    ids: tuple[int, ...]
    items: tuple[list[str], ...]
    terms: dict[str, int]
    maxima: np.ndarray  # terms x blocks
    postings: tuple[tuple[np.ndarray, np.ndarray], ...]  # per item: its terms and their impacts
    step: int

    @staticmethod
    def build(items: list[tuple[int, list[str]]], frequency: dict[str, int], total: int, mean: float, step: int) -> Index:
        # Items that share words lie together, so that the maxima of a block stay close to its items'.
        items = sorted(items, key=lambda x: (min(x[1], key=lambda w: (frequency[w], w)), x[0]))
        terms = {w: i for i, w in enumerate(sorted({w for _, found in items for w in found}))}
        idf = {w: float(np.log1p((total - frequency[w] + 0.5) / (frequency[w] + 0.5))) for w in terms}
        maxima = np.zeros((len(terms), -(-len(items) // BLOCK)), np.float32)
        postings = []
        for at, (_, found) in enumerate(items):
            norm = K1 * (1 - B + B * len(found) / mean)
            own = {terms[w]: idf[w] * n * (K1 + 1) / (n + norm) for w, n in Counter(found).items()}
            codes, impacts = np.array(list(own)), np.array(list(own.values()))
            impacts = impacts / impacts.sum()
            maxima[codes, at // BLOCK] = np.maximum(maxima[codes, at // BLOCK], impacts)
            postings.append((codes, impacts))
        return Index(tuple(i for i, _ in items), tuple(f for _, f in items), terms, maxima, tuple(postings), step)

    def search(self, text: str | None) -> Iterator[tuple[int, float, int, list[str]]]:
        """(item, score, passage, words of the passage) of all above the threshold."""
        found = words(text)
        codes = np.fromiter(map(self.terms.get, found, repeat(-1)), np.int64, len(found))
        places = np.flatnonzero(codes >= 0)
        if not len(places):
            return
        # Each term once per step, then the sums of the maxima of two steps: an upper bound.
        n = len(self.terms)
        pairs = np.sort(places // self.step * n + codes[places])
        pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
        steps, terms = np.divmod(pairs, n)
        first = np.flatnonzero(np.r_[True, steps[1:] != steps[:-1]])
        last = max(1, -(-len(found) // self.step) - 1)
        bounds = np.zeros((last + 1, self.maxima.shape[1]), np.float32)
        bounds[steps[first]] = np.add.reduceat(self.maxima[terms], first)
        above = bounds[:last] + bounds[1 : last + 1] >= THRESHOLD - 1e-4
        held = np.zeros(n + 1, bool)  # the last place stands for unknown words
        for passage in np.flatnonzero(above.any(1)):
            inside = codes[passage * self.step : (passage + 2) * self.step]
            held[inside] = True
            held[-1] = False
            for block in np.flatnonzero(above[passage]):
                for at in range(block * BLOCK, min((block + 1) * BLOCK, len(self.ids))):
                    own, impacts = self.postings[at]
                    score = float(impacts[held[own]].sum())
                    if score >= THRESHOLD:
                        yield at, score, int(passage), found[passage * self.step : (passage + 2) * self.step]
            held[inside] = False


def _in_order(wanted: list[str], found: list[str]) -> list[int]:
    """Length of the longest common subsequence of ``wanted`` and each prefix of ``found``; a bit per wanted word."""
    whole, masks = (1 << len(wanted)) - 1, {}
    for i, w in enumerate(wanted):
        masks[w] = masks.get(w, 0) | 1 << i
    left, lengths = whole, [0]
    for w in found:
        mask = masks.get(w)
        if mask is not None:
            same = left & mask
            left = ((left + same) | (left - same)) & whole
        lengths.append(len(wanted) - left.bit_count())
    return lengths


def _split(item: list[str]) -> tuple[list[str], list[str]]:
    """Question and answer; an item of one word is an answer."""
    at = len(item) - max(1, len(item) // 5)
    return item[:at], item[at:]


def overlaps(item: list[str], passage: list[str]) -> tuple[float, float]:
    """Shares of the question's and of the answer's words held in order, the answer after the question.

    Both are looked for in one stretch of the passage, a fifth longer than the item. The
    stretch and its division that hold most words of the item count, among equal ones those that
    hold most of the question, so that its last words do not pass for an answer; 0 for too few.
    """
    size = len(item)
    question, answer = _split(item)
    best = (0, 0, 0)
    held = set(passage)
    if sum(w in held for w in item) < OVERLAP * size or _in_order(item, passage)[-1] < OVERLAP * size:
        return 0.0, 0.0
    stride = max(1, size // 20)
    width = size + max(2, size // 5) + stride
    for at in range(0, max(1, len(passage) - width + stride), stride):
        part = passage[at : at + width]
        asked = _in_order(question, part)
        answered = _in_order(answer[::-1], part[::-1])[::-1]
        best = max(best, max((q + a, q, a) for q, a in zip(asked, answered, strict=True)))
        if best[0] == size:
            break
    return best[1] / len(question) if question else best[2] / len(answer), best[2] / len(answer)


def holds(item: list[str], asked: float, answered: float) -> bool:
    question, answer = map(len, _split(item))
    lacking = round(answer * (1 - answered))
    whole = question + answer - round(question * (1 - asked)) - lacking
    return asked >= OVERLAP and lacking < answer and lacking <= max(EDITS, (1 - OVERLAP) * answer) and whole >= OVERLAP * len(item)


def parts(items: DataFrame, key: str, text: str) -> Iterator[Index]:
    """The index in parts of bounded size; frequencies are those of all items."""
    rows = items.select(F.col(key).alias("id"), F.col(text).alias("text"))
    split = F.filter(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0)), lambda w: w != "")
    rows = rows.withColumn("n", F.size(split)).where("n > 0")
    facts = rows.agg(F.count("*"), F.max("n"), F.avg("n"), F.sum(F.octet_length("text"))).first()
    if not facts[0]:
        return
    needed = -(-facts[3] // PART_BYTES)
    counted = rows.select(F.explode(F.array_distinct(split)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    for part in range(needed):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(needed)) == part)
        held = [(r["id"], words(r["text"])) for r in own.select("id", "text").collect()]
        held = [x for x in held if x[1]]
        if not held:
            continue
        used = own.select(F.explode(F.array_distinct(split)).alias("w")).distinct()
        frequency = {r["w"]: r["n"] for r in counted.join(used, "w").collect()}
        # Words that the two engines split or fold differently count as rare.
        frequency |= {w: 1 for _, found in held for w in found if w not in frequency}
        yield Index.build(held, frequency, facts[0], facts[2], facts[1])


def _held(index: Index, text: str | None) -> dict[int, tuple[float, float, float]]:
    """Verified items of a text, each with its best (score, question and answer overlap)."""
    best: dict[int, tuple] = {}
    for at, score, _, passage in index.search(text):
        asked, answered = overlaps(index.items[at], passage)
        if holds(index.items[at], asked, answered):
            best[at] = max(best.get(at, ()), (score, asked, answered))
    return best


def clean(documents: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``documents`` without the rows that hold an item."""
    for index in parts(items, item_key, item_text):
        sent = documents.sparkSession.sparkContext.broadcast(index)

        def work(rows: list[dict], sent=sent) -> list[tuple]:
            return [(len(_held(sent.value, row[text])),) for row in rows]

        documents = add_columns(documents, [text], work, "__items int").where(F.col("__items") == 0).drop("__items")
    return documents


def matches(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, score, question_overlap, answer_overlap): one row per document row and item it holds."""
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id bigint, score double, question_overlap double, answer_overlap double"
    found = []
    for index in parts(items, item_key, item_text):
        sent = documents.sparkSession.sparkContext.broadcast(index)

        def work(row: dict, sent=sent) -> Iterator[tuple]:
            for at, values in sorted(_held(sent.value, row[text]).items()):
                yield row[key], sent.value.ids[at], *values

        found.append(map_rows(documents.select(key, text), work, schema))
    if not found:
        return documents.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def op8_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
