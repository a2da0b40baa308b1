"""Token counts of whole texts by a two-tier table of pre-token lengths, on the map side.

A pre-token is encoded on its own, so its number of tokens (its length) depends on nothing else
and a text's count is the sum over its pre-tokens. A small table of frequent
pre-tokens and their lengths is made once and broadcast. Pre-tokens that it lacks are encoded by the
library and remembered in a bounded cache of the worker, which lives as long as the worker
does. Pre-tokens are never shuffled.

The table only saves time: any table, an empty one too, gives the same counts. It is
made of about ``SAMPLE`` rows and holds ``HEAD`` pre-tokens of at most ``SHORT`` characters, so
what is broadcast is below 10 MB whatever the corpus.

Texts are split as the tokenizer file says. Special strings (``<|endoftext|>`` and the like) count as
one token each and separate what is before and after them, as is the library's default. For the usual
letters the file's rules are followed here; a text with letters for which Unicode versions
or contexts could differ is normalised and split by the library itself.

Null and empty texts, and texts of white space, have no tokens. Repeated rows stay repeated
rows. Extra columns are set aside. A long text is split piece by piece, never cut.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import islice

import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from cdcmart.llm.common import empty_if_null, map_rows, ship, table

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Rows that the table of frequent pre-tokens is made of, its size, and the longest pre-token in it or in a cache.
SAMPLE, HEAD, SHORT = 2_000, 32_768, 64
#: Pre-tokens a worker remembers before it starts anew.
REMEMBERED = 1 << 18
#: Characters from which a text's pre-tokens are counted one by one instead of being listed.
LONG = 1 << 20

# The rules of the tokenizer file that ``_fast`` follows.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: White space as the file's rules see it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")


class Rules:
    """A tokenizer file: its special strings, its pre-tokens, and the length of each."""

    def __init__(self, name: str):
        path = public_tokenizers.path(name)
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        added = told["added_tokens"]
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
            raise ValueError(f"{name}: special strings that depend on their surroundings are not supported")
        self.special = regex.compile("|".join(regex.escape(x["content"]) for x in added)) if added else None
        steps = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.known = (
            (told["normalizer"] or {}).get("normalizers") == _NORMALIZER
            and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": _SPLIT}
            and (steps[0]["behavior"], steps[0]["invert"], steps[1]["use_regex"], steps[1]["add_prefix_space"]) == ("Removed", True, False, False)
        )
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False)

    def length(self, piece: str) -> int:
        """Tokens of a pre-token that ``pieces`` gave."""
        coded = self.bytes.pre_tokenize_str(piece)[0][0] if self.known else piece
        return len(self.library.model.tokenize(coded))

    def pieces(self, part: str) -> Iterator[str] | list[str]:
        """Pre-tokens of text between special strings."""
        if self.known and (part.isascii() or not any(map(_odd, set(part)))):
            part = unicodedata.normalize("NFC", part).lower()
            return _PIECES.findall(part) if len(part) < LONG else (m[0] for m in _PIECES.finditer(part))
        if self.library.normalizer is not None:
            part = self.library.normalizer.normalize_str(part)
        if self.library.pre_tokenizer is None:
            return [part] if part else []
        found = self.library.pre_tokenizer.pre_tokenize_str(part)
        return [part[a:b] for _, (a, b) in found] if self.known else [coded for coded, _ in found]

    def parts(self, text: str) -> tuple[list[str], int]:
        """Text between special strings, and how many of these there are."""
        if self.special is None or "<" not in text and self.known:
            return [text], 0
        parts = self.special.split(text)
        return parts, len(parts) - 1


@lru_cache(1 << 14)
def _odd(letter: str) -> bool:
    """Letters unknown to some Unicode versions, and that whose small form depends on its place."""
    return letter == "Σ" or unicodedata.category(letter) == "Cn"


@cache
def rules(name: str) -> Rules:
    return Rules(name)


class Lengths(dict):
    """The worker's cache: lengths of pre-tokens that the broadcast table lacks."""

    def __init__(self, name: str):
        super().__init__()
        self.rules = rules(name)

    def __missing__(self, piece: str) -> int:
        found = self.rules.length(piece)
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = found
        return found


@cache
def _lengths(name: str) -> Lengths:
    return Lengths(name)


def count(text: str, name: str, head: dict[str, int]) -> int:
    """Tokens of a text; ``head`` are the lengths of frequent pre-tokens."""
    own, cached = rules(name), _lengths(name)
    parts, total = own.parts(text)
    for part in parts:
        pieces = iter(own.pieces(part))
        while some := list(islice(pieces, LONG)):
            found = list(map(head.get, some))
            missed = (piece for piece, length in zip(some, found, strict=True) if length is None) if None in found else ()
            total += sum(filter(None, found)) + sum(map(cached.__getitem__, missed))
    return total


def frequent(texts: DataFrame, text: str = "text", name: str = TOKENIZER, head: int = HEAD, sample: int = SAMPLE) -> dict[str, int]:
    """Lengths of the ``head`` most frequent pre-tokens of about ``sample`` rows."""
    rows = texts.count()
    if not rows:
        return {}

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = rules(name), Counter()
        for batch in batches:
            for value in batch.column(0):
                for part in own.parts(value.as_py())[0]:
                    seen.update(piece for piece in own.pieces(part) if len(piece) <= SHORT)
                if len(seen) > 32 * head:
                    seen = Counter(dict(seen.most_common(8 * head)))
        found = [piece for piece, _ in seen.most_common(head)]
        yield pa.RecordBatch.from_pydict({"piece": pa.array(found, pa.string()), "length": pa.array(map(own.length, found), pa.int64())})

    ship(texts.sparkSession)
    drawn = texts.select(F.col(text).alias("text")).where(F.col(text).isNotNull())
    drawn = drawn.sample(min(1.0, sample / rows), 11) if rows > sample else drawn
    told = drawn.repartition(1).mapInArrow(most, "piece string, length bigint").collect()
    return {row.piece: row.length for row in told}


def counted(frame: DataFrame, key: str = "doc_id", text: str = "text", name: str = TOKENIZER, limit: int = LIMIT, head: dict[str, int] | None = None) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row."""
    spark = frame.sparkSession
    shared: Broadcast = spark.sparkContext.broadcast(frequent(frame, text, name) if head is None else head)

    def work(row: dict) -> Iterator[tuple]:
        yield row["key"], row["n_bytes"], count(row["text"], name, shared.value)

    rows = frame.select(F.col(key).alias("key"), F.octet_length(empty_if_null(F.col(text))).cast("long").alias("n_bytes"), empty_if_null(F.col(text)).alias("text"))
    told = map_rows(rows, work, f"key {frame.schema[key].dataType.simpleString()}, n_bytes bigint, n_tokens bigint", slice_rows=4096)
    return told.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    return counted(table(spark, sf_dir, "documents"))
