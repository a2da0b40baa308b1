"""Byte-level BPE over long texts: overlapping chunks, stitched where their boundaries meet.

A text longer than a chunk is cut into chunks that overlap. Each chunk is split into
pre-tokens on its own, so its first boundaries may be wrong: it may start inside a
pre-token. Splitting runs left to right and never looks back, so from the first boundary
that two neighbours share both go on alike. The neighbours are joined there: what lies
before comes from the earlier chunk, what follows from the later one. A cut never follows
white space, whose split depends on what comes next. Where the overlap holds no common
boundary (one pre-token fills it) the two chunks stay one piece. Pieces are then encoded
independently, and a text's ids are those of its pieces in order. A text of one chunk is
one piece.

Null and empty texts have no ids. Repeated long texts are encoded once; rows with equal
keys and texts are kept. Extra columns are set aside.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcmart.llm.common import empty_if_null, map_rows, table, text_key

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK, OVERLAP = 1 << 16, 1 << 10  # characters

# --- one text, chunk or piece -----------------------------------------------------------


@cache
def _ranks(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def _encoding(name: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(name), special_tokens={})


@cache
def _tokens(name: str) -> list[bytes]:
    ranks = _ranks(name)
    found = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        found[rank] = token
    return found


_pattern = cache(regex.compile)


def boundaries(text: str, last: bool) -> list[int]:
    """Starts of pre-tokens at which a cut is safe; the unfinished end of a chunk has none."""
    found = [m.start() for m in _pattern(public_tokenizers.PATTERN).finditer(text)]
    if not last:
        # The pre-token that touches the chunk's end may go on behind it.
        found = found[:-1]
    return [at for at in found if at == 0 or not text[at - 1].isspace()]


def cut(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str]]:
    step, k = chunk - overlap, 0
    while True:
        yield k, text[k * step : k * step + chunk]
        k += 1
        if k * step + overlap >= len(text):
            return


# --- frames -----------------------------------------------------------------------------


def chunks(texts: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(digest, k, body, head, tail) of (digest, text): chunks and their boundaries in the overlaps.

    ``head`` counts from the chunk's start, ``tail`` from the start of the next chunk.
    """
    step = chunk - overlap

    def work(row: dict) -> Iterator[tuple]:
        text = row["text"]
        for k, body in cut(text, chunk, overlap):
            last = k * step + chunk >= len(text)
            found = boundaries(body, last)
            head = [at for at in found if at <= overlap] if k else []
            tail = [at - step for at in found if at >= step] if not last else []
            yield row["digest"], k, body, head, tail

    return map_rows(texts.select("digest", "text"), work, "digest binary, k int, body string, head array<int>, tail array<int>")


def pieces(parts: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(digest, piece, text): chunks stitched at the first boundary they share with the one before."""
    step = chunk - overlap
    order = W.partitionBy("digest").orderBy("k")
    own = F.array_intersect("head", F.lag("tail").over(order))
    met = parts.withColumn("start", F.when(F.col("k") == 0, 0).otherwise(F.get(F.array_sort(own), F.lit(0))))
    named = (
        met.withColumn("piece", F.sum(F.when(F.col("start").isNotNull(), 1).otherwise(0)).over(order))
        .withColumn("next", F.lead(F.coalesce("start", F.lit(0))).over(order))
        .withColumn("start", F.coalesce("start", F.lit(0)))
    )
    end = F.coalesce(F.col("next") + step, F.char_length("body"))
    body = F.substring("body", F.col("start") + 1, end - F.col("start"))
    parts = F.array_sort(F.collect_list(F.struct("k", body.alias("body"))))
    return named.groupBy("digest", "piece").agg(F.array_join(F.transform(parts, lambda p: p["body"]), "").alias("text"))


def _encode(frame: DataFrame, ranks: str, kept: dict[str, str]) -> DataFrame:
    names = list(kept)

    def work(row: dict) -> Iterator[tuple]:
        ids = np.asarray(_encoding(ranks).encode_ordinary(row["text"]), np.int32)
        yield *[row[name] for name in names], ids

    schema = ", ".join(f"`{name}` {kind}" for name, kind in kept.items()) + ", ids array<int>"
    return map_rows(frame.select(*names, "text"), work, schema)


def encode(frame: DataFrame, key: str, text: str = "text", ranks: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, ids) of each row's whole text."""
    kind = frame.schema[key].dataType.simpleString()
    rows = frame.select(F.col(key).alias("key"), empty_if_null(F.col(text)).alias("text"))
    short = _encode(rows.where(F.char_length("text") <= chunk), ranks, {"key": kind})
    long = rows.where(F.char_length("text") > chunk).withColumn("digest", text_key(F.col("text")))
    once = long.select("digest", "text").dropDuplicates(["digest"])
    done = _encode(pieces(chunks(once, chunk, overlap), chunk, overlap), ranks, {"digest": "binary", "piece": "bigint"})
    whole = done.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
    whole = whole.select("digest", F.flatten("parts.ids").alias("ids"))
    rest = long.select("key", "digest").join(whole, "digest").select("key", "ids")
    return short.unionByName(rest).withColumnRenamed("key", key)


def decode(frame: DataFrame, key: str, ranks: str = RANKS) -> DataFrame:
    """(key, ids, raw): the tokens' bytes concatenated. An id without a token is an error."""
    kind = frame.schema[key].dataType.simpleString()

    def work(row: dict) -> Iterator[tuple]:
        token = _tokens(ranks).__getitem__
        yield row[key], row["ids"], b"".join(map(token, row["ids"]))

    return map_rows(frame.select(key, "ids"), work, f"`{key}` {kind}, ids array<int>, raw binary", slice_rows=64)


def digests(frame: DataFrame) -> DataFrame:
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return frame.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text encoded, decoded and digested."""
    return digests(decode(encode(table(spark, sf_dir, "documents"), "doc_id"), "doc_id"))
