"""Language identification by words first, then by shorter and shorter character n-grams.

A word seen in training adds its log frequency in each language. A word never seen falls back
to its character n-grams, longest first: the first length with a known n-gram counts, by the
mean over its known n-grams. Words are runs of letters in lower case; n-grams see a mark at
both ends of a word.

All training rows are counted and all counts are used. Tasks receive the head: a language's most
frequent words and per length its most frequent n-grams, as many whole levels of frequency as fit
in ``WORDS`` and ``GRAMS``, with their counts in every language. Its bound does not follow the data,
and no task ranks all words. What a text holds besides is joined with the full tables. Null texts and texts without a letter are ``und`` with score 0, and
so is every text if nothing was learnt. Ties go to the language that sorts first. Rows with a
null language are not learnt from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcmart.llm.common import add_columns, cut_lineage, map_rows, ship, table

WORDS, GRAMS, LONGEST = 30_000, 10_000, 4
CACHE = 100_000  # words whose n-gram scores a task remembers
UNIT = 2.0**32  # joined scores are whole numbers of 1 / UNIT, so that sums do not depend on their order
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


@dataclass(frozen=True)
class Model:
    """The head of the counts, and for ``identify`` the tables of all."""

    languages: tuple[str, ...]
    words: dict[str, int]  # row of ``word_scores``
    word_scores: np.ndarray  # log frequencies, a column per language
    grams: tuple[dict[str, int], ...]  # by length - 1
    gram_scores: tuple[np.ndarray, ...]
    known: dict[str, np.ndarray] = field(default_factory=dict, compare=False)
    all_words: DataFrame | None = field(default=None, compare=False)  # word, s0, s1 .. per language
    all_grams: DataFrame | None = field(default=None, compare=False)  # size, gram, s0, s1 ..

    def unseen(self, word: str) -> np.ndarray:
        """Kept for words to come, as long as they are few."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[word] = self._unseen(word)
        return found

    def _unseen(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            known = [i for i in map(self.grams[n - 1].get, grams(word, n)) if i is not None]
            if known:
                return self.gram_scores[n - 1][known].mean(0)
        return np.zeros(len(self.languages))

    def head(self, text: str | None) -> tuple[list[float] | None, list[tuple[str, int]]]:
        """Sums over the head's words, None without words; and all other words with their numbers."""
        found = words(text)
        if not found:
            return None, []
        rows = np.fromiter(map(self.words.get, found, repeat(-1)), np.int64, len(found))
        total = self.word_scores[rows[rows >= 0]].sum(0, dtype=np.float64)
        return total.tolist(), list(Counter(found[at] for at in np.flatnonzero(rows < 0)).items())

    def pieces(self, word: str) -> Iterator[tuple[int, str | None, int, list[int] | None]]:
        """(size, n-gram, 1, None) to be looked up, and (size, None, number, sums) of the head's.

        Lengths end at the first of which the head has an n-gram: shorter ones cannot count.
        """
        for n in range(LONGEST, 0, -1):
            rows = [(gram, self.grams[n - 1].get(gram)) for gram in grams(word, n)]
            yield from ((n, gram, 1, None) for gram, at in rows if at is None)
            known = [at for _, at in rows if at is not None]
            if known:
                sums = self.gram_scores[n - 1][known].sum(0, dtype=np.float64)
                yield n, None, len(known), np.rint(sums * UNIT).astype(np.int64).tolist()
                return

    def predict(self, text: str | None) -> tuple[str, float]:
        """By the head alone; ``identify`` uses all counts."""
        found = words(text)
        if not found or not self.languages:
            return UNKNOWN, 0.0
        rows = np.fromiter(map(self.words.get, found, repeat(-1)), np.int64, len(found))
        total = self.word_scores[rows[rows >= 0]].sum(0, dtype=np.float64)
        other = [self.unseen(found[at]) for at in np.flatnonzero(rows < 0)]
        if other:
            total = total + np.sum(other, axis=0, dtype=np.float64)
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def _word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n), counted per task first."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter[str]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in found.items():
                names = list(counter)
                for at in range(0, len(names), 20_000):
                    part = names[at : at + 20_000]
                    yield pa.RecordBatch.from_pydict({"lang": [lang] * len(part), "word": part, "n": [counter[x] for x in part]})
            found.clear()

        for batch in source:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    found.setdefault(row["lang"], Counter()).update(words(row["text"]))
                if sum(map(len, found.values())) > 250_000:
                    yield from flush()
        yield from flush()

    each = rows.mapInArrow(count, "lang string, word string, n bigint")
    return each.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _gram_counts(counted: DataFrame) -> DataFrame:
    """(lang, size, gram, n) from word counts."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, int, str]] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            items = list(found.items())
            for at in range(0, len(items), 20_000):
                part = items[at : at + 20_000]
                yield pa.RecordBatch.from_pydict(
                    {"lang": [k[0] for k, _ in part], "size": pa.array([k[1] for k, _ in part], pa.int32()),
                     "gram": [k[2] for k, _ in part], "n": [v for _, v in part]}
                )
            found.clear()

        for batch in source:
            for lang, word, n in zip(*(batch.column(name).to_pylist() for name in ("lang", "word", "n")), strict=True):
                for size in range(1, LONGEST + 1):
                    for gram in grams(word, size):
                        found[lang, size, gram] += n
                if len(found) > 250_000:
                    yield from flush()
        yield from flush()

    each = counted.select("lang", "word", "n").mapInArrow(count, "lang string, size int, gram string, n bigint")
    return each.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def _table(rows: pa.Table, name: str, languages: list[str], totals: dict[str, float], kinds: int) -> tuple[dict[str, int], np.ndarray]:
    index: dict[str, int] = {}
    for token in rows.column(name).to_pylist():
        index.setdefault(token, len(index))
    counts = np.zeros((len(index), len(languages)))
    at = [index[x] for x in rows.column(name).to_pylist()]
    column = [languages.index(x) for x in rows.column("lang").to_pylist()]
    counts[at, column] = rows.column("n").to_numpy()
    whole = np.array([totals[lang] for lang in languages])
    return index, np.log((counts + 0.5) / (whole + 0.5 * kinds)).astype(np.float32)


def _scores(frame: DataFrame, key: list[str], languages: list[str], totals: Callable[[str], Column], kinds: int) -> DataFrame:
    """``key`` and a score per language, s0, s1 .., of every counted token."""
    counts = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(languages)]
    logs = [
        F.rint(F.log((F.col(f"n{i}") + 0.5) / (totals(lang) + 0.5 * kinds)) * UNIT).cast("bigint").alias(f"s{i}")
        for i, lang in enumerate(languages)
    ]
    return frame.groupBy(*key).agg(*counts).select(*key, *logs)


def fit(rows: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    ship(rows.sparkSession)
    learnt = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = cut_lineage(_word_counts(learnt))
    totals = {r["lang"]: float(r["n"]) for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)

    def most(frame: DataFrame, group: list[str], key: list[str], limit: int) -> pa.Table:
        """The tokens of the highest frequencies in any language, of a level all or none; with their counts in every language."""
        above = W.partitionBy(*group).orderBy(F.col("n").desc())
        levels = frame.groupBy(*group, "n").agg(F.count("*").alias("kinds"))
        levels = levels.withColumn("sum", F.sum("kinds").over(above)).where(F.col("sum") <= limit)
        least = levels.groupBy(*group).agg(F.min("n").alias("least"))
        # A row per language and length at most.
        kept = frame.join(F.broadcast(least), group).where("n >= least").select(*key).distinct()
        return frame.join(kept, key, "left_semi").toArrow()

    top = most(counted, ["lang"], ["word"], WORDS)
    known, scores = _table(top, "word", languages, totals, WORDS)
    pieces = cut_lineage(_gram_counts(counted))
    sums = pieces.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()
    short = most(pieces, ["lang", "size"], ["size", "gram"], GRAMS)
    of_size = {n: dict.fromkeys(languages, 0.0) | {r["lang"]: float(r["n"]) for r in sums if r["size"] == n} for n in range(1, LONGEST + 1)}
    tables = []
    for size, all_of in of_size.items():
        own = short.filter(pa.compute.equal(short.column("size"), size))
        tables.append(_table(own, "gram", languages, all_of, GRAMS))
    all_words = all_grams = None
    if languages:
        all_words = _scores(counted, ["word"], languages, lambda x: F.lit(totals[x]), WORDS)
        by_size = lambda x: F.element_at(F.array(*[F.lit(of_size[n][x]) for n in of_size]), F.col("size"))
        all_grams = _scores(pieces, ["size", "gram"], languages, by_size, GRAMS)
    return Model(tuple(languages), known, scores, tuple(t[0] for t in tables), tuple(t[1] for t in tables), all_words=all_words, all_grams=all_grams)


def _guesses(found: DataFrame, model: Model, sent) -> DataFrame:
    """(word, s0, s1 ..) of words never seen, by their longest known n-grams."""
    each = range(len(model.languages))

    def work(row: dict) -> Iterator[tuple]:
        for piece in sent.value.pieces(row["word"]):
            yield row["word"], *piece

    pieces = map_rows(found, work, "word string, size int, gram string, k bigint, s array<bigint>", slice_rows=8192)
    ready = pieces.where("gram IS NULL").select("word", "size", "k", *[F.get("s", F.lit(i)).alias(f"s{i}") for i in each])
    # The head is asked first, so the n-grams of many words are not joined.
    joined = pieces.where("gram IS NOT NULL").drop("s").join(model.all_grams, ["size", "gram"]).drop("gram")
    sums = ready.unionByName(joined).groupBy("word", "size").agg(F.sum("k").alias("k"), *[F.sum(f"s{i}").alias(f"s{i}") for i in each])
    best = sums.groupBy("word").agg(F.max_by(F.struct("k", *[f"s{i}" for i in each]), "size").alias("m"))
    return best.select("word", *[F.rint(F.col(f"m.s{i}") / F.col("m.k")).cast("bigint").alias(f"s{i}") for i in each])


def identify(frame: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``frame``, or its columns ``keep``, with lang_pred and score."""
    kept = [F.col(f"`{c}`") for c in (frame.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    if not model.languages:
        return frame.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = frame.sparkSession.sparkContext.broadcast(replace(model, known={}, all_words=None, all_grams=None))
    each = range(len(model.languages))

    def work(rows: list[dict]) -> list[tuple]:
        return [sent.value.head(row[text]) for row in rows]

    marked = add_columns(frame, [text], work, "__head array<double>, __rest array<struct<word: string, k: bigint>>")
    # Numbers are given once: what follows reads the rows as they were written.
    marked = cut_lineage(marked.select(*kept, "__head", "__rest", F.monotonically_increasing_id().alias("__row")))
    rest = marked.select("__row", F.explode("__rest").alias("r")).select("__row", "r.word", "r.k")
    new = rest.select("word").distinct().join(model.all_words, "word", "left_anti")
    parts = [rest.join(scores, "word") for scores in (model.all_words, _guesses(new, model, sent))]
    sums = parts[0].unionByName(parts[1]).groupBy("__row").agg(*[F.sum(F.col("k") * F.col(f"s{i}")).alias(f"__s{i}") for i in each])
    totals = F.array(*[F.get("__head", F.lit(i)) + F.coalesce(f"__s{i}", F.lit(0)) / UNIT for i in each])
    found = marked.join(sums, "__row", "left").withColumn("__totals", totals).withColumn("__best", F.array_max("__totals"))
    best = F.element_at(F.array(*[F.lit(x) for x in model.languages]), F.array_position("__totals", F.col("__best")).cast("int"))
    share = 1 / F.aggregate("__totals", F.lit(0.0), lambda total, x: total + F.exp(x - F.col("__best")))
    none = F.col("__head").isNull()
    return found.select(*kept, F.when(none, UNKNOWN).otherwise(best).alias("lang_pred"), F.when(none, 0.0).otherwise(share).alias("score"))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op9_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(documents.where(~held_out(F.col("doc_id"))))
    found = identify(documents.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
