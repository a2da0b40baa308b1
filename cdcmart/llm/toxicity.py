"""Toxicity by a classifier chain.

Categories are predicted one after another; each linear model sees the text's features and
the probabilities of the categories before it. For training, those probabilities are
out-of-fold predictions, so that a later model learns from errors as they will occur.

Features are the presence of words and of the first characters of words (compounds of a
rude stem share them), the ``FEATURES`` most telling per category by chi-square. Models are fitted
on a sample of labelled rows: at most ``POSITIVE`` rows of the last category and ``NEGATIVE``
others, the least by a hash of their id. This bounds what is collected and broadcast.

A text falls into the last category from the probability on at which the out-of-fold
predictions have the best F1. Null and empty texts have no features; their probability is that of the intercept. Without
labels of both kinds for a category its probability is the share seen, 0 without labels.
Rows with a null label take no part in training; of repeated labels the largest counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.llm.common import add_columns, cut_lineage, table

#: (category, SQL over the label columns), in the order of the chain.
CATEGORIES = (("junk", "quality = 0"), ("toxic", "toxic = 1"))
POSITIVE, NEGATIVE = 6_000, 14_000
FEATURES, LEAST_ROWS = 1_000, 4
FOLDS, REGULAR, ROUNDS, STEPS = 3, 1e-4, 12, 25
#: The threshold is not set below this: folds share the choice of features, which flatters them.
LEAST = 0.25
_WORDS = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> set[str]:
    """Words and word starts of 4 and 5 characters, marked by how long they are."""
    words = set(_WORDS.findall((text or "").lower()))
    return words | {f"{w[:4]}~" for w in words if len(w) > 4} | {f"{w[:5]}~" for w in words if len(w) > 5}


@dataclass(frozen=True)
class Chain:
    """Per category: intercept, feature weights, weights of earlier probabilities."""

    categories: tuple[str, ...]
    vocabulary: dict[str, int]
    weights: np.ndarray  # category x (1 + features + earlier categories)
    threshold: float = 0.5  # of the last category

    def probabilities(self, text: str | None) -> list[float]:
        known = [i for i in map(self.vocabulary.get, tokens(text)) if i is not None]
        size, found = len(self.vocabulary), []
        for row in self.weights:
            logit = row[0] + row[1:][known].sum() + float(np.dot(row[1 + size : 1 + size + len(found)], found))
            found.append(float(1 / (1 + np.exp(-np.clip(logit, -500, 500)))))
        return found


def sample(labels: DataFrame, key: str, categories: tuple[tuple[str, str], ...]) -> DataFrame:
    """(key, one 0/1 column per category) of the rows to fit on; bounded."""
    flags = [F.max(F.expr(f"CAST({rule} AS INT)")).alias(f"y{i}") for i, (_, rule) in enumerate(categories)]
    each = labels.groupBy(F.col(key).alias("__id")).agg(*flags).dropna()
    last = F.col(f"y{len(categories) - 1}")
    order = F.xxhash64("__id"), F.col("__id")
    return each.where(last == 1).orderBy(*order).limit(POSITIVE).unionByName(each.where(last == 0).orderBy(*order).limit(NEGATIVE))


def _counts(rows: DataFrame, n: int) -> DataFrame:
    """(token, rows, rows per category): counted per task first."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_rows: Counter[str] = Counter()
        positive = [Counter() for _ in range(n)]

        def flush() -> Iterator[pa.RecordBatch]:
            names = list(all_rows)
            for at in range(0, len(names), 20_000):
                part = names[at : at + 20_000]
                yield pa.RecordBatch.from_pydict(
                    {"token": part, "n": [all_rows[x] for x in part], "p": [[c[x] for c in positive] for x in part]}
                )
            all_rows.clear()
            for c in positive:
                c.clear()

        for batch in source:
            for row in batch.to_pylist():
                found = tokens(row["__text"])
                all_rows.update(found)
                for i, c in enumerate(positive):
                    if row[f"y{i}"]:
                        c.update(found)
                if len(all_rows) > 200_000:
                    yield from flush()
        yield from flush()

    each = rows.mapInArrow(count, "token string, n bigint, p array<bigint>")
    return each.groupBy("token").agg(F.sum("n").alias("n"), *[F.sum(F.get("p", F.lit(i))).alias(f"p{i}") for i in range(n)])


def fit(documents: DataFrame, labels: DataFrame, categories: tuple[tuple[str, str], ...] = CATEGORIES, key: str = "doc_id", text: str = "text") -> Chain:
    names, n = tuple(name for name, _ in categories), len(categories)
    chosen = cut_lineage(sample(labels, key, categories))
    shares = chosen.agg(F.count("*"), *[F.coalesce(F.sum(f"y{i}"), F.lit(0)) for i in range(n)]).first()
    total = shares[0]
    # The sample has POSITIVE + NEGATIVE rows at most, so it fits every task.
    rows = documents.select(F.col(key).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
    vocabulary: list[str] = []
    if total:
        counted = cut_lineage(_counts(rows, n).where(F.col("n") >= LEAST_ROWS))
        for i in range(n):
            p, q = F.col(f"p{i}"), F.lit(float(shares[1 + i]))
            off = p * F.lit(float(total)) - F.col("n") * q
            chi = off * off / (F.col("n") * (F.lit(float(total)) - F.col("n") + 1e-9) * q * (F.lit(float(total)) - q) + F.lit(1e-9))
            vocabulary += [r[0] for r in counted.orderBy(chi.desc(), "token").limit(FEATURES).select("token").collect()]
    index = {token: i for i, token in enumerate(dict.fromkeys(vocabulary))}
    weights = np.zeros((n, 1 + len(index) + n))
    if not index:
        weights[:, 0] = [_logit(s / total if total else 0.0) for s in shares[1:]]
        return Chain(names, index, weights)

    def present(found: list[dict]) -> list[tuple]:
        return [(sorted(index[t] for t in tokens(row["__text"]) if t in index),) for row in found]

    flags = [f"y{i}" for i in range(n)]
    marked = add_columns(rows.select("__id", "__text", *flags), ["__text"], present, "known array<int>")
    marked = marked.withColumn("fold", F.pmod(F.xxhash64("__id", F.lit("fold")), F.lit(FOLDS)))
    # POSITIVE + NEGATIVE rows at most.
    data = marked.select("known", "fold", *flags).toArrow()
    held, folds = Rows.of(data.column("known").to_pylist(), len(index)), data.column("fold").to_numpy()
    for i in range(n):
        labels_ = data.column(f"y{i}").to_numpy().astype(float)
        found = _linear(held, labels_)
        weights[i, : len(found)] = found
        out = np.zeros(len(labels_))
        for fold in range(FOLDS):
            own = folds == fold
            if own.any() and not own.all():
                out[own] = _sigmoid(held.only(own).logits(_linear(held.only(~own), labels_[~own])))
        held = held.beside(out)
    return Chain(names, index, weights, _threshold(out, labels_))


@dataclass(frozen=True)
class Rows:
    """Sparse 0/1 features and dense columns of the sampled rows."""

    at: np.ndarray  # feature numbers, row after row
    row: np.ndarray  # the row of each
    dense: np.ndarray
    size: int

    @staticmethod
    def of(known: list[list[int]], size: int) -> Rows:
        counts = [len(x) for x in known]
        at = np.fromiter((i for x in known for i in x), np.int64, sum(counts))
        return Rows(at, np.repeat(np.arange(len(known)), counts), np.zeros((len(known), 0)), size)

    def only(self, mask: np.ndarray) -> Rows:
        number, own = np.cumsum(mask) - 1, mask[self.row]
        return Rows(self.at[own], number[self.row[own]], self.dense[mask], self.size)

    def beside(self, column: np.ndarray) -> Rows:
        return Rows(self.at, self.row, np.c_[self.dense, column], self.size)

    def logits(self, w: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.row, w[1:][self.at], len(self.dense))
        return w[0] + sparse + self.dense @ w[1 + self.size :]

    def gathered(self, of_rows: np.ndarray) -> np.ndarray:
        """The transposed product, with the intercept first."""
        return np.r_[of_rows.sum(), np.bincount(self.at, of_rows[self.row], self.size), of_rows @ self.dense]


def _threshold(said: np.ndarray, y: np.ndarray) -> float:
    """Where the out-of-fold predictions have the best F1; the middle of the gap below."""
    order = np.argsort(-said, kind="stable")
    ranked, hits = said[order], np.cumsum(y[order])
    if not len(y) or not hits[-1]:
        return 0.5
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + hits[-1])
    f1[:-1][ranked[1:] == ranked[:-1]] = 0  # ties fall on one side
    best = int(f1.argmax())
    middle = float((ranked[best] + (ranked[best + 1] if best + 1 < len(y) else 0.0)) / 2)
    return min(max(middle, LEAST), 0.5)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _logit(share: float) -> float:
    share = min(max(share, 1e-12), 1 - 1e-12)
    return float(np.log(share / (1 - share)))


def _linear(rows: Rows, y: np.ndarray) -> np.ndarray:
    """Intercept and weights of a ridge-penalised logistic regression.

    Newton steps, each solved by conjugate gradients; the share alone where only one class is seen.
    """
    w = np.zeros(1 + rows.size + rows.dense.shape[1])
    share = float(y.mean()) if len(y) else 0.0
    w[0] = _logit(share)
    if share in (0.0, 1.0):
        return w
    penalty = np.full(len(w), REGULAR * len(y))
    penalty[0] = 0.0
    for _ in range(ROUNDS):
        p = _sigmoid(rows.logits(w))
        slope = rows.gathered(y - p) - penalty * w
        curve = p * (1 - p)
        step, rest = np.zeros(len(w)), slope.copy()
        way, size = rest.copy(), float(rest @ rest)
        start = size
        for _ in range(STEPS):
            if size <= 1e-4 * start or size < 1e-12:
                break
            bent = rows.gathered(curve * rows.logits(way)) + (penalty + 1e-9) * way
            length = size / float(way @ bent)
            step, rest = step + length * way, rest - length * bent
            size, before = float(rest @ rest), size
            way = rest + size / before * way
        w = w + step
        if np.abs(step).max() < 1e-3:
            break
    return w


def score(documents: DataFrame, chain: Chain, text: str = "text", prefix: str = "p_") -> DataFrame:
    """``documents`` with a probability per category."""
    schema = ", ".join(f"`{prefix}{name}` double" for name in chain.categories)

    def work(rows: list[dict]) -> list[tuple]:
        return [tuple(chain.probabilities(row[text])) for row in rows]

    return add_columns(documents, [text], work, schema)


def op4_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's probabilities, and whether it is toxic."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = fit(documents, labels)
    found = score(documents.select("doc_id", "text"), chain)
    return found.select("doc_id", "p_junk", "p_toxic", (F.col("p_toxic") >= chain.threshold).alias("toxic"))
