import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cdcmart.llm import ranked
from cdcmart.llm.ranked import Best, build, pack, search, terms, unpack

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(SMALL))


def brute(docs: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    bags = [(key, Counter(split(text))) for key, text in docs if split(text)]
    n, size = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    rows = []
    for item, text in items:
        scores = []
        for key, bag in bags:
            m = 50 + (50 * sum(bag.values()) * n) // size
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(split(text))
                if t in bag
            )
            if score > 0:
                scores.append((-score, -math.inf if key is None else key))
        rows += [(item, i + 1, None if key == -math.inf else int(key), -score) for i, (score, key) in enumerate(sorted(scores)[:k])]
    return rows


def random_texts(n: int, seed: int, words: int = 60) -> list[str]:
    draw = np.random.default_rng(seed)
    names = [f"{'Wß'[i % 2]}{i}" for i in range(words)]
    return [" ".join(names[min(int(draw.exponential(8)), words - 1)] for _ in range(int(draw.integers(0, 40)))) for _ in range(n)]


def test_terms_are_those_of_the_pattern(monkeypatch):
    texts = ["", "A-b ÀÉ_é x\x00y", None, "日本 語,Z9`{|}~\x7f", "end", "end"]
    for piece in (1 << 20, 3):
        monkeypatch.setattr(ranked, "PIECE", piece)
        seen = Counter()
        for owner, hashes, times in terms(pa.array(texts)):
            for o, h, t in zip(owner.tolist(), hashes.tolist(), times.tolist(), strict=True):
                seen[o, h] += t
        for i, text in enumerate(texts):
            assert sorted(c for (o, _), c in seen.items() if o == i) == sorted(Counter(split(text)).values())
    assert len({h for (_, h) in seen}) == len({t for text in texts for t in split(text)})


@pytest.mark.parametrize("shape", [(1, 1), (1, 9), (9, 1), (5, 5), (40, 7), (7, 40), (64, 64)])
def test_a_treap_holds_every_point_and_finds_the_best(shape):
    draw = np.random.default_rng(sum(shape))
    spots = np.flatnonzero(draw.random(shape[0] * shape[1]) < 0.4)
    spots = spots if len(spots) else np.array([0])
    rows, columns = spots // shape[1], spots % shape[1]
    impacts = draw.integers(1, 50, len(spots))
    treap = unpack(pack(build(rows, columns, impacts, *shape)), build(rows, columns, impacts, *shape).splits)
    grid = np.zeros(shape, np.int64)
    grid[rows, columns] = impacts
    keys = draw.permutation(shape[1]).astype(np.int64)
    for k in (1, 3, 100):
        own = np.flatnonzero(draw.random(shape[0]) < 0.6)
        weights = draw.integers(0, 4, len(own))
        best = Best(k)
        search(treap, own, weights, keys, best, group=2)
        scores = weights @ grid[own]
        want = sorted((-s, key) for s, key in zip(scores.tolist(), keys.tolist(), strict=True) if s > 0)[:k]
        assert sorted(zip((-best.scores).tolist(), best.keys.tolist(), strict=True)) == want


def test_bounds_leave_most_ranges_out():
    """One document has all the rare terms: the search goes straight to it."""
    draw = np.random.default_rng(3)
    grid = (draw.random((256, 1024)) < 0.05) * draw.integers(1, 20, (256, 1024))
    grid[100:120, 700] = 1000
    rows, columns = np.nonzero(grid)
    treap = build(rows, columns, grid[rows, columns], *grid.shape)
    best = Best(1)
    assert search(treap, np.arange(100, 120), np.ones(20, np.int64), np.arange(1024), best, group=1) < 40
    assert best.keys.tolist() == [700]


@pytest.mark.parametrize("blocks", [(8192, 2_000_000), (70, 90)])
def test_ranked_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", blocks[0])
    monkeypatch.setattr(ranked, "BLOCK_POINTS", blocks[1])
    texts = random_texts(400, 1)
    docs = [(i // 2 if i % 50 else None, text, i) for i, text in enumerate(texts)]  # repeated and null keys
    docs += [(1000 + i, texts[7], i) for i in range(90)] + [(5000, None, 0), (5001, "", 0), (5002, "-- !", 0), (5003, "w1 " * 30_000, 0)]
    items = [(i, text) for i, text in enumerate(random_texts(12, 2, 70))] + [(90, None), (91, "..."), (92, "unknown words"), (3, "w1 w1 ß3")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, score int").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    found = ranked.ranked(frame, asked, k=20)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute([d[:2] for d in docs], items, 20)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))


def test_items_searched_in_turns_give_the_same(spark, monkeypatch):
    docs, items = list(enumerate(random_texts(150, 4))), list(enumerate(random_texts(9, 5)))
    frame, asked = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(ranked, "PAIRS", 30)
    assert sorted(map(tuple, ranked.ranked(frame, asked, k=5).collect())) == sorted(brute(docs, items, 5))


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert ranked.ranked(docs, items).collect() == []
    wordless = spark.createDataFrame([(1, "--"), (2, None)], "doc_id bigint, text string")
    assert ranked.ranked(wordless, items).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id bigint, text string")
    assert ranked.ranked(some, items.limit(0)).collect() == []
    assert [r.doc_id for r in ranked.ranked(some, items).collect()] == [r[2] for r in brute([(1, "a b"), (2, "a")], [(1, "a")], 50)]
