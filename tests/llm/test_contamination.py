import random
from collections import Counter

import pytest

from cdcmart.llm import contamination

rng = random.Random(7)
VOCABULARY = ["w%d" % i for i in range(900)] + ["the", "of", "and"] * 60


def some_words(n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


ITEMS = [(i, " ".join(some_words(rng.randint(12, 50)))) for i in range(60)]


def documents():
    rows = []
    for i in range(80):
        words = some_words(rng.randint(0, 400))
        if i % 4 == 0:
            at = rng.randint(0, len(words))
            item = ITEMS[rng.randrange(len(ITEMS))][1]
            words[at:at] = (item.upper().replace(" ", ", ") if i % 8 else item).split()
        rows.append((i % 70, " ".join(words), "x"))
    return rows


def brute(rows, items):
    plain = [(k, " ".join(contamination.words(t))) for k, t, *_ in rows]
    return sorted((k, i) for k, t in plain for i, x in items if x and f" {' '.join(contamination.words(x))} " in f" {t} ")


@pytest.mark.parametrize("part", [contamination.PART_BYTES, 1500])
def test_matches_equal_brute_force(spark, monkeypatch, part):
    """Also with an index of several parts."""
    monkeypatch.setattr(contamination, "PART_BYTES", part)
    rows = [*documents(), (500, None, "x"), (501, "", "x"), (502, "?!", "x"), (None, ITEMS[3][1], "x"), (503, ITEMS[3][1] * 1, "x"), (503, ITEMS[3][1], "x")]
    items = [*ITEMS, (200, None), (201, ""), (202, ITEMS[5][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = contamination.matches(docs, bench).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.item_id) for r in found), key=key) == sorted(brute([r for r in rows if r[0] is not None], items) + [(None, 3)], key=key)
    assert all(r.score > 0.99 and r.question_overlap == 1 for r in found)
    clean = contamination.clean(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == len(rows) - sum(1 for r in rows if brute([(0, *r[1:])], items))


def test_bounds_never_hide_an_item_above_the_threshold():
    frequency = Counter(w for _, t in ITEMS for w in set(t.split()))
    index = contamination.Index.build([(i, t.split()) for i, t in ITEMS], frequency, len(ITEMS), 30.0, 50)
    for _, text, _ in documents():
        words = contamination.words(text)
        wanted = set()
        for p in range(max(1, -(-len(words) // 50) - 1)):
            inside = {index.terms[w] for w in words[p * 50 : p * 50 + 100] if w in index.terms}
            for at in range(len(ITEMS)):
                score = sum(x for t, x in zip(*index.postings[at], strict=True) if t in inside)
                if score >= contamination.THRESHOLD:
                    wanted.add((at, p))
        assert {(at, p) for at, _, p, _ in index.search(text)} == wanted


def test_edited_items_are_found_and_topics_are_not():
    item = " ".join(some_words(40)).split()
    edited = item.copy()
    edited[3] = "changed"
    assert min(contamination.overlaps(item, ["a", *edited, "b"])) >= contamination.OVERLAP
    assert min(contamination.overlaps(item, sorted(item))) < contamination.OVERLAP


@pytest.mark.parametrize("size", [16, 18, 20, 24, 27, 30])
def test_one_and_two_edits_of_short_items_are_found(size):
    own = random.Random(size)
    items = [(i, [own.choice(VOCABULARY) for _ in range(size)]) for i in range(30)]
    frequency = Counter(w for _, x in items for w in set(x))
    index = contamination.Index.build(items, frequency, len(items), float(size), size)
    clean = [" ".join(own.choice(VOCABULARY) for _ in range(300)) for _ in range(30)]
    assert not any(contamination._held(index, text) for text in clean)
    answer = max(1, size // 5)
    for number, item in items:
        # Within the question; within the answer; one in each; two in each part as far as it has them.
        for places in ([size // 3], [size - 2], [size // 3, size - 2], [size // 4, size // 2], [size - answer, size - 1]):
            edited = item.copy()
            for at in places:
                edited[at] = "changed"
            text = " ".join([*clean[number].split()[:130], *edited, *clean[number].split()[130:]])
            assert number in {index.ids[at] for at in contamination._held(index, text)}, places
        gone = " ".join(item[: size - answer])
        assert number not in {index.ids[at] for at in contamination._held(index, f"{gone} other words follow here")}
        shuffled = own.sample(item, size)
        assert number not in {index.ids[at] for at in contamination._held(index, " ".join(shuffled))} or contamination._in_order(item, shuffled)[-1] >= 0.8 * size


def test_long_items_and_longest_common_subsequences():
    own = random.Random(3)
    for _ in range(60):
        a, b = ([own.choice("abcd") for _ in range(own.randint(0, 12))] for _ in "ab")
        rows = [[0] * (len(a) + 1)]
        for y in b:
            rows.append([0])
            for i, x in enumerate(a):
                rows[-1].append(rows[-2][i] + 1 if x == y else max(rows[-2][i + 1], rows[-1][i]))
        assert contamination._in_order(a, b) == [r[-1] for r in rows]
    item = ["v%d" % own.randrange(5000) for _ in range(1000)]
    spread = [w for i, x in enumerate(item) for w in ([x, "more"] if i % 9 == 0 else [x])]
    assert contamination.overlaps(item, ["x"] * 471 + spread + ["y"] * 300) == (1.0, 1.0)
    assert contamination.overlaps(item, [w for x in item for w in (x, "a", "b")])[1] < 0.8
    assert contamination.overlaps(["one"], ["a", "one"]) == (1.0, 1.0)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination.matches(docs, none).count() == 0 and contamination.clean(docs, none).count() == 1
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert contamination.op8_block_max(spark, str(tmp_path)).count() == 0
