import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cdcmart.llm import repeats, suffix


def test_suffix_arrays_and_prefixes_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(1)
    for trial in range(150):
        monkeypatch.setattr(suffix, "_SHORT", int(rng.choice([1, 2, 7, 32])))
        text = rng.integers(0, rng.integers(1, 6), rng.integers(1, 150))
        if trial % 3 == 0:
            text = np.concatenate([text, text[: len(text) // 2], text])
        plain = text.tolist()
        array = suffix.suffix_array(text)
        assert array.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        common = suffix.permuted_prefixes(text, array)
        for rank, at in enumerate(array):
            before, k = array[rank - 1], 0
            while rank and max(at, before) + k < len(plain) and plain[at + k] == plain[before + k]:
                k += 1
            assert common[at] == k


def brute(docs, length):
    bodies = [(k, (t or "").encode()) for k, t in docs]
    seen = Counter(b[i : i + length] for _, b in bodies for i in range(len(b) - length + 1))
    found = Counter()
    for key, b in bodies:
        covered = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = True
        kept = bytes(x for x, c in zip(b, covered, strict=False) if not c)
        runs = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        found[key, len(b), int(covered.sum()), runs, kept] += 1
    return found


def made(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(10, 120))) for _ in range(6)]
    docs = []
    for i in range(50):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("xyzw") for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(0, 8))]
        docs.append((i % 45, "".join(parts)))
    return [*docs, (100, None), (101, ""), (102, "a" * 500), (103, "ab" * 300), (104, docs[3][1]), (104, docs[3][1]), (None, docs[5][1] + "!")]


@pytest.mark.parametrize(("seed", "hot", "shard"), [(1, 10**6, 1 << 20), (2, 2, 1 << 20), (3, 10**6, 64)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, seed, hot, shard):
    """Also with every anchor hot, and with shards as small as they get."""
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
    docs = made(seed)
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, tid int, kept string")
    found = repeats.removed(frame, length=40, anchor=20, hot=hot).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == brute(docs, 40)


def test_long_texts_are_read_in_segments(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(0, 4, 5000).astype(np.uint8)

    def by_window():
        _, places, first, last = repeats.anchors(data, 60, 30)
        return {w: p for p, a, b in zip(places, first, last, strict=True) for w in range(a, b + 1)}

    whole = by_window()
    assert sorted(whole) == list(range(5000 - 60 + 1)) and all(0 <= p - w <= 30 for w, p in whole.items())
    monkeypatch.setattr(repeats, "_SEGMENT", 128)
    assert by_window() == whole


def test_characters_stay_whole(spark):
    shared = "é" * 30
    rows = [(b"1" * 16, ("x" + shared + "ü").encode()), (b"2" * 16, (shared + "y").encode())]
    frame = spark.createDataFrame(rows, "tid binary, body binary")
    kept = [bytes(r.kept).decode() for r in repeats.kept_parts(frame, 40, 20, characters=True).collect()]
    assert sorted(kept) == ["xü", "y"]


def test_query_on_the_sample_and_empty_table(spark, tmp_path):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    wanted = Counter((k, n, gone, runs, hashlib.sha256(kept).hexdigest()) for (k, n, gone, runs, kept), c in brute(docs, 400).items() for _ in range(c))
    found = repeats.op6_suffix_array(spark, "/root/testdata/sf0.001").collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == wanted
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert repeats.op6_suffix_array(spark, str(tmp_path)).count() == 0
