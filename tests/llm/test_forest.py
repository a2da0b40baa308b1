import numpy as np
import pytest

from cdcmart.llm import forest
from cdcmart.llm.forest import nearest, op10_prefix_forest, usable


def brute(rows, queries, k):
    vectors = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    found = {}
    for i, v in queries:
        far = np.sqrt(((vectors - np.array(v)) ** 2).sum(1))
        order = [o for o in np.lexsort((ids, far)) if ids[o] != i][:k]
        found[i] = [(int(ids[o]), float(far[o])) for o in order]
    return found


def search(spark, rows, every, k, **sizes):
    frame = usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding")
    found = {}
    for r in nearest(frame.where(f"id % {every} = 0"), frame, k, **sizes).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(x)] for q, x in found.items()}


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 300, "block_queries": 5}])
def test_recall_and_exact_scores(spark, sizes):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((20, 32))
    data = [(i, (centres[i % 20] + 0.4 * rng.standard_normal(32)).tolist()) for i in range(1500)]
    found, wanted = search(spark, data, 25, 10, **sizes), brute(data, data[::25], 10)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits / (10 * len(wanted)) >= 0.9
    held = dict(data)
    for q, near in found.items():
        assert [i for i, _ in near] == [i for i, _ in sorted(near, key=lambda x: (x[1], x[0]))]
        assert all(s == pytest.approx(np.sqrt(((np.array(held[q]) - np.array(held[i])) ** 2).sum()), abs=1e-12) for i, s in near)


def shares(vectors, queries, k=11):
    """Recall of the k nearest, and the share of rows whose distance was computed."""
    made = forest.Forest(vectors, float(np.linalg.norm(vectors, axis=1).max()) * (1 + 1e-9))
    hits = 0
    for at, (rows, _) in zip(queries, made.search(vectors[queries], k), strict=True):
        far = ((vectors - vectors[at]) ** 2).sum(1)
        hits += len(set(rows[:k].tolist()) & set(np.argsort(far, kind="stable")[:k].tolist()))
    return hits / (k * len(queries)), made.compared / (len(vectors) * len(queries))


def test_a_search_compares_few_rows(spark):
    held = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()], float)
    recall, share = shares(held, range(0, len(held), 20))
    assert recall >= 0.9 and share < 0.12
    # A full block: the sample, and noise that is as far away as such vectors are.
    rng = np.random.default_rng(1)
    noise = rng.standard_normal((forest.BLOCK_ROWS - len(held), held.shape[1]))
    full = np.concatenate([held, noise / np.linalg.norm(noise, axis=1, keepdims=True)])
    recall, share = shares(full, range(0, len(full), 300))
    assert recall >= 0.9 and share < 0.1
    # Where neighbours are near, hardly any.
    centres = rng.standard_normal((200, 64))
    near = centres[np.arange(8000) % 200] + 0.1 * rng.standard_normal((8000, 64))
    recall, share = shares(near, range(0, 8000, 200))
    assert recall >= 0.9 and share < 0.03


def test_meetings_follow_the_angle():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 16))
    points = forest.lifted(x, float(np.linalg.norm(x, axis=1).max()) * 1.01)
    bits = np.stack([forest.strings(points, tree) for tree in range(64)])
    for a, b in ((0, 1), (2, 3), (4, 5)):
        same = 1 - np.bitwise_count(bits[:, a] ^ bits[:, b]).sum() / (64 * forest.BITS)
        assert abs(same - forest.same_bit(float(np.linalg.norm(points[a] - points[b])))) < 0.05
    assert forest.least_meetings(10, 1.0) == 10 and forest.least_meetings(256, 0.5) == pytest.approx(128 - 1.18 * 8, abs=2)


def test_copies_ties_and_unusable_vectors(spark):
    same = [1.0, 0.0, 0.0]
    rows = [(i, same) for i in range(40)] + [(100, [0.0, 1.0, 0.0]), (101, [0.0, -1.0, -0.0]), (101, [0.0, -1.0, 0.0])]
    rows += [(200, None), (300, [0.0, 0.0, 0.0]), (400, [1.0, None, 0.0]), (500, [float("nan"), 1.0, 1.0]), (600, [float("inf"), 1.0, 1.0]), (700, []), (None, same)]
    found = search(spark, rows, 100, 10)
    assert set(found) == {0, 100}
    assert found[0] == [(i, 0.0) for i in range(1, 11)]
    assert [i for i, _ in found[100]] == list(range(10))


def test_fewer_candidates_other_lengths_and_empty_tables(spark, tmp_path):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 1.0]), (100, [1.0, 1.0, 1.0])]
    found = search(spark, rows, 100, 10)
    assert [i for i, _ in found[0]] == [1, 2] and 100 not in found
    schema = "vec_id bigint, embedding array<float>, score int"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op10_prefix_forest(spark, str(tmp_path)).count() == 0


def test_query_recall_on_the_sample(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    wanted = brute(rows, [r for r in rows if r[0] % forest.EVERY == 0], forest.K)
    found = {}
    for r in op10_prefix_forest(spark, folder).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[q] & {i for i, _ in near}) for q, near in wanted.items())
    assert hits / (forest.K * len(wanted)) >= 0.9
