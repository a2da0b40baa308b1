import math
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from cdcmart.llm import shards
from cdcmart.llm.shards import Tree, number, place


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def brute(key: int | None, tree: Tree) -> int:
    node = "root"
    for level in range(3):
        below = tree.children(level)[node]

        def draw(name: str, weight: float, level: int = level) -> float:
            seed = 42
            if key is not None:
                seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), seed)
            bits = xxhash.xxh64_intdigest(f"{level}:{name}".encode(), seed) >> 11
            return -math.log((bits + 0.5) / (1 << 53)) / weight

        node = min(below, key=lambda n: (draw(n, below[n]), n))
    return int(node)


def placed(spark, keys, tree):
    frame = spark.createDataFrame([(k,) for k in keys], "doc_id bigint")
    return [(r.doc_id, r.shard) for r in place(frame, "doc_id", tree).collect()]


def test_descent_equals_brute_force(spark):
    weights = [3.0, 1.0, 0.5, 2.0, 1.0]
    leaves = tuple((f"r{i // 3}", f"k{i // 2}-{i // 3}", i, w) for i, w in enumerate(weights))
    for tree in (Tree.of(16), Tree.of(17), Tree.of(1), Tree(leaves)):
        assert all(shard == brute(key, tree) for key, shard in placed(spark, [*range(300), -5, None], tree))


def test_one_more_shard_takes_rows_only_into_itself(spark):
    before, after = dict(placed(spark, range(4000), Tree.of(16))), dict(placed(spark, range(4000), Tree.of(17)))
    moved = {k for k in before if before[k] != after[k]}
    assert {after[k] for k in moved} == {16}
    assert 150 < len(moved) < 330  # a seventeenth is 235


def test_shares_follow_weights_and_moves_stay_in_changed_subtrees(spark):
    def tree(w):
        return Tree((("a", "a1", 0, w), ("a", "a1", 1, 1.0), ("a", "a2", 2, 1.0), ("b", "b1", 3, 1.0), ("b", "b2", 4, 2.0)))

    one, three = dict(placed(spark, range(6000), tree(1.0))), dict(placed(spark, range(6000), tree(3.0)))
    share = Counter(three.values())
    assert abs(share[0] / 6000 - 3 / 8) < 0.03 and abs(share[4] / 6000 - 2 / 8) < 0.03
    # Weights rose in region a and rack a1 only: nothing moves among the others.
    others = {(one[k], three[k]) for k in one if one[k] != three[k] and three[k] not in (0, 1)}
    assert all(a in (0, 1) or three_ in (2,) for a, three_ in others) or not others
    assert not {(a, b) for a, b in others if {a, b} == {3, 4}}


def test_slots_are_gapless_with_repeats_nulls_and_clashing_columns(spark):
    rows = [(i % 50, f"t{i % 7}", 1, 2, 3) for i in range(200)] + [(None, None, 9, 9, 9)] * 3
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, shard int, slot int, `__piece` int")
    done = number(place(frame.drop("__piece"), "doc_id", Tree.of(16)), "shard", ["doc_id", "text"], pieces=4)
    assert done.columns == ["doc_id", "text", "shard", "slot"] and done.count() == 203
    slots = {}
    for r in done.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_query_and_empty_table(spark, tmp_path):
    text = [(1, "é"), (2, None), (3, "")]
    spark.createDataFrame(text, "doc_id bigint, text string").write.parquet(f"{tmp_path}/a/documents.parquet")
    rows = {r.doc_id: r for r in shards.op1_hash_tree(spark, f"{tmp_path}/a").collect()}
    assert (rows[1].size, rows[2].size, rows[3].size) == (3, 1, 1)
    assert (rows[1].text_crc32, rows[2].text_crc32) == (__import__("zlib").crc32("é".encode()), 0)
    assert all(r.grown_shard in (r.shard, 16) for r in rows.values())
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/b/documents.parquet")
    assert shards.op1_hash_tree(spark, f"{tmp_path}/b").count() == 0
    assert F is not None
