import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cdcmart.llm import trie
from cdcmart.llm.queries import ORACLE, QUERIES
from checks.compare import connect
from tests.conftest import SAMPLE_FOLDER


def remainder(c: int) -> int:
    """As in SQL, with the sign of the id."""
    return c % 5 if c >= 0 else -(-c % 5)


def brute(rows: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        members[c] = tuple(own.get(c - remainder(c), [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, turns in members.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in nodes:
        if node:
            kids[node[:-1]] += 1
    for node, held in nodes.items():
        value = (len(held) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            leaves[node[:d]] += not kids[node]
    found = []
    for node, held in nodes.items():
        ended = ",".join(str(c) for c in sorted(c for c in held if members[c] == node))
        parent = min(nodes[node[:-1]]) if node else None
        found.append((min(held), len(node), parent, len(held), kids[node], leaves[node], saved[node], hashlib.sha256(ended.encode()).hexdigest()))
    return found


def made(spark, rows):
    frame = spark.createDataFrame([(*r, r[0]) for r in rows], "conv_id bigint, turn bigint, role string, text string, depth bigint")
    return trie.trie(*trie.rebuilt(trie.ordered(frame)))


def check(spark, rows):
    assert sorted(map(repr, map(tuple, made(spark, rows).collect()))) == sorted(map(repr, brute(rows)))


def copies(n: int, longest: int, seed: int, letters: str = "ab") -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        source = draw.choice([draw.randint(0, longest), longest])
        word = [draw.choice(letters) if draw.random() < 0.15 else letters[0] for _ in range(source)]
        rows += [(c * 3 - n, turn, "user" if turn % 2 else "assistant", word[turn] * draw.choice([1, 1, 1, 2])) for turn in range(source)]
    return rows


@pytest.mark.parametrize("leaf", [1, 2, 8])
def test_trie_equals_brute_force_whatever_the_size_of_a_part(spark, monkeypatch, leaf):
    monkeypatch.setattr(trie, "LEAF", leaf)
    monkeypatch.setattr(trie, "CHUNK", 7)
    monkeypatch.setattr(trie, "SLICE_BITS", 1)
    check(spark, copies(40, 11, leaf))


def test_deep_sequences_take_few_rounds(spark, monkeypatch):
    rows = [(c, turn, "user", f"t{turn if c < 4 or turn < 61 else turn + c}") for c in range(0, 30, 5) for turn in range(70)]
    rows += [(7, turn, "user", "x") for turn in range(33)]
    turns, members = trie.rebuilt(trie.ordered(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")))
    assert trie.paths(turns, members)[1] == 4  # nine parts of eight turns
    check(spark, rows)


def test_nulls_ties_turnless_members_and_clashing_columns(spark):
    rows = [(None, 0, "user", "lost"), (0, None, "user", "first"), (0, 3, None, None), (0, 3, "", ""), (0, 1, "user", ""), (5, 0, "user", "é" * 50_000), (5, 0, "user", "é" * 50_000)]
    short = next(c for c in range(1, 1000, 5) if zlib.crc32(str(c).encode()) % 9 == 8)  # its source is absent and it is shorter than h
    check(spark, [*rows, (short, 1, "user", "gone"), (-7, 1, "user", "negative")])


def test_common_conversations_and_first_turns(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 64)
    rows = [(c, turn, "user", "hello" if c % 3 or turn == 0 else f"{c}") for c in range(600) for turn in range(1 + c % 2)]
    check(spark, rows)


def test_empty_table(spark):
    assert made(spark, []).collect() == []


def test_query_equals_its_sql(spark):
    found = QUERIES["op11_prefix_trie"](spark, SAMPLE_FOLDER)
    result = connect(SAMPLE_FOLDER).execute(ORACLE["op11_prefix_trie"])
    names = [column[0] for column in result.description]
    assert sorted(map(repr, map(tuple, found.select(*names).collect()))) == sorted(map(repr, result.fetchall()))
