import pytest
from pyspark.sql import functions as F

from cdcmart.llm import tokens
from cdcmart.llm.tokens import counted, frequent, rules
from tests.conftest import SAMPLE_FOLDER

ODD = [
    "", " \n\t ", "It's we'll THEY'RE 1234 ab12c", "<|endoftext|>", "a<|startoftext|>b <|EndOfText|> <|endoftext|><|endoftext|>x <|end",
    "ΣΑΣ ΟΔΟΣ σ", "İstanbul J̌ é ﬁ", "日本語テキスト、です。 한국어 عربى", "\x1c\x1d\x1e\x1f\x85\xa0 x　y᠎z​",
    "👩‍👩‍👧 🇩🇪 ☃", "͸՘ \U0001ffff", "x" * 5000, "é" * 3000 + " " + "!?" * 2000, "don'tdon't 'S 'LL",
]


def by_library(text: str | None, name: str = tokens.TOKENIZER) -> int:
    return len(rules(name).library.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("head", [{}, None])
def test_counts_equal_the_library_with_and_without_a_table(spark, head):
    texts = [(i, t, i) for i, t in enumerate([*ODD, None, *ODD])]
    frame = spark.createDataFrame([*texts, (None, "null key", 1)], "doc_id bigint, text string, n_tokens bigint")
    found = sorted(counted(frame, head=head).collect(), key=repr)
    want = sorted([(k, len((t or "").encode()), by_library(t), False) for k, t, _ in [*texts, (None, "null key", 1)] if t is None or by_library(t) <= 2048], key=repr)
    assert [r for r in sorted((tuple(r) for r in found), key=repr) if not r[3]] == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in found)


def test_every_code_point_is_counted_as_by_the_library():
    for at in range(0, 0x110000, 512):
        text = " ".join(f"a{chr(c)}a {chr(c)}{chr(c)}" for c in range(at, at + 512) if not 0xD800 <= c < 0xE000)
        if text:
            assert tokens.count(text, tokens.TOKENIZER, {}) == by_library(text), hex(at)


def test_small_caches_and_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "LONG", 4)
    monkeypatch.setattr(tokens, "SHORT", 5)
    text = "one two three four fivefivefive six " * 30
    assert tokens.count(text, tokens.TOKENIZER, {"two": 1}) == by_library(text)


def test_other_tokenizer_files_go_through_the_library():
    name = "byte_bpe_50k.json"
    for text in ODD:
        assert tokens.count(text, name, {}) == by_library(text, name)


def test_table_holds_the_frequent_pre_tokens_and_their_lengths(spark):
    frame = spark.createDataFrame([("red red red blue blue grün " + "z" * 200,)] * 5 + [(None,)], "text string")
    assert set(frequent(frame, head=2)) == {"red", "blue"}
    assert frequent(frame.limit(0)) == {}
    assert all(length == rules(tokens.TOKENIZER).length(piece) for piece, length in frequent(frame).items())
    assert frequent(frame, sample=3, head=9)


def test_query_equals_the_library_and_shuffles_no_pre_tokens(spark):
    frame = tokens.op12_token_counts(spark, SAMPLE_FOLDER)
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SAMPLE_FOLDER}/documents.parquet").collect()}
    found = frame.collect()
    assert len(found) == len(texts)
    assert all((r.n_tokens, r.n_bytes) == (by_library(texts[r.doc_id]), len((texts[r.doc_id] or "").encode())) for r in found)
    assert frame.where(F.lit(False)).count() == 0


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert counted(frame).collect() == []
