import zlib

import numpy as np
from pyspark.sql import functions as F

from cdcmart.llm import language

ROWS = [(i, "the cat and the dog", "en") for i in range(9)] + [(i + 20, "der hund und die katze", "de") for i in range(9)]


def test_known_words_then_shorter_and_shorter_grams(spark):
    model = language.fit(spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string"))
    assert model.languages == ("de", "en") and "hund" in model.words
    assert model.predict("the")[0] == "en" and model.predict("Und!")[0] == "de"
    assert "hunds" not in model.words and model.predict("hunds")[0] == "de"
    word = model.words["cat"]
    assert np.allclose(model.word_scores[word], np.log([0.5 / (45 + 0.5 * language.WORDS), 9.5 / (45 + 0.5 * language.WORDS)]))
    longest = [g for g in language.grams("hunds", 4) if g in model.grams[3]]
    assert np.allclose(model.unseen("hunds"), model.gram_scores[3][[model.grams[3][g] for g in longest]].mean(0))
    # Only single letters of this word are known.
    assert np.allclose(model.unseen("kn"), model.gram_scores[1 - 1 if not any(g in model.grams[1] for g in language.grams("kn", 2)) else 1][
        [model.grams[0][c] for c in "kn"] if not any(g in model.grams[1] for g in language.grams("kn", 2)) else [model.grams[1][g] for g in language.grams("kn", 2) if g in model.grams[1]]
    ].mean(0))
    assert model.predict("пример")[1] == 0.5


def test_texts_without_letters_and_models_without_rows(spark):
    model = language.fit(spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string"))
    for text in (None, "", "123 !?", "\n"):
        assert model.predict(text) == ("und", 0.0)
    empty = language.fit(spark.createDataFrame([(1, "a", None), (2, None, "en")], "doc_id bigint, text string, lang string"))
    assert empty.predict("text") == ("und", 0.0)


def test_query_is_right_on_held_out_documents(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = language.op9_word_backoff(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.95
    rows = [(None, "the cat", "en", "x"), (1, None, None, "y"), (1, None, None, "y")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string").write.parquet(f"{tmp_path}/a/documents.parquet")
    assert language.op9_word_backoff(spark, f"{tmp_path}/a").count() == 3
    spark.createDataFrame([], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/b/documents.parquet")
    assert language.op9_word_backoff(spark, f"{tmp_path}/b").count() == 0


def test_held_out_rows_teach_nothing(spark, tmp_path):
    """The language of a held-out row is never seen, whatever it says."""
    for name, lang in (("a", "en"), ("b", "xx")):
        rows = [(i, t, lang if zlib.crc32(str(i).encode()) % 4 == 2 else kind) for i, t, kind in ROWS]
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
    a, b = (sorted(map(tuple, language.op9_word_backoff(spark, f"{tmp_path}/{n}").collect())) for n in "ab")
    assert a == b
    assert F is not None


def test_tokens_past_the_head_count_in_every_language(spark, monkeypatch):
    """A head of next to nothing gives the scores of the full counts."""
    monkeypatch.setattr(language, "WORDS", 3)
    monkeypatch.setattr(language, "GRAMS", 4)
    rows = [("the cat and the dog sat and ran", "en"), ("the the of a cat", "en"), ("der hund und die katze der of", "de"), ("die the und der", "de")]
    counts, pieces, wholes = {}, {}, {}
    for text, lang in rows:
        for word in text.split():
            counts.setdefault(word, {}).setdefault(lang, 0)
            counts[word][lang] += 1
            for n in range(1, 5):
                for gram in language.grams(word, n):
                    pieces.setdefault((n, gram), {}).setdefault(lang, 0)
                    pieces[n, gram][lang] += 1
                    wholes[n, lang] = wholes.get((n, lang), 0) + 1
            wholes[0, lang] = wholes.get((0, lang), 0) + 1

    def score(word):
        log = lambda found, n, kinds: np.log([(found.get(x, 0) + 0.5) / (wholes[n, x] + 0.5 * kinds) for x in ("de", "en")])
        if word in counts:
            return log(counts[word], 0, 3)
        for n in range(4, 0, -1):
            known = [log(pieces[n, g], n, 4) for g in language.grams(word, n) if (n, g) in pieces]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(2)

    texts = ["cat", "katze of", "sat ran dog dog", "hunds", "cats the dieder", "zq", "kn of", "пример a", "the the cat und xandx", None, "12", "cat"]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.words) < len(counts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = sorted(map(tuple, language.identify(frame, model).collect()))
    assert [r[:2] for r in found] == list(enumerate(texts))
    for _, text, lang, share in found:
        if not language.words(text):
            assert (lang, share) == ("und", 0.0)
            continue
        total = np.sum([score(w) for w in language.words(text)], axis=0)
        assert lang == ("de", "en")[int(total.argmax())]
        assert np.isclose(share, 1 / np.exp(total - total.max()).sum(), atol=1e-5)
