import random

import numpy as np

from cdcmart.llm import toxicity

RUDE = ["blarg", "snoff", "grubbo"]


def tables(spark, n=900, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["w%s" % "".join(rng.choice("abcdef") for _ in range(4)) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(RUDE) + rng.choice(["", "ish", "er"])
        junk = rng.random() < 0.3
        if junk:
            words += ["buy", "now"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not junk), int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels, rows, truth = tables(spark)
    chain = toxicity.fit(docs, labels.where("doc_id % 3 <> 0"))
    said = [(t, chain.probabilities(x)) for (i, x), (_, q, t) in zip(rows, truth, strict=True) if i % 3 == 0]
    right = np.mean([(p[1] >= chain.threshold) == bool(t) for t, p in said])
    assert right > 0.95
    # The second model was given the first one's out-of-fold probabilities.
    assert chain.categories == ("junk", "toxic") and chain.weights.shape[1] == 1 + len(chain.vocabulary) + 2


def test_newton_steps_find_the_optimum():
    rng = np.random.default_rng(3)
    known = [sorted(set(rng.integers(0, 12, 4).tolist())) for _ in range(400)]
    rows = toxicity.Rows.of(known, 12).beside(rng.random(400))
    y = (rng.random(400) < 0.3 + 0.4 * np.array([0 in k for k in known])).astype(float)
    w = toxicity._linear(rows, y)
    slope = rows.gathered(y - toxicity._sigmoid(rows.logits(w)))
    slope[1:] -= toxicity.REGULAR * len(y) * w[1:]
    assert np.abs(slope).max() < 0.05 and w[1] > 1


def test_missing_labels_classes_and_texts(spark):
    docs, labels, _, _ = tables(spark, 60)
    assert toxicity.fit(docs, labels.limit(0)).probabilities("x") == [0.0, 0.0] or max(toxicity.fit(docs, labels.limit(0)).probabilities("x")) < 1e-9
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert none.probabilities("blarg")[1] < 1e-9
    more = labels.unionByName(spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 0, 1), (2, 0, 1)], labels.schema))
    chain = toxicity.fit(docs, more)
    assert chain.probabilities(None) == chain.probabilities("")
    frame = spark.createDataFrame([(1, None, "a", 3.0), (1, None, "a", 3.0), (2, "blarg " * 5000, "b", 4.0)], "doc_id bigint, text string, toxic string, p_junk double")
    scored = toxicity.score(frame, chain)
    assert scored.columns == ["doc_id", "text", "toxic", "p_junk", "p_toxic"] and scored.count() == 3


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVE", 5)
    monkeypatch.setattr(toxicity, "NEGATIVE", 7)
    _, labels, _, _ = tables(spark, 200)
    rows = toxicity.sample(labels, "doc_id", toxicity.CATEGORIES).collect()
    assert sum(r.y1 for r in rows) == 5 and len(rows) == 12


def test_query_on_the_sample_and_empty_tables(spark, tmp_path):
    found = toxicity.op4_classifier_chain(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "p_junk", "p_toxic", "toxic"]
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert toxicity.op4_classifier_chain(spark, str(tmp_path)).count() == 0
