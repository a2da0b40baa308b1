import hashlib
import random
from collections import Counter

import pytest

from cdcmart.llm import bpe

BITS = ["  ", "\n", "\n\n", " the", " naïve", "'s", "你好", "\t ", " 123", "!!! ", "é", " "]


def texts():
    rng = random.Random(3)
    made = ["".join(rng.choice([*BITS, "x" * rng.randint(1, 40)]) for _ in range(rng.randint(1, 1500))) for _ in range(20)]
    hard = [None, "", "a" * 5000, " " * 5000, "x" + " " * 3000 + "y" + "b" * 4000 + " c"]
    return made + hard + ["ab " * 3000] * 3


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (200, 50), (bpe.CHUNK, bpe.OVERLAP)])
def test_ids_equal_the_library_for_any_chunk(spark, chunk, overlap):
    rows = [(i % 25, t, "x", 1) for i, t in enumerate(texts())]  # keys and rows repeat
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, digest int")
    found = bpe.decode(bpe.encode(frame, "doc_id", chunk=chunk, overlap=overlap), "doc_id").collect()
    library = bpe._encoding(bpe.RANKS)
    wanted = Counter((k, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for k, t, *_ in rows)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.raw)) for r in found) == wanted


def test_boundaries_resynchronise_within_the_overlap():
    text = "one two  three\n\nfour five " * 40
    whole = set(bpe.boundaries(text, True))
    for k, part in bpe.cut(text, 100, 30):
        found = {at + k * 70 for at in bpe.boundaries(part, k * 70 + 100 >= len(text)) if at}
        late = {at for at in found if at > min(found & whole)}
        assert late <= whole


def test_query_digests_and_empty_table(spark, tmp_path):
    library = bpe._encoding(bpe.RANKS)
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    for r in bpe.op2_byte_bpe(spark, "/root/testdata/sf0.001").collect():
        ids = library.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert bpe.op2_byte_bpe(spark, str(tmp_path)).count() == 0
