import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chapterloom.llm import bpe, queries


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    path, pattern = queries.tokenizer()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_tree_equals_whole_text(encoding):
    alphabet = st.sampled_from(list(" \n\t\r'srevltmd01aZé语  \x1c.!<|") + ["  ", " \n", "'re", "hello", " world"])

    @settings(max_examples=400, deadline=None)
    @given(st.lists(alphabet, max_size=60).map("".join), st.integers(1, 9))
    def check(text, leaf):
        ids = bpe.encode_tree(text, encoding.encode_ordinary, leaf)
        assert ids == encoding.encode_ordinary(text)
        assert bpe.decode_tree(ids, encoding.decode_bytes, leaf) == text.encode()

    check()


def test_giant_words_and_long_texts(encoding):
    random.seed(3)
    for text in ("a" * 20_000, " " * 5_000 + "x", "ab " * 9_000, "".join(random.choices("ab \n'é", k=50_000))):
        assert bpe.encode_tree(text, encoding.encode_ordinary) == encoding.encode_ordinary(text)


def test_operator_round_trip(spark, encoding):
    path, pattern = queries.tokenizer()
    rows = [(1, "Hello <|endoftext|> world", "x"), (2, None, "y"), (3, "", "z"), (4, "é" * 5000, "w"), (4, "é" * 5000, "w"), (None, "one two", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode_ids(bpe.encode_texts(df, path, pattern), path, pattern).collect()
    assert len(out) == 6
    for r in out:
        assert r.ids == encoding.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode_texts(df.limit(0), path, pattern).count() == 0


def test_query_digests(spark, encoding):
    d = "/root/testdata/sf0.001"
    want = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = queries.op8_byte_bpe(spark, d).collect()
    assert len(rows) == len(want)
    for r in rows:
        ids = encoding.encode_ordinary(want[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
