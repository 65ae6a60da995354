"""The pipeline's stages, each against plain Python on its own input."""

import hashlib
import re
import zlib
from collections import Counter

import corpus_pipeline as P
import numpy as np
import pytest

from chapterloom.llm import bpe, queries
from chapterloom.llm import quality_rules as Q
from tests.llm.test_language_id import grams, top
from tests.llm.test_quality_rules import brute_counts, brute_distances
from tests.llm.test_signature_join import brute as components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_columns_and_shrink(stages):
    assert len(P.STAGES) == 5
    for a, b in zip(stages[:-2], stages[1:-1]):
        assert b.columns == stages[0].columns and set(ids(b)) <= set(ids(a))


def test_language_stage(stages):
    rows = stages[0].collect()
    counts = {r.doc_id: grams(r.text or "") for r in rows}
    learned = {}
    for r in rows:
        if r.lang is not None and r.text and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            learned[r.lang] = learned.get(r.lang, Counter()) + counts[r.doc_id]
    ranks = {x: {g: k for k, g in enumerate(top(c, 300))} for x, c in learned.items()}
    kept = []
    for r in rows:
        own = top(counts[r.doc_id], 300) if any(c.isalpha() for c in r.text or "") else []
        fits = [1 - sum(abs(rank[g] - k) if g in rank else 300 for k, g in enumerate(own)) / (300 * len(own)) for rank in ranks.values()] if own else [0]
        kept += [r.doc_id] if max(fits) >= 0.05 else []
    assert ids(stages[1]) == sorted(kept)


def test_quality_stage(stages):
    frame = stages[1].toPandas()
    counts = np.array([brute_counts(t) for t in frame.text])
    for k, name in enumerate(Q.COUNTS):
        frame[name] = counts[:, k]
    good = frame[(frame.n_words >= 50) & (100 * frame.n_repeat_words <= 50 * frame.n_words)].reset_index(drop=True)
    assert ids(stages[2]) == sorted(i for i, d in brute_distances(good).items() if d <= Q.chi2_quantile(Q.CUTOFF, Q.D))


def test_near_duplicate_stage(stages):
    texts = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert ids(stages[3]) == sorted({c for _, c in components(texts).values()})


def test_decontamination_stage(spark, stages):
    words = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(x[a : a + 10]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (x := words(r.text)) for a in range(max(1, len(x) - 9))}
    sizes = {len(w) for w in windows}
    clean = []
    for r in stages[3].collect():
        x = words(r.text)
        if not any(tuple(x[a : a + n]) in windows for n in sizes for a in range(len(x) - n + 1)):
            clean.append(r.doc_id)
    assert ids(stages[4]) == sorted(clean) and len(clean) < stages[3].count()


def test_last_stage_and_run(spark, stages):
    import tiktoken

    path, pattern = queries.tokenizer()
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for r in stages[4].collect():
        own = encoding.encode_ordinary(r.text)
        want.append((r.doc_id, len(own), sha(" ".join(map(str, own)).encode()), sha(r.text.encode())))
    assert sorted(map(tuple, stages[5].collect())) == sorted(want) == sorted(map(tuple, P.run(spark, SF).collect()))
