import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chapterloom.llm import ppm, queries
from chapterloom.llm.common import most_frequent


def table(texts, order):
    counts = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for t in texts:
        s = [ppm.END] * order + list((t or "").encode().translate(ppm._LOWER)) + [ppm.END]
        for i in range(order, len(s)):
            for j in range(order + 1):
                counts[j][tuple(s[i - j : i])][s[i]] += 1
    return counts


def probability(counts, history, symbol, order):
    """Method D with exclusion, symbol by symbol."""
    p, excluded = 1.0, set()
    for j in range(order, -1, -1):
        own = counts[j].get(tuple(history[len(history) - j :]) if j else ())
        if not own:
            continue
        left = {s: 2 * n - 1 for s, n in own.items() if s not in excluded}
        whole = sum(left.values()) + len(left)
        if symbol in left:
            return p * left[symbol] / whole
        if left:
            p *= len(left) / whole
        excluded |= set(own)
    return p / (ppm.SYMBOLS - len(excluded))


TEXTS = ["abracadabra", "the cat and the Hat", "", None, "aaaa bbb", "naïve é"]


def test_scores_by_brute_force(spark):
    train = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    model = ppm.learn(train)
    counts = table(TEXTS, ppm.ORDER)
    cases = [*TEXTS, "the bra", "zzz", "cat\nand", "é" * 40]
    got = model.scores(cases)
    for text, value in zip(cases, got):
        s = [ppm.END] * ppm.ORDER + list((text or "").encode().translate(ppm._LOWER)) + [ppm.END]
        want = sum(math.log10(probability(counts, s[i - ppm.ORDER : i], s[i], ppm.ORDER)) for i in range(ppm.ORDER, len(s)))
        assert value == pytest.approx(want, rel=1e-4)
    # Every context's symbols sum to 1; those never seen share the last column.
    unseen = ppm.SYMBOLS - (model.table.shape[1] - 1)
    total = (10.0 ** model.table[:, :-1].astype(float)).sum(1) + unseen * 10.0 ** model.table[:, -1].astype(float)
    assert np.allclose(total, 1, atol=1e-3)


def test_baseline_by_brute_force_and_edges(spark):
    rows = [(i, t) for i, t in enumerate([*TEXTS, "the cat sat", "the cat sat"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = docs.where("doc_id < 5")
    tokens = lambda t: [*(t or "").encode().translate(ppm._LOWER).split(), None]
    c = collections.Counter(w for i, t in rows if i < 5 for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for frequent in (400_000, 2):
        got = {r.doc_id: r for r in ppm.scored(docs, train, frequent=frequent).collect()}
        for i, t in rows:
            w = tokens(t)
            assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
            assert got[i].base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
    nothing = ppm.scored(docs, docs.limit(0)).collect()
    assert len(nothing) == len(rows) and all(r.train_tokens == 0 and r.base_score == pytest.approx(0) for r in nothing)
    assert ppm.learn(docs.limit(0)).scores(["ab"])[0] == pytest.approx(-3 * math.log10(ppm.SYMBOLS), rel=1e-5)
    assert ppm.scored(docs.limit(0), train).count() == 0


def test_rare_contexts_count_whatever_is_kept(spark):
    rows = [(i, t) for i, t in enumerate([*TEXTS, "the bra", "zzz", "cat\nand", "é" * 40, "the hat and a cab", "the bra"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = docs.where("doc_id < 6")
    counts = table(TEXTS, ppm.ORDER)
    # Columns with the names of inner ones stay, those of outputs are replaced.
    docs = docs.withColumns({"row_id": F.lit("x"), "rest": F.col("doc_id") + 1, "Score": F.lit("old"), "c0": F.lit(None)})
    for kept in (1, 12, 100_000):
        out = ppm.scored(docs, train, kept)
        assert out.columns == ["doc_id", "row_id", "rest", "c0", *ppm.OUTPUTS]
        got = {r.doc_id: r for r in out.collect()}
        assert len(got) == len(rows) and all(r.row_id == "x" and r.rest == i + 1 and r.c0 is None for i, r in got.items())
        for i, text in rows:
            s = [ppm.END] * ppm.ORDER + list((text or "").encode().translate(ppm._LOWER)) + [ppm.END]
            want = sum(math.log10(probability(counts, s[k - ppm.ORDER : k], s[k], ppm.ORDER)) for k in range(ppm.ORDER, len(s)))
            assert got[i].score == pytest.approx(want, rel=1e-6)
    nothing = ppm.scored(docs, docs.limit(0)).where("doc_id = 0").first()
    assert nothing.score == pytest.approx(-12 * math.log10(ppm.SYMBOLS))


def test_most_frequent(spark):
    rows = spark.createDataFrame([(k, n) for k, n in enumerate([1, 1, 5, 5, 40, 9])], "key long, times long")
    kept = lambda limit: sorted(r.times for r in most_frequent(rows, limit).collect())
    assert kept(6) == [1, 1, 5, 5, 9, 40] and kept(3) == [9, 40] and kept(0) == [] and most_frequent(rows.limit(0), 3).count() == 0


def test_query_beats_nothing_learned(spark):
    rows = queries.op5_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.score < 0 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 1.6
