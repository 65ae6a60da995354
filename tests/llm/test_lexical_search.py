import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from chapterloom.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    counts = [(i, Counter(w), len(w)) for i, text in docs if (w := terms(text))]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        rows = []
        for i, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, k, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out, key=str)


def found(docs, items, **more):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in S.ranked(docs, items, **more).collect()), key=str)


def corpus(n, seed=1):
    random.seed(seed)
    words = [f"w{i}" for i in range(300)] + ["Straße", "ΑΒΓ", "日本", "X1"]
    weigh = [1 / (k + 1) for k in range(len(words))]
    docs = [(i, " ".join(random.choices(words, weigh, k=random.choice([1, 5, 40, 200]))).replace(" ", random.choice([" ", "-", "\n"]))) for i in range(n)]
    items = [(i, " ".join(random.choices(words, weigh, k=random.choice([1, 3, 12, 40])))) for i in range(40)]
    return docs + docs[:30] + [(1000 + i, d[1]) for i, d in enumerate(docs[:20])], items


@pytest.mark.parametrize("first, bucket, block", [(2000, 512, 500_000), (20, 16, 60), (0, 3, 150)])
def test_against_brute_force(spark, monkeypatch, first, bucket, block):
    docs, items = corpus(400)
    docs += [(None, docs[3][1]), (5000, None), (5001, ""), (5002, "--"), (5003, "w7 " * 30_000), (5004, "w299 w298"), (5005, "w298 W299")]
    items += [(100, None), (101, ""), (102, "absent"), (1, "w298"), (None, "w299 w1")]
    monkeypatch.setattr(S, "FIRST_LEAST", first)
    monkeypatch.setattr(S, "FIRST_PART", 0)
    monkeypatch.setattr(S, "BUCKET", bucket)
    left = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, n int, ids string").repartition(5)
    right = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    assert found(left, right, block_terms=block) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert found(docs.limit(0), items) == [] and found(docs, items.limit(0)) == []
    # One document holds every term: its weights are not above what floor() leaves.
    assert found(docs, items) == brute([(1, "a b")], [(1, "a")])


def test_terms_are_the_pattern():
    text = "".join(map(chr, range(1, 0x250))) + "aB\u3000c\x85d İK ſ"
    assert [t.decode() for t in S.terms_of(text)] == terms(text)


def test_buckets_are_pruned_and_lose_nothing():
    rng = np.random.default_rng(5)
    at = np.append(0, np.cumsum(rng.integers(1, 30, 600)))
    ids = np.concatenate([np.sort(rng.choice(80, b - a, replace=False)) for a, b in zip(at, at[1:])])
    value = rng.integers(0, 1000, len(ids)) * np.where(ids % 9 == 0, 40, 1)
    length = np.sqrt(np.add.reduceat(value.astype(float) ** 2, at[:-1]))
    rows = np.argsort(-length, kind="stable")[:400]
    bucket, kept = S.Bucket(rows, at, ids, value, length), 0
    for _ in range(60):
        own = np.sort(rng.choice(80, rng.integers(1, 20), replace=False))
        wanted = np.isin(np.arange(80), own)
        scores = np.array([value[at[r] : at[r + 1]][wanted[ids[at[r] : at[r + 1]]]].sum() for r in rows])
        least = max(1, int(np.sort(scores)[-10]))
        found = bucket.survivors(own, float(least))
        assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
        assert (bucket.exact(found, wanted) == scores[found]).all()
        kept += len(found)
    assert kept < 0.5 * 60 * 400
