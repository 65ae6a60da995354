from collections import Counter

import pytest

from chapterloom.llm import language_id as L
from chapterloom.llm import queries

ROWS = [(1, "en", "the cat sat on the mat and the dog"), (2, "de", "der hund und die katze über straße"), (3, None, "no label"), (4, "en", ""), (5, "de", None)]


def grams(text):
    y = " "
    for c in text:
        c = c.lower()[0] if c.isalpha() else " "
        if not (c == " " and y[-1] == " "):
            y += c
    y = y if y[-1] == " " else y + " "
    out = [c for c in y if c != " "] + [y[i : i + 2] for i in range(len(y) - 1)]
    return Counter(out + [y[i : i + 3] for i in range(len(y) - 2) if y[i + 1] != " "])


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


def top(counter, k):
    return [code(g) for g, _ in sorted(counter.items(), key=lambda x: (-x[1], code(x[0])))[:k]]


def test_profiles_and_distance_by_brute_force(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, lang string, text string")
    k = 40
    profiles = L.learn_profiles(df, top=k)
    want = {x: top(sum((grams(t) for _, y, t in ROWS if y == x and t), Counter()), k) for x in ("en", "de")}
    assert profiles == want
    for text in ("the mat", "Über die Straße!", "xyzzy", "a"):
        own = top(grams(text), k)
        fit = {x: 1 - sum(abs(want[x].index(g) - r) if g in want[x] else k for r, g in enumerate(own)) / (k * len(own)) for x in want}
        [lang], [score], [best] = L.ranker(profiles, k)([text])
        assert best == pytest.approx(max(0, max(fit.values())))
        assert lang == min(fit, key=lambda x: (-fit[x], x))
        assert 0 <= score <= 1


def test_edges_clashes_and_order(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "123 !?", "z"), (4, "the dog", "w"), (4, "the dog", "w")], "doc_id long, text string, lang_pred string")
    profiles = {"en": top(grams("the dog"), 300)}
    rows = L.predict(df, profiles).sort("doc_id").collect()
    assert [r.lang_pred for r in rows] == ["und", "und", "und", "en", "en"] and rows[0].score == 0.0
    assert L.predict(df.limit(0), profiles).count() == 0
    assert {r.lang_pred for r in L.predict(df, {}).collect()} == {"und"}
    kept = L.accepted(df, profiles)
    assert kept.columns == ["doc_id", "text", "lang_pred"] and [r.doc_id for r in kept.collect()] == [4, 4]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op1_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
