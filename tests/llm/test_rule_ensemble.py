import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from chapterloom.llm import queries
from chapterloom.llm import rule_ensemble as R

DUMP = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=11
  Tree 0 (weight 1.0):
    If (feature 2 <= 0.5)
     If (feature 0 <= 3.25)
      Predict: 0.0
     Else (feature 0 > 3.25)
      If (feature 2 <= 0.25)
       Predict: 1.0
      Else (feature 2 > 0.25)
       Predict: 0.0
    Else (feature 2 > 0.5)
     Predict: 0.0
  Tree 1 (weight 1.0):
    Predict: 1.0
"""


def test_paths_become_rules():
    rules = R.tree_rules(DUMP, list(R.STATISTICS))
    a, c = "s_words", "s_symbols"
    assert {tuple(sorted(r)) for r in rules} == {
        ((c, "<=", 0.5),),
        ((c, "<=", 0.5), (a, "<=", 3.25)),
        ((c, "<=", 0.5), (a, ">", 3.25)),
        ((c, "<=", 0.25), (a, ">", 3.25)),
        ((c, "<=", 0.5), (c, ">", 0.25), (a, ">", 3.25)),
        ((c, ">", 0.5),),
    }


def test_compiled_score(spark):
    rules = [((("s_words", ">", 1.0), ("s_upper", "<=", 0.5)), 2.0), ((("s_upper", ">", 0.5),), -3.0)]
    df = spark.createDataFrame([(2.0, 0.1), (2.0, 0.9), (0.0, 0.2)], "s_words double, s_upper double")
    got = [r.z for r in df.select((-F.log(1 / R.Ensemble(0.5, rules).score() - 1)).alias("z")).collect()]
    assert [round(z, 6) for z in got] == [2.5, -2.5, 0.5]


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x " * 50_000, "c"), (3, "x " * 50_000, "c"), (None, "word", None)], "doc_id long, text string, n_words string")
    statistics = R.with_statistics(docs)
    empty = R.fit(statistics.withColumn("label", F.lit(None).cast("int")))
    assert [r.score for r in R.score(statistics, empty).collect()] == [0.5] * 5
    one = R.fit(statistics.withColumn("label", F.lit(1)))
    assert all(r.predicted == 1 for r in R.score(statistics, one).collect())
    assert R.score(R.with_statistics(docs.limit(0)), one).count() == 0


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op10_quality_classifier(spark, d)
    assert rows.count() == spark.read.parquet(f"{d}/documents.parquet").count()
    held = rows.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(held) > 50 and sum(r.predicted == r.quality for r in held) / len(held) > 0.93
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out and 0 <= r.score <= 1 for r in held)


def plain_score(ensemble, row):
    z = ensemble.intercept
    for rule, weight in ensemble.rules:
        z += weight * all(row[n] <= v if s == "<=" else row[n] > v for n, s, v in rule)
    return 1 / (1 + math.exp(-z))


def test_query_by_plain_evaluation(spark, monkeypatch):
    """The query's scores are those of its rules, evaluated in Python over statistics that Python counts."""
    fitted = []
    fit = R.fit
    monkeypatch.setattr(R, "fit", lambda *a, **k: fitted.append(fit(*a, **k)) or fitted[-1])
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op10_quality_classifier(spark, d).collect()}
    assert len(fitted) == 1 and 0 < len(fitted[0].rules) < 200
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        n, chars, repeated = max(1, len(words)), max(1, sum(map(len, words))), Counter(zip(words, words[1:], words[2:]))
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        covered = {i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if repeated[w] > 1 for j in range(3)}
        row = {
            "s_words": math.log1p(len(words)), "s_word_length": sum(map(len, words)) / n, "s_symbols": len(re.findall(r"[#*$%&|<>]", text)) / chars, "s_dup_lines": (len(lines) - len(set(lines))) / max(1, len(lines)),
            "s_repeat": len(covered) / n, "s_line_words": len(words) / max(1, len(lines)), "s_upper": len(re.findall("[A-Z]", text)) / chars, "s_distinct": len(set(words)) / n,
            "s_digits": len(re.findall("[0-9]", text)) / chars, "s_marks": len(re.findall(r"[!?;:{}\[\]()=_/\\~^@]", text)) / chars, "s_longest": math.log1p(max((len(w.encode()) for w in words), default=0)),
        }
        want = plain_score(fitted[0], row)
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == (want >= 0.7)


def test_rules_are_the_forest_and_weights_the_lasso(spark):
    """Rows share a leaf where they share its rule; the weights are as good as those of plain proximal steps."""
    rng = np.random.default_rng(5)
    names = list(R.STATISTICS)
    x = rng.random((600, len(names))).round(3)
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.6)) ^ (rng.random(600) < 0.1)
    rows = spark.createDataFrame([(i, int(b), *map(float, v)) for i, (b, v) in enumerate(zip(y, x))], f"doc_id long, label int, {', '.join(f'{n} double' for n in names)}")
    vectors = VectorAssembler(inputCols=names, outputCol="vector").transform(rows.withColumn("label", F.col("label").cast("double")))
    forest = RandomForestClassifier(labelCol="label", featuresCol="vector", numTrees=3, maxDepth=3, seed=1).setLeafCol("leaf").fit(vectors)
    leaves = np.array([r.leaf.toArray() for r in forest.transform(vectors).sort("doc_id").collect()])
    holds = lambda rule: np.all([x[:, names.index(n)] <= v if s == "<=" else x[:, names.index(n)] > v for n, s, v in rule], axis=0)
    made = {holds(r).tobytes() for r in R.tree_rules(forest.toDebugString, names)}
    assert all((leaves[:, t] == leaf).tobytes() in made for t in range(3) for leaf in set(leaves[:, t]))
    ensemble = R.fit(rows, penalty=0.01)
    flags = np.array([holds(r) for r, _ in ensemble.rules], float).T
    scale = flags.std(0, ddof=1)
    weights, intercept = np.array([w for _, w in ensemble.rules]), ensemble.intercept

    def loss(w, b):
        z = flags @ w + b
        return np.mean(np.logaddexp(0, z) - y * z) + 0.01 * np.abs(w * scale).sum()

    # Accelerated steps in units of each rule's deviation, as the penalty counts it.
    unit = flags / scale
    size = 4 / np.linalg.eigvalsh(np.c_[unit, np.ones(len(y))].T @ np.c_[unit, np.ones(len(y))] / len(y)).max()
    w, b = np.zeros(len(weights)), 0.0
    u, c = w, b
    for k in range(3000):
        p = 1 / (1 + np.exp(-(unit @ u + c))) - y
        v = u - size * unit.T @ p / len(y)
        w2, b2 = np.sign(v) * np.maximum(np.abs(v) - size * 0.01, 0), c - size * p.mean()
        u, c = w2 + k / (k + 3) * (w2 - w), b2 + k / (k + 3) * (b2 - b)
        w, b = w2, b2
    w = w / scale
    assert loss(weights, intercept) <= loss(np.zeros(len(weights)), np.log(y.mean() / (1 - y.mean()))) - 0.05
    assert loss(weights, intercept) <= loss(w, b) + 1e-3
