"""Quality classifier: a sparse ensemble of rules.

A few shallow trees are grown on statistics of labelled texts. Every path from a root to
a node is a conjunctive rule. A logistic regression with a lasso penalty weighs the rules
and drops most; what is left is compiled into one Spark column expression, so that
scoring runs no Python beyond the statistics.

The classifier is fitted on at most ``sample`` labelled rows, chosen by a hash of the id;
statistics and scores cover all rows.

Defined results: a null or empty text has zero statistics and is scored like any other.
Labels that are null count as missing. Without labels the score is 0.5 for every text, and
with labels of one kind their share (0 or 1). Rows that repeat an id are scored each.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chapterloom.llm.common import store, with_text_columns, without
from chapterloom.llm.quality_rules import COUNTS, text_counts

MORE = ["n_distinct", "n_digits", "n_marks", "longest_word"]
FIELDS = [T.StructField(c, T.LongType()) for c in [*COUNTS, *MORE]]
_DIGITS, _MARKS = b"0123456789", b"!?;:{}[]()=_/\\~^@"

#: The statistics that trees split on.
STATISTICS = {
    "s_words": "ln(1 + n_words)",
    "s_word_length": "word_chars / greatest(n_words, 1)",
    "s_symbols": "n_symbols / greatest(word_chars, 1)",
    "s_dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "s_repeat": "n_repeat_words / greatest(n_words, 1)",
    "s_line_words": "n_words / greatest(n_lines, 1)",
    "s_upper": "n_upper / greatest(word_chars, 1)",
    "s_distinct": "n_distinct / greatest(n_words, 1)",
    "s_digits": "n_digits / greatest(word_chars, 1)",
    "s_marks": "n_marks / greatest(word_chars, 1)",
    "s_longest": "ln(1 + longest_word)",
}


def counts_of(text: str | None) -> tuple[int, ...]:
    own = text_counts(text)
    if not text:
        return (*own, 0, 0, 0, 0)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    return (*own, len(set(words)), len(data) - len(data.translate(None, _DIGITS)), len(data) - len(data.translate(None, _MARKS)), max(map(len, words), default=0))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds STATISTICS, from whole texts."""
    counted = with_text_columns(docs, lambda: lambda texts: list(map(list, zip(*map(counts_of, texts)))), FIELDS, text_col)
    counted = without(counted, list(STATISTICS))
    return without(counted.withColumns({name: F.expr(sql) for name, sql in STATISTICS.items()}), [f.name for f in FIELDS])


def tree_rules(dump: str, names: list[str]) -> list[tuple[tuple[str, str, float], ...]]:
    """The conditions (statistic, sign, threshold) on the way to each node but the roots, from a tree's or forest's printout."""
    path: list[tuple[str, str, float]] = []
    rules = {}
    base = 0
    for line in dump.splitlines():
        if re.match(r"\s*Tree \d+", line):
            path, base = [], 0
            continue
        found = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not found:
            continue
        depth = len(found[1])
        if not path:
            base = depth
        path = path[: depth - base] + [(names[int(found[2])], found[3], float(found[4]))]
        merged: dict[tuple[str, str], float] = {}
        for name, sign, value in path:
            key = (name, sign)
            merged[key] = value if key not in merged else (min if sign == "<=" else max)(merged[key], value)
        rules[tuple(sorted((n, s, v) for (n, s), v in merged.items()))] = True
    return list(rules)


def rule_column(rule: tuple[tuple[str, str, float], ...]) -> Column:
    """A rule as a boolean column."""
    out = None
    for name, sign, value in rule:
        one = F.col(name) <= value if sign == "<=" else F.col(name) > value
        out = one if out is None else out & one
    return out


class Ensemble:
    """Weighted rules; score() is the compiled column."""

    def __init__(self, intercept: float, rules: list[tuple[tuple, float]]):
        self.intercept, self.rules = intercept, rules

    def score(self) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule_column(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))

    def describe(self) -> list[str]:
        return [f"{w:+.4f} if " + " and ".join(f"{n} {s} {v:.6g}" for n, s, v in rule) for rule, w in self.rules]


def fit(labelled: DataFrame, label_col: str = "label", id_col: str = "doc_id", sample: int = 40_000, trees: int = 12, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> Ensemble:
    """The ensemble from rows with STATISTICS and a label of 0 or 1."""
    rows = labelled.where(F.col(label_col).isNotNull()).withColumn("label", F.col(label_col).cast("double"))
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share")).first()
    if not known.n or known.share in (0.0, 1.0):
        return Ensemble(0.0 if not known.n else math.copysign(50.0, known.share - 0.5), [])
    rows = rows.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, sample / known.n)))
    names = list(STATISTICS)
    rows = store(rows.select("label", *names), "labelled")
    share = rows.agg(F.avg("label")).first()[0]
    if share in (None, 0.0, 1.0):
        return Ensemble(math.copysign(50.0, known.share - 0.5), [])
    vectors = VectorAssembler(inputCols=names, outputCol="vector").transform(rows)
    forest = RandomForestClassifier(labelCol="label", featuresCol="vector", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.7, maxBins=64, seed=seed).fit(vectors)
    rules = tree_rules(forest.toDebugString, names)
    if not rules:
        return Ensemble(math.log(share / (1 - share)), [])
    flags = rows.select("label", *[rule_column(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)])
    flags = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="rules").transform(flags).select("label", "rules")
    lasso = LogisticRegression(labelCol="label", featuresCol="rules", elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(store(flags, "rules"))
    weights = lasso.coefficients.toArray().tolist()
    return Ensemble(float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def score(statistics: DataFrame, ensemble: Ensemble, cut: float = 0.7) -> DataFrame:
    """Adds score and predicted."""
    return statistics.withColumn("score", ensemble.score()).withColumn("predicted", (F.col("score") >= cut).cast("int"))
