"""Quality rules: base rules and robust multivariate outliers.

Every text gives a few counts; their transformed ratios make a vector. For each language
and source the minimum covariance determinant (MCD) gives a mean and scatter that
outliers don't move, and a text is rejected where its Mahalanobis distance is too large.

The MCD is a Spark job: from two starting estimates, concentration steps alternate between
a quantile of the distances and sums over the rows within it, all as partial aggregates
over a narrow table, so a source with a third of all rows is no burden. Quantiles come from counts in
narrow classes, so they don't depend on the partitioning. The start that
ends with the smaller determinant wins; one reweighting step follows.

Every group, its language and all rows together get an estimate of their own. A group's is then drawn towards its
language's, that towards the one of all rows, and that towards fixed deviations (PRIOR), each as if prior_rows more rows spoke
for the latter: n / (n + prior_rows) is the weight of a group's own n rows. So there is no size at which the rule changes.

Defined results: a null or empty text has no words and fails the base rule. Null and
empty lang or source are one group each. Where no text passes the base rules, no distance is known
and nothing is rejected by it. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chapterloom.llm.common import packed, store, with_text_columns

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_SPACE = b" \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]
FIELDS = [T.StructField(c, T.LongType()) for c in COUNTS]


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    bare = data.translate(None, _SPACE)
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(text) - (len(data) - len(bare)),
        len(bare) - len(bare.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(bare) - len(bare.translate(None, _UPPER)),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(known.__getitem__, words), np.int64, n)
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(n, bool)
    for j in range(3):
        covered[j : n - 2 + j] |= again
    return int(covered.sum())


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds COUNTS, from whole texts."""
    return with_text_columns(docs, lambda: lambda texts: list(map(list, zip(*map(text_counts, texts)))), FIELDS, text_col)


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


#: Transformed statistics: name, expression, and the smallest standard deviation that counts. For word length and capitals it
#: only guards against a singular matrix and is far under what is measured (0.03 and 0.013). The other three are
#: 0 in most texts, so the innermost rows have no deviation at all; there it is the scale of what still counts as 0.
VECTOR = [
    ("x_word", "ln((word_chars + 1) / (n_words + 1))", 0.005),
    ("x_symbol", "sqrt(n_symbols / greatest(word_chars, 1))", 0.02),
    ("x_lines", "sqrt(n_dup_lines / greatest(n_lines, 1))", 0.15),
    ("x_repeat", "sqrt(n_repeat_words / greatest(n_words, 1))", 0.15),
    ("x_upper", "sqrt(n_upper / greatest(word_chars, 1))", 0.005),
]
#: Deviations that count where few rows are known.
PRIOR = [0.1, 0.1, 0.3, 0.3, 0.05]
D = len(VECTOR)
PAIRS = [(i, j) for i in range(D) for j in range(i, D)]


def with_vector(counts: DataFrame) -> DataFrame:
    return counts.withColumns({name: F.expr(sql) for name, sql, _ in VECTOR})


def chi2_cdf(x: float, d: int) -> float:
    """The chi-squared distribution, by the series of the incomplete gamma function."""
    a, z = d / 2, x / 2
    term = total = 1 / a
    for k in range(1, 2000):
        term *= z / (a + k)
        total += term
        if term < total * 1e-14:
            break
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a))) if z > 0 else 0.0


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, d) < p else (low, mid)
    return low


def consistency(share: float) -> float:
    """What a covariance over the innermost share of a normal sample has to be multiplied by."""
    return share / chi2_cdf(chi2_quantile(share, D), D + 2)


def distance(mean: str = "mean", precision: str = "precision") -> Column:
    """Squared Mahalanobis distance; precision holds the upper triangle of the inverse scatter."""
    terms = [f"{1 if i == j else 2} * {precision}[{k}] * ({VECTOR[i][0]} - {mean}[{i}]) * ({VECTOR[j][0]} - {mean}[{j}])" for k, (i, j) in enumerate(PAIRS)]
    return F.expr(" + ".join(terms))


def unpacked(values) -> np.ndarray:
    """A symmetric matrix from its upper triangle."""
    out = np.empty((D, D))
    for k, (i, j) in enumerate(PAIRS):
        out[i, j] = out[j, i] = values[k]
    return out


def solved(moments: pd.DataFrame, factor: float) -> pd.DataFrame:
    """Mean, scatter, its inverse (both packed) and log-determinant from a frame of count, sums and sums of products."""
    out = {"mean": [], "scatter": [], "precision": [], "logdet": []}
    for row in moments.itertuples(index=False):
        mean = np.array(row.sums, float) / row.n
        scatter = (unpacked(row.products) / row.n - np.outer(mean, mean)) * factor
        least = np.square([v[2] for v in VECTOR])
        scatter += np.diag(np.maximum(0.1 * least, least - np.diag(scatter)))  # so that few or dependent rows leave it regular
        inverse = np.linalg.inv(scatter)
        out["mean"].append(mean)
        out["scatter"].append(np.array([scatter[p] for p in PAIRS]))
        out["precision"].append(np.array([inverse[p] for p in PAIRS]))
        out["logdet"].append(float(np.linalg.slogdet(scatter)[1]))
    return pd.DataFrame(out, index=moments.index)


_DOUBLES = T.ArrayType(T.DoubleType())


def _estimates(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """One (n, mean, scatter, precision, logdet) for each group of rows, from partial sums."""
    x = [v[0] for v in VECTOR]
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("sums"),
        F.array(*[F.sum(F.col(x[i]) * F.col(x[j])) for i, j in PAIRS]).alias("products"),
    )
    carried = [f for f in sums.schema.fields if f.name not in ("sums", "products")]
    schema = T.StructType([*carried, *[T.StructField(c, _DOUBLES) for c in ("mean", "scatter", "precision")], T.StructField("logdet", T.DoubleType())])

    def run(frames):
        for frame in frames:
            yield pd.concat([frame.drop(columns=["sums", "products"]), solved(frame, factor)], axis=1)

    return sums.mapInPandas(run, schema)


#: Groups up to which estimates are broadcast (about 250 bytes each); beyond, they are joined by shuffling.
BROADCAST_GROUPS = 100_000


def attach(rows: DataFrame, groups: DataFrame, on: list[str], n_groups: int) -> DataFrame:
    return rows.join(F.broadcast(groups) if n_groups <= BROADCAST_GROUPS else groups, on, "left")


def pools() -> Column:
    """The three groups that a row is part of: all rows, its language, its language and source."""
    source = F.concat(F.lit("s"), F.length("g_lang").cast("string"), F.lit(":"), F.col("g_lang"), F.lit(":"), F.col("g_source"))
    return F.array(F.lit("all"), F.concat(F.lit("l:"), F.col("g_lang")), source)


def quantile(rows: DataFrame, keys: list[str], kind: Column, share: float) -> DataFrame:
    """(keys, kind): the class that holds the quantile, from the classes' sizes."""
    sizes = rows.groupBy(*keys, kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*keys)
    sizes = sizes.withColumns({"upto": F.sum("n").over(group.orderBy("kind")), "whole": F.sum("n").over(group)})
    return sizes.where(F.col("upto") >= F.ceil(share * F.col("whole"))).groupBy(*keys).agg(F.min("kind").alias("kind"))


#: Classes of a statistic for each unit, and of a squared distance for each doubling.
FINE, FINE_D2 = 4096, 64


def distance_class() -> Column:
    return F.ceil(F.log2(F.greatest(distance(), F.lit(1e-9))) * FINE_D2)


def _middles(cells: DataFrame, value: Column) -> DataFrame:
    """(pool, m): the medians of a value for each pool and statistic, from cells (pool, k, ...)."""
    found = quantile(cells, ["pool", "k"], F.floor(value * FINE), 0.5).groupBy("pool").agg(F.array_sort(F.collect_list(F.struct("k", "kind"))).alias("m"))
    return found.select("pool", F.transform("m", lambda v: v["kind"] / FINE).alias("m"))


def fit(vectors: DataFrame, share: float = 0.75, steps: int = 4, prior_rows: int = 100) -> tuple[DataFrame, int]:
    """(g_lang, g_source, mean, precision) by the MCD over the stored vectors that pass the base rules, and the number of groups."""
    x = [v[0] for v in VECTOR]
    groups = store(vectors.select("g_lang", "g_source").distinct(), "mcd-groups")
    n_groups = groups.count()
    rows = vectors.where(~base_failed()).select(F.explode(pools()).alias("pool"), *x)
    cells = rows.select("pool", F.posexplode(F.array(*x)).alias("k", "v"))
    middle = store(_middles(cells, F.col("v")).withColumnRenamed("m", "mean"), "mcd-middle")
    spread = _middles(attach(cells, middle, ["pool"], n_groups), F.abs(F.col("v") - F.col("mean")[F.col("k")]))
    diagonal = F.array(*[1 / F.pow(F.greatest(1.4826 * F.col("m")[i], F.lit(VECTOR[i][2])), 2) if i == j else F.lit(0.0) for i, j in PAIRS])
    starts = middle.join(spread, "pool").select("pool", F.lit(0).alias("start"), "mean", diagonal.alias("precision"))
    whole = _estimates(rows, ["pool"], 1.0).select("pool", F.lit(1).alias("start"), "mean", "precision")
    now = store(starts.unionByName(whole), "mcd-start")
    for step in range(steps):
        measured = attach(rows, now, ["pool"], n_groups).withColumn("d2", distance_class())
        limits = store(quantile(measured, ["pool", "start"], F.col("d2"), share), "mcd-limit")
        inner = attach(measured, limits, ["pool", "start"], n_groups).where("d2 <= kind")
        now = store(_estimates(inner, ["pool", "start"], consistency(share)), f"mcd-step{step}")
    best = now.groupBy("pool").agg(F.min_by(F.struct("mean", "precision"), F.struct("logdet", "start")).alias("b")).select("pool", "b.*")
    inner = attach(rows, store(best, "mcd-best"), ["pool"], n_groups).where(distance() <= chi2_quantile(0.975, D))
    final = _estimates(inner, ["pool"], consistency(0.975)).select("pool", F.struct("mean", "scatter").alias("own"))
    # A group's weight is its rows, not those within the cutoff.
    final = store(final.join(rows.groupBy("pool").agg(F.count(F.lit(1)).alias("n")), "pool"), "mcd-final")
    chains = groups.withColumn("pools", pools())
    for k, name in enumerate("als"):
        chains = chains.withColumn("pool", F.col("pools")[k]).join(final.select("pool", F.col("own").alias(name), F.col("n").alias(f"n_{name}")), "pool", "left")
    parts = [c for name in "als" for c in (F.col(f"n_{name}").alias(f"n_{name}"), F.col(f"{name}.mean").alias(f"m_{name}"), F.col(f"{name}.scatter").alias(f"s_{name}"))]
    chains = chains.select("g_lang", "g_source", *parts)

    def run(frames):
        for frame in frames:
            means, inverses = [], []
            for row in frame.to_dict("records"):
                mean, scatter = None, np.diag(np.square(PRIOR))
                for name in "als":
                    if row[f"m_{name}"] is not None:
                        weight = row[f"n_{name}"] / (row[f"n_{name}"] + prior_rows)
                        own = np.array(row[f"m_{name}"])
                        mean = own if mean is None else weight * own + (1 - weight) * mean
                        scatter = weight * unpacked(row[f"s_{name}"]) + (1 - weight) * scatter
                inverse = np.linalg.inv(scatter)
                means.append(mean)
                inverses.append(np.array([inverse[p] for p in PAIRS]))
            yield frame[["g_lang", "g_source"]].assign(mean=means, precision=inverses)

    schema = T.StructType([*groups.schema.fields, T.StructField("mean", _DOUBLES), T.StructField("precision", _DOUBLES)])
    return store(chains.mapInPandas(run, schema), "mcd"), n_groups


def with_groups(rows: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    return rows.withColumns({"g_lang": F.coalesce(F.col(lang_col).cast("string"), F.lit("")), "g_source": F.coalesce(F.col(source_col).cast("string"), F.lit(""))})


def verdict(cutoff: float) -> Column:
    """False where a base rule fails or the distance is beyond the cutoff; true where no estimate could be made."""
    return ~base_failed() & F.coalesce(distance() <= cutoff, F.lit(True))


#: Quantile of the chi-squared distribution beyond which a text is an outlier (squared distance 25.7): of 0.999, 0.9999, and so on
#: the least that keeps 99 % of the texts labelled good that pass the base rules.
CUTOFF = 0.9999


def judge(docs: DataFrame, cutoff: float = CUTOFF, share: float = 0.75, steps: int = 4, prior_rows: int = 100) -> DataFrame:
    """doc_id, COUNTS, base_failed, distance2 and kept for each row of docs (doc_id, text, lang, source)."""
    own = with_counts(docs.select("doc_id", "text", "lang", "source")).drop("text")
    vectors = store(with_groups(with_vector(own)), "mcd-vectors")
    # What fails a base rule is rejected anyway and doesn't shape the estimates.
    estimates, n = fit(vectors, share, steps, prior_rows)
    limit = chi2_quantile(cutoff, D)
    return attach(vectors, estimates, ["g_lang", "g_source"], n).select("doc_id", *COUNTS, base_failed().alias("base_failed"), distance().alias("distance2"), verdict(limit).alias("kept"))


def accepted(docs: DataFrame, cutoff: float = CUTOFF, share: float = 0.75, steps: int = 4, prior_rows: int = 100) -> DataFrame:
    """The rows, unchanged, that the rules keep. Texts are read twice and, up to BROADCAST_GROUPS groups, not shuffled."""
    vectors = store(with_groups(with_vector(with_counts(docs.select("text", "lang", "source")).drop("text"))), "mcd-vectors")
    estimates, n = fit(vectors, share, steps, prior_rows)
    measured = attach(with_vector(with_groups(with_counts(packed(docs, "text", "lang", "source")))), estimates, ["g_lang", "g_source"], n)
    return measured.where(verdict(chi2_quantile(cutoff, D))).select("row.*")
