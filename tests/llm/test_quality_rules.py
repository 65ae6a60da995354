import re
from collections import Counter

import numpy as np

from chapterloom.llm import quality_rules as Q
from chapterloom.llm import queries


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines), len(re.findall("[A-Z]", text)))


def test_counts_by_brute_force():
    rng = np.random.default_rng(4)
    for n in range(300):
        text = "".join(rng.choice(list("ab  \n\t\r\x0b#|É A\x1c\xa0"), rng.integers(0, 80)))
        assert Q.text_counts(text) == brute_counts(text), repr(text)
    assert Q.text_counts(None) == Q.text_counts("") == (0,) * 7


def vectors(frame):
    w, c, s, dup, rep, lines, up = (frame[k].to_numpy(float) for k in Q.COUNTS)
    return np.stack([np.log((c + 1) / (w + 1)), np.sqrt(s / np.maximum(c, 1)), np.sqrt(dup / np.maximum(lines, 1)), np.sqrt(rep / np.maximum(w, 1)), np.sqrt(up / np.maximum(c, 1))], 1)


def brute_mcd(x, share=0.75, steps=4):
    """Mean and scatter by the same concentration steps in numpy; quantiles are rounded up to the edges of classes."""
    floor = np.array([v[2] for v in Q.VECTOR])

    def estimate(rows, factor):
        mean = rows.mean(0)
        scatter = np.cov(rows.T, bias=True) * factor
        scatter += np.diag(np.maximum(0.1 * floor**2, floor**2 - np.diag(scatter)))
        return mean, scatter

    def d2(mean, scatter):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean)

    def kinds(d):
        return np.ceil(np.log2(np.maximum(d, 1e-9)) * 64)

    def quantile(v, p):
        return np.sort(v)[max(0, int(np.ceil(p * len(v))) - 1)]

    middle = np.array([np.floor(quantile(c, 0.5) * 4096) / 4096 for c in x.T])
    spread = np.array([np.floor(quantile(np.abs(c - m), 0.5) * 4096) / 4096 for c, m in zip(x.T, middle)])
    best = None
    for mean, scatter in ((middle, np.diag(np.maximum(1.4826 * spread, floor) ** 2)), estimate(x, 1.0)):
        for _ in range(steps):
            d = kinds(d2(mean, scatter))
            mean, scatter = estimate(x[d <= quantile(d, share)], Q.consistency(share))
        logdet = np.linalg.slogdet(scatter)[1]
        if best is None or logdet < best[2]:
            best = mean, scatter, logdet
    return estimate(x[d2(*best[:2]) <= Q.chi2_quantile(0.975, Q.D)], Q.consistency(0.975))


def brute_distances(good, prior_rows=100):
    """The squared distance of each row, from the estimates of its source, its language and all rows."""
    x, out = vectors(good), {}
    for (lang, source), group in good.groupby([good.lang.fillna(""), good.source.fillna("")]):
        mean, scatter = None, np.diag(np.square(Q.PRIOR))
        for rows in (good.index >= 0, good.lang.fillna("") == lang, (good.lang.fillna("") == lang) & (good.source.fillna("") == source)):
            own, own_scatter = brute_mcd(x[np.asarray(rows)])
            w = rows.sum() / (rows.sum() + prior_rows)
            mean = own if mean is None else w * own + (1 - w) * mean
            scatter = w * own_scatter + (1 - w) * scatter
        apart = vectors(group) - mean
        out |= zip(group.doc_id, np.einsum("ij,jk,ik->i", apart, np.linalg.inv(scatter), apart))
    return out


def test_query_by_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = {r.doc_id: r for r in queries.op9_quality_rules(spark, d).collect()}
    frame = docs.toPandas()
    counts = np.array([brute_counts(t) for t in frame.text])
    for k, name in enumerate(Q.COUNTS):
        frame[name] = counts[:, k]
    frame["failed"] = (frame.n_words < 50) | (100 * frame.n_repeat_words > 50 * frame.n_words)
    for r in frame.itertuples():
        own = got[r.doc_id]
        assert (own.n_words, own.word_chars, own.n_symbols, own.n_dup_lines, own.n_repeat_words) == tuple(counts[r.Index][:5]) and own.base_failed == r.failed
        assert not (r.failed and own.kept)
    limit = Q.chi2_quantile(Q.CUTOFF, Q.D)
    good = frame[~frame.failed].reset_index(drop=True)
    for i, dist in brute_distances(good).items():
        assert abs(got[i].distance2 - dist) < 1e-6 * max(1, dist) and got[i].kept == (dist <= limit)


def test_outliers_go_and_edges(spark):
    rng = np.random.default_rng(8)
    v = [a + b for a in ("alpha", "beta", "gamma", "delta", "omega", "sigma", "rho", "tau") for b in ("", "ne", "st", "ing", "or", "um")]
    prose = [(i, " ".join(rng.choice(v, 120)) + "\n" + " ".join(rng.choice(v, 60)) + f" w{i}", "en", "a") for i in range(300)]
    junk = [(1000 + i, " | ".join(rng.choice(v, 90)) + f" {i}", "en", "a") for i in range(40)]
    odd = [(2000, None, None, None), (2001, "", "en", None), (2002, "short", None, "b"), (2003, "x " * 300, "en", "a"), (2003, "x " * 300, "en", "a")]
    docs = spark.createDataFrame([(*r, "k") for r in prose + junk + odd], "doc_id long, text string, lang string, source string, n_words string")
    got = {r.doc_id: r for r in Q.judge(docs).collect()}
    assert all(got[r[0]].kept for r in prose) and not any(got[r[0]].kept for r in junk)
    assert all(got[i].base_failed for i in (2000, 2001, 2002, 2003))
    left = Q.accepted(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == list(range(300))
    few = docs.where("doc_id < 20")
    assert Q.accepted(few).count() == 20
    assert Q.accepted(docs.limit(0)).count() == 0 and Q.judge(docs.limit(0)).count() == 0


def test_moderate_outliers_go(spark):
    rng = np.random.default_rng(8)
    v = [a + b for a in ("alpha", "beta", "gamma", "delta", "omega", "sigma", "rho", "tau") for b in ("", "ne", "st", "ing", "or", "um")]
    prose = [(i, " ".join(rng.choice(v, 120)) + "\n" + " ".join(rng.choice(v, 60)) + f" w{i}", "en", "a") for i in range(300)]
    lines = [" ".join(rng.choice(v, 2, False)) for _ in range(60)]
    repeated = (1000, "\n".join(x for _ in range(4) for x in rng.permutation(lines)), "en", "a")  # three quarters of the lines
    symbols = (1001, " ".join(w + "|" * (k % 4 == 0) for k, w in enumerate(rng.choice(v, 200))), "en", "a")  # about 4 %
    docs = spark.createDataFrame([*prose, repeated, symbols], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in Q.judge(docs).collect()}
    assert all(got[r[0]].kept for r in prose)
    assert not any(got[i].base_failed or got[i].kept for i in (1000, 1001))


def test_labelled_texts(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op9_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert len(good) > 200 and sum(good) >= 0.98 * len(good) and bad and not any(bad)


def test_estimate_by_brute_force(spark):
    rng = np.random.default_rng(9)
    docs = [(i, " ".join(rng.choice([a + b for a in ("a", "bb", "Ccc", "d|d", "eeee", "f") for b in "uvwxyz"], 80)) + "\n" + " ".join(rng.choice(["a", "bb"], 8)), "en", "s") for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.distance2 for r in Q.judge(frame).collect()}
    pdf = Q.with_counts(frame).toPandas()
    good = pdf[(pdf.n_words >= 50) & (100 * pdf.n_repeat_words <= 50 * pdf.n_words)]
    assert len(good) > 300
    for i, dist in brute_distances(good.reset_index(drop=True)).items():
        assert abs(got[i] - dist) < 1e-6 * max(1, dist)


def test_chi_squared():
    assert abs(Q.chi2_quantile(0.95, 5) - 11.0705) < 1e-3 and abs(Q.chi2_quantile(0.99, 2) - 9.2103) < 1e-3
