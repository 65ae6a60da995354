import random
import re

import numpy as np
from pyspark.sql import functions as F

from chapterloom.llm import signature_join as S


def brute(rows, k=5, percent=75):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[a : a + k]) for a in range(max(1, len(w) - k + 1))) if w else frozenset()
    label = {i: i for i in sets}

    def root(a):
        while label[a] != a:
            a = label[a]
        return a

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            x, y = sets[i], sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def noisy(seed, n):
    random.seed(seed)
    v = [f"w{i}" for i in range(30)]
    base = [[random.choice(v) for _ in range(random.choice([3, 8, 40, 200, 900]))] for _ in range(8)]
    shared = [random.choice(v) for _ in range(30)]
    rows = []
    for i in range(n):
        b = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 5, 10])):
            b[random.randrange(len(b))] = random.choice(v)
        if random.random() < 0.3:
            b += shared
        rows.append((i, None if i == 7 else random.choice([" ", "\n"]).join(b)))
    return rows


def test_components_by_brute_force(spark):
    rows = noisy(5, 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # Small chunks and few pairs a key, so that every way is taken.
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in S.components(df, rounds=1, chunk_tokens=2000, chunk_rows=16, key_pairs=1).collect()}
    assert got == brute(rows)


def test_edges_and_one_of_each(spark):
    long = " ".join(f"t{i}" for i in range(400))
    rows = [(3, long, "a"), (1, long.upper(), "b"), (2, long + " more", "c"), (4, None, "d"), (5, " \n", "e"), (6, "just four words here", "f"), (7, "JUST four  words here", "g"), (8, "alone", "h"), (8, "alone", "h"), (None, long, "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in S.components(df).collect()), key=str)
    assert got == sorted([(3, 396, 1), (1, 396, 1), (2, 397, 1), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (8, 1, 8), (8, 1, 8), (None, 396, 1)], key=str)
    df = df.select("text", "n", "doc_id")
    kept = S.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 4, 5, 6, 8]
    assert S.components(df.limit(0)).count() == 0


def test_an_id_with_several_texts_is_one_node(spark):
    a, b = " ".join(f"a{i}" for i in range(90)), " ".join(f"b{i}" for i in range(90))
    rows = [(1, a), (5, a), (5, b), (9, b), (9, ""), (12, ""), (12, "x"), (3, "x"), (20, b), (20, b), (30, ""), (None, b), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in S.components(df).collect()}
    assert got == {(1, 1), (5, 1), (9, 1), (20, 1), (3, 3), (12, 3), (30, 30), (None, 1), (None, None)}
    kept = S.one_of_each(df.withColumn("row", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "row"] and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 3, 30]


def test_parts_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_IDS", 0)
    rows = noisy(6, 60)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in S.components(spark.createDataFrame(rows, "doc_id long, text string"), chunk_tokens=500).collect()}
    assert got == brute(rows)


def test_sets_with_the_same_name_get_other_names(spark):
    rows = noisy(9, 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    described = S.describe(df, 5)
    named, naming = S.named_sets(described.cache(), 11)
    assert naming.taken  # 2,048 names are too few for these sets
    sets = {x.tobytes(): naming(x) for x in S.Shingler(5)([t for _, t in rows]) if len(x)}
    assert len(set(sets.values())) == len(sets)
    by_column = {r.node for r in named.where("n > 0").select("node").distinct().collect()}
    assert by_column == set(sets.values())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in S.components(df, name_bits=11).collect()}
    assert got == brute(rows)
    # Whole names, one of them taken: both ways of naming agree.
    whole, row = S.Naming(), S.Shingler(5)([rows[0][1]])[0]
    other = S.Naming(frozenset([whole(row)]))
    assert other(row) != whole(row) and {r.n for r in named.where("doc_id = 0").select(other.column().alias("n")).collect()} == {other(row)}


def test_tree_loses_no_link():
    random.seed(2)
    universe = np.unique(np.random.default_rng(1).integers(0, 2**63, 4000).astype(np.uint64))
    sets = []
    for _ in range(60):
        base = np.random.default_rng(random.randrange(6)).choice(universe, random.choice([10, 100, 600]), replace=False)
        sets.append(np.unique(base[np.random.random(len(base)) > random.choice([0, 0.05, 0.2])]))
    sets = [x for x in sets if len(x)]
    n, marks = np.array([len(x) for x in sets]), S.bitmaps(sets)
    tree = S.SignatureTree(marks, n, n - np.bitwise_count(marks).sum(1), np.arange(len(sets)), 75)
    found = {tuple(sorted(p)) for i, j in tree.pairs() for p in zip(i.tolist(), j.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            if S.linked(sets[i], sets[j], 75):
                assert (j, i) in found
