from itertools import permutations

from chapterloom.llm import filter_audit as A
from chapterloom.llm import queries

WORDS = " ".join(f"w{i}" for i in range(60))
DOCS = [
    (1, WORDS, "a", 0),
    (2, WORDS, "a", 0),
    (2, WORDS, "a", 0),  # the row before again: a document of its own
    (3, WORDS + " #", "a", 0),
    (4, "the " * 80, "b", 0),
    (5, "The\x0bTHE " * 40, "b", 0),
    (6, None, "b", 0),
    (7, "", None, 0),
    (None, "", "b", 0),  # without an id: repeats nothing
    (8, "x\u3000y é " + WORDS.upper(), "a", 0),
    (9, "\U0001f600" * 19 + "A", "a", 0),  # one capital in 20 code points
    (10, "y" * 200_000 + " $", "c", 0),
    (1, WORDS, "c", 0),
]
SCHEMA = "doc_id long, text string, source string, mask int"
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (4, 1, None), (6, 1, 1), (None, 1, 1)]


def masks(docs):
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, source, *_ in docs:
        text = text or ""
        words = text.translate({c: " " for c in range(9, 14)}).split(" ")
        words = [w for w in words if w]
        fails = [
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text),
            i is not None and i > least[text],
        ]
        out.append((i, source or "", fails))
    return out


def brute(docs, labels):
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            good, bad = marks.get(i, (False, False))
            marks[i] = good or quality == 1, bad or toxic == 1
    rows, out = masks(docs), {}
    for part in {r[1] for r in rows}:
        for order in permutations("ABCDE"):
            left = [(f, *marks.get(i, (False, False))) for i, p, f in rows if p == part]
            everyone = left
            for step, letter in enumerate(order, 1):
                k = "ABCDE".index(letter)
                gone = [r for r in left if r[0][k]]
                left = [r for r in left if not r[0][k]]
                failing = sum(r[0][k] for r in everyone)
                alone = sum(r[0][k] and sum(r[0]) == 1 for r in everyone)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), alone, sum(r[1] for r in gone), sum(r[2] for r in gone)]
    for (part, order, step), row in out.items():
        row.append(sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == order[step - 1] and len(v) >= 6))
    return {k: tuple(v) for k, v in out.items()}


def test_against_brute_force(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)  # mask: a name that the operator uses itself
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    rows = A.audit(A.failures(docs, labels)).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(rows) == len(got) == 4 * 600
    assert got == brute(DOCS, LABELS)


def test_intervals_cover_each_order_once():
    for k in (1, 2, 3, 5):
        orders = list(permutations(range(k)))
        assert [A.rank(o, k) for o in orders] == list(range(len(orders)))
        seen = {}
        for mask, f, step, lo, hi in A.intervals(k):
            for r in range(lo, hi):
                assert (mask, r) not in seen
                seen[mask, r] = step, f
        for (mask, r), (step, f) in seen.items():
            first = next(i for i, x in enumerate(orders[r]) if mask >> x & 1)
            assert (step, f) == (first + 1, orders[r][first])
        assert len(seen) == (2**k - 1) * len(orders)


def test_empty_and_other_filters(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert A.audit(A.failures(docs.limit(0), labels)).count() == 0
    assert A.audit(A.failures(docs, labels.limit(0))).where("good_lost > 0 or toxic_lost > 0").count() == 0
    two = spark.createDataFrame([("p", 1, 0, 0), ("p", 3, 1, 0), ("p", 0, 0, 0)], "part string, fails int, good int, toxic int")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in A.audit(two, "XY").collect()}
    assert got == {("XY", 1): (1, 2, 0, 1, 3), ("XY", 2): (1, 0, 1, 0, 1), ("YX", 1): (2, 1, 0, 0, 1), ("YX", 2): (1, 1, 1, 1, 3)}


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    expected = {}
    for (part, order, step), row in brute(docs, labels).items():
        expected[part, order, step] = row
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in queries.op11_filter_audit(spark, sf).collect()}
    assert got == expected
