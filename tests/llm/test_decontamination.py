import random
import re
import time

from chapterloom.llm import decontamination as C

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []


def brute(docs, items, window):
    wanted = {}
    for i, text in items:
        x = words(text)
        for a in range(max(1, len(x) - window + 1) if x else 0):
            wanted.setdefault(tuple(x[a : a + window]), set()).add(i)
    out = []
    for text in docs:
        x = words(text)
        hit, found, longest = set(), set(), 0
        for w, ids in wanted.items():
            for a in range(len(x) - len(w) + 1):
                if tuple(x[a : a + len(w)]) == w:
                    hit |= set(range(a, a + len(w)))
                    found |= ids
        for _, item in items:
            y = words(item)
            for a in range(len(x)):
                for b in range(len(y)):
                    n = 0
                    while a + n < len(x) and b + n < len(y) and x[a + n] == y[b + n]:
                        n += 1
                    if n >= min(window, len(y)) and (n >= window or b == 0):
                        longest = max(longest, n)
        out.append((len(x), len(hit), sorted(map(str, found)), longest))
    return out


def test_shards_by_brute_force():
    random.seed(11)
    for _ in range(150):
        v = ["a", "b", "c", "É9", "Z"][: random.randint(1, 5)]
        docs = [None if random.random() < 0.1 else " ".join(random.choice(v) for _ in range(random.randint(0, 30))) for _ in range(random.randint(0, 6))]
        items = [(i, " ".join(random.choice([*v, "q"]) for _ in range(random.randint(0, 12)))) for i in range(random.randint(0, 4))]
        window = random.choice([1, 2, 3, 5, 10])
        items = [x for x in items if words(x[1])]
        test = C.Suffixes(items, window)
        shard = C.Shard(docs, window)
        hit, pairs, longest = C.search(shard, test, random.choice([1, 2, 200_000]))
        n_hit = [int((hit & (shard.word > 0) & (shard.doc == d)).sum()) for d in range(len(docs))]
        ids = [sorted({test.items[i] for i in test.items_in([c for d, c in pairs.tolist() if d == k])}) for k in range(len(docs))]
        got = list(zip(shard.n_words.tolist(), n_hit, ids, longest[:, 0].tolist()))
        for text, (size, at, item) in zip(docs, longest.tolist()):
            found, other = words(text)[at : at + size], words(items[item][1]) if items else []
            assert not size or any(other[b : b + size] == found for b in range(len(other)))
        assert got == brute(docs, items, window), (docs, items, window)


def test_longest_match_is_the_first_of_the_first_item():
    random.seed(12)
    for _ in range(60):
        doc = [random.choice("abc") for _ in range(40)]
        items = [(i, " ".join(random.choice("abc") for _ in range(random.randint(3, 20)))) for i in range(4)]
        test, shard = C.Suffixes(items, 3), C.Shard([" ".join(doc)], 3)
        size, at, item = C.search(shard, test)[2][0].tolist()
        inside = lambda a, n, i: f" {' '.join(doc[a : a + n])} " in f" {items[i][1]} "
        best = max(((n, -a, -i) for a in range(40) for n in range(3, 41 - a) for i in range(4) if inside(a, n, i)), default=None)
        assert best == ((size, -at, -item) if size else None)


def test_one_word_repeated_takes_no_longer(spark):
    began = time.process_time()
    many, text = 20_000, "w " * 20_000
    test, shard = C.Suffixes([(1, text), (2, "w " * 50)], 10), C.Shard([text, "x", "w " * 9], 10)
    hit, pairs, longest = C.search(shard, test)
    assert hit.sum() == many and [test.items_in([c]).tolist() for _, c in pairs.tolist()] == [[0, 1]] and longest.tolist() == [[many, 0, 0], [0, 0, 0], [0, 0, 0]]
    assert time.process_time() - began < 5


def test_blocks_edges_and_removal(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"x {passage.upper()} y", 5), (2, None, 6), (3, "", 7), (4, "clean text", 8), (4, "clean text", 8), (5, "shorty!", 9), (6, "w " * 60_000 + passage, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame([(10, passage), (9, passage), (None, "shorty"), (3, None), (4, " .")], "item_id long, text string")
    first = C.scan(docs, bench).where("doc_id in (1, 4)").sort("doc_id").collect()
    assert [(r.longest_at, r.longest_item) for r in first] == [(1, "9"), (None, None), (None, None)]
    for size in (16_000_000, 40):  # one block, and a block for each item
        got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.longest_match) for r in C.scan(docs, bench, block_chars=size).collect()}
        assert got == {1: (13, 11, ["10", "9"], 11), 2: (0, 0, [], 0), 3: (0, 0, [], 0), 4: (2, 0, [], 0), 5: (1, 1, [], 1), 6: (60_011, 11, ["10", "9"], 11)}
        kept = C.clean(docs, bench, block_chars=size)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 4]
    assert C.clean(docs, bench.limit(0)).count() == 7 and C.scan(docs.limit(0), bench).count() == 0


def test_equal_texts_with_equal_items_make_no_pairs(spark):
    passage = "one two three four five six seven eight nine ten"
    test, shard = C.Suffixes([(i, passage) for i in range(3000)], 10), C.Shard([passage] * 3000, 10)
    hit, pairs, _ = C.search(shard, test)
    assert hit.sum() == 30_000 and len(pairs) == 3000
    docs = spark.range(60).selectExpr("id AS doc_id", f"'{passage}' AS text").coalesce(1)
    bench = spark.range(5000).selectExpr("id AS item_id", f"concat('{passage}', if(id % 5 = 0, ' w', '')) AS text")
    want = sorted(map(str, range(5000)))
    for size in (4_000_000, 60_000):
        rows = C.scan(docs, bench, block_chars=size).collect()
        assert len(rows) == 60 and all(r.item_ids == want and r.n_hit == 10 for r in rows)
    assert C.clean(docs, bench).count() == 0
