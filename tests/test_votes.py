import random
import re

from chapterloom.operators import glossary, votes

MINED = "slug string, chapter int, pos int, korean string, english string, category string, note string, enforce boolean"


def rows(seed, books="abc", chapters=12):
    random.seed(seed)
    spell = ["검 성", "검성", "검성(劍)", "강", "강 (강)", "독"]
    return [(b, c, p, random.choice(spell), random.choice(["Sword", "Saint", "River"]), random.choice(["item", "place"]), f"n{c}", True) for b in books for c in range(1, chapters + 1) for p in range(random.randint(0, 4))]


def bare(df):
    return sorted((r.slug, r.korean, r.english, r.category, r.note) for r in df.collect())


def test_any_order_of_increments(spark, tmp_path):
    mined = rows(1)
    frame = lambda x: spark.createDataFrame(x, MINED)
    parts = [[r for r in mined if (r[1] * 7 + ord(r[0])) % 4 == k] for k in range(4)]
    path, given = f"{tmp_path}/a", {}
    for k in (2, 0, 3, 0, 1):  # one comes twice
        touched = votes.add_increment(frame(parts[k]), path, f"i{k}")
        now = {(r.slug, r.korean): r.token_id for r in votes.current_terms(spark, path).collect()}
        by_book = {}
        for (slug, _), i in now.items():
            by_book.setdefault(slug, []).append(i)
        assert all(sorted(i) == list(range(1, len(i) + 1)) for i in by_book.values())
        assert {tuple(r) for r in touched.collect()} <= {tuple(r) for r in votes.current_terms(spark, path).collect()}
        ids = {(r.slug, r.key): r.token_id for r in spark.read.parquet(f"{path}/ids").collect()}
        assert given.items() <= ids.items()
        given = ids
    assert bare(votes.current_terms(spark, path)) == bare(glossary.merge_terms(frame(mined)))
    # Chapters that were counted, and rows of no book or chapter, add nothing under another name.
    again = parts[1] + [(None, 1, 0, "신", "God", "item", "", True), ("a", None, 0, "신", "God", "item", "", True)]
    assert votes.add_increment(frame(again), path, "late").count() == 0
    assert bare(votes.current_terms(spark, path)) == bare(glossary.merge_terms(frame(mined)))
    assert votes.add_increment(frame([]), path, "none").count() == 0


def test_in_order_of_chapters_ids_are_those_of_one_run(spark, tmp_path):
    mined = rows(2)
    for k in range(3):
        votes.add_increment(spark.createDataFrame([r for r in mined if (r[1] - 1) // 4 == k], MINED), str(tmp_path), str(k))
    assert sorted(map(tuple, votes.current_terms(spark, str(tmp_path)).collect())) == sorted(map(tuple, glossary.merge_terms(spark.createDataFrame(mined, MINED)).collect()))


def test_reads_only_touched_buckets(spark, tmp_path):
    votes.add_increment(spark.createDataFrame(rows(3, [f"b{i}" for i in range(40)], 2), MINED), str(tmp_path), "0")
    out = votes.add_increment(spark.createDataFrame(rows(4, ["b1"], 5), MINED), str(tmp_path), "1")
    plan = out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert sum("bucket" in f for f in found) >= 2  # votes and ids
