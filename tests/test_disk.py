"""What queries leave on disk: texts are shuffled no more often than they have to be, and tables go when they have been read."""

import os

from pyspark.sql import functions as F

from chapterloom.operators import match, tokens
from chapterloom.plans import derived as D
from chapterloom.plans import queries as Q
from chapterloom.sources.books import token_map
from chapterloom.streaming import loop

DATA = "/root/testdata/sf0.001"
#: As where tables are too large to be broadcast.
LARGE = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def held(spark, conf):
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return before


def test_replies_need_no_shuffle(spark):
    before = held(spark, LARGE)
    try:
        assert shuffles(D.replies(spark, DATA)) == 0 and shuffles(Q._loop_events(spark, DATA)[1]) == 0
    finally:
        held(spark, before)
    lines = D.tokened(spark, DATA).join(D.term_lines(spark, DATA), ["slug", "chapter"], "left").where("chapter % 7 <> 2 and chapter % 29 <> 8")
    rows = D.replies(spark, DATA).join(lines.select("slug", "chapter", "block"), ["slug", "chapter"])
    assert rows.where("block is not null").count() > 20
    assert rows.where(~F.contains("raw", F.concat(F.lit("_terms>\n"), F.coalesce("block", F.lit("none")), F.lit("\n</new")))).count() == 0


def test_gate_shuffles_a_text_once(spark, monkeypatch):
    replies = spark.createDataFrame([("b", 1, 1, "[[G1]] and [[G2]]"), ("b", 2, 2, "[[G2]] [[NEW:독|Poison]]"), ("c", 1, 0, "no glossary")], "slug string, chapter int, size int, raw string")
    chapters = spark.createDataFrame([("b", 1, "검이 강에"), ("b", 2, "검"), ("b", 3, "강")], "slug string, chapter int, text string")
    terms = spark.createDataFrame([("b", 1, "검", "Sword", "item", "", True), ("b", 2, "강", "River", "place", "", True)], "slug string, token_id int, korean string, english string, category string, note string, enforce boolean")
    want = sorted(map(tuple, loop.judged(replies, terms, chapters).collect()))
    assert want == [
        ("b", 1, "NEEDS_HUMAN", ["[[G2]]"], 1, 0, 1, 0, None, None, 1, "[withheld: [[G2]]]"),
        ("b", 2, "ok", [], 0, 1, 0, 1, 1, ["검"], 2, "River Poison"),
        ("c", 1, "ok", [], 0, 0, 0, 0, 0, [], 0, "no glossary"),
    ]
    monkeypatch.setattr(match, "BROADCAST_TERMS", -1)
    before = held(spark, LARGE | {"spark.sql.requireAllClusterKeysForCoPartition": "false"})
    try:
        made = loop.judged(replies, terms, chapters)
        assert shuffles(made) == 3  # replies, chapters, terms
        assert sorted(map(tuple, made.collect())) == want
    finally:
        held(spark, before)


def test_loop_leaves_its_rows_alone(spark, monkeypatch):
    paths, there = {}, Q.new_path
    monkeypatch.setattr(Q, "new_path", lambda s, name: paths.setdefault(name, there(s, name)))
    rows, chapters = Q._looped(spark, DATA)
    left = {name for name, path in paths.items() if os.path.exists(path.removeprefix("file://"))}
    assert left == {"loop"} and loop.loop_rows(spark, rows, "reply").join(chapters, ["slug", "chapter"], "left_semi").count() > 50
    assert not {"body", "translation"} & set(loop.parsed_events(spark.createDataFrame([], loop.EVENTS)).columns)


def test_reports_shuffle_documents_once_at_most(spark, monkeypatch):
    before = held(spark, LARGE)
    try:
        assert shuffles(Q._finished(spark, DATA, repaired=True)[0]) == 0
        monkeypatch.setattr(match, "BROADCAST_TERMS", -1)
        rows = Q._finished(spark, DATA, repaired=True)[0]
        assert shuffles(rows) == 2 and rows.count() == D.documents(spark, DATA).count()  # documents, terms
    finally:
        held(spark, before)


def test_one_row_says_what_the_operators_say(spark):
    terms = spark.createDataFrame([("b", 1, "검", "Sword", "item", "", True), ("b", 2, "검은", "Black", "other", "", False)], "slug string, token_id int, korean string, english string, category string, note string, enforce boolean")
    data = [("b", 1, "검은 검", "a [[G1]]", "a [[G7]] [[NEW:독|Poison]]", True), ("b", 2, "검은", "black [[G9]]", "[[G2]]", None), ("b", 3, None, "x", "[[G1]]", False), ("b", 4, "검", None, None, False), ("c", 1, "검", "[[G1]]", "y", True), ("b", None, "검", "z", "[[G8]]", True), (None, 1, "검", "[[G1]]", "[[NEW:독]]", True)]
    rows = spark.createDataFrame(data, "slug string, chapter int, source string, raw string, sent string, rejected boolean")
    gated = tokens.fail_closed_gate(tokens.substitute(rows.drop("sent", "source"), token_map(terms)))
    scored = match.check_adherence(rows.select("slug", "chapter", F.col("source").alias("text")), gated.select("slug", "chapter", F.col("body").alias("text")), terms)
    defects = tokens.defect_table(rows.select("slug", "chapter", "source", F.col("sent").alias("raw")), terms)
    want = tokens.chapter_report(gated, scored, defects, rows)
    got = tokens.finish(rows, terms)
    assert got.columns == [*want.columns, "body"] and sorted(map(repr, got.drop("body").collect())) == sorted(map(repr, want.collect()))
