import difflib

import pytest
from pyspark.sql import functions as F

from chapterloom.operators import context, costs, glossary, match, parse, tokens
from chapterloom.sources import books
from chapterloom.streaming import incremental

TERM = "slug string, token_id int, korean string, english string, category string, note string, enforce boolean"
GLOSSARY = [("b", 1, "아스테르", "Aster", "person", "", True), ("b", 2, "아스테르 상단", "Aster Trading", "organization", "big", True), ("b", 3, "검", "Sword", "item", "", False)]


@pytest.fixture
def terms(spark):
    return spark.createDataFrame(GLOSSARY, TERM)


def reply(translation="t", terms="NONE", summary="s"):
    parts = [f"<translation>{translation}</translation>" if translation is not None else "", f"<new_glossary_terms>\n{terms}\n</new_glossary_terms>" if terms is not None else "", f"<chapter_summary>{summary}</chapter_summary>" if summary is not None else ""]
    return "\n".join(parts)


def test_parse_translations(spark):
    cases = [
        (reply(), None, 0),
        (reply(terms="none so far"), None, 0),
        (reply(terms="NONE\n`검 | Sword | item | n | Soft`"), None, 1),
        (reply(translation=" "), "no translation", None),
        (reply(summary=None, terms=None), "no chapter_summary", None),
        (reply(terms=None), "no new_glossary_terms", None),
        (reply(terms="검 | Sword"), "too few fields", None),
        (reply(terms="검 | Sword | item\n | x | item"), "blank korean", None),
        (reply(terms="검 | Sword | weapon"), "unknown category", None),
    ]
    df = spark.createDataFrame([("b", i, c[0]) for i, c in enumerate(cases)], "slug string, chapter int, raw string")
    rows = parse.parse_translations(df).sort("chapter").collect()
    for r, (_, error, n) in zip(rows, cases):
        assert r.parse_error == error and (r.terms is None if n is None else len(r.terms) == n)
    assert rows[2].terms[0].enforce is False and rows[2].terms[0].note == "n"


def test_parse_json_and_judge(spark):
    raw = ['```json\n{"translation": "t", "new_glossary_terms": [{"korean": "검", "english": "S", "category": "item"}], "chapter_summary": "s"}\n```', '{"translation": 1, "new_glossary_terms": [], "chapter_summary": "s"}', '{"translation": "t", "new_glossary_terms": [], "chapter_summary": ""}', "[]", "{", '{"translation": "t", "new_glossary_terms": [3], "chapter_summary": "s"}']
    rows = parse.json_reply(spark.createDataFrame(list(enumerate(raw)), "k int, raw string")).sort("k").collect()
    assert [r.parse_error for r in rows] == [None, "bad translation", "bad chapter_summary", "no object", "no json", "too few fields"]
    judged = ["<overall_winner>It's a tie</overall_winner><voice>b</voice><rationale> r </rationale>", "<overall_winner>nobody</overall_winner>", "x"]
    rows = parse.parse_judge(spark.createDataFrame(list(enumerate(judged)), "k int, raw string")).sort("k").collect()
    # The article a counts as a verdict.
    assert [(r.overall, r.parse_error) for r in rows] == [("A", None), (None, "no verdict"), (None, "no overall_winner")]
    assert rows[0].dimensions["voice"] == "B" and rows[0].dimensions["accuracy"] == "?" and rows[0].rationale == "r"


def test_vote_and_clean(spark):
    mined = [("b", 2, 0, "데스 나이트", "Death Knight/Lord", "person", "x", False), ("b", 1, 0, "데스나이트 (주)", "Doom Knight", "item", "y", True), ("b", 3, 1, "데스나이트", "Death Knight", "place", "z", True), ("b", 2, 1, "검", "A", "item", "", True), ("b", 1, 1, "검", "B", "item", "", True)]
    df = spark.createDataFrame(mined, "slug string, chapter int, pos int, korean string, english string, category string, note string, enforce boolean")
    clean = {(r.chapter, r.pos): r for r in glossary.clean_terms(df).collect()}
    assert clean[2, 0].english == "Death Knight" and clean[2, 0].fixed and clean[2, 0].enforce
    got = [tuple(r) for r in glossary.merge_terms(glossary.clean_terms(df)).sort("token_id").collect()]
    # Two votes win over the earlier rendering; one vote each goes to the earlier chapter.
    assert got == [("b", 1, "데스나이트", "Death Knight", "person", "x", True), ("b", 2, "검", "B", "item", "", True)]
    again = [tuple(r) for r in glossary.merge_terms(glossary.clean_terms(df.repartition(7))).sort("token_id").collect()]
    assert again == got


def test_append_never_changes_what_exists(spark, terms):
    new = spark.createDataFrame([("b", 2, 0, "검", "Blade", "item", "", True), ("b", 1, 1, "창", "Spear", "item", "", False), ("b", 3, 0, "창", "Lance", "item", "", True), ("c", 1, 0, "검", "Sword", "item", "", True)], "slug string, chapter int, pos int, korean string, english string, category string, note string, enforce boolean")
    got = sorted(tuple(r)[:4] for r in glossary.append_terms(terms, new).collect())
    assert got == sorted([g[:4] for g in GLOSSARY] + [("b", 4, "창", "Spear"), ("c", 1, "검", "Sword")])
    entities = spark.createDataFrame([("b", 9, 0, " 창 ", "Pike"), ("b", 1, 0, "활", "")], "slug string, chapter int, pos int, korean string, english string")
    folded = {r.korean: r for r in glossary.fold_back(terms, entities, new).where("slug = 'b'").collect()}
    assert folded["창"].english == "Pike" and folded["창"].category == "other" and "활" not in folded and folded["검"].english == "Sword"


def test_forgotten_terms_with_superset_masking(spark, terms):
    pairs = spark.createDataFrame([("b", 1, "아스테르 상단이 왔다", "[[G2]] came"), ("b", 2, "아스테르 상단과 아스테르는", "[[G2]] and Aster"), ("b", 3, "검이 있다", "a sword [[G9]] [[G9]]"), ("b", 4, "아스테르는", "[[NEW:활|Bow]]")], "slug string, chapter int, source string, raw string")
    got = {r.chapter: r for r in tokens.defect_table(pairs, terms).collect()}
    assert [[t.token for t in got[k].forgotten] for k in (1, 2, 3, 4)] == [[], ["[[G1]]"], [], ["[[G1]]"]]
    assert got[3].invalid == ["[[G9]]", "[[G9]]"] and [got[k].needs_repair for k in (1, 2, 3, 4)] == [False, True, True, True]


def test_adherence_rollup(spark, terms):
    chapters = spark.createDataFrame([("b", 1, "아스테르는 검을"), ("b", 2, "검"), ("b", 3, "없음")], "slug string, chapter int, text string")
    translations = spark.createDataFrame([("b", 1, "Aster drew a blade"), ("b", 2, "the sword")], "slug string, chapter int, text string")
    checked = match.check_adherence(chapters, translations, terms)
    rows = {(r.slug, r.chapter): (r.present, r.ok, r.pct) for r in match.adherence_rollup(checked).collect()}
    assert rows[("b", 1)] == (2, 1, 50) and rows[("b", None)] == (3, 2, 67) == rows[(None, None)] and ("b", 3) not in rows


def test_repair_and_gate(spark):
    a = "He met [[G1]] at the gate and they spoke of the long war until dawn."
    rows = [("b", 1, a, a.replace("[[G1]]", "[[G2]] [[G3]]")), ("b", 2, a, "Something else entirely happened in this version here!"), ("b", 3, a, None)]
    bounded = tokens.repair_bounds(spark.createDataFrame(rows, "slug string, chapter int, raw string, repaired string"))
    got = {r.chapter: (r.ratio, r.in_bounds) for r in bounded.collect()}
    assert got[1] == (1.0, True) or got[1][0] > 0.95 and got[1][1]
    bare = "He met  at the gate and they spoke of the long war until dawn."
    assert got[2] == (pytest.approx(difflib.SequenceMatcher(None, bare, rows[1][3]).ratio()), False) and got[3] == (None, False)
    chosen = {r.chapter: r for r in tokens.choose_translation(bounded.select("slug", "chapter", "raw"), bounded).collect()}
    assert [chosen[k].repaired for k in (1, 2, 3)] == [True, False, False] and chosen[2].rejected
    subs = spark.createDataFrame([("b", 1, "fine", []), ("b", 2, "x [[G9]]", ["[[G9]]", "[[A]]", "[[G9]]"])], "slug string, chapter int, body string, leaked array<string>")
    gate = {r.chapter: (r.status, r.body) for r in tokens.fail_closed_gate(subs).collect()}
    assert gate == {1: ("ok", "fine"), 2: ("NEEDS_HUMAN", "[withheld: [[A]], [[G9]]]")}
    assert not any("[[" in b and s == "ok" for s, b in gate.values())


def test_windows_differ_with_gaps(spark):
    rows = [("b", c, s) for c, s in ((1, "a"), (2, None), (3, "c"), (4, None), (5, "e"), (30, "z"), (31, None))]
    df = spark.createDataFrame(rows, "slug string, chapter int, summary string")
    by_number = {r.chapter: [s.chapter for s in r.prior] for r in context.context_window(df, 3).collect()}
    by_count = {r.chapter: [s.chapter for s in r.prior] for r in context.last_k_summaries(df, 2).collect()}
    assert by_number == {1: [], 2: [1], 3: [1], 4: [1, 3], 5: [3], 30: [], 31: [30]}
    assert by_count == {1: [], 2: [1], 3: [1], 4: [1, 3], 5: [1, 3], 30: [3, 5], 31: [5, 30]}
    assert {(r.chapter, r.n_summaries) for r in context.arc_requests(df).collect()} == {(5, 3), (30, 4)}


def test_arcs_are_carried_on(spark):
    arcs = [("b", 5, " one "), ("b", 10, None), ("b", 15, " "), ("b", 20, "two"), ("b", 20, "zwei"), ("b", 22, "not due"), (None, 5, "x")]
    arcs = spark.createDataFrame(arcs, "slug string, chapter int, arc string")
    rows = spark.createDataFrame([("b", c, "old") for c in (0, 1, 5, 6, 10, 11, 20, 21, 22, 23, 60)] + [("c", 9, "old"), (None, 9, "old")], "slug string, chapter int, arc string")
    got = {(r.slug, r.chapter): r.arc for r in context.with_arc(rows, arcs).collect()}
    want = dict.fromkeys([(r.slug, r.chapter) for r in rows.collect()]) | {("b", c): " one " for c in (6, 10, 11, 20)} | {("b", c): "two" for c in (21, 22, 23, 60)}
    assert got == want
    assert {r.arc for r in context.with_arc(rows, arcs.limit(0)).collect()} == {None} and context.with_arc(rows.limit(0), arcs).count() == 0


def test_arc_requests_of_a_long_book(spark):
    n, every = 5000, 50
    told = {c: f"s{c}" for c in range(1, n + 1) if c % 7 and not 100 < c <= 200}
    arc = {c: f"arc {c}" for c in range(every, n, every) if c % 3}
    summaries = spark.createDataFrame([("b", c, told.get(c)) for c in range(1, n + 1)] + [("short", 50, None), ("short", 51, "x"), ("b", None, "no number")], "slug string, chapter int, summary string")
    arcs = spark.createDataFrame([("b", c, arc.get(c)) for c in range(every, n, every)], "slug string, chapter int, arc string")
    rows = context.arc_requests(summaries, every, "P", arcs).collect()
    assert sorted(r.chapter for r in rows) == list(range(every, n, every))
    for r in rows:
        lines = [f"Ch.{c}: {s}" for c, s in told.items() if c <= r.chapter]
        story = next((arc[c] for c in range(r.chapter - every, 0, -every) if c in arc), "(empty)")
        assert r.n_summaries == len(lines)
        assert r.message == f"P\n\n<current_story_so_far>\n{story}\n</current_story_so_far>\n\n<recent_chapter_summaries>\n" + "\n".join(lines) + "\n</recent_chapter_summaries>"


def test_requests_shuffle_texts_once(spark, terms, monkeypatch):
    rows = [("b", c, f"text {c}") for c in (1, 2, 2, 6, 7, 40)] + [("c", 3, "no glossary"), (None, 3, "no book"), ("b", None, "no number"), ("b", 8, " ")]
    chapters = spark.createDataFrame(rows, "slug string, chapter int, text string")
    summaries = spark.createDataFrame([("b", c, f"s{c}") for c in range(1, 30)], "slug string, chapter int, summary string")
    arcs = spark.createDataFrame([("b", 5, "one")], "slug string, chapter int, arc string")
    set_to = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in set_to}
    try:
        for k, v in set_to.items():
            spark.conf.set(k, v)
        made = context.translation_requests(chapters, summaries, terms, arcs=arcs)
        plan = made._jdf.queryExecution().executedPlan().toString().split("\n")
        deep = [len(x) - len(x.lstrip(" :+-*0123456789()")) for x in plan]
        at = next(n for n, x in enumerate(plan) if "Scan" in x and "text#" in x)
        above, depth = [], len(plan[at])
        for n in range(at, -1, -1):
            if plan[n].strip() and plan[n].lstrip(" :+-").startswith(("+-", "Exchange", "Sort", "*", "Project", "Filter", "BroadcastHashJoin", "ShuffledHashJoin", "SortMergeJoin", "Scan")) and deep[n] < depth:
                above.append(plan[n].lstrip(" :+-*0123456789()").split(" ")[0])
                depth = deep[n]
        assert above.count("Exchange") == 1 and "Sort" not in above and "SortMergeJoin" not in above, above
        got = sorted(map(tuple, made.collect()), key=str)
        monkeypatch.setattr(context, "BROADCAST_BLOCKS", -1)
        assert sorted(map(tuple, context.translation_requests(chapters, summaries, terms, arcs=arcs).collect()), key=str) == got
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    told = {(r[0], r[1]): r[2] for r in got}
    assert len(got) == 9 and "story_so_far" in told["b", 6] and "story_so_far" not in told["b", 2] and "Ch.5: s5" in told["b", 6] and "Glossary" not in told["c", 3]


def test_messages(spark, terms):
    df = spark.createDataFrame([("b", 1, " text ", " arc ", [(1, "x")]), ("b", 2, "t", "", []), ("b", 3, " \n", "a", [])], "slug string, chapter int, text string, arc string, prior array<struct<chapter:int,summary:string>>")
    got = [r.message for r in context.user_message(df).sort("chapter").collect()]
    assert got == ["<story_so_far>\narc\n</story_so_far>\n\n<previous_chapter_summaries>\nCh.1: x\n</previous_chapter_summaries>\n\n<chapter>\ntext\n</chapter>", "<chapter>\nt\n</chapter>", None]
    assert context.glossary_table(terms).first().table == "아스테르 | Aster | person\n아스테르 상단 | Aster Trading | organization | big\n검 | Sword | item"
    block = context.placeholder_block(terms).first().block
    assert "아스테르 상단 | [[G2]]  (big)" in block and "Aster Trading" not in block and "검 | Sword | item" in block
    est = context.token_estimate(spark.createDataFrame([("가나 abcdefg",), (None,)], "text string")).collect()
    assert [r.estimate for r in est] == [4, 0]


def test_costs(spark):
    calls = spark.createDataFrame([("t", "large", 9000, 5000, 0, 0, False), ("t", "large", 9000, 5000, 0, 0, True), ("t", "small", 1000, 0, 10000, 10000, False), ("t", "odd", 1, 1, 0, 0, False)], "tag string, model string, input_tokens long, output_tokens long, cache_read_tokens long, cache_write_tokens long, batch boolean")
    prices = costs.pricing(spark)
    got = sorted(round(r.cost_usd, 6) for r in costs.call_cost(calls, prices).collect())
    assert got == [0.0145, 0.085, 0.17] and costs.unpriced_calls(calls, prices).count() == 1
    attempts = spark.createDataFrame([("b", 1, 1, False, 1.0), ("b", 1, 2, True, 2.0), ("b", 1, 3, True, 4.0), ("b", 2, 1, True, 8.0), ("b", 3, 1, False, 1.0)], "slug string, chapter int, attempt int, parse_ok boolean, cost_usd double")
    got = {r.chapter: (r.attempts, r.used, r.last_cost, r.logged_cost) for r in costs.retry_resolution(attempts).collect()}
    assert got == {1: (2, 2, 2.0, 3.0), 2: (1, 1, 8.0, 8.0), 3: (1, None, 1.0, 1.0)}


def test_judge_pairs_alternate(spark):
    rows = [(c, c, m, f"{m}{c}") for c in (0, 1) for m in ("x", "y", "z") if (c, m) != (1, "y")]
    got = sorted((r.chapter, r.pair, r.a, r.b) for r in costs.judge_pairs(spark.createDataFrame(rows, "chapter int, chapter_index int, model string, text string"), ["x", "y", "z"]).collect())
    assert got == [(0, 0, "x", "y"), (0, 1, "z", "x"), (0, 2, "y", "z"), (1, 1, "x", "z")]


def test_slice_and_deliverable(spark):
    text = "intro\n1화 시작\n가\n\n7화\n나 \n화살 8화\n9화살\n"
    novels = spark.createDataFrame([("b", text), ("c", "no headers")], "slug string, text string")
    assert [tuple(r) for r in books.slice_chapters(novels).sort("chapter").collect()] == [("b", 1, "1화 시작\n가\n"), ("b", 2, "7화\n나 \n화살 8화\n9화살\n")]
    assert books.slice_chapters(novels, 3).count() == 0 and {r.slug for r in books.short_novels(novels, 1).collect()} == {"c"}
    gated = spark.createDataFrame([("b", 1, "1화 \n가", " one\n", False), ("b", 2, "7화\n나", "two", True)], "slug string, chapter int, source string, body string, withheld boolean")
    r = books.deliverable(gated).first()
    assert r.name == "b_INCOMPLETE" and r.text == f"1화 \n\none\n\n\n\n7화\n\n{books.WITHHELD}\n"


def test_files_round_trip(spark, tmp_path, terms):
    books.write_glossary(terms, f"{tmp_path}/g")
    assert sorted(tuple(r)[:7] for r in books.read_glossary(spark, f"{tmp_path}/g").collect()) == sorted(GLOSSARY)
    for slug, text in {"my book+1": '[{"korean": "검", "english": "S", "category": "x"}, {"korean": "활", "english": "Bow", "category": "item", "note": "n", "enforce": false}]', "bad": '{"korean": 1', "empty": "[]"}.items():
        (tmp_path / "h" / slug).mkdir(parents=True)
        (tmp_path / "h" / slug / "glossary.json").write_text(text)
        (tmp_path / "h" / slug / "summaries.json").write_text('{"arc_summary": "so far", "chapter_summaries": [{"chapter": 1, "summary": "a"}, {"chapter": "2", "summary": "b"}, {"chapter": "x", "summary": "c"}]}' if slug != "bad" else "{")
    got = sorted(tuple(r) for r in books.read_glossary(spark, f"{tmp_path}/h", "glossary.json").collect())
    assert got == [("bad", None, None, None, None, None, None, "no list of terms"), ("my book+1", 1, "검", "S", "x", "", True, "unknown category"), ("my book+1", 2, "활", "Bow", "item", "n", False, None)]
    got = {tuple(r) for r in books.read_context(spark, f"{tmp_path}/h", "summaries.json").where("slug <> 'empty'").collect()}
    assert got == {("bad", "", None, None), ("my book+1", "so far", 1, "a"), ("my book+1", "so far", 2, "b"), ("my book+1", "so far", None, "c")}
    books.write_token_map(terms, f"{tmp_path}/m")
    assert {r.slug: r.ids for r in books.read_token_map(spark, f"{tmp_path}/m").collect()} == {"b": {1: "Aster", 2: "Aster Trading", 3: "Sword"}}
    pairs = spark.createDataFrame([("a b", 7, "아스테르는", "[[G9]] [[NEW:활|Bow]]"), ("a b", 12, "", "")], "slug string, chapter int, source string, raw string")
    books.write_defects(tokens.defect_table(pairs, terms.withColumn("slug", F.lit("a b"))), f"{tmp_path}/d")
    assert sorted(tuple(r) for r in books.read_defects(spark, f"{tmp_path}/d").collect()) == [("a b", 7, ["아스테르"], ["[[G9]]"], [["활", "Bow"]]), ("a b", 12, [], [], [])]
    (tmp_path / "n").mkdir()
    (tmp_path / "n/book.txt").write_text("1화\n가\n")
    assert [tuple(r) for r in books.read_novels(spark, f"{tmp_path}/n").collect()] == [("book", "1화\n가\n")]
    (tmp_path / "c/b").mkdir(parents=True)
    (tmp_path / "c/b/ch007.txt").write_text("본문")
    assert [tuple(r) for r in books.read_chapters(spark, f"{tmp_path}/c").collect()] == [("b", 7, "본문")]


def test_stream_equals_batch(spark, tmp_path):
    rows = [[("b", 1, reply(terms="검 | Sword | item")), ("b", 2, reply(summary=None, terms="창 | Spear | item"))], [("b", 3, reply(terms="검 | Blade | item\n활 | Bow | item"))], [("b", 3, reply(terms="검 | Blade | item\n활 | Bow | item"))]]
    for k, part in enumerate(rows):
        spark.createDataFrame(part, incremental.REPLIES).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    path = f"{tmp_path}/out"
    stream = incremental.read_replies(spark, f"{tmp_path}/in/*")
    incremental.grow_glossary(stream, path, f"{tmp_path}/cp").awaitTermination()
    got = sorted(tuple(r)[:4] for r in incremental.grown_terms(spark, path).collect())
    assert got == [("b", 1, "검", "Sword"), ("b", 2, "활", "Bow")]
    assert sorted(r.chapter for r in incremental.grown_summaries(spark, path).collect()) == [1, 3]
    # Later files go on where the state is; a chapter that failed may come again.
    again = [("b", 2, reply(terms="창 | Spear | item")), ("b", 1, reply(terms="독 | Poison | item")), ("c", 1, reply(terms="검 | Blade | item")), ("c", None, reply(terms="x | y | item"))]
    spark.createDataFrame(again, incremental.REPLIES).coalesce(1).write.parquet(f"{tmp_path}/in/3")
    incremental.grow_glossary(incremental.read_replies(spark, f"{tmp_path}/in/*"), path, f"{tmp_path}/cp").awaitTermination()
    got = sorted(tuple(r)[:4] for r in incremental.grown_terms(spark, path).collect())
    assert got == [("b", 1, "검", "Sword"), ("b", 2, "활", "Bow"), ("b", 3, "창", "Spear"), ("c", 1, "검", "Blade")]


def test_markup(spark):
    df = spark.createDataFrame([("b", 1, "@it[a] @b(3)@", "@it[x] @b(9)@"), ("b", 2, "@b<a>", None)], "slug string, chapter int, source string, translation string")
    assert [r.intact for r in match.markup_integrity(df).sort("chapter").collect()] == [True, False]
    assert df.select(F.lit(1)).count() == 2


def test_empty_tables_nulls_and_clashing_columns(spark, terms):
    chapters = spark.createDataFrame([("b", 1, None, "k"), ("none", 2, "검", "k"), (None, 3, "검", "k"), ("b", 4, "", "k")], "slug string, chapter int, text string, present string")
    got = match.with_present(chapters, terms)
    assert got.columns == chapters.columns and {(r.chapter, len(r.present)) for r in got.collect()} == {(1, 0), (2, 0), (3, 0), (4, 0)}
    assert match.with_present(chapters.limit(0), terms).count() == 0 and match.with_present(chapters, terms.limit(0)).count() == 4
    pairs = spark.createDataFrame([("b", 1, None, None), ("b", 2, "검", None), ("b", 3, None, "[[G1]]")], "slug string, chapter int, source string, raw string")
    got = {r.chapter: (len(r.forgotten), r.needs_repair) for r in tokens.defect_table(pairs, terms).collect()}
    assert got[1] == (0, False) and got[3] == (0, False)
    replies = spark.createDataFrame([("b", 1, None), ("b", 2, "")], "slug string, chapter int, raw string")
    assert [r.parse_error for r in parse.parse_translations(replies).collect()] == ["no translation"] * 2
    assert parse.parse_consolidated(replies).count() == 0 and {r.lines for r in parse.consolidated_drops(replies).collect()} <= {-1, 0, None}
    assert tokens.run_report(tokens.chapter_report(*[_none(spark, x) for x in REPORTS]), _none(spark, "slug string, chapter int, parse_error string"), _none(spark, "slug string, token_id int, korean string")).count() == 0
    assert costs.judge_by_model(_none(spark, "a string, b string, overall string")).count() == 0


REPORTS = [
    "slug string, chapter int, status string, leaks array<string>, leaked array<string>",
    "slug string, chapter int, present int, violations array<struct<korean:string>>",
    "slug string, chapter int, forgotten array<string>, invalid array<string>, new array<string>",
    "slug string, chapter int, rejected boolean",
]


def _none(spark, schema):
    return spark.createDataFrame([], schema)
