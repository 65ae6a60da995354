import os

import pytest

from chapterloom.operators import tokens
from chapterloom.sources import books, files

GLOSSARY = "slug string, token_id int, korean string, english string, category string, note string, enforce boolean"


def listed(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


def write(spark, rows, root, parts=3):
    files.write_files(spark.createDataFrame(rows, files.SCHEMA).repartition(parts), str(root))


def test_files_are_replaced_together_or_not_at_all(spark, tmp_path):
    write(spark, [(f"b{k}/x.json", f"old {k}") for k in range(9)] + [("c/y.txt", "stays"), ("top", "t")], tmp_path)
    assert len(listed(tmp_path)) == 11
    write(spark, [(f"b{k}/x.json", f"new {k}") for k in range(4)] + [("d e/é 검#?.txt", "한\n")], tmp_path)
    got = {r.path: r.content for r in files.read_files(spark, f"file://{tmp_path}", "*/*").collect()}
    assert got == {**{f"b{k}/x.json": f"{'new' if k < 4 else 'old'} {k}" for k in range(9)}, "c/y.txt": "stays", "d e/é 검#?.txt": "한\n"}
    # A task that fails (in any attempt) leaves every old file; so do two rows for one path.
    for bad in (("b1/x.json", None), (None, "x"), ("../x", "x"), ("b/../../x", "x"), ("/x", "x"), ("b0/x.json", "twice")):
        with pytest.raises(Exception):
            write(spark, [(f"b{k}/x.json", "broken") for k in range(8)] + [bad], tmp_path, 8)
        assert {r.path: r.content for r in files.read_files(spark, str(tmp_path), "*/*").collect()} == got
    assert not [f for f in os.listdir(tmp_path) if f.startswith("_staging")]
    assert [r.path for r in files.read_files(spark, str(tmp_path), "*").collect()] == ["top"]
    assert files.read_files(spark, f"{tmp_path}/absent", "*/*").count() == 0
    write(spark, [("b0/x.json", "x")], f"{tmp_path}/new")
    files.write_files(spark.createDataFrame([], files.SCHEMA), f"{tmp_path}/new")
    assert listed(f"{tmp_path}/new") == ["b0/x.json"]


def test_glossaries_round_trip_and_fold_back(spark, tmp_path):
    first = [("b", 1, "검", "Sword", "item", "", True), ("b", 2, "강", "River", "place", "n", False), ("a/b %.", 1, "성", "Castle", "place", "", True)]
    root = str(tmp_path)
    files.replace_glossaries(spark.createDataFrame(first, GLOSSARY), root)
    assert listed(root) == ["a%2Fb+%25%2E/glossary.json", "b/glossary.json"]
    assert sorted(tuple(r)[:7] for r in files.current_glossaries(spark, root).collect()) == sorted(first)
    # A run reads its glossary and replaces it: the file it reads is whole until the new one is there.
    more = files.current_glossaries(spark, root).where("slug = 'b'").select(*[c.split()[0] for c in GLOSSARY.split(", ")])
    files.replace_glossaries(more.unionByName(spark.createDataFrame([("b", 3, "독", "Poison", "item", "", True)], GLOSSARY)), root)
    assert sorted(tuple(r)[:3] for r in files.current_glossaries(spark, root).collect()) == [("a/b %.", 1, "성"), ("b", 1, "검"), ("b", 2, "강"), ("b", 3, "독")]
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "glossary.json").write_text("{broken")
    assert [(r.slug, r.reason) for r in files.current_glossaries(spark, root).where("reason is not null").collect()] == [("z", "no list of terms")]


def test_deliverables_and_reports(spark, tmp_path):
    gated = spark.createDataFrame([("b", 1, "1화\n가", "one", False, []), ("b", 2, "2화", "x", True, ["[[G9]]", "[[x]]"]), ("c", 1, "1화", "ok", False, [])], "slug string, chapter int, source string, body string, withheld boolean, leaks array<string>")
    files.write_deliverables(books.deliverable(gated), str(tmp_path))
    assert listed(tmp_path) == ["b/ch001-002_EN_INCOMPLETE.txt", "c/ch001-001_EN.txt"]
    got = {r.slug: (r.incomplete, r.text) for r in files.read_deliverables(spark, str(tmp_path)).collect()}
    assert got["b"] == (True, "1화\n\none\n\n\n\n2화\n\n[chapter 2 withheld, a human has to see it: [[G9]], [[x]]]\n") and got["c"] == (False, "1화\n\nok\n")
    rows = spark.createDataFrame([("b", 1, "ok", [], 0, 0, 0, 0, False, 2, ["검"]), ("b", 2, "NEEDS_HUMAN", ["[[x]]"], 1, 1, 0, 2, True, None, [])], "slug string, chapter int, status string, leaks array<string>, n_leaks int, forgotten int, invalid int, new int, rejected boolean, present int, violations array<string>")
    report = tokens.run_report(rows, spark.createDataFrame([("b", 1, None), ("b", 2, "no")], "slug string, chapter int, parse_error string"), spark.createDataFrame([("b", 1, "독")], "slug string, token_id int, korean string"))
    files.write_reports(report, rows, str(tmp_path))
    r = files.read_reports(spark, str(tmp_path), "slug string, status string, pct int, withheld array<int>, new_entities_folded array<string>, per_chapter array<struct<chapter:int,violations:array<string>>>").first()
    assert (r.slug, r.status, r.pct, r.withheld, r.new_entities_folded) == ("b", "NEEDS_HUMAN", 50, [2], ["독"])
    assert [(c.chapter, c.violations) for c in r.per_chapter] == [(1, ["검"]), (2, [])]
