"""Parsing model replies: one column for each part, and what is wrong in parse_error; no reply fails the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chapterloom.functions.text import CATEGORIES, filled, lines, section, strip

DIMENSIONS = ["accuracy", "naturalness", "voice", "terminology", "formatting"]
_SOFT = ["no", "false", "0", "soft"]


def _checked(korean: Column, english: Column, category: Column, note: Column, enforce: Column, short: Column) -> Column:
    blank = lambda c: F.length(strip(F.coalesce(c, F.lit("")))) == 0
    wrong = F.when(short, "too few fields").when(blank(korean), "blank korean").when(blank(english), "blank english").when(~F.coalesce(category.isin(CATEGORIES), F.lit(False)), "unknown category")
    return F.struct(korean.alias("korean"), english.alias("english"), category.alias("category"), note.alias("note"), enforce.alias("enforce"), wrong.alias("error"))


def term_line(line: Column) -> Column:
    """STRUCT<korean, english, category, note, enforce, error> of a line ``ko | en | category [| note [| enforce]]``."""
    fields = F.transform(F.split(line, r"\|", -1), strip)
    at = lambda k: F.try_element_at(fields, F.lit(k))
    enforce = F.when((F.size(fields) > 4) & (at(5) != ""), ~F.lower(at(5)).isin(_SOFT)).otherwise(True)
    return _checked(at(1), at(2), at(3), F.coalesce(at(4), F.lit("")), enforce, F.size(fields) < 3)


def _bare_lines(block: Column) -> Column:
    bare = F.transform(lines(strip(block)), lambda x: F.regexp_replace(strip(x), "^`+|`+$", ""))
    return F.filter(bare, lambda x: (x != "") & (F.upper(x) != "NONE"))


def terms_block(block: Column) -> Column:
    """The block's term lines; none where it starts with NONE and has no line of fields."""
    none = F.upper(strip(block)).startswith("NONE") & ~F.contains(block, F.lit("|"))
    return F.transform(F.when(none, F.array().cast("array<string>")).otherwise(_bare_lines(block)), term_line)


def _first_error(terms: Column) -> Column:
    return F.try_element_at(F.filter(F.transform(terms, lambda t: t["error"]), lambda e: e.isNotNull()), F.lit(1))


def extract_sections(replies: DataFrame, tags: list[str]) -> DataFrame:
    """Adds a column for each tag: its first section, null where there is none."""
    return replies.withColumns({t: section("raw", t) for t in tags})


def parse_term_lines(table: DataFrame, line_col: str = "line") -> DataFrame:
    return table.withColumn("t", term_line(F.col(line_col))).select(*table.columns, "t.*")


def _with_terms(rows: DataFrame, required: list[str]) -> DataFrame:
    """Adds terms and parse_error, from the required sections in order, then the terms' block and lines."""
    rows = rows.withColumn("block", section("raw", "new_glossary_terms")).withColumn("found", F.coalesce(terms_block(F.col("block")), F.array()))
    wrong = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in required], F.when(F.col("block").isNull(), "no new_glossary_terms"), _first_error(F.col("found")))
    rows = rows.withColumn("parse_error", wrong)
    return rows.withColumn("terms", F.when(F.col("parse_error").isNull(), F.col("found"))).drop("block", "found")


def parse_translations(replies: DataFrame) -> DataFrame:
    """(…, translation, chapter_summary, terms, parse_error): a full reply."""
    rows = replies.withColumns({t: filled(section("raw", t)) for t in ("translation", "chapter_summary")})
    return _with_terms(rows, ["translation", "chapter_summary"])


def parse_mining(replies: DataFrame) -> DataFrame:
    """(…, chapter_summary, terms, parse_error): a mining reply."""
    return _with_terms(replies.withColumn("chapter_summary", filled(section("raw", "chapter_summary"))), ["chapter_summary"])


def parse_single_section(replies: DataFrame, tag: str) -> DataFrame:
    rows = replies.withColumn("body", filled(section("raw", tag)))
    return rows.withColumn("parse_error", F.when(F.col("body").isNull(), F.lit(f"no {tag}")))


def parse_consolidated(replies: DataFrame) -> DataFrame:
    """(slug, pos, korean, english, category, note, enforce): a consolidated glossary's valid lines; faulty ones are dropped."""
    kept = F.filter(_bare_lines(section("raw", "glossary")), lambda x: F.contains(x, F.lit("|")))
    good = F.filter(F.transform(kept, term_line), lambda t: t["error"].isNull())
    rows = replies.select("slug", F.posexplode_outer(good).alias("pos", "t")).where("pos is not null")
    return rows.select("slug", "pos", *[F.col(f"t.{c}") for c in ("korean", "english", "category", "note", "enforce")])


def consolidated_drops(replies: DataFrame) -> DataFrame:
    """(slug, lines, dropped): how many of a consolidated glossary's lines are faulty."""
    found = F.transform(F.filter(_bare_lines(section("raw", "glossary")), lambda x: F.contains(x, F.lit("|"))), term_line)
    return replies.select("slug", found.alias("t")).select("slug", F.size("t").alias("lines"), F.size(F.filter("t", lambda t: t["error"].isNotNull())).alias("dropped"))


def json_reply(replies: DataFrame) -> DataFrame:
    """(…, translation, chapter_summary, terms, parse_error) of a JSON reply, in a code fence or not; types are checked."""
    text = strip("raw")
    fenced = r"(?s)^```(?:json)?\s*(.*?)\s*```"
    rows = replies.withColumn("v", F.try_parse_json(F.when(text.rlike(fenced), F.regexp_extract(text, fenced, 1)).otherwise(text)))
    kind = lambda path: F.schema_of_variant(F.try_variant_get("v", path, "variant"))
    rows = rows.withColumns({
        "kind": F.schema_of_variant("v"),
        "k1": kind("$.translation"),
        "k2": kind("$.chapter_summary"),
        "k3": kind("$.new_glossary_terms"),
        "translation": strip(F.try_variant_get("v", "$.translation", "string")),
        "chapter_summary": strip(F.try_variant_get("v", "$.chapter_summary", "string")),
        "items": F.try_variant_get("v", "$.new_glossary_terms", "array<variant>"),
    })

    def term(item: Column) -> Column:
        text_of = lambda name: F.when(F.schema_of_variant(F.try_variant_get(item, f"$.{name}", "variant")) == "STRING", F.try_variant_get(item, f"$.{name}", "string"))
        return _checked(*[F.coalesce(text_of(c), F.lit("")) for c in ("korean", "english", "category", "note")], F.lit(True), ~F.schema_of_variant(item).startswith("OBJECT"))

    rows = rows.withColumn("found", F.coalesce(F.transform("items", term), F.array()))
    object_ = F.coalesce(F.col("kind"), F.lit("")).startswith("OBJECT")
    wrong = (
        F.when(F.col("v").isNull(), "no json")
        .when(~object_, "no object")
        .when(F.col("k1").isNull() | F.col("k2").isNull() | F.col("k3").isNull(), "missing keys")
        .when((F.col("k1") != "STRING") | (F.col("translation") == ""), "bad translation")
        .when((F.col("k2") != "STRING") | (F.col("chapter_summary") == ""), "bad chapter_summary")
        .when(~F.col("k3").startswith("ARRAY"), "bad new_glossary_terms")
        .otherwise(_first_error(F.col("found")))
    )
    rows = rows.withColumn("parse_error", wrong)
    ok = F.col("parse_error").isNull()
    return rows.withColumns({"terms": F.when(ok, F.col("found")), "translation": F.when(ok, F.col("translation")), "chapter_summary": F.when(ok, F.col("chapter_summary"))}).drop("v", "kind", "k1", "k2", "k3", "items", "found")


def _verdict(c: Column) -> Column:
    """A, B or tie, the first that stands as a word of its own; null if none does."""
    word = F.regexp_extract(c, r"(?i)\b(A|B|tie)\b", 1)
    return F.when(word != "", F.when(F.lower(word) == "tie", "tie").otherwise(F.upper(word)))


def parse_judge(replies: DataFrame) -> DataFrame:
    """(…, overall, rationale, dimensions MAP, parse_error): the overall verdict is required, the rest lenient."""
    whole = filled(section("raw", "overall_winner"))
    pairs = [x for d in DIMENSIONS for x in (F.lit(d), F.coalesce(_verdict(section("raw", d)), F.lit("?")))]
    rows = replies.withColumns({"overall": _verdict(whole), "rationale": F.coalesce(section("raw", "rationale"), F.lit("")), "dimensions": F.create_map(*pairs)})
    return rows.withColumn("parse_error", F.when(whole.isNull(), "no overall_winner").when(F.col("overall").isNull(), "no verdict"))


def reported_terms(parsed: DataFrame) -> DataFrame:
    """(slug, chapter, pos, korean, english, category, note, enforce) of the replies that parsed."""
    # A reply that didn't parse has no terms. An outer explode, as Spark computes the array once more to filter by its size otherwise.
    rows = parsed.select("slug", "chapter", F.posexplode_outer("terms").alias("pos", "t")).where("pos is not null")
    return rows.select("slug", "chapter", "pos", *[F.col(f"t.{c}") for c in ("korean", "english", "category", "note", "enforce")])
