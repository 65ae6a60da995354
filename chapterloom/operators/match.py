"""Finding glossary terms in chapters and scoring translations by them.

A book's glossary (some hundred terms) is one array a book that joins each chapter's row, so
chapter texts are neither copied for each term nor exploded. Up to BROADCAST_TERMS terms these arrays are broadcast and
chapters stay where they are; beyond, both are shuffled by book. A text is searched once for all terms (see finder).

Chapters may carry ``size``: then only terms with ids up to it count, as when the glossary was still growing. Defined results: a null
text, or a book without a glossary, has no terms; terms with one spelling are all found; ids are numbered from 1 without gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chapterloom.operators.finder import checked_column, present_column
from chapterloom.sources.scratch import store

_TERM = ["token_id", "korean", "english", "category", "note", "enforce"]


def book_terms(glossary: DataFrame) -> DataFrame:
    """(slug, terms, n_terms): each book's terms in the order of their ids."""
    return glossary.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct(*_TERM))).alias("terms"), F.count(F.lit(1)).alias("n_terms"))


#: Terms of all books up to which they are broadcast, at some 100 bytes each.
BROADCAST_TERMS = 500_000


def with_books(rows: DataFrame, books: DataFrame) -> DataFrame:
    """rows joined with books (slug, terms, n_terms), adding the terms' spellings (keys), lower-cased renderings (lows) and whether they are enforced. The books are stored and counted."""
    each = {"keys": lambda t: t["korean"], "lows": lambda t: F.lower(t["english"]), "enforced": lambda t: t["enforce"]}
    books = store(books.withColumns({c: F.transform("terms", f) for c, f in each.items()}), "books")
    n = books.agg(F.sum("n_terms")).first()[0] or 0
    return rows.join(F.broadcast(books) if n <= BROADCAST_TERMS else books, "slug", "left")


def size_of(rows: DataFrame) -> Column:
    """How many of its book's terms a row may see: its column ``size``, else all."""
    return F.col("size").cast("int") if "size" in rows.columns else F.lit(2**31 - 1)


def picked(places: Column | str, terms: str = "terms") -> Column:
    """The terms at these places."""
    return F.coalesce(F.transform(places, lambda p: F.element_at(terms, p + 1)), F.array())


def with_present(chapters: DataFrame, glossary: DataFrame) -> DataFrame:
    """Adds present: the terms that occur in the chapter's text, none for a book without a glossary or a chapter without text."""
    joined = with_books(chapters, book_terms(glossary)).withColumn("places", present_column()("slug", "keys", "text", size_of(chapters)))
    return joined.withColumn("present", picked("places")).drop("terms", "n_terms", "keys", "lows", "enforced", "places")


def terms_in_source(chapters: DataFrame, glossary: DataFrame) -> DataFrame:
    """(slug, chapter, token_id, korean, english, category, note, enforce) of each occurring term."""
    # inline() would have Spark compute the array once more for a filter on its size.
    return with_present(chapters, glossary).select("slug", "chapter", F.inline_outer("present")).where("token_id is not null")


def check_adherence(chapters: DataFrame, translations: DataFrame, glossary: DataFrame) -> DataFrame:
    """(slug, chapter, present, violations, missing): terms that occur, and those that the translation lacks.

    A chapter without a translation is missing and has null counts.
    """
    size = size_of(chapters)
    low = F.lower("text")
    rows = chapters.select("slug", "chapter", "text", size.alias("size")).join(translations.select("slug", "chapter", low.alias("translation")), ["slug", "chapter"], "left")
    found = checked_column()("slug", "keys", "lows", "text", "translation", "size")
    rows = with_books(rows, book_terms(glossary)).withColumn("found", found)
    there = F.col("translation").isNotNull()
    return rows.select(
        "slug",
        "chapter",
        F.when(there, F.coalesce(F.size("found.present"), F.lit(0))).alias("present"),
        F.when(there, picked("found.wrong")).alias("violations"),
        (~there).alias("missing"),
    )


def percent(ok: str, present: str):
    """Rounded half to even; 0 where nothing is present."""
    return F.when(F.col(present) > 0, F.bround(100 * F.col(ok) / F.col(present), 0)).otherwise(0.0).cast("int")


def adherence_rollup(checked: DataFrame) -> DataFrame:
    """(slug, chapter, present, ok, pct) of each chapter, each book (chapter null) and all (slug null)."""
    rows = checked.where("not missing").select("slug", "chapter", "present", (F.col("present") - F.size("violations")).alias("ok"))
    summed = rows.rollup("slug", "chapter").agg(F.sum("present").alias("present"), F.sum("ok").alias("ok"))
    return summed.withColumn("pct", percent("ok", "present"))


def named(violations):
    """ko→en, … in the order of ids."""
    return F.array_join(F.transform(violations, lambda t: F.concat(t["korean"], F.lit("→"), t["english"])), ", ")


def run_consistency(chapters: DataFrame, translations: DataFrame, glossary: DataFrame) -> DataFrame:
    """Every chapter against the final glossary: (slug, chapter, present, ok, violations as text, missing)."""
    rows = check_adherence(chapters, translations, glossary)
    return rows.select("slug", "chapter", "present", (F.col("present") - F.size("violations")).alias("ok"), named("violations").alias("violations"), "missing")


def violations_by_term(checked: DataFrame, top: int | None = None) -> DataFrame:
    """(slug, korean, english, times, chapters): the terms most often missed; ``top`` keeps so many of the whole."""
    rows = checked.select("slug", "chapter", F.explode_outer("violations").alias("t")).where("t is not null").select("slug", "chapter", "t.korean", "t.english")
    found = rows.groupBy("slug", "korean", "english").agg(F.count(F.lit(1)).alias("times"), F.array_sort(F.collect_set("chapter")).alias("chapters"))
    return found if top is None else found.orderBy(F.col("times").desc(), "slug", "korean").limit(top)


def adherence_by_repeat(checked: DataFrame) -> DataFrame:
    """(experiment, repeat, chapters, failed, present, violations, missed): repeats whose reply didn't parse are counted, not scored.

    missed: ko→en of each violation, by chapter, then id.
    """
    each = F.struct("chapter", F.transform("violations", lambda t: F.concat(t["korean"], F.lit("→"), t["english"])).alias("v"))
    return checked.groupBy("experiment", "repeat").agg(
        F.count(F.lit(1)).alias("chapters"),
        F.count_if(F.col("missing")).alias("failed"),
        F.coalesce(F.sum("present"), F.lit(0)).alias("present"),
        F.coalesce(F.sum(F.when(~F.col("missing"), F.size("violations"))), F.lit(0)).alias("violations"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.when(~F.col("missing"), each))), lambda c: c["v"])).alias("missed"),
    )


MARKUP = [r"@it\[", r"@b<", r"@b\([0-9]+\)@"]


def markup_integrity(pairs: DataFrame) -> DataFrame:
    """pairs (slug, chapter, source, translation): adds the marks on either side and whether they agree."""
    counts = lambda c: F.array(*[F.regexp_count(F.coalesce(F.col(c), F.lit("")), F.lit(m)) for m in MARKUP])
    return pairs.withColumns({"source_marks": counts("source"), "translation_marks": counts("translation")}).withColumn("intact", F.col("source_marks") == F.col("translation_marks"))
