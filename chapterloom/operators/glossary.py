"""Building glossaries: cleaning, voting, appending, folding back, counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chapterloom.functions.text import normalize_key, strip

TERM = ["korean", "english", "category", "note", "enforce"]
FOLD_NOTE = "reported by the translator"


def clean_terms(terms: DataFrame) -> DataFrame:
    """The first of several renderings (before / and parenthesis) and fixed; a fixed term is enforced again."""
    first = strip(F.substring_index(F.substring_index("english", "/", 1), "(", 1))
    fixed = (first != "") & (first != F.col("english"))
    return terms.withColumns({"fixed": fixed, "english": F.when(fixed, first).otherwise(F.col("english")), "enforce": fixed | F.col("enforce")})


def term_votes(mined: DataFrame) -> DataFrame:
    """(slug, key, english, votes, first, plain) of mined terms (slug, chapter, pos, korean, english, category, note): how often a key has a rendering, its earliest row, and whether a row is spelled as the key.

    Sums of such rows, by summed_votes(), are those of all their terms.
    """
    at = F.struct("chapter", "pos")
    return mined.withColumn("key", normalize_key("korean")).groupBy("slug", "key", "english").agg(
        F.count(F.lit(1)).alias("votes"),
        F.min(F.struct(at.alias("at"), "category", "note", "korean")).alias("first"),
        F.max(F.col("korean") == F.col("key")).alias("plain"),
    )


def summed_votes(votes: DataFrame) -> DataFrame:
    """One row for each (slug, key, english) from term_votes() of disjoint rows."""
    return votes.groupBy("slug", "key", "english").agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("plain").alias("plain"))


def winners(votes: DataFrame) -> DataFrame:
    """(slug, key, at, korean, english, category, note, enforce): the rendering of each key with most votes, of equal ones the earliest; at is the key's first place."""
    best = votes.groupBy("slug", "key").agg(
        F.min(F.struct((-F.col("votes")).alias("v"), F.col("first.at").alias("at"), "english", F.col("first.category").alias("category"), F.col("first.note").alias("note"))).alias("w"),
        F.min("first").alias("first"),
        F.max("plain").alias("plain"),
    )
    korean = F.when(F.col("plain"), F.col("key")).otherwise(F.col("first.korean"))
    return best.select("slug", "key", F.col("first.at").alias("at"), korean.alias("korean"), "w.english", "w.category", "w.note", F.lit(True).alias("enforce"))


def merge_terms(mined: DataFrame) -> DataFrame:
    """(slug, token_id, korean, english, category, note, enforce): one term for each book and normalised key.

    The rendering with most votes wins, of equal ones the earliest by (chapter, pos); category and
    note come from its earliest row. Counting is by (slug, key, english) first, so that a
    term in very many chapters is summed before it meets its rivals.
    """
    place = F.row_number().over(Window.partitionBy("slug").orderBy("at"))
    return winners(term_votes(mined)).select("slug", place.alias("token_id"), *TERM)


def append_terms(glossary: DataFrame, new: DataFrame, order: list[str] = ["chapter", "pos"]) -> DataFrame:
    """The glossary with terms whose korean is not in it, each once, numbered on; nothing that exists changes."""
    fresh = new.join(glossary.select("slug", "korean"), ["slug", "korean"], "left_anti")
    first = fresh.groupBy("slug", "korean").agg(F.min(F.struct(*order, *TERM[1:])).alias("f")).select("slug", "korean", "f.*")
    last = glossary.groupBy("slug").agg(F.max("token_id").alias("last"))
    place = F.row_number().over(Window.partitionBy("slug").orderBy(*order, "korean"))
    added = first.withColumn("place", place).join(last, "slug", "left").withColumn("token_id", (F.coalesce("last", F.lit(0)) + F.col("place")).cast("int"))
    columns = ["slug", "token_id", *TERM]
    return glossary.select(*columns).unionByName(added.select(*columns))


def entity_terms(entities: DataFrame) -> DataFrame:
    """Self-reported entities as terms; blank ones are dropped."""
    rows = entities.withColumns({"korean": strip("korean"), "english": strip("english")}).where("korean <> '' and english <> ''")
    return rows.withColumns({"category": F.lit("other"), "note": F.lit(FOLD_NOTE), "enforce": F.lit(True)})


def fold_new_entities(glossary: DataFrame, entities: DataFrame) -> DataFrame:
    return append_terms(glossary, entity_terms(entities))


def fold_reported_terms(glossary: DataFrame, terms: DataFrame) -> DataFrame:
    """Reported terms keep their own category, note and enforce."""
    return append_terms(glossary, terms.where((strip("korean") != "") & (strip("english") != "")))


def fold_back(glossary: DataFrame, entities: DataFrame, terms: DataFrame) -> DataFrame:
    """Both at the end of a run: all entities come before all reported terms."""
    columns = ["slug", "priority", "chapter", "pos", *TERM]
    one = entity_terms(entities).withColumn("priority", F.lit(0)).select(*columns)
    two = terms.where((strip("korean") != "") & (strip("english") != "")).withColumn("priority", F.lit(1)).select(*columns)
    return append_terms(glossary, one.unionByName(two), ["priority", "chapter", "pos"])


def glossary_stats(glossary: DataFrame) -> DataFrame:
    return glossary.groupBy("slug").agg(F.count(F.lit(1)).alias("n_terms"), F.count_if("enforce").alias("n_enforce"), F.count_if(~F.col("enforce")).alias("n_soft"))


def glossary_growth(terms: DataFrame) -> DataFrame:
    """(slug, chapter, reported, added, size): how the glossary grows from chapter to chapter."""
    first = terms.groupBy("slug", "korean").agg(F.min("chapter").alias("chapter")).groupBy("slug", "chapter").agg(F.count(F.lit(1)).alias("added"))
    rows = terms.groupBy("slug", "chapter").agg(F.count(F.lit(1)).alias("reported")).join(first, ["slug", "chapter"], "left").withColumn("added", F.coalesce("added", F.lit(0)))
    running = Window.partitionBy("slug").orderBy("chapter").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("size", F.sum("added").over(running))
