"""Context and request tables. Prompt texts are parameters; the jobs put the data together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chapterloom.functions.text import strip
from chapterloom.sources.scratch import store

FIXED_HEAD = "## Fixed tokens\nWrite the token for each of these terms.\n\nkorean | token"
OTHER_HEAD = "## Other names\nWrite [[NEW:term|rendering]] for every other name."
SOFT_HEAD = "## Renderings\nkorean | english | category | note"
TITLE = "# Glossary"


def context_window(summaries: DataFrame, width: int = 20) -> DataFrame:
    """(slug, chapter, prior): summaries of the chapters numbered up to ``width`` before, in order."""
    frame = Window.partitionBy("slug").orderBy("chapter").rangeBetween(-width, -1)
    there = F.when(F.col("summary").isNotNull() & (F.col("chapter") >= 1), F.struct("chapter", "summary"))
    return summaries.select("slug", "chapter", F.array_sort(F.collect_list(there).over(frame)).alias("prior"))


def last_k_summaries(summaries: DataFrame, k: int = 3) -> DataFrame:
    """(slug, chapter, prior): the last k summaries that there are before a chapter, gaps skipped.

    Summaries are numbered among those that exist; a chapter joins the k numbers before it.
    """
    before = F.count("summary").over(Window.partitionBy("slug").orderBy("chapter").rowsBetween(Window.unboundedPreceding, -1))
    rows = summaries.withColumn("seen", before)
    known = rows.where("summary is not null").select("slug", F.col("seen").alias("at"), F.struct(F.col("chapter"), F.col("summary")).alias("s"))
    wanted = rows.select("slug", "chapter", F.explode(F.sequence(F.col("seen") - k, F.col("seen") - 1)).alias("at"))
    joined = wanted.join(known, ["slug", "at"], "left")
    return joined.groupBy("slug", "chapter").agg(F.array_sort(F.collect_list("s")).alias("prior"))


def table_line(t) -> Column:
    """ko | en | category | note without trailing blanks and bars."""
    return F.rtrim(F.concat(t["korean"], F.lit(" | "), t["english"], F.lit(" | "), t["category"], F.lit(" | "), t["note"]), F.lit(" |"))


def _ordered(glossary: DataFrame) -> DataFrame:
    term = F.struct("token_id", "korean", "english", "category", "note", "enforce")
    return glossary.groupBy("slug").agg(F.array_sort(F.collect_list(term)).alias("terms"))


def glossary_table(glossary: DataFrame) -> DataFrame:
    """(slug, n_terms, table)."""
    return _ordered(glossary).select("slug", F.size("terms").alias("n_terms"), F.array_join(F.transform("terms", table_line), "\n").alias("table"))


def placeholder_block(glossary: DataFrame) -> DataFrame:
    """(slug, block): enforced terms with their tokens and no rendering, the rest with renderings; sections without terms are left out."""
    books = _ordered(glossary)
    note = lambda t: F.when(t["note"] != "", F.concat(F.lit("  ("), t["note"], F.lit(")"))).otherwise("")
    fixed = F.transform(F.filter("terms", lambda t: t["enforce"]), lambda t: F.concat(t["korean"], F.lit(" | [[G"), t["token_id"].cast("string"), F.lit("]]"), note(t)))
    soft = F.transform(F.filter("terms", lambda t: ~t["enforce"]), table_line)
    part = lambda head, rows: F.when(F.size(rows) > 0, F.concat(F.lit(head + "\n"), F.array_join(rows, "\n")))
    return books.select("slug", F.concat_ws("\n\n", F.lit(TITLE), part(FIXED_HEAD, fixed), F.lit(OTHER_HEAD), part(SOFT_HEAD, soft)).alias("block"))


def user_message(rows: DataFrame, arc: str = "arc", prior: str = "prior", text: str = "text") -> DataFrame:
    """Adds message: story so far, earlier summaries and the chapter, each left out where empty; null for a blank chapter."""
    tagged = lambda tag, c: F.concat(F.lit(f"<{tag}>\n"), c, F.lit(f"\n</{tag}>"))
    story = strip(F.coalesce(F.col(arc), F.lit("")))
    earlier = F.transform(F.coalesce(F.col(prior), F.array()), lambda s: F.concat(F.lit("Ch."), s["chapter"].cast("string"), F.lit(": "), s["summary"]))
    body = strip(F.coalesce(F.col(text), F.lit("")))
    whole = F.concat_ws(
        "\n\n",
        F.when(story != "", tagged("story_so_far", story)),
        F.when(F.size(earlier) > 0, tagged("previous_chapter_summaries", F.array_join(earlier, "\n"))),
        tagged("chapter", body),
    )
    return rows.withColumn("message", F.when(body != "", whole))


def request(custom_id: Column, system: list[Column], user: Column, max_tokens: int) -> Column:
    blocks = F.filter(F.array(*system), lambda x: x.isNotNull() & (x != ""))
    return F.to_json(F.struct(custom_id.alias("custom_id"), F.lit(max_tokens).alias("max_tokens"), blocks.alias("system"), user.alias("user")))


def _id(stage: str) -> Column:
    return F.concat(F.lit(stage + ":"), "slug", F.lit(":"), F.col("chapter").cast("string"))


def mining_requests(chapters: DataFrame, prompt: str = "MINE", max_tokens: int = 2000) -> DataFrame:
    rows = user_message(chapters.withColumns({"arc": F.lit(""), "prior": F.lit(None).cast("array<struct<chapter:int,summary:string>>")})).where("message is not null")
    return rows.select("slug", "chapter", request(_id("mine"), [F.lit(prompt)], F.col("message"), max_tokens).alias("request"))


def consolidation_requests(glossary: DataFrame, prompt: str = "CONSOLIDATE") -> DataFrame:
    """(slug, prompt): one request a book with its draft glossary."""
    text = F.concat(F.lit(f"{prompt}\n\n# Draft glossary ("), F.col("n_terms").cast("string"), F.lit(" entries)\n\n"), "table", F.lit("\n"))
    return glossary_table(glossary).select("slug", text.alias("prompt"))


def with_arc(rows: DataFrame, arcs: DataFrame | None, every: int = 5) -> DataFrame:
    """Adds arc to rows (slug, chapter, ...): the story as of the last due chapter before the row's, null before the first.

    arcs: (slug, chapter, arc) of due chapters, those whose number ``every`` divides; other rows are left out. A null or blank arc is a
    reply that failed: the one before it stays. Of several arcs of a chapter the least counts. Each arc is repeated for the
    due chapters up to its successor, so rows meet theirs by an equi-join, and only due chapters are ever sorted by book.
    """
    rows = rows.drop("arc")
    if arcs is None:
        return rows.withColumn("arc", F.lit(None).cast("string"))
    due = F.expr(f"(chapter - 1) div {int(every)}").cast("long")
    rows = rows.withColumn("due", due)
    ends = rows.groupBy("slug").agg(F.max("due").alias("end"))
    told = arcs.where((F.col("chapter") % every == 0) & (strip("arc") != "")).groupBy("slug", F.expr(f"chapter div {int(every)}").cast("long").alias("at")).agg(F.min("arc").alias("arc"))
    told = told.withColumn("next", F.lead("at").over(Window.partitionBy("slug").orderBy("at"))).join(ends, "slug")
    upto = F.greatest("at", F.coalesce(F.col("next") - 1, "end"))
    told = told.select("slug", "arc", F.explode(F.sequence("at", upto)).alias("due"))
    return rows.join(told, ["slug", "due"], "left").drop("due")


#: Glossaries' blocks are broadcast up to this many characters in all.
BROADCAST_BLOCKS = 100_000_000


def with_blocks(rows: DataFrame, glossary: DataFrame) -> DataFrame:
    """Adds block, null for a book without a glossary. Blocks are stored and their characters counted, and up to BROADCAST_BLOCKS rows stay where they are."""
    blocks = store(placeholder_block(glossary), "blocks")
    n = blocks.agg(F.sum(F.length("block"))).first()[0] or 0
    return rows.join(F.broadcast(blocks) if n <= BROADCAST_BLOCKS else blocks, "slug", "left")


def translation_requests(chapters: DataFrame, summaries: DataFrame, glossary: DataFrame, prompt: str = "TRANSLATE", max_tokens: int = 16_000, last: int | None = None, arcs: DataFrame | None = None, every: int = 5) -> DataFrame:
    """(slug, chapter, request): instructions, the glossary block where the book has one, and the message with the story so far and earlier summaries.

    last: that many available summaries; otherwise the window of 20 chapter numbers. Arcs and summaries are put together on chapters' numbers alone;
    texts are joined afterwards, shuffled once and never sorted: they are probed against the hash table of a task's numbers.
    """
    key = ["slug", "chapter"]
    prior = context_window(summaries) if last is None else last_k_summaries(summaries, last)
    context = with_arc(chapters.select(*key).distinct(), arcs, every).join(prior, key, "left")
    rows = chapters.drop("arc", "prior").join(context.hint("shuffle_hash"), key, "left")
    rows = user_message(with_blocks(rows, glossary)).where("message is not null")
    return rows.select(*key, request(_id("translate"), [F.lit(prompt), F.col("block")], F.col("message"), max_tokens).alias("request"))


def repair_requests(defects: DataFrame, pairs: DataFrame, glossary: DataFrame, prompt: str = "REPAIR", max_tokens: int = 16_000) -> DataFrame:
    """(slug, chapter, request) of the chapters that need repair; the glossary goes along only with invalid tokens."""
    bad = defects.where("needs_repair").select("slug", "chapter", "forgotten", F.array_sort(F.array_distinct("invalid")).alias("invalid"))
    rows = bad.join(pairs.select("slug", "chapter", "source", "raw"), ["slug", "chapter"]).join(placeholder_block(glossary), "slug", "left")
    missed = F.array_join(F.transform("forgotten", lambda t: F.concat(t["korean"], F.lit(" | "), t["token"])), "\n")
    message = F.concat_ws(
        "\n\n",
        F.concat(F.lit("<source>\n"), "source", F.lit("\n</source>")),
        F.concat(F.lit("<translation>\n"), "raw", F.lit("\n</translation>")),
        F.when(F.size("forgotten") > 0, F.concat(F.lit("<missed>\n"), missed, F.lit("\n</missed>"))),
        F.when(F.size("invalid") > 0, F.concat(F.lit("<invalid>\n"), F.array_join("invalid", "\n"), F.lit("\n</invalid>"))),
    )
    return rows.select("slug", "chapter", request(_id("repair"), [F.lit(prompt), F.when(F.size("invalid") > 0, F.col("block"))], message, max_tokens).alias("request"))


#: The tags of an arc request, and what stands for the story before there is one.
STORY, RECENT, NO_STORY = "current_story_so_far", "recent_chapter_summaries", "(empty)"


def arc_requests(summaries: DataFrame, every: int = 5, prompt: str = "ARC", arcs: DataFrame | None = None) -> DataFrame:
    """(slug, chapter, n_summaries, message): at every so many chapters but the last, the current arc and all summaries so far.

    Summaries are put together once for the chapters up to each due one, and a due chapter takes the texts of the blocks up to its own: rows are
    as many as due chapters. A due chapter without a summary before it asks nothing; chapters without a number count nowhere.
    """
    rows = summaries.select("slug", "chapter", "summary").where("chapter is not null")
    ends = rows.groupBy("slug").agg(F.max("chapter").alias("end"))
    block = F.ceil(F.col("chapter") / every).alias("block")
    line = lambda s: F.concat(F.lit("Ch."), s["chapter"].cast("string"), F.lit(": "), s["summary"])
    known = rows.where("summary is not null").groupBy("slug", block).agg(F.array_sort(F.collect_list(F.struct("chapter", "summary"))).alias("s"))
    known = known.select("slug", "block", F.size("s").alias("n"), F.array_join(F.transform("s", line), "\n").alias("lines"))
    due = rows.where(F.col("chapter") % every == 0).select("slug", "chapter", block).distinct().join(ends, "slug").where("chapter < end").drop("end")
    upto = Window.partitionBy("slug").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    both = known.join(due, ["slug", "block"], "full").select("slug", "chapter", F.coalesce(F.sum("n").over(upto), F.lit(0)).cast("int").alias("n_summaries"), F.collect_list("lines").over(upto).alias("lines"))
    found = with_arc(both.where("chapter is not null and n_summaries > 0"), arcs, every)
    tagged = lambda tag, c: F.concat(F.lit(f"<{tag}>\n"), c, F.lit(f"\n</{tag}>"))
    message = F.concat_ws("\n\n", F.lit(prompt), tagged(STORY, F.coalesce(strip("arc"), F.lit(NO_STORY))), tagged(RECENT, F.array_join("lines", "\n")))
    return found.select("slug", "chapter", "n_summaries", message.alias("message"))


def token_estimate(rows: DataFrame, col: str = "text") -> DataFrame:
    """Adds estimate: a token a Hangul syllable, and one for four other characters."""
    syllables = F.length(F.regexp_replace(F.coalesce(F.col(col), F.lit("")), "[^가-힣]", ""))
    other = F.length(F.coalesce(F.col(col), F.lit(""))) - syllables
    return rows.withColumn("estimate", syllables + F.floor(other / 4).cast("int"))


