"""Tokens in replies: substitution, faults, repair, and the gate that withholds what is not clean."""

from __future__ import annotations

import difflib
from bisect import bisect_left
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chapterloom.functions import text as X
from chapterloom.operators.finder import checked_column, forgotten_column
from chapterloom.operators.match import book_terms, percent, picked, size_of, with_books


def substitute(replies: DataFrame, ids: DataFrame, col: str = "raw") -> DataFrame:
    """Adds body (tokens replaced by their renderings) and leaked (whatever is still in brackets); ids: (slug, ids MAP). Replies may carry ``size``: larger ids aren't known then."""
    return _with_body(replies.join(ids, "slug", "left"), col)


def _with_body(rows: DataFrame, col: str = "raw") -> DataFrame:
    """substitute() for rows that have their book's ids."""
    if "size" in rows.columns:
        rows = rows.withColumn("ids", F.map_filter("ids", lambda k, _: k <= F.col("size")))
    empty = F.create_map().cast("map<int,string>")
    rows = rows.withColumn("body", X.apply_tokens(F.col(col), F.coalesce("ids", empty))).drop("ids")
    return rows.withColumn("leaked", X.leaked(F.col("body")))


def invalid_tokens(replies: DataFrame, sizes: DataFrame, col: str = "raw") -> DataFrame:
    """Adds invalid: numbered tokens, in order, that are no term of the book; sizes: (slug, n_terms)."""
    rows = replies.join(sizes.select("slug", "n_terms"), "slug", "left")
    return rows.withColumn("invalid", _invalid(F.col(col), F.coalesce("n_terms", F.lit(0)))).drop("n_terms")


def _invalid(c, n):
    pairs = F.arrays_zip(X.token_texts(c).alias("t"), X.token_ids(c).alias("i"))
    found = F.transform(F.filter(pairs, lambda p: ~F.coalesce(p["i"].between(1, n), F.lit(False))), lambda p: p["t"])
    return F.coalesce(found, F.array().cast("array<string>"))


def new_entities(replies: DataFrame, col: str = "raw") -> DataFrame:
    """(slug, chapter, pos, korean, english) of each self-reported entity."""
    rows = replies.select("slug", "chapter", F.posexplode_outer(X.new_entities(F.col(col))).alias("pos", "e")).where("pos is not null")
    return rows.select("slug", "chapter", "pos", "e.korean", "e.english")


def _with_places(rows: DataFrame, col: str = "raw") -> DataFrame:
    """rows that have their books: adds places, where forgotten terms are among the book's. Only enforced terms whose token isn't in the reply are looked for."""
    rows = rows.withColumn("size", size_of(rows)).withColumn("ids", F.regexp_extract_all(col, F.lit(X.TOKEN), F.lit(1)))
    return rows.withColumn("places", forgotten_column()("slug", "keys", "enforced", "ids", "source", "size"))


def _with_forgotten(pairs: DataFrame, glossary: DataFrame) -> DataFrame:
    """pairs with their books, and forgotten."""
    rows = _with_places(with_books(pairs, book_terms(glossary)))
    missed = F.transform(picked("places"), lambda t: F.struct(t["korean"].alias("korean"), F.concat(F.lit("[[G"), t["token_id"].cast("string"), F.lit("]]")).alias("token")))
    return rows.withColumn("forgotten", missed)


def untokenized_terms(pairs: DataFrame, glossary: DataFrame) -> DataFrame:
    """pairs (slug, chapter, source, raw): adds forgotten, the enforced terms that occur in the source on their own but whose token is not in the reply.

    A term that longer terms contain counts where it stands after those are cut out. Pairs may carry ``size`` (see match).
    """
    return _with_forgotten(pairs, glossary).select(*[f"`{c}`" for c in pairs.columns if c != "forgotten"], "forgotten")


def defect_table(pairs: DataFrame, glossary: DataFrame) -> DataFrame:
    """(slug, chapter, forgotten, invalid, new, needs_repair); new entities alone need no repair, nor does a null source or reply."""
    rows = _with_forgotten(pairs, glossary)
    rows = rows.select(
        "slug",
        "chapter",
        "forgotten",
        _invalid(F.col("raw"), F.least(F.coalesce("n_terms", F.lit(0)), "size")).alias("invalid"),
        F.coalesce(X.new_entities(F.col("raw")), F.array()).alias("new"),
    )
    return rows.withColumn("needs_repair", (F.size("forgotten") > 0) | (F.size("invalid") > 0))


def defect_totals(defects: DataFrame) -> DataFrame:
    """Sums for each book, and for all (slug null)."""
    return defects.rollup("slug").agg(F.sum(F.size("forgotten")).alias("forgotten"), F.sum(F.size("invalid")).alias("invalid"), F.sum(F.size("new")).alias("new"), F.count_if("needs_repair").alias("need_repair"))


def _extended(a: str, b: str, i: int, j: int, k: int, alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
    """The match with the equal characters at its ends, frequent ones too."""
    while i > alo and j > blo and a[i - 1] == b[j - 1]:
        i, j, k = i - 1, j - 1, k + 1
    while i + k < ahi and j + k < bhi and a[i + k] == b[j + k]:
        k += 1
    return i, j, k


def _longest(a: str, b: str, where: dict[str, list[int]], seeds: list[int], alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
    """difflib's find_longest_match where nothing is junk. Only seeds, the places of a whose character ``where`` has, are visited, and of the places in b those within the range."""
    besti, bestj, bestsize = alo, blo, 0
    sizes: dict[int, int] = {}
    last = -2
    for at in range(bisect_left(seeds, alo), bisect_left(seeds, ahi)):
        i = seeds[at]
        get = sizes.get if i == last + 1 else {}.get
        last, sizes = i, {}
        places = where[a[i]]
        for p in range(bisect_left(places, blo) if blo else 0, len(places)):
            j = places[p]
            if j >= bhi:
                break
            k = sizes[j] = get(j - 1, 0) + 1
            if k > bestsize:
                besti, bestj, bestsize = i - k + 1, j - k + 1, k
    return _extended(a, b, besti, bestj, bestsize, alo, ahi, blo, bhi)


#: Longest run of seeds for which substrings are looked up; slices of that length are held for every seed of a range.
SHORT_RUN = 64


def _run_ends(seeds: list[int]) -> list[int]:
    """For each seed, where the run of consecutive ones that it is in ends."""
    ends = list(seeds)
    for at in range(len(seeds) - 1, -1, -1):
        ends[at] = ends[at + 1] if at + 1 < len(seeds) and seeds[at + 1] == seeds[at] + 1 else seeds[at] + 1
    return ends


def _longest_by_lookup(a: str, b: str, seeds: list[int], ends: list[int], others: list[int], alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
    """As _longest(), for short runs of seeds: whether the range of b has a longer substring is looked up for each seed, so pairs of places are never visited. others: the seeds of b."""
    besti, bestj, bestsize = alo, blo, 0
    at, last = bisect_left(seeds, alo), bisect_left(seeds, ahi)
    while at < last:
        size = bestsize + 1
        known = {b[j : j + size] for j in others[bisect_left(others, blo) : bisect_left(others, bhi - bestsize)]}
        at = next((n for n in range(at, last) if min(ends[n], ahi) - seeds[n] >= size and a[seeds[n] : seeds[n] + size] in known), last)
        if at < last:
            besti, end = seeds[at], min(ends[at], ahi)
            while besti + size < end and b.find(a[besti : besti + size + 1], blo, bhi) >= 0:
                size += 1
            bestj, bestsize, at = b.find(a[besti : besti + size], blo, bhi), size, at + 1
    return _extended(a, b, besti, bestj, bestsize, alo, ahi, blo, bhi)


def ratio_of(x: str, y: str, autojunk: bool = True) -> float:
    """difflib's ratio, from the same matching blocks; equal texts need no comparison."""
    if x == y:
        return 1.0
    where = difflib.SequenceMatcher(None, x, y, autojunk).b2j
    seeds = [i for i, c in enumerate(x) if c in where]
    ends = _run_ends(seeds)
    short = all(end - i <= SHORT_RUN for i, end in zip(seeds, ends))
    others = [j for j, c in enumerate(y) if c in where] if short else []
    found, ranges = 0, [(0, len(x), 0, len(y))]
    while ranges:
        alo, ahi, blo, bhi = ranges.pop()
        i, j, k = _longest_by_lookup(x, y, seeds, ends, others, alo, ahi, blo, bhi) if short else _longest(x, y, where, seeds, alo, ahi, blo, bhi)
        found += k
        parts = ((alo, i, blo, j), (i + k, ahi, j + k, bhi)) if k else ()
        ranges += [p for p in parts if p[0] < p[1] and p[2] < p[3]]
    return 2.0 * found / (len(x) + len(y))


def similarity(autojunk: bool = True):
    """difflib's ratio of two text columns as a pandas UDF; autojunk drops characters that are frequent in long texts."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else ratio_of(x, y, autojunk) for x, y in zip(a, b)], dtype="float64")

    return ratio


def repair_bounds(repairs: DataFrame, least: float = 0.7, autojunk: bool = True) -> DataFrame:
    """repairs (slug, chapter, raw, repaired): adds ratio of the prose without tokens, and in_bounds. Nothing else needs Python."""
    rows = repairs.withColumn("ratio", similarity(autojunk)(X.prose(F.col("raw")), X.prose(F.col("repaired"))))
    return rows.withColumn("in_bounds", F.coalesce(F.col("ratio") >= least, F.lit(False)))


def repair_retry(sent: DataFrame, bounded: DataFrame, still: DataFrame) -> DataFrame:
    """(slug, chapter, reason): repairs to ask for again; missing, out of bounds or still defective.

    sent: chapters (slug, chapter) that went to repair; bounded: repair_bounds' rows; still: the
    repaired replies' defect table.
    """
    rows = sent.join(bounded.select("slug", "chapter", "in_bounds"), ["slug", "chapter"], "left").join(still.select("slug", "chapter", "needs_repair"), ["slug", "chapter"], "left")
    reason = F.when(F.col("in_bounds").isNull(), "missing").when(~F.col("in_bounds"), "out of bounds").when(F.col("needs_repair"), "still defective")
    return rows.select("slug", "chapter", reason.alias("reason")).where("reason is not null")


def choose_translation(replies: DataFrame, bounded: DataFrame) -> DataFrame:
    """(slug, chapter, raw, repaired, rejected): the repair if it is in bounds, else the reply."""
    rows = replies.select("slug", "chapter", "raw").join(bounded.select("slug", "chapter", F.col("repaired").alias("r"), "in_bounds"), ["slug", "chapter"], "left")
    used = F.coalesce("in_bounds", F.lit(False))
    return rows.select("slug", "chapter", F.when(used, F.col("r")).otherwise(F.col("raw")).alias("raw"), used.alias("repaired"), (F.col("in_bounds").isNotNull() & ~used).alias("rejected"))


def fail_closed_gate(substituted: DataFrame) -> DataFrame:
    """Adds status and leaks: a chapter with anything left in brackets needs a human, and its body is replaced by the sorted distinct leaks."""
    leaks = F.array_sort(F.array_distinct("leaked"))
    bad = F.size("leaked") > 0
    return substituted.withColumns({
        "status": F.when(bad, "NEEDS_HUMAN").otherwise("ok"),
        "leaks": leaks,
        "body": F.when(bad, F.concat(F.lit("[withheld: "), F.array_join(leaks, ", "), F.lit("]"))).otherwise(F.col("body")),
    })


def chapter_report(gated: DataFrame, checked: DataFrame, defects: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row a chapter: status, leaks (distinct) and their number, defects before repair, whether its repair was rejected, and adherence unless withheld.

    A chapter that one of the tables lacks has zeros and empty lists from it.
    """
    key = ["slug", "chapter"]
    rows = gated.select(*key, "status", "leaks", F.size("leaked").alias("n_leaks"))
    rows = rows.join(checked.select(*key, "present", "violations"), key, "left").join(chosen.select(*key, "rejected"), key, "left")
    rows = rows.join(defects.select(*key, F.size("forgotten").alias("forgotten"), F.size("invalid").alias("invalid"), F.size("new").alias("new")), key, "left")
    ok, none = F.col("status") == "ok", F.lit(0)
    return rows.select(
        *key,
        "status",
        "leaks",
        "n_leaks",
        *[F.coalesce(c, none).alias(c) for c in ("forgotten", "invalid", "new")],
        F.coalesce("rejected", F.lit(False)).alias("rejected"),
        F.when(ok, F.coalesce("present", none)).alias("present"),
        F.when(ok, F.coalesce(F.transform("violations", lambda t: t["korean"]), F.array())).alias("violations"),
    )


def finish(rows: DataFrame, glossary: DataFrame, texts: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Gate, adherence and defects at once, for rows (slug, chapter, source, raw, sent, rejected): chapter_report's columns, then size, where rows have it, and the gated body.

    raw is the chosen translation, sent the reply before its repair; ``size`` as in match. All of a chapter is in one row: texts are never shuffled to meet each
    other, and once to meet their book's terms, where those are too many to be broadcast. texts: makes the row's texts after that, from less.
    """
    numbers = F.map_from_entries(F.transform("terms", lambda t: F.struct(t["token_id"].cast("int"), t["english"])))
    rows = texts(with_books(rows, book_terms(glossary).withColumn("ids", numbers)))
    sized = [c for c in ("size",) if c in rows.columns]
    rows = fail_closed_gate(_with_body(rows))
    rows = rows.withColumn("found", checked_column()("slug", "keys", "lows", "source", F.lower("body"), size_of(rows)))
    rows = _with_places(rows, "sent")
    ok, none, known = F.col("status") == "ok", F.lit(0), F.col("slug").isNotNull() & F.col("chapter").isNotNull()
    n_known = lambda c: F.coalesce(F.when(known, c), none)
    there = known & F.col("body").isNotNull()
    wrong = F.transform("found.wrong", lambda p: F.element_at("keys", p + 1))
    return rows.select(
        "slug",
        "chapter",
        "status",
        "leaks",
        F.size("leaked").alias("n_leaks"),
        n_known(F.size("places")).alias("forgotten"),
        n_known(F.size(_invalid(F.col("sent"), F.least(F.coalesce("n_terms", none), "size")))).alias("invalid"),
        n_known(F.size(X.new_entities(F.col("sent")))).alias("new"),
        (F.coalesce("rejected", F.lit(False)) & known).alias("rejected"),
        F.when(ok, F.coalesce(F.when(there, F.size("found.present")), none)).alias("present"),
        F.when(ok, F.coalesce(F.when(there, wrong), F.array().cast("array<string>"))).alias("violations"),
        *sized,
        "body",
    )


def run_report(chapters: DataFrame, parsed: DataFrame, folded: DataFrame) -> DataFrame:
    """One row a book from chapter_report's rows: its status, chapters and how many replies parsed, adherence over what was not withheld, leaks, withheld and rejected chapters, defects before repair, and the terms that fold-back added.

    parsed: (slug, chapter, parse_error); folded: (slug, token_id, korean) of the added terms.
    """
    ok = F.col("status") == "ok"
    out = chapters.groupBy("slug").agg(
        F.count(F.lit(1)).alias("chapters"),
        F.count_if(ok).alias("chapters_ok"),
        F.coalesce(F.sum("present"), F.lit(0)).alias("present"),
        F.coalesce(F.sum(F.when(ok, F.col("present") - F.size("violations"))), F.lit(0)).alias("ok"),
        F.sum("n_leaks").alias("leaks"),
        F.array_sort(F.collect_list(F.when(~ok, F.col("chapter")))).alias("withheld"),
        F.array_sort(F.collect_list(F.when(F.col("rejected"), F.col("chapter")))).alias("rejected"),
        F.sum("forgotten").alias("forgotten"),
        F.sum("invalid").alias("invalid"),
        F.sum("new").alias("new"),
    )
    good = parsed.groupBy("slug").agg(F.count_if(F.col("parse_error").isNull()).alias("parse_ok"))
    added = folded.groupBy("slug").agg(F.transform(F.array_sort(F.collect_list(F.struct("token_id", "korean"))), lambda t: t["korean"]).alias("new_entities_folded"))
    out = out.join(good, "slug", "left").join(added, "slug", "left").withColumns({"parse_ok": F.coalesce("parse_ok", F.lit(0)), "new_entities_folded": F.coalesce("new_entities_folded", F.array().cast("array<string>"))})
    return out.withColumns({"status": F.when(F.size("withheld") > 0, "NEEDS_HUMAN").otherwise("OK"), "pct": percent("ok", "present")})
