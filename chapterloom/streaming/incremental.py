"""Mining over time: replies arrive in any order, and glossaries grow append-only.

State is one value a book, the known chapters and terms, read and written whole with each batch that has the book; a chapter
that comes again adds nothing. The loop that translates in order, with state that costs what an event brings, and the
gate are in loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from chapterloom.operators.parse import parse_mining

REPLIES = "slug string, chapter int, raw string"
GROWN = "slug string, chapter int, summary string, token_id int, korean string, english string, category string, note string, enforce boolean"
_STATE = "size int, chapters array<int>, known array<string>"
_TERM = ["korean", "english", "category", "note", "enforce"]


def read_replies(spark: SparkSession, path: str, files_per_trigger: int | None = 1) -> DataFrame:
    """The stream of replies (slug, chapter, raw) from Parquet files, in the order in which they appear; without a number of files, a batch takes all that are there."""
    reader = spark.readStream.schema(REPLIES)
    return (reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)).parquet(path)


def _grow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A book's new rows: one for each new chapter (with its summary), one for each new term."""
    size, chapters, known = state.get if state.exists else (0, [], [])
    chapters, known, rows = set(chapters), dict.fromkeys(known), []
    arrived = pd.concat(list(frames)).sort_values(["chapter", "raw_order"], kind="stable")
    for reply in arrived.itertuples(index=False):
        if reply.chapter in chapters:
            continue
        chapters.add(reply.chapter)
        rows.append((key[0], reply.chapter, reply.chapter_summary, None, *[None] * len(_TERM)))
        for term in reply.terms:
            if term["korean"] and term["english"] and term["korean"] not in known:
                known[term["korean"]] = None
                size += 1
                rows.append((key[0], reply.chapter, None, size, *[term[c] for c in _TERM]))
    state.update((size, sorted(chapters), list(known)))
    frame = pd.DataFrame(rows, columns=["slug", "chapter", "summary", "token_id", *_TERM])
    yield frame.astype({"token_id": "Int32", "enforce": "boolean"})


def grow_glossary(replies: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends each new chapter's summary and new terms to the table under ``path``; what exists never changes.

    A failed reply adds nothing, and its chapter may come again; of several good replies to a chapter the first counts,
    in one batch the one whose text sorts first.
    """
    parsed = parse_mining(replies).where("parse_error is null and slug is not null and chapter is not null")
    terms = F.transform("terms", lambda t: F.struct(*[t[c].alias(c) for c in _TERM]))
    rows = parsed.select("slug", "chapter", F.col("raw").alias("raw_order"), "chapter_summary", terms.alias("terms"))
    grown = rows.groupBy("slug").applyInPandasWithState(_grow, GROWN, _STATE, "append", "NoTimeout")
    return grown.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def grown_terms(spark: SparkSession, path: str) -> DataFrame:
    """(slug, token_id, korean, english, category, note, enforce) of what a stream has written so far."""
    return spark.read.schema(GROWN).parquet(path).where("token_id is not null").select("slug", "token_id", *_TERM)


def grown_summaries(spark: SparkSession, path: str) -> DataFrame:
    """(slug, chapter, summary) of the chapters that a stream has taken in, for context windows."""
    return spark.read.schema(GROWN).parquet(path).where("token_id is null").select("slug", "chapter", "summary")
