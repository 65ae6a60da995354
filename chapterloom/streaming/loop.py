"""The real-time loop: chapters of a book are translated strictly in order, each with what the chapters before it gave.

Events come as a stream: replies to translation requests, and replies to arc requests. State is kept for each book in
stores of their own, so that an event costs what it brings: a map of the known terms (looked up by term, never read whole), a list
of the last summaries, the arc, where the book stands, and events that came early. A book's chapters close one after
the other: by the first reply that parses, or by the last failed attempt. A chapter that closes gives

- ``term`` rows, for terms that weren't known; ids go on, nothing that exists changes,
- a ``reply`` row (or ``failed``) with how many terms its request showed,
- a ``request`` row for the next chapter: number of terms, arc and last summaries. After every so many chapters an
  ``arc`` row asks for a new arc first, and the request waits for that reply; a failed one keeps the old arc.

The rows are the same for any split of the events into batches, also where chapters come out of order, are repeated or come again
after a restart. Only of several good replies to one chapter the first to arrive counts, within a batch the least seq.

The gate reads the loop's rows as a second stream and works on its batches with the batch operators; each reply is judged by
the terms that its request showed. A batch that is delivered again writes its own folder over.

Defined results: events without a book, or with a chapter below 1, are left out; a null or unknown kind is a reply. Equal
seqs go by text. Null texts fail. A book's first chapter is 1; it needs no state, so requests() makes its request.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from chapterloom.functions.text import filled, section
from chapterloom.operators.context import user_message
from chapterloom.operators.parse import parse_translations
from chapterloom.operators.tokens import finish

EVENTS = "slug string, chapter int, seq long, kind string, raw string"
_TERM = ["korean", "english", "category", "note", "enforce"]
_TERMS = "array<struct<korean:string,english:string,category:string,note:string,enforce:boolean>>"
#: The loop's rows; kind is term, reply, failed, arc or request.
ROWS = "kind string, slug string, chapter int, size int, arc string, prior array<struct<chapter:int,summary:string>>, summary string, raw string, token_id int, korean string, english string, category string, note string, enforce boolean"
COLUMNS = [c.split()[0] for c in ROWS.split(", ")]

_EVENT = ["seq", "good", "body", "summary", "terms"]

ARC_TAG = "arc_summary"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _fields(struct, names: list[str]) -> tuple:
    """A nested struct as a tuple, whether it comes as a Row or as a dict."""
    return tuple(struct[n] for n in names)


class Loop(StatefulProcessor):
    """State and rows of one book; see the module's text."""

    def __init__(self, window: int = 3, arc_every: int = 5, attempts: int = 2):
        self.window, self.arc_every, self.attempts = window, arc_every, attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", "done int, waits boolean, failures int, size int, early int")
        self.arc = handle.getValueState("arc", "arc string")
        self.last = handle.getListState("summaries", "chapter int, summary string")
        self.terms = handle.getMapState("terms", "korean string", "token_id int")
        self.early = handle.getMapState("early", "kind string, chapter int", f"events array<struct<seq:bigint,good:boolean,body:string,summary:string,terms:{_TERMS}>>")

    def _row(self, kind: str, chapter: int, **more) -> Row:
        return Row(**{**self.blank, "kind": kind, "slug": self.slug, "chapter": chapter, **more})

    def _kept(self, kind: str, chapter: int) -> list[tuple]:
        events = [_fields(e, _EVENT) for e in self.early.getValue((kind, chapter))[0]]
        return [(*e[:4], [_fields(t, _TERM) for t in e[4] or []]) for e in events]

    def _take(self, kind: str, chapter: int) -> list:
        """All events of a chapter that are here, the ones kept early first, and forgets them."""
        kept = []
        if self.n_early and self.early.containsKey((kind, chapter)):
            kept = self._kept(kind, chapter)
            self.early.removeKey((kind, chapter))
            self.n_early -= 1
        return kept + self.here.pop((kind, chapter), [])

    def _request(self, chapter: int) -> Row:
        arc = self.arc.get()[0] if self.arc.exists() else None
        prior = [tuple(s) for s in self.last.get()] if self.last.exists() else []
        return self._row("request", chapter, size=self.size, arc=arc, prior=prior)

    def _accept(self, chapter: int, event: tuple) -> Iterator[Row]:
        _, _, body, summary, terms = event
        yield self._row("reply", chapter, size=self.size, summary=summary, raw=body)
        for term in terms or []:
            if term[0] and term[1] and not self.terms.containsKey((term[0],)):
                self.size += 1
                self.terms.updateValue((term[0],), (self.size,))
                yield self._row("term", chapter, token_id=self.size, **dict(zip(_TERM, term)))
        known = [tuple(s) for s in self.last.get()] if self.last.exists() else []
        self.last.put([*known, (chapter, summary)][-self.window :])

    def _advance(self) -> Iterator[Row]:
        while True:
            if self.waits:
                told = self._take("arc", self.done)
                if not told:
                    return
                if told[0][1]:
                    self.arc.update((told[0][2],))
                self.waits = False
                yield self._request(self.done + 1)
                continue
            chapter, closed = self.done + 1, False
            for event in self._take("reply", chapter):
                if event[1]:
                    yield from self._accept(chapter, event)
                    closed = True
                    break
                self.failures += 1
                if self.failures >= self.attempts:
                    yield self._row("failed", chapter, size=self.size)
                    closed = True
                    break
            if not closed:
                return
            self.done, self.failures = chapter, 0
            if chapter % self.arc_every == 0:
                self.waits = True
                yield self._row("arc", chapter, size=self.size, arc=self.arc.get()[0] if self.arc.exists() else None)
            else:
                yield self._request(chapter + 1)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self.slug, self.blank = key[0], dict.fromkeys(COLUMNS)
        self.done, self.waits, self.failures, self.size, self.n_early = self.at.get() if self.at.exists() else (0, False, 0, 0, 0)
        self.here: dict[tuple[str, int], list] = {}
        seen = set()
        for r in sorted(rows, key=lambda r: (r.chapter, r.seq is None, r.seq or 0, r.text or "")):
            # What is closed, and a second copy of an event in this batch, adds nothing.
            if r.chapter <= self.done and not (r.kind == "arc" and r.chapter == self.done and self.waits) or (r.kind, r.chapter, r.seq) in seen:
                continue
            seen.add((r.kind, r.chapter, r.seq))
            body = r.text[r.begin - 1 : r.begin - 1 + r.length] if r.good else None
            self.here.setdefault((r.kind, r.chapter), []).append((r.seq, r.good, body, r.summary, [_fields(t, _TERM) for t in r.terms or []]))
        yield from self._advance()
        for (kind, chapter), events in self.here.items():
            if chapter < self.done or chapter == self.done and not (kind == "arc" and self.waits):
                continue
            there = self.early.containsKey((kind, chapter))
            kept = self._kept(kind, chapter) if there else []
            seqs = {e[0] for e in kept}
            self.early.updateValue((kind, chapter), ([*kept, *(e for e in events if e[0] not in seqs)],))
            self.n_early += not there
        self.at.update((self.done, self.waits, self.failures, self.size, self.n_early))

    def close(self) -> None:
        pass



@contextmanager
def _state_in_rocksdb(spark: SparkSession):
    """Maps and lists of state need this store, and a task's store would take 4 MB of disk for its manifest ahead, however little it holds; the session's own settings come back when the query has started."""
    own = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
    before = {name: spark.conf.get(name, None) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_events(spark: SparkSession, path: str, files_per_trigger: int | None = 1) -> DataFrame:
    """The stream of events from Parquet files, in the order in which they appear; without a number of files, a batch takes all that are there."""
    reader = spark.readStream.schema(EVENTS)
    return (reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)).parquet(path)


def parsed_events(events: DataFrame) -> DataFrame:
    """(slug, chapter, seq, kind, good, begin, length, summary, terms, text) of the events that count; a good one's body is so many characters of its text, which is shuffled once, not twice."""
    rows = events.where("slug is not null and chapter >= 1").withColumn("kind", F.when(F.col("kind") == "arc", "arc").otherwise("reply"))
    rows = parse_translations(rows).withColumn("told", filled(section("raw", ARC_TAG)))
    arc = F.col("kind") == "arc"
    good = F.when(arc, F.col("told").isNotNull()).otherwise(F.col("parse_error").isNull())
    terms = F.transform("terms", lambda t: F.struct(*[t[c].alias(c) for c in _TERM]))
    body = F.when(arc, F.col("told")).otherwise(F.col("translation"))
    return rows.select(
        "slug", "chapter", "seq", "kind", good.alias("good"), F.position(body, F.col("raw")).alias("begin"), F.length(body).alias("length"),
        F.col("chapter_summary").alias("summary"), F.when(good & ~arc, terms).alias("terms"), F.col("raw").alias("text"),
    )


def run_loop(events: DataFrame, path: str, checkpoint: str, window: int = 3, arc_every: int = 5, attempts: int = 2) -> StreamingQuery:
    """Writes the loop's rows to the table under ``path``."""
    spark = events.sparkSession
    rows = parsed_events(events).groupBy("slug").transformWithState(Loop(window, arc_every, attempts), ROWS, "Append", "None")
    with _state_in_rocksdb(spark):
        return rows.writeStream.format("parquet").option("path", path).option("compression", "zstd").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def loop_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(path).where(F.col("kind") == kind)


def loop_terms(spark: SparkSession, path: str) -> DataFrame:
    """The glossaries so far. Those with ids up to a request's ``size`` are what it showed."""
    return loop_rows(spark, path, "term").select("slug", "token_id", *_TERM)


def requests(spark: SparkSession, path: str, chapters: DataFrame) -> DataFrame:
    """(slug, chapter, size, message): the requests so far for the chapters (slug, chapter, text) that there are; each book's first needs nothing."""
    asked = loop_rows(spark, path, "request").select("slug", "chapter", "size", "arc", "prior")
    first = chapters.where("chapter = 1").select("slug", "chapter", F.lit(0).alias("size"), F.lit(None).cast("string").alias("arc"), F.lit(None).cast("array<struct<chapter:int,summary:string>>").alias("prior"))
    rows = first.unionByName(asked).join(chapters.select("slug", "chapter", "text"), ["slug", "chapter"])
    return user_message(rows).where("message is not null").select("slug", "chapter", "size", "message")


def judged(replies: DataFrame, terms: DataFrame, chapters: DataFrame, source: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """chapter_report's rows and the gated body, for the loop's replies (slug, chapter, size, raw) against chapters (slug, chapter, text); source makes a chapter's text of that column, once it has been shuffled.

    Both are dealt by book, so where spark.sql.requireAllClusterKeysForCoPartition is off they meet each other and their book's terms in one shuffle.
    """
    sources = chapters.select("slug", "chapter", F.col("text").alias("own")).repartition("slug")
    rows = replies.select("slug", "chapter", "size", "raw").repartition("slug").join(sources, ["slug", "chapter"], "left")
    texts = lambda r: r.withColumns({"source": source(F.col("own")), "sent": F.col("raw"), "rejected": F.lit(False)})
    return finish(rows, terms, texts).drop("rejected")


def gate_loop(spark: SparkSession, path: str, chapters: DataFrame, out: str, checkpoint: str, source: Callable[[Column], Column] = lambda text: text) -> StreamingQuery:
    """Judges the loop's replies as they come; source as in judged(). A reply's terms were written before it, or with it."""

    def step(batch: DataFrame, number: int) -> None:
        batch.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # the stream's own session
        replies = batch.where("kind = 'reply'")
        # Ids are given once, so a later look at the table shows no less than an earlier one.
        terms = loop_terms(batch.sparkSession, path).join(replies.select("slug").distinct(), "slug", "left_semi")
        judged(replies, terms, chapters, source).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={number}")

    rows = spark.readStream.schema(ROWS).parquet(path)
    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
