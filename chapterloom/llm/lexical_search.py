"""Ranked lexical search: exact top lists of documents for a set of items, with norm buckets (LEMP).

A document is a vector over the terms of the items: a term's coordinate is its weight times its saturated frequency.
An item asks for the sum over its terms, the inner product with a vector of ones. Documents are read once, into
counts of the items' terms; then

1. corpus figures (documents N, terms L, documents df of each term) are sums over all documents, so coordinates are known;
2. the longest vectors are searched first, in buckets of equal length class; the least score of each item's top list there
   is a threshold that every later document has to reach;
3. the others are searched in batches, sorted by length and cut into buckets. A bucket is left out for an item by
   Cauchy and Schwarz (the bucket's greatest length times the item's), or by the greatest coordinates of its terms. In a
   bucket that is left the item's heaviest terms are added up first, as few as leave a rest that cannot reach the threshold
   alone; documents with none of them are out, and the others stay only if what they have, and the least of the rest's
   greatest coordinates and of the rest's length (Cauchy and Schwarz again), can reach it. Bounds are rounded up,
   so that ties survive;
4. survivors are scored in 64-bit integers. A task gives at most ``top`` rows an item; of those the best are the result.

Items are queries: they come through the driver in blocks of BLOCK_TERMS terms, each broadcast and searched alone.
Nothing else passes the driver but figures of a block's terms, of length classes, and one threshold an item.

Defined results: null texts have no terms; an item without terms, or whose terms no document holds, has no rows. Rows of one
item_id are one item with all their terms; rows with equal doc_id are documents each. Equal scores rank by doc_id, a null
one last. A document of any length is one vector; terms that no item has only count for its length. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chapterloom.llm.common import in_batches, runs, store

TOP = 10
#: Terms of the items that are searched at once, some 100 bytes each.
BLOCK_TERMS = 500_000
#: Documents of a bucket, at most.
BUCKET = 512
#: Length classes: so many to a doubling.
FINENESS = 4
#: Of the vectors, the part that is searched first (and FIRST_LEAST at least), by whole length classes.
FIRST_PART, FIRST_LEAST = 0.01, 2_000
#: Bounds are floating-point numbers; they are raised by this part.
SLACK = 1e-9

#: Term bytes (letters and digits of ASCII, all other characters) lower-cased, everything else a blank.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_VECTORS = "doc_id long, n long, ids array<int>, tfs array<int>"
_FOUND = "item int, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Block:
    """Items that are searched together: their ids, the vocabulary of their terms, and each one's term numbers."""

    def __init__(self, items: list[tuple[int | None, set[bytes]]]):
        self.ids = [i for i, _ in items]
        self.vocabulary = {t: k for k, t in enumerate(dict.fromkeys(t for _, terms in items for t in sorted(terms)))}
        self.terms = [np.array(sorted(self.vocabulary[t] for t in terms), np.int64) for _, terms in items]


def blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks of about block_terms terms; the driver holds one block, and a partition of item texts."""
    held, size, last = [], 0, object()
    rows = items.select("item_id", "text").where("text is not null").repartitionByRange("item_id").sortWithinPartitions("item_id")
    for row in rows.toLocalIterator():
        new = set(terms_of(row.text))
        if not new:
            continue
        if held and row.item_id == last:
            held[-1][1].update(new)
        else:
            if size >= block_terms:
                yield Block(held)
                held, size = [], 0
            held.append((row.item_id, new))
        size, last = size + len(new), row.item_id
    if held:
        yield Block(held)


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], chunk_chars: int = 500_000) -> DataFrame:
    """(doc_id, n, ids, tfs) of each document with a term: how many it has, and those of the vocabulary with their frequencies."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in runs(texts, chunk_chars):
                keep, n, size, terms, times = [], [], [0], [], []
                for i in range(lo, hi):
                    words = terms_of(texts[i]) if texts[i] else []
                    if not words:
                        continue
                    own = [(k, c) for t, c in Counter(words).items() if (k := vocabulary.get(t)) is not None]
                    own.sort()
                    keep.append(i)
                    n.append(len(words))
                    terms += [k for k, _ in own]
                    times += [c for _, c in own]
                    size.append(len(terms))
                if keep:
                    lists = [pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(v, pa.int32())) for v in (terms, times)]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep)), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "ids", "tfs"])

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, _VECTORS)


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Coordinates:
    """Vectors of an Arrow batch of term_counts: coordinates and lengths."""

    def __init__(self, weight: np.ndarray, n_docs: int, n_terms: int):
        self.weight, self.n_docs, self.n_terms = weight, n_docs, n_terms

    def __call__(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where each row's terms begin (and all end), the terms, their coordinates, and each row's length."""
        n = batch.column(1).to_numpy()
        lists = batch.column(2)
        at = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy()[at[0] : at[-1]].astype(np.int64)
        tf = batch.column(3).values.to_numpy()[at[0] : at[-1]].astype(np.int64)
        at = at - at[0]
        m = 100 - 90 + (90 * n * self.n_docs) // self.n_terms
        value = self.weight[ids] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(at))))
        squares = np.append(0.0, np.cumsum(value.astype(np.float64) ** 2))
        return at, ids, value, np.sqrt(np.maximum(squares[at[1:]] - squares[at[:-1]], 0) * (1 + 1e-6))


def length_class(length: np.ndarray) -> np.ndarray:
    return np.floor(FINENESS * np.log2(np.maximum(length, 1))).astype(np.int64)


class Lists:
    """Each item's best (score, doc_id) so far, in a task; a null doc_id is kept apart by the flag."""

    def __init__(self, items: int, least: np.ndarray, top: int):
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))] * items
        self.least, self.top = least.copy(), top

    def add(self, item: int, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        keep = score >= self.least[item]
        if not keep.any():
            return
        score, doc, null = (np.append(a, b[keep]) for a, b in zip(self.best[item], (score, doc, null)))
        order = np.lexsort((doc, null, -score))[: self.top]
        self.best[item] = score[order], doc[order], null[order]
        if len(order) == self.top:
            self.least[item] = max(self.least[item], int(score[order[-1]]))


class Bucket:
    """Some vectors of about equal length, by term: whose coordinates are how large."""

    def __init__(self, rows: np.ndarray, at: np.ndarray, ids: np.ndarray, value: np.ndarray, length: np.ndarray):
        size = at[rows + 1] - at[rows]
        start = np.cumsum(size) - size
        pick = np.arange(size.sum()) + np.repeat(at[rows] - start, size)
        self.rows, self.start, self.ids, self.value = rows, np.append(start, len(pick)), ids[pick], value[pick]
        self.length = length[rows]
        order = np.argsort(self.ids, kind="stable")
        self.row_of, self.by_term = np.repeat(np.arange(len(rows)), size)[order], self.value[order]
        self.terms, self.first = np.unique(self.ids[order], return_index=True)
        self.end = np.append(self.first[1:], len(order))
        self.most = np.maximum.reduceat(self.by_term, self.first) if len(order) else np.empty(0, np.int64)

    def survivors(self, terms: np.ndarray, least: float) -> np.ndarray:
        """Rows of this bucket whose score for an item of these terms may reach least, which is over 0."""
        where = np.searchsorted(self.terms, terms)
        where = where[(where < len(self.terms)) & (self.terms[np.minimum(where, len(self.terms) - 1)] == terms)]
        most = self.most[where]
        order = np.argsort(-most, kind="stable")
        where, most = where[order], most[order]
        rest = np.append(np.cumsum(most[::-1])[::-1], 0).astype(np.float64) * (1 + SLACK)
        if rest[0] < least:
            return where[:0]
        focus = int(np.searchsorted(-rest, -least, side="right"))  # terms from here on cannot reach least alone
        spans = [slice(self.first[w], self.end[w]) for w in where[:focus]]
        rows = np.concatenate([self.row_of[s] for s in spans])
        value = np.concatenate([self.by_term[s] for s in spans]).astype(np.float64)
        have, squares = np.bincount(rows, value, len(self.rows)), np.bincount(rows, value * value, len(self.rows))
        tail = np.sqrt((len(where) - focus) * np.maximum(self.length**2 - squares, 0))
        return np.flatnonzero((have > 0) & ((have + np.minimum(rest[focus], tail)) * (1 + SLACK) >= least))

    def exact(self, survivors: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The survivors' scores; wanted marks the item's terms in the vocabulary."""
        size = self.start[survivors + 1] - self.start[survivors]
        begin = np.cumsum(size) - size
        pick = np.arange(size.sum()) + np.repeat(self.start[survivors] - begin, size)
        return np.add.reduceat(np.where(wanted[self.ids[pick]], self.value[pick], 0), begin)


def search(vectors: DataFrame, block: Block, coordinates: Coordinates, least: np.ndarray, classes: tuple[int, int], top: int = TOP) -> DataFrame:
    """(item, doc_id, score): the best rows of each task among vectors whose length class is from classes[0] to classes[1] - 1."""
    items, size = block.terms, len(block.vocabulary)
    lengths = np.sqrt([len(t) for t in items])

    def run(batches):
        lists, wanted = Lists(len(items), least, top), np.zeros(size, bool)
        for batch in batches:
            at, ids, value, length = coordinates(batch)
            doc = batch.column(0)
            null, doc = np.asarray(doc.is_null()), doc.fill_null(0).to_numpy()
            kind = length_class(length)
            rows = np.flatnonzero((kind >= classes[0]) & (kind < classes[1]) & (length > 0))
            rows = rows[np.argsort(-length[rows], kind="stable")]
            for lo in range(0, len(rows), BUCKET):
                bucket = Bucket(rows[lo : lo + BUCKET], at, ids, value, length)
                for item in np.flatnonzero(lengths * bucket.length[0] * (1 + SLACK) >= lists.least):
                    found = bucket.survivors(items[item], float(lists.least[item]))
                    if len(found):
                        wanted[items[item]] = True
                        lists.add(item, bucket.exact(found, wanted), doc[bucket.rows[found]], null[bucket.rows[found]])
                        wanted[items[item]] = False
        for item, (score, doc, null) in enumerate(lists.best):
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), item), pa.int32()), pa.array(doc, mask=null), pa.array(score)], names=["item", "doc_id", "score"])

    return in_batches(vectors, run, _FOUND)


def class_sizes(vectors: DataFrame, coordinates: Coordinates) -> dict[int, int]:
    """How many vectors each length class has."""

    def run(batches):
        sizes = Counter()
        for batch in batches:
            length = coordinates(batch)[3]
            kinds, n = np.unique(length_class(length[length > 0]), return_counts=True)
            sizes.update(dict(zip(kinds.tolist(), n.tolist())))
        yield pa.RecordBatch.from_arrays([pa.array(list(sizes), pa.int64()), pa.array(list(sizes.values()), pa.int64())], names=["kind", "n"])

    return {r.kind: r.n for r in in_batches(vectors, run, "kind long, n long").groupBy("kind").agg(F.sum("n").alias("n")).collect()}


def best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _block_results(docs: DataFrame, block: Block, top: int) -> DataFrame:
    """(item, doc_id, score, rank) of a block's items."""
    vectors = store(term_counts(docs, block.vocabulary), "term-counts")
    total = vectors.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(len(block.vocabulary), np.int64)
    for r in vectors.select(F.explode_outer("ids").alias("id")).where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r.id] = r.df
    coordinates = Coordinates(weights(df, total.docs), total.docs, total.terms or 1)
    # The longest classes that hold the first part, so that thresholds are known for the rest.
    sizes, first, cut = class_sizes(vectors, coordinates), max(FIRST_LEAST, FIRST_PART * total.docs), 0
    for kind in sorted(sizes, reverse=True):
        cut, first = kind, first - sizes[kind]
        if first <= 0:
            break
    ones = np.ones(len(block.ids), np.int64)
    head = store(best(search(vectors, block, coordinates, ones, (cut, 1 << 30), top), top), "head")
    least = ones.copy()
    for r in head.where(F.col("rank") == top).select("item", "score").collect():
        least[r.item] = r.score
    rest = search(vectors, block, coordinates, least, (0, cut), top)
    return best(head.drop("rank").unionByName(rest), top)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``top`` documents with the highest scores above 0."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.range(0).select(F.lit(None).cast(kind).alias("item_id"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    for block in blocks(items, block_terms):
        names = F.broadcast(spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kind}"))
        found = store(_block_results(docs, block, top).join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        out = out.unionByName(found)
    return out


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), c AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0
), t AS (
  SELECT k, doc_id, n, term, count(*) AS tf FROM (SELECT k, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) GROUP BY ALL
), wanted AS (
  SELECT * FROM t WHERE term IN (SELECT term FROM q)
), weighted AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM wanted GROUP BY term), c
), v AS (
  SELECT k, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS x FROM wanted JOIN weighted USING (term), c
), s AS (
  SELECT item_id, k, doc_id, CAST(sum(x) AS BIGINT) AS score FROM q JOIN v USING (term) GROUP BY ALL
), r AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
