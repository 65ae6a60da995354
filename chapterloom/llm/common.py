"""Helpers shared by the text operators: text columns in tasks, held-out splits; scratch tables are the library's."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from chapterloom.sources.scratch import drop_scratch, new_path, scratch_dir, store

__all__ = ["drop_scratch", "id_hash", "in_batches", "most_frequent", "new_path", "packed", "runs", "scratch_dir", "store", "with_text_columns", "without"]


def id_hash(column: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def most_frequent(counts: DataFrame, limit: int, column: str = "times") -> DataFrame:
    """The rows of a stored table with the largest counts, limit rows at most.

    Counts fall into some hundred classes, of which the highest that fit stay whole; nothing is sorted, so no
    task gets limit rows of every other.
    """
    kind = F.floor(8 * F.log2(F.col(column)))
    sizes = counts.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).collect()
    left, least = limit, None
    for row in sorted(sizes, key=lambda r: -r.kind):
        left -= row.n
        if left < 0:
            break
        least = row.kind
    return counts.where(F.lit(False)) if least is None else counts.where(kind >= least)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df without the columns of these names, whatever their case."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row as one struct, and copies of some columns to work on; so columns of docs never clash with new ones."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


#: Bytes of an Arrow batch that goes to a Python worker; Spark's own default is thirty-two times as much, held on both sides by every task.
BATCH_BYTES = "2m"


def in_batches(df: DataFrame, run, schema) -> DataFrame:
    """mapInArrow with batches of bounded size, by the session's setting; a task gives the memory it no longer uses back at its end."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(tidy, schema)


def with_text_columns(docs: DataFrame, make, fields: list[T.StructField], text_col: str = "text", keep=None, chunk_chars: int = 500_000) -> DataFrame:
    """Adds columns that are computed from the text column in Arrow batches.

    make() runs once for each task and gives a function from a list of texts (None for
    null) to one list or Arrow array for each field. Texts come in runs of about
    chunk_chars characters, so that memory doesn't follow the batch size. Columns of
    docs that have a field's name are replaced. keep: (function from the new columns
    to a mask) drops rows.
    """
    base = without(docs, [f.name for f in fields])
    schema = T.StructType([*base.schema.fields, *fields])
    arrow = to_arrow_schema(T.StructType(fields))

    def run(batches):
        function = make()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            for lo, hi in runs(texts, chunk_chars):
                new = function(texts[lo:hi])
                kept = pa.array(keep(new), pa.bool_()) if keep is not None else None
                for a, b in pieces(new, hi - lo):
                    arrays = [x[a:b] if isinstance(x, pa.Array) else pa.array(x[a:b], f.type) for x, f in zip(new, arrow)]
                    out = pa.RecordBatch.from_arrays([*(c.slice(lo + a, b - a) for c in batch.columns), *arrays], names=[*batch.schema.names, *arrow.names])
                    if kept is not None:
                        out = out.filter(kept[a:b])
                    if out.num_rows:
                        yield out

    return in_batches(base, run, schema)


def pieces(columns: list, n: int, most: int = 100_000):
    """Spans of n rows whose lists hold about most elements together, one row at least."""
    lists = [x for x in columns if isinstance(x, list) and any(isinstance(y, list) for y in x)]
    lo = total = 0
    for i in range(n) if lists else ():
        size = sum(len(x[i] or ()) for x in lists)
        if i > lo and total + size > most:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < n:
        yield lo, n


def runs(texts: list, chunk_chars: int):
    """Spans (lo, hi) of consecutive texts with about chunk_chars characters each, at least one text each."""
    lo = total = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > lo and total + n > chunk_chars:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(texts):
        yield lo, len(texts)
