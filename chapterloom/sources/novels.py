"""Slicing novels' files into chapters where the files are split over tasks.

A file is read by lines, in as many tasks as it has splits; a task puts the lines between headers together and counts headers, which are then
counted over splits, so that every piece knows its chapter. All of it works on one stored scan: how files are split changes no row.

Defined results: as slice_chapters(), which takes whole texts. A file of its own is a novel, also where two have one name; an empty
file, or one without a header, has no chapter. A header is a line on its own: patterns don't see the lines around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chapterloom.functions.text import rstrip
from chapterloom.sources.books import HEADER, folder_of
from chapterloom.sources.scratch import store


def slug_of(file: Column) -> Column:
    """The file's stem; for Spark's own files, the folder's ``slug=``."""
    stem = F.regexp_replace(F.regexp_extract(file, r"([^/]+)$", 1), r"\.[^.]*$", "")
    own = F.coalesce(F.try_url_decode(F.replace(stem, F.lit("+"), F.lit("%2B"))), stem)
    return F.when(file.rlike(r"/slug=[^/]*/[^/]+$"), folder_of(file)).otherwise(own)


def read_lines(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """(file, block, row, sub, line): the lines of all files; (block, row, sub) is their order in one scan."""
    rows = spark.read.text(path, pathGlobFilter=files, recursiveFileLookup=True)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value")
    # The source breaks at \n and \r; the other breaks of a text are left.
    return rows.select("file", "block", "row", F.posexplode_outer(F.split("value", r"\R", -1)).alias("sub", "line"))


_PIECE = "file string, block long, seq long, upto int, whole boolean, text string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, head, line) in order as pieces, which begin at headers, blocks and batches: upto counts the block's headers so far, whole pieces are chapters."""
    last, upto, seq = None, 0, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, block, head = batch.column("file"), batch.column("block"), batch.column("head").to_numpy(zero_copy_only=False).astype(bool)
        key, number = file.dictionary_encode().indices.to_numpy(), block.to_numpy()
        new = np.r_[True, (key[1:] != key[:-1]) | (number[1:] != number[:-1])]  # another block than the line before
        at = np.flatnonzero(head | new)
        count = np.cumsum(head)
        opened = np.maximum.accumulate(np.where(new, np.arange(n), 0))[at]
        heads = count[at] - np.where(opened > 0, count[opened - 1], 0)
        first = file[0].as_py(), block[0].as_py()
        heads[opened == 0] += upto if first == last else 0
        ends = np.r_[at[1:], n]
        whole = head[at] & np.r_[~new[at[1:]], False]
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[at, n], pa.int32()), batch.column("line")), "\n")
        yield pa.RecordBatch.from_arrays([file.take(pa.array(at)), block.take(pa.array(at)), pa.array(seq + np.arange(len(ends))), pa.array(heads.astype("int32")), pa.array(whole), text], ["file", "block", "seq", "upto", "whole", "text"])
        last, upto, seq = (file[n - 1].as_py(), block[n - 1].as_py()), int(heads[-1]), seq + len(ends)


#: Rows of splits that are broadcast; some 150 bytes each.
BROADCAST_SPLITS = 500_000


def placed_pieces(lines: DataFrame, header: str = HEADER) -> DataFrame:
    """Lines of a scan, put together to stored pieces with chapter (0 before the first header) and found, the file's headers. Texts are neither sorted nor shuffled."""
    lines = lines.select("file", "block", F.col("line").rlike(rf"^(?:{header})").alias("head"), "line")
    pieces = store(lines.mapInArrow(_pieces, _PIECE), "pieces")
    blocks = pieces.groupBy("file", "block").agg(F.max("upto").alias("heads"))
    whole = Window.partitionBy("file")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = store(blocks.select("file", "block", F.coalesce(F.sum("heads").over(earlier), F.lit(0)).alias("before"), F.sum("heads").over(whole).alias("found")), "blocks")
    rows = pieces.join(F.broadcast(blocks) if blocks.count() <= BROADCAST_SPLITS else blocks, ["file", "block"])
    return rows.select("file", "block", "seq", "whole", "text", (F.col("before") + F.col("upto")).cast("int").alias("chapter"), "found")


def slice_files(spark: SparkSession, path: str, n: int | None = None, header: str = HEADER, files: str = "*") -> DataFrame:
    """(slug, chapter, text) of the novels below path. n keeps the first n chapters, and drops novels with fewer. Only chapters at the ends of splits and batches are shuffled."""
    rows = placed_pieces(read_lines(spark, path, files), header).where("chapter > 0")
    if n is not None:
        rows = rows.where((F.col("found") >= n) & (F.col("chapter") <= n))
    parts = rows.where("not whole").groupBy("file", "chapter").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("parts"))
    rows = rows.where("whole").select("file", "chapter", "text").unionByName(parts.select("file", "chapter", F.array_join("parts.text", "\n").alias("text")))
    return rows.select(slug_of(F.col("file")).alias("slug"), "chapter", F.concat(rstrip("text"), F.lit("\n")).alias("text"))


def short_files(spark: SparkSession, path: str, n: int, header: str = HEADER, files: str = "*") -> DataFrame:
    """(slug, found): novels with fewer than n headers, of those with any line."""
    heads = F.col("line").rlike(rf"^(?:{header})")
    found = read_lines(spark, path, files).groupBy("file").agg(F.count_if(heads).alias("found"))
    return found.where(F.col("found") < n).select(slug_of(F.col("file")).alias("slug"), "found")
