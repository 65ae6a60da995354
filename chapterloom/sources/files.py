"""A data source of small named files, one for each row: glossaries, deliverables and reports of books.

    spark.dataSource.register(BookFiles)
    rows.write.format("bookfiles").mode("append").save(root)             # rows (path, content)
    spark.read.format("bookfiles").option("glob", "*/glossary.json").load(root)

Tasks write to a staging folder below the root. Only when all of them have succeeded are the files moved to their places, each by
one rename that replaces what was there; a job that fails leaves all old files as they were. Attempts of a task have folders of
their own, so a lost or speculative one adds nothing. Reading lists the folder once and deals the files out to tasks.

Defined results: a path is relative to the root and stays below it; its parts may hold any character but / and \\0. A row with a null
path or content, or with a path that leaves the root, and two rows with one path, fail the job. Modes: append writes over files of
the same paths, and leaves others alone; overwrite isn't offered, as no other file is ours to delete.
"""

from __future__ import annotations

import fnmatch
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from chapterloom.sources.books import GLOSSARY_FILE, validate_terms

SCHEMA = "path string, content string"
_STAGING = "_staging-"
#: Files that a reading task gets, and bytes of them, at most (a larger file has a task of its own).
FILES_A_TASK = 500
BYTES_A_TASK = 32_000_000
#: Bytes of files that go to Spark as one batch, at most (or one file).
BYTES_A_BATCH = 2_000_000


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or an absolute path, and the path in it."""
    if root.startswith("file:///"):
        return fs.LocalFileSystem(), root[7:]
    return (fs.LocalFileSystem(), root) if root.startswith("/") else fs.FileSystem.from_uri(root)


@dataclass
class Staged(WriterCommitMessage):
    """Where a task's files are, and where they belong."""

    files: list[tuple[str, str]]


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root, self.staging = root, f"{_STAGING}{uuid.uuid4().hex}"
        system, path = _opened(root)
        system.create_dir(f"{path}/{self.staging}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, root = _opened(self.root)
        folder, done = f"{root}/{self.staging}/{uuid.uuid4().hex}", []
        system.create_dir(folder, recursive=False)  # a task that is late, after the job was given up, finds no staging folder
        rows = (row for batch in iterator for row in zip(batch.column("path"), batch.column("content")))
        for k, (name, content) in enumerate(rows):
            path = name.as_py()
            if path is None or not content.is_valid:
                raise ValueError("a file needs a path and a content")
            parts = path.split("/")
            if not all(parts) or "." in parts or ".." in parts or parts[0].startswith(_STAGING):
                raise ValueError(f"not a path below the root: {path!r}")
            with system.open_output_stream(f"{folder}/{k}") as out:
                out.write(content.as_buffer())  # UTF-8 as it is in the batch
            done.append((f"{folder}/{k}", path))
        return Staged(done)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root = _opened(self.root)
        files = [f for m in messages if m is not None for f in m.files]
        if len({path for _, path in files}) < len(files):
            self.abort(messages)
            raise ValueError("two rows have one path")
        for folder in sorted({posixpath.dirname(f"{root}/{path}") for _, path in files}):
            system.create_dir(folder)
        for staged, path in files:
            system.move(staged, f"{root}/{path}")
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        system, root = _opened(self.root)
        if system.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.staging}")


@dataclass
class Files(InputPartition):
    names: list[str]


class _Reader(DataSourceReader):
    def __init__(self, root: str, glob: str):
        self.root, self.glob = root, glob

    def partitions(self) -> list[Files]:
        system, root = _opened(self.root)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        sizes = {i.path[len(root.rstrip("/")) + 1 :]: i.size or 0 for i in found if i.type == fs.FileType.File}
        depth, tasks, held = self.glob.count("/"), [], 0
        for n in sorted(sizes):
            if n.startswith(_STAGING) or n.count("/") != depth or not all(map(fnmatch.fnmatchcase, n.split("/"), self.glob.split("/"))):
                continue
            if not tasks or len(tasks[-1].names) == FILES_A_TASK or held + sizes[n] > BYTES_A_TASK:
                tasks.append(Files([]))
                held = 0
            tasks[-1].names.append(n)
            held += sizes[n]
        return tasks or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, root = _opened(self.root)
        names, texts, held = [], [], 0
        for name in partition.names:
            with system.open_input_stream(f"{root}/{name}") as source:
                data = source.read()
            if held and held + len(data) > BYTES_A_BATCH:
                yield _batch(names, texts)
                names, texts, held = [], [], 0
            names.append(name)
            texts.append(data.decode("utf-8", "replace"))
            held += len(data)
        if names:
            yield _batch(names, texts)


def _batch(names: list[str], texts: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["path", "content"])


class BookFiles(DataSource):
    """Options: path (the root), and for reading glob, of paths below it; * stands for part of one name."""

    @classmethod
    def name(cls) -> str:
        return "bookfiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("glob", "*/*"))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("bookfiles are written in append mode")
        return _Writer(self.options["path"])


def write_files(rows: DataFrame, root: str) -> None:
    """rows (path, content)."""
    rows.sparkSession.dataSource.register(BookFiles)
    rows.select("path", "content").write.format("bookfiles").mode("append").save(root)


def read_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, content) of the files whose path below the root fits the glob."""
    spark.dataSource.register(BookFiles)
    return spark.read.format("bookfiles").option("glob", glob).load(root)


def _book(c: Column | str = "slug") -> Column:
    """A book's folder: its name, with what no path can hold as %XX."""
    return F.replace(F.url_encode(c), F.lit("."), F.lit("%2E"))


def _named(path: Column, part: int = 0) -> Column:
    return F.url_decode(F.split(path, "/")[part])


def replace_glossaries(glossary: DataFrame, root: str) -> None:
    """<slug>/glossary.json: the book's list of terms in the order of their ids, in place of the one before."""
    terms = F.array_sort(F.collect_list(F.struct("token_id", "korean", "english", "category", "note", "enforce")))
    bare = F.transform(terms, lambda x: F.struct(*[x[c].alias(c) for c in ("korean", "english", "category", "note", "enforce")]))
    write_files(glossary.groupBy("slug").agg(bare.alias("t")).select(F.concat(_book(), F.lit("/glossary.json")).alias("path"), F.to_json("t").alias("content")), root)


def current_glossaries(spark: SparkSession, root: str) -> DataFrame:
    """(slug, token_id, korean, english, category, note, enforce, reason); a faulty file is a row with the reason."""
    rows = read_files(spark, root, "*/glossary.json").select(_named(F.col("path")).alias("slug"), F.from_json("content", GLOSSARY_FILE).alias("v"))
    terms = rows.where("v is not null").select("slug", F.posexplode("v").alias("p", "t"))
    found = terms.select("slug", (F.col("p") + 1).alias("token_id"), "t.korean", "t.english", "t.category", F.coalesce("t.note", F.lit("")).alias("note"), F.coalesce("t.enforce", F.lit(True)).alias("enforce"))
    return validate_terms(found).unionByName(rows.where("v is null").select("slug", F.lit("no list of terms").alias("reason")), allowMissingColumns=True)


def write_deliverables(books: DataFrame, root: str) -> None:
    """deliverable()'s rows as <slug>/ch001-NNN_EN.txt, _EN_INCOMPLETE.txt where a chapter is withheld."""
    stem = F.format_string("/ch001-%03d_EN", "chapters")
    write_files(books.select(F.concat(_book(), stem, F.when(F.col("incomplete"), "_INCOMPLETE").otherwise(""), F.lit(".txt")).alias("path"), F.col("text").alias("content")), root)


def read_deliverables(spark: SparkSession, root: str) -> DataFrame:
    """(slug, incomplete, text)."""
    rows = read_files(spark, root, "*/ch001-*_EN*.txt")
    return rows.select(_named(F.col("path")).alias("slug"), F.col("path").endswith("_EN_INCOMPLETE.txt").alias("incomplete"), F.col("content").alias("text"))


def write_reports(reports: DataFrame, chapters: DataFrame, root: str) -> None:
    """<slug>/_report.json: a row of run_report(), with its chapters' rows of chapter_report() under per_chapter."""
    own = [c for c in chapters.columns if c != "slug"]
    each = chapters.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("chapter", F.struct(*own).alias("row")))).alias("c")).select("slug", F.transform("c", lambda x: x["row"]).alias("per_chapter"))
    rows = reports.join(each, "slug", "left")
    write_files(rows.select(F.concat(_book(), F.lit("/_report.json")).alias("path"), F.to_json(F.struct(*rows.columns)).alias("content")), root)


def read_reports(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The reports' fields by a schema."""
    return read_files(spark, root, "*/_report.json").select(F.from_json("content", schema).alias("v")).select("v.*")
