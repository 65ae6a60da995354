"""Reading and writing books: chapters, glossaries, summaries, results, logs, deliverables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chapterloom.functions.text import CATEGORIES, lines, rstrip, strip

HEADER = r"\d+화(\s|$)"
WITHHELD = "[chapter withheld: needs a human]"

GLOSSARY_FILE = "array<struct<korean:string,english:string,category:string,note:string,enforce:boolean>>"
SUMMARY_FILE = "arc_summary string, chapter_summaries array<struct<chapter:string,summary:string>>"


def read_novels(spark: SparkSession, path: str) -> DataFrame:
    """(slug, text): one whole source file a row; the slug is the file's stem."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return files.select(F.regexp_replace("file", r"\.[^.]*$", "").alias("slug"), "text")


def slice_chapters(novels: DataFrame, n: int | None = None, header: str = HEADER) -> DataFrame:
    """(slug, chapter, text): cuts at lines that match the header and numbers chapters by order; text before the first header goes.

    n keeps the first n chapters, and drops books with fewer (see short_novels).
    """
    text = F.array_join(lines("text"), "\n")
    parts = F.split(text, rf"(?m)^(?={header})", -1)
    bodies = F.filter(parts, lambda p: p.rlike(rf"\A(?:{header})"))
    rows = novels.select("slug", bodies.alias("bodies"))
    if n is not None:
        rows = rows.where(F.size("bodies") >= n).withColumn("bodies", F.slice("bodies", 1, n))
    return rows.select("slug", F.posexplode_outer("bodies").alias("p", "body")).where("p is not null").select("slug", (F.col("p") + 1).alias("chapter"), F.concat(rstrip("body"), F.lit("\n")).alias("text"))


def short_novels(novels: DataFrame, n: int, header: str = HEADER) -> DataFrame:
    """(slug, found): books with fewer than n headers."""
    found = F.regexp_count(F.array_join(lines("text"), "\n"), F.lit(f"(?m)^(?={header})"))
    return novels.select("slug", found.alias("found")).where(F.col("found") < n)


def read_chapters(spark: SparkSession, path: str) -> DataFrame:
    """(slug, chapter, text) from files slug/chNNN.txt."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return files.select(F.regexp_extract("file", r"([^/]+)/ch\d+\.txt$", 1).alias("slug"), F.regexp_extract("file", r"ch(\d+)\.txt$", 1).cast("int").alias("chapter"), "text")


def validate_chapters(chapters: DataFrame) -> DataFrame:
    """Adds status: ok, or blank for a chapter without text."""
    return chapters.withColumn("status", F.when(F.length(strip(F.coalesce("text", F.lit("")))) > 0, "ok").otherwise("blank"))


def validate_terms(terms: DataFrame) -> DataFrame:
    """Adds reason: null for a valid term, or what is wrong with it."""
    blank = lambda c: F.length(strip(F.coalesce(c, F.lit("")))) == 0
    return terms.withColumn("reason", F.when(blank("korean"), "blank korean").when(blank("english"), "blank english").when(~F.coalesce(F.col("category").isin(CATEGORIES), F.lit(False)), "unknown category"))


def folder_of(file: Column) -> Column:
    """The folder that a file lies in, which names its book; decoded, and without Spark's ``slug=``."""
    decoded = lambda c: F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    folder = decoded(F.regexp_extract(file, r"([^/]+)/[^/]+$", 1))
    return F.when(folder.startswith("slug="), decoded(F.substring(folder, F.lit(6), F.length(folder)))).otherwise(folder)


def read_json_files(spark: SparkSession, path: str, schema: str, files: str = "*") -> DataFrame:
    """(slug, v): one JSON file a book, in a folder of the book's name below path; v is null for a file that doesn't fit the schema."""
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=files)
    return rows.select(folder_of(F.col("_metadata.file_path")).alias("slug"), F.from_json("value", schema).alias("v"))


def write_json_files(rows: DataFrame, path: str) -> None:
    """rows (slug, v): one JSON file a book, in the folder slug=<book>."""
    rows.select("slug", F.to_json("v").alias("value")).repartition("slug").write.partitionBy("slug").text(path)


def write_glossary(glossary: DataFrame, path: str) -> None:
    """A list of terms a book, in the order of their ids."""
    terms = F.array_sort(F.collect_list(F.struct("token_id", "korean", "english", "category", "note", "enforce")))
    bare = F.transform("t", lambda x: F.struct(*[x[c].alias(c) for c in ("korean", "english", "category", "note", "enforce")]))
    write_json_files(glossary.groupBy("slug").agg(terms.alias("t")).select("slug", bare.alias("v")), path)


def read_glossary(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """(slug, token_id, korean, english, category, note, enforce, reason) from files <slug>/<file> with a list of terms each.

    An absent note is empty, an absent enforce true. A file that holds no such list is a row of its own with the reason.
    """
    rows = read_json_files(spark, path, GLOSSARY_FILE, files)
    terms = rows.where("v is not null").select("slug", F.posexplode("v").alias("p", "t"))
    found = terms.select("slug", (F.col("p") + 1).alias("token_id"), "t.korean", "t.english", "t.category", F.coalesce("t.note", F.lit("")).alias("note"), F.coalesce("t.enforce", F.lit(True)).alias("enforce"))
    bad = rows.where("v is null").select("slug", F.lit("no list of terms").alias("reason"))
    return validate_terms(found).unionByName(bad, allowMissingColumns=True)


def write_summaries(summaries: DataFrame, path: str, arcs: DataFrame | None = None) -> None:
    """An object a book: arc_summary and chapter_summaries."""
    rows = summaries.where("summary is not null").groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("chapter", "summary"))).alias("chapter_summaries"))
    rows = rows.withColumn("arc_summary", F.lit("")) if arcs is None else rows.join(arcs, "slug", "left")
    write_json_files(rows.select("slug", F.struct("arc_summary", "chapter_summaries").alias("v")), path)


def read_context(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """(slug, arc_summary, chapter, summary) from files <slug>/<file> with one object each; a chapter that is no number is null, and so is all of a faulty file."""
    rows = read_json_files(spark, path, SUMMARY_FILE, files)
    return rows.select("slug", F.coalesce("v.arc_summary", F.lit("")).alias("arc_summary"), F.explode_outer("v.chapter_summaries").alias("s")).select("slug", "arc_summary", F.col("s.chapter").try_cast("int").alias("chapter"), "s.summary")


def write_token_map(glossary: DataFrame, path: str) -> None:
    """An object a book: id to rendering."""
    write_json_files(token_map(glossary).select("slug", F.col("ids").alias("v")), path)


def read_token_map(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """(slug, ids) from files <slug>/<file> with an object each; ids that are no number are left out."""
    rows = read_json_files(spark, path, "map<string,string>", files)
    numbered = F.map_filter("v", lambda k, _: k.try_cast("int").isNotNull())
    return rows.select("slug", F.transform_keys(numbered, lambda k, _: k.try_cast("int")).alias("ids"))


DEFECT_FILE = "map<string,struct<forget:array<string>,invalid:array<string>,new:array<array<string>>>>"


def write_defects(defects: DataFrame, path: str) -> None:
    """An object a book: chNNN to what its chapter lacks, from a defect table."""
    one = F.struct(
        F.transform("forgotten", lambda t: t["korean"]).alias("forget"),
        "invalid",
        F.transform("new", lambda e: F.array(e["korean"], e["english"])).alias("new"),
    )
    rows = defects.select("slug", F.struct("chapter", one.alias("d")).alias("c")).groupBy("slug").agg(F.array_sort(F.collect_list("c")).alias("c"))
    write_json_files(rows.select("slug", F.map_from_entries(F.transform("c", lambda x: F.struct(F.format_string("ch%03d", x["chapter"]), x["d"]))).alias("v")), path)


def read_defects(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """(slug, chapter, forget, invalid, new) from files <slug>/<file> with an object each."""
    rows = read_json_files(spark, path, DEFECT_FILE, files).select("slug", F.explode("v").alias("name", "d"))
    return rows.select("slug", F.regexp_extract("name", r"(\d+)$", 1).try_cast("int").alias("chapter"), "d.forget", "d.invalid", "d.new")


def token_map(glossary: DataFrame) -> DataFrame:
    """(slug, ids): MAP of every position to its rendering."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("token_id").cast("int").alias("k"), F.col("english").alias("v"))))
    return glossary.groupBy("slug").agg(F.map_from_entries(pairs).alias("ids"))


def ingest_results(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Each request with its result's text; status ok, error or missing. One that failed leaves the others alone."""
    joined = requests.join(results.select("slug", "chapter", "raw", "failed"), ["slug", "chapter"], "left")
    return joined.withColumn("status", F.when(F.col("failed").isNull(), "missing").when(F.col("failed") | F.col("raw").isNull(), "error").otherwise("ok"))


def call_log(calls: DataFrame) -> DataFrame:
    """Log records: cost rounded to 6 places, and ts, if there is one, in seconds. All other columns go along."""
    rows = calls.withColumn("cost_usd", F.round("cost_usd", 6))
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")) if "ts" in calls.columns else rows


def append_records(records: DataFrame, path: str) -> None:
    """Records as gzipped JSON lines in folders of their tags; a log repeats its field names in every record."""
    records.write.mode("append").partitionBy("tag").option("compression", "gzip").json(path)


def append_log(calls: DataFrame, path: str) -> None:
    append_records(call_log(calls), path)


def deliverable(gated: DataFrame) -> DataFrame:
    """(name, text) of each book: per chapter its first source line, a blank line, the stripped body and a line's end; two blank lines between chapters.

    gated: (slug, chapter, source, body, withheld), and leaks if a withheld chapter's marker is to name them.
    """
    if "leaks" in gated.columns:
        marker = F.concat(F.lit("[chapter "), F.col("chapter").cast("string"), F.lit(" withheld, a human has to see it: "), F.array_join("leaks", ", "), F.lit("]"))
    else:
        marker = F.lit(WITHHELD)
    head = F.element_at(F.concat(lines("source"), F.array(F.lit(""))), 1)
    part = F.concat(head, F.lit("\n\n"), F.when(F.col("withheld"), marker).otherwise(strip("body")), F.lit("\n"))
    rows = gated.select("slug", "withheld", F.struct("chapter", part.alias("part")).alias("p"))
    books = rows.groupBy("slug").agg(F.array_sort(F.collect_list("p")).alias("parts"), F.max("withheld").alias("some"))
    return books.select(F.concat("slug", F.when(F.col("some"), "_INCOMPLETE").otherwise("")).alias("name"), F.array_join("parts.part", "\n\n\n").alias("text"), "slug", F.size("parts").alias("chapters"), F.col("some").alias("incomplete"))


def review_outputs(spark: SparkSession, path: str) -> DataFrame:
    """Outputs saved by (experiment, variant), read again; blank ones are dropped."""
    return spark.read.parquet(path).where(F.length(strip("text")) > 0)


def save_outputs(outputs: DataFrame, path: str) -> None:
    outputs.write.mode("append").partitionBy("experiment", "variant").parquet(path)

