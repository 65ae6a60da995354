"""WARC archives: writing pages, and reading records back by boundary-chain verification.

Writing is one text sink whose line separator is the blank lines after a record. Pages
with equal payloads are written once; later ones become revisit records.

Reading: files are split at blank lines before magic, wherever that stands, payloads included. A task tells for each
such place the header's fields and how far its successor is; the offsets in the file are sums of the pieces' sizes.
Pointer jumping from each file's start then doubles the verified stretch of the chain in
every round, and only reachable candidates are records. A record whose payload holds such places is put together from its
pieces after it was verified. For that the files are read again, and pieces are known by their digest, never by their place in a
scan: how files are split may differ from one scan to the next.

Files may be of any size, as tasks share them, or gzipped (one task each).

Defined results: a null html is an empty payload; a null url is written as an empty
target, and control characters or blanks in it as %20. Pages that repeat an id with the
same payload are all responses. A null page_id is a response only if no page with an id has its
payload. A page_id that is no integer comes back as null. A chain that leads to no candidate ends there; a file without a record at its
start, or without content, has none. A payload that ends with its file is what there is of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chapterloom.llm.common import store

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What stands before every record but a file's first, up to the version's last digit; and the part of it that is the record's own.
_SPLIT = "\r\n\r\nWARC/1."
_MAGIC = "WARC/1."
_ID = "urn:chapterloom:page:"

#: Groups of equal payloads up to which they are broadcast.
BROADCAST_GROUPS = 400_000


def base32_of_hex(column: Column) -> Column:
    """Base32 of a SHA-1 in hex: five hex digits are four base32 digits."""
    parts = [F.lpad(F.conv(F.substring(column, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_records(pages: DataFrame, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """(record): the text of each page's WARC record, without the blank lines that end it."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"sha": F.sha1("html"), "size": F.octet_length("html").cast("long")})
    groups = rows.groupBy("sha", "size").agg(F.count(F.lit(1)).alias("times"), F.min("page_id").alias("first")).where("times > 1").drop("times")
    groups = store(groups, "payloads")
    rows = rows.join(F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups, ["sha", "size"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    length = F.when(again, F.lit(len(_HTTP)).cast("long")).otherwise(F.col("size") + len(_HTTP))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("sha"))),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), name("first"))),
        F.when(again, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    )
    return rows.select(F.concat(head, F.lit("\r\n\r\n" + _HTTP), F.when(again, "").otherwise(F.col("html"))).alias("record"))


def write(pages: DataFrame, path: str) -> None:
    """Writes the archives, a file for each partition of pages; nothing but equal payloads' names moves."""
    with_records(pages).write.option("lineSep", "\r\n\r\n").text(path)


def pieces(spark: SparkSession, path: str, files: str) -> DataFrame:
    """(file, block, row, data): what stands between the places where files are split; (block, row) is a piece's order in its file."""
    rows = spark.read.text(path, lineSep=_SPLIT, pathGlobFilter=files, recursiveFileLookup=True)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value").cast("binary").alias("data"))


def _field(head: Column, name: str, value: str = "(.*?)") -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*{value}[ \t]*$", 1), F.lit(""))


def _behind(data: Column, n: Column) -> Column:
    """The bytes after the first n."""
    return F.substring(data, (n + 1).cast("int"), F.octet_length(data))


def _payload(block: Column, is_http: Column) -> Column:
    """A record's block without its HTTP head."""
    head = F.octet_length(F.substring_index(block.cast("string"), "\r\n\r\n", 1))
    return F.when(is_http & (head < F.octet_length(block)), _behind(block, head + 4)).otherwise(block)


def described(found: DataFrame) -> DataFrame:
    """Narrow rows of pieces: size, digest (sha), whether magic stands first, and of what may be a record its fields, its block's length and how much of it the piece holds (own), and the payload's size and digest if that is all."""
    text = F.col("data").cast("string")
    rows = found.withColumns({"size": F.octet_length("data").cast("long"), "marked": F.startswith(text, F.lit(_MAGIC))})
    rows = rows.withColumn("bare", F.when(F.col("marked"), _behind(F.col("data"), F.lit(len(_MAGIC)))).otherwise(F.col("data")))
    rows = rows.withColumn("head", F.substring_index(F.col("bare").cast("string"), "\r\n\r\n", 1))
    rows = rows.withColumns({"head_bytes": F.octet_length("head").cast("long"), "rest": _behind(F.col("bare"), F.octet_length("head") + 4)})
    rows = rows.withColumns({
        "length": F.when(F.col("head").rlike(r"^[01]\r\n") & (F.col("head_bytes") < F.octet_length("bare")), _field(F.col("head"), "content-length", "([0-9]{1,15})").try_cast("long")),
        "own": F.octet_length("rest").cast("long"),
        "is_http": F.startswith(F.coalesce(_field(F.col("head"), "content-type"), F.lit("")), F.lit("application/http")),
    })
    whole = F.when(F.col("length") <= F.col("own"), _payload(F.substring(F.col("rest"), F.lit(1), F.col("length").cast("int")), F.col("is_http")))
    rows = rows.withColumn("payload", whole)
    return rows.select(
        "file",
        "block",
        "row",
        "size",
        "marked",
        "head_bytes",
        "length",
        "own",
        "is_http",
        F.unhex(F.sha1("data")).alias("sha"),
        _field(F.col("head"), "warc-record-id").alias("record_id"),
        _field(F.col("head"), "warc-type").alias("record_type"),
        _field(F.col("head"), "warc-refers-to").alias("refers_to"),
        _field(F.col("head"), "warc-payload-digest").alias("stated_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
    )


def with_offsets(rows: DataFrame) -> DataFrame:
    """Adds to described pieces k (how many stand before in the file) and offset (of a piece's magic), by sums within blocks and over blocks."""
    blocks = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "bytes")])
    within = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumns({"i": F.count(F.lit(1)).over(within), "upto": F.coalesce(F.sum("size").over(within), F.lit(0))})
    joined = own.join(blocks, ["file", "block"]).withColumn("k", F.col("n_before") + F.col("i"))
    offset = F.when(F.col("k") == 0, 0).otherwise(F.col("bytes_before") + F.col("upto") + F.col("k") * len(_SPLIT) - len(_MAGIC))
    return joined.withColumn("offset", offset.cast("long")).drop("i", "upto", "n_before", "bytes_before")


def candidates(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """Stored rows of all pieces: offset, and next, the successor's offset, for what looks like a record (else null), with described()'s columns."""
    rows = with_offsets(store(described(pieces(spark, path, files)), "pieces"))
    record = F.col("length").isNotNull() & (F.col("marked") == (F.col("k") == 0))
    start = F.col("offset") + len(_MAGIC) + F.col("head_bytes") + 4
    return store(rows.withColumns({"start": start, "next": F.when(record, start + F.col("length") + 4)}), "candidates")


def reachable(chain: DataFrame, name: str = "reach") -> DataFrame:
    """(file, offset) of the candidates that the chain from offset 0 reaches, by pointer jumping over (file, offset, next).

    Nothing is broadcast: the rows are as many as records.
    """
    chain = chain.select("file", "offset", "next")
    reached = store(chain.where("offset = 0").select("file", "offset"), name)
    # A candidate whose successor is none ends its chain.
    jump = store(chain.join(chain.select("file", F.col("offset").alias("next")).hint("merge"), ["file", "next"], "left_semi").select("file", "offset", "next"), name)
    while True:
        fresh = reached.join(jump.hint("merge"), ["file", "offset"]).select("file", F.col("next").alias("offset")).join(reached.hint("merge"), ["file", "offset"], "left_anti")
        fresh = store(fresh, name)
        if fresh.isEmpty():
            return reached
        reached = store(reached.union(fresh), name)
        then = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        jump = store(jump.join(then.hint("merge"), ["file", "next"]).select("file", "offset", F.col("far").alias("next")), name)


def put_together(found: DataFrame, records: DataFrame, spark: SparkSession, path: str, files: str) -> DataFrame:
    """(file, offset, payload_bytes, payload_digest) of the records (stored) whose block goes on in later pieces."""
    long = store(records.where("length > own").select("file", "offset", "start", "length", "is_http"), "long")
    if long.isEmpty():
        return long.select("file", "offset", F.lit(None).cast("long").alias("payload_bytes"), F.lit(None).cast("string").alias("payload_digest"))
    # The pieces of a long record are those from its own up to the next record of the chain.
    order = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, 0)
    some = found.select("file", "block", "row", "offset", "size", "sha").join(long.select("file").distinct(), "file", "left_semi")
    own = some.join(records.select("file", "offset", F.col("offset").alias("record")).hint("merge"), ["file", "offset"], "left")
    placed = own.withColumn("record", F.last("record", True).over(order)).where("record is not null")
    placed = placed.join(long.withColumnRenamed("offset", "record"), ["file", "record"]).where("offset = record or offset < start + length")
    parts = store(placed.select("file", "offset", "record", "length", "is_http", "size", "sha", (F.col("start") - F.col("offset")).alias("skip")), "parts")
    # Equal pieces are one: a digest's first bytes are as good as any.
    again = pieces(spark, path, files).select("file", F.octet_length("data").cast("long").alias("size"), "data").join(parts.select("file").distinct(), "file", "left_semi").withColumn("sha", F.unhex(F.sha1("data")))
    again = again.join(parts.select("size", "sha").distinct().hint("merge"), ["size", "sha"], "left_semi").groupBy("size", "sha").agg(F.first("data").alias("data"))
    text = F.col("data").cast("string")
    head = F.col("skip") - F.when(F.startswith(text, F.lit(_MAGIC)), 0).otherwise(len(_MAGIC))
    part = F.when(F.col("offset") == F.col("record"), _behind(F.col("data"), head).cast("string")).otherwise(F.concat(F.lit(_SPLIT), text))
    rows = parts.join(again.hint("merge"), ["size", "sha"]).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("offset", part.alias("part")))).alias("p"), F.first("length").alias("length"), F.first("is_http").alias("is_http"))
    block = F.substring(F.array_join("p.part", "").cast("binary"), F.lit(1), F.col("length").cast("int"))
    rows = rows.withColumn("payload", _payload(block, F.col("is_http")))
    return rows.select("file", F.col("record").alias("offset"), F.octet_length("payload").cast("long").alias("payload_bytes"), base32_of_hex(F.sha1("payload")).alias("payload_digest"))


def read(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """The records of the archives below path (files: a glob of names): those candidates that the boundary chain of their file reaches.

    (file, offset, next, record_id, record_type, refers_to, stated_digest, payload_bytes, payload_digest).
    """
    found = candidates(spark, path, files)
    kept = found.where("next is not null")
    records = store(kept.join(reachable(kept).hint("merge"), ["file", "offset"], "left_semi"), "records")
    rest = put_together(found, records, spark, path, files).select("file", "offset", F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d"))
    names = ["file", "offset", "next", "record_id", "record_type", "refers_to", "stated_digest"]
    return records.join(rest.hint("merge"), ["file", "offset"], "left").select(*names, F.coalesce("n", "payload_bytes").alias("payload_bytes"), F.coalesce("d", "payload_digest").alias("payload_digest"))


def chain_ends(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """(file, bytes, verified_end, beyond, complete): how far the boundary chain of each file that has content goes.

    bytes: of the content, decompressed; verified_end: where the last reachable record ends by its own length, 0 without one; beyond: what
    looks like a record behind that; complete: the chain ends with the file. A wrong Content-Length, junk or a cut shows here.
    """
    found = candidates(spark, path, files)
    kept = found.where("next is not null")
    ends = kept.join(reachable(kept).hint("merge"), ["file", "offset"], "left_semi").groupBy("file").agg(F.max("next").alias("end"))
    rows = found.join(ends.hint("merge"), "file", "left").withColumn("end", F.coalesce("end", F.lit(0).cast("long")))
    rows = rows.groupBy("file", F.col("end").alias("verified_end")).agg(
        (F.sum("size") + (F.count(F.lit(1)) - 1) * len(_SPLIT)).alias("bytes"),
        F.count_if(F.col("next").isNotNull() & (F.col("offset") >= F.col("end"))).alias("beyond"),
    )
    return rows.select("file", "bytes", "verified_end", "beyond", (F.col("verified_end") == F.col("bytes")).alias("complete"))


def page_of(column: str) -> Column:
    return F.regexp_extract(column, f"^<{_ID}([0-9-]+)>$", 1).try_cast("long")


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to); a revisit has its response's payload size and digest."""
    rows = records.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.when(F.col("record_type") == "revisit", page_of("refers_to")).alias("refers_to"), F.regexp_replace("stated_digest", "^sha1:", "").alias("d"))
    first = rows.where("record_type = 'response' and page_id is not null").select(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d"))
    wanted = rows.where("refers_to is not null").select("refers_to").distinct()
    first = first.join(wanted.hint("merge"), "refers_to", "left_semi").groupBy("refers_to", "d").agg(F.first("n").alias("n"))
    return rows.join(first.hint("merge"), ["refers_to", "d"], "left").select("page_id", F.coalesce("n", "payload_bytes").alias("payload_bytes"), F.when(F.col("n").isNotNull(), F.col("d")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to")
