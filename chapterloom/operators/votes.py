"""Glossary votes kept up to date: what chapters' terms add is merged into a stored table, and nothing is counted twice.

Below one folder lie three tables, each partitioned by (increment, bucket of books): partial votes, the chapters that were counted, and the
ids that keys got. An increment reads its own rows and, of what is there, only the buckets that its books are in. Running an
increment again writes its own partitions over; its chapters don't count as known to itself.

Defined results: the winners are those of merge_terms() over all counted chapters, whatever the order and the cut of the increments. Ids are
given when a key first comes, in order of its first place within the increment, after the book's last id; they never change, so they
equal merge_terms()'s where increments come in the order of chapters. A chapter that was counted adds nothing later. Rows
without a book or a chapter aren't counted. An increment without new rows adds no id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chapterloom.operators.glossary import TERM, summed_votes, term_votes, winners
from chapterloom.sources.scratch import store

#: Parts that books are dealt out to; an increment reads those that its books are in.
BUCKETS = 64

_FIRST = "struct<at:struct<chapter:int,pos:int>,category:string,note:string,korean:string>"
VOTES = f"slug string, key string, english string, votes long, first {_FIRST}, plain boolean, increment string, bucket int"
CHAPTERS = "slug string, chapter int, increment string, bucket int"
IDS = "slug string, key string, token_id int, increment string, bucket int"


def _bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64("slug"), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
    """A table, empty before the first increment; only some buckets if they are given."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    rows = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
    return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))


def _write(rows: DataFrame, path: str, increment: str) -> None:
    """Writes an increment's rows, in place of those that it wrote before."""
    rows.withColumn("bucket", _bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/increment={increment}")


def add_increment(mined: DataFrame, path: str, increment: str) -> DataFrame:
    """Counts the chapters of mined that no other increment has; gives the winners, with their ids, of the keys that this touches."""
    spark = mined.sparkSession
    rows = store(mined.where("slug is not null and chapter is not null").withColumn("bucket", _bucket()), "mined")
    touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most BUCKETS
    known = _read(spark, f"{path}/chapters", CHAPTERS, touched).where(F.col("increment") != increment)
    new = store(rows.join(known.select("slug", "chapter").distinct(), ["slug", "chapter"], "left_anti"), "new")
    votes = store(term_votes(new), "votes")
    _write(votes, f"{path}/votes", increment)
    _write(new.select("slug", "chapter").distinct(), f"{path}/chapters", increment)
    given = _read(spark, f"{path}/ids", IDS, touched).where(F.col("increment") != increment)
    fresh = votes.groupBy("slug", "key").agg(F.min("first.at").alias("at")).join(given.select("slug", "key"), ["slug", "key"], "left_anti")
    last = given.groupBy("slug").agg(F.max("token_id").alias("last"))
    place = F.row_number().over(Window.partitionBy("slug").orderBy("at"))
    ids = fresh.withColumn("place", place).join(last, "slug", "left").select("slug", "key", (F.coalesce("last", F.lit(0)) + F.col("place")).alias("token_id"))
    _write(store(ids, "ids"), f"{path}/ids", increment)
    return current_terms(spark, path, touched, votes.select("slug", "key").distinct())


def current_terms(spark: SparkSession, path: str, buckets: list[int] | None = None, keys: DataFrame | None = None) -> DataFrame:
    """(slug, token_id, korean, english, category, note, enforce) of what was counted so far, of some buckets and (slug, key) only if they are given."""
    votes, ids = _read(spark, f"{path}/votes", VOTES, buckets), _read(spark, f"{path}/ids", IDS, buckets)
    if keys is not None:
        votes = votes.join(keys, ["slug", "key"], "left_semi")
    return winners(summed_votes(votes)).join(ids.select("slug", "key", "token_id"), ["slug", "key"]).select("slug", "token_id", *TERM)
