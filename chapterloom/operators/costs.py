"""Costs of calls and comparisons of experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CACHE_READ, CACHE_WRITE, BATCH = 0.1, 1.25, 0.5

#: model, dollars for a million input tokens, dollars for a million output tokens. A parameter; these are examples.
PRICES = [("large", 5.0, 25.0), ("medium", 3.0, 15.0), ("small", 1.0, 5.0)]


def pricing(spark: SparkSession, prices: list[tuple[str, float, float]] = PRICES) -> DataFrame:
    return spark.createDataFrame(prices, "model string, input_price double, output_price double")


def call_cost(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Adds cost_usd. Calls of a model without a price are left out; see unpriced_calls.

    Prices are a row a model and go to every task; a join by model would leave all calls of one model to one task.
    """
    inputs = F.col("input_tokens") + CACHE_READ * F.col("cache_read_tokens") + CACHE_WRITE * F.col("cache_write_tokens")
    cost = inputs * F.col("input_price") / 1e6 + F.col("output_tokens") * F.col("output_price") / 1e6
    return calls.join(F.broadcast(prices), "model").withColumn("cost_usd", cost * F.when(F.col("batch"), BATCH).otherwise(1.0)).drop("input_price", "output_price")


def unpriced_calls(calls: DataFrame, prices: DataFrame) -> DataFrame:
    return calls.join(F.broadcast(prices), "model", "left_anti")


def cost_rollup(costed: DataFrame, keys: list[str] = ["tag", "model", "batch"]) -> DataFrame:
    """Calls and cost by every combination of the keys; a key that is summed over is null."""
    return costed.cube(*keys).agg(F.count(F.lit(1)).alias("calls"), F.sum("cost_usd").alias("cost_usd"))


def cost_windows(costed: DataFrame, every: str = "1 day") -> DataFrame:
    """(start, tag, model, calls, hits, cost_usd) by windows of the calls' time ts; hits: calls that read from the cache. Calls without a time have none. Also for streams."""
    rows = costed.where("ts is not null").groupBy(F.window("ts", every).alias("w"), "tag", "model")
    sums = rows.agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("cache_read_tokens") > 0).alias("hits"), F.sum("cost_usd").alias("cost_usd"))
    return sums.select(F.col("w.start").alias("start"), "tag", "model", "calls", "hits", "cost_usd")


def parse_failure_rate(calls: DataFrame, by: str = "variant") -> DataFrame:
    return calls.groupBy(by).agg(F.count(F.lit(1)).alias("runs"), F.count_if(~F.col("parse_ok")).alias("failures")).withColumn("rate", F.col("failures") / F.col("runs"))


def variant_compare(costed: DataFrame, variants: tuple[str, ...] = ("combined", "split")) -> DataFrame:
    """A row for each tag with calls, parsed ones, terms and cost of each variant side by side."""
    sums = costed.groupBy("tag").pivot("variant", list(variants)).agg(F.count(F.lit(1)).alias("calls"), F.count_if("parse_ok").alias("ok"), F.sum("terms").alias("terms"), F.sum("cost_usd").alias("cost"))
    return sums.na.fill(0)


def cache_hits(calls: DataFrame, order: list[str] = ["chapter", "seq"]) -> DataFrame:
    """(slug, later, hits, rate): of a run's calls after its first, those that read from the cache.

    The first call is found by a minimum, not by numbering a run's calls.
    """
    firsts = calls.groupBy("slug").agg(F.min_by("cache_read_tokens", F.struct(*order, "cache_read_tokens")).alias("first"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("cache_read_tokens") > 0).alias("hits"))
    hits = F.col("hits") - (F.col("first") > 0).cast("int")
    rows = firsts.select("slug", (F.col("n") - 1).alias("later"), hits.alias("hits"))
    return rows.withColumn("rate", F.when(F.col("later") > 0, F.col("hits") / F.col("later")).otherwise(0.0))


def retry_resolution(attempts: DataFrame, most: int = 2) -> DataFrame:
    """(slug, chapter, attempts, used, last_cost, logged_cost) from (slug, chapter, attempt, parse_ok, cost_usd).

    The first of ``most`` attempts that parses is used; the result carries the last attempt's cost, the log all of them.
    Attempts of one number are ordered by parse_ok, then cost.
    """
    rows = attempts.withColumn("k", F.row_number().over(Window.partitionBy("slug", "chapter").orderBy("attempt", F.col("parse_ok").desc(), "cost_usd"))).where(F.col("k") <= most)
    good = rows.groupBy("slug", "chapter").agg(F.min(F.when(F.col("parse_ok"), F.col("k"))).alias("used"))
    rows = rows.join(good, ["slug", "chapter"]).where(F.col("used").isNull() | (F.col("k") <= F.col("used")))
    return rows.groupBy("slug", "chapter").agg(F.count(F.lit(1)).alias("attempts"), F.first("used").alias("used"), F.max_by("cost_usd", "k").alias("last_cost"), F.sum("cost_usd").alias("logged_cost"))


def judge_pairs(translations: DataFrame, models: list[str]) -> DataFrame:
    """(chapter, pair, a, b, text_a, text_b): every two models that translated a chapter.

    translations: (chapter, chapter_index, model, text). A and B change places where chapter and pair number sum to an
    odd number; pairs are numbered among all models, whether they translated or not.
    """
    rank = F.array_position(F.array(*map(F.lit, models)), F.col("model")) - 1
    rows = translations.withColumn("rank", rank).where("rank >= 0")
    one = rows.select("chapter", "chapter_index", F.col("model").alias("m1"), F.col("rank").alias("r1"), F.col("text").alias("t1"))
    two = rows.select("chapter", F.col("model").alias("m2"), F.col("rank").alias("r2"), F.col("text").alias("t2"))
    n = len(models)
    pair = (F.col("r1") * (2 * n - F.col("r1") - 1) / 2).cast("long") + F.col("r2") - F.col("r1") - 1
    both = one.join(two, "chapter").where("r1 < r2").withColumn("pair", pair)
    swap = (F.col("chapter_index") + F.col("pair")) % 2 == 1
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return both.select("chapter", "pair", pick("m1", "m2").alias("a"), pick("m2", "m1").alias("b"), pick("t1", "t2").alias("text_a"), pick("t2", "t1").alias("text_b"))


def judge_winner(verdicts: DataFrame) -> DataFrame:
    """Adds winner to (…, a, b, overall): a model, tie, or judge_parse_error."""
    return verdicts.withColumn("winner", F.when(F.col("overall").isNull(), "judge_parse_error").when(F.col("overall") == "tie", "tie").when(F.col("overall") == "A", F.col("a")).otherwise(F.col("b")))


def judge_tally(verdicts: DataFrame) -> DataFrame:
    return judge_winner(verdicts).groupBy("winner").agg(F.count(F.lit(1)).alias("times"))


def judge_by_model(verdicts: DataFrame) -> DataFrame:
    """(model, judged, wins, ties, unparsed): how each model fared in the pairs it was part of."""
    rows = judge_winner(verdicts).select(F.explode(F.array("a", "b")).alias("model"), "winner")
    return rows.groupBy("model").agg(
        F.count(F.lit(1)).alias("judged"),
        F.count_if(F.col("winner") == F.col("model")).alias("wins"),
        F.count_if(F.col("winner") == "tie").alias("ties"),
        F.count_if(F.col("winner") == "judge_parse_error").alias("unparsed"),
    )


def cost_projection(costed: DataFrame, chapters: int = 1_000_000, by: list[str] = ["model", "batch"]) -> DataFrame:
    """Mean cost of a chapter in each scenario, and of a corpus of so many."""
    per = costed.groupBy(*by, "chapter").agg(F.sum("cost_usd").alias("c")).groupBy(*by).agg(F.avg("c").alias("per_chapter"))
    return per.withColumn("corpus", F.col("per_chapter") * chapters)
