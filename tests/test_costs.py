from pyspark.sql import functions as F

from chapterloom.operators import costs
from chapterloom.sources import books


def test_calls_of_one_model_stay_spread(spark):
    calls = spark.range(0, 800, 1, 8).select(
        F.lit("large").alias("model"), F.lit(False).alias("batch"), F.lit(1_000_000).alias("input_tokens"), F.lit(0).alias("output_tokens"), F.lit(0).alias("cache_read_tokens"), F.lit(0).alias("cache_write_tokens"), F.spark_partition_id().alias("at")
    )
    for rows, n in ((costs.call_cost(calls, costs.pricing(spark)), 800), (costs.unpriced_calls(calls, costs.pricing(spark, [("small", 1.0, 5.0)])), 800)):
        # Neither the calls nor their costs are dealt out by the model.
        assert "hashpartitioning(model" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.where(F.spark_partition_id() == F.col("at")).count() == n
    assert costs.call_cost(calls, costs.pricing(spark)).agg(F.sum("cost_usd")).first()[0] == 4000.0


def test_log_is_small_and_reads_again(spark, tmp_path):
    calls = spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 2 == 0, "mine").otherwise("judge").alias("tag"), F.lit("large").alias("model"), F.col("id").alias("chapter"), F.lit(100).alias("input_tokens"), (F.col("id") / 1e7).alias("cost_usd"), F.timestamp_seconds("id").alias("ts")
    )
    books.append_log(calls.where("chapter < 15000"), str(tmp_path))
    books.append_log(calls.where("chapter >= 15000"), str(tmp_path))
    found = spark.read.schema("model string, chapter long, input_tokens long, cost_usd double, ts string, tag string").json(str(tmp_path))
    assert found.exceptAll(books.call_log(calls).select(found.columns)).count() == 0 and found.count() == 20_000
    plain = found.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert sum(f.stat().st_size for f in tmp_path.rglob("part-*")) < plain / 4
