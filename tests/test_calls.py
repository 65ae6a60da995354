from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chapterloom.operators import costs
from chapterloom.sources import books
from chapterloom.streaming import calls

T0 = datetime(2024, 5, 1)
SCHEMA = "ts timestamp, call_id string, tag string, model string, cache_read_tokens long, cost_usd double, note string"


def call(i, hours, cost=1.0, tag="t", model="m", hit=0):
    return (T0 + timedelta(hours=hours), i, tag, model, hit, cost, "an extra")


def test_stream_equals_batch_but_for_late_calls(spark, tmp_path):
    batches = [
        [call("a", 1), call("a", 1), call("b", 2, 2.0, hit=5), call("c", 30)],
        [call("b", 2, 2.0, hit=5), call("d", 20, 4.0), call("e", 60, tag="u"), (None, "x", "t", "m", 0, 9.0, ""), (T0, None, "t", "m", 0, 9.0, "")],
        [call("late", 3, 100.0), call("e", 60, tag="u"), call("f", 40, 8.0), call("g", 61, 0.1234567)],
    ]
    for rows in batches:
        books.append_log(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"{tmp_path}/log")
        query = calls.log_costs(calls.read_log(spark, f"{tmp_path}/log"), f"{tmp_path}/out", f"{tmp_path}/cp")
        query.awaitTermination()
    kept = {r[1]: r for b in batches for r in b if r[0] and r[1] and r[1] != "late"}.values()
    whole = costs.cost_windows(spark.createDataFrame(list(kept), SCHEMA).withColumn("cost_usd", F.round("cost_usd", 6)))
    plain = lambda df: sorted((r.start, r.tag, r.model, r.calls, r.hits, round(r.cost_usd, 6)) for r in df.collect())
    assert plain(calls.windows_so_far(spark, f"{tmp_path}/out")) == plain(whole)
    assert len(plain(whole)) == 4  # two days of t, the third of t and of u
    assert [r["ts"] for r in spark.read.json(f"{tmp_path}/log").where("call_id = 'g'").collect()] == ["2024-05-03T13:00:00"]
