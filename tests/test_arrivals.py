import os

from chapterloom.plans import queries as Q
from chapterloom.sources.scratch import store as store
from chapterloom.streaming import incremental, loop

DATA = "/root/testdata/sf0.001"


def test_arrivals_are_written_by_many_tasks(spark, monkeypatch):
    paths, there = {}, Q.new_path
    monkeypatch.setattr(Q, "new_path", lambda s, name: paths.setdefault(name, there(s, name)))
    monkeypatch.setattr(Q, "store", lambda df, name: store(df.repartition(6), name))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    for k in before:
        spark.conf.set(k, "100k")  # tables of this size are read by several tasks
    try:
        Q._grown(spark, DATA)
        replies = Q.D.replies(spark, DATA)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [f for f in os.listdir(paths["arrivals"].removeprefix("file://")) if f.startswith("part-")]
    assert len(files) > 4
    arrived = spark.read.schema(incremental.REPLIES).parquet(paths["arrivals"])
    assert arrived.exceptAll(replies.select(arrived.columns)).count() == 0 and arrived.count() == replies.count()


def test_one_batch_takes_all_files(spark, tmp_path):
    rows = [("b", c, 0, "reply", "no") for c in range(1, 9)]
    spark.createDataFrame(rows, loop.EVENTS).repartition(4).write.parquet(f"{tmp_path}/in")
    query = loop.run_loop(loop.read_events(spark, f"{tmp_path}/in", None), f"{tmp_path}/out", f"{tmp_path}/cp", attempts=1)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [8]
    assert loop.loop_rows(spark, f"{tmp_path}/out", "failed").count() == 5  # then the loop waits for an arc
