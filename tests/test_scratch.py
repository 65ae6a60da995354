import os

from chapterloom.sources.scratch import discard, store, store_alone


def _there(table):
    return os.path.exists(table._stored_at.removeprefix("file://").removeprefix("file:"))


def test_a_stage_leaves_its_result_alone(spark):
    before, made = store(spark.range(5), "before"), []

    def stage():
        made.append(store(before.where("id > 1"), "inner"))
        return made[0].where("id > 2")

    kept = store_alone(spark, stage, "kept")
    assert _there(before) and _there(kept) and not _there(made[0])
    discard(before)
    assert not _there(before) and sorted(r.id for r in kept.collect()) == [3, 4]
    empty = store_alone(spark, lambda: spark.range(0), "empty")
    assert empty.count() == 0 and _there(kept)
