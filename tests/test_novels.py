import random

from chapterloom.sources import books, novels


def test_rows_for_any_split(spark, tmp_path):
    random.seed(4)
    pieces = ["1화 시작", "12화", "7화살", "가나다", "", "  끝 ", "3화\t제목", "x 9화 뒤", "y\x0b10화\x0cz", "화", "9 화"]
    texts = {f"n {k}": "".join(random.choice(pieces) + random.choice(["\n", "\n", "\r\n", "\n\n"]) for _ in range(k * 40)) for k in range(1, 6)}
    texts |= {"first": "1화\n가", "none": "a\nb\n", "empty": "", "last": "a\n2화", "long": "1화 " + "가" * 5000 + "\n2화\n" + "나 " * 3000}
    (tmp_path / "in").mkdir()
    for name, text in texts.items():
        (tmp_path / "in" / f"{name}.txt").write_bytes(text.encode())
    frame = spark.createDataFrame(list(texts.items()), "slug string, text string")
    want = {n: sorted(map(tuple, books.slice_chapters(frame, n).collect())) for n in (None, 30)}
    short = sorted(map(tuple, books.short_novels(frame.where("text <> ''"), 30).collect()))
    assert len(want[None]) > 150 and 0 < len({r[0] for r in want[30]}) < 5
    try:
        for split in ("128m", "200b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            spark.conf.set("spark.sql.files.openCostInBytes", "0b" if split != "128m" else "4m")
            for n, rows in want.items():
                assert sorted(map(tuple, novels.slice_files(spark, f"{tmp_path}/in", n).collect())) == rows, (split, n)
            assert sorted(map(tuple, novels.short_files(spark, f"{tmp_path}/in", 30).collect())) == short
        assert novels.read_lines(spark, f"{tmp_path}/in").select("file", "block").distinct().count() > 30
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")


def test_one_chapter_over_many_splits(spark, tmp_path):
    (tmp_path / "big.txt").write_text("front\n1화\n" + "가나다라\n" * 20_000 + "2화\nend\n")
    rows = novels.slice_files(spark, str(tmp_path)).collect()
    assert {(r.slug, r.chapter, len(r.text)) for r in rows} == {("big", 1, 3 + 5 * 20_000), ("big", 2, 7)}


def test_whole_chapters_are_not_shuffled(spark, tmp_path):
    (tmp_path / "in").mkdir()
    texts = {f"n{k}": "front\n" + "".join(f"{c}화\n가나 {c}\n\n다\n" for c in range(k * 9)) for k in range(4)} | {"x": "no header\n"}
    for name, text in texts.items():
        (tmp_path / "in" / f"{name}.txt").write_text(text)
    want = sorted(map(tuple, books.slice_chapters(spark.createDataFrame(list(texts.items()), "slug string, text string")).collect()))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    try:
        for size in ("1", "3", "10000"):
            spark.conf.set(batch, size)
            rows = novels.slice_files(spark, f"{tmp_path}/in")
            assert sorted(map(tuple, rows.collect())) == want and len(want) == 54, size
    finally:
        spark.conf.set(batch, before)
    plan = novels.slice_files(spark, f"{tmp_path}/in")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Window" not in plan and "NOT whole#" in plan
