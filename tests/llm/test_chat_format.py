from chapterloom.llm import chat_format as C


def test_snapshots_collapse(spark):
    a, b, c = ("user", "hi"), ("assistant", "hello"), ("user", "bye <|im_end|>")
    convs = {1: [a], 2: [a, b], 3: [a, b, c], 4: [a, b, c], 5: [b], 6: [a, c], 7: [("system", None), a], 8: [a, b]}
    rows = [(k, t, role, text, "x") for k, turns in convs.items() for t, (role, text) in enumerate(turns)]
    rows += [(3, 0, "user", "hi", "x"), (None, 0, "user", "lost", "x"), (9, None, None, "first", "x"), (9, 5, "user", "then", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string")
    got = {r.conv_id: r.text for r in C.formatted(df).collect()}
    assert set(got) == {3, 5, 6, 7, 9}
    assert got[3] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user\nbye < |im_end|><|im_end|>\n"
    assert got[9].startswith("<|im_start|>unknown\nfirst<|im_end|>\n")
    assert C.formatted(df.limit(0)).count() == 0


def test_long_conversation_in_segments(spark):
    n = 2500
    rows = [(1, t, "user", f"t{t}") for t in range(n)] + [(2, t, "user", f"t{t}") for t in range(1500)] + [(3, t * 3, "user", f"t{t}") for t in range(1100)]
    out = C.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).sort("segment").collect()
    assert [(r.conv_id, r.segment, r.n_turns) for r in out] == [(1, 0, 1024), (1, 1, 1024), (1, 2, 452)]
    assert "".join(r.text for r in out) == "".join(f"<|im_start|>user\nt{t}<|im_end|>\n" for t in range(n))


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = C.formatted(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
