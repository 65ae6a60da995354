from pyspark.sql import functions as F

from chapterloom.functions import text as X


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(column.alias("x")).first().x


def test_strip_lines_section(spark):
    assert one(spark, X.strip("t"), t=" 　\n a b  ") == "a b"
    for t, want in (("", []), ("a\n\nb\n", ["a", "", "b"]), ("\n", [""]), ("a\r\nb", ["a", "b"])):
        assert one(spark, X.lines("t"), t=t) == want
    raw = "x<a> one </a><a>two</a><b></b>"
    assert one(spark, X.section("t", "a"), t=raw) == "one"
    assert one(spark, X.section("t", "b"), t=raw) == ""
    assert one(spark, X.section("t", "c"), t=raw) is None


def test_occurs_at_hangul_boundaries(spark):
    cases = [("민주", "민주화 운동", False), ("민주", "민주는 좋다", True), ("민주", "그 민주, 저", True), ("민주", "비민주", False), ("강", "강도", True), ("민주", "비민주 민주", True), ("a.b", "x a.b y", True), ("a.b", "x acb y", False), (r"q\E(", r"q\E( z", True)]
    df = spark.createDataFrame(cases, "k string, s string, want boolean")
    for r in df.select("k", "s", "want", X.occurs(F.col("k"), F.col("s")).alias("x")).collect():
        assert r.x == r.want, (r.k, r.s)


def test_normalize_key(spark):
    for k, want in (("데스 나이트 (데스나이트)", "데스나이트"), ("검수림（劍樹林）", "검수림"), ("(전부)", "")):
        assert one(spark, X.normalize_key("k"), k=k) == want


def applied(spark, text, ids={1: "Han Li", 2: "see [[G1]]", 4: "Soft"}):
    df = spark.createDataFrame([(text, ids)], "t string, m map<int,string>")
    r = df.select(X.apply_tokens(F.col("t"), F.col("m")).alias("x")).select("x", X.leaked(F.col("x")).alias("l")).first()
    return r.x, r.l


def test_apply_tokens(spark):
    cases = {
        "[[G1]]'s and [[ g 01 ]]": ("Han Li's and Han Li", []),
        "[[[G1]]] [[[[ G4 ]]": ("Han Li Soft", []),
        "[[G2]]": ("see [[G1]]", ["[[G1]]"]),
        "[[G9]] [[G0]]": ("[[G9]] [[G0]]", ["[[G9]]", "[[G0]]"]),
        "[[G99999999999]]": ("[[G99999999999]]", ["[[G99999999999]]"]),
        "[[NEW:백호| Baekho ]]'s": ("Baekho's", []),
        "[[NEW:백호]] [[NEW:백호|]]": ("[[NEW:백호]] [[NEW:백호|]]", ["[[NEW:백호]]", "[[NEW:백호|]]"]),
        "[[G134:무림|Murim Alliance]]": ("Murim Alliance", []),
        "[[Great Hall]] [[G3 summit]]": ("Great Hall [[G3 summit]]", ["[[G3 summit]]"]),
        "plain [[G1": ("plain [[G1", []),
    }
    for text, want in cases.items():
        assert applied(spark, text) == want, text


def test_tokens_found(spark):
    assert one(spark, X.token_ids(F.col("t")), t="[[G7]] [[g 08]] [[G99999999999]]") == [7, 8, None]
    got = one(spark, X.new_entities(F.col("t")), t="[[NEW: 검성 | Sword ]] x [[NEW:신]] [[NEW:a|]]")
    assert [(r.korean, r.english) for r in got] == [("검성", "Sword"), ("신", ""), ("a", "")]
