import random

import pytest

from chapterloom.llm import url_rules as U

URLS = [
    "http://a.example.org/es/1",
    "https://WWW.Example.ORG/en/17?q#f",
    "http://example.org/en/2",
    "http://notexample.org/en/1",
    "http://org/",
    "http://x.org",
    "http://x.org?/",
    "http://x.com/fr/",
    "http://x.com/fr",
    "http://x.com/de/#/fr/",
    "https://user@com:80/de/",
    "http://com./de/",
    "ftp://Ä.org/Ä?",
    "http://a.net/x://b.org/",
    "://y.com/de/",
    "no scheme.org/",
    "",
    None,
    "http:///es/",
    "http://a..example.org/es/\n",
    "http://" + "a." * 3000 + "org/" + "p" * 5000,
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h) + len(p), len(h), a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, default, None))
    return host, path, best[3], best[2]


@pytest.mark.parametrize("limit", [10, 0])
def test_cases(spark, limit):
    rows = [(k, u, "x", "y") for k, u in enumerate(URLS)] + [(0, URLS[0], "x", "y"), (None, URLS[1], "x", "y"), (None, None, "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, digest string").repartition(3)
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in U.judge(pages, U.rules_table(spark), broadcast_rules=limit).collect()), key=str)
    assert got == sorted(((k, *brute(u, U.RULES)) for k, u, *_ in rows), key=str)


@pytest.mark.parametrize("limit", [1000, 0])
def test_precedence_against_brute_force(spark, limit):
    random.seed(3)
    part = lambda alphabet, n: "".join(random.choice(alphabet) for _ in range(random.randint(0, n)))
    rules = [(part("ab.", 4), random.choice(["", "/", "/"]) + part("xy/", 3), random.choice(["allow", "block"])) for _ in range(150)]
    urls = [f"s://{part('abA.', 6)}/{part('xy/', 5)}" for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame([*rules, ("a/b", "", "block"), (None, "/", "block"), ("a", None, "block")], "host string, path string, action string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(pages, table, "review", limit).collect()}
    assert got == {k: brute(u, rules, "review") for k, u in enumerate(urls)}


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    rules = U.rules_table(spark)
    assert U.judge(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in U.judge(pages, rules.limit(0)).collect()] == [(1, "a.example.org", "/es/1", None, "allow")]


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string").write.mode("overwrite")
    path = spark.conf.get("spark.checkpoint.dir") + "/pages-plan"
    pages.parquet(path)
    for limit in (10, 0):
        plan = U.judge(spark.read.parquet(path), U.rules_table(spark), broadcast_rules=limit)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
