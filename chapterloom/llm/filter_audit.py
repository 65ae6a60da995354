"""Filter interaction audit: what each filter removes at each place of every order of the filters.

Every document is reduced to a mask of the filters that it fails; documents are then counted by part and mask, 2**k rows
a part at most. Orders are ranked by their Lehmer code, so orders that share their first letters are neighbours:
a mask is removed at step s by all orders that begin with s - 1 filters it passes and one that it fails, an
interval of (k - s)! ranks. A mask's counts are added where such an interval begins and taken off where it ends; sums
over the ranks then give the counts of all k! orders.

Texts that repeat are told by their SHA-256. A document fails as a repeat unless its id is its text's least; the pair (text, id)
is the key of that join, so that a text with very many copies is spread over tasks.

Defined results: a null text is empty, a null source is the part ''. A document without an id repeats nothing and nothing
repeats it. Rows with the same id and text are documents each; none of them repeats the others. Several labels of one
id count as one that has each mark which any of them has; a document without a label is neither good nor toxic. An empty
table has no part and no rows. Only doc_id, text and source are read, of labels only doc_id, quality and toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chapterloom.llm.common import store

#: The filters of failures(), in the order of their bits.
FILTERS = "ABCDE"
MEASURES = ["n", "good", "toxic"]
_BLANK = r"[\x20\x09-\x0D]+"


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic) of each document; bit i of fails says that filter FILTERS[i] fails. Texts are read once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, _BLANK), lambda w: w != "")
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"), F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0].alias("w"))
    tests = [
        F.col("w.n") < 50,
        100 * F.col("w.distinct") < 65 * F.col("w.n"),
        100 * (F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))) > 5 * F.length("text"),
        F.col("text").rlike(r"[#$%&*|]"),
    ]
    own = sum((t.cast("int") * (1 << i) for i, t in enumerate(tests)), F.lit(0))
    rows = store(rows.select("doc_id", "part", own.alias("fails"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")), "masks")
    firsts = rows.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(firsts, ["sha", "doc_id"], "left").join(marks, "doc_id", "left")
    again = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return rows.select("part", (F.col("fails") + again.cast("int") * (1 << len(tests))).alias("fails"), *[F.coalesce(c, F.lit(0)).alias(c) for c in MEASURES[1:]])


def rank(prefix: tuple[int, ...], k: int) -> int:
    """The place, among all orders of 0..k-1, of the first one that begins so: the Lehmer code's digits times factorials."""
    return sum((x - sum(y < x for y in prefix[:i])) * factorial(k - 1 - i) for i, x in enumerate(prefix))


def intervals(k: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(mask, filter, step, begin, end): the orders of ranks begin to end - 1 remove what has this mask at this step, by this filter."""
    for mask in range(1, 1 << k):
        fails = [f for f in range(k) if mask >> f & 1]
        passes = [f for f in range(k) if not mask >> f & 1]
        for step in range(1, len(passes) + 2):
            for before in permutations(passes, step - 1):
                for f in fails:
                    begin = rank((*before, f), k)
                    yield mask, f, step, begin, begin + factorial(k - step)


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def audit(failed: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts for every (part, order of the filters, step), zeros included, from rows (part, fails, good, toxic).

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley). With k
    filters the tables of orders and intervals are fixed by k alone: 120 and 840 rows for five.
    """
    spark, k = failed.sparkSession, len(filters)
    sums = [F.sum(c).alias(c) for c in MEASURES]
    masks = store(failed.groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")), "by-mask")
    spans = _small(spark, list(intervals(k)), "fails int, filter int, step int, begin int, end int")
    covered = masks.join(spans, "fails")
    # A difference array for each (part, step): added where an interval begins, taken off where it ends.
    ends = F.explode(F.array(F.struct(F.col("begin").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")))).alias("e")
    steps = covered.select("part", "step", ends, *MEASURES).select("part", "step", "e.rank", *[(F.col("e.sign") * F.col(c)).alias(c) for c in MEASURES])
    steps = steps.where(F.col("rank") < factorial(k)).groupBy("part", "step", "rank").agg(*sums)
    orders = _small(spark, [(r, s + 1, f, "".join(filters[x] for x in o)) for r, o in enumerate(permutations(range(k))) for s, f in enumerate(o)], "rank int, step int, filter int, filter_order string")
    parts = masks.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.when(F.col("fails").bitwiseAND(1 << f) != 0, F.col("n")).otherwise(0)).alias(f"failing{f}") for f in range(k)],
        *[F.sum(F.when(F.col("fails") == 1 << f, F.col("n")).otherwise(0)).alias(f"alone{f}") for f in range(k)],
    )
    pick = lambda name: F.element_at(F.array(*[F.col(f"{name}{f}") for f in range(k)]), F.col("filter") + 1)
    share = covered.groupBy("part", "filter").agg(F.sum(F.col("n") * (F.col("end") - F.col("begin"))).alias("shapley"))
    grid = parts.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(factorial(k) - 1)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    grid = grid.withColumnRenamed("o", "rank").join(orders, ["rank", "step"]).withColumns({"failing": pick("failing"), "unique_fails": pick("alone")})
    grid = grid.select("part", "rank", "step", "filter", "filter_order", "total", "failing", "unique_fails").join(steps, ["part", "rank", "step"], "left").join(share, ["part", "filter"], "left")
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = grid.withColumns({c: F.coalesce(F.sum(c).over(upto), F.lit(0)) for c in MEASURES})
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"),
        (F.col("failing") - F.col("n")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.coalesce("shapley", F.lit(0)).alias("shapley"),
    )


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w), 'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
     'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)} AS x
  FROM t LEFT JOIN l USING (doc_id)
), m AS (
  SELECT part, x.A AS a, x.B AS b, x.C AS c, x.D AS d, x.E AS e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), g AS (
  SELECT part, ['A', 'B', 'C', 'D', 'E'] AS names, [a, b, c, d, e] AS x, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS fails, n, good, toxic FROM m
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS v
), orders AS (
  SELECT a.v || b.v || c.v || d.v || e.v AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.v, b.v, c.v, d.v, e.v])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS v FROM orders, range(1, 6) r(step)
), cells AS (
  SELECT part, filter_order, step, v,
    CAST(sum(CASE WHEN failed AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN failed AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN NOT failed AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN failed AND fails = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN failed AND NOT earlier THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN failed AND NOT earlier THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM (
    SELECT part, filter_order, step, v, fails, n, good, toxic, x[list_position(names, v)] AS failed,
      len(list_filter(names, lambda y: x[list_position(names, y)] AND strpos(filter_order, y) < step)) > 0 AS earlier
    FROM g, steps
  ) GROUP BY part, filter_order, step, v
)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, v) AS BIGINT) AS shapley
FROM cells
"""
