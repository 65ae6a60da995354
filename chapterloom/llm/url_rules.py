"""URL filters: rules of a host and the beginning of a path, looked up by hashed expressions. DataFrame functions only.

A rule holds for its host, all hosts below it, and all paths that begin with its path. Each URL is expanded
into host-suffix and path-prefix expressions, but only of the shapes (labels of the host, characters of the path) that
some rule has; so no rule is lost, and a URL has no more expressions than there are shapes. Expressions meet
the rules by an equi-join on the first four bytes of their SHA-256, then whole digests are compared; of a URL's rules the longest
one decides.

Rules up to BROADCAST_RULES are broadcast; beyond that they are shuffled, each repeated for SALTS salts, as one expression (a top
level domain, say) can be a part of most URLs. Verdicts come back to the pages by (page_id, url).

Defined results: the host is what follows the first :// up to /, ? or #, with A-Z lower-cased, the path goes on up to ? or #;
without :// or for a null URL both are empty. A port, a user or a trailing dot is part of the host as it stands. The longest rule
is that with most characters of host and path together; of equal ones that with the longer host, then block. Rules that
repeat count once; where they contradict each other, block wins; one whose host is null or no host, or whose path is null, fits
nothing. A URL without a rule gets the default verdict. Pages that
repeat are judged alike; a null page_id is as good as any. Columns other than page_id and url are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules up to which they are broadcast, at some 150 bytes each.
BROADCAST_RULES = 500_000
#: Copies of each rule where they are shuffled.
SALTS = 32

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(host, path, action) as a DataFrame."""
    row = lambda r: F.struct(*[F.lit(v).alias(c) for c, v in zip(("host", "path", "action"), r)])
    return spark.range(1).select(F.inline(F.array(*map(row, rules))))


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.try_element_at(F.split(url, "://", 2), F.lit(2)), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return _ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _keyed(host: Column, path: Column) -> Column:
    """The digest of an expression. No host holds a slash, so that no two expressions are alike."""
    return F.unhex(F.sha2(F.concat(host, F.lit("/"), path).cast("binary"), 256))


def _short(digest: Column) -> Column:
    """The first four bytes."""
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long")


def compiled(rules: DataFrame) -> DataFrame:
    """One row for each distinct (host, path): short (hash prefix), digest, rule, action, its length, and its shape (labels, n)."""
    rows = rules.select(_ascii_lower(F.col("host")).alias("h"), F.col("path").alias("p"), "action").where(F.col("p").isNotNull() & ~F.col("h").rlike("[/?#]"))
    rows = rows.groupBy("h", "p").agg(F.max("action").alias("action"))  # block sorts after allow
    digest = _keyed(F.col("h"), F.col("p"))
    return rows.select(
        _short(digest).alias("short"),
        digest.alias("digest"),
        F.concat("h", "p").alias("rule"),
        "action",
        (F.length("h") + F.length("p")).alias("size"),
        F.length("h").alias("host_size"),
        _labels(F.col("h")).alias("labels"),
        F.length("p").alias("n"),
    )


def expressions(pages: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """(page_id, url, short, digest): each page's expressions of the given shapes (labels of the host, characters of the path)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("labels", _labels(F.col("host")))
    shape = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(n).alias("n")) for a, n in shapes])
    fit = F.filter(shape, lambda s: (s["labels"] <= F.col("labels")) & (s["n"] <= F.length("path")))
    made = F.transform(fit, lambda s: _keyed(F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"]), F.substring(F.col("path"), F.lit(1), s["n"])))
    return rows.select("page_id", "url", F.explode(made).alias("digest")).withColumn("short", _short(F.col("digest")))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page.

    The distinct shapes of the rules go through the driver: at most as many as (labels, lengths) that rules have.
    """
    table = compiled(rules)
    shapes = [(r.labels, r.n) for r in table.select("labels", "n").distinct().collect()]
    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    if not shapes:
        return out.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    found, table = expressions(pages, shapes), table.drop("labels", "n")
    if table.count() <= broadcast_rules:
        found = found.alias("e").join(F.broadcast(table.alias("r")), F.col("e.short") == F.col("r.short"))
    else:
        # Salts come from the row, so that they are the same when a task runs again.
        salted = found.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).alias("e")
        each = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).alias("r")
        found = salted.join(each, (F.col("e.short") == F.col("r.short")) & (F.col("e.salt") == F.col("r.salt")))
    found = found.where("e.digest = r.digest").select("page_id", "url", F.struct("size", "host_size", "action", "rule").alias("best"))
    best = found.groupBy("page_id", "url").agg(F.max("best").alias("best")).select(F.col("page_id").alias("page"), F.col("url").alias("of"), "best")
    out = out.join(best, F.col("page_id").eqNullSafe(F.col("page")) & F.col("url").eqNullSafe(F.col("of")), "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))


def sql(rules: list[tuple[str, str, str]] = RULES, default: str = "allow") -> str:
    values = ", ".join("('" + "', '".join(r) + "')" for r in rules)
    return rf"""
WITH rules(h, p, action) AS (VALUES {values}), rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT row_number() OVER () AS k, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), found AS (
  SELECT k, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k
)
SELECT page_id, host, path, rule, coalesce(action, '{default}') AS verdict FROM parts LEFT JOIN found USING (k)
"""
