"""LM scoring: prediction by partial matching over bytes, and a unigram baseline.

Training counts byte contexts of up to ORDER symbols with their successors, over all
training texts: a distributed byte-context trie. Every context counts, however rare. A context gives a symbol that it has seen c of T times
(2c - 1) / 2T, and escapes to its suffix with D / 2T, where D is its number of distinct
successors (method D). After an escape, the symbols that the longer context knows are excluded from the shorter one's
counts. All of this depends on the context and the symbol alone, so a text's code length is a sum of look-ups.

The most frequent contexts (max_contexts, which bounds memory and changes no result; suffixes of a kept context are kept too) are
broadcast as a table of log-probabilities. A symbol after any other context is left to joins with the tables of
counts: its distinct contexts are resolved order by order, from the empty context upwards.

The baseline looks frequent tokens up in a broadcast of bounded size and joins the rest. One pass over the texts
does both.

Defined results: a null or empty text is just the end symbol. With nothing to learn from,
every symbol has the same probability. A-Z are lower-cased. Tokens are told apart by
64-bit hashes. Rows that repeat an id are scored each. Columns of OUTPUTS' names are replaced, the text is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chapterloom.llm.common import in_batches, most_frequent, runs, store, with_text_columns
from chapterloom.llm.words import word_hashes

ORDER = 5
#: 256 bytes and the end of the text, which also stands before it.
SYMBOLS = 257
END = 256
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Stands for the end among token hashes; 0 is no hash of a word with any likelihood.
END_TOKEN = 0


def codes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of the texts and their ends, one integer of its ORDER predecessors and itself; and where each text starts."""
    parts, starts, at = [], [], 0
    pad = np.full(ORDER, END, np.int16)
    for text in texts:
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8).astype(np.int16)
        parts += [pad, data, pad[:1]]
        starts.append(at)
        at += len(data) + 1 + ORDER
    flat = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
    code = np.zeros(max(0, len(flat) - ORDER), np.int64)
    for j in range(ORDER + 1):
        code *= SYMBOLS
        code += flat[j : len(flat) - ORDER + j]
    # Drop the windows that begin in one text's end and run into the next text's padding.
    real = np.ones(len(code), bool)
    for s in starts[1:]:
        real[s - ORDER : s] = False
    return code[real], np.array([s - k * ORDER for k, s in enumerate(starts)], np.int64)


class Tally:
    """Counts of integers, merged now and then, so that at most about ``hold`` entries are kept."""

    def __init__(self, hold: int = 3_000_000):
        self.hold, self.parts, self.size = hold, [], 0

    def add(self, keys: np.ndarray) -> bool:
        """Whether it is full, so that it has to be emptied."""
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > self.hold and len(self.parts) > 1:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
        return self.size > self.hold // 2

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([p[1] for p in self.parts])).astype(np.int64)

    def batches(self):
        if self.parts:
            keys, times = self.merged()
            for lo in range(0, len(keys), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[lo : lo + 200_000].astype(np.int64)), pa.array(times[lo : lo + 200_000])], names=["key", "times"])
        self.parts, self.size = [], 0


def _counted(docs: DataFrame, keys_of, text_col: str) -> DataFrame:
    """(key, times) over all texts: each task sums first."""

    def run(batches):
        function, tally = keys_of(), Tally()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in runs(texts, 1_000_000):
                if tally.add(function(texts[lo:hi])):
                    yield from tally.batches()
        yield from tally.batches()

    return in_batches(docs.select(text_col), run, "key long, times long").groupBy("key").agg(F.sum("times").alias("times"))


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and how many each text has."""
    words, n = word_hashes(texts)
    n = n + 1
    out = np.full(int(n.sum()), END_TOKEN, np.uint64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(n) - 1] = False
    out[inner] = words
    return out.view(np.int64), n


def count_contexts(train: DataFrame, text_col: str = "text") -> DataFrame:
    return _counted(train, lambda: lambda texts: codes_of(texts)[0], text_col)


def count_tokens(train: DataFrame, text_col: str = "text") -> DataFrame:
    return _counted(train, lambda: lambda texts: token_hashes(texts)[0], text_col)


# ---------------------------------------------------------------- the model


class Model:
    """Log-probabilities (base 10) of every symbol after every kept context.

    levels[j]: sorted codes of the contexts of order j. Row r of the table belongs to the
    context of that place among all levels. symbols maps a symbol to its column; the last
    column holds what each symbol never seen in training gets.
    """

    def __init__(self, successors: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """successors[j]: arrays (context code, symbol, count) of order j."""
        seen = np.unique(successors[0][1]) if len(successors[0][1]) else np.empty(0, np.int64)
        width = len(seen) + 1
        self.symbols = np.full(SYMBOLS, len(seen), np.int64)
        self.symbols[seen] = np.arange(len(seen))
        self.levels, tables = [], []
        lower_counts = lower_escaped = None
        for j, (context, symbol, count) in enumerate(successors):
            codes = np.unique(context) if j else np.zeros(1, np.int64)
            counts = np.zeros((len(codes), width), np.float32)
            np.add.at(counts, (np.searchsorted(codes, context), self.symbols[symbol]), 2 * count - 1)
            parent = np.searchsorted(self.levels[j - 1], codes % SYMBOLS ** (j - 1)) if j else None
            escaped = np.full((len(codes), width), 1 / max(1, SYMBOLS - len(seen)), np.float32)
            table = np.empty((len(codes), width), np.float32)
            for lo in range(0, len(codes), 4096):  # bounds what the driver holds besides the table
                rows = slice(lo, lo + 4096)
                own, known = counts[rows], counts[rows] > 0
                if j:
                    below = lower_counts[parent[rows]]
                    below[known] = 0
                    rest, kinds = below.sum(1, dtype=np.float64), (below > 0).sum(1)
                    whole = np.maximum(rest + kinds, 1e-30)
                    on = np.where(kinds > 0, kinds / whole, 1.0)
                    escaped[rows] = np.where(below > 0, below / whole[:, None], on[:, None] * lower_escaped[parent[rows]])
                total, distinct = own.sum(1, dtype=np.float64), known.sum(1)
                whole = np.maximum(total + distinct, 1e-30)
                away = np.where(total > 0, distinct / whole, 1.0)
                p = np.where(known, own / whole[:, None], away[:, None] * escaped[rows])
                table[rows] = np.log10(np.maximum(p, 1e-38))
            tables.append(table)
            self.levels.append(codes)
            lower_counts, lower_escaped = counts, escaped
        self.offsets = np.cumsum([0, *map(len, self.levels)])
        self.table = np.concatenate(tables)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """log10 probability of each text and its end by the kept contexts alone."""
        if not texts:
            return np.empty(0)
        codes, starts = codes_of(texts)
        codes, place = np.unique(codes, return_inverse=True)  # a text repeats most of its contexts
        return np.add.reduceat(self.table[self._rows(codes), self.symbols[codes % SYMBOLS]].astype(np.float64)[place], starts)

    def parts(self, texts: list[str | None]) -> tuple[np.ndarray, pa.ListArray]:
        """log10 probability of the symbols of each text whose whole context is kept; the distinct codes of the others and how often each occurs."""
        codes, starts = codes_of(texts)
        codes, place = np.unique(codes, return_inverse=True)
        row = self._rows(codes)
        kept = row >= self.offsets[ORDER]
        logs = np.where(kept, self.table[row, self.symbols[codes % SYMBOLS]], 0).astype(np.float64)
        at = np.flatnonzero(~kept[place])
        pairs, n = np.unique((np.searchsorted(starts, at, "right") - 1) * len(codes) + place[at], return_counts=True)
        text, code = np.divmod(pairs, len(codes))
        rest = pa.StructArray.from_arrays([pa.array(codes[code], pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])
        return np.add.reduceat(logs[place], starts), pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), rest)

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        """The table's row of the longest kept context of each code."""
        row, context = np.zeros(len(codes), np.int64), codes // SYMBOLS
        left = np.arange(len(codes))
        for j in range(1, len(self.levels)):
            level = self.levels[j]
            if not len(level):
                break
            own = context[left] % SYMBOLS**j
            at = np.searchsorted(level, own)
            at[at == len(level)] = 0
            found = level[at] == own
            left = left[found]
            row[left] = at[found] + self.offsets[j]
        return row


def count_levels(train: DataFrame, text_col: str = "text") -> list[DataFrame]:
    """For each order (key, times) of all contexts with a successor, as stored tables."""
    grams = [store(count_contexts(train, text_col), "contexts")]
    for j in range(ORDER, 0, -1):
        lower = grams[-1].groupBy((F.col("key") % SYMBOLS**j).alias("key")).agg(F.sum("times").alias("times"))
        grams.append(store(lower, f"contexts{j}"))
    return grams[::-1]


def learn(train: DataFrame, max_contexts: int = 100_000, text_col: str = "text", grams: list[DataFrame] | None = None) -> Model:
    """The most frequent contexts' rows of the model of all training texts: max_contexts at most, equally frequent ones all or none.

    The driver gets their successors, max_contexts * SYMBOLS rows at most.
    """
    grams = grams or count_levels(train, text_col)
    totals = None
    for j, g in enumerate(grams):
        own = g.groupBy(F.expr(f"key div {SYMBOLS}").alias("context")).agg(F.sum("times").alias("times")).select(F.lit(j).alias("order"), "context", "times")
        totals = own if totals is None else totals.union(own)
    kept = store(most_frequent(store(totals, "totals"), max_contexts), "kept")
    successors = []
    for j, g in enumerate(grams):
        rows = g.select(F.expr(f"key div {SYMBOLS}").alias("context"), (F.col("key") % SYMBOLS).alias("symbol"), "times")
        own = kept.where(F.col("order") == j).select("context")
        found = rows.join(F.broadcast(own), "context", "left_semi").toArrow()
        successors.append(tuple(found.column(c).to_numpy() for c in ("context", "symbol", "times")))
    return Model(successors)


def resolved(codes: DataFrame, grams: list[DataFrame]) -> DataFrame:
    """(key, log): log10 probability by all contexts of each of the distinct codes.

    Each order's distinct codes are joined to their counts, to their context's sums and to
    what the order below has found, so no key has more than SYMBOLS rows. Of a
    context, weight sums 2c - 1 and kinds counts its successors; rest and rest_kinds are the same of
    its suffix without the excluded symbols.
    """
    weight = F.lit(2) * F.col("times") - 1
    top = grams[0].agg(F.coalesce(F.sum(weight), F.lit(0)).alias("weight"), F.count(F.lit(1)).alias("kinds")).first()
    never = -float(np.log10(max(1, SYMBOLS - top.kinds)))
    away = never + (float(np.log10(top.kinds / (top.weight + top.kinds))) if top.kinds else 0.0)
    log = F.when(F.col("times") > 0, F.log10(weight) - F.log10(F.lit(float(max(1, top.weight + top.kinds))))).otherwise(F.lit(away))
    below = codes.select((F.col("key") % SYMBOLS).alias("key")).distinct().join(grams[0], "key", "left")
    below = store(below.select("key", F.coalesce("times", F.lit(0)).alias("times"), log.alias("log"), F.lit(never).alias("escaped")), "resolved0")
    sums = None
    for j in range(1, ORDER + 1):
        suffix, context = F.col("key") % SYMBOLS**j, F.expr(f"key div {SYMBOLS}")
        both = grams[j].withColumn("suffix", suffix).join(grams[j - 1].select(F.col("key").alias("suffix"), (2 * F.col("times") - 1).alias("lower")), "suffix")
        own = both.groupBy(context.alias("context")).agg(F.sum(weight).alias("weight"), F.count(F.lit(1)).alias("kinds"), F.sum("lower").alias("known"))
        if j == 1:
            own = own.withColumns({"rest": F.lit(top.weight) - F.col("known"), "rest_kinds": F.lit(top.kinds) - F.col("kinds")})
        else:
            lower = sums.select(F.col("context").alias("parent"), F.col("weight").alias("w"), F.col("kinds").alias("k"))
            own = own.withColumn("parent", F.col("context") % SYMBOLS ** (j - 1)).join(lower, "parent").withColumns({"rest": F.col("w") - F.col("known"), "rest_kinds": F.col("k") - F.col("kinds")})
        sums = store(own.select("context", "weight", "kinds", "rest", "rest_kinds"), f"sums{j}")
        asked = codes.select((F.col("key") % SYMBOLS ** (j + 1)).alias("key")).distinct() if j < ORDER else codes
        found = asked.join(grams[j], "key", "left").withColumns({"context": context, "suffix": suffix}).join(sums, "context", "left")
        found = found.join(below.select(F.col("key").alias("suffix"), F.col("times").alias("times_below"), F.col("log").alias("log_below"), F.col("escaped").alias("escaped_below")), "suffix")
        whole = F.log10(F.col("rest") + F.col("rest_kinds"))
        # Where the longer context knows the symbol, this is null and not used.
        escaped = F.when(F.col("times_below") > 0, F.log10(2 * F.col("times_below") - 1) - whole).otherwise(F.when(F.col("rest_kinds") > 0, F.log10("rest_kinds") - whole).otherwise(0.0) + F.col("escaped_below"))
        total = F.log10(F.col("weight") + F.col("kinds"))
        log = F.when(F.col("weight").isNull(), F.col("log_below")).when(F.col("times") > 0, F.log10(weight) - total).otherwise(F.log10("kinds") - total + escaped)
        below = store(found.select("key", F.coalesce("times", F.lit(0)).alias("times"), log.alias("log"), escaped.alias("escaped")), f"resolved{j}")
    return below.select("key", "log")


# ---------------------------------------------------------------- scoring

OUTPUTS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
_REST = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())]))
_FIELDS = [
    T.StructField("log", T.DoubleType()),
    T.StructField("rest", _REST),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()),
    T.StructField("base", T.DoubleType()),
    T.StructField("rare", T.ArrayType(T.LongType())),
]


def baseline_parts(texts: list[str | None], keys: np.ndarray, logs: np.ndarray) -> list:
    """For each text the number of tokens, of those among the sorted keys, the sum of these's logs, and the others' hashes."""
    hashes, n = token_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), n)
    if len(keys):
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        often = keys[at] == hashes
        base = np.bincount(doc[often], logs[at[often]], len(texts)).astype(float)
    else:
        often, base = np.zeros(len(hashes), bool), np.zeros(len(texts))
    offsets = np.append(0, np.cumsum(np.bincount(doc[~often], minlength=len(texts)))).astype(np.int32)
    return [n, np.bincount(doc[often], minlength=len(texts)), base, pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[~often]))]


def scored(docs: DataFrame, train: DataFrame, max_contexts: int = 100_000, frequent: int = 400_000, text_col: str = "text") -> DataFrame:
    """Every row of docs without its text, and OUTPUTS: base_score is the unigram model's log10 probability (half a count added to each token), score the contexts'.

    At most max_contexts contexts and ``frequent`` tokens are broadcast; what is rarer is joined. Neither changes the result.
    """
    spark = docs.sparkSession
    grams = count_levels(train, text_col)
    model = learn(train, max_contexts, text_col, grams)
    counts = store(count_tokens(train, text_col), "tokens")
    total = counts.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = most_frequent(counts, frequent).toArrow().sort_by("key")
    shared = spark.sparkContext.broadcast((model, top.column("key").to_numpy(), np.log10(top.column("times").to_numpy() + 0.5)))

    def make():
        def one(texts):
            own, keys, logs = shared.value
            return [*own.parts(texts), *baseline_parts(texts, keys, logs)]

        return one

    # Columns go by their place, so that none clashes with those that are made on the way.
    kept = [c for c in docs.columns if c.lower() not in {text_col.lower(), *OUTPUTS}]
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)], F.col(f"`{text_col}`").alias("text"))
    first = store(with_text_columns(rows, make, _FIELDS, chunk_chars=500_000).drop("text"), "scored")
    rest = first.select("row_id", F.explode("rest").alias("r")).select("row_id", "r.key", "r.n")
    logs = resolved(store(rest.select("key").distinct(), "rest"), grams)
    more = rest.join(logs, "key").groupBy("row_id").agg(F.sum(F.col("n") * F.col("log")).alias("more"))
    rare = first.select("row_id", F.explode("rare").alias("key")).join(counts, "key", "left")
    rare = rare.groupBy("row_id").agg(F.sum(F.log10(F.coalesce("times", F.lit(0)) + 0.5)).alias("more_base"), F.count("times").alias("more_known"))
    scale = F.log10(F.lit(total.n) + F.lit(0.5) * (total.v + 1))
    return first.join(more, "row_id", "left").join(rare, "row_id", "left").select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)],
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"),
        (F.col("log") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
