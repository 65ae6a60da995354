"""Language ID by rank-order profiles (Cavnar and Trenkle's out-of-place distance).

A text is folded to lower-case letters and single spaces; its 1-, 2- and 3-grams are
ranked by frequency. A language's profile is the ranking of the grams of all its
training texts. The distance of a text to a profile sums, over the text's most
frequent grams, how far each stands from its rank in the profile.

Defined results: a null text, an empty one or one without a letter is ``und`` with score
0; so is every text when nothing could be learned. Equal counts rank by the gram's code,
equal distances go to the language that sorts first. Repeated rows are predicted alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chapterloom.llm.common import in_batches, packed, with_text_columns

#: The label of texts that have no letter.
UNKNOWN = "und"


class Folder:
    """Turns texts to arrays of lower-case letters' code points, with 32 for everything else."""

    def __init__(self):
        self.table = np.zeros(0x110000, np.int32)

    def __call__(self, text: str) -> np.ndarray:
        x = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        y = self.table[x]
        if not y.all():
            for c in np.unique(x[y == 0]).tolist():
                self.table[c] = ord(chr(c).lower()[0]) if chr(c).isalpha() else 32
            y = self.table[x]
        gap = y == 32
        return y[np.append(True, ~(gap[1:] & gap[:-1]))].astype(np.int64)


def gram_codes(y: np.ndarray) -> np.ndarray:
    """One integer for each 1-, 2- and 3-gram that doesn't span a gap: 21 bits a letter, so codes are exact."""
    two = (y[:-1] << 21) | y[1:]
    three = ((two[:-1] << 21) | y[2:])[y[1:-1] != 32]
    return np.concatenate([y[y != 32], two, three])


def count_grams(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", hold: int = 1_000_000) -> DataFrame:
    """(lang, gram, n) over all texts. Each task sums its own rows first and holds about ``hold`` entries at most."""

    def run(batches):
        import pyarrow as pa

        fold, held, size = Folder(), {}, 0

        def merged(parts):
            codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return codes, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)

        def flush():
            for lang, parts in held.items():
                codes, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            by: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = by.setdefault(lang, [0])
                part[0] += len(text)
                part.append(fold(text))
                if part[0] > 1_000_000:
                    size += _add(held, lang, by.pop(lang)[1:])
            for lang, part in by.items():
                size += _add(held, lang, part[1:])
            if size > hold:
                for lang, parts in held.items():
                    held[lang] = [merged(parts)]
                size = sum(len(p[0][0]) for p in held.values())
                if size > hold / 2:
                    yield from flush()
                    size = 0
        yield from flush()

    used = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null and text <> ''")
    return in_batches(used, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _add(held: dict, lang: str, folded: list) -> int:
    codes, n = np.unique(gram_codes(np.concatenate(folded)), return_counts=True)
    held.setdefault(lang, []).append((codes, n))
    return len(codes)


def learn_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = 300, max_langs: int = 2000) -> dict[str, list[int]]:
    """The ``top`` most frequent grams of each language, best first.

    Only top grams of each language reach the driver: top * max_langs at most; more
    languages raise. Ranking runs in two steps, so that no task gets all grams of a language.
    """
    counts = count_grams(docs, lang_col, text_col)
    order = [F.col("n").desc(), F.col("gram")]
    salted = counts.withColumn("salt", F.pmod(F.hash("gram"), F.lit(64)))
    for keys in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    profiles: dict[str, list[int]] = {}
    for row in salted.select("lang", "gram", "rank").sort("lang", "rank").toLocalIterator():
        profiles.setdefault(row.lang, []).append(row.gram)
        if len(profiles) > max_langs:
            raise ValueError(f"more than {max_langs} languages to learn")
    return profiles


def ranker(profiles: dict[str, list[int]], top: int = 300):
    """A function from texts to (language, score, fit) lists."""
    langs = sorted(profiles)
    vocabulary = np.unique(np.concatenate([np.asarray(profiles[x], np.int64) for x in langs])) if langs else np.empty(0, np.int64)
    ranks = np.full((len(vocabulary), max(1, len(langs))), top, np.int64)
    for k, lang in enumerate(langs):
        ranks[np.searchsorted(vocabulary, profiles[lang]), k] = np.arange(len(profiles[lang]))
    fold = Folder()

    def one(text):
        y = fold(text) if text else None
        if y is None or not langs or (y == 32).all():
            return UNKNOWN, 0.0, 0.0
        codes, n = np.unique(gram_codes(y), return_counts=True)
        best = codes[np.lexsort((codes, -n))[:top]]
        at = np.searchsorted(vocabulary, best)
        at[at == len(vocabulary)] = 0
        known = vocabulary[at] == best
        apart = np.abs(ranks[at] - np.arange(len(best))[:, None])
        apart[(ranks[at] == top) | ~known[:, None]] = top
        fit = 1 - apart.sum(0) / (top * len(best))
        k = int(fit.argmax())
        return langs[k], float(fit[k] / fit.sum()) if fit[k] > 0 else 0.0, float(max(0.0, fit[k]))

    return lambda texts: [list(x) for x in zip(*map(one, texts))] if texts else [[], [], []]


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("fit", T.DoubleType())]


def predict(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", top: int = 300) -> DataFrame:
    """Adds lang_pred, score (the best language's share of all languages' fits) and fit (1 less the mean displacement) to every row."""
    return with_text_columns(docs, lambda: ranker(profiles, top), FIELDS, text_col)


def accepted(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", top: int = 300, min_fit: float = 0.05) -> DataFrame:
    """The rows, unchanged, whose text has a letter and fits a learned language by min_fit at least."""
    rows = packed(docs, text_col)
    return with_text_columns(rows, lambda: ranker(profiles, top), FIELDS, text_col, keep=lambda new: [a != UNKNOWN and fit >= min_fit for a, _, fit in zip(*new)]).select("row.*")
