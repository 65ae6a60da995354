"""Benchmark decontamination with training suffix arrays.

Each task cuts its documents into shards of bounded size and sorts all word suffixes of a
shard (packed words first, then prefix doubling among ties). Every test suffix is
binary-searched in every shard: the range of its window (its first words) gives all
verbatim occurrences. From there the longest match is the one with a neighbour among the
test suffixes, in the common order of a shard's hit documents and the items that hit them;
its length comes from the ranks of prefix doubling, so repeated words take no longer. A document's
words lie in one shard, so nothing is shuffled. The benchmark's suffixes are built in blocks of
bounded size and broadcast; a worker holds one block at a time.

Defined results: null texts have no words; an item without a word has no window; an item
shorter than a window is one window; equal items all count; a null item_id is left out of
the list of ids. Repeated rows get the same result each. With an empty benchmark nothing
is hit. Of equally long matches the first in the document counts, then the item that sorts first
by id (of blocks, the first).
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chapterloom.llm.common import packed, with_text_columns

#: Bytes of words (digits, letters, everything beyond ASCII) stay, A-Z become a-z, the rest becomes a space.
_WORD_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class Suffixes:
    """The test suffixes of a block of items, as arrays: distinct windows, the items that hold each, and the items' words."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        known: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.window, self.items, lines = window, [], []
        for item_id, text in items:
            words = words_of(text)
            if words:
                self.items.append(str(item_id) if item_id is not None else None)
                lines.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        self.words = list(known)
        self.line_length = np.array([len(x) for x in lines], np.int64)
        self.line_start = np.cumsum(self.line_length) - self.line_length
        self.line_words = np.concatenate(lines) if lines else np.empty(0, np.int32)
        many = np.maximum(1, self.line_length - window + 1)
        item = np.repeat(np.arange(len(lines)), many)
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        length = np.minimum(window, self.line_length)[item]
        windows = np.full((len(item), window), -1, np.int32)
        for j in range(window):
            there = j < length
            windows[there, j] = self.line_words[(self.line_start[item] + at)[there] + j]
        self.windows, which = np.unique(windows, axis=0, return_inverse=True)
        self.lengths = (self.windows >= 0).sum(1)
        held = np.unique(which.reshape(-1).astype(np.int64) * max(1, len(lines)) + item)
        first = np.searchsorted(held // max(1, len(lines)), np.arange(len(self.windows) + 1))
        lists: dict[bytes, int] = {}
        window_items = (held % max(1, len(lines))).astype(np.int32)
        #: Windows that the same items hold are of one class, so that a text with a passage of many items needs no row for each.
        self.class_of = np.array([lists.setdefault(window_items[a:b].tobytes(), len(lists)) for a, b in itertools.pairwise(first.tolist())], np.int64)
        self.classes = [np.frombuffer(x, np.int32) for x in lists]
        self.least_item = np.array([x[0] for x in self.classes], np.int64)

    def items_in(self, classes: list[int]) -> np.ndarray:
        """The items, by number, of some classes."""
        return np.unique(np.concatenate([self.classes[c] for c in classes])) if classes else np.empty(0, np.int32)


class Shard:
    """The suffix array of some texts' words. A 0 stands after each text's words."""

    def __init__(self, texts: list[str | None], depth: int):
        lines = [words_of(x) for x in texts]
        self.n_words = np.array([len(x) for x in lines], np.int64)
        self.ids: dict[bytes, int] = defaultdict(itertools.count(1).__next__)
        flat = np.fromiter(map(self.ids.__getitem__, itertools.chain.from_iterable(lines)), np.int64, int(self.n_words.sum()))
        doc = np.repeat(np.arange(len(lines)), self.n_words)
        self.doc = np.repeat(np.arange(len(lines)), self.n_words + 1)
        self.word = np.zeros(len(flat) + len(lines), np.int64)
        self.word[np.arange(len(flat)) + doc] = flat
        bits = max(1, len(self.ids).bit_length())
        self.bits, self.packed = bits, max(1, 62 // bits)
        n, key = len(self.word), np.zeros(len(self.word), np.int64)
        for j in range(min(n, self.packed)):
            key[: n - j] |= self.word[j:] << (bits * (self.packed - 1 - j))
        self.order = np.argsort(key)
        self.key = key[self.order]
        self._refine(depth)

    def _refine(self, depth: int) -> None:
        """Prefix doubling among suffixes that are still tied, down to depth words."""
        n, known = len(self.order), self.packed
        new = np.append(True, self.key[1:] != self.key[:-1]) if n else np.empty(0, bool)
        while known < depth and not new.all():
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            rank = np.empty(n + 1, np.int64)
            rank[self.order], rank[n] = first, -1
            tied = np.flatnonzero(~new | ~np.append(new[1:], True))
            at = self.order[tied]
            key = (rank[at] << 32) | (rank[np.minimum(at + known, n)] + 1)
            by = np.argsort(key)
            self.order[tied] = at[by]
            key = key[by]
            new[tied] = np.append(True, key[1:] != key[:-1])
            known *= 2

    def ranges(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the range [lo, hi) of suffixes that begin with it. Words that the shard lacks are negative."""
        count = len(windows)
        low = np.zeros(count, np.int64)
        high = np.zeros(count, np.int64)
        there = np.ones(count, bool)
        top = (1 << self.bits) - 1
        for j in range(self.packed):
            shift = self.bits * (self.packed - 1 - j)
            own = (lengths > j) if j < windows.shape[1] else np.zeros(count, bool)
            word = windows[:, j] if j < windows.shape[1] else np.zeros(count, np.int64)
            there &= ~own | (word > 0)
            low |= np.where(own, np.maximum(word, 0), 0) << shift
            high |= np.where(own, np.maximum(word, 0), top) << shift
        lo, hi = np.searchsorted(self.key, low, "left"), np.searchsorted(self.key, high, "right")
        for j in range(windows.shape[1]):
            there &= (lengths <= j) | (windows[:, j] > 0)
        lo, hi = np.where(there, lo, 0), np.where(there, hi, 0)
        left = np.flatnonzero((lo < hi) & (lengths > self.packed))
        for upper in (False, True):
            a, b = lo[left].copy(), hi[left].copy()
            while (open_ := np.flatnonzero(a < b)).size:
                mid = (a[open_] + b[open_]) // 2
                after = self._compare(mid, windows[left[open_]], lengths[left[open_]])
                below = after < 0 if not upper else after <= 0
                a[open_[below]] = mid[below] + 1
                b[open_[~below]] = mid[~below]
            if upper:
                hi[left] = a
            else:
                bound = a
        lo[left] = bound if left.size else lo[left]
        return lo, hi

    def _compare(self, slots: np.ndarray, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sign of each slot's suffix against a window, over the window's words."""
        sign = np.zeros(len(slots), np.int64)
        at = self.order[slots]
        for j in range(self.packed, windows.shape[1]):
            word = np.where(at + j < len(self.word), self.word[np.minimum(at + j, len(self.word) - 1)], 0)
            sign = np.where((sign == 0) & (lengths > j), np.sign(word - windows[:, j]), sign)
        return sign


class Ranks:
    """Ranks of all runs of 1, 2, 4, ... symbols from each place of a sequence, until runs of ``longest`` are told apart."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.levels = [np.unique(symbols, return_inverse=True)[1].astype(np.int32)]
        n = len(symbols)
        while 1 << (len(self.levels) - 1) < longest and int(self.levels[-1].max(initial=-1)) < n - 1:
            last, step = self.levels[-1].astype(np.int64), 1 << (len(self.levels) - 1)
            key = last << 32
            key[: max(0, n - step)] |= last[step:] + 1
            self.levels.append(np.unique(key, return_inverse=True)[1].astype(np.int32))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from a on equal those from b on."""
        n, found = len(self.levels[0]), np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + found, b + found
            same = (x < n) & (y < n)
            same[same] = self.levels[k][x[same]] == self.levels[k][y[same]]
            found += same.astype(np.int64) << k
        return found


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... count of them, one run after the other."""
    return np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)


def longest_from(shard: Shard, test: Suffixes, line: np.ndarray, at: np.ndarray, items: np.ndarray):
    """For places where a whole window begins: document, place, length and item of the longest match of each document. items: those that hit."""
    docs, words = np.unique(shard.doc[at]), shard.n_words
    first = np.cumsum(words + 1) - words - 1
    count = words[docs]
    # The hit documents' words, then the items'; ends and words that the shard lacks equal nothing.
    places = _spread(first[docs], count + 1)
    own = np.append(shard.word[places], np.zeros(1, np.int64))
    spans = _spread(test.line_start[items], test.line_length[items])
    behind = np.repeat(np.arange(len(items)), test.line_length[items])
    other = np.full(len(spans) + len(items), -1, np.int64)
    there = np.arange(len(spans)) + behind
    other[there] = line[spans]
    symbols = np.append(own, other)
    lone = np.flatnonzero(symbols <= 0)
    symbols[lone] = -1 - np.arange(len(lone))
    ranks = Ranks(symbols, int(test.line_length[items].max()))
    order = np.argsort(ranks.levels[-1], kind="stable")
    slot = np.empty(len(order), np.int64)
    slot[order] = np.arange(len(order))
    tests = np.zeros(len(symbols), bool)
    tests[len(own) + there] = True
    item_of = np.zeros(len(symbols), np.int64)
    item_of[len(own) + there] = items[behind]
    sorted_tests = order[tests[order]]
    here = np.searchsorted(places, at)
    after = np.cumsum(tests[order])[slot[here]]  # test suffixes that sort before
    none = len(sorted_tests)
    length = np.zeros(len(here), np.int64)
    for neighbour in (after - 1, after):
        ok = (neighbour >= 0) & (neighbour < none)
        length[ok] = np.maximum(length[ok], ranks.common(here[ok], sorted_tests[neighbour[ok]]))
    doc = shard.doc[at]
    by = np.lexsort((at, -length, doc))
    by = by[np.append(True, doc[by][1:] != doc[by][:-1])]
    best, size, middle = here[by], length[by], after[by]
    # The test suffixes with a match as long stand together; of their items the first counts.
    low, high = np.zeros(len(by), np.int64), middle.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        far = ranks.common(best[open_], sorted_tests[mid]) < size[open_]
        low[open_[far]], high[open_[~far]] = mid[far] + 1, mid[~far]
    left, low, high = low, middle.copy(), np.full(len(by), none)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        near = ranks.common(best[open_], sorted_tests[mid]) >= size[open_]
        low[open_[near]], high[open_[~near]] = mid[near] + 1, mid[~near]
    names = np.append(item_of[sorted_tests], len(test.items))
    item = np.minimum.reduceat(names, np.stack([left, low], 1).ravel())[::2]
    return doc[by], at[by], size, item


def search(shard: Shard, test: Suffixes, step: int = 200_000):
    """In one shard: covered words, pairs of document and class of items, and each document's longest match (length, first word, item)."""
    n, docs, classes = len(shard.word), len(shard.n_words), max(1, len(test.classes))
    covered, longest = np.zeros(n + 1, np.int64), np.zeros((docs, 3), np.int64)
    begins = np.cumsum(shard.n_words + 1) - shard.n_words - 1
    found_pairs, whole = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if not n or not len(test.windows):
        return covered[:n] > 0, np.empty((0, 2), np.int64), longest
    own = np.array([shard.ids.get(w, -1) for w in test.words] + [-1], np.int64)
    for k in range(0, len(test.windows), step):
        lengths = test.lengths[k : k + step]
        lo, hi = shard.ranges(own[test.windows[k : k + step]], lengths)
        found = np.flatnonzero(hi > lo)
        window = np.repeat(found, (hi - lo)[found])
        at = shard.order[_spread(lo[found], (hi - lo)[found])]
        covered += np.bincount(at, minlength=n + 1) - np.bincount(at + lengths[window], minlength=n + 1)
        held = np.unique(shard.doc[at] * len(test.windows) + window + k)
        doc, window_of = held // len(test.windows), held % len(test.windows)
        found_pairs.append(np.unique(doc * classes + test.class_of[window_of]))
        whole.append(at[lengths[window] == test.window])
        # Short items: the whole item is the match.
        for size in np.unique(lengths[window]).tolist():
            if size < test.window:
                some = lengths[window] == size
                first_item = test.least_item[test.class_of[window[some] + k]]
                by = np.lexsort((first_item, at[some]))[::-1]
                place, who = at[some][by], first_item[by]
                fresh = size > longest[shard.doc[place], 0]
                place, who = place[fresh], who[fresh]
                longest[shard.doc[place]] = np.stack([np.full(len(place), size), place - begins[shard.doc[place]], who], 1)
                # Later rows win in an assignment; they come last place first, so the first stays.
    pairs = np.unique(np.concatenate(found_pairs))
    at = np.unique(np.concatenate(whole))
    if len(at):
        long = test.items_in(np.unique(pairs % classes).tolist())
        long = long[test.line_length[long] >= test.window]
        doc, place, size, item = longest_from(shard, test, own[test.line_words], at, long)
        longest[doc] = np.stack([size, place - begins[doc], item], 1)
    return np.cumsum(covered[:n]) > 0, np.stack([pairs // classes, pairs % classes], 1), longest


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_chars: int) -> list:
    """Broadcasts of the items' suffixes, block_chars characters each at most but for one longer item; the driver holds one block."""
    context, out, rows, chars = benchmark.sparkSession.sparkContext, [], [], 0
    for row in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).sort(id_col, text_col).toLocalIterator():
        if rows and chars + len(row[1]) > block_chars:
            out.append(context.broadcast(Suffixes(rows, window)))
            rows, chars = [], 0
        rows.append((row[0], row[1]))
        chars += len(row[1])
    return [*out, context.broadcast(Suffixes(rows, window))] if rows else out


def _blocks_in_turn(parts: list):
    """The values of broadcasts, of which a worker keeps none but a single one."""
    for part in parts:
        yield part.value
        if len(parts) > 1:
            part.__dict__.pop("_value", None)  # else every block that was read stays in memory


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("longest_match", T.LongType()),
    T.StructField("longest_at", T.LongType()),
    T.StructField("longest_item", T.StringType()),
]


def _scan(docs: DataFrame, benchmark: DataFrame, window: int, id_col: str, text_col: str, block_chars: int, shard_chars: int, keep=None) -> DataFrame:
    parts = blocks(benchmark, id_col, "text", window, block_chars)

    def make():
        def find(texts):
            shard = Shard(texts, window)
            hit = np.zeros(len(shard.word), bool)
            items: list[list] = [[] for _ in texts]
            merged: dict[tuple, list] = {(): []}
            longest = np.zeros((len(texts), 2), np.int64)
            best: list = [None] * len(texts)
            for test in _blocks_in_turn(parts):
                covered, pairs, far = search(shard, test)
                hit |= covered
                for d in np.flatnonzero(far[:, 0] > longest[:, 0]).tolist():
                    longest[d], best[d] = far[d, :2], test.items[far[d, 2]]
                # Texts with the same classes share one list of ids.
                lists: dict[tuple, list] = {}
                for d, rows in itertools.groupby(pairs.tolist(), lambda x: x[0]):
                    own = tuple(c for _, c in rows)
                    if own not in lists:
                        lists[own] = sorted({test.items[i] for i in test.items_in(list(own)).tolist()} - {None})
                    items[d].append(lists[own])
            n_hit = np.bincount(shard.doc[hit & (shard.word > 0)], minlength=len(texts))
            for d, own in enumerate(items):
                key = tuple(map(id, own))
                if key not in merged:
                    merged[key] = own[0] if len(own) == 1 else sorted(set().union(*own))
                items[d] = merged[key]
            return [shard.n_words, n_hit, items, longest[:, 0], [a if n else None for n, a in longest.tolist()], best]

        return find

    return with_text_columns(docs, make, FIELDS, text_col, keep, shard_chars)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text", block_chars: int = 4_000_000, shard_chars: int = 2_000_000) -> DataFrame:
    """Adds n_words, n_hit (words in a window's occurrence), item_ids (items with an occurring window) and the longest verbatim match (longest_match words from word longest_at on, of longest_item) to every document."""
    return _scan(docs, benchmark, window, id_col, text_col, block_chars, shard_chars)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text", block_chars: int = 4_000_000, shard_chars: int = 2_000_000) -> DataFrame:
    """The documents, unchanged, in which no window occurs."""
    return _scan(packed(docs, text_col), benchmark, window, id_col, text_col, block_chars, shard_chars, lambda new: [n == 0 for n in new[1]]).select("row.*")
