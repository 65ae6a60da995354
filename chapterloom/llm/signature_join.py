"""N-gram Jaccard join with signature trees.

A text's set holds its distinct word shingles (64-bit hashes). Two texts link where
100 * |intersection| >= percent * |union|; the result is each text's component.

1. Equal sets collapse to one node. Sets are told apart by 128 bits of their digests; a node's name has 64 bits, of
   which other ones are taken where sets would get the same name.
2. A link needs a shared shingle among both sets' first ones in one global order
   (prefix filter). Shingles that many texts share come last in that order, which only
   affects speed. Representatives without a shared prefix shingle have no link, and the
   prefixes of a link share more the closer the sets' sizes are.
3. Rounds: representatives with the same minimum hash, in chunks of bounded size, form
   a signature tree. Its nodes hold the OR of their texts' token bitmaps and a size
   range; a dual traversal drops node pairs whose greatest possible overlap is too
   small, or which are connected already. What is left is compared exactly.
4. Sweep: texts that share a prefix shingle but are in different components go
   through a tree of that shingle (chunk pairs, if it is a frequent one). Survivors among large
   sets are held against wider bitmaps, and what is left is compared exactly. A shingle with very many survivors first gives one pair for each two
   components, and a second sweep takes all that are still apart, so no link between
   different components is lost.

Defined results: null and empty texts, and texts without a word, have an empty set, no
link and their own id as component. Fewer words than a shingle make one shingle of the
whole sequence. A row without a doc_id takes part in no link; its component is that of rows with an
equal set, else null. Texts of one doc_id count as linked with each other, empty ones too.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chapterloom.llm.common import in_batches, most_frequent, packed, runs, store
from chapterloom.llm.words import mix, word_hashes
from chapterloom.sources.scratch import discard

#: Bits of a token bitmap.
BITS = 1024
#: Texts of a key up to which a tree isn't worth while.
SMALL = 8
_EMPTY = np.empty(0, np.uint64)


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes."""

    def __init__(self, words: int = 5):
        self.k = words
        odd = [int.from_bytes(hashlib.blake2b(f"shingle {j}".encode(), digest_size=8).digest(), "little") | 1 for j in range(words + 1)]
        self.odd = np.array(odd, np.uint64)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        flat, counts = word_hashes(texts)
        n = max(0, len(flat) - self.k + 1)
        sums = np.zeros(n, np.uint64)
        for j in range(self.k):
            sums += flat[j : j + n] * self.odd[j]
        hashes = mix(sums)
        out, at = [], 0
        for m in counts.tolist():
            if m >= self.k:
                own = np.sort(hashes[at : at + m - self.k + 1])
                out.append(own[np.append(True, own[1:] != own[:-1])])
            elif m:
                terms = np.append(flat[at : at + m] * self.odd[:m], self.odd[self.k :] * np.uint64(m))
                out.append(mix(terms.sum(keepdims=True, dtype=np.uint64)))
            else:
                out.append(_EMPTY)
            at += m
        return out


#: Names that a set can get.
NAMES = 64


def digest_of(tokens: np.ndarray) -> tuple[int | None, int | None]:
    """A set's digest as two signed 64-bit numbers; nulls for an empty set."""
    return struct.unpack("<qq", hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()) if len(tokens) else (None, None)


class Naming:
    """Names of sets: the low half of the digest, or where that is taken, the halves combined in the next of NAMES - 1 ways.

    taken: names that several sets would have had, so none has them; expected are n * n / 2**65 of n sets. bits: of a name, fewer in tests only.
    """

    def __init__(self, taken: frozenset[int] = frozenset(), bits: int = 64):
        self.taken, self.mask = taken, -1 if bits == 64 else (1 << bits) - 1

    def __call__(self, tokens: np.ndarray) -> int | None:
        low, high = digest_of(tokens)
        if low is None:
            return None
        whole = high & (1 << 64) - 1
        for k in range(NAMES):
            name = low
            if k:
                turned = (whole << k - 1 | whole >> 65 - k) & (1 << 64) - 1
                name ^= turned - (1 << 64) if turned >> 63 else turned
            if name & self.mask not in self.taken:
                return name & self.mask
        raise ValueError("all names of a set are taken")

    def column(self, low: str = "low", high: str = "high") -> Column:
        """The same name from columns with a digest's halves."""
        ways = [F.col(low)]
        if self.taken:
            turned = [F.shiftleft(high, k - 1).bitwiseOR(F.shiftrightunsigned(high, 65 - k)) for k in range(1, NAMES)]
            ways += [F.col(low).bitwiseXOR(x) for x in turned]
        ways = [x.bitwiseAND(F.lit(self.mask)) for x in ways]
        return F.coalesce(*[F.when(~x.isin(*self.taken), x) for x in ways]) if self.taken else ways[0]


def named_sets(described: DataFrame, bits: int = 64) -> tuple[DataFrame, Naming]:
    """The stored rows of describe() with the column node, and the naming under which no two sets share a node."""
    taken: frozenset[int] = frozenset()
    while True:
        naming = Naming(taken, bits)
        rows = described.withColumn("node", naming.column())
        halves = rows.where("n > 0").groupBy("node").agg(*[f(c).alias(f"{c}{k}") for c in ("low", "high") for k, f in enumerate((F.min, F.max))])
        clashes = frozenset(r.node for r in halves.where("low0 <> low1 or high0 <> high1").select("node").toLocalIterator())
        if not clashes:
            return rows, naming
        taken |= clashes


def _per_text(docs: DataFrame, make, schema: str, chunk_chars: int = 500_000) -> DataFrame:
    """docs has an id and a text. make() gives a function from ids and texts to record batches."""

    def run(batches):
        function = make()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in runs(texts, chunk_chars):
                yield from function(ids[lo:hi], texts[lo:hi])

    return in_batches(docs, run, schema)


# ---------------------------------------------------------------- sets and keys


def describe(docs: DataFrame, words: int, repeated: int = 3) -> DataFrame:
    """A row (doc_id, n, low, high) for each text, the halves of its set's digest, and rows (token, times) for tokens that several texts of a chunk share."""

    def make():
        shingles = Shingler(words)
        names, types = ["doc_id", "n", "low", "high", "token", "times"], [pa.int64()] * 6

        def rows(*columns):
            m = max(len(c) for c in columns if c is not None)
            return pa.RecordBatch.from_arrays([pa.nulls(m, t) if c is None else pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def one(ids, texts):
            sets = shingles(texts)
            low, high = zip(*map(digest_of, sets))
            yield rows(ids, [len(x) for x in sets], low, high, None, None)
            token, times = np.unique(np.concatenate(sets), return_counts=True)
            often = times >= repeated
            if often.any():
                yield rows(None, None, None, None, token[often].view(np.int64), times[often])

        return one

    return _per_text(docs, make, "doc_id long, n long, low long, high long, token long, times long")


def frequent(described: DataFrame, least: int = 48, most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shared tokens (most at most, which is what is broadcast) and their counts, by token. They only order tokens."""
    rows = store(described.where("token is not null").groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= least), "frequent")
    rows = most_frequent(rows, most).toArrow()
    token, times = rows.column("token").to_numpy().view(np.uint64), rows.column("times").to_numpy()
    by = np.argsort(token)
    return token[by], times[by]


def prefix_length(n: int, percent: int) -> int:
    """Of how many first tokens a set shares one at least with each set that it links with."""
    return n - -(-percent * n // 100) + 1


def prefixes(docs: DataFrame, words: int, percent: int, heavy, naming: Naming) -> DataFrame:
    """(doc_id, n, node, prefix) with each text's first tokens in the global order: rare ones by hash, then frequent ones by count."""

    def make():
        shingles, (token, times) = Shingler(words), heavy.value

        def one(ids, texts):
            rows, seen = [], set()
            for i, x in zip(ids, shingles(texts)):
                node = naming(x)
                if i is None or node is None or (node, i) in seen:
                    continue
                seen.add((node, i))
                long = prefix_length(len(x), percent)
                if len(token):
                    at = np.searchsorted(token, x)
                    at[at == len(token)] = 0
                    often = token[at] == x
                    first = x[~often][:long]
                    if len(first) < long:
                        rest, count = x[often], times[at[often]]
                        first = np.concatenate([first, rest[np.lexsort((rest, count))][: long - len(first)]])
                else:
                    first = x[:long]
                rows.append((i, len(x), node, first.view(np.int64)))
            if rows:
                ids, n, nodes, first = zip(*rows)
                offsets = np.cumsum([0, *map(len, first)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(first)))], names=["doc_id", "n", "node", "prefix"])

        return one

    return _per_text(docs, make, "doc_id long, n long, node long, prefix array<long>")


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BITS // 64 words for each set; a token sets the bit that its low bits name."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    bits = (np.concatenate(sets) & np.uint64(BITS - 1)).astype(np.int64) if len(sets) else np.empty(0, np.int64)
    marks = np.zeros((len(sets), BITS), bool)
    marks[rows, bits] = True
    return np.packbits(marks, axis=1, bitorder="little").view(np.uint64)


def full_sets(docs: DataFrame, words: int, functions: int, naming: Naming) -> DataFrame:
    """(rep, n, extra, bits, tokens, h0, h1, ...): whole sets with bitmaps, the tokens that share a bit, and minimum hashes."""
    names = [f"h{j}" for j in range(functions)]

    def make():
        shingles = Shingler(words)
        seeds = [mix(np.array([j + 1], np.uint64))[0] for j in range(functions)]

        def one(ids, texts):
            found = [(naming(x), x) for x in shingles(texts) if len(x)]
            for lo in range(0, len(found), 128):
                reps, sets = zip(*found[lo : lo + 128])
                marks, n = bitmaps(sets), np.array([len(x) for x in sets])
                starts = np.cumsum([0, *n[:-1]])
                flat = np.concatenate(sets)
                least = [np.minimum.reduceat(mix(flat ^ s), starts).view(np.int64) for s in seeds]
                yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(n), pa.array(n - np.bitwise_count(marks).sum(1, dtype=np.int64)), pa.array([x.tobytes() for x in marks], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary()), *map(pa.array, least)], names=["rep", "n", "extra", "bits", "tokens", *names])

        return one

    return _per_text(docs, make, "rep long, n long, extra long, bits binary, tokens binary, " + ", ".join(f"{x} long" for x in names))


# ---------------------------------------------------------------- the tree


def common_prefix(total, larger, percent: int):
    """How many shingles the prefixes of two linked sets share at least, from both sizes' sum and the larger size.

    The set whose prefix ends first in the global order has in it at most n - overlap shingles
    that the other set lacks; the others are in the other's prefix as well.
    """
    return 1 - (-percent * total // (100 + percent)) + (-percent * larger // 100)


def may_link(level: list[np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of a level's nodes (or texts) may hold a link between different components."""
    bits, least, most, extra, low, high, firsts = level
    ok = (low[i] != high[i]) | (low[j] != high[j]) | (low[i] != low[j])
    ok &= (100 * most[i] >= percent * least[j]) & (100 * most[j] >= percent * least[i])
    ok &= np.minimum(firsts[i], firsts[j]) >= common_prefix(least[i] + least[j], np.maximum(most[i], most[j]), percent)
    at = np.flatnonzero(ok)
    for lo in range(0, len(at), 50_000):
        a = at[lo : lo + 50_000]
        shared = np.bitwise_count(bits[i[a]] & bits[j[a]]).sum(1, dtype=np.int64) + np.minimum(extra[i[a]], extra[j[a]])
        shared = np.minimum(shared, np.minimum(most[i[a]], most[j[a]]))
        ok[a] = (100 + percent) * shared >= percent * (least[i[a]] + least[j[a]])
    return ok


class SignatureTree:
    """Texts in order of size under nodes of FAN children each; see the module's text.

    Four children make fewer comparisons of bitmaps in all than eight or two, three still 2 % fewer (README has the counts).
    """

    FAN = 4

    def __init__(self, bits: np.ndarray, n: np.ndarray, extra: np.ndarray, comp: np.ndarray, percent: int, shared: np.ndarray | None = None):
        """shared: how many of each set's prefix shingles are in another set's prefix."""
        self.percent, self.order = percent, np.argsort(n, kind="stable")
        level = [x[self.order] for x in (bits, n, n, extra, comp, comp, n if shared is None else shared)]
        self.levels = [level]
        while len(level[0]) > self.FAN:
            starts = np.arange(0, len(level[0]), self.FAN)
            level = [f.reduceat(x, starts) for f, x in zip((np.bitwise_or, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum, np.maximum), level)]
            self.levels.append(level)

    def pairs(self, limit: int = 200_000):
        """Pairs (i, j) of texts that may link, in runs of bounded length; depth first."""
        i, j = np.triu_indices(len(self.levels[-1][0]))
        stack = [(len(self.levels) - 1, i, j)]
        while stack:
            depth, i, j = stack.pop()
            if len(i) > limit:
                stack += [(depth, i[limit:], j[limit:]), (depth, i[:limit], j[:limit])]
                continue
            if depth == 0:
                i, j = i[i < j], j[i < j]
            ok = may_link(self.levels[depth], i, j, self.percent)
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            if depth == 0:
                yield self.order[i], self.order[j]
                continue
            size, step = len(self.levels[depth - 1][0]), np.arange(self.FAN)
            a = np.repeat(i[:, None] * self.FAN + step, self.FAN, axis=1).ravel()
            b = np.tile(j[:, None] * self.FAN + step, (1, self.FAN)).ravel()
            ok = (a < size) & (b < size) & (a <= b)
            stack.append((depth - 1, a[ok], b[ok]))


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    return (100 + percent) * overlap(x, y) >= percent * (len(x) + len(y))


def spanning_links(sets: list[np.ndarray], comp: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Exact links that connect whatever is linked among these sets, none between what is connected already."""
    label, found = comp.copy(), []
    tree = SignatureTree(bitmaps(sets), np.array([len(x) for x in sets]), np.array([len(x) for x in sets]) - np.bitwise_count(bitmaps(sets)).sum(1, dtype=np.int64), comp, percent)
    for i, j in tree.pairs():
        while len(i):
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            for a, b in zip(i[:64].tolist(), j[:64].tolist()):
                if label[a] != label[b] and linked(sets[a], sets[b], percent):
                    found.append((a, b))
                    label[label == max(label[a], label[b])] = min(label[a], label[b])
            i, j = i[64:], j[64:]
    return found


def tree_round(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) from rows (part, chunk, rep, comp, tokens): one tree for each part and chunk."""

    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        reps = table.column("rep").to_numpy()
        pairs = spanning_links(sets, table.column("comp").to_numpy(), percent)
        return pa.table({"a": pa.array([reps[i] for i, _ in pairs], pa.int64()), "b": pa.array([reps[j] for _, j in pairs], pa.int64())})

    return members.groupBy("part", "chunk").applyInArrow(run, "a long, b long")


# ---------------------------------------------------------------- components


def relabel(edges: DataFrame, comps: DataFrame | None) -> DataFrame | None:
    """(rep, comp) for every representative that has a link, after adding edges (a, b); comps as before without edges.

    Labels fall to the least neighbour's, then follow their own label (pointer jumping), until none changes.
    """
    if comps is not None:
        edges = named(named(edges, comps, "a"), comps, "b")
    edges = store(edges.where("a <> b").distinct(), "links")
    if edges.isEmpty():
        return comps
    both = store(edges.union(edges.select("b", "a")), "arcs")
    label = store(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "label")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), F.col("comp").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        lower = label.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "c").alias("comp"))
        jump = label.select(F.col("node").alias("comp"), F.col("comp").alias("then"))
        now = store(lower.join(jump, "comp", "left").select("node", "was", F.least("comp", F.coalesce("then", "comp")).alias("comp")), "label")
        label = now.select("node", "comp")
        if now.where("was <> comp").isEmpty():
            break
    if comps is None:
        return store(label.withColumnRenamed("node", "rep"), "comps")
    moved = comps.join(label.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("rep", F.coalesce("to", "comp").alias("comp"))
    fresh = label.withColumnRenamed("node", "rep").join(comps, "rep", "left_anti")
    return store(moved.unionByName(fresh), "comps")


def named(edges: DataFrame, comps: DataFrame, side: str) -> DataFrame:
    """edges with a representative replaced by its component."""
    other = "b" if side == "a" else "a"
    return edges.join(comps.withColumnRenamed("rep", side), side, "left").select(F.coalesce("comp", side).alias(side), other).select("a", "b")


def labelled(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """rows with the column comp: the representative itself where it has no link yet."""
    if comps is None:
        return rows.withColumn("comp", F.col("rep"))
    return rows.join(comps, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))


# ---------------------------------------------------------------- the sweep


def shared_key_pairs(rows: DataFrame, percent: int, limit: int | None) -> DataFrame:
    """Pairs (key, part, a, b, m, n, more) of different components that may link, from rows (key, part, rep, n, extra, firsts, comp, bits); m and n are the sets' sizes.

    A key with more than ``limit`` such pairs gives one pair for each two components instead, with more = true.
    """

    def run(batches):
        held = None

        def pairs_of(table: pa.Table):
            key = table.column("key").to_numpy()
            part = table.column("part").to_numpy()
            new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])))
            rep, n, extra, comp, firsts = (table.column(c).to_numpy() for c in ("rep", "n", "extra", "comp", "firsts"))
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(rep), BITS // 64)
            ends = np.append(new[1:], len(rep))
            end_of = np.repeat(ends, ends - new)
            few = end_of - np.repeat(new, ends - new) <= SMALL
            whole = [bits, n, n, extra, comp, comp, firsts]
            for d in range(1, SMALL):
                i = np.flatnonzero(few[:-d] & (np.arange(d, len(rep)) < end_of[:-d])) if len(rep) > d else np.empty(0, np.int64)
                i = i[may_link(whole, i, i + d, percent)]
                if len(i):
                    yield key[i], part[i], rep[i], rep[i + d], n[i], n[i + d], False
            large = ends - new > SMALL
            for lo, hi in zip(new[large].tolist(), ends[large].tolist()):
                if (comp[lo:hi] == comp[lo]).all():
                    continue
                s = slice(lo, hi)
                found, count, best = [], 0, {}
                for i, j in SignatureTree(bits[s], n[s], extra[s], comp[s], percent, firsts[s]).pairs():
                    i, j = i + lo, j + lo
                    count += len(i)
                    if limit is None:
                        yield key[lo], part[lo], rep[i], rep[j], n[i], n[j], False
                        continue
                    if count <= limit:
                        found.append((i, j))
                    low, high = np.minimum(comp[i], comp[j]), np.maximum(comp[i], comp[j])
                    for at in np.unique(np.stack([low, high], 1), axis=0, return_index=True)[1].tolist():
                        best.setdefault((int(low[at]), int(high[at])), (int(i[at]), int(j[at])))
                if limit is None or not count:
                    continue
                i, j = (np.concatenate(x) for x in zip(*found)) if count <= limit else (np.array(x) for x in zip(*best.values()))
                yield key[lo], part[lo], rep[i], rep[j], n[i], n[j], count > limit

        def out(table: pa.Table):
            found = list(pairs_of(table))
            if found:
                size = [len(x[2]) for x in found]
                columns = [np.concatenate([np.broadcast_to(x[k], len(x[2])) for x in found]) for k in (0, 1)]
                a, b, m, n = (np.concatenate([x[k] for x in found]) for k in (2, 3, 4, 5))
                columns += [np.minimum(a, b), np.maximum(a, b), m, n, np.repeat([x[6] for x in found], size)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "part", "a", "b", "m", "n", "more"])

        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            key, part = table.column("key").to_numpy(), table.column("part").to_numpy()
            last = (key == key[-1]) & (part == part[-1])
            cut = int(np.argmax(last))
            if cut:
                yield from out(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield from out(held)

    return in_batches(rows, run, "key long, part long, a long, b long, m long, n long, more boolean")


def sliced(batches, rows: int = 64):
    """Pieces of Arrow batches, so that a task copies few sets at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def wide_bitmap(tokens: np.ndarray) -> np.ndarray:
    """A bitmap of eight bits a token or more (up to 2**20), a power of two."""
    width = 1 << min(20, max(9, (8 * len(tokens) - 1).bit_length()))
    marks = np.zeros(width, bool)
    marks[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap as if its tokens had set bits in one of so many words."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def narrowed(pairs: DataFrame, sets: DataFrame, percent: int, bucket_tokens: int = 4_000_000) -> DataFrame:
    """The pairs of large sets (stored: key, part, a, b) that wide bitmaps don't rule out.

    A pair belongs to one of the keys it shares; a bucket of keys gets each of its sets' bitmaps once, not once a pair.
    """
    members = pairs.select("key", "part", F.col("a").alias("rep"), "size").union(pairs.select("key", "part", F.col("b").alias("rep"), "size"))
    total = members.groupBy("key", "part", "rep").agg(F.max("size").alias("size")).agg(F.sum("size")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("key", "part"), F.lit(max(1, -(-total // bucket_tokens)))).alias("bucket")
    wanted = store(members.select(bucket, "rep").distinct(), "members")

    def widen(batches):
        for batch in sliced(batches):
            tokens = [np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), batch.column("rep"), pa.array([len(x) for x in tokens], pa.int64()), pa.array([wide_bitmap(x).tobytes() for x in tokens], pa.binary())], names=["bucket", "rep", "n", "bits"])

    wide = in_batches(with_sets(wanted, sets, "rep").select("bucket", "rep", "tokens"), widen, "bucket long, rep long, n long, bits binary")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = dict(zip(right.column("rep").to_pylist(), right.column("n").to_pylist()))
        bits = {r: np.frombuffer(x, np.uint64) for r, x in zip(right.column("rep").to_pylist(), right.column("bits").to_pylist())}
        keep = []
        for a, b in zip(left.column("a").to_pylist(), left.column("b").to_pylist()):
            words = min(len(bits[a]), len(bits[b]))
            x, y = folded(bits[a], words), folded(bits[b], words)
            extra = min(n[a] - int(np.bitwise_count(x).sum()), n[b] - int(np.bitwise_count(y).sum()))
            shared = min(int(np.bitwise_count(x & y).sum()) + extra, n[a], n[b])
            keep.append((100 + percent) * shared >= percent * (n[a] + n[b]))
        return left.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select(bucket, "a", "b").groupBy("bucket").cogroup(wide.groupBy("bucket")).applyInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link."""

    def run(batches):
        for batch in sliced(batches):
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            ok = [linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = with_sets(pairs, sets, "a").select("a", "b", F.col("tokens").alias("x"))
    right = with_sets(pairs, sets, "b").select("a", "b", F.col("tokens").alias("y"))
    return in_batches(left.join(right, ["a", "b"]).select("a", "b", "x", "y"), run, "a long, b long")


def with_sets(rows: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Stored rows with the set of the representative in a column. Few rows are broadcast, so that only their sets move."""
    few = F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows
    return sets.select(F.col("rep").alias(column), "tokens").join(few, column)


# ---------------------------------------------------------------- the join

#: Ids up to which a list of documents is broadcast; beyond, texts are shuffled by id.
BROADCAST_IDS = 400_000


def by_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """docs joined (left_semi or left_anti) with a stored table of ids, which is broadcast only if it is small."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how).select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_ids(described: DataFrame) -> DataFrame | None:
    """doc_id of the ids that come with several texts, stored; None if there are none."""
    sizes = described.where("n is not null and doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("node").alias("full"), F.count(F.lit(1)).alias("times"))
    found = store(sizes.where("low <> high or (full > 0 and full < times)").select("doc_id"), "repeated")
    return None if found.isEmpty() else found


def round_members(known: DataFrame, j: int, chunk_tokens: int, chunk_rows: int) -> DataFrame:
    """(rep, comp, part, chunk) of the rows (rep, n, part, comp) whose part holds different components, in chunks of bounded size.

    Parts with more than one chunk are few and are broadcast, so that no task gets all rows of one; so are all parts if
    they are few.
    """
    groups = known.groupBy("part").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    groups = store(groups.select("part", F.ceil(F.greatest(F.col("total") / chunk_tokens, F.col("rows") / (chunk_rows // 4))).alias("chunks")), "parts")
    if groups.count() <= BROADCAST_IDS:
        chosen = known.join(F.broadcast(groups), "part")
    else:
        large = groups.where("chunks > 1")
        marked = known.join(F.broadcast(large) if large.count() <= BROADCAST_IDS else large, "part", "left")
        one = marked.where("chunks is null").drop("chunks").join(groups.where("chunks = 1"), "part")
        chosen = marked.where("chunks is not null").unionByName(one)
    return chosen.select("rep", "comp", "part", F.pmod(F.xxhash64("rep", F.lit(j)), F.col("chunks")).alias("chunk"))


def components(docs: DataFrame, words: int = 5, percent: int = 75, rounds: int = 3, chunk_tokens: int = 1_000_000, chunk_rows: int = 4096, key_pairs: int = 256, name_bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    described = store(describe(docs, words), "described")
    named_rows, naming = named_sets(described, name_bits)
    heavy = spark.sparkContext.broadcast(frequent(described))
    firsts = prefixes(docs, words, percent, heavy, naming).groupBy(F.col("node").alias("rep")).agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    nodes = store(firsts, "nodes")
    heavy.destroy()
    keys = nodes.select("rep", F.explode("prefix").alias("key"))
    common = keys.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key")
    keys = store(keys.join(common, "key", "left_semi"), "keys")
    # What later steps need of the wide tables is narrow; the wide ones go.
    wide = described, nodes
    described, nodes = store(named_rows.where("n is not null").select("doc_id", "n", "node"), "texts"), store(nodes.select("rep", "doc_id"), "names")
    for table in wide:
        discard(table)
    firsts = store(keys.groupBy("rep").agg(F.count(F.lit(1)).alias("firsts")), "firsts")
    names = [f"h{j}" for j in range(rounds)]
    wanted = store(nodes.select("rep", "doc_id").join(firsts, "rep", "left_semi"), "wanted")
    sets = store(full_sets(by_id(docs, wanted.select("doc_id"), "left_semi"), words, rounds, naming), "sets")
    repeated = repeated_ids(described)
    if sets.count() > wanted.count():  # an id came with several texts, or with the same one again
        every, sets = sets, store(sets.join(wanted, "rep", "left_semi").dropDuplicates(["rep"]), "sets")
        discard(every)

    comps = None
    if repeated is not None:  # an id's texts are one node
        texts = by_id(described.where("node is not null").select("doc_id", "node"), repeated, "left_semi")
        least = texts.groupBy("doc_id").agg(F.min("node").alias("a"))
        comps = relabel(texts.join(least, "doc_id").select("a", F.col("node").alias("b")), comps)
    for j, h in enumerate(names):
        known = labelled(sets.select("rep", "n", F.col(h).alias("part")), comps)
        members = with_sets(store(round_members(known, j, chunk_tokens, chunk_rows), "chosen"), sets, "rep").select("part", "chunk", "rep", "comp", "tokens")
        comps = relabel(tree_round(members, percent), comps)

    narrow = sets.select("rep", "n", "extra", "bits").join(firsts, "rep")
    for limit in (key_pairs, None):
        now = labelled(keys, comps)
        open_ = now.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
        open_ = open_.select("key", F.ceil(F.col("times") / chunk_rows).alias("chunks"))
        # A frequent key's rows go to every pair of chunks that holds their own.
        own = F.pmod(F.xxhash64("rep"), F.col("chunks"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
        rows = now.join(open_, "key").select("key", "rep", "comp", "chunks", own.alias("own"), other.alias("other"))
        rows = rows.select("key", "rep", "comp", (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).alias("part"))
        rows = rows.join(narrow, "rep").repartition("key", "part").sortWithinPartitions("key", "part")
        pairs = shared_key_pairs(rows, percent, limit).groupBy("a", "b").agg(F.min(F.struct("key", "part")).alias("k"), F.count(F.lit(1)).alias("times"), F.max("m").alias("m"), F.max("n").alias("n"), F.max("more").alias("more"))
        # A pair comes once for each shingle that its prefixes share, unless a key gave only some pairs.
        least = F.expr(f"1 + ceil({percent} * (m + n) / {100 + percent}) - ceil({percent} * greatest(m, n) / 100)")
        pairs = pairs.where(F.col("more") | (F.col("times") >= least))
        pairs = store(pairs.select("a", "b", "k.key", "k.part", F.greatest("m", "n").alias("size"), "more"), "pairs")
        large = F.col("size") > BITS // 2
        likely = pairs.where(~large).select("a", "b").unionByName(narrowed(pairs.where(large), sets, percent))
        comps = relabel(verified(store(likely, "likely"), sets, percent), comps)
        if pairs.where("more").isEmpty():
            break

    # Stored, so that Spark may split a set that very many copies share.
    named_nodes = labelled(nodes.select("rep", "doc_id"), comps)
    least = named_nodes.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_node = store(named_nodes.join(least, "comp").select(F.col("rep").alias("node"), "component_id"), "components")
    found = described.where("n is not null").select("doc_id", "n", "node").join(of_node, "node", "left")
    found = found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    if repeated is None:
        return found
    own = by_id(found, repeated, "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("least"))
    return found.join(own, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """The documents, unchanged, that have the least doc_id of their component.

    Of rows that repeat a doc_id one stays, the least by its columns as JSON; rows without a doc_id all stay.
    """
    found = store(components(docs, words, percent).select("doc_id", "component_id"), "components")
    gone = store(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    kept = by_id(docs, gone, "left_anti")
    twice = store(found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    packs = packed(by_id(kept, twice, "left_semi"), "doc_id").groupBy("doc_id").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return by_id(kept, twice, "left_anti").unionByName(packs.select("row.*"))
