"""Byte-level BPE by monoid tree reduction.

A text is halved down to small leaves, which the tiktoken library encodes. Two
neighbours are joined by encoding anew a window round their boundary. The window grows
on either side to the next stable cut: a place where a non-space stands before a blank
or line feed. No match of the split pattern holds a space after a non-space, so every
encoding of the text has a token boundary there and the tokens outside the window stay.
Decoding concatenates the tokens' bytes up the same tree.

Defined results: a null text is encoded like an empty one, to no tokens; null ids decode
to empty bytes. A run without a stable cut (one giant word) makes the window as long as
that run. Repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chapterloom.llm.common import with_text_columns

LEAF_CHARS = 2048
_CUT = re.compile(r"\S(?=[ \n])")
_built: dict = {}


def read_ranks(path: str, limit_bytes: int = 64_000_000) -> dict[bytes, int]:
    """The vocabulary file's ranks. It goes to all tasks, so a file beyond limit_bytes raises rather than fill them."""
    with open(path, "rb") as file:
        data = file.read(limit_bytes + 1)
    if len(data) > limit_bytes:
        raise ValueError(f"{path} is larger than {limit_bytes} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def _encoding(shared, pattern: str):
    """tiktoken's encoder; one for each worker process and vocabulary."""
    key = (shared.id if hasattr(shared, "id") else id(shared), pattern)
    if key not in _built:
        import tiktoken

        _built.clear()
        _built[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=getattr(shared, "value", shared), special_tokens={})
    return _built[key]


def encode_tree(text: str, encode, leaf: int = LEAF_CHARS) -> list[int]:
    """The ids of a text: equal to encode(text) for a pattern with stable cuts."""

    def left_cut(lo: int, mid: int) -> int:
        width = 32
        while True:
            start = max(lo, mid - width)
            last = None
            for last in _CUT.finditer(text, start, mid):
                pass
            if last is not None:
                return last.end()
            if start == lo:
                return lo
            width *= 4

    def right_cut(mid: int, hi: int) -> int:
        width = 32
        while True:
            stop = min(hi, mid + width)
            found = _CUT.search(text, mid, stop)
            if found:
                return found.end()
            if stop == hi:
                return hi
            width *= 4

    def node(lo: int, hi: int) -> list[int]:
        if hi - lo <= leaf:
            return encode(text[lo:hi])
        mid = (lo + hi) // 2
        left, right = node(lo, mid), node(mid, hi)
        if _CUT.match(text, mid - 1, mid + 1):
            return left + right
        start, stop = left_cut(lo, mid), right_cut(mid, hi)
        gone = len(encode(text[start:mid]))
        return left[: len(left) - gone] + encode(text[start:stop]) + right[len(encode(text[mid:stop])) :]

    return node(0, len(text))


def decode_tree(ids: list[int], decode, leaf: int = LEAF_CHARS) -> bytes:
    """The ids' bytes, concatenated up the tree."""
    if len(ids) <= leaf:
        return decode(ids)
    mid = len(ids) // 2
    return decode_tree(ids[:mid], decode, leaf) + decode_tree(ids[mid:], decode, leaf)


def _coded(rows: DataFrame, ranks_path: str, pattern: str, column: str, steps, fields: list[T.StructField], leaf: int) -> DataFrame:
    """Adds fields by steps(encoding) -> function from a list of the column's values to a list for each field. The ranks are broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    return with_text_columns(rows, lambda: steps(_encoding(shared, pattern)), fields, column)


def _encoded(encoding, leaf: int):
    return lambda texts: [encode_tree(x, encoding.encode_ordinary, leaf) if x else [] for x in texts]


def _decoded(encoding, leaf: int):
    return lambda ids: [decode_tree(x, encoding.decode_bytes, leaf) if x else b"" for x in ids]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", leaf: int = LEAF_CHARS) -> DataFrame:
    """Adds the array of ids to every row. The ranks (a vocabulary file, bounded by read_ranks) are broadcast."""
    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    return _coded(docs, ranks_path, pattern, text_col, lambda e: lambda texts: [_encoded(e, leaf)(texts)], fields, leaf)


def decode_ids(tokens: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded", leaf: int = LEAF_CHARS) -> DataFrame:
    """Adds the bytes that the ids stand for (binary: ids may cut a character)."""
    return _coded(tokens, ranks_path, pattern, ids_col, lambda e: lambda ids: [_decoded(e, leaf)(ids)], [T.StructField(out_col, T.BinaryType())], leaf)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", out_col: str = "decoded", leaf: int = LEAF_CHARS) -> DataFrame:
    """Adds the ids and the bytes that they decode to, in one pass."""
    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(out_col, T.BinaryType())]

    def steps(encoding):
        encode, decode = _encoded(encoding, leaf), _decoded(encoding, leaf)

        def both(texts):
            ids = encode(texts)
            return [ids, decode(ids)]

        return both

    return _coded(docs, ranks_path, pattern, text_col, steps, fields, leaf)


def digests(decoded: DataFrame) -> DataFrame:
    """n_tokens and the SHA-256 of the ids and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
