"""Words of many texts at once, as 64-bit hashes, by array operations alone.

A word is a run of bytes other than blanks (0x20, 0x09-0x0D) of the text in UTF-8, with A-Z lower-cased.
Its hash sums a mixed number for each byte and its place in the word, taken from running sums over a piece of the texts;
it depends on the word only. Places are mixed in, not multiplied by: no polynomial, as words like Thue and Morse's are roots of many
of those modulo 2**64. Pieces are cut between words, so memory follows PIECE or the longest word.
"""

from __future__ import annotations

import numpy as np

#: Bytes that are taken at once.
PIECE = 250_000
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that scatters 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _cuts(data: np.ndarray, piece: int):
    """Spans of about piece bytes that end in a blank each; data ends in one."""
    lo = 0
    while lo < len(data):
        hi = min(lo + piece, len(data))
        step = piece
        while not _BLANK[data[hi - 1]]:
            blanks = np.flatnonzero(_BLANK[data[hi : hi + step]])
            hi = hi + int(blanks[0]) + 1 if len(blanks) else min(hi + step, len(data))
            step *= 2
        yield lo, hi
        lo = hi


def word_hashes(texts: list[str | None], piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts in order, and how many words each text has; a null text has none."""
    parts = [x.encode("utf-8", "surrogatepass") if x else b"" for x in texts]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    del parts
    starts, hashes = [], []
    for lo, hi in _cuts(data, piece):
        own = data[lo:hi]
        edge = np.flatnonzero(np.diff(_BLANK[own], prepend=True))
        if not len(edge):
            continue
        start, end = edge[::2], edge[1::2]
        own, start, end, lo = own[start[0] :], start - start[0], end - start[0], lo + int(start[0])
        place = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
        sums = np.cumsum(mix(_LOWER[own] + np.uint64(1) + (place.astype(np.uint64) << np.uint64(9))))
        before = np.where(start > 0, sums[start - 1], np.uint64(0))
        hashes.append(mix(sums[end - 1] - before))
        starts.append(start + lo)
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    at = np.concatenate(starts) if starts else np.empty(0, np.int64)
    first = np.cumsum(size + 1) - size - 1
    return flat, np.diff(np.append(np.searchsorted(at, first), len(at)))
