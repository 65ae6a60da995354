"""Finding all terms of a book in a text at once.

One automaton for each book and task takes a text in one pass, however many terms the book has and whatever they are
made of. An occurrence counts where the term stands on its own: no Hangul before it, and after it no Hangul or a particle. The
columns below are Arrow functions: rows carry their book's terms as arrays, which a task looks at once a book.

Positions are 0-based places in the book's array of terms. Null texts, and books without terms, have none; an empty term
stands where no Hangul is on its left and no Hangul, or a particle, on its right.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import functions as F

from chapterloom.functions.text import PARTICLES, STOP_WORDS

#: Books whose automata a task keeps.
BOOKS = 64

_HANGUL = re.compile("[가-힣]")
_AFTER = re.compile("(?![가-힣])|" + "|".join(PARTICLES))
_EMPTY = re.compile("(?<![가-힣])(?:(?![가-힣])|" + "|".join(PARTICLES) + ")")
_WORD = re.compile(r"[0-9a-z\-]+")


class Finder:
    """The terms of one book."""

    def __init__(self, keys: list[str | None]):
        self.keys, self.places = keys, {}
        for i, key in enumerate(keys):
            if key is not None:
                self.places.setdefault(key, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for key in self.places:
            if key:
                self.automaton.add_word(key, key)
        if len(self.automaton):
            self.automaton.make_automaton()
        self._over: list[list[int]] | None = None

    def _matches(self, text: str) -> Iterator[tuple[int, str]]:
        return self.automaton.iter(text) if len(self.automaton) and text else iter(())

    def standing(self, text: str | None) -> list[int]:
        """Places of the terms that stand in the text on their own, in order."""
        if text is None:
            return []
        found = {""} if "" in self.places and _EMPTY.search(text) else set()
        for last, key in self._matches(text):
            begin = last + 1 - len(key)
            if key not in found and not (begin and _HANGUL.match(text, begin - 1)) and _AFTER.match(text, last + 1):
                found.add(key)
        return sorted(i for key in found for i in self.places[key])

    @property
    def over(self) -> list[list[int]]:
        """For each term the longer terms that contain it, by place; found by taking each term as a text."""
        if self._over is None:
            inside: list[set[int]] = [set() for _ in self.keys]
            for longer, places in self.places.items():
                for part in {k for _, k in self._matches(longer)} | ({""} & self.places.keys()):
                    if part != longer:
                        for i in self.places[part]:
                            inside[i].update(places)
            self._over = [sorted(s) for s in inside]
        return self._over

    def unmasked(self, text: str | None, told: set[int], size: int) -> list[int]:
        """Places, in order, of those of the first ``size`` terms, without the told ones, that stand in the text once the longer of the first ``size`` terms are cut out of it, one after the other."""
        if text is None:
            return []
        there = {key for _, key in self._matches(text)} | ({""} & self.places.keys())
        alone, out = None, []
        # Cutting may join what stood apart, but a term that wasn't in the text before is none of the chapter's.
        for i in sorted(i for key in there for i in self.places[key] if i < size and i not in told):
            longer = [self.keys[o] for o in self.over[i] if o < size]
            if any(o in there for o in longer):
                rest = text
                for o in longer:
                    rest = rest.replace(o, "")
                if stands(self.keys[i], rest):
                    out.append(i)
            else:
                alone = set(self.standing(text)) if alone is None else alone
                if i in alone:
                    out.append(i)
        return out


def stands(key: str, text: str) -> bool:
    """Whether a single term stands in the text on its own."""
    if not key:
        return _EMPTY.search(text) is not None
    at = text.find(key)
    while at >= 0:
        if not (at and _HANGUL.match(text, at - 1)) and _AFTER.match(text, at + len(key)):
            return True
        at = text.find(key, at + 1)
    return False


def content_words(low: str) -> set[str]:
    """The words of a lower-cased rendering that have to occur."""
    return set(_WORD.findall(low)).difference(STOP_WORDS)


class _Books:
    """Finders of the books that a task meets; keys tell a book."""

    def __init__(self):
        self.known: dict[str, tuple[pa.Array, Finder, list]] = {}

    def __call__(self, slug: str, keys: pa.Array) -> tuple[Finder, list]:
        """The book's finder, and a list that its user may fill."""
        held = self.known.get(slug)
        if held is None or not held[0].equals(keys):
            if len(self.known) >= BOOKS:
                self.known.pop(next(iter(self.known)))
            held = self.known[slug] = (keys, Finder(keys.to_pylist()), [])
        return held[1], held[2]


def _row(lists: pa.Array, i: int) -> pa.Array:
    """The i-th list of a list array, empty for null."""
    scalar = lists[i].values
    return lists.values[:0] if scalar is None else scalar


def present_column():
    """(slug, keys, text, size) -> array<int>: places among the first ``size`` terms of those that stand in the text."""

    @F.arrow_udf("array<int>")
    def present(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        books = _Books()
        for slugs, keys, texts, sizes in columns:
            out = []
            for i, (slug, text, size) in enumerate(zip(slugs.to_pylist(), texts.to_pylist(), sizes.to_pylist())):
                own = _row(keys, i)
                out.append([p for p in books(slug, own)[0].standing(text) if p < size] if text and len(own) else [])
            yield pa.array(out, pa.list_(pa.int32()))

    return present


def checked_column():
    """(slug, keys, lower-cased renderings, text, lower-cased translation, size) -> places of the terms that stand in the text, and of those that the translation lacks.

    A rendering is in a translation as it stands, or by all its content words.
    """

    @F.arrow_udf("struct<present: array<int>, wrong: array<int>>")
    def checked(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        books = _Books()
        for slugs, keys, lows, texts, translations, sizes in columns:
            present, wrong = [], []
            for i, (slug, text, translation, size) in enumerate(zip(slugs.to_pylist(), texts.to_pylist(), translations.to_pylist(), sizes.to_pylist())):
                own = _row(keys, i)
                if not len(own) or not text:
                    present.append([])
                    wrong.append([])
                    continue
                finder, wanted = books(slug, own)
                if not wanted:
                    wanted += [(low, content_words(low or "")) for low in _row(lows, i).to_pylist()]
                found = [p for p in finder.standing(text) if p < size]
                words = set(_WORD.findall(translation)) if translation and found else set()
                present.append(found)
                wrong.append([p for p in found if not (wanted[p][0] is not None and translation is not None and (wanted[p][0] in translation or wanted[p][1] and wanted[p][1] <= words))])
            yield pa.StructArray.from_arrays([pa.array(present, pa.list_(pa.int32())), pa.array(wrong, pa.list_(pa.int32()))], ["present", "wrong"])

    return checked


def forgotten_column():
    """(slug, keys, enforced, ids of the reply's tokens as digits, text, size) -> places of the enforced terms without a token that stand in the text without longer terms."""

    @F.arrow_udf("array<int>")
    def forgotten(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        books = _Books()
        for slugs, keys, enforced, tokens, texts, sizes in columns:
            out = []
            for i, (slug, ids, text, size) in enumerate(zip(slugs.to_pylist(), tokens.to_pylist(), texts.to_pylist(), sizes.to_pylist())):
                own = _row(keys, i)
                if text is None or ids is None or not len(own):
                    out.append([])
                    continue
                finder, soft = books(slug, own)
                if not soft:
                    soft.append({p for p, e in enumerate(_row(enforced, i).to_pylist()) if not e})
                out.append(finder.unmasked(text, soft[0] | {int(x) - 1 for x in ids}, size))
            yield pa.array(out, pa.list_(pa.int32()))

    return forgotten
