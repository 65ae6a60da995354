"""Column functions for texts, terms and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What may follow a term inside a Hangul run (particles and endings).
PARTICLES = (
    "으로써 으로서 에서는 에게서 이라고 이라는 으로 에서 에게 한테 처럼 만큼 까지 부터 보다 라고 라는 "
    "마저 조차 밖에 이나 은 는 이 가 을 를 과 와 의 에 로 도 만 님 씨 들 "
    "이었 였다 였고 였어 였 이다 이라 이고 이며 이야 이지 예요 입니 인"
).split()

# Words of a rendering that need not occur.
STOP_WORDS = ["the", "of", "a", "an", "and", "s"]

# Categories of terms.
CATEGORIES = ["person", "place", "organization", "technique", "rank_title", "item", "creature", "other"]

#: White space, all of Unicode's, as characters and as a class of a pattern.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_SPACE = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: A numbered token, as a Java pattern with the id in group 1.
TOKEN = rf"\[\[{_SPACE}*[Gg]{_SPACE}*0*([0-9]+){_SPACE}*\]\]"
#: A self-reported entity: korean in group 1, english (or nothing) in group 2.
NEW_TOKEN = rf"\[\[NEW:{_SPACE}*([^|\]]+?){_SPACE}*(?:\|{_SPACE}*([^\]]*?){_SPACE}*)?\]\]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at either end, all of Unicode's."""
    return F.btrim(col(c), F.lit(BLANKS))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(BLANKS))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body uses it for each element of an array."""
    return F.transform(F.array(value), body)[0]


def lines(c: Column | str) -> Column:
    """The lines of a text; none for an empty one, and no empty line after the last break."""
    whole = F.split(F.regexp_replace(col(c), r"\R\z", ""), r"\R", -1)
    return F.when(F.length(col(c)) > 0, whole).otherwise(F.array().cast("array<string>"))


def section(c: Column | str, tag: str) -> Column:
    """What stands between the first <tag> and the next </tag>, stripped; null where there is none."""
    rest = F.split(F.try_element_at(F.split(col(c), f"<{tag}>", 2), F.lit(2)), f"</{tag}>", 2)
    return let(rest, lambda r: F.when(F.size(r) == 2, strip(r[0])))


def filled(c: Column) -> Column:
    """The text, or null where it is empty."""
    return F.when(F.length(c) > 0, c)


def normalize_key(korean: Column | str) -> Column:
    """Without parentheses (either width) and all white space."""
    bare = F.regexp_replace(col(korean), r"\([^)]*\)|（[^）]*）", "")
    return F.regexp_replace(bare, f"{_SPACE}+", "")


def occurs(key: Column, source: Column) -> Column:
    """Whether a term stands in a text on its own: no Hangul before it, and after it no Hangul or a particle."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(key, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    pattern = F.concat(F.lit("(?<![가-힣])"), quoted, F.lit("(?:(?![가-힣])|" + "|".join(PARTICLES) + ")"))
    return F.contains(source, key) & F.regexp_like(source, pattern)


def token_ids(c: Column) -> Column:
    """The ids of all numbered tokens in order; null for one that fits no INT."""
    return F.transform(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(1)), lambda x: x.try_cast("int"))


def token_texts(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def new_entities(c: Column) -> Column:
    """ARRAY<STRUCT<korean, english>> of the self-reported entities; english is empty where none was given."""
    korean = F.regexp_extract_all(c, F.lit(NEW_TOKEN), F.lit(1))
    english = F.regexp_extract_all(c, F.lit(NEW_TOKEN), F.lit(2))
    return F.transform(F.arrays_zip(korean.alias("k"), english.alias("e")), lambda x: F.struct(strip(x["k"]).alias("korean"), strip(F.coalesce(x["e"], F.lit(""))).alias("english")))


def apply_tokens(c: Column, id_map: Column) -> Column:
    """The text after all recovery passes over its tokens; id_map is a MAP<INT, STRING>.

    Numbered tokens are replaced in one pass, so that a rendering which holds a token
    stays as it is until the later passes.
    """
    text = F.regexp_replace(c, rf"\[{{2,}}({_SPACE}*[Gg]{_SPACE}*0*[0-9]+{_SPACE}*)\]{{2,}}", "[[$1]]")
    between, tokens, ids = F.split(text, TOKEN, -1), token_texts(text), token_ids(text)
    pieces = F.transform(F.arrays_zip(between.alias("b"), tokens.alias("t"), ids.alias("i")), lambda x: F.concat(x["b"], F.coalesce(F.try_element_at(id_map, x["i"]), x["t"], F.lit(""))))
    text = F.array_join(pieces, "")
    named = rf"\[\[NEW:{_SPACE}*[^|\]]+?{_SPACE}*\|{_SPACE}*([^\]]*?[^\]\s]){_SPACE}*\]\]"
    text = F.regexp_replace(text, named, "$1")
    text = F.regexp_replace(text, rf"\[\[[^\[\]]*\|{_SPACE}*([^\[\]|]+?){_SPACE}*\]\]", "$1")
    return F.regexp_replace(text, rf"\[\[(?!NEW:)(?!{_SPACE}*[Gg]{_SPACE}*0*[0-9])([^\[\]]*?)\]\]", "$1")


def leaked(c: Column) -> Column:
    """Whatever is still in double brackets."""
    return F.regexp_extract_all(c, F.lit(r"\[\[[^\]]*\]\]"), F.lit(0))


def prose(c: Column) -> Column:
    return F.regexp_replace(c, r"\[\[[^\]]*\]\]", "")
