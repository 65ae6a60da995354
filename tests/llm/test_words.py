import random
import re

from chapterloom.llm.words import word_hashes


def test_words_by_brute_force():
    random.seed(1)
    chars = ["a", "B", "b", "é", "語", " ", " ", "\n", "\t", "\x0b", "\x1f", "\xa0", "\u2003", "\ud800", "0"]
    texts = [None, "", "  ", "x", *["".join(random.choices(chars, k=random.choice([1, 7, 60]))) for _ in range(200)], "y" * 500, " z"]
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    for piece in (1, 16, 10_000):
        hashes, n = word_hashes(texts, piece)
        assert n.tolist() == list(map(len, words))
        seen = dict(zip([w for x in words for w in x], hashes.tolist()))
        assert [seen[w] for x in words for w in x] == hashes.tolist() and len(set(seen.values())) == len(seen)
    assert word_hashes([])[1].tolist() == []


def test_thue_morse_words_differ():
    # Roots of polynomials modulo 2**64: such a word and its complement had one hash, whatever the factor.
    words = []
    for n in (1024, 2048, 4096):
        morse = [bin(i).count("1") % 2 for i in range(n)]
        words += ["".join("ab"[b] for b in morse), "".join("ba"[b] for b in morse)]
    assert len(set(word_hashes(words)[0].tolist())) == 6
    assert len(set(word_hashes([" ".join(words)])[0].tolist())) == 6
