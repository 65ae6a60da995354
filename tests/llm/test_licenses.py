import os
import random
import textwrap
import time

import duckdb
import pytest

from chapterloom.llm import licenses as L


def brute(text, threshold=0.8):
    best = []
    units = [(0, text), *enumerate(text.split("\n"), 1)] if text else []
    for k, unit in units:
        own = L.pairs(L.normalised(unit))
        for name, body in L.TEMPLATES.items():
            other = L.pairs(L.normalised(body))
            if own and 2 * len(own & other) / (len(own) + len(other)) >= threshold:
                best.append((-2 * len(own & other) / (len(own) + len(other)), name, k))
    return min(best) if best else None


def test_bounds_lose_nothing():
    m = L.Matcher()
    mit = L.TEMPLATES["MIT-notice"].split(" ")
    texts = ["Released under the MIT License.", "x\nreleased UNDER the mit licence!\ny", " ".join(mit[: len(mit) * 7 // 10]), "\n".join(mit), " ".join(mit) + " tail" * 30, " ".join(mit) + " a b c d e f g h " * 90, "MIT", "", None]
    texts += [body + " some more words" for body in L.TEMPLATES.values()] + ["prose " * 5 + body for body in L.TEMPLATES.values()]
    for text in texts:
        name, dice, unit, n, names = m.text(text)
        want = brute(text)
        assert (name, unit) == ((want[1], want[2]) if want else (None, None))
        assert not want or abs(dice + want[0]) < 1e-12 and n >= 1 and name in names


def test_wrapped_in_longer_texts():
    m, prose = L.Matcher(), [f"line {k} of some other text, number {k * 7}, and more of it" for k in range(40)]
    warranty = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    for name in ("MIT-notice", "Apache-2.0-notice", "GPL-3.0-notice", "ISC", "MPL-2.0"):
        for mark in ("", "# ", " * "):
            body = [mark + x for x in textwrap.wrap(L.TEMPLATES[name], 70) + [""] + textwrap.wrap(warranty, 70)]
            lines = [*prose, "", *body, "", *prose]
            got = m.text("\n".join(lines))
            assert (got[0], got[2]) == (name, 42) and got[1] > 0.9 and got[3] >= 1
            runs = [(lo, L.pairs(L.normalised(" ".join(lines[lo:hi])))) for lo in range(36, 60) for hi in range(lo + 1, 62)]
            own = L.pairs(L.normalised(L.TEMPLATES[name]))
            assert abs(got[1] - max(2 * len(r & own) / (len(r) + len(own)) for _, r in runs)) < 1e-12
    assert m.text("\n".join(prose))[0] is None
    often = [*prose, *(textwrap.wrap(L.TEMPLATES["ISC"], 70) + ["in short"]) * 3000]
    assert m.text("\n".join(often))[0] == "ISC"


def test_operator_edges(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "w " * 100_000 + "\nReleased under the MIT License.", 3), (3, "a", 3)], "doc_id long, text string, dice int")
    rows = L.scan(df).collect()
    assert len(rows) == 4 and [r.license for r in rows] == [None, None, "MIT", None]
    assert L.scan(df.limit(0)).count() == 0


def test_whole_licences_wrapped_in_source_files():
    matcher = L.Matcher()
    for name in ("MIT-text", "BSD-3-Clause-text", "BSD-2-Clause-text", "ISC-text", "GPL-2.0-header", "Apache-2.0-header", "Zlib-text"):
        for width, mark in ((70, " * "), (50, "# ")):
            body = "\n".join(mark + x for x in textwrap.wrap(L.TEMPLATES[name], width))
            text = f"/* some module\n{mark}Copyright (c) 2001 Someone\n{mark}\n{body}\n */\n" + "\n".join(f"int f{k}(void) {{ return {k}; }}" for k in range(60))
            found = matcher.text(text)
            assert name in found[4] and found[1] > 0.9, (name, width, found)
    assert matcher.text("\n".join(textwrap.wrap("no licence at all, just words on many lines " * 40, 60)))[0] is None


def runs_by_brute_force(matcher, text, done):
    """Best run of lines of every template that isn't done: the highest Dice, then the last first line."""
    lines, out = [L.normalised(x) for x in text.split("\n")], {}
    if sum(map(bool, lines)) < 2:
        return out
    for name in set(matcher.sizes) - done:
        own = {p for p, names in matcher.index.items() if name in names}
        for lo in range(len(lines)):
            for hi in range(lo, len(lines)):
                run = L.pairs([w for x in lines[lo : hi + 1] for w in x])
                dice = 2 * len(run & own) / (len(run) + len(own))
                if lines[lo] and dice >= max(matcher.threshold, out.get(name, (0, 0))[0]):
                    out[name] = dice, lo + 1
    return out


def random_texts(templates, seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        lines = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice(list(templates.values())).split()
            words = [w for w in words if rng.random() < 0.95] * rng.randint(1, 2)
            while words:
                k = rng.randint(1, 6)
                lines += [" ".join(words[:k])] + [""] * (rng.random() < 0.2) + ["other words"] * (rng.random() < 0.1)
                words = words[k:]
            lines += ["some words of prose"] * rng.randint(0, 3)
        yield "\n".join(lines)


SMALL = {"a": "one two three four five six seven", "b": "one two three one two four five", "c": "six seven eight one two three nine ten eleven twelve", "d": "x y"}


def test_runs_of_lines_by_brute_force():
    found = 0
    for threshold in (0.8, 0.6):
        matcher = L.Matcher(SMALL, threshold)
        for text in random_texts(SMALL, 5, 400):
            lines = [L.normalised(x) for x in text.split("\n")]
            got = matcher.wrapped(lines, [w for x in lines for w in x], {"d"})
            assert {name: (dice, k) for dice, name, k in got} == runs_by_brute_force(matcher, text, {"d"})
            found += len(got)
    assert found > 400


def test_sql_has_the_same_runs(spark):
    texts = [None, "", *random_texts(SMALL, 7, 150), "one two\nthree four five\nsix seven\n" * 3]
    rows = list(enumerate(texts))
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string"), SMALL).collect()
    base = duckdb.connect()
    base.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    base.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = {r[0]: r[1:] for r in base.execute("SELECT doc_id, license, dice, unit, n_units, licenses FROM (" + L.sql(SMALL) + ")").fetchall()}
    assert {r.doc_id: (r.license, r.dice, r.unit, r.n_units, ",".join(r.licenses)) for r in got} == want
    assert sum(r.license is not None for r in got) > 50


def test_long_texts_of_licence_words_take_linear_time():
    words = [w for body in L.TEMPLATES.values() for w in body.split()]
    rng, matcher = random.Random(3), L.Matcher()
    for lines in ([" ".join(words[k : k + 2]) for k in (rng.randrange(len(words) - 1) for _ in range(10_000))], ["permission is", "hereby granted"] * 20_000):
        began = time.process_time()
        matcher.text("\n".join(lines))
        assert time.process_time() - began < 5


def test_templates_from_files(spark, tmp_path):
    rng = random.Random(1)
    body = "\n".join(" ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(10)) for _ in range(300))
    (tmp_path / "Own-1.0.txt").write_text(body)
    (tmp_path / "MIT").write_text(L.TEMPLATES["MIT-text"])
    templates = L.read_templates(spark, str(tmp_path))
    assert templates == {"Own-1.0": body, "MIT": L.TEMPLATES["MIT-text"]}
    docs = spark.createDataFrame([(1, "int x;\n" * 5 + "\n".join("// " + x for x in body.split("\n")) + "\nint y;" * 9), (2, body), (3, "int x;")], "doc_id long, text string")
    assert [(r.license, r.dice > 0.95) if r.license else None for r in L.scan(docs, templates).sort("doc_id").collect()] == [("Own-1.0", True), ("Own-1.0", True), None]
    with pytest.raises(ValueError):
        L.read_templates(spark, str(tmp_path), 100)


@pytest.mark.skipif(not os.path.exists("/usr/share/common-licenses/GPL-3"), reason="no full licence texts on this machine")
def test_full_licences_in_source_trees(spark):
    templates = L.read_templates(spark, "/usr/share/common-licenses/{GPL-3,MPL-2.0,Apache-2.0}")
    matcher = L.Matcher(templates)
    for name, body in templates.items():
        text = "A program\n" * 30 + "\n".join("# " + x for x in body.split("\n")) + "\nmore of it" * 30
        assert matcher.text(text)[0] == name and matcher.text(body)[:2] == (name, 1.0)
