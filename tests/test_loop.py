"""The real-time loop against a plain one, for events split into batches in several ways."""

import random

import pytest

from chapterloom.streaming import loop as L

TERM = "slug string, token_id int, korean string, english string, category string, note string, enforce boolean"


def reply(c, good=True, terms=(), text="x"):
    lines = "\n".join(f"{k} | {e} | item" for k, e in terms) or "NONE"
    return f"<translation>\n{text} {c}\n</translation>\n<new_glossary_terms>\n{lines}\n</new_glossary_terms>\n" + (f"<chapter_summary>sum {c}</chapter_summary>" if good else "")


def story(n, seed):
    """Events of a book of n chapters in the order of a loop that waits for each, with failed attempts and failed arcs."""
    random.seed(seed)
    events, names = [], [f"{a}{b}" for a in "검성마강" for b in "은는도만"]
    for c in range(1, n + 1):
        terms = [(random.choice(names), f"E{c}{i}") for i in range(random.randint(0, 3))]
        fails = random.choice([0, 0, 0, 1, 2])
        events += [(c, k, "reply", reply(c, False)) for k in range(fails)]
        if fails < 2:
            events.append((c, fails, "reply", reply(c, True, terms, f"[[G{random.randint(1, 12)}]]")))
        if c % 5 == 0:
            events.append((c, 0, "arc", f"<arc_summary>arc {c}</arc_summary>" if random.random() < 0.6 else "nothing"))
    return [("b%d" % seed, *e) for e in events]


def plain(events):
    """Rows of a loop over one book's events in order."""
    out, known, summaries, arc, failures, slug = [], {}, [], None, 0, events[0][0]
    for _, c, _, kind, raw in events:
        if kind == "arc":
            arc = raw[13:-14] if raw.startswith("<arc_summary>") else arc
            out.append(("request", slug, c + 1, len(known), arc, tuple(summaries[-3:])))
            continue
        if "<chapter_summary>" in raw:
            size = len(known)
            for line in raw.split("<new_glossary_terms>\n")[1].split("\n</new")[0].split("\n"):
                k, _, e = line.partition(" | ")
                if e and k not in known:
                    known[k] = len(known) + 1
                    out.append(("term", slug, c, None, known[k], k, e.split(" | ")[0]))
            out.append(("reply", slug, c, size, f"sum {c}"))
            summaries.append((c, f"sum {c}"))
        else:
            failures += 1
            if failures < 2:
                continue
            out.append(("failed", slug, c, len(known)))
        failures = 0
        out.append(("arc", slug, c, len(known), arc) if c % 5 == 0 else ("request", slug, c + 1, len(known), arc, tuple(summaries[-3:])))
    return out


def seen(spark, path):
    out = []
    for r in spark.read.schema(L.ROWS).parquet(path).collect():
        head = (r.kind, r.slug, r.chapter, r.size)
        more = {"term": (r.token_id, r.korean, r.english), "reply": (r.summary,), "failed": (), "arc": (r.arc,), "request": (r.arc, tuple(map(tuple, r.prior or ())))}[r.kind]
        out.append(head + more)
    return sorted(out, key=str)


def feed(spark, folder, batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, L.EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        assert k >= 0


@pytest.mark.parametrize("split", ["one", "each", "random"])
def test_rows_for_any_split(spark, tmp_path, split):
    books = [story(17, 1), story(9, 2), story(5, 3)]
    want = sorted((r for b in books for r in plain(b)), key=str)
    events = [e for b in books for e in b]
    random.seed(7)
    if split == "one":
        random.shuffle(events)
        batches = [events + random.choices(events, k=15)]
    elif split == "each":
        batches = [events[i::4] for i in range(4)]  # out of order, each chapter's replies apart
        batches = [sorted(events[i : i + 11], key=lambda _: random.random()) for i in range(0, len(events), 11)]
    else:
        batches = [[] for _ in range(5)]
        place = {}
        for e in events:  # chapters anywhere, but a chapter's replies in order
            place[e[:2] + e[3:4]] = k = max(place.get(e[:2] + e[3:4], 0), random.randrange(5))
            batches[k].append(e)
        batches.append(random.choices(events, k=20) + [(None, 1, 0, "reply", reply(1)), ("b1", None, 0, "reply", reply(1)), ("b1", -1, 0, "reply", reply(1))])
    for rows in batches:  # the query is started anew for each batch: state comes from the checkpoint
        feed(spark, tmp_path, [rows])
        L.run_loop(L.read_events(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert seen(spark, f"{tmp_path}/out") == want
    before = spark.read.parquet(f"{tmp_path}/out").count()
    L.run_loop(L.read_events(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == before


def test_requests_and_gate(spark, tmp_path):
    said = {1: ([("검", "Sword"), ("검은", "Black")], "plain"), 2: ([("강", "River")], "the [[G1]] and [[G3]]"), 3: ([], "[[G3]] [[NEW:독|Poison]]"), 4: ([], "nothing")}
    events = [("b", c, 0, "reply", reply(c, True, terms, text)) for c, (terms, text) in said.items()]
    chapters = spark.createDataFrame([("b", 1, "시작"), ("b", 2, "검이 강에"), ("b", 3, "강 검은"), ("b", 4, "검"), ("b", 5, "끝"), ("b", 6, "없다")], "slug string, chapter int, text string")

    def run():
        L.run_loop(L.read_events(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        L.gate_loop(spark, f"{tmp_path}/out", chapters, f"{tmp_path}/gate", f"{tmp_path}/cp2").awaitTermination()
        rows = spark.read.parquet(f"{tmp_path}/gate").collect()
        assert len({r.chapter for r in rows}) == len(rows)
        return {r.chapter: r for r in rows}

    feed(spark, tmp_path, [events[:2]])
    assert set(run()) == {1, 2}
    feed(spark, tmp_path, [events])  # the first two come again
    got = run()
    assert set(got) == {1, 2, 3, 4} and run().keys() == got.keys()
    # Chapter 2 was asked for with two terms: [[G3]] isn't known to it, though its own reply makes it one.
    assert (got[2].status, got[2].leaks, got[2].invalid, got[2].size) == ("NEEDS_HUMAN", ["[[G3]]"], 1, 2)
    assert (got[3].status, got[3].body, got[3].new, got[3].size) == ("ok", "River Poison 3", 1, 3)
    assert (got[3].present, got[3].violations, got[3].forgotten) == (3, ["검", "검은"], 1)  # 검 stands by its particle, but 검은 hides it
    assert (got[4].present, got[4].violations, got[4].forgotten, got[4].status) == (1, ["검"], 1, "ok")
    asked = {r.chapter: r for r in L.requests(spark, f"{tmp_path}/out", chapters).collect()}
    assert set(asked) == {1, 2, 3, 4, 5} and [asked[c].size for c in range(1, 6)] == [0, 2, 3, 3, 3]
    assert asked[5].message == "<previous_chapter_summaries>\nCh.2: sum 2\nCh.3: sum 3\nCh.4: sum 4\n</previous_chapter_summaries>\n\n<chapter>\n끝\n</chapter>"
