import base64
import gzip
import hashlib

from chapterloom.llm import warc

MAGIC = "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:chapterloom:page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nafter"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    html = [(1, "é" * 3000), (2, "same"), (3, "same"), (4, None), (5, ""), (6, MAGIC), (7, MAGIC), (8, "\r\n\r\n"), (9, "x" * 200_000), (11, "WARC/1.0\r\nContent-Length: 0\r\n\r\n"), (12, "a\r\n\r\n" * 50), (13, f"{MAGIC}{MAGIC} end"), (10, "same")]
    pages = spark.createDataFrame([(i, None if i == 2 else f"http://a b/\r\n{i}", h, "n") for i, h in html] + [(2, "u", "same", "n"), (None, "v", "lonely", "n")], "page_id long, url string, html string, sha string")
    for n, split in ((1, "128m"), (3, "128m"), (2, "999b")):  # one file, several, and many tasks a file
        path = f"{tmp_path}/w{n}{split}"
        warc.write(pages.repartition(n), path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.resolved(warc.read(spark, path)).collect()), key=str)
        first = {}
        for i, h in html:
            first.setdefault(h or "", i)
        want = [(i, len((h or "").encode()), digest(h or ""), "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""]) for i, h in html]
        want += [(2, 4, digest("same"), "response", None), (None, 6, digest("lonely"), "response", None)]
        assert got == sorted(want, key=str)
        # Magic inside payloads is a candidate, but not in the chain.
        assert warc.candidates(spark, path).where("next is not null and record_id like '%666%'").count() == 3
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert warc.read(spark, path).where("record_id like '%666%'").count() == 0


def test_pointer_jumping(spark):
    rows = [("f", 10 * k, 10 * (k + 1)) for k in range(37)] + [("f", 5, 20), ("f", 371, 380), ("g", 3, 9), ("g", 0, 7), ("h", 0, 4), ("h", 4, 4000)]
    chain = spark.createDataFrame(rows, "file string, offset long, next long")
    got = {(r.file, r.offset) for r in warc.reachable(chain).collect()}
    assert got == {("f", 10 * k) for k in range(37)} | {("g", 0), ("h", 0), ("h", 4)}
    assert warc.reachable(chain.limit(0)).count() == 0


def test_names_gzip_and_broken_files(spark, tmp_path):
    record = b"WARC/1.0\r\nContent-Length: %d\r\nWARC-Record-ID: <%d>\r\n\r\n%s\r\n\r\n"
    whole = b"".join(record % (len(x), k, x) for k, x in enumerate([b"one", b"", b"\xff\x00two", b"\r\n\r\nWARC/1.0 three"]))
    for name, data in {"a.warc": whole, "b.warc.gz": gzip.compress(whole[:70]) + gzip.compress(whole[70:]), "c.warc": b"junk" + whole, "d.warc": b"", "e.warc": whole[:-10], "f.other": whole, "g.warc": record % (99, 7, b"cut")}.items():
        (tmp_path / name).write_bytes(data)
    rows = warc.read(spark, str(tmp_path), "*.warc*").collect()
    got = sorted((r.file.rpartition("/")[2], r.record_id, r.payload_bytes, r.payload_digest) for r in rows)
    sha = lambda x: base64.b32encode(hashlib.sha1(x).digest()).decode()
    full = [("<0>", b"one"), ("<1>", b""), ("<2>", b"\xff\x00two"), ("<3>", b"\r\n\r\nWARC/1.0 three")]
    want = [(f, i, len(x), sha(x)) for f in ("a.warc", "b.warc.gz") for i, x in full]
    want += [("e.warc", i, len(x), sha(x)) for i, x in [*full[:3], ("<3>", b"\r\n\r\nWARC/1.0")]]
    want.append(("g.warc", "<7>", 7, sha(b"cut\r\n\r\n")))
    assert got == sorted(want)


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(pages, f"{tmp_path}/none")
    assert warc.resolved(warc.read(spark, f"{tmp_path}/none")).count() == 0


def test_files_split_differently_by_two_scans(spark, tmp_path):
    pages = [(k, f"http://x/{k}", f"{MAGIC}{'y' * 700 * k}{MAGIC} {k}") for k in range(1, 9)] + [(9, "http://x/9", MAGIC * 3)]
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(1), f"{tmp_path}/one")
    records = warc.read(spark, f"{tmp_path}/one")
    want = sorted((k, len(h), digest(h)) for k, _, h in pages)
    try:
        for split in ("128m", "8k", "1k"):  # the plan is lazy: its second scan takes the setting of the action
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in warc.resolved(records).collect()) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_chains_that_end_early_are_told(spark, tmp_path):
    record = b"WARC/1.0\r\nContent-Length: %d\r\nWARC-Record-ID: <%d>\r\n\r\n%s\r\n\r\n"
    one, two, three = (record % (len(x), k, x) for k, x in enumerate([b"one", b"\r\n\r\nWARC/1.0 two", b"three"]))
    wrong = record % (9, 1, b"two")
    data = {"good": one + two + three, "wrong": one + wrong + two + three, "junk": b"junk" + one, "cut": (one + two)[:-6], "tail": one + b"more", "empty": b"", "none": b"some text"}
    for name, body in data.items():
        (tmp_path / name).write_bytes(body)
    (tmp_path / "z.gz").write_bytes(gzip.compress(data["good"]))
    got = {r.file.rpartition("/")[2]: (r.bytes, r.verified_end, r.beyond, r.complete) for r in warc.chain_ends(spark, str(tmp_path)).collect()}
    size = {k: len(x) for k, x in data.items()}
    assert got == {
        "good": (size["good"], size["good"], 0, True),
        "z.gz": (size["good"], size["good"], 0, True),
        "wrong": (size["wrong"], len(one + wrong) + 6, 1, False),
        "junk": (size["junk"], 0, 0, False),
        "cut": (size["cut"], len(one + two), 0, False),
        "tail": (size["tail"], len(one), 0, False),
        "none": (size["none"], 0, 0, False),
    }
