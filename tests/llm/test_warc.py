"""Operator 4: archives written and read back, and the merge of index runs."""

import base64
import hashlib
import random

from panelspark.llm import common, warc


def test_loser_tree():
    rng = random.Random(2)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted((rng.randint(0, 9), rng.random()) for _ in range(rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)
    assert list(warc.LoserTree([])) == []


def test_archives(spark):
    rows = [
        (1, "http://b.example/x?q=1", "<p>one</p>", "c"), (2, "http://a.example/", "<p>one</p>", "c"),
        (3, None, None, "c"), (4, "http://a.example/", "", "c"), (5, "http://[bad", "é" * 70_000, "c"),
        (6, "http://a.example/ü y\r\nX: 1", "<p>two</p>", "c"), (6, "http://a.example/ü y\r\nX: 1", "<p>two</p>", "c"),
        (None, "http://a.example/", "<p>two</p>", "c"), (7, "", "\r\n\r\n\x00", "c"),
        *[(100 + i, "http://hot.example/", "hot", "c") for i in range(300)],
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    folder = common.work_dir(spark, "test")
    runs = warc.write_archives(pages, folder)
    index = common.stage(warc.merge_runs(runs))
    order = [(r.urlkey, r.ts, -1 if r.page_id is None else r.page_id) for r in index.orderBy("range", "position").collect()]
    assert order == sorted(order) and len(order) == len(rows)
    best = {}
    for i, _, html, _ in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        first = best[html or ""] == i
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else best[html or ""]))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(index, folder).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    folder = common.work_dir(spark, "test")
    none = warc.write_archives(pages.where("false"), folder)
    assert warc.read_archives(warc.merge_runs(none), folder).count() == 0


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    folder = common.work_dir(spark, "test")
    index = warc.merge_runs(warc.write_archives(pages, folder, revisit_from=3))
    got = {r.page_id: r.record_type for r in warc.read_archives(index, folder).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
