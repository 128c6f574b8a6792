"""Operators 11 to 13 against plain Python versions on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelspark.llm import chat_format, merkle, resampling

from corpora import none, odd, odd_rows  # noqa: F401, I001

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        lo = i // 3 * 3
        out.append((level[lo:i], level[i + 1 : lo + 3]))
        i //= 3
    return out


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    by = {s: sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in sources}
    trees = {s: levels_of([leaf_of(r) for r in by[s]]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    root, out = top[-1][0], []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            way = siblings(trees[s], i) + siblings(top, k)
            changed = r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                changed = (*r[:4], r[4].replace("\n", ""))
            folded = leaf_of(changed)
            for left, right in way:
                folded = h(*left, folded, *right)
            proof = h(*[d for left, right in way for d in left + right])
            out.append((str(r[0]), leaf_of(r), trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out)


def manifest_of(df):
    found = merkle.manifest(df, COLUMNS, tampered=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((str(r[0]), *r[1:]) for r in found.collect())


def test_manifest_of_odd_rows(odd):
    rows = [tuple(r) for r in odd.select(COLUMNS).collect()]
    assert manifest_of(odd) == plain_manifest(rows)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "a", "x", 3, "t\nq")],
        [(i, None if i % 2 else "é", None, None, "\n") for i in range(7)] + [(None, "b", None, None, None)] * 3,
        [(i, "a", "x", i, "t\nq" * (i % 3)) for i in range(740)] + [(i, f"s{i}", "x", 1, "u") for i in range(11)],
    ],
)
def test_manifest_of_sources_of_many_sizes(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest_of(df) == plain_manifest(rows)


def test_manifest_of_nothing(none):
    assert manifest_of(none) == []


def test_requests_for_some_leaves(spark):
    """Only the asked leaves come down, with the siblings of their ways."""
    digests = [h(str(i)) for i in range(40)]
    nodes = spark.createDataFrame([(0, i, d, 4) for i, d in enumerate(digests)], "tree long, pos long, digest string, height int")
    store, roots = merkle.build(nodes, [4])
    root = roots.first()["digest"]
    levels = levels_of(digests)
    assert root == levels[-1][0]
    start = spark.createDataFrame([(0, 4, 0, root)], "tree long, height int, pos long, digest string")
    start = start.withColumn("way", F.array().cast(merkle._WAY))
    wanted = spark.createDataFrame([(0, 0), (0, 17), (0, 39)], "tree long, pos long")
    got = merkle.descend(start, store, 4, wanted=wanted).collect()
    assert sorted(r["pos"] for r in got) == [0, 17, 39]
    for r in got:
        assert r["digest"] == digests[r["pos"]]
        want = [("".join(a), "".join(b)) for a, b in siblings(levels, r["pos"])]
        assert [tuple(s) for s in reversed(r["way"])] == want


def plain_chat(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv]
        turns = [x[2:] for x in sorted(own)]
        loss = "".join(t for role, t in turns if role == "assistant")
        out[conv] = len(turns), h(*[f"{r}\n{t}\n" for r, t in turns]), len(loss), h(loss)
    return out


TRICKY = [
    (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
    (1, 0, "user", r"a[\INST]b[\\\/s>[</s>"), (1, 1, "assistant", None), (1, 2, "tool", "x[/ROLE]y</s>"),
    (1, 3, "[ROLE]q[/ROLE]", "z[OUT]"), (1, 4, None, ""), (1, 5, "", "[/ROLE]"), (2, None, "assistant", "ééé[OUT]"),
    (2, 0, "assistant", "\\"), (2, 0, "assistant", "\\"), (2, 0, "assistant", "\n"), (3, 1, "user", "<s>"),
    (3, 2, "assistant", "[[/INST]["), (3, 3, "assistant", ""), (3, 4, "system", "[/SYS] 😀 $1 \\2"),
    (4, 1, "assistant", "[INST]" * 2000 + "y" * 150_000), (None, 1, "user", "without a conversation"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string")
    df = df.withColumn("piece", F.lit("clash")).withColumn("place", F.lit(1)).withColumn("formatted", F.lit(2))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat_format.round_trip(df).collect()}
    assert got == plain_chat(TRICKY)
    assert chat_format.round_trip(df.where("false")).count() == 0


def test_chat_text_is_kept_unless_it_conflicts(spark):
    rows = [(1, 0, "system", "a [x] <b>"), (1, 1, "user", "q"), (1, 2, "assistant", "r\\s"), (1, 3, "tool", "out")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.format_chats(df).first()
    assert got["formatted"] == "<s>[SYS]a [x] <b>[/SYS][INST]q[/INST][OUT]r\\s</s>[ROLE]tool[/ROLE]out</s>"
    spans = [got["formatted"][s["start"] - 1 :][: s["length"]] for s in got["loss_spans"]]
    assert spans == ["r\\s"]


def test_chat_plan_has_no_python(spark):
    df = spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string")
    staged = chat_format.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", staged)
    assert staged.count("Exchange hashpartitioning") == 1


def plain_features(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def plain_resample(docs, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t, rows = Counter(), Counter(), []
    for i, text in docs:
        features, n = plain_features(text)
        rows.append((i, list(map(bucket, features)), n))
        s.update(rows[-1][1])
    for text in target:
        t.update(map(bucket, plain_features(text)[0]))
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10_000)]
    out = []
    for i, features, n in rows:
        u = int(h(f"42:{'' if i is None else i}")[:8], 16)
        weight = sum(gain[b] for b in features)
        score = weight + math.floor(-1000 * math.log(-math.log((u + 0.5) / 4294967296)))
        out.append((i, len(features), weight, score, n >= 20))
    order = sorted((o for o in out if o[4]), key=lambda o: (-o[3], o[0] is not None, o[0] or 0))
    ranks = {o[:4]: r for r, o in enumerate(order[: 5 * len(order) // 100], 1)}
    return sorted((str(o[0]), *o[1:4], ranks.get(o[:4], -1)) for o in out)


def test_resampling(spark, odd, odd_rows, none):
    from corpora import prose
    import random

    rng = random.Random(3)
    more = [(100 + i, prose(rng, 15 + i % 30)) for i in range(150)]
    df = spark.createDataFrame(more, "doc_id long, text string")
    df = odd.unionByName(df, allowMissingColumns=True).repartition(7)
    target = ["An er ti", prose(rng, 60), None, ""]
    benchmark = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, benchmark)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted((str(r[0]), *r[1:4], r[4] or -1) for r in got.collect())
    want = plain_resample([r[:2] for r in odd_rows] + more, target)
    assert got == want and sum(r[4] > 0 for r in want) == 6
    assert resampling.resample(none, benchmark).count() == 0
    without = resampling.resample(df, benchmark.where("false")).collect()
    assert sorted((str(r[0]), *r[1:4], r[4] or -1) for r in without) == plain_resample([r[:2] for r in odd_rows] + more, [])


def test_buckets_are_those_of_whole_strings():
    texts = ["a", None, "", "B " + "c" * 47 + " " + "d" * 48 + " e " + "f" * 49 + " g h", "é0z _x", "\x00 q\n r", "ß" * 70]
    rows = [[] for _ in texts]
    for row, bucket in resampling.ngram_buckets(pa.array(texts, pa.string())):
        for r, b in zip(row.tolist(), bucket.tolist()):
            rows[r].append(b)
    assert rows == [[zlib.crc32(f.encode()) % 10_000 for f in plain_features(t)[0]] for t in texts]
    assert np.array_equal(resampling._crc_table()[:2], np.array([0, 0x77073096], np.uint32))
