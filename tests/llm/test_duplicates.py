"""Operators 1 and 7 against brute force and planted cases."""

import random

import numpy as np
import pytest

from panelspark.llm import lsh_forest, paragraphs, shingles

from corpora import none, odd, odd_rows, prose  # noqa: F401, I001


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, threshold=0.8):
    sets = [shingle_set(t) for _, t in rows]
    links, root = [0] * len(rows), {i: i for i, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                both = len(sets[a] & sets[b])
                if both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                    links[a] += 1
                    links[b] += 1
                    x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                    root[y] = x
    return sorted((str(i), n, str(find(i))) for (i, _), n in zip(rows, links))


def near_copies(seed, groups=12, size=25):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = prose(rng, rng.randint(8, 300)).split(" ")
        for k in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 40])):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(1000)}"
            rows.append((g * 1000 + k, " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [7, 256])
def test_join_is_whole(spark, block, monkeypatch):
    monkeypatch.setattr(shingles, "BLOCK", block)
    rows = near_copies(4)
    got = lsh_forest.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_links, str(r.class_id)) for r in got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_join_of_odd_rows(odd, odd_rows, none):
    got = lsh_forest.jaccard_join(odd).collect()
    # rows that share an id share its links in one number; leave them to the count of rows
    single = {10, 11, None}
    want = [w for w in brute([r[:2] for r in odd_rows]) if w[0] not in map(str, single)]
    assert sorted((str(r.doc_id), r.n_links, str(r.class_id)) for r in got if r.doc_id not in single) == want
    assert len(got) == len(odd_rows)
    assert lsh_forest.jaccard_join(none).count() == 0


def test_prefix_shortens_until_the_recall():
    lengths = [lsh_forest.matched_prefix(0.8, 48, 8, r)[0] for r in (0.9, 0.999, 0.99999, 1 - 1e-9)]
    assert lengths == sorted(lengths, reverse=True) and lengths[0] > lengths[-1]
    for recall in (0.9, 0.9999):
        assert lsh_forest.matched_prefix(0.8, 48, 8, recall)[1] >= recall


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    b = np.concatenate([a[:3600], rng.integers(0, 1 << 63, 400, dtype=np.uint64)])
    s = shingles.MinHash(1500).signatures([np.unique(a), np.unique(b), np.zeros(0, np.uint64)])
    assert abs((s[0] == s[1]).mean() - 3600 / 4400) < 0.04


def test_tuned_bands():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = paragraphs.tune_bands(threshold)
        assert bands <= paragraphs.MAX_BANDS and 1 - (1 - threshold**rows) ** bands >= 0.995


def test_passages(spark):
    rng = random.Random(9)
    passage, line = prose(rng, 60).replace("\n", " "), "All rights reserved by the owner."
    rows = []
    for i in range(60):
        parts = [prose(rng, 120), line]
        if i % 6 == 1:  # inside a longer line
            parts.insert(1, f"{prose(rng, 9)} {passage} {prose(rng, 9)}".replace("\n", " "))
        rows.append((i, "\n".join(parts)))
    near = prose(rng, 120).replace("\n", " ")
    rows.append((100, "Start.\n" + near))
    words = near.split(" ")
    words[60] = "changed"
    rows.append((101, prose(rng, 30) + "\n" + " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = paragraphs.repeated_passages(df).collect()
    assert {r.doc_id for r in spans} == {i for i in range(60) if i % 6 == 1} - {1} | {101}
    assert {r.first_doc for r in spans if r.doc_id < 60} == {1}
    texts = dict(rows)
    for r in spans:
        part = texts[r.doc_id].encode()[r.start : r.stop].decode()
        assert part in passage or r.doc_id == 101
        assert r.doc_id == 101 or len(part.split()) >= 30
    left = {r.doc_id: r.text for r in paragraphs.without_passages(df, paragraphs.repeated_passages(df)).collect()}
    assert left[0] == texts[0] and left[1] == texts[1] and len(left) == len(rows)
    assert len(texts[7].split()) - len(left[7].split()) >= 40
    assert len(left[101].split()) < 40


def test_runs_lie_in_one_earlier_document(spark):
    """Lines and stretches of many documents strung together are no passage; the same words in one document are."""
    rng = random.Random(21)
    menu = [prose(rng, n).replace("\n", " ") for n in (1, 2, 1, 3, 5, 1, 2, 4, 5, 1, 3, 2, 5, 4, 1)]
    rows = [(i, f"{prose(rng, 12)}\n{line}\n{prose(rng, 12)}") for i, line in enumerate(menu)]
    rows.append((50, "\n".join(menu)))
    rows.append((51, "\n".join(reversed(menu))))  # the same lines in another order
    rows.append((52, "\n".join([prose(rng, 10), *menu, prose(rng, 10)])))
    # two texts of one id hold half of a passage each
    halves = [prose(rng, 14).replace("\n", " ") for _ in range(2)]
    rows += [(60, halves[0]), (60, f"x\n{halves[1]}"), (61, "\n".join(halves))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = paragraphs.repeated_passages(df).collect()
    assert [(r.doc_id, r.first_doc, r.words, r.kind) for r in spans] == [(52, 50, sum(len(m.split()) for m in menu), "run")]


def test_lines_of_twenty_words(spark):
    """Equal and nearly equal lines of 20 words are found, however many earlier lines hold their pieces."""
    rng, rows = random.Random(33), []
    for i in range(6):
        base = prose(rng, 20).replace("\n", " ").split(" ")
        rows.append((10 * i, " ".join(base)))
        rows.append((10 * i + 1, "\n".join([prose(rng, 6), " ".join(base), prose(rng, 6)])))
        rows.append((10 * i + 2, "\n".join([prose(rng, 6), " ".join([*base[:-1], "edited"]), prose(rng, 6)])))
    spans = paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(10 * i + k, 20, 10 * i, "paragraph") for i in range(6) for k in (1, 2)]
    assert sorted((r.doc_id, r.words, r.first_doc, r.kind) for r in spans) == want


def test_passages_of_odd_rows(odd, odd_rows, none):
    spans = paragraphs.repeated_passages(odd)
    got = spans.collect()
    assert {r.doc_id for r in got} == {8} and all(r.first_doc == 7 for r in got)
    cut = paragraphs.without_passages(odd, spans)
    assert cut.columns == odd.columns and cut.count() == len(odd_rows)
    assert [r.text for r in cut.where("doc_id = 8").collect()][0].endswith("tail")
    assert paragraphs.repeated_passages(none).count() == 0
