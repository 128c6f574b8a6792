"""Operators 3 and 6 against brute force."""

import numpy as np
from pyspark.sql import functions as F

from panelspark.llm import learned_index, metric_join

SCHEMA = "vec_id long, embedding array<float>, label int, key string, part int, vec string"


def table(spark, seed=1, n=600, copies=150):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, 16))
    for i in range(0, n - 60, 3):  # chains of near copies
        x[i + 1] = x[i] + 0.12 * rng.normal(size=16)
    x[-copies:] = x[5]
    rows = [(int(i), [float(np.float32(v)) for v in x[i]], int(rng.integers(0, 3)), "k", 1, "v") for i in range(n)]
    odd = [
        (9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] * 16, 1), (9003, [float("inf")] + [1.0] * 15, 1),
        (9004, rows[5][1], None), (9005, [None, *rows[5][1][1:]], 1), (9006, [], 1), (9007, rows[5][1][:8], 1),
        (9100, rows[5][1], rows[5][2]), (9101, [2 * v for v in rows[5][1]], rows[5][2]), (None, rows[5][1], rows[5][2]),
    ]
    return spark.createDataFrame([*rows, *[(*o, "k", 1, "v") for o in odd]], SCHEMA)


def usable(rows):
    return [
        r for r in rows
        if r.embedding and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)
    ]


def test_metric_join(spark):
    df = table(spark)
    rows = df.collect()
    good = [r for r in usable(rows) if r.label is not None]
    links = {id(r): 0 for r in rows}
    root = {r.vec_id: r.vec_id for r in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(good):
        for b in good[i + 1 :]:
            if a.label == b.label and len(a.embedding) == len(b.embedding):
                u, v = np.array(a.embedding), np.array(b.embedding)
                if u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98:
                    links[id(a)] += 1
                    links[id(b)] += 1
                    if a.vec_id is not None and b.vec_id is not None:
                        x, y = sorted((find(a.vec_id), find(b.vec_id)))
                        root[y] = x
    want = {r.vec_id: (links[id(r)], find(r.vec_id)) for r in rows if r.vec_id is not None}
    got = metric_join.near_vectors(df, 0.98).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id) == want[r.vec_id]
            assert r.kept == (r.vec_id == r.component_id)
        else:
            assert r.n_links == next(links[id(x)] for x in rows if x.vec_id is None)
    assert sum(n for n, _ in want.values()) > 300
    assert metric_join.near_vectors(df.where("false"), 0.98).count() == 0


def test_blocks_of_a_cell(spark, monkeypatch):
    """Small blocks and few pivots: the same links, from pairs of blocks."""
    df = table(spark, seed=2, n=300)
    want = sorted(map(str, metric_join.near_vectors(df, 0.9).collect()))
    monkeypatch.setattr(metric_join, "BLOCK", 16)
    monkeypatch.setattr(metric_join, "MAX_PIVOTS", 3)
    assert sorted(map(str, metric_join.near_vectors(df, 0.9).collect())) == want


def test_learned_index(spark):
    df = table(spark, n=2000, copies=300)
    rows = {r.vec_id: np.array(r.embedding, float) for r in usable(df.collect()) if len(r.embedding) == 16 and r.vec_id is not None}
    ids, x = np.array(list(rows)), np.array(list(rows.values()))
    got = learned_index.nearest(df, F.col("vec_id") % 100 == 0, 10).toPandas()
    hit = total = 0
    for q, found in got.groupby("query_id"):
        d = np.sqrt(((x - rows[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        order = np.lexsort((ids, d))[:10]
        found = found.sort_values("rank")
        assert found["rank"].tolist() == list(range(1, 11)) and q not in set(found.vec_id)
        assert list(zip(found.score, found.vec_id)) == sorted(zip(found.score, found.vec_id))
        np.testing.assert_allclose(found.score, [d[np.flatnonzero(ids == v)[0]] for v in found.vec_id], rtol=1e-14)
        hit += np.isin(found.score.round(12), d[order].round(12)).sum()
        total += 10
    assert set(got.query_id) == {i for i in rows if i % 100 == 0}
    assert hit / total >= 0.9
    assert learned_index.nearest(df.where("false"), F.col("vec_id") % 100 == 0, 10).count() == 0
    few = learned_index.nearest(df.where("vec_id < 4"), F.col("vec_id") == 0, 10).collect()
    assert len(few) == 3


def test_index_probes_until_enough_are_found(spark):
    """Uneven parts: every query still gets its k rows, all of them if there are fewer; repeats of an id aside."""
    rng = np.random.default_rng(4)
    x = rng.lognormal(0, 2, size=(400, 4))
    rows = [(i, x[i].tolist()) for i in range(400)]
    rows += [(7, x[7].tolist())] * 12 + [(900 + i, [1.0, float(i)]) for i in range(5)]
    rows += [(950, [1e200] * 4), (951, [-1e200, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (10, 60):
        got = learned_index.nearest(df, F.lit(True), k, parts=16).toPandas()
        count = got.groupby("query_id").size()
        for i in (*range(400), 950, 951):
            assert count[i] == k
        assert (got.query_id != got.vec_id).all()
        odd = got[got.query_id >= 900]
        assert count[902] == 4 and set(odd[odd.query_id == 902].vec_id) == {900, 901, 903, 904}
    d = {(r.query_id, r.vec_id): r.score for r in got.itertuples()}
    ends = learned_index.distances(np.array([[1e200] * 4, [3.0, 4.0, 0.0, 0.0]]), np.array([-1e200, 0.0, 0.0, 0.0]))
    np.testing.assert_allclose(ends, [np.sqrt(7.0) * 1e200, 1e200])
    assert all(np.isfinite(v) for v in d.values())


def test_number_of_parts_grows_with_the_table():
    assert [learned_index.number_of_parts(n) for n in (0, 131_072, 131_073, 10**6, 10**9)] == [16, 16, 32, 128, 128]


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(100, 8)) + 6 * np.eye(8)[i] for i in range(8)])
    graph = learned_index.neighbours(x, 5)
    part = learned_index.balanced_parts(x, graph, 8)
    assert np.bincount(part).max() <= 1.1 * len(x) / 8 + 1
    assert (part[graph] == part[:, None]).mean() > 0.6
