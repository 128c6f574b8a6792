"""Operators 8 and 9: held-out accuracy, fairness, exact counts, and edge cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from panelspark.llm import context_mixing, toxicity
from panelspark.llm import words as W

from corpora import none, odd, odd_rows, prose  # noqa: F401, I001


def held(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def corpus(n=1500, seed=3):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = prose(rng, rng.randint(5, 80)).split(" ")
        bad = int(rng.random() < 0.2)
        for _ in range(bad * rng.randint(1, 3)):
            words[rng.randrange(len(words))] = rng.choice(["zapwort", "zapwortes", "nasty", "Vilely", "scumbag!"])
        rows.append((i, " ".join(words)))
        labels.append((i, bad))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (3, None), (None, 1), (5, labels[5][1])], "doc_id long, toxic int")
    model = toxicity.train(docs, marks, held)
    got = toxicity.score(docs, model).withColumn("held", held(F.col("doc_id"))).where("held").collect()
    truth = dict(labels)
    assert len(got) > 250
    assert sum(r.predicted == truth[r.doc_id] for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_no_leak_from_held_out_labels(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    flipped = marks.withColumn("toxic", F.when(held(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, marks, held), toxicity.train(docs, flipped, held)
    assert (a.feature == b.feature).all() and np.allclose(a.weight, b.weight) and a.bias == b.bias


def test_swapped_identities_score_alike(spark):
    """One group is named mostly in toxic texts; the penalty keeps its mention from counting as toxic."""
    rng, rows, labels = random.Random(1), [], []
    for i in range(800):
        bad = int(rng.random() < 0.3)
        group = rng.choice(["women", "women", "men"]) if bad else rng.choice(["men", "men", "men", "women"])
        words = [*prose(rng, 12).split(" "), group, *(["nasty"] if bad and rng.random() < 0.7 else [])]
        rows.append((i, " ".join(words)))
        labels.append((i, bad))
    sets = toxicity._sets([t for _, t in rows])
    y = np.array([b for _, b in labels], float)
    pairs = [(a, b) for _, t in rows for x, z in toxicity.counterfactuals(t) for a, b in [toxicity._sets([x, z])]]
    gap = {}
    for fairness in (0.0, 5.0):
        model = toxicity.fit(sets, y, pairs if fairness else (), fairness=fairness)
        women, men, nasty = (model.dense()[s].sum() for s in toxicity._sets(["women", "men", "nasty"]))
        gap[fairness] = abs(women - men)
        assert nasty > 1
    assert gap[5.0] < 0.25 * gap[0.0]


def test_sample_keeps_all_documents_beside_their_swaps(spark, monkeypatch):
    """Texts full of group terms take no place of other documents, and repeated rows count once."""
    rng, rows = random.Random(2), []
    for i in range(60):
        rows.append((i, " ".join(f"{prose(rng, 3)} men and women." for _ in range(12)) if i < 30 else prose(rng, 20)))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE", 60)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda sets, y, pairs, times=None: seen.append((sets, y, pairs, times)))
    for copies, parts in ((1, 1), (1, 7), (9, 3)):
        docs = spark.createDataFrame(rows * copies, "doc_id long, text string").repartition(parts)
        toxicity.train(docs, labels, lambda doc_id: F.lit(False))
    for sets, y, pairs, times in seen:
        assert len(sets) == 60 and y.sum() == 12
        assert sum(times) == sum(len(toxicity.counterfactuals(t)) for _, t in rows)
    assert all([s.tobytes() for s in seen[0][0]] == [s.tobytes() for s in other[0]] for other in seen)


def test_driver_gets_only_features_that_fit_uses(spark, monkeypatch):
    """Features are counted on the executors; the model is that of the whole texts, to the last bit."""
    rows, labels = corpus(400)
    docs = spark.createDataFrame([*rows, (7, ""), (9, None)], "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    real, seen = toxicity.fit, []
    monkeypatch.setattr(toxicity, "fit", lambda sets, y, pairs, times=None: seen.append((sets, y)))
    toxicity.train(docs, marks, lambda doc_id: F.lit(False))
    (sets, y), truth = seen[0], dict(labels)
    texts = [(t, truth[i]) for i, t in [*rows, (7, "")]]
    whole = sorted(zip(toxicity._sets([t for t, _ in texts]), [b for _, b in texts]), key=lambda x: (len(x[0]), zlib.crc32(x[0]), x[1]))
    assert len(sets) == len(whole) == 401 and y.tolist() == [b for _, b in whole]
    assert 0 < sum(map(len, sets)) < 0.7 * sum(len(s) for s, _ in whole)
    a, b = real(sets, y), real([s for s, _ in whole], y)
    assert len(a.feature) and (a.feature == b.feature).all() and (a.weight == b.weight).all() and a.bias == b.bias


def test_sample_is_bounded_if_ids_have_many_texts(spark, monkeypatch):
    rows, labels = corpus(30)
    docs = spark.createDataFrame([(i, f"{t} {k}") for i, t in rows for k in range(3)], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE", 40)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda sets, y, pairs, times=None: seen.append((sets, y)))
    for parts in (1, 6):
        toxicity.train(docs.repartition(parts), marks, lambda doc_id: F.lit(False))
    (a, y), (b, z) = seen
    assert len(a) == len(y) == 40 and (y == z).all()
    assert [s.tobytes() for s in a] == [s.tobytes() for s in b]


def test_toxicity_of_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(1, 0), (7, 1), (2, 1), (11, 0)], "doc_id long, toxic int")
    got = toxicity.score(odd, toxicity.train(odd, labels, held)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    model = toxicity.train(none, labels, held)
    assert toxicity.score(none, model).count() == 0
    assert toxicity.score(odd, toxicity.train(odd, labels.where("false"), held)).count() == len(odd_rows)


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), None]


def test_context_mixing(spark, odd, odd_rows):
    out = context_mixing.score(odd, F.col("doc_id") % 5 == 3).collect()
    count = collections.Counter()
    for i, t, *_ in odd_rows:
        if i is None or i % 5 != 3:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    want = collections.Counter()
    for i, t, *_ in odd_rows:
        own = tokens(t)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        want[(i, i is not None and i % 5 == 3, len(own), sum(count[w] > 0 for w in own), n, round(base, 5))] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want
    assert all(math.isfinite(r.score) and r.score < 0 and r.bits_per_byte > 0 for r in out)


def test_held_out_texts_cost_less_than_unigrams(spark):
    """Texts of two vocabularies: the kinds are found, and each text pays for its own words only."""
    rng, rows = random.Random(8), []
    vocabularies = [[prose(rng, 1) + f"{k}x" for _ in range(400)] for k in "ab"]
    for i in range(300):
        words = [vocabularies[i % 2][int(400 * rng.random() ** 2)] for _ in range(120)]
        rows.append((i, " ".join(words + [prose(rng, 1)] * (rng.random() < 0.3))))
    got = context_mixing.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 7 == 2)
    total = got.where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert total[0] > total[1] + 0.2 * total[2]


def test_kinds_are_fitted_on_all_training_texts(spark):
    """Every training text's own word is counted in a kind, however many texts there are and wherever they lie."""
    rng = random.Random(9)
    vocabularies = [[f"{k}{j}" for j in range(60)] for k in "ab"]
    texts = [f"own{i} " + " ".join(rng.choice(vocabularies[i % 2]) for _ in range(30)) for i in range(6000)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    fits = []
    for own in (docs, docs.repartition(5)):
        fits.append(context_mixing._topics(context_mixing._documents(own, "text", "doc_id", F.col("doc_id") % 7 == 2)))
    assert np.array_equal(fits[0].logp, fits[1].logp) and len(fits[0].logp) == context_mixing.CLASSES
    parts = [*context_mixing.W.words(*context_mixing.W.column_bytes(context_mixing.pa.array(texts)))]
    hashes = [p.hashes() for p in parts]
    kind = fits[0].of(parts, hashes, len(texts))
    assert not set(kind[::2]) & set(kind[1::2])
    row, h = np.concatenate([p.row for p in parts]), np.concatenate(hashes)
    bucket = (h[np.flatnonzero(np.diff(row, prepend=-1))] >> np.uint64(64 - context_mixing.BUCKETS)).astype(int)
    words = 31 * np.bincount(kind[np.arange(6000) % 7 != 2], minlength=context_mixing.CLASSES)
    counted = np.exp(fits[0].logp[kind, bucket]) * (words[kind] + 50)
    assert (counted[np.arange(6000) % 7 != 2] > 0.9).all()


def test_words_are_counted_by_kind_in_parts(monkeypatch):
    """However little is held before it goes out, the parts add up to the counts of each word in each kind."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["a", "B", "\u00e9t\u00e9", "x" * 900, f"n{i % 50}"]) for _ in range(rng.randrange(60))) for i in range(400)]
    columns = [pa.array(texts[:150]), pa.array([], pa.string()), pa.array([None, "", " \t"]), pa.array(texts[150:])]
    kinds = context_mixing.Topics(np.log(np.random.default_rng(1).dirichlet(np.ones(1 << context_mixing.BUCKETS), 3)))
    parts = [*W.words(*W.column_bytes(pa.array(texts)))]
    kind = kinds.of(parts, [p.hashes() for p in parts], len(texts))
    nothing = int(kinds.of([], [], 1)[0])
    want = collections.Counter()
    for own, text in zip([*kind.tolist(), *[nothing] * 3], [*texts, None, "", " \t"]):
        want.update((own, t or b"") for t in tokens(text))
    assert len({k for k, _ in want}) == 3
    sent = []
    for held, size, together in ((150_000, 1 << 23, 1 << 20), (40, 1 << 23, 1 << 12), (150_000, 3_000, 1 << 12)):
        monkeypatch.setattr(context_mixing, "HELD", held)
        monkeypatch.setattr(context_mixing, "HELD_BYTES", size)
        monkeypatch.setattr(context_mixing, "TOGETHER", together)
        got, hashes = collections.Counter(), collections.defaultdict(set)
        rows = [r for b in context_mixing._tallied(iter(columns), kinds) for r in b.to_pylist()]
        for r in rows:
            got[(r["class"], r["word"])] += r["n"]
            hashes[r["hash"]].add(r["word"])
        assert +got == want and all(len(v) == 1 for v in hashes.values())
        assert r["hash"] == context_mixing.END
        sent.append(len(rows))
    assert sent[0] < min(sent[1:])


def test_spelling_together_changes_nothing():
    """Probabilities of many words worked out a little at a time are those of each word alone."""
    rng = np.random.default_rng(6)
    code = context_mixing.Code.of(rng.integers(0, 1000, 256))
    model = context_mixing.Model(rng.integers(0, 50, (int(context_mixing.BASES[-1]), 2)).astype(np.float32), code)
    words = [rng.integers(33, 127, n).astype(np.uint8).tobytes() for n in [0, 9_000, *rng.integers(1, 12, 6_000)]]
    got = context_mixing.log10_probabilities(model, words)
    assert len(got) == len(words) and len(context_mixing.log10_probabilities(model, [])) == 0
    for i in (0, 1, 2, 4094, 4095, 4096, 4097, 6001):
        assert math.isclose(got[i], context_mixing.log10_probabilities(model, [words[i]])[0], rel_tol=1e-9)


def test_models_of_two_corpora_do_not_mix(spark):
    """Workers are reused, so a model kept from another table must never score this one."""
    rng = random.Random(11)
    tables = []
    for k in range(2):
        words = [prose(rng, 1) for _ in range(40)]
        rows = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(120)]
        tables.append(spark.createDataFrame(rows, "doc_id long, text string").cache())

    def scores(k):
        return {r["doc_id"]: r["score"] for r in context_mixing.score(tables[k], F.col("doc_id") % 7 == 2).collect()}

    first = [scores(0), scores(1)]
    for k in (0, 1, 0):
        again = scores(k)
        assert all(math.isclose(again[i], first[k][i], rel_tol=1e-9) for i in again)


def test_accepted_rows_are_those_not_predicted(spark, odd):
    rows, labels = corpus(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), held)
    want = sorted(r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 0").collect())
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want
    assert 0 < len(want) < len(rows)
    # all columns stay, whatever they are called
    assert toxicity.accepted(odd, model).columns == odd.columns
    assert toxicity.accepted(odd, model).count() == toxicity.score(odd, model).where("predicted = 0").count()


def test_no_training_rows(spark, none):
    assert context_mixing.score(none, F.lit(False)).count() == 0
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    got = context_mixing.score(docs, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in got)


def test_spelling_is_a_distribution():
    """Over all next bytes, the decisions on the paths sum to one in any state of the tables."""
    rng = np.random.default_rng(0)
    code = context_mixing.Code.of(rng.integers(0, 1000, 256))
    assert abs((0.5 ** code.length.astype(float)).sum() - 1) < 1e-12
    model = context_mixing.Model(rng.integers(0, 50, (int(context_mixing.BASES[-1]), 2)).astype(np.float32), code)
    words = [b"ab" + bytes([b]) for b in range(256)]
    total = 0.0
    for data, contexts, number in context_mixing.spelled(words):
        at = np.flatnonzero(np.append(number[1:] != number[:-1], True)) - 1  # the third byte
        slots, bits, symbol = context_mixing.decisions(code, data[at], contexts[at])
        odds, gate = context_mixing.evidence(model, slots)
        p = context_mixing._refined(model, context_mixing._mixed(odds, model.weights, gate), gate)
        total += np.exp(np.bincount(symbol, np.log(np.where(bits == 1, p, 1 - p)))).sum()
    assert abs(total - 1) < 1e-5
