"""Operators 2, 5 and 10 against the tokenizer libraries themselves."""

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelspark.llm import byte_bpe, common, packing, queries, token_files, vocab
from panelspark.llm import words as W

from corpora import none, odd, odd_rows  # noqa: F401, I001


def reference(name, texts, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
@pytest.mark.parametrize("segment", [64, 1 << 21])
def test_pieces_give_the_same_ids(odd_rows, name, spaced, segment, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(W, "SEGMENT", segment)
    texts = [r[1] for r in odd_rows if len(r[1] or "") < 3000]
    ids, counts = vocab.PieceEncoder(queries.vocabulary(name), spaced).encode(pa.array(texts, pa.string()))
    want = [r[:-1] for r in reference(name, texts, 0)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_recurring_pieces_are_encoded_once(name, spaced, monkeypatch):
    """A full memory lets go of pieces that came up once, not of the common ones, and takes little room."""
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(W, "SEGMENT", 1 << 14)
    common_ones = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    texts = [" " + " ".join([*common_ones, *(f"x{i}y{j}" for j in range(800))]) for i in range(12)]
    encoder = vocab.PieceEncoder(queries.vocabulary(name), spaced, remembered=2_000)
    learned, real = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda *a: learned.extend(a[-1]) or real(*a))
    got = [encoder.encode(pa.array([t], pa.string()))[0].tolist() for t in texts]
    assert got == [r[:-1] for r in reference(name, texts, 0)]
    assert len(learned) == len(set(learned))
    many = vocab.PieceEncoder(queries.vocabulary(name), spaced)
    tracemalloc.start()
    many.encode(pa.array([" ".join(f"q{i}" for i in range(100_000))], pa.string()))
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 10e6


def test_byte_bpe(odd, odd_rows, none):
    ranks = queries.vocabulary("byte_bpe_50k.tiktoken")
    own, _ = byte_bpe.encoding(ranks, public_tokenizers.PATTERN)
    got = byte_bpe.byte_bpe(odd, ranks, public_tokenizers.PATTERN, with_ids=True).collect()
    want = sorted((str(r[0]), own.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in odd_rows)
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in got) == want
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(bytes(r.decoded)).hexdigest()
    assert byte_bpe.byte_bpe(none, ranks, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("size", [3, 10, 100])
def test_spans_are_safe(odd_rows, size):
    own, _ = byte_bpe.encoding(queries.vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in (r[1] or "" for r in odd_rows if len(r[1] or "") < 3000):
        parts = list(byte_bpe.spans(text, size))
        assert "".join(parts) == text
        assert [i for p in parts for i in own.encode_ordinary(p)] == own.encode_ordinary(text)


def test_token_files(spark, odd, odd_rows, none):
    definition = queries.vocabulary("word_bpe_49k.json")
    folder = common.work_dir(spark, "test")
    manifest = token_files.write_token_files(odd, definition, 1, folder)
    got = token_files.read_token_files(spark, folder).orderBy("start").collect()
    encoded = reference("word_bpe_49k.json", [r[1] for r in odd_rows], 1)
    sums = lambda ids: zlib.crc32(np.array(ids, "<u4"))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(r[0]), len(e), sums(e)) for r, e in zip(odd_rows, encoded)
    )
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert manifest["width"] == 2
    folder = common.work_dir(spark, "test")
    token_files.write_token_files(none, definition, 1, folder)
    assert token_files.read_token_files(spark, folder).count() == 0


def packed(spark, docs, capacity):
    pieces = common.stage(packing.document_pieces(docs, queries.vocabulary("byte_bpe_50k.json"), 0, capacity))
    return packing.pack(pieces, capacity).collect()


def test_packing(spark, odd, odd_rows, none):
    capacity = 64
    got = packed(spark, odd, capacity)
    encoded = reference("byte_bpe_50k.json", [r[1] for r in odd_rows], 0)
    want = []
    for row, ids in zip(odd_rows, encoded):
        first = (len(ids) - 1) % capacity + 1
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            want.append((str(row[0]), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4"))))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert [p[0] for p in places] == np.cumsum([0, *[p[1] for p in places]])[:-1].tolist()
        assert sum(p[1] for p in places) <= capacity
    assert len(by) <= math.ceil(1.05 * sum(w[3] for w in want) / capacity) + 1
    assert packed(spark, none, capacity) == []


def test_the_genetic_algorithm_beats_best_fit():
    """Triples that fill a bin exactly: best fit by falling size misses some, the islands find more."""
    rng = np.random.default_rng(3)
    sizes = []
    for _ in range(60):
        a, b = sorted(rng.integers(260, 480, 2).tolist())
        sizes += [a, b, 1000 - a - b]
    falling = sorted(range(len(sizes)), key=lambda x: -sizes[x])
    plain = packing.best_fit(falling, sizes, 1000)
    best = packing.evolve(sizes, 1000, 1, [], 8, 300)[0]
    assert sorted(x for b in best.bins for x in b) == list(range(len(sizes)))
    assert max(best.fill) <= 1000
    assert len(best.bins) <= len(plain.bins) and best.worth(1000) > plain.worth(1000)


def test_islands_go_on_while_they_improve():
    """Triples that fill a bin exactly: an island stops after steps in a row without a better solution, not after so many."""
    rng = np.random.default_rng(3)
    sizes = []
    for _ in range(60):
        a, b = sorted(rng.integers(260, 480, 2).tolist())
        sizes += [a, b, 1000 - a - b]
    steps = []
    real = packing.crossover
    try:
        packing.crossover = lambda *a, **k: steps.append(1) or real(*a, **k)
        best = packing.evolve(sizes, 1000, 1, [], 8, 20)[0]
    finally:
        packing.crossover = real
    assert len(steps) > 20
    assert sorted(x for b in best.bins for x in b) == list(range(len(sizes))) and max(best.fill) <= 1000
