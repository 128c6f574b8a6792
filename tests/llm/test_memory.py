"""Memory of a Python worker beside the other stages of the pipeline."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from panelspark.llm import context_mixing, paragraphs, shingles, toxicity
from panelspark.llm import words as W

from corpora import prose


def test_words_of_a_batch_take_bounded_memory():
    """A batch of Arrow is worked off in slices, so its size does not decide what the arrays of its words take."""
    text = prose(random.Random(1), 2_000)
    column = pa.array([text] * (8_000_000 // len(text)))
    paragraphs._powers(1)
    for _ in paragraphs._words(column.slice(0, 1)):
        pass
    tracemalloc.start()
    rows = 0
    for lo, part in shingles.slices(column, paragraphs.SLICE):
        for row, *_ in paragraphs._words(part):
            rows += len(np.unique(row))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(column)
    assert peak < 60e6


def test_scoring_a_batch_takes_bounded_memory():
    """Words and stems of a batch are worked on a little text at a time, so a worker stays small beside the executor."""
    text = prose(random.Random(1), 2_000)
    column = pa.array([text] * (8_000_000 // len(text)))
    model = np.arange(100), np.ones(100), -1.0
    W._powers.clear()
    tracemalloc.start()
    got = next(toxicity._probabilities(model, iter([column])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    W._powers.clear()
    assert len(got) == len(column) and len(np.unique(got)) == 1
    assert peak < 80e6


def test_fit_takes_bounded_memory():
    """The driver holds the sample's entries as narrow integers; sums over them are taken a little at a time."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2_000, 1_000).astype(np.int32)) for _ in range(4_000)]
    y = (rng.random(len(sets)) < 0.1).astype(float)
    entries = sum(map(len, sets))
    tracemalloc.start()
    toxicity.fit(sets, y, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6 + 16 * entries


def test_counting_distinct_words_takes_bounded_memory():
    """Words that are held until they are added up take their bytes, not an object each, and few are held."""
    column = pa.array([" ".join(f"word{i}" for i in range(lo, lo + 1_000)) for lo in range(0, 1_000_000, 1_000)])
    kinds = context_mixing.Topics(np.full((1, 1 << context_mixing.BUCKETS), -9.0))
    W._powers.clear()
    old, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(pool)
    tracemalloc.start()
    rows = sum(len(batch) for batch in context_mixing._tallied(iter([column]), kinds))
    peak = tracemalloc.get_traced_memory()[1] + pool.max_memory()
    tracemalloc.stop()
    pa.set_memory_pool(old)
    W._powers.clear()
    assert rows == 1_000_001  # and the ends
    assert peak < 70e6
