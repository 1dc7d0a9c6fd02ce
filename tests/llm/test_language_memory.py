"""What a task makes of its texts is bounded, however many bytes a batch or a text has."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tributary.llm import language


def peak(made):
    tracemalloc.start()
    result = made()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return result, most


def model(n):
    table = np.log(np.random.default_rng(1).dirichlet(np.ones(n + 1), language.BINS)).astype(np.float32)
    return language.Model([f"l{i}" for i in range(n)], table, np.full((len(language.LEVELS), n + 1), -9.0))


def test_likelihoods_of_many_and_of_long_texts():
    held = model(8)
    text = "de la mer et du ciel " * 50_000
    (alone, fits), long = peak(lambda: held.likelihoods(pa.array([text])))
    (many, _), wide = peak(lambda: held.likelihoods(pa.array([text[:2000]] * 1000 + [None, "ab"])))
    assert max(long, wide) < 60 << 20
    grams = language._grams(np.frombuffer(text.encode(), np.uint8))
    assert (alone[0] == held.table[grams].sum(axis=0, dtype=np.float64)[:8] / 3).all() and fits.shape == (1, 8)
    grams = language._grams(np.frombuffer(text[:2000].encode(), np.uint8))
    assert (many[:1000] == held.table[grams].sum(axis=0, dtype=np.float64)[:8] / 3).all()
    assert (many[1000:] == 0).all()
