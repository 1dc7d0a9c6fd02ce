"""What a task makes of its texts is bounded, however many bytes a batch or a text has."""

import tracemalloc

import pyarrow as pa

from tributary.llm import phrases, words


def peak(made):
    tracemalloc.start()
    result = made()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return result, most


def test_runs_of_a_large_batch():
    texts = [f"one {i} two. three " * 400 for i in range(2_000)] + [None, "", "four"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array(["a" if i % 2 else "b" for i in range(len(texts))])], ["text", "lang"]
    )

    def found():
        return sum(len(phrases.Runs(*part).starts) for part in phrases._flat(batch))

    n, most = peak(found)
    assert n == 2_000 * 400 * 4 + 1
    # Twice as large a batch may not need more.
    assert most < 30 << 20, most
    assert batch.nbytes > 7 * words.SLICE


def test_prefixes_are_made_once_a_slice(monkeypatch):
    """However many lengths of runs are asked for, each polynomial goes over the bytes once."""
    calls, made = [], phrases._Polynomial.prefixes
    monkeypatch.setattr(phrases._Polynomial, "prefixes", lambda p, *a: calls.append(p) or made(p, *a))
    batch = pa.RecordBatch.from_arrays([pa.array(["one two three four five. six " * 9]), pa.array(["a"])], ["text", "lang"])
    (part,) = phrases._flat(batch)
    runs = phrases.Runs(*part)
    for n, places, keys in phrases._candidates(runs, range(1, 6), {}):
        residues = runs.residues(places, n)
        found = {}
        for i, key, residue in zip(places.tolist(), keys.tolist(), residues.tolist()):
            assert found.setdefault(runs.text(i, n), (key, residue)) == (key, residue)
        assert len(set(found.values())) == len(found)
    assert sorted(map(id, calls)) == sorted(map(id, phrases._POLYNOMIALS))
