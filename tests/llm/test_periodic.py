"""Periodic runs against every period tried at every place, odd rows, and texts on which a naive search grows with the square."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from newslens.llm import periodic

DOCS = "doc_id string, text string, runs int, n_words int, _text string"


def _brute(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - at + q >= max(24, 3 * q):
                found.setdefault((at, end - at + q), q)
            at = end + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def _words(rng):
    letters, n, out = rng.choice([1, 2, 2, 3, 5, 30]), rng.randrange(400), []
    while len(out) < n:
        part = [rng.randrange(letters) for _ in range(rng.randrange(1, rng.choice([4, 12, 40, 90])))]
        out += (part * rng.randrange(1, 8))[: rng.randrange(1, 300)] if rng.random() < 0.6 else part
    return out[:n]


def test_runs_are_those_of_brute_force():
    rng, total = random.Random(11), 0
    for _ in range(600):
        words = _words(rng)
        want = _brute(words)
        total += len(want)
        assert periodic.runs_of(np.array(words, dtype=np.int64)) == want
    assert total > 300


@pytest.mark.parametrize("period", [1, 7, 8, 9, 1000, 15000])
def test_long_periodic_texts_take_no_square_time(period):
    began = time.perf_counter()
    words = np.arange(100_000) % period
    words[0] = 100_000
    assert periodic.runs_of(words) == [(1, 99_999, period)]
    assert time.perf_counter() - began < 10


def test_least_sizes():
    run = lambda n, q: periodic.runs_of(np.concatenate([[97], np.arange(n) % q, [98]]).astype(np.int64))
    assert run(23, 1) == [] and run(24, 1) == [(1, 24, 1)] and run(24, 8) == [(1, 24, 8)]
    assert run(26, 9) == [] and run(27, 9) == [(1, 27, 9)] and run(200, 67) == [] and run(201, 67) == [(1, 201, 67)]


def test_rows_of_every_kind(spark):
    rng = random.Random(5)
    line = "one two three four five six"
    texts = [None, "", " \t\n", "x", f"a {line}\n" * 5 + "end", "  " * 30, "é\x0b" * 24, " ".join([line] * 4), " ".join(["w"] * 5000), *(" ".join(f"v{x}" for x in _words(rng)) for _ in range(40))]
    ids = [None if k == 3 else str(k // 2) for k in range(len(texts))]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in zip(ids, texts, strict=True)] * 2, DOCS)
    rows = periodic.periodic_runs(docs, keep=("doc_id", "text", "_text")).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        words = [x for x in (r.text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if x]
        want = _brute(words)
        gone = {k for s, n, q in want for k in range(s + q, s + n)}
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), want)
        assert r.collapsed == " ".join(w for k, w in enumerate(words) if k not in gone)
    assert periodic.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, keep=("runs",))
