"""The toxicity classifier: held-out accuracy, its numpy parts against plain loops and differences, odd rows."""

from __future__ import annotations

import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.llm import toxicity

SF_DIR = "/root/testdata/sf0.01"


def _corpus(rng, n, langs=("en", "de")):
    """Texts in languages of their own words; toxic ones hold a word or a stem that tells."""
    rows = []
    for k in range(n):
        lang = rng.choice(langs)
        words = [f"{lang}{chr(97 + rng.randrange(20))}{chr(97 + rng.randrange(20))}" for _ in range(rng.choice([5, 40, 300]))]
        toxic = int(rng.random() < 0.25)
        for _ in range(toxic * rng.randrange(1, 4)):
            words.insert(rng.randrange(len(words)), "vile" if lang == "en" else "scheuss" + rng.choice(["lich", "tat", "werk", "ung", "or"]))
        rows.append((k, " ".join(words), lang, toxic))
    return rows


def test_words_and_beginnings():
    texts = ["Éabcdefgh x, loWer lowering lowerings", "", "lowerin!", "x" * 9]
    hashes, bounds = toxicity.word_features(texts)
    words = [re.findall(r"\w+", t.lower()) for t in texts]
    assert np.diff(bounds).tolist() == [len(x) for x in words]
    flat = [(w, *(w[:k] if len(w) > k else "" for k in toxicity.STEMS)) for x in words for w in x]
    for column in range(hashes.shape[1]):
        names: dict[str, int] = {}
        for row, h in zip(flat, hashes[:, column].tolist(), strict=True):
            assert (h == 0) == (row[column] == "") and names.setdefault(row[column], h) == h
        assert len(set(names.values())) == len(names)


def test_pieces_give_the_same_words(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join("abcdefgh"[: rng.randrange(1, 9)] for _ in range(rng.randrange(60))) for _ in range(9)]
    want = toxicity.word_features(texts)
    monkeypatch.setattr(toxicity, "PIECE", 64)
    got = toxicity.word_features(texts)
    assert all((a == b).all() for a, b in zip(want, got, strict=True))


def test_filters_and_pools_are_those_of_plain_loops(monkeypatch):
    monkeypatch.setattr(toxicity, "SEGMENT", 5)
    monkeypatch.setattr(toxicity, "_WORDS", 7)
    rng = np.random.default_rng(4)
    keys = np.arange(1, 40, dtype=np.uint64)
    model = toxicity._new_model(keys, rng.normal(size=39), ["a"], rng)
    model.bias[:] = rng.normal(size=len(model.bias))
    sizes = [0, 1, 4, 5, 6, 23]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    rows = rng.integers(0, 40, (bounds[-1], 3)).astype(np.int32)
    got = toxicity._pooled(model, *toxicity._laid_out(rows, bounds))
    for k, n in enumerate(sizes):
        vectors = np.concatenate([model.embedding[rows[bounds[k] : bounds[k + 1]]].sum(axis=1), np.zeros((9, toxicity.DIM))])
        maxima = []
        for low in range(0, max(n, 1), 5):
            out = [np.concatenate([sum(vectors[p + j] @ f[j] for j in range(len(f))) for f in model.filters]) + model.bias for p in range(low, min(low + 5, max(n, 1)))]
            maxima.append(np.maximum(np.max(out, axis=0), 0))
        want = np.concatenate([np.max(maxima, axis=0), np.mean(maxima, axis=0)])
        assert np.allclose(got[k], want, atol=1e-4), n


def test_threshold_makes_fewest_errors():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(2, 12))
        odds, toxic, weight = rng.normal(size=n).round(1), rng.integers(0, 2, n), rng.integers(1, 4, n).astype(float)
        errors = lambda t: weight[(odds >= t) != (toxic == 1)].sum()
        tried = [*(np.unique(odds) - 0.01), odds.max() + 1]
        assert errors(toxicity.best_threshold(odds, toxic, weight)) <= min(map(errors, tried)) + 1e-9


def test_an_unknown_word_is_no_known_one():
    keys = np.array([5, 5 + toxicity.SLOTS, 9], dtype=np.uint64)
    model = toxicity._new_model(keys, np.array([0.1, 3.0, 1.0]), [], np.random.default_rng(0))
    assert model.rows(np.array([5 + toxicity.SLOTS, 9, 9 + toxicity.SLOTS, 0, 77], dtype=np.uint64)).tolist() == [2, 3, 0, 0, 0]
    assert model.rows(np.array([5], dtype=np.uint64)).tolist() == [0] and not model.embedding[0].any()


def test_it_learns_words_and_stems(spark):
    rows = _corpus(random.Random(3), 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.learn(docs.where("doc_id < 700"), docs.where("doc_id < 700").select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.score(docs.where("doc_id >= 700"), model).collect()}
    wrong = sum(got[k].predicted != toxic for k, _, _, toxic in rows[700:])
    assert wrong <= 4 and sum(got[k].lang_read == lang for k, _, lang, _ in rows[700:]) >= 195
    assert all((r.score >= 0.7) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got.values())
    again = toxicity.learn(docs.where("doc_id < 700").repartition(7), docs.where("doc_id < 700").select("doc_id", "toxic").repartition(3))
    assert [tuple(r) for r in toxicity.score(docs, again).orderBy("doc_id").collect()] == [tuple(r) for r in toxicity.score(docs, model).orderBy("doc_id").collect()]


def test_odd_rows(spark):
    rows = _corpus(random.Random(5), 120)
    odd = [(None, "vile", "en", 1), (1, None, None, None), (2, "", "en", 1), (3, "!?", "xx", 0), (4, "vile " * 40_000, "en", 1), (5, "enaa", None, None), (5, "enaa", None, None)]
    schema = "doc_id long, text string, lang string, toxic int"
    docs = spark.createDataFrame(odd, schema).withColumns({"key": F.lit(1), "weight": F.lit("x"), "_text": F.lit(2)})
    labelled = spark.createDataFrame(rows, schema)
    labels = labelled.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (7, None), (8, 0), (8, 0)], "doc_id long, toxic int"))
    model = toxicity.learn(labelled, labels)
    found = toxicity.score(docs, model, keep=("doc_id", "_text", "weight")).collect()
    assert len(found) == len(odd) and [r.doc_id for r in found].count(5) == 2
    by = {r.doc_id: r for r in found}
    assert by[1].score == by[2].score == by[3].score < 0.7 <= by[4].score and by[None].predicted == 1
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert toxicity.learn(labelled, labels.limit(0)) is None
    assert {(r.score, r.predicted, r.lang_read) for r in toxicity.score(docs, None).collect()} == {(0.0, 0, None)}
    one = toxicity.learn(labelled.where("toxic = 0"), labels.where("toxic = 0"))
    assert len(toxicity.score(docs, one).collect()) == len(odd)


def test_held_out_documents(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    found = {r.doc_id: r for r in toxicity.op13_toxicity(spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in found.items())
    held = [(found[r.doc_id].predicted, r.toxic) for r in labels if found[r.doc_id].held_out]
    assert sum(p and t for p, t in held) >= 0.75 * sum(t for _, t in held) and sum(p and not t for p, t in held) <= 2


def test_every_labelled_document_counts(spark, monkeypatch):
    """A word of three documents among 8000 labelled ones, of which a sample would miss some, has an embedding; shards agree on what all need."""
    rng = random.Random(11)
    rows = [(k, " ".join(f"en{rng.choice('abcdefgh')}{rng.choice('abcdefgh')}" for _ in range(6)) + (" vile" if k % 4 == 0 else ""), "en", int(k % 4 == 0)) for k in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    fit = [r.doc_id for r in docs.where(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)) != 0).where("doc_id % 4 = 1").orderBy(F.xxhash64("doc_id")).collect()]
    rare = fit[-3:]
    docs = docs.withColumn("text", F.when(F.col("doc_id").isin(rare), F.concat("text", F.lit(" seldom"))).otherwise(F.col("text")))
    model = toxicity.learn(docs, docs.select("doc_id", "toxic"))
    hashes, _ = toxicity.word_features(["seldom vile"])
    assert (model.rows(hashes[:, 0]) > 0).all()
    wrong = toxicity.score(docs, model, keep=("doc_id", "toxic")).where("predicted <> toxic").count()
    assert wrong == 0


def test_thresholds_come_from_counts():
    counts = [(True, 0, -2000, 50, 0), (True, 0, 1000, 20, 20), (True, 1, 3000, 40, 0), (True, 1, 5000, 30, 30), (False, 0, 0, 9, 9)]
    found = toxicity._thresholds(counts, ["a", "b", "c"])
    assert found["a"] == -0.5 and found["b"] == 4.0 and set(found) == {"", "a", "b"}
    assert toxicity._thresholds([(True, 0, 0, 5, 0), (False, 0, 1000, 5, 5)], ["a"]) == {"": 0.5}
