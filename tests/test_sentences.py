"""Sentences from the statistics of a corpus: hard cases, odd rows, the ratio against its definition."""

from __future__ import annotations

import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from newslens.operators import sentences
from newslens.plans import reports

HARD = {
    "The U.S. officials met. They left.": ["The U.S. officials met.", "They left."],
    "Dr. Smith saw it. He ran!": ["Dr. Smith saw it.", "He ran!"],
    "It was approx. ten. It ended.": ["It was approx. ten.", "It ended."],
    "They met J. Jones. It rained.": ["They met J. Jones.", "It rained."],
    'He said "Stop." They did.  Really?\nYes.': ['He said "Stop."', "They did.", "Really?", "Yes."],
    "We met in the U.S. It was fine.": ["We met in the U.S.", "It was fine."],
    "Costs rose 3.5 per cent. they say.": ["Costs rose 3.5 per cent. they say."],
    "no mark at all": ["no mark at all"],
}


def _corpus(rng):
    names, things = ["Smith", "Jones", "Brown", "Miller"], ["house", "river", "garden", "street", "council", "budget", "road"]
    for _ in range(400):
        lines = []
        for _ in range(rng.randrange(2, 6)):
            kind = rng.random()
            start = rng.choice(["The", "It", "They", "He", "We"])
            if kind < 0.2:
                lines.append(f"{start} saw Dr. {rng.choice(names)} near the {rng.choice(things)}.")
            elif kind < 0.4:
                lines.append(f"{start} asked the U.S. {rng.choice(things)} about approx. {rng.choice(things)}.")
            else:
                lines.append(f"{start} left the {rng.choice(things)} at the {rng.choice(things)}{rng.choice('...!?')}")
        yield " ".join(lines)


def test_hard_cases(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(_corpus(random.Random(4)))], "doc_id long, text string")
    model = sentences.learn(docs)
    found = {r.type for r in model["abbreviations"].collect()}
    assert found == {"dr", "u.s", "approx"}
    # "the" stands within sentences just as often
    assert {"it", "they", "he", "we"} == {r.type for r in model["starters"].collect()}
    cases = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    got = {r.doc_id: r.sentences for r in sentences.split(cases, model).collect()}
    assert got == dict(enumerate(HARD.values()))
    assert all("".join(t.split()) == "".join("".join(got[k]).split()) for k, t in enumerate(HARD))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "One. Two. three.", 1), (None, "One. Two. three.", 1), (3, "A", 1), (3, "B. C?", 1), (4, "x. " * 500, 1)], "doc_id long, text string, type int")
    model = sentences.learn(docs)
    got = sorted(((r.doc_id or 0, r.sentences) for r in sentences.split(docs, model).collect()), key=str)
    assert (0, ["One.", "Two. three."]) in got and (1, []) in got and (2, []) in got and (3, ["A"]) in got and len(got) == 6
    assert sum(len(" ".join(s).replace(" ", "")) for k, s in got if k == 4) == 1000
    none = sentences.learn(docs.limit(0))
    assert [x.count() for x in none.values()] == [0, 0, 0]
    assert sentences.split(docs.limit(0), none).collect() == []
    assert {tuple(r.sentences) for r in sentences.split(docs.where("doc_id = 2"), none).collect()} == {()}


def test_ratio_is_that_of_two_binomials(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(60):
        n = rng.randrange(50, 5000)
        first, second = rng.randrange(1, n), rng.randrange(1, n)
        rows.append((rng.randrange(max(0, first + second - n), min(first, second) + 1), first, second, n))
    got = spark.createDataFrame(rows, "a long, b long, c long, n long").select("a", "b", "c", "n", sentences.ratio(F.col("a"), F.col("b"), F.col("c"), F.col("n")).alias("x")).collect()

    def log_of(k, n, p):
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n - k else 0.0)

    for a, b, c, n, x in got:
        want = 2 * (log_of(a, b, a / b) + log_of(c - a, n - b, (c - a) / (n - b)) - log_of(a, b, c / n) - log_of(c - a, n - b, c / n))
        assert abs(x - want) < 1e-6 * max(1, abs(want)) and x >= -1e-6


def test_words_are_counted_before_patterns(spark, monkeypatch):
    plans = {}

    def seen(df, tag):
        plans[tag] = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return df

    monkeypatch.setattr(sentences, "stash", seen)
    docs = spark.createDataFrame([(1, "One Mr. Two. Three")], "doc_id long, text string")
    sentences.learn(docs)
    for tag, words in (("types", "word"), ("pairs", "last|following")):
        # the lowest line runs first: words are grouped before the patterns that read them
        pattern = max(k for k, x in enumerate(plans[tag]) if re.search(rf"regexp_replace\(({words})#", x))
        assert any(re.search(rf"Aggregate \[({words})#", x) for x in plans[tag][pattern:]), plans[tag]


_MODEL = {"abbreviations": "type string, score double", "starters": "type string, score double", "collocations": "first string, second string, score double"}


def test_texts_are_shuffled_once(spark):
    docs = spark.createDataFrame([(1, "One Mr. Two. Three")], "doc_id long, text string")
    plan = sentences.split(docs, {k: spark.createDataFrame([], x) for k, x in _MODEL.items()})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_joins_of_sentences_with_large_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(_corpus(random.Random(4)))], "doc_id long, text string")
    model = sentences.learn(docs)
    cases = spark.createDataFrame(list(enumerate([*HARD, "A\x01b Dr. \x01 Smith. x", " . U.S. They U.S.", "x.\x01Dr. Y. dr. \x0b Z!"])), "doc_id long, text string")
    sent = {r.doc_id: r.sentences for r in sentences.split(cases, model).collect()}
    monkeypatch.setattr(sentences, "SENT", 0)
    assert sent == {r.doc_id: r.sentences for r in sentences.split(cases, model).collect()}
    assert [sent[len(HARD) + k] for k in range(3)] == [["A", "b Dr. Smith. x"], [".", "U.S.", "They U.S."], ["x. Dr. Y. dr. Z!"]]


def test_many_fragments_of_one_sentence(spark):
    docs = spark.createDataFrame([(1, "Dr. " * 60000 + "Smith. He ran.")], "doc_id long, text string")
    model = {k: spark.createDataFrame([("dr", 1.0)] if k == "abbreviations" else [], x) for k, x in _MODEL.items()}
    assert [len(x) for x in sentences.split(docs, model).first().sentences] == [4 * 60000 + 6, 7]


#: Texts without a sentence; blanks that aren't white space; line ends of Unicode; a text's own \x01; letters whose case is odd.
ODD = {
    "empty": [None, "", " \n\t", "\u00a0 \u3000"],
    "blanks": ["\u00a0The house.\u00a0 \u2003He left.\u3000 It rained.", "Dr.\u00a0 Smith ran. \u202fThey ran."] * 2,
    "line ends": ["They saw Q\u2028. Smith and Q.\u2028 it."] * 20 + ["He saw Dr.\u2028 Smith, \u2029 and it.\u0085 They a.\u2028 ran,\u2028 He", "It,\u2029 approx.\u2029 ten. We"] * 20,
    "cuts": ["The ho\x01use. He\x01y ran ho\x01use.", "us\x01e. Dr.\x01Smith"] * 20,
    "letters": ["\u0130t \u01c5. \u03a3\u0391\u03a3. The \U00010400. \u01c5 It \u2167. \ufb01 saw \u1c90."] * 3,
}


@pytest.mark.parametrize("name", ["sentence_statistics", "learnt_sentences"])
@pytest.mark.parametrize("kind", sorted(ODD))
def test_odd_texts_give_the_rows_of_the_sql(spark, tmp_path, kind, name):
    texts = [*_corpus(random.Random(4)), *ODD[kind]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = reports.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({reports.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
