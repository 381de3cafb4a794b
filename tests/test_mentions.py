"""Names found by joins over a trie against a scan of every text from left to right."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from newslens.operators import entities, mentions

DOCS = "`doc_id` long, text string, name string, place int, _node string"


def _words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def _brute(text, names):
    """(place, words, name): the leftmost names, of several the longest."""
    held = {}
    for x in sorted(n for n in names if n and _words(n)):
        held.setdefault(tuple(_words(x)), x)
    words, at, out = _words(text), 0, []
    while at < len(words):
        fits = [n for n in range(1, len(words) - at + 1) if tuple(words[at : at + n]) in held]
        if fits:
            out.append((at, fits[-1], held[tuple(words[at : at + fits[-1]])]))
        at += fits[-1] if fits else 1
    return out


@pytest.mark.parametrize("sent_edges", [mentions.SENT_EDGES, 0])
def test_mentions_are_those_of_a_scan(spark, sent_edges):
    rng = random.Random(sent_edges)
    word = lambda: rng.choice("a a a b b c d e".split())
    names = list(dict.fromkeys(" ".join(word() for _ in range(rng.randrange(1, 5))) for _ in range(14))) + ["A. B!", "É", "U.S.", None, "", "?!"]
    texts = ["".join(word() + rng.choice([" ", ". ", "\n", "--"]) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += [None, "", " ", "é U. S. É", "a " * 3000, "x" * 500]
    rows = [(k if k else None, t, "n", 1, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + [rows[3], (4, "a b", "n", 1, "x")], DOCS)
    table = spark.createDataFrame([(x,) for x in names], "name string")
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.place, r.n_words, r.name) for r in mentions.find_mentions(docs, table, sent_edges=sent_edges).collect())
    assert got == sorted([(k if k else -1, *x) for k, t in enumerate(texts) for x in _brute(t, names)] + [(4, *x) for x in _brute("a b", names)])
    assert len(got) > 300
    assert mentions.find_mentions(docs.limit(0), table, sent_edges=sent_edges).count() == 0
    assert mentions.find_mentions(docs, table.limit(0), sent_edges=sent_edges).count() == 0


def test_a_walk_needs_no_python(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    found = mentions.find_mentions(docs, spark.createDataFrame([("x y",)], "name string"))
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()


def test_countries_of_texts(spark):
    docs = spark.createDataFrame([(1, "The DR Congo, not Congo, met the U.S. and the UAE."), (2, "Nothing here."), (3, "South Korea! North Korea? South.")], "feed_entry_id long, text string")
    lookup = entities.countries(spark)
    names = lookup.select(F.col("key").alias("name"), F.lit("LOC").alias("entity_group"))
    raw = mentions.as_entities(mentions.find_mentions(docs, names, key="feed_entry_id"), names, key="feed_entry_id")
    sources = docs.select("feed_entry_id", F.lit("Iran").alias("sourcecountry"))
    found = {(r.feed_entry_id, r.alpha3): (r["count"], r.avg_score) for r in entities.geo_aggregate(raw, sources, lookup).collect()}
    assert found == {(1, "COD"): (1, 0.7), (1, "COG"): (1, 0.6), (1, "USA"): (1, 0.7), (1, "ARE"): (1, 0.6), (3, "KOR"): (1, 0.7), (3, "PRK"): (1, 0.7), **{(k, "IRN"): (1, 0.5) for k in (1, 2, 3)}}
    merged = entities.merge_entities(raw).where("feed_entry_id = 3").collect()
    assert {(r.category, r.text, r.score) for r in merged} == {("LOC", "South Korea", 0.7), ("LOC", "North Korea", 0.7)}
