"""Collocations against counting every phrase as a string, with blocks of every size; perfect hashes against a dictionary."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.llm import collocations, perfect_hash
from newslens.runtime import stash

DOCS = "doc_id long, text string, lang string, `n` int, `group` string, ids int, `a.b` string"


def _brute(rows, least, longest, absorbed=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    f[lang or "und", words[at : at + size]] += 1
    f = {k: a for k, a in f.items() if a >= least}
    gone = {(g, long[s:e]) for (g, long), a in f.items() for s in range(len(long)) for e in range(s + 2, len(long) + 1) if e - s < len(long) and 100 * a >= absorbed * f[g, long[s:e]]}
    out = []
    for (g, words), a in f.items():
        if len(words) > 1 and (g, words) not in gone:
            score, _, left, right = min((2_000_000 * a // (f[g, words[:k]] + f[g, words[k:]]), k, f[g, words[:k]], f[g, words[k:]]) for k in range(1, len(words)))
            out.append((g, " ".join(words), a, left, right, score, n[g]))
    return sorted(out)


def _texts(rng, n):
    vocabulary = ["the", "The", "a", "é", "É", "漢", "x\x1cy", "z z", *(f"w{k}" for k in range(12))]
    phrases = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(2, 7))) for _ in range(8)]
    for _ in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.5 else rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))]
        yield "".join(p + rng.choice([" ", " ", "\t ", ". ", ", ", "\n", "\x0b", "  "]) for p in parts)


@pytest.mark.parametrize("block", [perfect_hash.BLOCK, 40])
def test_collocations_are_those_of_brute_force(spark, block, monkeypatch):
    rng = random.Random(block)
    if block == 40:
        monkeypatch.setattr(perfect_hash.perfect_hash, "__defaults__", (20,))
    rows = [(t, rng.choice(["en", "de", None, "und"])) for t in _texts(rng, 120)]
    rows += [(None, "en"), ("", None), (" ", "fr"), ("once", "it"), ("go go go go go " * 40, "en")] + rows[:10]
    docs = spark.createDataFrame([(k, t, g, 1, "x", 2, "y") for k, (t, g) in enumerate(rows)], DOCS).repartition(5)
    columns = ["group", "phrase", "a", "l", "r", "score", "n"]
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=6, longest=3 if block == 40 else 4, block=block).select(*columns).collect())
    want = _brute(rows, 6, 3 if block == 40 else 4)
    assert got == want and len(want) > 30


def test_tables_without_phrases(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", 1, "x", 2, "y"), (2, None, None, 1, "x", 2, "y")], DOCS)
    for some in (docs, docs.limit(0)):
        assert collocations.top_of_each(collocations.collocations(some)).collect() == []
    other = collocations.collocations(docs.withColumn("a.b", F.repeat(F.lit("p q. "), 40)), text="a.b", group="ids")
    assert [tuple(r) for r in other.select("group", "phrase", "a", "l", "r", "score", "n").collect()] == [("2", "p q", 80, 80, 80, 1_000_000, 160)]


def test_scores_are_exact_beyond_64_bits(spark):
    a = 9_000_000_000_000_000_001
    rows = spark.createDataFrame([(a, [a + 5, a], [a + 9, a]), (7, [10, 7], [11, 7])], "a long, heads array<long>, tails array<long>")
    got = rows.select(collocations._lowest_cut(2).alias("c")).select("c.*").collect()
    assert [tuple(r) for r in got] == [(2_000_000 * a // (2 * a + 14), 1, a + 5, a + 9), (2_000_000 * 7 // 21, 1, 10, 11)]


def test_ranks_break_ties_by_count_and_bytes(spark):
    rng = random.Random(3)
    rows = [(g, p, rng.randrange(3), rng.randrange(3)) for g in "xy" for p in ["é", "z", "𠀀", "ﬁ", "aa", "a", "b", "Z"]]
    found = collocations.top_of_each(spark.createDataFrame(rows, "`group` string, phrase string, a long, score long"), top=5).collect()
    for g in "xy":
        want = sorted((x for x in rows if x[0] == g), key=lambda x: (-x[3], -x[2], x[1].encode()))[:5]
        assert [(r["group"], r.phrase, r.a, r.score, r["rank"]) for r in sorted(found, key=lambda r: r["rank"]) if r["group"] == g] == [(*x, k + 1) for k, x in enumerate(want)]


def test_perfect_hash_numbers_keys_and_nothing_else(spark):
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(-50, 50, (4000, 2)), axis=0)
    keys[:3] = [[-(1 << 63), (1 << 63) - 1], [0, 0], [1 << 40, -7]]
    keys = np.unique(keys, axis=0)
    table = spark.createDataFrame(keys.tolist(), "p long, q long")
    held = perfect_hash.perfect_hash(table, len(keys), bucket=300)
    ids = {(r.first, r.second): r.id for r in held.keys().collect()}
    assert sorted(ids.values()) == list(range(len(keys))) and set(ids) == set(map(tuple, keys.tolist())) and len(held) == len(keys)
    asked = np.concatenate([keys, rng.integers(-80, 80, (5000, 2))])
    out = np.full(len(asked), -1)
    blocks = list(held.blocks(700))
    assert len(blocks) > 3
    for block in blocks:
        out = np.maximum(out, block.numbers(asked[:, 0], asked[:, 1]))
    assert out.tolist() == [ids.get(tuple(x), -1) for x in asked.tolist()]


def test_keys_of_equal_hash_get_another_salt(spark, monkeypatch):
    real = collocations.word_keys
    monkeypatch.setattr(collocations, "word_keys", lambda words, group, salt: np.ones(len(words), dtype=np.int64) if salt == 0 else real(words, group, salt))
    docs = spark.createDataFrame([("a b " * 40, "en")], "text string, lang string").withColumnRenamed("lang", "group")
    words, salt = collocations._words(docs.coalesce(1), 30)
    assert salt == 1 and words.count() == 2


def test_passes_over_several_blocks_write_rows_of_bounded_size(spark, monkeypatch):
    """The corpus as numbers, between the blocks of a hash too, lies in rows of a few hundred KB and row groups that follow their size."""
    written = []

    def kept(df, tag, options=None):
        out = stash(df, tag, options)
        if {x.dataType.typeName() for x in df.schema} == {"binary"}:
            written.append((out, options))
        return out

    monkeypatch.setattr(collocations, "stash", kept)
    monkeypatch.setattr(perfect_hash.perfect_hash, "__defaults__", (20,))
    rng = random.Random(2)
    text = "".join(f"w{rng.randrange(30)}" + rng.choice([" ", " ", "."]) for _ in range(400_000))
    docs = spark.createDataFrame([(text, "en")], "text string, lang string")
    got = collocations.collocations(docs, least=300, longest=2, block=20).select("group", "phrase", "a").collect()
    counts = Counter(f"{a} {b}" for piece in text.split(".") for a, b in pairwise(piece.split(" ")) if a and b)
    assert {r.phrase: r.a for r in got} == {p: n for p, n in counts.items() if n >= 300}
    assert any(len(df.columns) == 2 for df, _ in written)
    for df, options in written:
        assert options == collocations.LONG_ROWS
        assert all(n is None or n <= 9 * collocations.ROW for n in df.agg(*(F.max(F.length(c)) for c in df.columns)).first())
