"""The corpus queries that have SQL give the SQL's rows: on the small standard tables, and on odd rows."""

from __future__ import annotations

import os
import random

import duckdb
import pytest

from newslens.llm.registry import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "benchmark", "conversations")


def _same(spark, name, where):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{where}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{where}/{t}.parquet{'/*.parquet' if os.path.isdir(f'{where}/{t}.parquet') else ''}')")
    found = con.execute(ORACLE_SQL[name])
    columns = [x[0] for x in found.description]
    frame = QUERIES[name](spark, str(where))
    assert sorted(columns) == sorted(frame.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)
    assert rows == sorted(map(tuple, found.fetchall()), key=str) and rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_standard_tables(spark, name):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    _same(spark, name, SF_DIR)


@pytest.mark.parametrize("name", ["op1_benchmark_leaks", "op3_jump_shards", "op4_bagminhash_near_dups", "op11_periodic_runs"])
def test_odd_rows(spark, tmp_path, name):
    rng = random.Random(17)
    word = lambda: f"w{rng.randrange(200)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 3, 7, 8, 10, 13, 40])))) for k in range(14)] + [(50, None), (51, ""), (None, "a b c d e f g h")]
    texts = [None, "", " ", "!!!", "!!!", "x", "x", "é ü ß", "\U0001f600 漢字", "one two", "One, two!", "word " * 40, "word " * 41]
    for _ in range(80):
        body = [word() for _ in range(rng.randrange(5, 60))]
        part = rng.choice([t for _, t in items if t]).split()
        for k in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = word()
        texts += [" ".join(body + part), " ".join([*body, *part, word()])]
    if name == "op11_periodic_runs":
        texts += [" \t\u00a0 ", "a\x0bb\x0cc " * 9, *(" ".join((words := [word() for _ in range(rng.randrange(1, 40))]) * 4 + words[: rng.randrange(40)]) for _ in range(60))]
    if name in ("op3_jump_shards", "op11_periodic_runs"):
        docs = [(rng.choice([None, -5, 7, 1 << 60, k]), t) for k, t in enumerate(texts + texts)]
    else:
        docs = list(enumerate(texts))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    _same(spark, name, tmp_path)
