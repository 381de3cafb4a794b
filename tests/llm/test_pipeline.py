"""Every stage of the corpus pipeline against brute force on a small fixture with odd rows."""

from __future__ import annotations

import os
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newslens import runtime
from newslens.llm import common, langid, packing, pii
from tests.llm.test_operators import ODD, _classes, _leaks

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
#: Columns of documents, and some whose names clash with inner ones.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _node long, _gone string, lang_pred string, one int, `a``b` int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, g, None, None if t is None else len(t), 0.5, 1, "g", "x", 1, 2) for i, t, g in rows], SCHEMA)


def _texts(rng, n, alphabet):
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 8))) for _ in range(60)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(8, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    out = [(k, t, None) for k, t in enumerate(ODD)] + [(None, "ab cd ef", "aa"), (None, None, None)]
    for k, (name, alphabet) in enumerate((("aa", "abcdefgh"), ("bb", "mnopqrst"), ("cc", "абвгдежз"))):
        out += [(100 * (k + 1) + j, t, name) for j, t in enumerate(_texts(rng, 40, alphabet))]
    # a script that no language has, and copies, near copies and equal rows
    out += [(900 + j, t, None) for j, t in enumerate(_texts(rng, 12, "αβγδεζηθικλμ"))]
    for j in range(10):
        i, t, g = out[len(ODD) + 2 + 5 * j]
        out += [(1000 + j, t, g), (1100 + j, t + " " + t.split()[0], g), (i, t, g)]
    return out


def test_language_keeps_what_the_naive_cosines_keep(spark, rows):
    got = STAGES["language_id"](spark, _frame(spark, rows), SF_DIR)
    assert got.columns == corpus_pipeline.COLUMNS

    def vector(text):
        letters = [c if c.isalpha() else " " for c in re.sub(r"[^\W\d_]+|.", lambda m: m[0] if m[0].isalpha() else " ", f" {text} ".lower(), flags=re.S)]
        out = np.zeros(langid.DIM)
        for k in range(len(letters) - 2):
            gram = letters[k : k + 3]
            if any(a == b == " " for a, b in zip(gram, gram[1:], strict=False)):
                continue
            out += np.prod([langid.letter_vector(0 if c == " " else ord(c), j, langid.DIM).astype(float) for j, c in enumerate(gram)], axis=0)
        return out

    taught = [r.doc_id for r in _frame(spark, rows).where(~langid.held_out()).collect()]
    profiles = {}
    for i, t, g in rows:
        if g is not None and t is not None and i in taught and any(c.isalpha() for c in t):
            v = vector(t)
            profiles[g] = profiles.get(g, 0) + v / max(np.linalg.norm(v), 1e-9)
    want = []
    for i, t, _ in rows:
        letters = sum(c.isalpha() for c in t or "")
        if letters:
            v = vector(t)
            cosine = max(float(v @ p) / max(1e-9, np.linalg.norm(v) * np.linalg.norm(p)) for p in profiles.values())
            if letters < langid.SHORT or cosine >= langid.LEAST_COSINE:
                want.append((i, t))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)
    assert not {i for i, _ in want} & set(range(900, 1000)) and {x for x, _, g in rows if g and x} <= {i for i, _ in want}


def test_near_dedup_keeps_one_of_each_class(spark, rows):
    got = STAGES["near_dedup"](spark, _frame(spark, rows), SF_DIR)
    assert got.columns == corpus_pipeline.COLUMNS
    kept = Counter(r.doc_id for r in got.collect())
    assert kept == Counter([*set(_classes([(i, t) for i, t, _ in rows]).values()), None, None])


def test_decontamination_drops_what_holds_a_passage(spark, rows, tmp_path):
    rng = random.Random(5)
    items = [(k, t) for k, t in enumerate(_texts(rng, 12, "abcdefgh")) if len(t.split()) >= 14]
    spark.createDataFrame([*items, (None, "ab cd ef gh ab cd ef gh"), (77, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    dirty = []
    for j, (_, item) in enumerate(items):
        passage = item.split()[:14]
        passage[6] = "changed"
        dirty.append((2000 + j, f"{rows[40 + j][1]} {' '.join(passage)} end", "aa"))
    everything = [*rows, *dirty]
    got = STAGES["decontamination"](spark, _frame(spark, everything), str(tmp_path))
    assert got.columns == corpus_pipeline.COLUMNS
    gone = {k for k, _ in _leaks([t for _, t, _ in everything], items)}
    assert {everything[k][0] for k in gone} == {i for i, _, _ in dirty}
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((i, t) for k, (i, t, _) in enumerate(everything) if k not in gone)


def test_personal_data_is_replaced_and_nothing_else(spark, rows):
    extra = [(3000 + k, t, "aa") for k, t in enumerate(["mail a.b@c.org now", "from 10.0.0.1 or 10.0.0.999", "card 4111 1111 1111 1111.", "call +1 (706) 555-3138 or 706 555 3138", "x@y", "plain 12"] * 4)]
    frame = _frame(spark, [*rows, *extra])
    got = STAGES["personal_data"](spark, frame, SF_DIR)
    assert got.columns == corpus_pipeline.COLUMNS
    spans = {}
    for r in pii.find(frame, pii.learn(frame)).collect():
        spans[r.doc_id] = sorted((int(b), int(c), a) for a, b, c in (x.split(":") for x in r.spans.split(",") if x))

    def clean(i, t):
        if t is None:
            return None
        out, done = "", 0
        for a, b, kind in spans[i]:
            if a >= done:
                out += t[done:a] + f"[{kind.upper()}]"
            done = max(done, b)
        return out + t[done:]

    want = Counter((i, clean(i, t)) for i, t, _ in [*rows, *extra])
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want
    assert all((r.n_chars is None) == (r.text is None) and (r.text is None or r.n_chars == len(r.text)) for r in got.collect())
    assert {(3000, "mail [EMAIL] now"), (3001, "from [IP] or 10.0.0.999"), (3002, "card [CARD]."), (3004, "x@y"), (3005, "plain 12")} <= set(want)


def test_packing_holds_every_token_once(spark, rows):
    got = STAGES["packing"](spark, _frame(spark, rows), SF_DIR).collect()
    assert Counter(r.doc_id for r in got for _ in range(r.n_tokens)) == Counter(i for i, t, _ in rows for _ in range(len((t or "").encode()) + 1))
    bins = {}
    for r in got:
        bins.setdefault(r.bin_id, []).append(r)
    for parts in bins.values():
        parts.sort(key=lambda r: r.bin_offset)
        used = sum(r.n_tokens for r in parts)
        assert [r.bin_offset for r in parts] == [sum(x.n_tokens for x in parts[:k]) for k in range(len(parts))]
        assert {(r.bin_tokens, r.capacity) for r in parts} == {(used, packing.downsize(used, packing.CAPACITIES))}


def test_empty_tables_go_through(spark):
    docs = _frame(spark, []).select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.count() == 0, name
        docs = out if name != "packing" else docs


def test_run_is_its_stages_in_order(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [docs.count()]
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stash(stage(spark, docs, SF_DIR), "test")
        kept.append(docs.select("doc_id").distinct().count())
    assert kept[0] >= kept[1] > kept[2] > kept[3] == kept[4] == kept[5] > 0.5 * kept[0]
    assert sorted(map(str, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(str, docs.collect()))


def _session(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default)), sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_intermediate_tables_go_to_the_shared_folder(spark, tmp_path, monkeypatch):
    assert runtime.shared_dir(_session("spark://host:7077", spark_checkpoint_dir="s3a://b/c/")) == "s3a://b/c"
    with pytest.raises(RuntimeError):  # a cluster without one
        runtime.shared_dir(_session("spark://host:7077"))
    monkeypatch.setattr(runtime, "shared_dir", lambda _: f"file://{tmp_path}")
    out = common.stash(spark.range(5).withColumn("x", F.lit(1)), "probe")
    assert out.count() == 5 and [x.partition("-")[0] for x in os.listdir(tmp_path / "newslens")] == ["probe"]


def test_batches_are_cut_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(common, "ARROW_ROWS", 10)
    monkeypatch.setattr(common, "ARROW_BYTES", 3000)
    small, large = (pa.RecordBatch.from_pydict({"t": ["x" * n] * 25}) for n in (10, 1000))
    assert [b.num_rows for b in common.slices(iter([small]))] == [10, 10, 5]
    assert [b.num_rows for b in common.slices(iter([large]))] == [2] * 12 + [1] and not list(common.slices(iter([small.slice(0, 0)])))
