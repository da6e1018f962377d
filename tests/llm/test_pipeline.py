"""Stages of the pipeline on a small corpus, each against a plain version of its decision."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_ops import near_brute
from voxloom.llm import decontam, packing, pii, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 4000, n))
    bench = [word(20), word(12)]
    texts = [word(60) + "." for _ in range(120)]
    texts += [texts[0], texts[1] + " more", texts[2].replace("w", "W", 3), f"{word(30)} {bench[0]} {word(9)}", f"mail x@y.org, {word(30)}", "BUY!! NOW!! $$$ " * 12, "SALE### $$$ !! " * 15, "", None, word(3000)]
    rows = [(i, t, "en" if i % 2 else None, "src0", len(t) if t else None) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no id at all", None, None, None)]
    bad = [i for i, t in enumerate(texts) if t and ("$$$" in t)]
    labels = [(i, 0 if i in bad else 1, 0) for i in range(len(texts))]
    extra = [(1000 + i, "WIN!! $$$ ### " * (5 + i % 40), "en", "src1", 0) for i in range(120)]
    labels += [(r[0], 0, 0) for r in extra]
    d = f"file://{tmp_path_factory.mktemp('sf')}"
    spark.createDataFrame(rows + extra, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def key(r):
    return (r.doc_id is None, r.doc_id or 0, r.text or "")


def test_stages(spark, sf):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    kept = cp.keep_quality(spark, docs, sf).collect()
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert sorted(kept, key=key) == sorted(quality.score(docs, model).where(F.col("quality_score") >= quality.THRESHOLD).select(*docs.columns).collect(), key=key)
    assert not any("$$$" in (r.text or "") for r in kept) and sum("w" in (r.text or "") for r in kept) >= 120

    one = cp.drop_near_duplicates(spark, docs, sf)
    assert one.columns == docs.columns
    rows = docs.collect()
    classes = near_brute([(r.doc_id, r.text) for r in rows])
    want = sorted({(i, r.text) for (i, c), r in zip(classes, rows, strict=True) if i == c}, key=str)
    assert sorted([(r.doc_id, r.text) for r in one.collect()], key=str) == want

    clean = cp.drop_contaminated(spark, docs, sf).collect()
    items = [r.text.split() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {tuple(w[s : s + 8]) for w in items for s in range(len(w) - 7)}
    find = lambda t: (t or "").lower().replace(".", " ").split()
    dirty = lambda t: any(tuple(find(t)[s : s + 8]) in grams for s in range(len(find(t))))
    assert sorted(clean, key=key) == sorted([r for r in rows if not dirty(r.text)], key=key) and len(clean) < len(rows)
    assert decontam.WINDOW == 8

    safe = cp.redact_personal_data(spark, docs, sf).collect()
    assert sorted([(str(r.doc_id), r.text) for r in safe], key=str) == sorted([(str(r.doc_id), pii.redact(r.text)) for r in rows], key=str)
    assert all(r.n_chars == len(r.text) for r in safe if r.text is not None)


def test_whole_run(spark, sf):
    got = cp.run(spark, sf).collect()
    ends = collections.defaultdict(int)
    for r in got:
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= packing.CAPACITY and len(ends) == -(-sum(ends.values()) // packing.CAPACITY)
    ids = {r.doc_id for r in got}
    assert {3, 10, 50} <= ids and not {120, 123, 125, 126} & ids


def test_empty_tables(spark, tmp_path):
    d = f"file://{tmp_path}"
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    assert cp.run(spark, d).count() == 0
