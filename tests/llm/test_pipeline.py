"""The pipeline: columns between stages, planted cases, and each stage against brute force."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from graphloom.llm import near_dup

from test_operators import base_spans, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good and bad documents, copies, leaks and secrets, written as tables."""
    root = tmp_path_factory.mktemp("tables")
    rng = random.Random(5)
    items = [(k, " ".join(words(rng, 30))) for k in range(3)]
    texts = [" ".join(words(rng, 60)) for _ in range(120)]
    texts += [" ".join(f"{w}!!" for w in words(rng, 60)) for _ in range(60)]
    texts += [texts[0], texts[1] + " tail", texts[2] + " " + items[1][1], texts[3] + ' token = "abcdefabcdef0123456789"']
    docs = [(k, t, "en", "src", len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(k, int(k < 120 or k >= 180), 0) for k in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == columns
            out.write.parquet(str(tmp_path / str(k)))
            docs = spark.read.parquet(str(tmp_path / str(k)))
            kept.append({r.doc_id: r.text for r in docs.collect()})
    good, single, clean, masked = kept
    assert set(good) == set(texts) - set(range(120, 180))
    order = sorted(good)
    label = near_dup.brute_force([good[d] for d in order])
    assert set(single) == {order[c] for c in set(label)}
    assert set(single) - set(clean) == {182} - (set(label) - set(label)) or 182 not in clean
    assert set(masked) == set(clean)
    assert all(not base_spans(t) for t in masked.values())
    assert all(masked[d] == clean[d] for d in clean if not base_spans(clean[d]))
    assert {r.doc_id for r in out.collect()} == set(masked)


def test_run_equals_its_stages(spark, folder):
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} <= set(range(184))
