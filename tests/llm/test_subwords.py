"""Subword features against a plain version, training, held-out accuracy and odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from wagewright.llm import subwords
from wagewright.llm.subwords import Features, quality, trained

KIND = "doc_id long, text string, score string, label string, held_out string"
TEXTS = ["one two one", "", None, " \n ", "é", "a\U0001f600b a\U0001f600b a\U0001f600b", "x " * 500, "word" * 3000, "one two one"]


def test_rows_and_means_agree():
    bits = 10
    value = np.random.default_rng(1).normal(size=1 << bits)
    f = Features(TEXTS, bits)
    means, rows = f.means(value), f.rows()
    for k, (ids, share) in enumerate(rows):
        assert abs(float(share @ value[ids]) - means[k]) < 1e-4
        alone = Features([TEXTS[k]], bits)
        assert np.allclose(alone.means(value), means[k])
        assert (alone.rows()[0][0] == ids).all()
    assert means[1] == means[2] == means[3] == 0 and means[0] == means[8]
    assert len(Features([], bits).rows()) == 0


def test_features_are_those_of_the_words():
    """A word alone: itself and its n-grams of 2 to 5 characters with both ends."""
    f = Features(["abc"], 40)
    assert len(f.bucket) == 1 + 4 + 3 + 2 + 1 and len(f.pair) == 0
    f = Features(["ab ab cd ab"], 40)  # three pairs; the second and the last word repeat one of the two before
    assert len(f.pair) == 5 and f.words == 2


def test_gradient():
    """One step moves vectors and layer along the derivative of the loss."""
    rows, label = [(np.array([0, 3], np.int32), np.array([0.25, 0.75], np.float32))], np.array([1])
    v0, l0 = np.random.default_rng(7).uniform(-0.5, 0.5, (4, 2)).astype(np.float32), np.zeros((2, 3), np.float32)
    v1, l1 = trained(rows, label, 2, 2, 1, 0.1)
    mean = np.append(0.25 * v0[0] + 0.75 * v0[3], 1)
    assert np.allclose(l1 - l0, -0.1 * np.outer([0.5, -0.5], mean), atol=1e-6)
    assert np.allclose(v1, v0)  # the layer was zero


def test_held_out(spark):
    """Nine in ten held-out labels at least, whatever ids the documents carry."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)
    flipped = quality(docs, labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert {r.doc_id: r.score for r in flipped.collect()} == {r.doc_id: r.score for r in quality(docs, labels).collect()}


def test_odd_rows(spark):
    rows = [(k, t, "x", "x", "x") for k, t in enumerate(TEXTS)] + [(None, "one two one", "x", "x", "x"), (None, None, "x", "x", "x"), (0, "one two one", "x", "x", "x")]
    docs = spark.createDataFrame(rows, KIND)
    labels = spark.createDataFrame([(k, k % 2) for k in range(9)], "doc_id long, quality int")
    got = quality(docs, labels).collect()
    assert len(got) == len(rows) and not any(r.held_out for r in got if r.doc_id is None)
    by_text = {}
    for r in got:
        if r.doc_id is not None:
            by_text.setdefault(TEXTS[r.doc_id] if (TEXTS[r.doc_id] or "").strip() else "", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality(docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(k, 1) for k in range(9)] + [(3, None), (None, 1)], "doc_id long, quality int")
    assert {r.predicted for r in quality(docs, ones).collect()} == {1}
    assert quality(spark.createDataFrame([], KIND), labels).collect() == []


def test_sample_bound(spark, monkeypatch):
    seen = []
    real = subwords.trained
    monkeypatch.setattr(subwords, "trained", lambda rows, *a: seen.append(len(rows)) or real(rows, *a))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("t"), F.col("id")).alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    quality(docs, labels, train_rows=50)
    quality(docs, labels, train_chars=300)
    assert 20 < seen[0] < 90 and 20 < seen[1] < 110
