"""Collocations against a brute-force count, at every shard number, and on odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

from wagewright.llm import phrases
from wagewright.llm.phrases import collocations

KIND = "lang string, text string, rank string, n string"


def brute(rows, longest=3, min_count=10, cover=50, first=2000):
    found, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                found[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in found.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in cand.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        longer[p[i:j]] = max(longer[p[i:j]], a)
        kept = []
        for p, a in cand.items():
            if p in longer and 100 * longer[p] >= cover * a:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:first], 1):
            out.add((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return out


def texts(n, seed=3):
    draw = random.Random(seed)
    words = ["the", "New", "york", "city", "a", "Été", "b\x00c", "\U0001f600", "of", "to"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(0, 60)):
            parts.append(draw.choice([*words, "New York", "New York City", "of the", str(draw.randint(0, 400))]))
            parts.append(draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!\x0b"]))
        rows.append((draw.choice(["en", "en", "fr", None, "und", ""]), "".join(parts)))
    return rows


def result(frame):
    got = [tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("shards,bits,longest,first", [(1, 4, 3, 2000), (3, 16, 3, 7), (4, 10, 4, 2000), (2, 24, 2, 2000)])
def test_equals_brute_force(spark, shards, bits, longest, first):
    rows = texts(400)
    rows += [("en", "New York City " * 3000), ("de", "x"), ("en", None), (None, "")] + [("en", "to be or not")] * 40
    df = spark.createDataFrame([(a, b, "x", "x") for a, b in rows], KIND).repartition(5)
    got = result(collocations(df, shards=shards, filter_bits=bits, final_bits=bits + 1, longest=longest, first=first))
    assert got == brute(rows, longest=longest, first=first)


def test_small_chunks(monkeypatch):
    """The scans cut their input at whole texts and hand counts on when they hold many; the sums are the same."""
    import numpy as np
    import pyarrow as pa

    rows = texts(200, seed=9)
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows]), pa.array([a or "und" for a, _ in rows])], names=["text", "lang"])
    seen = []
    for size in (8_000_000, 500):
        monkeypatch.setattr(phrases, "CHARS", size)
        found = Counter()
        for c in phrases.chunks([batch]):
            for h, n in zip(c.hash.tolist(), c.count.tolist()):
                found[h] += n
            for k, h, valid in c.longer(3, lambda k, a, b: np.ones(len(b), bool)):
                for x in h[valid].tolist():
                    found[k, x] += 1
        seen.append(found)
    assert seen[0] == seen[1] and sum(seen[0].values()) > 1000


def test_exact_beyond_64_bits(spark):
    """a * a * 10^6 passes 2^63 from three million on; checked on the expression itself."""
    from pyspark.sql import functions as F

    a, l, r = 5_000_000_000_003, 6_000_000_000_001, 5_500_000_000_009
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(*[F.col(c).cast("decimal(19,0)").alias(c) for c in "alr"])
    df = df.withColumn("over", F.col("a") * F.col("a") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("under", F.col("l") * F.col("r"))
    assert df.select(F.expr("over div under")).first()[0] == 10**6 * a * a // (l * r)


def test_empty(spark):
    assert collocations(spark.createDataFrame([], KIND)).collect() == []
    assert collocations(spark.createDataFrame([(None, None, "x", "x"), ("en", " \n", "x", "x")], KIND)).collect() == []
