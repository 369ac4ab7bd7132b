"""Repeated passages against a plain version over texts with null, shared and text ids."""

import random
from collections import defaultdict

import pytest

from wagewright.llm.substring import repeated_passages, units, without_passages


def sentence(draw, n):
    return " ".join("".join(draw.choice("abcdeghilmnoprst") for _ in range(draw.randint(2, 8))) for _ in range(n))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_with_null_and_shared_ids(spark, kind):
    """The earliest occurrence stays, wherever it is; every other row that holds the passage loses it, and no other."""
    draw = random.Random(5)
    passages = [sentence(draw, 40) for _ in range(6)]
    rows, holds = [], []
    for k in range(60):
        p = draw.choice([None, *range(6)])
        text = sentence(draw, 20) + ("\n" + passages[p] + "\n" if p is not None else "\n") + sentence(draw, 20)
        i = draw.choice([None, k, k, k, 7, 8])
        rows.append((i, text))
        holds.append(p)
    rows += [rows[0], (None, None), (7, None), (99, ""), (8, " \n")]
    holds += [holds[0], None, None, None, None]
    cast = lambda i: i if kind == "long" or i is None else f"id{i:03d}"
    rows = [(cast(i), t) for i, t in rows]
    docs = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], f"doc_id {kind}, text string, start string, removed string").repartition(4)
    found = repeated_passages(docs)
    left = without_passages(docs, found)
    assert left.columns == ["doc_id", "text", "start", "removed"]
    got = [tuple(r)[:2] for r in left.collect()]
    assert len(got) == len(rows)
    # Of each passage one row at least keeps it, all rows equal to that one too; all others lose it.
    for p, words in enumerate(passages):
        own = {(i, t) for (i, t), h in zip(rows, holds) if h == p}
        if len(own) < 2:
            continue
        kept = {(i, t) for i, t in got if words in (t or "")}
        first = min((i is not None, i if i is not None else "") for i, _ in own)
        assert len({t for _, t in kept}) == 1 and all((i is not None, i if i is not None else "") == first for i, _ in kept), p
    plain = {(i, t) for (i, t), h in zip(rows, holds) if h is None}
    assert plain <= set(got)
    for r in found.collect():
        assert (r.text_hash is None) == (r.doc_id is not None and len({t for i, t in rows if i == r.doc_id}) == 1)


def test_spans_against_plain_grouping(spark):
    """Every marked character lies in a unit that also stands at an earlier place, and every such unit of long runs is marked."""
    draw = random.Random(11)
    pool = [sentence(draw, n) for n in (3, 8, 25, 60)]
    rows = [(k, " ".join(draw.choice([sentence(draw, 15), draw.choice(pool)]) for _ in range(6)).replace(" ", "\n", k % 3)) for k in range(40)]
    got = defaultdict(set)
    for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), min_chars=0, bridge=0).collect():
        got[r.doc_id] |= set(range(r.start, r.end))
    first, want = {}, defaultdict(set)
    for i, (digest, start, end) in zip([i for i, _ in rows], units([t for _, t in rows], 5, 6)):
        for d, a, b in sorted(zip(digest.tolist(), start.tolist(), end.tolist()), key=lambda x: x[1]):
            if first.setdefault(d, (i, a)) != (i, a):
                want[i] |= set(range(a, b))
    for i, text in rows:
        gaps = {k for k in range(len(text)) if not text[k].isalnum()}
        assert got[i] - gaps == want[i] - gaps


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_passages(docs).collect() == [] and without_passages(docs, repeated_passages(docs)).collect() == []
