"""Toxicity scores from a lexicon that reads misspellings, with context windows."""

from __future__ import annotations

import re
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import by_arrow
from wagewright.llm.lexicon import Lexicon
from wagewright.session import settled

WORD = re.compile(r"[^\W_]+")
#: Openers of quoted speech and what closes them; a quotation ends with its line at the latest.
QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|«[^»\n]*»|„[^“”\n]*[“”]|^>[^\n]*", re.M)
WINDOW = 24
STEMS = range(3, 9)
FEATURES = 8


def held_out(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def term_counts(rows: DataFrame) -> DataFrame:
    """Documents that hold each word and each word beginning, by label; summed per batch first."""

    def work(batch):
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = set(WORD.findall((text or "").lower()))
            counts[toxic].update(words)
            counts[toxic].update({w[:k] + "*" for w in words for k in STEMS if k < len(w)})
        keys = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64()) for c in counts[::-1]]], names=["term", "toxic", "civil"]
        )

    return by_arrow(rows, work, "term string, toxic long, civil long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("civil").alias("civil"))


def learned_lexicon(rows: DataFrame, odds: float) -> tuple[dict[str, float], dict[str, float]]:
    """All terms and stems at least ``odds`` (natural log) likelier in toxic documents; the sample of labelled rows bounds their number."""
    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, civil = n.get(1, 0), n.get(0, 0)
    if not toxic or not civil:
        return {}, {}
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("civil") + 0.5) / (civil + 1))
    often = term_counts(rows).filter(F.col("toxic") >= max(4, toxic // 100))
    strong = settled(often.withColumn("weight", F.round(weight, 6)).filter(F.col("weight") >= odds), "terms")
    found: tuple[dict[str, float], dict[str, float]] = ({}, {})
    for r in strong.orderBy("term").collect():
        found[r.term.endswith("*")][r.term.removesuffix("*")] = r.weight
    return found


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Weights of a text's words, apart for exact, misspelled and stem matches, quoted words, and its worst window."""
    low = (text or "").lower()
    words = WORD.findall(low)
    hits = {w: r for w in set(words) if (r := lexicon.read(w))}
    if not hits:
        return [0.0] * FEATURES
    quotes = [m.span() for m in QUOTED.finditer(low)]
    total, quoted, heat = [0.0, 0.0, 0.0], 0.0, []
    q = 0
    for i, m in enumerate(WORD.finditer(low)):
        r = hits.get(m[0])
        if r is None:
            continue
        while q < len(quotes) and quotes[q][1] <= m.start():
            q += 1
        if q < len(quotes) and quotes[q][0] <= m.start():
            quoted += max(r)
            continue
        for k in range(3):
            total[k] += r[k]
        heat.append((i, max(r[0], r[1], r[2])))
    worst, first, now = 0.0, 0, 0.0
    for i, w in heat:  # abuse stands close together, a mention stands alone
        now += w
        while heat[first][0] <= i - WINDOW:
            now -= heat[first][1]
            first += 1
        worst = max(worst, now)
    plain = sum(w for _, w in heat)
    return [*[log(1 + x) for x in total], log(1 + quoted), log(1 + worst), 10 * plain / (len(words) + 10), log(1 + len(hits)), log(1 + plain / (1 + log(1 + len(words))))]


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.full(len(w), ridge)
        penalty[-1] = 1e-3
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = 8000,
    odds: float = 1.6,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and the columns of ``keep`` for each row.

    Labels are learned from rows whose crc32 of the id leaves a remainder by 5, about ``train_rows`` of them at most, chosen by a
    hash of the id; half of those gives the lexicon, the other half the weights of the features. Only the text is scored:
    the whole of it, word by word, through one Levenshtein automaton over the lexicon's trie; quoted words count apart, and the
    densest window of {window} words tells abuse from a mention.

    Null and empty texts score like a text without any listed word. Rows without an id are not held out and never
    learned from; repeated rows score alike. Without labelled rows of both kinds every score is the share of toxic labels
    (0 without any). An empty table gives no rows. Columns in ``keep`` named like the new ones are replaced.
    """
    named = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).alias("toxic")).filter(F.col("toxic").isin(0, 1) & ~held_out("label_id"))
    named = named.groupBy("label_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = named.count()
    draw = F.pmod(F.xxhash64(F.lit(5), "label_id"), F.lit(1 << 30))
    chosen = named.filter(draw < int((1 << 30) * min(1.0, train_rows / max(n, 1))))
    rows = docs.join(chosen, docs[id_col] == chosen.label_id).select(F.col(text_col).alias("body"), "toxic", F.pmod(F.xxhash64(F.lit(6), "label_id"), F.lit(2)).alias("half"))
    terms, stems = learned_lexicon(rows.filter("half = 0").select("body", "toxic"), odds)

    def measure(batch):
        lexicon = cache(terms, stems)
        x = [features(t, lexicon) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    seen = by_arrow(rows.filter("half = 1").select("body", "toxic"), measure, "x array<double>, toxic int", forget).collect()
    seen.sort(key=lambda r: (r.x, r.toxic))  # sums in one order, whatever order the rows came in
    if seen and terms.keys() | stems.keys():
        weights = fitted(np.array([r.x for r in seen]), np.array([float(r.toxic) for r in seen]))
    else:
        share = (sum(r.toxic for r in seen) + 1e-9) / (len(seen) + 1e-6)
        weights = np.array([0.0] * FEATURES + [log(share / (1 - share)) if 0 < share < 1 else -30.0])

    extra = [c for c in dict.fromkeys(keep) if c not in ("doc_id", "held_out", "score", "predicted")]
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col(text_col).alias("scored_text"), *[F.col(c).alias(f"kept_{c}") for c in extra]
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "scored_text")

    def score(batch):
        lexicon = cache(terms, stems)
        at = batch.schema.get_field_index("scored_text")
        x = np.array([features(t, lexicon) for t in batch.column(at).to_pylist()]).reshape(-1, FEATURES)
        p = np.round(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))), 6)
        rest = [(batch.schema.field(k).name, batch.column(k)) for k in range(batch.num_columns) if k != at]
        yield pa.RecordBatch.from_arrays(
            [c for _, c in rest] + [pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[m for m, _ in rest] + ["score", "predicted"]
        )

    out = by_arrow(own, score, f"{kinds}, score double, predicted int", forget)
    return out.select("doc_id", "held_out", "score", "predicted", *[F.col(f"kept_{c}").alias(c) for c in extra])


toxicity.__doc__ = (toxicity.__doc__ or "").replace("{window}", str(WINDOW))
_built: dict[int, tuple[dict, dict, Lexicon]] = {}


def cache(terms: dict[str, float], stems: dict[str, float]) -> Lexicon:
    """One automaton per worker and lexicon: its states are kept from batch to batch."""
    key = hash((tuple(terms.items()), tuple(stems.items())))
    if key not in _built:
        _built.clear()
        _built[key] = (terms, stems, Lexicon(terms, stems))
    return _built[key][2]


def forget() -> None:
    _built.clear()
