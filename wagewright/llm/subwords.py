"""A quality classifier on learned subword vectors."""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import by_arrow, slices
from wagewright.llm.words import BASE, is_space, mixed, points
from wagewright.session import settled

SIZES = (2, 3, 4, 5)  # characters in an n-gram, word ends included
PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
SAME = np.uint64(0x165667B19E3779F9)
EDGE = np.uint64(3)  # a word's end; code points are counted from 4 on


def in_sample(id_col: str, rest: int, by: int = 4):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(by)) == rest


class Features:
    """Bucket numbers of the words, word pairs and character n-grams of some texts.

    A word's own features (itself and its n-grams) are found once for each distinct word. A pair of neighbours is hashed
    from both words; of a word that repeats one of the two before it there is one pair more, the same for all words.
    """

    def __init__(self, texts: list[str | None], bits: int):
        cp, first = points(texts)
        inside = ~is_space(cp)
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = end - start
        text = np.searchsorted(first, start, side="right") - 1
        shift = np.uint64(64 - bits)
        body = cp[inside].astype(np.uint64) + np.uint64(4)
        at = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=at[1:])
        whole = np.zeros(len(size), dtype=np.uint64)
        if len(size):
            power = np.cumprod(np.full(int(size.max()), BASE))
            whole = mixed(np.add.reduceat(body * power[np.arange(len(body)) - np.repeat(at[:-1], size)], at[:-1]))
        _, one, self.word = np.unique(whole, return_index=True, return_inverse=True)
        self.words, self.texts = len(one), len(texts)
        self.text, self.n_words = text, np.bincount(text, minlength=len(texts))
        # Code points of the distinct words, each between two edges.
        long = size[one] + 2
        begin = np.zeros(len(one) + 1, dtype=np.int64)
        np.cumsum(long, out=begin[1:])
        owner = np.repeat(np.arange(len(one)), long)
        place = np.arange(int(begin[-1])) - begin[owner]
        middle = (place > 0) & (place < long[owner] - 1)
        chars = np.full(int(begin[-1]), EDGE, dtype=np.uint64)
        chars[middle] = body[(at[:-1][one][owner] + place - 1)[middle]]
        self.bucket, self.owner = [whole[one] >> shift], [np.arange(len(one))]
        roll = np.zeros(len(chars), dtype=np.uint64)
        for n in range(1, max(SIZES) + 1):
            if len(chars) < n:
                break
            roll = roll[: len(chars) - n + 1] * BASE + chars[n - 1 :]
            if n in SIZES:
                fits = np.flatnonzero(place[: len(roll)] + n <= long[owner[: len(roll)]])
                self.bucket.append(mixed(roll[fits] + np.uint64(n)) >> shift)
                self.owner.append(owner[fits])
        self.bucket, self.owner = np.concatenate(self.bucket).astype(np.int64), np.concatenate(self.owner)
        next_ = np.flatnonzero(text[1:] == text[:-1]) + 1 if len(text) else np.zeros(0, np.int64)
        pair = mixed(whole[next_ - 1] * PAIR + whole[next_]) >> shift
        again = [np.flatnonzero((whole[k:] == whole[:-k]) & (text[k:] == text[:-k])) + k for k in (1, 2)] if len(text) > 2 else []
        again = np.unique(np.concatenate(again)) if again else np.zeros(0, np.int64)
        self.pair = np.concatenate([pair, np.full(len(again), mixed(np.array([SAME]))[0] >> shift)]).astype(np.int64)
        self.pair_text = np.concatenate([text[next_], text[again]]) if len(text) else np.zeros(0, np.int64)

    def rows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text, its buckets and their shares: a word counts once, however many n-grams it has; so does a pair."""
        per_word = np.bincount(self.owner, minlength=self.words)
        order = np.argsort(self.owner, kind="stable")
        begin = np.zeros(self.words + 1, dtype=np.int64)
        np.cumsum(per_word, out=begin[1:])
        bucket = self.bucket[order]
        cut = np.searchsorted(self.text, np.arange(self.texts + 1))
        pairs = np.argsort(self.pair_text, kind="stable")
        pair_cut = np.searchsorted(self.pair_text[pairs], np.arange(self.texts + 1))
        out = []
        for k in range(self.texts):
            seen, times = np.unique(self.word[cut[k] : cut[k + 1]], return_counts=True)
            ids = [bucket[begin[w] : begin[w + 1]] for w in seen]
            own = self.pair[pairs[pair_cut[k] : pair_cut[k + 1]]]
            weights = [np.full(len(x), t / len(x)) for x, t in zip(ids, times)]
            ids, back = np.unique(np.concatenate([*ids, own]).astype(np.int32), return_inverse=True)
            share = np.bincount(back, weights=np.concatenate([*weights, np.ones(len(own))]), minlength=len(ids))
            out.append((ids, (share / max(share.sum(), 1)).astype(np.float32)))
        return out

    def means(self, value: np.ndarray) -> np.ndarray:
        """Mean of a number per bucket over each text's features, weighted as in ``rows``."""
        per_word = np.bincount(self.owner, minlength=self.words)
        word = np.bincount(self.owner, weights=value[self.bucket], minlength=self.words) / np.maximum(per_word, 1)
        total = np.bincount(self.text, weights=word[self.word], minlength=self.texts) + np.bincount(self.pair_text, weights=value[self.pair], minlength=self.texts)
        n = self.n_words + np.bincount(self.pair_text, minlength=self.texts)
        return total / np.maximum(n, 1)


def trained(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, bits: int, width: int, epochs: int, rate: float, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Vectors by bucket and the softmax layer (two classes, the last column is the constant), by stochastic gradient descent.

    Texts come in a new order each epoch; the rate falls to zero in a line. A text's vector is the mean of its features'.
    """
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    layer = np.zeros((2, width + 1), dtype=np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            ids, share = rows[k]
            now = rate * (1 - done / steps)
            done += 1
            mean = np.append(share @ vectors[ids], np.float32(1))
            z = layer @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[k]] -= 1
            back = p @ layer
            layer -= np.float32(now) * np.outer(p, mean)
            vectors[ids] -= np.float32(now) * np.outer(share, back[:-1])
    return vectors, layer


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rest: int = 2, threshold: float = 0.7,
    train_rows: int = 4000, train_chars: int = 10_000_000, bits: int = 17, width: int = 16, epochs: int = 5, rate: float = 0.5,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (that the label is 1) and ``predicted`` (1 from ``threshold`` on) for each row.

    A text is the mean of the learned vectors of its words, their character n-grams (2 to 5, word ends included) and its pairs of
    neighbours, each hashed into one of 2 ** ``bits`` buckets; a softmax over two classes makes the score. Vectors and softmax are
    learned by stochastic gradient descent from labelled rows whose crc32 of the id doesn't leave ``rest`` by 4: about ``train_rows``
    of them with ``train_chars`` characters at most, chosen by a hash of the id. Executors make the features of those; the driver
    sees bucket numbers and shares only. With two classes the softmax needs one number per bucket, which is all the tasks get.

    Only the text is scored, the whole of it. Null, empty and blank texts get the constant's score. Rows without an id are not
    held out and never learned from; repeated rows score alike, and of an id's differing labels the largest counts. Without
    labels of both kinds every score is the share of label 1 (0 without any). An empty table gives no rows; other columns are left out.
    """
    named = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).alias("label")).filter(F.col("label").isin(0, 1) & ~in_sample("label_id", rest))
    named = named.groupBy("label_id").agg(F.max("label").cast("int").alias("label"))
    # Ids and lengths find the sample's share; texts are only read where the few ids of the sample are met.
    size = docs.select(F.col(id_col).alias("label_id"), F.char_length(text_col).cast("long").alias("size"))
    n, chars = size.join(named, "label_id").agg(F.count("*"), F.sum("size")).first()
    share = min(1.0, train_rows / max(n, 1), train_chars / max(chars or 0, 1))
    draw = F.pmod(F.xxhash64(F.lit(13), "label_id"), F.lit(1 << 30))

    def measure(batch):
        texts = batch.column(1).to_pylist()
        for a, b in slices(texts):
            found = Features(texts[a:b], bits).rows()
            ids, shares = [x.tobytes() for x, _ in found], [x.tobytes() for _, x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids, pa.binary()), pa.array(shares, pa.binary()), batch.column(2).slice(a, b - a)], names=["label_id", "ids", "shares", "label"])

    sample = settled(named.filter(draw < int((1 << 30) * share)), "sample")
    chosen = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("body")).join(sample, "label_id")
    kind = chosen.schema["label_id"].dataType.simpleString()
    seen = sorted(by_arrow(chosen.select("label_id", "body", "label"), measure, f"label_id {kind}, ids binary, shares binary, label int").collect(), key=lambda r: (str(r.label_id), bytes(r.ids), bytes(r.shares)))
    label = np.array([r.label for r in seen], dtype=np.int64)
    value, constant = np.zeros(1 << bits), -30.0
    if 0 < label.sum() < len(label):
        vectors, layer = trained([(np.frombuffer(r.ids, np.int32), np.frombuffer(r.shares, np.float32)) for r in seen], label, bits, width, epochs, rate)
        side = (layer[1] - layer[0]).astype(float)
        value, constant = np.round(vectors @ side[:-1], 7), float(side[-1])
    elif len(label):
        part = min(max(label.mean(), 1e-9), 1 - 1e-9)
        constant = log(part / (1 - part))

    def score(batch):
        texts = batch.column(1).to_pylist()
        z = [Features(texts[a:b], bits).means(value) for a, b in slices(texts)]
        p = np.round(1 / (1 + np.exp(-np.clip(np.concatenate(z) + constant, -30, 30))), 6)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"), F.coalesce(in_sample(id_col, rest), F.lit(False)).alias("held_out"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return by_arrow(own, score, f"doc_id {kind}, held_out boolean, score double, predicted int")
