"""Words of many texts at once, as numpy arrays of places and 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves about half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def lower_table() -> np.ndarray:
    """Lower-case code point of each of the first 65,536, itself where lowering makes several."""
    low = [chr(c).lower() if not 0xD800 <= c < 0xE000 else chr(0) for c in range(65536)]
    return np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(low)], dtype=np.uint32)


@lru_cache(1)
def alnum_table() -> np.ndarray:
    return np.array([not 0xD800 <= c < 0xE000 and chr(c).isalnum() for c in range(65536)], dtype=bool)


def lowered(cp: np.ndarray) -> np.ndarray:
    small = cp < 65536
    return np.where(small, lower_table()[np.where(small, cp, 0)], cp)


def alnum(cp: np.ndarray) -> np.ndarray:
    """Letters and digits; code points beyond the first 65,536 count as letters."""
    return alnum_table()[np.where(cp < 65536, cp, 65)]


def points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and where each text begins."""
    texts = [t or "" for t in texts]
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=first[1:])
    return cp, first


def is_space(cp: np.ndarray) -> np.ndarray:
    return (cp == 32) | ((cp >= 9) & (cp <= 13))


@dataclass
class Words:
    text: np.ndarray  # number of the text each word stands in
    start: np.ndarray  # code points before the word in its text
    end: np.ndarray
    hash: np.ndarray  # equal for equal words, 64 bits
    first: np.ndarray  # first word of each text, and the number of all words


def hashed_words(texts: list[str | None], plain: bool = False) -> Words:
    """Words between white space; hashes see A-Z as a-z.

    ``plain``: hashes see letters and digits only, all lower case, and words without any are left out.
    """
    cp, first = points(texts)
    inside = ~is_space(cp)
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    number = np.repeat(np.arange(len(start)), end - start)
    body = cp[inside]
    if plain:
        seen = alnum(body)
        body, number = lowered(body[seen]), number[seen]
    else:
        body = np.where((body >= 65) & (body <= 90), body + 32, body)
    count = np.bincount(number, minlength=len(start))
    has = count > 0
    start, end, count = start[has], end[has], count[has]
    at = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(count, out=at[1:])
    hash_ = np.zeros(len(count), dtype=np.uint64)
    if len(count):
        power = np.cumprod(np.full(int(count.max()), BASE))
        place = np.arange(len(body)) - np.repeat(at[:-1], count)
        hash_ = mixed(np.add.reduceat((body.astype(np.uint64) + np.uint64(1)) * power[place], at[:-1]))
    text = np.searchsorted(first, start, side="right") - 1
    return Words(text, start - first[text], end - first[text], hash_, np.searchsorted(text, np.arange(len(texts) + 1)))
