"""Personal data: fixed patterns, and a conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import by_arrow

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("O", *KINDS)

# The base patterns. A look-behind on the first digit keeps long digit runs linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPACE = re.compile(r"[\x20\x09-\x0D]")
MARK = re.compile(r"[0-9@]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str):
    """Each @ with its longest local part after the last match and a domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in emails(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def shape(word: str) -> str:
    """Runs of capitals, small letters and digits as X, x and d, other characters as they are."""
    return re.sub(r"(.)\1+", r"\1+", "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in word))


CORE = re.compile(r"^[\"'(\[<]*(.*?)[\"')\]>.,;:!?#*$%&|]*$", re.S)


def word_features(word: str) -> tuple[str, ...]:
    core = CORE.match(word[:200])[1]
    digits = sum(c.isdigit() for c in core)
    letters = sum(c.isalpha() for c in core)
    hexes = len(core) >= 16 and all(c in "0123456789abcdefABCDEF" for c in core)
    mixed_ = len(core) >= 16 and digits > 2 and letters > 2 and "@" not in core
    return (
        f"digits={min(digits, 20)}" if not letters else f"some={min(digits, 3)}",
        f"dots={min(core.count('.'), 4)}{'d' if not letters else 'x'}",
        f"at={'@' in core and '.' in core.rpartition('@')[2]}",
        f"hex={hexes}",
        f"key={mixed_}",
        f"plus={core[:1] == '+' or word[:2] in ('+', '(+')}",
        f"paren={word[:1] == '('}",
        f"shape={shape(core)[:12]}",
        f"long={min(len(core) // 4, 6)}",
    )


def near_features(word: str | None, side: str) -> str:
    """What a neighbour tells: its letters in small, or its kind of shape."""
    if word is None:
        return f"{side}=edge"
    core = word.strip(".,;:!?\"'()").lower()
    return f"{side}={core if core in CUES else 'x'}"


# Words that stand before keys, numbers and addresses.
CUES = frozenset("= : token key secret password api phone tel call mail email card ip host version section page chapter year".split())


def marked(word: str) -> bool:
    return MARK.search(word) is not None


def sequence_features(words: list[str], a: int, b: int) -> list[tuple[str, ...]]:
    out = []
    for i in range(a, b):
        before = words[i - 1] if i else None
        out.append((*word_features(words[i]), near_features(before, "before"), near_features(words[i - 2] if i > 1 else None, "earlier")))
    return out


def labelled_table(rows: int = 400, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """A small labelled table made by rule: words and labels of ``rows`` short sentences.

    Plain words surround one item each, in several spellings: addresses, card and phone numbers, keys, and numbers that are no
    personal data (versions, years, amounts, ranges). Digits and letters are drawn, so no value stands for itself.
    """
    draw = random.Random(seed)
    digit = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    plain = lambda: "".join(draw.choice("aeioulnrstdm") for _ in range(draw.randint(2, 9)))
    octet = lambda: str(draw.randint(0, 255))
    makers = {
        "email": lambda: [f"{plain()}.{digit(2)}@{plain()}{digit(1)}.{plain()}.{draw.choice(['com', 'org', 'net'])}"],
        "ip": lambda: [".".join(octet() for _ in range(4))],
        "card": lambda: draw.choice([[digit(16)], [digit(4) for _ in range(4)], ["-".join(digit(4) for _ in range(4))], [digit(15)]]),
        "phone": lambda: draw.choice(
            [[f"+{digit(1)}", f"({digit(3)})", f"{digit(3)}-{digit(4)}"], [f"+{digit(2)}", digit(3), digit(7)], [f"({digit(3)})", f"{digit(3)}-{digit(4)}"], [f"+{digit(11)}"]]
        ),
        "secret": lambda: [draw.choice(['"{}"', "{}"]).format("".join(draw.choice("0123456789abcdef") for _ in range(draw.choice([32, 40, 40, 64]))))],
        "O": lambda: [draw.choice([f"{digit(1)}.{digit(1)}", f"{digit(1)}.{digit(1)}.{digit(1)}", f"{digit(1)}.", digit(4), digit(1), digit(2), f"{digit(2)}%", f"{digit(2)}-{digit(2)}", f"{digit(3)},{digit(3)}", f"{plain()}{digit(1)}", f"{plain()}-{digit(2)}"])],
    }
    tails = ["", "", "", ".", ",", "!!", "***", "###", "%%%"]
    before = {"secret": [["token", "="], ["key", ":"], ["api", "key"], ["password", "="]], "phone": [["call"], ["phone"]], "email": [["mail"]], "card": [["card"]], "ip": [["host"]], "O": [["version"], ["page"], ["year"], ["section"]]}
    table = []
    for n in range(rows):
        label = list(makers)[n % len(makers)]
        item = makers[label]()
        item[-1] += draw.choice(tails)
        lead = [plain() for _ in range(draw.randint(0, 4))] + (draw.choice(before[label]) if draw.random() < 0.5 or label == "secret" and draw.random() < 0.8 else [])
        tail = [plain() for _ in range(draw.randint(0, 4))]
        table.append((lead + item + tail, ["O"] * len(lead) + [label] * len(item) + ["O"] * len(tail)))
    return table


class Field:
    """A linear-chain conditional random field; words without a digit or @ are always ``O``."""

    def __init__(self, table: list[tuple[list[str], list[str]]], steps: int = 150, rate: float = 0.5, ridge: float = 0.002):
        chains, golds = [], []
        for words, tags in table:
            for a, b in runs(words):
                chains.append(sequence_features(words, a, b))
                golds.append([LABELS.index(t) for t in tags[a:b]])
        self.names = {f: k for k, f in enumerate(dict.fromkeys(f for c in chains for w in c for f in w))}
        size = len(LABELS)
        self.emit, self.link = np.zeros((len(self.names), size)), np.zeros((size, size))
        grad_e, grad_l = np.zeros_like(self.emit), np.zeros_like(self.link)
        ids = [[[self.names[f] for f in w] for w in c] for c in chains]
        square_e, square_l = np.full_like(self.emit, 1e-8), np.full_like(self.link, 1e-8)
        for _ in range(steps):
            grad_e[:], grad_l[:] = ridge * self.emit * len(chains), ridge * self.link * len(chains)
            for chain, gold in zip(ids, golds, strict=True):
                self._add_gradient(chain, gold, grad_e, grad_l)
            square_e += grad_e**2
            square_l += grad_l**2
            self.emit -= rate * grad_e / np.sqrt(square_e)
            self.link -= rate * grad_l / np.sqrt(square_l)

    def _add_gradient(self, chain, gold, grad_e, grad_l):
        """Expected less observed counts, by the forward and backward sums of one chain between two ``O``."""
        e = np.array([self.emit[w].sum(axis=0) for w in chain])
        n, fore, back = len(chain), np.zeros_like(e), np.zeros_like(e)
        fore[0] = self.link[0] + e[0]
        for i in range(1, n):
            fore[i] = logsum(fore[i - 1][:, None] + self.link) + e[i]
        back[-1] = self.link[:, 0]
        for i in range(n - 2, -1, -1):
            back[i] = logsum((self.link + e[i + 1] + back[i + 1]).T)
        whole = logsum((fore[-1] + back[-1])[:, None])[0]
        one = np.exp(fore + back - whole)
        for i, w in enumerate(chain):
            grad_e[w] += one[i]
            grad_e[w, gold[i]] -= 1
        grad_l[0] += one[0]
        grad_l[0, gold[0]] -= 1
        grad_l[:, 0] += one[-1]
        grad_l[gold[-1], 0] -= 1
        for i in range(1, n):
            grad_l += np.exp(fore[i - 1][:, None] + self.link + e[i] + back[i] - whole)
            grad_l[gold[i - 1], gold[i]] -= 1

    def decode(self, chains: list[list[tuple[str, ...]]]) -> list[np.ndarray]:
        """Viterbi over a batch of chains at once, ordered by length, so that a step handles all that go on."""
        order = sorted(range(len(chains)), key=lambda k: -len(chains[k]))
        flat = [[self.names[f] for f in w if f in self.names] for k in order for w in chains[k]]
        size = np.array([len(chains[k]) for k in order])
        if not len(size):
            return []
        lens = np.array([len(w) for w in flat])
        emit = np.zeros((len(flat), len(LABELS)))
        np.add.at(emit, np.repeat(np.arange(len(flat)), lens), self.emit[np.array([f for w in flat for f in w], dtype=np.int64)])
        at = np.cumsum(size) - size
        score = self.link[0] + emit[at]
        back = np.zeros((len(flat), len(LABELS)), dtype=np.int8)
        for i in range(1, int(size[0])):
            live = int((size > i).sum())
            step = score[:live, :, None] + self.link
            back[at[:live] + i] = step.argmax(axis=1)
            score[:live] = step.max(axis=1) + emit[at[:live] + i]
        label = (score + self.link[:, 0]).argmax(axis=1)
        best = np.zeros(len(flat), dtype=np.int64)
        for i in range(int(size[0]) - 1, -1, -1):
            live = int((size > i).sum())
            best[at[:live] + i] = label[:live]
            if i:
                label[:live] = back[at[:live] + i, label[:live]]
        out: list[np.ndarray] = [None] * len(chains)  # type: ignore[list-item]
        for k, a, n in zip(order, at, size, strict=True):
            out[k] = best[a : a + n]
        return out


def logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    return top + np.log(np.exp(x - top).sum(axis=0))


def runs(words: list[str]) -> list[tuple[int, int]]:
    """Stretches of marked words; the words between are ``O``, so each stretch is decoded by itself, exactly."""
    out, i = [], 0
    while i < len(words):
        if marked(words[i]):
            j = i
            while j < len(words) and marked(words[j]):
                j += 1
            out.append((i, j))
            i = j
        else:
            i += 1
    return out


def stretches(text: str, reach: int = 200):
    """Stretches of words with a digit or @: their bounds, and the two words before, found from the marks alone."""
    out, done = [], 0
    mark = MARK.search(text)
    while mark:
        at = mark.start()
        start = 1 + max(text.rfind(c, done, at) for c in " \t\n\x0b\x0c\r")
        start = max(start, done)
        end = SPACE.search(text, at)
        end = end.start() if end else len(text)
        gap = text[out[-1][-1][1] : start] if out else None
        if gap is not None and gap and not gap.strip(" \t\n\x0b\x0c\r"):
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
        done = end
        mark = MARK.search(text, end)
    found = []
    for words in out:
        lead = text[max(0, words[0][0] - reach) : words[0][0]].split()[-2:]
        found.append((lead, words))
    return found


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without the quotes and marks around."""
    while start < end and text[start] in "\"'([<":
        start += 1
    while start < end and text[end - 1] in "\"')]>.,;:!?#*$%&|":
        end -= 1
    return start, end


@lru_cache(1)
def default_field() -> Field:
    return Field(labelled_table())


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], field: Field) -> list[list[tuple[str, int, int]]]:
    """Spans that the field labels and the base spans leave free, for a batch of texts."""
    chains, places = [], []
    for t, text in enumerate(texts):
        for lead, words in stretches(text) if text else []:
            all_words = lead + [text[a:b] for a, b in words]
            chains.append(sequence_features(all_words, len(lead), len(all_words)))
            places.append((t, words))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (t, words), tags in zip(places, field.decode(chains), strict=True):
        # Words of a base span part a labelled stretch; what stands beside them is a span of its own.
        taken = [bool(g) and any(x < b and y > a for _, a, b in base[t]) for g, (x, y) in zip(tags, (trimmed(texts[t], *w) for w in words), strict=True)]
        i = 0
        while i < len(words):
            j = i
            while j < len(words) and tags[j] == tags[i] and taken[j] == taken[i]:
                j += 1
            if tags[i] and not taken[i]:
                start, end = trimmed(texts[t], words[i][0], words[j - 1][1])
                if start < end and all(end <= a or start >= b for _, a, b in base[t]):
                    out[t].append((LABELS[tags[i]], start, end))
            i = j
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: list | None = None) -> DataFrame:
    """Counts of the base kinds, ``base_sha256``, all ``spans`` and ``n_added`` for each row.

    Base spans are fixed patterns. The field is trained here from ``table`` (``labelled_table()`` unless given), goes to
    the tasks as a few arrays and adds spans that touch no base span: numbers and addresses in other spellings, and keys
    (``secret``). Offsets are code points, end exclusive. Null and empty texts have no spans. Repeated rows get the
    same result each, other columns are left out, and an empty table gives no rows.
    """
    field = default_field() if table is None else Field(table)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batch):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        base = [base_spans(t) if MARK.search(t) else [] for t in texts]
        more = added_spans(texts, base, field)
        counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS[:4]]
        sha = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
        spans = [joined(b + m) for b, m in zip(base, more, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *counts, pa.array(sha, pa.string()), pa.array(spans, pa.string()), pa.array([len(m) for m in more], pa.int64())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
        )

    return by_arrow(rows, work, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
