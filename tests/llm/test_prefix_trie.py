"""The prefix trie against a brute-force one, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from wagewright.llm import prefix_trie as trie

KIND = "conv_id long, turn long, role string, text string, depth string, k1 string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - c % 20, [])[:h] + ts[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        ends[ts].append(c)
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(m) - 1) * words(node)
    out = set()
    for node, m in members.items():
        ids = ",".join(map(str, sorted(ends[node])))
        up = min(members[node[:-1]]) if node else None
        out.add((min(m), len(node), up, len(m), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ids.encode()).hexdigest()))
    return out


def result(spark, rows):
    frame = spark.createDataFrame(rows, KIND).repartition(6)
    got = [tuple(r) for r in trie.prefix_trie(*trie.with_heads(trie.numbered(frame))).collect()]
    assert len(got) == len(set(got))
    return set(got)


def conversations(n, seed=5):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(draw.choice([0, 1, 1, 2, 3, 5])):
            text = draw.choice(["hello there", "a b  c\n", "", None, "ok", str(draw.randint(0, 5))])
            rows.append((c + 40 if c % 20 == 7 else c, draw.choice([None, t, t]), draw.choice(["user", "user", None, "assistant", ""]), text, "x", "x"))
    return rows


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 4)
    rows = conversations(180)
    rows += [(500, t, "user", "one two", "x", "x") for t in range(50)] + [(501 + 20 * k, t, "user", "one two", "x", "x") for k in range(30) for t in range(9)]
    rows += [(2000 + k, 0, "user", "the same for all", "x", "x") for k in range(1200)]  # more than one piece of an end list
    rows += [(3000, 1, "a", "bc", "x", "x"), (3001, 1, "ab", "c", "x", "x")] * 3 + [(None, 1, "user", "lost", "x", "x"), (3002, None, None, None, "x", "x")]
    assert result(spark, rows) == brute(rows)


def test_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 16)
    rows = conversations(60, seed=8) + [(800, t, "user", "w " * (t % 7), "x", "x") for t in range(150)] + [(801, 0, "user", "long " * 30_000, "x", "x")]
    assert result(spark, rows) == brute(rows)


def test_empty_and_turnless(spark):
    assert result(spark, [(None, 1, "user", "x", "x", "x")]) == set()
    assert trie.prefix_trie(*trie.with_heads(trie.numbered(spark.createDataFrame([], KIND)))).collect() == []
    # 21 has no conversation 20 and loses its own first turns: it belongs to the root alone.
    lone = next(c for c in range(21, 39) if zlib.crc32(str(c).encode()) % 4)
    empty = hashlib.sha256(str(lone).encode()).hexdigest()
    assert result(spark, [(lone, 1, "user", "x", "x", "x")]) == {(lone, 0, None, 1, 0, 1, 0, empty)}
