"""Each operator against brute force and on odd rows: nulls, empty and long texts, repeats, clashing columns, no rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wagewright.llm import page_text, pii, queries, substring
from wagewright.llm.components import components
from wagewright.llm.decontaminate import contaminated, distance
from wagewright.llm.lexicon import Lexicon
from wagewright.llm.line_dedup import drop_shared_lines
from wagewright.llm.near_dedup import near_duplicates
from wagewright.llm.packing import Tokens, pack, plan, tail_cuts, vocabulary_path
from wagewright.llm.page_text import main_text
from wagewright.llm.perspectives import dialogues, perspectives
from wagewright.llm.quality_rules import quality_rules
from wagewright.llm.substring import repeated_passages, without_passages
from wagewright.llm.toxicity import toxicity
from wagewright.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_words string, score string, kept string, n_lines string"
LONG = "word " * 30_000


def sentence(draw, n):
    return " ".join("".join(draw.choice("abcdefghilmnoprstu") for _ in range(draw.randint(2, 8))) for _ in range(n))


def odd_rows():
    draw = random.Random(1)
    some = sentence(draw, 80)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, some), (5, some), (6, some), (None, some), (None, None), (7, "é" * 5000), (8, "\U0001f600 a\x00b")]
    return [(i, t, "x", "x", "x", "x") for i, t in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")


OPERATORS = {
    "quality": lambda d, s: quality_rules(d),
    "lines": lambda d, s: drop_shared_lines(d),
    "near": lambda d, s: near_duplicates(d),
    "passages": lambda d, s: repeated_passages(d),
    "pack": lambda d, s: pack(d),
    "pii": lambda d, s: pii.personal_data(d),
    "leaks": lambda d, s: contaminated(d, s.createDataFrame([(1, "some text that is long enough to search"), (None, None)], "item_id long, text string")),
    "toxic": lambda d, s: toxicity(d, s.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int"), keep=("kept",)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, name):
    rows = OPERATORS[name](odd, spark).collect()
    if name not in ("passages", "leaks", "pack"):
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in odd.collect())
    assert OPERATORS[name](odd.limit(0), spark).collect() == []


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = con.execute(queries.SQL[key])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[key](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert collections.Counter(tuple(r) for r in got.select(*names).collect()) == collections.Counter(want.fetchall())


def test_shared_lines_with_null_id(spark):
    line = "a line of forty characters and a few more of them"
    docs = spark.createDataFrame([(i, f"x\n  {line.upper()}\ny") for i in (None, 1, 2, 3, 4)] + [(9, line[:39])], "doc_id long, text string")
    got = {r.doc_id: (r.n_dropped, r.text) for r in drop_shared_lines(docs).collect()}
    assert got[4][0] == 0 and got[9] == (0, line[:39])
    assert all(got[i] == (1, "x\ny") for i in (None, 1, 2, 3))


def test_near_duplicates_against_all_pairs(spark):
    draw = random.Random(3)
    texts = {}
    for g in range(12):
        base = sentence(draw, draw.randint(4, 60)).split()
        for _ in range(12):
            words = [w if draw.random() > 0.03 else "other" for w in base]
            texts[len(texts)] = " ".join(words)
    texts |= {500: "A b", 501: "a  B", 502: "a", 503: "", 504: None}
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = set(zip(w, w[1:], strict=False)) if len(w) > 1 else set(map(tuple, [w])) if w else set()
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(texts, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), width=2).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(sets[i]), find(i)) for i in texts}


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    low = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(400):
        for u, v in edges:
            if u != v:
                low[u] = low[v] = min(low[u], low[v])
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r.id, r.component) for r in got} == set(low.items())


def test_passages_inside_lines(spark):
    draw = random.Random(8)
    passage = sentence(draw, 60)
    rows = [(i, f"{sentence(draw, 30)} {passage.upper() if i % 2 else passage}, {sentence(draw, 30)}") for i in range(12)] + [(50 + i, sentence(draw, 90)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeated_passages(docs)
    assert {r.doc_id for r in found.collect()} == set(range(1, 12)) and {r.first_doc_id for r in found.collect()} == {0}
    texts = dict(rows)
    for r in without_passages(docs, found).collect():
        assert r.text == re.sub("\0+", "", "".join("\0" if any(c.start <= k < c.end for c in r.removed) else x for k, x in enumerate(texts[r.doc_id])))
    for r in found.collect():
        assert texts[r.doc_id][r.start : r.end].lower() in passage.lower()


def test_passages_of_short_units(spark):
    draw = random.Random(21)
    short = "\n".join(sentence(draw, 3) for _ in range(20))  # lines of fewer words than a unit asks for
    uncut = " ".join(["vex", "mol"] * 40)
    one_line = sentence(draw, 14) + " " + "x" * 40
    rows = [(2 * k, f"{sentence(draw, 30)}\n{p}\n{sentence(draw, 30)}") for k, p in enumerate((short, one_line))]
    rows += [(2 * k + 1, f"{sentence(draw, 30)}\n{p}\n{sentence(draw, 30)}") for k, p in enumerate((short, one_line))]
    rows += [(9, uncut)]
    texts = dict(rows)
    got = collections.defaultdict(str)
    for r in sorted(repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: (r.doc_id, r.start)):
        got[r.doc_id] += texts[r.doc_id][r.start : r.end]
    assert got[1] == short and got[3] == one_line
    assert len(got[9]) > 200 and set(got) == {1, 3, 9}


def test_units_cover_every_word():
    draw = random.Random(22)
    texts = ["", "a", "a b\nc", *[re.sub(" ", lambda m: draw.choice(" \n "), sentence(draw, draw.randint(1, 60))) for _ in range(200)], None, "!? .", "vex " * 50]
    for text, (digest, start, end) in zip(texts, substring.units(texts, 5, 6), strict=True):
        covered = {k for a, b in zip(start, end, strict=True) for k in range(a, b)}
        assert covered >= {k for k, x in enumerate(text or "") if x.isalnum()} and len(digest) == len(start)
        n = len((text or "").split())
        assert all(len(text[a:b].split()) >= min(6, n) for a, b in zip(start, end, strict=True)) or "!" in text


def test_leaks_against_alignment(spark):
    draw = random.Random(9)
    items = [(k, sentence(draw, 30)) for k in range(6)]
    rows, want = [], set()
    for i in range(60):
        k = i % 6
        letters = list(items[k][1])
        for _ in range(i // 12):  # no edits to four
            letters[draw.randrange(len(letters))] = draw.choice("xyz")
        rows.append((i, f"{sentence(draw, 40)} {''.join(letters).replace(' ', chr(10), i % 3).upper()} {sentence(draw, 40)}"))
        want.add((i, k))
    rows += [(100 + i, sentence(draw, 100)) for i in range(20)]
    got = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_chars=300).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.n_edits <= 4 for r in got)


def test_leaks_of_short_items(spark):
    draw = random.Random(19)
    sizes = [10, 13, 16, 19, 25, 29, 38, 39, 66]
    items = [(n, "".join(draw.choice("abcdefghi") for _ in range(n))) for n in sizes]
    rows, want = [], set()
    for n, item in items:
        edits, changed = int(0.08 * n), list(item)
        for k in range(edits):  # as far apart as they spoil the most
            changed[(k + 1) * n // (edits + 1)] = "z"
        rows.append((n, f"{'uvwx ' * 9}{''.join(changed)}{' uvwx' * 9}"))
        want.add((n, n, edits))
    got = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.n_edits) for r in got.collect()} == want


def test_distance():
    draw = random.Random(4)
    for _ in range(60):
        item, region = ([draw.randrange(3) for _ in range(draw.randint(1, n))] for n in (7, 12))

        def edits(a, b):
            row = list(range(len(b) + 1))
            for i, x in enumerate(a, 1):
                row, last = [i], row
                for j, y in enumerate(b, 1):
                    row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            return row[-1]

        want = min(edits(item, region[a:b]) for a in range(len(region) + 1) for b in range(a, len(region) + 1))
        found, start, end = distance(np.array(item), np.array(region), 99)
        assert found == want == edits(item, region[start:end])


def test_lexicon_reads_misspellings():
    book = Lexicon({"idiot": 2.0, "worthless": 3.0, "bad": 1.0}, {"réeux": 1.5})
    assert book.read("idiot") == (2.0, 0.0, 0.0) and book.read("1diot") == (2.0, 0.0, 0.0)
    for word in ("idiots", "idit", "ideot"):
        assert book.read(word) == (0.0, 2.0, 0.0)
    assert book.read("wrothles")[1] == 0.0 if book.read("wrothles") else True
    assert book.read("worthles")[1] == book.read("vortless")[1] == 3.0
    assert book.read("bat") is None and book.read("réeuxment")[2] == 1.5 and book.read("xréeux") is None


def test_toxicity_held_out(spark):
    draw = random.Random(2)
    rows = []
    for i in range(600):
        words = sentence(draw, 60).split()
        if i % 4 == 0:
            for _ in range(4):
                words.insert(draw.randrange(20), draw.choice(["scoundrel", "villain", "rascal"]))
        rows.append((i, " ".join(words), i % 4 == 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, t boolean")
    got = toxicity(docs.select("doc_id", "text"), docs.select("doc_id", F.col("t").cast("int").alias("toxic"))).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([(r.predicted == 1) == (r.doc_id % 4 == 0) for r in held]) > 0.98


def test_personal_data(spark):
    text = "mail a.b@c.de. or x@y, host 10.0.0.255 and 300.1.1.1; card 4111-1111 1111 1111, call +1 (017) 555-7713 now; token = \"0123456789abcdef0123456789abcdef01234567\" version 2.0."
    r = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    found = [("email", "a.b@c.de"), ("ip", "10.0.0.255"), ("card", "4111-1111 1111 1111"), ("phone", "+1 (017) 555-7713")]
    base = [f"{k}:{text.index(v)}:{text.index(v) + len(v)}" for k, v in found]
    assert set(base) <= set(r.spans.split(","))
    assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
    secrets = [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in r.spans.split(",") if s.startswith("secret")]
    assert secrets == ["0123456789abcdef0123456789abcdef01234567"]


def test_number_beside_a_base_number(spark):
    text = "Call us at (415) 555-0100 +14155552671 any day"
    r = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    found = {text[int(a) : int(b)] for _, a, b in (s.split(":") for s in r.spans.split(","))}
    assert r.n_phone == 1 and "+14155552671" in found and any("555-0100" in f for f in found - {"+14155552671"})


def test_viterbi_against_all_paths():
    field = pii.default_field()
    words = "call +1 (017) 555-7713 1.2.3.4 now".split()
    chain = pii.sequence_features(words, 1, 5)
    emit = [sum(field.emit[field.names[f]] for f in w if f in field.names) for w in chain]

    def score(path):
        full = (0, *path, 0)
        return sum(field.link[a, b] for a, b in itertools.pairwise(full)) + sum(e[p] for e, p in zip(emit, path, strict=True))

    best = max(itertools.product(range(len(pii.LABELS)), repeat=4), key=score)
    assert tuple(field.decode([chain, chain[:1]])[0]) == best


def test_packing_round_trip(spark):
    draw = random.Random(6)
    rows = [(i, sentence(draw, draw.choice([3, 60, 60, 60, 200, 900]))) for i in range(150)] + [(200, None), (201, "a  b\n\n c   d"), (202, "<|endoftext|> x")]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    ids = {i: x for (i, _), x in zip(rows, Tokens(vocabulary_path()).ids([t for _, t in rows]), strict=True)}
    whole = Tokens(vocabulary_path())
    assert all(np.array_equal(ids[i][:-1], np.frombuffer(whole._encode([t or ""])[0], "<u4")) for i, t in rows)
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, x in ids.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(x), zlib.crc32(x[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(x)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0


def test_plan_uses_no_more_than_there_is():
    histogram = np.zeros(33, dtype=np.int64)
    histogram[[5, 10, 12, 17, 22, 27, 31]] = [100, 7, 40, 11, 90, 80, 3]
    ways, left = plan(histogram, 32)
    used = sum(np.bincount(w, minlength=33) * n for w, n in ways)
    assert (used + left == histogram).all() and all(sum(w) == 32 for w, _ in ways) and (left >= 0).all()
    assert tail_cuts(32 * 3 + 13, 32) == [104, 108, 109]


PAGE = """<html><head><title>t</title></head><body><header>top</header><nav>menu</nav><div class="cookie-notice">eat</div>
<article><h1>Head &amp; more</h1><p>one<br>two <b>bold<p>three<script>var x="</p>";</script><div class="comments"><p>reader</p></div></article>
<aside>side</aside><form>ask</form><footer>&copy; x</footer></body>"""


def test_page_text(spark):
    plain = lambda n: f"<div class=box><span>same on all pages</span></div><section><p>own text {n}</p><p>more {n * 7}</p></section>"
    rows = [(1, "http://A.example/x", PAGE), (2, None, None), (3, "x", ""), (4, "http://a.example", "<p>a < b & c<!-- d")]
    rows += [(10 + n, f"http://site.example/{n}", plain(n)) for n in range(8)]
    got = {r.page_id: r for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "Head & more\n\none two bold\n\nthree"
    assert got[2].text == got[3].text == "" and got[4].text == "a < b & c"
    assert [got[10 + n].text for n in range(8)] == [f"own text {n}\n\nmore {n * 7}" for n in range(8)]
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert page_text.site_of("https://u@Www.Example.org:80/x") == "www.example.org"


def test_page_text_in_named_wrappers(spark):
    real = "<h1>Head {n}</h1><p>own text {n}</p>"
    wraps = [
        "<form id=aspnetForm><nav>menu</nav><main>{0}</main></form>", "<div class='layout has-sidebar'><article>{0}</article><div class=sidebar>side</div></div>",
        "<article class='post has-comments'>{0}<div class=comments><article class=comment>reader</article></div></article>",
        "<article>{0}</article><div id=comments><article class=comment>reader</article></div>",
    ]
    rows = [(k, f"http://w{k}.example/", "<body>" + w.format(real.format(n=k))) for k, w in enumerate(wraps)]
    # The tree takes what all articles of a host repeat, and leaves an unnamed lead that differs outside of the article.
    for n in range(8):
        rows.append((10 + n, f"http://t.example/{n}", f"<div class=lead>lead {n}</div><div class=strip>always</div><article><p>text {n}</p><div class=box>same line</div></article>"))
    # Copies of one article under several addresses stay whole.
    rows += [(30 + n, f"http://m.example/{n}", f"<nav>menu {n}</nav><article><p>one text</p></article>") for n in range(5)]
    rows += [(40 + n, f"http://n.example/{n}", f"<div>x {n}</div><article><p>one text</p></article>") for n in range(5)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(4)] == [f"Head {k}\n\nown text {k}" for k in range(4)]
    assert [got[10 + n] for n in range(8)] == [f"lead {n}\n\ntext {n}" for n in range(8)]
    assert all(got[30 + n] == "one text" and got[40 + n] == f"x {n}\n\none text" for n in range(5))


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "?"), (1, 3, None, "?"), (None, 0, "eve", "x"), (2, 0, "system", "alone")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = perspectives(turns).collect()
    assert len(got) == 2 * 5 + 1 and {r.conv_id for r in got} == {1, None}
    mine = next(r for r in got if r.perspective == "ann" and r.turn == 1)
    assert mine.role == "assistant" and mine.rendered[mine.train_from : mine.train_to] == "hi<|end|>"
    other = next(r for r in got if r.perspective == "ann" and r.turn == 2)
    assert (other.role, other.name, other.train, other.content) == ("user", "bob", False, "")
    for r in dialogues(turns, turns_per_row=2).collect():
        assert all(r.text[m.start : m.end].endswith("<|end|>") for m in r.mask)


def test_dialogue_query_joins_the_turns(spark):
    turns = queries.QUERIES["op8_perspective_rotation"](spark, SF).collect()
    want, spans = collections.defaultdict(str), collections.defaultdict(list)
    for r in sorted(turns, key=lambda r: (r.turn or 0, r.turn is not None, r.role, r.name or "", r.rendered)):
        key = (r.conv_id, r.perspective, (r.turn or 0) // 64)
        if r.train:
            spans[key].append((len(want[key]) + r.train_from, len(want[key]) + r.train_to))
        want[key] += r.rendered
    got = {(r.conv_id, r.perspective, r.stretch): r for r in queries.QUERIES["op8_dialogues"](spark, SF).collect()}
    assert {k: r.text for k, r in got.items()} == dict(want)
    assert all([(m.start, m.end) for m in r.mask] == spans[k] for k, r in got.items())


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = docs.unionByName(docs.filter("doc_id = 3").withColumn("doc_id", F.lit(9003).cast("long"))).unionByName(
        docs.filter("doc_id = 4").withColumn("doc_id", F.lit(9004).cast("long")).withColumn("text", F.concat(F.lit("unseen words before "), F.lit(leak)))
    )
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in P.STAGES:
        out = P.settled(stage(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert tuple(out.columns) == P.COLUMNS and 0 < out.count() <= docs.count()
        if name == "near_dedup":
            assert not out.filter("doc_id = 9003").count()
        if name == "decontamination":
            assert not out.filter("doc_id = 9004").count()
        docs = out
    assert docs.count() and P.STAGES[0][1](spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0), SF).count() == 0


def test_pipeline_rows_without_own_id(spark):
    import corpus_pipeline as P

    draw = random.Random(31)
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").filter("text is not null").first().text
    a, b, c, d, e, f, g, h = (sentence(draw, 60) for _ in range(8))
    leaky = f"{sentence(draw, 20)} {leak} {sentence(draw, 20)}"
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c + " tail"), (5, d), (5, e), (5, d), (6, f), (7, f), (7, g), (None, ""), (3, ""), (None, leaky), (8, leaky), (8, h)]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = P.settled(P.keep_one_of_each(spark, docs.repartition(7), SF), "test-rows")
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert tuple(kept.columns) == P.COLUMNS and max(got.values()) == 1
    tails = {x for x in got if x[1] in (c, c + " tail")}
    assert len(tails) == 1
    assert set(got) - tails == {(1, a), (None, b), (5, d), (5, e), (6, f), (7, g), (None, ""), (3, ""), (8, leaky), (8, h)}
    left = {(r.doc_id, r.text) for r in P.drop_leaks(spark, docs, SF).collect()}
    assert left == {x for x in rows if x[1] != leaky}
