"""Article text that names must not cost, and the style tree against a plain one."""

import random
from collections import Counter, defaultdict
from math import log

import pytest

from wagewright.llm import page_text as pt

KIND = "page_id long, url string, html string, text string, path string"


def text_of(page):
    return [t for _, prior, t in pt.blocks(page) if prior >= pt.UNMARKED]


@pytest.mark.parametrize("inner,want", [
    ("<div class='share-price'>Price 5</div>", ["Price 5"]),
    ("<section id='search-methods'>How we searched</section>", ["How we searched"]),
    ("<p class='notice-period'>Three months</p>", ["Three months"]),
    ("<p>The <math><mrow><mi>x</mi><mo>&lt;</mo><mn>3</mn></mrow></math> holds</p>", ["The x<3 holds"]),
    ("<p>An <math/>empty one</p>", ["An empty one"]),
    ("<div class='share'>Share this</div><p>rest</p>", ["rest"]),
    ("<div class='box widget'>Poll</div><aside>Also</aside><p>rest</p>", ["rest"]),
])
def test_names_inside_an_article(inner, want):
    assert text_of(f"<body><nav>Menu</nav><article>{inner}</article><div class='side-bar search-box'>find</div></body>") == want


def brute(pages, min_importance=0.3, min_pages=3, fade=0.9, outside=0.5, article=3.0):
    """The tree and its removals in plain Python, page by page."""
    made = [[(pt.site_of(u), prior, path, t) for path, prior, t in pt.blocks(h)] for _, u, h in pages]
    seen = {(pt.site_of(u), *((b[1], b[2], b[3]) for b in page if b[1] != pt.NAMED)): {b for b in page if b[1] != pt.NAMED} for (_, u, _), page in zip(pages, made)}
    layouts, content, prior_of = defaultdict(Counter), defaultdict(Counter), {}
    for page in seen.values():
        for element, n in Counter(b[:3] for b in page).items():
            layouts[element][n] += 1
        for b in page:
            content[b[:3]][b[3]] += 1
    keep = {}
    for element, kinds in layouts.items():
        m = sum(kinds.values())
        if m < min_pages:
            continue
        presentation = -sum(c / m * log(c / m) for c in kinds.values()) / log(m)
        own = [1 - log(c) / log(m) for c in content[element].values()]
        faded = fade ** len(kinds)
        weight = {pt.INSIDE: article, pt.OUTSIDE: outside}.get(element[1], 1.0)
        keep[element] = ((1 - faded) * presentation + faded * sum(own) / len(own)) * weight >= min_importance
    out = {}
    for (i, _, _), page in zip(pages, made):
        stays = [b for b in page if b[1] != pt.NAMED and keep.get(b[:3], b[1] >= pt.UNMARKED)]
        if not any(b[1] == pt.INSIDE for b in stays):
            stays = [b for b in page if b in stays or b[1] == pt.INSIDE]
        out[i] = "\n\n".join(b[3] for b in stays)
    return out


def site(draw, host, n):
    words = lambda k: " ".join("".join(draw.choice("abcdefg") for _ in range(5)) for _ in range(k))
    pages = []
    for _ in range(n):
        body = [f"<p>{words(12)}</p>" for _ in range(draw.randint(1, 4))]
        body.insert(draw.randint(0, len(body)), "<p class='byline'>By the staff of this paper</p>")
        body.append(f"<div class='teaser'>{draw.choice(['Read on', 'Read on', words(3)])}</div>")
        shell = "<article>{}</article>" if host != "plain" else "<div class='story'>{}</div>"
        extra = f"<div class='strip'>{draw.choice(['Offers of today', 'Offers of today', words(4)])}</div>"
        pages.append(f"<body><nav>{words(2)}</nav>{extra if draw.random() < 0.8 else ''}{shell.format(''.join(body))}<p class='legal'>All rights kept</p></body>")
    return pages


def test_tree_equals_a_plain_one(spark):
    draw = random.Random(12)
    pages, i = [], 0
    for host, n in (("one", 14), ("two", 9), ("plain", 12), ("few", 2)):
        for h in site(draw, host, n):
            pages += [(i, f"https://{host}.example/{i}", h)] * (2 if draw.random() < 0.1 else 1)
            i += 1
    pages += [(900, None, None), (901, "x", ""), (902, None, "<p>alone</p>"), (903, "https://one.example/e", "no marks &amp; <b>bold</b> " + "long " * 20_000)]
    df = spark.createDataFrame([(a, b, c, "x", "x") for a, b, c in pages], KIND).repartition(5)
    got = pt.main_text(df).collect()
    want = brute(pages)
    assert len(got) == len(pages)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)
    whole = " ".join(want[i] for i, u, _ in pages if u and "few" not in u)
    assert "By the staff" not in whole and "All rights kept" not in whole  # what a site repeats goes, in and outside of articles


def test_no_pages(spark):
    assert pt.main_text(spark.createDataFrame([], KIND)).collect() == []
