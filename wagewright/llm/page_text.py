"""Main text of web pages, with a style tree per site."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import by_arrow
from wagewright.session import settled

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Elements by what the standard says of them.
RAW = frozenset("script style noscript template textarea svg iframe object select title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
CHROME = frozenset("nav footer aside form button dialog menu head".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
#: Chrome that can hold parts marked as articles of their own: each reader's comment, each related page.
HOLDERS = frozenset("nav footer aside dialog menu navigation contentinfo complementary comment comments reply replies respond disqus related recommended".split())
MAIN = frozenset("article main".split())
#: Parts of a formula, whose text stands in the line.
FORMULA = frozenset(
    "mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts "
    "none mtable mtr mtd maction semantics".split()
)
#: Words in a class or id that name something other than the article.
CHROME_WORDS = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner cookie cookies consent notice alert popup modal overlay sidebar aside menu navbar nav navigation "
    "breadcrumb breadcrumbs footer masthead topbar toolbar pagination pager share sharing social related recommended newsletter subscribe signup login search "
    "comment comments reply replies respond disqus widget copyright skip".split()
)
#: An end tag that is left out: a tag of the key ends an open one of these.
ENDS = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
BLANK = re.compile(r"\s+")
#: Page chrome by its name; outside of a page's article or main; on a page without one; inside.
PRIORS = NAMED, OUTSIDE, UNMARKED, INSIDE = 0, 1, 2, 3


@dataclass
class Open:
    tag: str
    style: str
    chrome: bool
    main: bool
    above: Open | None = None
    holder: bool = False
    #: Holds an article or main element, or is one.
    around: bool = False
    depth: int = 0  # holders among this element and those above

    def __post_init__(self):
        self.depth = self.holder + (self.above.depth if self.above else 0)

    def line(self):
        at = self
        while at:
            yield at
            at = at.above


def named(attributes: str) -> tuple[str, str, set[str]]:
    """Class and id words, the role, and the names as they stand, not taken apart at hyphens."""
    words, role, whole = [], "", set()
    for m in ATTRIBUTE.finditer(attributes):
        value = html.unescape(m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            role = value.strip()
        else:
            words += re.split(r"[\s_-]+", value)
            whole |= set(value.split())
    return " ".join(w for w in words if w), role, whole


def blocks(page: str | None):
    """(style path, prior, text) of each block: what the page itself says of it, one of ``PRIORS``.

    A name doesn't make chrome of an element that holds an article or main element, or is one; inside one only a whole name does,
    not a part of ``share-price`` or ``search-methods``: what such parts repeat on a site is for the tree to say. Where comments and the like
    hold articles of their own, those under the fewest such parts are the page's.
    """
    page = page or ""
    stack: list[Open] = [Open("", "", False, False)]
    out: list[tuple[str, Open, str]] = []
    buffer: list[str] = []
    mains: list[Open] = []

    def flush():
        text = BLANK.sub(" ", html.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            block = [o for o in stack if o.tag not in INLINE]
            path = ">".join(o.style for o in block[1:])
            out.append((path, stack[-1], text))

    at, formula = 0, False
    while at < len(page):
        m = TAG.search(page, at)
        if not m:
            buffer.append(page[at:])
            break
        buffer.append(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "math":
            formula = not closing and not attributes.rstrip().endswith("/")
            continue
        if formula and tag in FORMULA:
            continue
        if closing:
            if any(o.tag == tag for o in stack[1:]):
                if tag not in INLINE:
                    flush()
                while stack.pop().tag != tag:
                    pass
            elif tag not in INLINE and tag not in VOID:
                flush()
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in RAW:
            flush() if tag != "svg" else None
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            while stack[-1].tag in INLINE and tag in ("p", "div", "article", "section", "footer", "ul", "li", "h1", "h2", "h3"):
                stack.pop()  # an inline element that was never closed ends with its block
            if stack[-1].tag in ENDS.get(tag, ()) or stack[-1].tag == "p":
                stack.pop()
        words, role, whole = named(attributes)
        own = set(words.split())
        main = tag in MAIN or role == "main"
        inside = any(o.main for o in stack)
        plain = tag not in ("body", "html")
        chrome = tag in CHROME or role in CHROME_ROLES or (tag == "header" and not inside) or (bool((whole if inside else own) & CHROME_WORDS) and plain)
        holder = plain and bool((own | {tag, role}) & HOLDERS)
        node = Open(tag, f"{tag}.{words.replace(' ', '.')}" if words else tag, chrome, main, stack[-1], holder)
        stack.append(node)
        if main:
            mains.append(node)
    flush()
    least = min((m.depth for m in mains), default=0)
    for m in mains:
        if m.depth == least:
            for o in m.line():
                o.around = True

    def prior(node):
        line = list(node.line())
        if any(o.chrome and not o.around for o in line):
            return NAMED
        return INSIDE if any(o.main and o.around for o in line) else OUTSIDE if mains else UNMARKED

    return [(p, prior(o), t) for p, o, t in out]


def site_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
    host = m[1].rpartition("@")[2].lower() if m else ""
    return re.sub(r":\d+$", "", host)


def page_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of each page; ``path`` is a hash of host, prior and styles, ``page`` one of host and unnamed blocks."""

    def work(batch):
        made = [blocks(h) for h in batch.column(2).to_pylist()]
        kind = pa.list_(pa.struct([("path", pa.int64()), ("prior", pa.int32()), ("text", pa.string()), ("feature", pa.int64())]))
        sites = [site_of(u) for u in batch.column(1).to_pylist()]
        short = lambda x: xxhash.xxh3_64_intdigest(x) - 2**63
        rows = [[{"path": short(f"{s} {v} {p}"), "prior": v, "text": t, "feature": short(t)} for p, v, t in page] for s, page in zip(sites, made, strict=True)]
        page = pa.array([short(s + "".join(f" {b['path']} {b['feature']}" for b in r if b["prior"] != NAMED)) for s, r in zip(sites, rows, strict=True)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), page, pa.array(rows, kind)], names=["page_id", "url", "page", "blocks"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return by_arrow(pages, work, f"page_id {kind}, url string, page long, blocks array<struct<path:bigint,prior:int,text:string,feature:bigint>>")


def style_tree(found: DataFrame, fade: float) -> DataFrame:
    """``importance`` of each element (``path``) of the merged trees, from 0 to 1, and its number of pages ``m``.

    Pages of a site with the same blocks count once. A block of text found on c of the m pages that share its
    element has the entropy log c / log m, so what every page repeats weighs 0 and what one page alone has weighs 1. An
    element's content importance is the mean of 1 - entropy below it; its presentation importance is the entropy of the
    block layouts found there. They are mixed by ``fade`` to the power of the number of layouts.
    """
    layout = found.groupBy("path", "prior", "page").agg(F.count("*").alias("n"))
    shown = layout.groupBy("path", "prior", "n").agg(F.count("*").alias("pages"))
    total = shown.groupBy("path").agg(F.sum("pages").alias("m"), F.count("*").alias("kinds"))
    share = F.col("pages") / F.col("m")
    styles = shown.join(total, "path").groupBy("path", "prior", "m", "kinds").agg(F.sum(-share * F.log(share)).alias("h"))
    styles = settled(styles.select("path", "prior", "m", "kinds", F.when(F.col("m") > 1, F.col("h") / F.log("m")).otherwise(1.0).alias("presentation")), "styles")
    content = found.groupBy("path", "feature").agg(F.count("*").alias("c"))
    met = content.join(styles, "path")
    own = F.when(F.col("m") > 1, 1 - F.log("c") / F.log("m")).otherwise(1.0)
    means = met.groupBy("path").agg(F.avg(own).alias("content"), *[F.first(c).alias(c) for c in ("prior", "presentation", "kinds", "m")])
    faded = F.pow(F.lit(fade), F.col("kinds"))
    return means.select("path", "prior", "m", ((1 - faded) * F.col("presentation") + faded * F.col("content")).alias("importance"))


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_importance: float = 0.3, min_pages: int = 3, fade: float = 0.9,
    outside: float = 0.5, article: float = 3.0,
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for each row.

    A page is parsed into blocks of text, each with the path of styles above it. Elements that the standard or their names
    call menus, headers, footers, sidebars, notices, adverts, forms or comments go, unless they hold the article: such text differs
    from page to page as articles do, so a tree can't tell. All other blocks are merged over all pages of a host into a site
    style tree, which decides elements found on ``min_pages`` pages or more by their importance: those with at least
    ``min_importance`` stay. What the page marks is a factor of the importance, ``article`` inside its article or main part and
    ``outside`` elsewhere on a page that has one. An element with fewer pages stays unless it is outside; and an
    article of which the tree would leave nothing stays whole.
    Only hashes of blocks are shuffled to learn the trees, and a host with a third of all pages is
    counted map-side. Pages are read a second time to apply the removals, which are broadcast while they are few.

    Character references are decoded, white space in a block is one space, blocks are joined by two line feeds. A null or
    empty html has an empty text, a null url belongs to the site without a name. Repeated rows are read each, other
    columns are left out, and an empty table gives no rows.
    """
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("body"))
    made = page_blocks(own)
    merged = F.filter("blocks", lambda b: b.prior != NAMED)
    found = made.select("page", F.explode(merged).alias("b")).select("page", F.col("b.path").alias("path"), F.col("b.prior").alias("prior"), F.col("b.feature").alias("feature"))
    found = settled(found.distinct(), "blocks")
    tree = style_tree(found, fade).filter(F.col("m") >= min_pages)
    weight = F.when(F.col("prior") == INSIDE, F.lit(article)).when(F.col("prior") == OUTSIDE, F.lit(outside)).otherwise(F.lit(1.0))
    keeps = F.col("importance") * weight >= min_importance
    # Elements of which the tree says something else than the page. Written, so that the join can split a hot element's partition.
    turned = settled(tree.filter(keeps != (F.col("prior") >= UNMARKED)).select("path"), "turned")
    # What to turn on a page depends on its host and blocks alone, so equal pages share a row.
    turns = settled(
        found.select("page", "path").distinct().join(turned, "path").groupBy(F.col("page").alias("turn_page")).agg(F.collect_set("path").alias("turned")),
        "turns",
    )
    met = made.join(turns, F.col("page") == F.col("turn_page"), "left").withColumn("turned", F.coalesce("turned", F.array().cast("array<bigint>")))
    stays = lambda b: (b.prior != NAMED) & ((b.prior >= UNMARKED) != F.array_contains("turned", b.path))
    met = met.withColumn("article", F.exists("blocks", lambda b: (b.prior == INSIDE) & stays(b)))
    text = F.array_join(F.transform(F.filter("blocks", lambda b: stays(b) | ((b.prior == INSIDE) & ~F.col("article"))), lambda b: b.text), "\n\n")
    return met.select("page_id", "url", text.alias("text")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
