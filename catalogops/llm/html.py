"""Main text of web pages by a site style tree.

The pages of a host are laid over one another: an element's place is the chain
of tags and classes above it. For every place the tree counts over how many
different pages each child layout (presentation) and each text (content)
appears. Entropy turns the counts into importance: texts that recur on all
pages of a site say nothing about any of them. Branches of low importance are
cut from each page, after the parts that their markup names as no article.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..sources import stages

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_NAME_PARTS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content that is not markup, up to the element's own end tag.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s"
    " samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that are no part of an article by their name.
NOT_ARTICLE = frozenset(
    "nav footer aside form script style noscript template iframe button select option dialog menu"
    " textarea canvas audio video head".split()
)
#: Words that name such parts as a class, id or role. They act outside articles only, and on whole names or on
#: names made of nothing else but such words and those of ``_LAYOUT_WORDS``.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion"
    " nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer masthead"
    " cookie cookies consent notice notices popup modal overlay newsletter subscribe signup login"
    " comment comments disqus reply replies respond share sharing social related recommended toolbar"
    " search widget widgets gdpr alert disclaimer pagination pager contentinfo complementary".split()
)
#: Words that name an article element as one that leads elsewhere.
_TEASER_WORDS = frozenset(
    "teaser teasers promo promotion related recommended sponsor sponsored advert advertisement ad ads".split()
)
_COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
#: The only words that act inside articles, as class or role: adverts and the comments of readers.
_SURE_WORDS = _COMMENT_WORDS | frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored disqus".split())
#: Words that say nothing about what a part holds.
_LAYOUT_WORDS = frozenset(
    "site page main top bottom left right inner outer bar box list item items wrap wrapper container section block slot"
    " area group panel link links button buttons global primary secondary form".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr main menu nav ol p pre section table ul".split()
)
_CLOSES_SELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
_SCOPE = frozenset("ul ol dl table article section body main div".split())


@dataclass
class Element:
    tag: str
    place: int
    noise: bool
    comments: bool
    article: int
    main: bool
    children: list[int] = field(default_factory=list)


@dataclass
class Page:
    """Blocks as (place, text, article number, inside main, named as no article), and layouts as (place, children).

    All blocks are there for the tree, also those that the markup names as menus
    and the like. ``teasers`` are the numbers of the articles named so.
    """

    blocks: list[tuple[int, str, int, bool, bool]] = field(default_factory=list)
    layouts: list[tuple[int, int]] = field(default_factory=list)
    teasers: set[int] = field(default_factory=set)


def _signed(text: str, seed: int = 0) -> int:
    value = xxhash.xxh64_intdigest(text, seed=seed & (2**64 - 1))
    return value - 2**64 if value >= 2**63 else value


def _attributes(text: str) -> tuple[str, list[str], list[str], bool]:
    """Classes as written, the names in class and role, those in id, and whether the element is hidden."""
    classes, names, ids, hidden = "", [], [], False
    for name, *values, alone in _ATTRIBUTE.findall(text):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        if alone:
            hidden = True
        elif name in ("class", "role"):
            names += value.split()
            classes = value if name == "class" else classes
        elif name == "id":
            ids += value.split()
        elif name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
    return classes, names, ids, hidden


def _names_any(names: list[str], words: frozenset[str]) -> bool:
    """Is some name one of the words, or put together from them and words of layout?"""
    for name in names:
        parts = set(_NAME_PARTS.findall(name))
        if parts & words and not parts - words - _LAYOUT_WORDS:
            return True
    return False


def parse(source: str) -> Page:
    """One pass over the markup; open elements are closed as browsers do, broken ends are ignored."""
    page = Page()
    stack = [Element("", 0, False, False, 0, False)]
    held: list[str] = []
    articles = 0

    def flush() -> None:
        if held:
            text = " ".join(_html.unescape("".join(held)).split())
            held.clear()
            top = next(e for e in reversed(stack) if e.tag not in INLINE)
            if text:
                page.blocks.append((top.place, text, top.article, top.main, top.noise))

    def close(upto: int) -> None:
        while len(stack) > upto:
            gone = stack.pop()
            if gone.tag not in INLINE:
                page.layouts.append((gone.place, _signed(",".join(map(str, gone.children)))))

    at, end = 0, len(source)
    while at < end:
        m = _TOKEN.search(source, at)
        if not m:
            held.append(source[at:])
            break
        if m.start() > at:
            held.append(source[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "br":
                flush()
                continue
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if k:
                if any(e.tag not in INLINE for e in stack[k:]):
                    flush()
                close(k)
            elif tag not in INLINE:
                flush()
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if tag in RAW:
            ended = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(source, at)
            at = ended.end() if ended else end
            continue
        if tag in _CLOSES_P:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == "p"), 0)
            if k and not any(e.tag in _SCOPE for e in stack[k + 1:]):
                close(k)
        if tag in _CLOSES_SELF:
            k = len(stack) - 1
            while k and stack[k].tag not in _CLOSES_SELF[tag] and stack[k].tag not in _SCOPE:
                k -= 1
            if k and stack[k].tag in _CLOSES_SELF[tag]:
                close(k)
        classes, names, ids, hidden = _attributes(m[3]) if "=" in m[3] or "hidden" in m[3] else ("", [], [], False)
        if tag in ("article", "main", "body") and stack[-1].noise and not stack[-1].comments:
            # An unclosed menu or advert does not swallow the article after it.
            close(next(k for k in range(1, len(stack)) if stack[k].noise))
        top = stack[-1]
        frame = tag in ("html", "body", "article", "main")
        if top.article:
            named, site_head = not frame and _names_any(names, _SURE_WORDS), False
        else:
            named = not frame and _names_any(names + ids, NOISE_WORDS)
            site_head = tag == "header" or tag == "div" and _names_any(names + ids, frozenset({"header"}))
        noise = top.noise or hidden or named or tag in NOT_ARTICLE or site_head
        commented = _names_any(names + ids if not top.article else names, _COMMENT_WORDS)
        if tag == "article" and commented:
            noise = True
        comments = top.comments or commented
        article = top.article
        if tag == "article" and not article and not noise:
            articles += 1
            article = articles
            if _names_any(names + ids, _TEASER_WORDS):
                page.teasers.add(article)
        place = top.place if tag in INLINE else _signed(f"{tag}.{classes}", top.place)
        if tag not in INLINE:
            top.children.append(place)
        main = top.main or tag == "main" or "main" in names + ids and tag in ("div", "section")
        stack.append(Element(tag, place, noise, comments, article, main))
    flush()
    close(0)
    return page


def site_features(page: Page) -> set[tuple[int, int, int]]:
    """(place, kind, feature): kind 0 the page itself, 1 content, 2 presentation."""
    return (
        {(p, 0, 0) for p, *_ in page.blocks}
        | {(p, 1, _signed(text)) for p, text, *_ in page.blocks}
        | {(p, 2, layout) for p, layout in page.layouts}
    )


def main_text(page: Page, low: set[int]) -> str:
    """Blocks of all articles, else of the main part, else of all that is no noise, without low branches.

    Articles named as teasers count only where there is no other, and then the
    largest. The place with most of the articles' text is their body: it stays
    where the low branches would take more than half of the text, as they do on
    a site of near copies.
    """
    own = [(p, t, a, m) for p, t, a, m, named in page.blocks if not named]
    sizes: dict[int, int] = {}
    for _, text, article, _ in own:
        if article:
            sizes[article] = sizes.get(article, 0) + len(text)
    if sizes:
        best = set(sizes) - page.teasers or {max(sizes, key=lambda k: (sizes[k], -k))}
        blocks = [(p, t) for p, t, a, _ in own if a in best]
        held: dict[int, int] = {}
        for p, t in blocks:
            held[p] = held.get(p, 0) + len(t)
        if 2 * sum(n for p, n in held.items() if p in low) > sum(held.values()):
            low = low - {max(held, key=held.__getitem__)}
    else:
        blocks = [(p, t) for p, t, _, m in own if m] or [(p, t) for p, t, _, _ in own]
    kept = [t for p, t in blocks if p not in low]
    return " ".join(kept or [t for _, t in blocks])


def host_of(url: str) -> Column:
    """Lower-cased host of a URL, empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"://([^/?#]*)", 1), F.lit("")))


def _parsed(batch: pa.RecordBatch, at: int) -> Iterator[Page]:
    for source in batch.column(at):
        yield parse(source.as_py() or "")


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, place, pages, content, presentation): the tree of every site with both importances.

    Equal pages of a host count once. Importance of content is 1 less the mean
    entropy of the place's texts over the site's pages, to the base of the
    number of pages; that of presentation is the entropy of the place's layouts.
    Both are 1 where a place was seen on one page only. Every count is summed
    on (host, place, feature) before anything is joined or gathered.
    """
    chosen = pages.select(host_of(url).alias("host"), F.xxhash64(html).alias("page"), F.col(html).alias("html"))
    schema = T.StructType([
        T.StructField("host", T.StringType()), T.StructField("page", T.LongType()),
        T.StructField("place", T.LongType()), T.StructField("kind", T.LongType()),
        T.StructField("feature", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [
                (h, i, *f)
                for h, i, page in zip(hosts, ids, _parsed(batch, 2))
                for f in site_features(page)
            ]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=schema.names
            )

    counted = (
        chosen.mapInArrow(run, schema).distinct()
        .groupBy("host", "place", "kind", "feature").agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    log_n = F.ln("n")
    per_place = counted.groupBy("host", "place").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.avg(F.when(F.col("kind") == 1, log_n)).alias("mean_log"),
        F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("layouts"),
        F.sum(F.when(F.col("kind") == 2, F.col("n") * log_n)).alias("layout_logs"),
    ).where("pages IS NOT NULL")
    one = F.col("pages") <= 1
    spread = F.coalesce(F.ln("layouts") - F.col("layout_logs") / F.col("layouts"), F.lit(0.0))
    return per_place.select(
        "host", "place", F.col("pages").cast("long").alias("pages"),
        F.when(one, 1.0).otherwise(1 - F.col("mean_log") / F.ln("pages")).alias("content"),
        F.when(one, 1.0).otherwise(F.least(F.lit(1.0), spread / F.ln("pages"))).alias("presentation"),
    )


def extract(
    pages: DataFrame, url: str = "url", html: str = "html", text: str = "text",
    threshold: float = 0.3, share: float = 0.1, least_pages: int = 8,
) -> DataFrame:
    """Add ``text``: the article of every page, blocks in page order, joined by one space.

    A place is cut when (1 - ``share``) content + ``share`` presentation
    importance is below ``threshold`` and at least ``least_pages`` different
    pages of the site have it; a page never loses all its text that way. NULL
    or empty html gives the empty text; a NULL url belongs to the host "".
    Equal pages get equal texts. The other columns pass through; ``text`` is
    replaced if present.

    The table of cut places has one row per site. It is written first, so the
    planner broadcasts it only while it is small and else splits a hot host.
    """
    importance = (1 - share) * F.col("content") + share * F.col("presentation")
    low = stages.stage(
        style_tree(pages, url, html).where((F.col("pages") >= least_pages) & (importance < threshold))
        .groupBy("host").agg(F.collect_set("place").alias("_low")),
        "low-places",
    ).withColumnRenamed("host", "_host")
    joined = pages.withColumn("_host", host_of(url)).join(low, "_host", "left").drop("_host")
    kept = [f for f in pages.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField(text, T.StringType())])
    joined = joined.select(*[f"`{f.name}`" for f in kept], F.col(html).alias("_html"), "_low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows = batch.column(batch.num_columns - 1).to_pylist()
            texts = [main_text(p, set(l or ())) for p, l in zip(_parsed(batch, batch.num_columns - 2), lows)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(texts, pa.string())], names=schema.names
            )

    return joined.mapInArrow(run, schema)
