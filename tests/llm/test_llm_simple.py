"""Sharding, URL rules, archives, page text and encoding against short sequential versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from catalogops.llm import bpe, components, html, queries, sharding, urls, warc
from catalogops.llm.components import connected_components
from catalogops.sources import stages


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# --- sharding

def test_shards_follow_the_law_and_slots_have_no_gaps(spark, sf):
    rows = queries.op1(spark, sf).collect()
    docs = {r.doc_id: r.text for r in queries.read(spark, sf, "documents").collect()}
    assert len(rows) == len(docs)
    slots = defaultdict(list)
    for r in rows:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_ties_nulls_and_clashing_names(spark):
    ids = spark.range(20000).withColumn("shard", F.lit("old")).withColumn("slot", F.lit(-1))
    placed = sharding.assign(ids, "id", {0: 1.0, 1: 3.0})
    share = placed.where("shard = 1").count() / 20000
    assert 0.73 < share < 0.77
    moved = sharding.assign(ids, "id", {0: 1.0, 1: 3.0}, {0: 1.0, 1: 3.0, 2: 2.0})
    assert moved.where("grown_shard <> 2 AND grown_shard <> shard").count() == 0
    odd = spark.createDataFrame([(None,), (None,), (5,), (5,), (7,)], "id long")
    out = sharding.number_slots(sharding.assign(odd, "id", {s: 1.0 for s in range(3)}), "id", ["id"], slices=4).collect()
    assert len(out) == 5 and len({r.shard for r in out if r.id == 5}) == 1
    assert len({r.shard for r in out if r.id is None}) == 1
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    assert sharding.number_slots(sharding.assign(odd.limit(0), "id", {0: 1.0}), "id", ["id"]).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(odd, "id", {0: 0.0})


# --- connected components

@pytest.mark.parametrize("bound", [0, 10**6])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, bound):
    monkeypatch.setattr(components, "BROADCAST_EDGES", bound)
    rng = random.Random(1)
    pairs = [(k, k + 1) for k in range(100, 400)] + [(1000, 1000 + k) for k in range(500)]
    pairs += [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(200)] + [(7, 7), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    edges = spark.createDataFrame(pairs + [(None, 3)], "a long, b long")
    got = dict(rows_of(connected_components(edges)))
    assert got == {x: find(x) for x in parent}
    assert connected_components(edges.limit(0)).count() == 0


# --- several articles, near copies

def test_all_articles_of_a_page_and_bodies_of_near_copies(spark):
    two = html.parse(
        "<main><article><h1>One</h1><p>first part</p></article><article class='teaser'><p>go elsewhere for a long time</p></article>"
        "<article><p>second part, longer than the first</p></article></main>"
    )
    assert html.main_text(two, set()) == "One first part second part, longer than the first"
    only = html.parse("<article class=teaser><p>a</p></article><article class=teaser><p>longer</p></article>")
    assert html.main_text(only, set()) == "longer"
    body = "<p>The same story told on every page of this site.</p><p>And its second paragraph.</p>"
    pages = spark.createDataFrame(
        [(k, f"http://a.b/{k}", f"<article><h1>Head {k}</h1>{body}<footer>x</footer></article>") for k in range(12)],
        "page_id long, url string, html string",
    )
    for r in html.extract(pages).collect():
        assert r.text == f"Head {r.page_id} The same story told on every page of this site. And its second paragraph."


# --- URL rules

def test_rules_and_aliases(spark):
    rows = [
        (1, "http://a.com/x", '<link rel="canonical" href="http://z.net/y">'),
        (2, "https://b.com/q#part", None),
        (3, "http://b.com/", '<META content="0; URL=/q" http-equiv=Refresh>'),
        (4, None, "<link rel=canonical href=http://z.net/y>"),
        (5, "no scheme", ""),
        (6, "HTTP://EXAMPLE.NET/en/?q", None),
        (7, "http://d.com?x", "<link href='//w.net' rel='nofollow canonical'>"),
        (8, "http://x.org/fr/1", "<link rel=canonical href=http://d.com?x>"),
        (9, "http://notexample.net/en/", None),
        (9, "http://notexample.net/en/", None),
        (10, "", None),
        (11, "http://a.com/x", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("rule", F.lit("old"))
    got = {r.page_id: r for r in urls.judge(pages, queries.RULES, urls.alias_edges(pages)).collect()}
    assert (got[1].rule, got[1].verdict) == (None, "block")
    assert got[11].verdict == "block"  # same URL, no link of its own
    assert got[2].verdict == got[3].verdict == "allow" and got[2].path == "/q"
    assert (got[4].host, got[4].path, got[4].verdict) == ("", "", "allow")
    assert (got[5].host, got[10].host) == ("", "")
    assert (got[6].host, got[6].rule, got[6].verdict) == ("example.net", "example.net/en/", "allow")
    assert got[7].verdict == "allow" and got[8].rule == "org/fr/"  # blocked and allowed alias: allowed
    assert (got[9].rule, got[9].verdict) == ("net/", "block")
    assert urls.judge(pages.limit(0), queries.RULES, urls.alias_edges(pages.limit(0))).count() == 0


def test_rules_on_pages_match_a_plain_loop(spark, sf):
    rules = [(r.host, r.path, r.verdict, r.name) for r in queries.RULES]
    urls_of = {r.page_id: r.url for r in queries.read(spark, sf, "pages").collect()}
    for r in queries.op4(spark, sf).collect():
        url = urls_of[r.page_id]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [x for x in rules if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fits, key=lambda x: len(x[3]), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best[3])
        assert best is None or r.verdict == best[2]


# --- archives

def test_archives_of_pages(spark, sf):
    pages = {r.page_id: (r.html or "").encode() for r in queries.read(spark, sf, "pages").collect()}
    rows = queries.op3(spark, sf).collect()
    assert Counter(r.page_id for r in rows) == Counter(list(pages))
    for r in rows:
        assert (r.payload_bytes, r.payload_digest) == (len(pages[r.page_id]), hashlib.sha1(pages[r.page_id]).hexdigest())


def test_revisits_odd_payloads_and_empty_tables(spark):
    big, small = "ä\r\n\r\nWARC/1.1\r\n\n2 0 x\n" * 80, "tiny"
    rows = [(1, "u 1", big), (2, None, big), (3, "u3", small), (4, "u4", small), (5, "u5", None), (6, "", ""),
            (None, "n", "z" * 2000), (None, "m", "z" * 2000), (9, "w", big), (9, "w", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")

    def run(df, **sizes):
        arcs, warcs = stages.new_path(spark, "arc"), stages.new_path(spark, "warc")
        warc.write_archives(warc.arc_archives(df, **sizes), arcs)
        warc.convert(spark, arcs, warcs, **sizes)
        archives = warc.read_archives(spark, warcs)
        files.append(archives.count())
        return warc.warc_records(archives).collect()

    files = []

    got = run(pages)
    assert len(got) == 10 and all(r.digest_ok for r in got)
    kinds = Counter((r.key, r.record_type, r.refers_to) for r in got)
    assert kinds[1, "revisit", 9] == 1 and kinds[2, "revisit", 9] == 1 and kinds[9, "response", None] == 2
    assert kinds[3, "response", None] == kinds[4, "response", None] == 1 and kinds[None, "response", None] == 2
    assert {r.payload_bytes for r in got if r.key in (1, 2, 9)} == {len(big.encode())}
    assert len({r.record_id for r in got}) == 10
    # Sizes change the files, not the records; columns named like internal ones are not read.
    clashing = pages.withColumns({"key": F.lit(7), "value": F.lit("v"), "block": F.lit(b"b")}).coalesce(1)
    small_files = run(clashing, archive_bytes=1)
    assert files[-1] >= 10 and Counter((r.key, r.record_type, r.refers_to, r.payload_digest) for r in small_files) == Counter(
        (r.key, r.record_type, r.refers_to, r.payload_digest) for r in got
    )
    assert run(pages.limit(0)) == []


def test_arc_versions_and_broken_files():
    for version in (1, 2):
        block = warc.http_block(5, b"body\n\n")
        data = warc.arc_version_block(version, "a.arc", "2001") + warc.arc_record(version, "http://x/a b", "20010203040506", block)
        (r,) = warc.parse_arc(data)
        assert (r.archive, r.url, r.date, r.block, r.problem) == ("a.arc", "http://x/a%20b", "20010203040506", block, None)
        assert [x.problem for x in warc.parse_arc(data[:-3])] == ["shorter than declared"]
        assert [x.problem for x in warc.parse_arc(data + b"\nnonsense\nmore")] == [None, "no header line"]
    assert list(warc.parse_arc(b"")) == [] and list(warc.parse_warc(b"")) == []
    spaced = b"http://x/a b 1.2.3.4 19990102030405 text/html 2\nhi"
    assert [x.url for x in warc.parse_arc(warc.arc_version_block(1, "n", "1999") + spaced)] == ["http://x/a b"]
    assert warc.warc_date("20010203040506") == "2001-02-03T04:05:06Z"
    assert warc.warc_date("2001") == "2001-01-01T00:00:00Z" and warc.warc_date("x") == "1970-01-01T00:00:00Z"


# --- page text

@pytest.mark.parametrize("source, expected", [
    ("", ""), ("plain  text", "plain text"), ("<p>a&amp;b&nbsp;<b>c</b>d<p>e", "a&b cd e"),
    ("<nav>menu<article><p>kept</article>", "kept"), ("<div class='ad'>x</div><p>y", "y"),
    ("<article><h1>T</h1><p>one<br>two</p><form>f</form></article><footer>z</footer>", "T one two"),
    ("<article><p>a</p><section class='comments'><article><p>no</p></article></section></article>", "a"),
    ("<script>var a='</p>'</script>x<!-- y --><style>p{}</style>", "x"), ("a <p title='x>y'>b", "a b"),
    ("<article>short</article><article>much longer text</article>", "short much longer text"),
    ("<p>cut &am", "cut &am"), ("<ul><li>a<li>b</ul>", "a b"), ("<header>h</header><main><p>m</main><p>out", "m"),
    ("<div class='site-header'>h</div><article><div class='entry-header'><h1>T</h1></div>x</article>", "T x"),
    ("<p>5 < 6 and 7 > 3", "5 < 6 and 7 > 3"), ("<p>x</p><script>never closed", "x"),
])
def test_main_text(source, expected):
    assert html.main_text(html.parse(source), set()) == expected


def test_style_tree_cuts_what_all_pages_share(spark):
    rows = [(k, f"http://s.org/{k}", f"<div class=top>Welcome to us</div><div class=body><p>story {k} of many</p></div>") for k in range(30)]
    rows += [(100 + k, "http://s.org/copy", rows[0][2]) for k in range(40)]  # copies do not outvote
    rows += [(200, "http://one.org/", "<div class=top>Welcome to us</div>"), (201, None, None), (202, "http://s.org", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got[3] == "story 3 of many" and got[100] == got[0] == "story 0 of many"
    assert got[200] == "Welcome to us" and got[201] == got[202] == ""
    assert html.extract(pages.limit(0)).count() == 0
    tree = html.style_tree(pages).where("host = 's.org'").collect()
    assert min(r.content for r in tree) == pytest.approx(0) and max(r.pages for r in tree) == 30


@pytest.mark.parametrize("part", [
    "<h2 id='sharing-data'>kept</h2>", "<div class='search-algorithms'>kept</div>", "<section id='related-work'><p>kept</p></section>",
    "<p class='alert'>kept</p>", "<p><math><mi>kept</mi></math></p>", "<svg><text>kept</text></svg>", "<object>kept</object>",
])
def test_articles_keep_what_their_markup_names(part):
    assert html.main_text(html.parse(f"<article><p>a</p>{part}<p>z</p></article>"), set()) == "a kept z"


@pytest.mark.parametrize("part", [
    "<div class='ad'>x</div>", "<div class='ad-slot'>x</div>", "<ol class='comment-list'><li>x</ol>", "<aside>x</aside>", "<nav>x</nav>",
    "<form>x</form>", "<p hidden>x</p>", "<script>x</script>", "<style>x</style>",
])
def test_articles_lose_what_is_none_of_them(part):
    assert html.main_text(html.parse(f"<article><p>a</p>{part}<p>z</p></article>"), set()) == "a z"


@pytest.mark.parametrize("part, kept", [
    ("<div class='cookie-banner'>x</div>", False), ("<div id='sidebar'>x</div>", False), ("<div role='navigation'>x</div>", False),
    ("<div class='search-algorithms'>x</div>", True), ("<div class='noticeboard-history'>x</div>", True),
])
def test_names_outside_articles(part, kept):
    assert html.main_text(html.parse(f"<p>a</p>{part}"), set()) == ("a x" if kept else "a")


def plain_tree(pages):
    """Importance of every place of one site, by dictionaries."""
    seen = {p: html.site_features(html.parse(p)) for p in set(pages)}
    counts = Counter(f for features in seen.values() for f in features)
    out = {}
    for place in {p for p, kind, _ in counts if kind == 0}:
        n = counts[place, 0, 0]
        texts, layouts = ([c for (p, k, _), c in counts.items() if p == place and k == kind] for kind in (1, 2))
        if n == 1:
            out[place] = (1, 1.0, 1.0)
            continue
        content = 1 - sum(math.log(c) for c in texts) / len(texts) / math.log(n)
        total = sum(layouts)
        entropy = -sum(c / total * math.log(c / total) for c in layouts) if total else 0.0
        out[place] = (n, content, min(1.0, entropy / math.log(n)))
    return out


def test_tree_equals_the_plain_one_and_cuts_without_any_name(spark):
    rng = random.Random(31)
    sources = []
    for k in range(25):
        story = "".join(f"<p>{rng.choice('abc')} story {rng.randrange(1000)}</p>" for _ in range(rng.randrange(1, 4)))
        sources.append(
            "<div class=q1><a href=/>Home</a><a href=/n>News</a></div><div class=q2>We use small files.</div>"
            f"<article><h1>Title {k}</h1>{story}<div class=q3>Tell your friends</div></article><div class=q4>All rights</div>"
        )
    sources += sources[:4] + ["<div class=q1>alone</div>"]
    pages = spark.createDataFrame([(k, "http://t.org/x", h) for k, h in enumerate(sources)], "page_id long, url string, html string")
    got = {r.place: (r.pages, r.content, r.presentation) for r in html.style_tree(pages).collect()}
    expected = plain_tree(sources)
    assert got.keys() == expected.keys()
    assert all(got[p] == pytest.approx(expected[p]) for p in expected)
    texts = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert all(texts[k].startswith(f"Title {k} ") and "friends" not in texts[k] and "story" in texts[k] for k in range(25))
    bare = spark.createDataFrame([(k, "http://u.org/x", h.replace("article", "div")) for k, h in enumerate(sources[:25])], "page_id long, url string, html string")
    for r in html.extract(bare).collect():
        assert r.text.startswith(f"Title {r.page_id} ") and not any(w in r.text for w in ("Home", "files", "friends", "rights"))


# --- encoding

@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_encoder_equals_the_library(reference):
    rng = random.Random(2)
    letters = "abcdeins the  tr01239\n\t\r'\"!éß漢😀²́  "
    texts = ["", " ", "a" * 5000, " " * 3000, "x<|endoftext|>y <|endoftext|>", "!?" * 400, "\x1c\x1f\x85﻿", "Don't we'll THEY'RE"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    ids, counts = bpe.Encoder(queries.tokenizer_path()).encode(texts)
    at = 0
    for text, n, expected in zip(texts, counts, reference.encode_batch(texts, add_special_tokens=False)):
        assert ids[at:at + n].tolist() == expected.ids, text
        at += n


def test_exact_merging_both_ways():
    v = bpe.vocabulary(queries.tokenizer_path())
    rng = random.Random(3)
    words = [bytes(rng.choice(b"abcdeinst hor") for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    assert v.merge_together(words) == [v.merge_exactly(w) for w in words] == v.encode_words(words)


def test_round_trip_of_documents(spark, sf, reference):
    docs = {r.doc_id: r.text or "" for r in queries.read(spark, sf, "documents").collect()}
    rows = queries.op10(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        expected = reference.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in expected)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_encoding_keeps_rows_and_columns(spark):
    path = queries.tokenizer_path()
    rows = [(1, None, "k"), (2, "", "k"), (2, "a b", "k"), (None, "word " * 60000, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, path)
    assert encoded.columns == ["doc_id", "text", "ids"]
    back = bpe.decode(encoded, path, text="text").collect()
    assert [r.text for r in back] == ["", "", "a b", "word " * 60000] and back[0].ids == []
    assert bpe.encode(docs.limit(0), path).count() == 0
    bad = spark.createDataFrame([([10**6],)], "ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(bad, path).collect()
