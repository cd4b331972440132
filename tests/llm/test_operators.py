"""Each operator against brute force, and on nulls, empty texts, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import time
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyspark.sql.functions as F
import pytest
import tiktoken

from brindle.llm import (
    byte_bpe,
    decontamination,
    html_extraction,
    jaccard_join,
    license_bank,
    license_scan,
    line_dedup,
    oracles,
    pii,
    pretokens,
    quality_rules,
    queries,
    token_counts,
    url_filter,
)
from brindle.llm.common import shaped

from llm_brute import brute_hits, brute_links, brute_statistics

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
DOC = "doc_id bigint, text string"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOC)


def prose(seed, n, words=400):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


# ---- shared ----


def test_shaped_leaves_clashing_names_out(spark):
    df = spark.range(1).select(F.lit(1).alias("doc_id"), F.lit("a").alias("text"), F.lit(2).alias("TEXT"), F.lit(3).alias("x"), F.lit(4).alias("x"), F.lit(5).alias("N_Words"))
    out = shaped(df, ["doc_id", "text"], ["n_words"])
    assert out.columns == ["doc_id", "text", "x"]
    with pytest.raises(ValueError, match="missing"):
        shaped(df, ["nothing"])


# ---- 1: HTML extraction ----

PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body class='has-sidebar'>"
    "<nav><ul><li><a href=/>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div><div class=ad>Buy {0}</div>"
    "{1}<aside>more {0}</aside><form><input name=q> find</form><div id=comments><p>first! {0}</div><footer>&copy; us</footer></body></html>"
)


def test_html_article():
    page = PAGE.format(1, "<article><header><h1>Ti&amp;tle\n  here</h1></header><p><b>One<br>two &lt;x&gt;<p>three <!-- c --> four<ul><li>a<li>b</ul></article>")
    assert html_extraction.extract(page) == "Ti&tle here\nOne two <x>\nthree four\na\nb"


def test_html_wrapper_drops_constants_and_keeps_slots():
    pages = [PAGE.format(i, f"<div class=story><div class=tag>Daily news of the town</div><h1>Head {i}</h1><p>Body {i}</div>") for i in range(6)]
    assert html_extraction.extract(pages[3], html_extraction.template_of(pages)) == "Head 3\nBody 3"
    assert html_extraction.extract(pages[3]) == "Daily news of the town\nHead 3\nBody 3"


def test_html_constant_among_like_siblings():
    pages = [f"<p>Read more news on our site</p>{''.join(f'<p>text {i} {k}</p>' for k in range(1 + i % 4))}<p>Write to us</p>" for i in range(8)]
    t = html_extraction.template_of(pages)
    assert [html_extraction.extract(p, t) for p in pages] == ["\n".join(f"text {i} {k}" for k in range(1 + i % 4)) for i in range(8)]


def test_html_matching_decides(monkeypatch):
    """Without the alignment, siblings paired by position, constants behind a varying number of blocks are lost."""
    pages = [f"<div>menu</div>{''.join(f'<div>story {i} {k}</div>' for k in range(1 + i % 3))}<div>footer</div>" for i in range(9)]
    want = ["\n".join(f"story {i} {k}" for k in range(1 + i % 3)) for i in range(9)]
    run = lambda: [html_extraction.extract(p, html_extraction.template_of(pages)) for p in pages]
    assert run() == want
    monkeypatch.setattr(html_extraction._Classes, "middle", lambda self, a, b: (0, 0))
    assert run() == want  # ends that are aligned first change nothing
    monkeypatch.setattr(html_extraction, "aligned", lambda x, y, worth: [(i, i) for i in range(min(len(x), len(y)))])
    assert run() != want


def test_html_depth_and_width_are_not_bounded():
    deep = [f"{'<div>' * 300}<b>Daily news of the town</b><p>one {i}</p><p>two {i}</p>" for i in range(6)]
    assert html_extraction.extract(deep[2], html_extraction.template_of(deep)) == "one 2\ntwo 2"
    assert html_extraction.extract(deep[2]) == "Daily news of the town\none 2\ntwo 2"
    wide = ["".join(f"<div class=c{k}>text {i} {k}</div>" for k in range(3000 + 7 * i)) + "<div>the end</div>" for i in range(5)]
    t = html_extraction.template_of(wide)
    assert html_extraction.extract(wide[1], t) == "\n".join(f"text 1 {k}" for k in range(3007))


def test_html_names_that_only_contain_a_boilerplate_word():
    keep = ("<div class=related-work>a</div>", "<div class='search-results'>b</div>", "<article class='promo-2024'>c</article>")
    assert [html_extraction.extract(x) for x in keep] == ["a", "b", "c"]
    gone = ("<div class=related-posts>a</div>", "<div class='ad-slot-2'>b</div>", "<section id=post-comments>c</section>", "<div class='site-header'>d</div>")
    assert [html_extraction.extract(x + "<p>own") for x in gone] == ["own"] * 4


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class='search results'>a</div>", "a"),
        ("<article><div class='related content'>a</div></article>", "a"),
        ("<div class=content-with-sidebar>a</div>", "a"),
        ("<div class=related-posts>a</div>", "a"),  # all that there is
        ("<div class=comment-thread>a</div><p>own", "own"),
        ("<div class=news-comments>a</div><p>own", "own"),
        ("<div id=disqus_thread>a</div><p>own", "own"),
        ("<article><p>own words of the story</p><article>first!</article><article>no, second</article></article>", "own words of the story"),
        ("<div class=google-ads>a</div><p>own", "own"),
        ("<ins class=adsbygoogle>a</ins><p>own", "own"),
        ("<div class=cookie-law-info>a</div><p>own", "own"),
        ("<div class=share-tools>a</div><p>own", "own"),
        ("<ol class=breadcrumb-trail><li>a</ol><p>own", "own"),
        ("<article><p>A long story of many words that goes on and on and does not end.</p></article><article><h2><a href=/x>More</a></h2></article>", "A long story of many words that goes on and on and does not end."),
        ("<main><article><p>one story</p></article><article><p>one more</p></article></main>", "one story\none more"),
        ("<article><article><p>wrapped</p></article></article>", "wrapped"),
        ("<p>a</b></i><i>b<td></i>c</p>d", "ab\nc\nd"),
        ("<a title='x>y' href=\"z\">k</a> <a title='never ends>l", "k l"),
    ],
)
def test_html_declarations(html, text):
    assert html_extraction.extract(html) == text


def test_html_templates_overrule_what_pages_declare():
    """Without its host's template each of these pages comes out otherwise."""
    r = random.Random(5)
    story = lambda i, n: f"story {i} " + " ".join(r.choice(["red", "green", "blue", "grey"]) for _ in range(n))
    tips = [story(i, 3) for i in range(8)]
    long = [story(i, 60) for i in range(8)]
    outside = [f"<article><p>{a}</p></article><div><p>{b}</p></div>" for a, b in zip(tips, long, strict=True)]
    assert [html_extraction.extract(p) for p in outside] == tips
    t = html_extraction.template_of(outside)
    assert t.whole and [html_extraction.extract(p, t) for p in outside] == [f"{a}\n{b}" for a, b in zip(tips, long, strict=True)]
    weak = [f"<div class=search><p>{b}</p></div><p>{a}</p>" for a, b in zip(tips, long, strict=True)]
    assert [html_extraction.extract(p) for p in weak] == tips
    t = html_extraction.template_of(weak)
    assert t.kept and [html_extraction.extract(p, t) for p in weak] == [f"{b}\n{a}" for a, b in zip(tips, long, strict=True)]
    sure = [f"<div class=comments><p>{b}</p></div><p>{a}</p>" for a, b in zip(tips, long, strict=True)]
    t = html_extraction.template_of(sure)
    assert [html_extraction.extract(p, t) for p in sure] == tips
    menus = [f"<ul>{''.join(f'<li><a href=/>tag {i} {k}</a>' for k in range(2 + i % 3))}</ul><p>{b}</p>" for i, b in enumerate(long)]
    t = html_extraction.template_of(menus)
    assert t.menus and not t.constants and [html_extraction.extract(p, t) for p in menus] == long
    assert all(html_extraction.extract(p) != b for p, b in zip(menus, long, strict=True))


def test_html_template_decides_in_the_table(spark):
    rows = [(i, f"http://h.org/{i}", f"<article>tip {i}</article><ul><li><a>link {i}</a></ul><div>{f'word{i} ' * 50}</div><div>imprint</div>") for i in range(30)]
    got = {r.page_id: r.text for r in html_extraction.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)).collect()}
    assert got == {i: f"tip {i}\n{' '.join([f'word{i}'] * 50)}" for i in range(30)}


def test_html_long_pages_take_linear_time():
    pages = {
        "misnested": "<b>" * 50_000 + "</i>" * 50_000, "behind a wall": "<i><td>" + "<b>" * 50_000 + "</i>" * 50_000, "paragraphs": "<p><b>" * 50_000,
        "items": "<ul>" + "<li><b>" * 40_000, "quotes": "<a b='" * 50_000, "unclosed": "<a " * 100_000, "odd quotes": '<a b="c" d=\'>' * 25_001, "closing": "</b '" * 60_000,
    }
    for name, page in pages.items():
        began = time.process_time()
        html_extraction.extract(page + "<p>end")
        assert time.process_time() - began < 3, name  # 300 KB in about a second, however busy the machine


def test_html_unlike_siblings_align_together():
    def page(seed):
        r = random.Random(seed)
        return "".join(f"<div>{''.join(f'<{t}>{r.random()}</{t}>' for t in r.choices(['p', 'section', 'ul', 'div'], k=3))}</div>" for _ in range(800))

    a, b = html_extraction.page_tree(page(1)), html_extraction.page_tree(page(2))
    began = time.process_time()
    score, pairs = html_extraction.matching(a, b)
    assert time.process_time() - began < 3
    assert score == len(pairs) and 1600 < score <= len(a.labels)


@pytest.mark.parametrize("frame", ["<div>Home News Contact</div>{}<div>All rights reserved</div>", "<div><ul><li>Home<li>News</ul></div>{}<div><ul><li>Terms<li>All rights reserved</ul></div>"])
def test_html_wrapper_sees_unclassed_menus_and_footers(frame):
    """Menus and footers are plain divs and lists among as many stories as a page has."""
    stories = [[f"story {i} {k}" for k in range(1 + i % 3)] for i in range(9)]
    pages = [f"<body>{frame.format(''.join(f'<div>{x}</div>' for x in s))}</body>" for s in stories]
    for seed in range(4):
        shuffled = list(pages)
        random.Random(seed).shuffle(shuffled)
        t = html_extraction.template_of(shuffled)
        assert [html_extraction.extract(p, t) for p in pages] == ["\n".join(s) for s in stories]
    few = html_extraction.template_of(pages[:4])
    assert html_extraction.extract(pages[0], few) != "story 0 0"  # under MIN_PAGES nothing is constant


def test_html_copies_of_the_longest_page_are_content():
    pages = [f"<main><p>a {i}</p><p>b {i}</p></main>" for i in range(10)] + ["<main><p>x</p><p>y</p><p>z</p></main>"] * 6
    for first in range(16):
        reference = html_extraction.page_tree(pages[first])
        stats = {}
        for p in pages:
            html_extraction.add_page(stats, reference, html_extraction.page_tree(p))
        t = html_extraction.Template(pages[first], html_extraction.constants_of(reference, stats))
        assert html_extraction.extract(pages[-1], t) == "x\ny\nz"


def brute_matching(a, b, i=0, j=0):
    """Simple tree matching by its textbook recursion; an equal text counts as one more node."""
    if a.labels[i] != b.labels[j]:
        return 0
    x, y = a.kids[i], b.kids[j]
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for p in range(len(x)):
        for q in range(len(y)):
            m[p + 1][q + 1] = max(m[p][q + 1], m[p + 1][q], m[p][q] + brute_matching(a, b, x[p], y[q]))
    return 1 + (0 != a.texts[i] == b.texts[j]) + m[-1][-1]


def test_html_simple_tree_matching_equals_brute_force(monkeypatch):
    r = random.Random(6)

    def some(depth):
        return "".join(f"<{t}>{r.choice(['', 'x', 'y', str(r.random())])}{some(depth - 1) if depth else ''}</{t}>" for t in r.choices(["div", "section", "ul"], k=r.randrange(4)))

    for k in range(300):
        monkeypatch.setattr(html_extraction, "CELLS", 1 if k % 2 else 1 << 22)
        a, b = (html_extraction.page_tree(some(3)) for _ in range(2))
        score, pairs = html_extraction.matching(a, b)
        assert score == brute_matching(a, b) == sum(1 + (0 != a.texts[i] == b.texts[j]) for i, j in pairs)
        assert all(a.labels[i] == b.labels[j] for i, j in pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)


def test_html_table(spark):
    schema = "page_id bigint, url string, html string, TEXT string"
    rows = [(1, None, None, "a"), (2, "nohost", "", "a"), (3, "http://h/x", "<p>only", "b"), (3, "http://h/x", "<p>only", "b"), (None, "http://h", "x" * 50_000, "c"), (5, "http://h/", "<div " * 2000 + "'", "c"), (6, "http://g", "<div>" * 5000 + "deep", "")]
    got = html_extraction.extracted(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    by = {r.page_id: r.text for r in got.collect()}
    assert by[1] == by[2] == "" and by[3] == "only" and by[None] == "x" * 50_000 and by[6] == "deep" and got.count() == 7
    assert html_extraction.extracted(spark.createDataFrame([], schema)).count() == 0
    shop = [(i, f"http://h{i % 2}.org/{i}", f"<div>menu of the shop</div>{''.join(f'<div>story {i} {k}</div>' for k in range(1 + i % 3))}<div>footer</div>", "") for i in range(40)]
    shop += [(100 + i, f"http://few.org/{i}", "<div>menu of the shop</div><div>same</div>", "") for i in range(4)]
    for limit in (1 << 20, 0):
        for n in (1, 7):
            got = html_extraction.extracted(spark.createDataFrame(shop, schema).repartition(n), limit).collect()
            want = {i: "\n".join(f"story {i} {k}" for k in range(1 + i % 3)) for i in range(40)} | {100 + i: "menu of the shop\nsame" for i in range(4)}
            assert {r.page_id: r.text for r in got} == want


def test_html_joined_templates_equal_broadcast_ones(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    a = {r.page_id: r.text for r in html_extraction.extracted(pages).collect()}
    b = {r.page_id: r.text for r in html_extraction.extracted(pages, max_broadcast=0).collect()}
    assert a == b
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"<p>|<h1>", article))
        assert a[r.page_id] == "\n".join(x for x in blocks if x)


# ---- 2: byte-level BPE ----


@pytest.fixture(scope="module")
def oracle():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=pretokens.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_the_library(oracle):
    codec, r = byte_bpe.codec(RANKS, PATTERN), random.Random(3)
    letters = list("aaab éñß日本語 \n\t0123٣Ⅷ  ’'s!…😀́") + ["the", "ing", "<|endoftext|>", "'re"]
    for k in range(1500):
        s = "".join(r.choice(letters) for _ in range(r.randint(0, 60)))
        if k % 100 == 0:
            s = s.replace(" ", "") * 100
        ids = codec.encode(s)
        assert list(ids) == oracle.encode_ordinary(s)
        assert codec.decode(ids) == s.encode()


def test_bpe_table(spark, oracle):
    rows = [(1, None), (2, ""), (3, "Hello  world's"), (3, "Hello  world's"), (None, "ab" * 20_000)]
    df = docs_of(spark, rows).withColumn("IDS", F.lit(1))
    got = byte_bpe.digests(byte_bpe.round_trip(df, RANKS, PATTERN)).collect()
    assert len(got) == 5
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        ids = oracle.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    both = byte_bpe.decode(byte_bpe.encode(docs_of(spark, rows), RANKS, PATTERN), RANKS, PATTERN)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in both.collect())
    assert byte_bpe.round_trip(docs_of(spark, []), RANKS, PATTERN).count() == 0


# ---- 3: URL filter ----


def test_url_cascade_is_exact(spark):
    keys = [(f"host{i}.example", i % 3 == 0) for i in range(3000)]
    levels = url_filter.cascade(spark.createDataFrame(keys, "key string, listed boolean"))
    assert len(levels) > 2
    out = spark.createDataFrame(keys, "key string, listed boolean").withColumn("got", url_filter.listed_in(F.col("key"), levels))
    assert out.where("got <> listed").count() == 0
    with pytest.raises(ValueError, match="bits"):
        url_filter.cascade(spark.createDataFrame(keys, "key string, listed boolean"), max_bits=128)


@pytest.mark.parametrize("few", [0, 40, 100_000])
def test_url_cascade_ends_alike(spark, few):
    keys = spark.range(20_000).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") % 7 == 3).alias("listed"))
    levels = url_filter.cascade(keys, few=few)
    assert keys.where(url_filter.listed_in(F.col("key"), levels) != F.col("listed")).isEmpty()
    assert len(levels) == 3 if few > 20_000 else len(levels) > 8


def test_url_cascade_near_its_bound(spark):
    keys = spark.range(60_000).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") < 20_000).alias("listed"))
    total = sum(x.bits for x in url_filter.cascade(keys))
    levels = url_filter.cascade(keys, max_bits=total)
    assert keys.where(url_filter.listed_in(F.col("key"), levels) != F.col("listed")).isEmpty()
    with pytest.raises(url_filter.TooLong):
        url_filter.cascade(keys, max_bits=total - 1)


def test_url_hosts_of_very_many_labels(spark):
    rows = [(1, "http://" + "a." * 50_000 + "spam.org/x"), (2, "http://" + "a." * 50_000 + "spam.com"), (3, "http://" + "." * 100_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    url_filter.judge(pages, [], domains(spark, "spam.org")).collect()
    began = time.time()
    got = url_filter.judge(pages, [], domains(spark, "spam.org", "b.a.spam.org")).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "allow", 3: "allow"} and time.time() - began < 20


def domains(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "domain string")


def test_url_query_takes_a_cascade_of_levels(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    keys = url_filter.universe(pages, queries.url_block_list(spark))
    assert 0 < keys.where("listed").count() < keys.count()
    levels = url_filter.cascade(keys)
    assert len(levels) >= 2 and levels[0].bits
    first = keys.where(url_filter.listed_in(F.col("key"), levels[:1]) != F.col("listed")).count()
    assert first > 0  # the first level alone would block hosts that aren't listed
    assert keys.where(url_filter.listed_in(F.col("key"), levels) != F.col("listed")).count() == 0


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/a?b", "x://example.com/en/#t", "x://a.example.com/de/", "x://notexample.com/en/", "http://b.net/fr/x", "http://spam.org?x=/en/", "http://sub.spam.org#f", "a://b://c/d", "http://com", "http://com/"]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(0, None, "y")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string, Rule string"), queries.URL_RULES, domains(spark, "spam.org", None, "spam.org"))
    r = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in got.collect()}
    assert r[0] == r[1] == r[2] == r[3] == ("", "", None, "allow")
    assert r[4] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert r[5] == ("example.com", "/en/", "example.com/en/", "block")
    assert r[6] == ("a.example.com", "/de/", "com/", "allow")
    assert r[7] == ("notexample.com", "/en/", "com/", "allow")
    assert r[8] == ("b.net", "/fr/x", "net/fr/", "block")
    assert r[9] == ("spam.org", "", None, "block") and r[10] == ("sub.spam.org", "", None, "block")
    assert r[11] == ("b:", "//c/d", None, "allow") and r[12] == ("com", "", None, "allow") and r[13] == ("com", "/", "com/", "allow")
    assert got.count() == len(rows)
    joined = url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string, Rule string"), queries.URL_RULES, domains(spark, "spam.org", None, "spam.org"), max_bits=1)
    assert sorted(map(str, joined.collect())) == sorted(map(str, got.collect()))
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge(empty, queries.URL_RULES, domains(spark)).count() == 0


# ---- 4: token counts ----


def best(token, costs):
    f = [(0, 0)] + [None] * len(token)
    for d in range(1, len(token) + 1):
        for s in range(d):
            if f[s] is not None and token[s:d] in costs:
                x = (f[s][0] + costs[token[s:d]], f[s][1] + 1)
                f[d] = x if f[d] is None else min(f[d], x)
    return 0 if f[-1] is None else f[-1][1]


def test_token_counts_equal_brute_force():
    costs = token_counts.zipf_costs(pretokens.read_ranks(RANKS))
    c, r = token_counts.Counter(costs, PATTERN), random.Random(5)
    for _ in range(600):
        s = "".join(r.choice("abcdeé 日1!'s") for _ in range(r.randint(0, 30)))
        tokens = c.split(s)
        want = [best(t.encode(), costs) for t in tokens]
        assert c.count(s) == (len(tokens), sum(want), 0)


def test_token_counts_ties_unknown_and_bounds(monkeypatch):
    costs = {b"a": 1, b"aa": 2, b"aaa": 3, b"b": 5}
    monkeypatch.setattr(token_counts, "MAX_NODES", 3)
    monkeypatch.setattr(token_counts, "DEEPEST", 2)
    c = token_counts.Counter(costs, r"\S+")
    assert c.count("aaaaaa") == (1, 2, 0)  # equal costs: the fewest pieces
    assert c.count("abx ab") == (2, 2, 1)
    assert c.trie.count(b"aaaaaa") == 2


def cheapest(piece, ranks):
    """Tokens of the cheapest segmentation of a pre-token, ties to fewer tokens, by the textbook recursion over ends."""
    best = [(0, 0)]
    for end in range(1, len(piece) + 1):
        best.append(min((best[k][0] + round(1e6 * math.log(ranks[piece[k:end]] + 2)), best[k][1] + 1) for k in range(end) if piece[k:end] in ranks))
    return best[-1][1]


def test_token_counts_query_equals_brute_force(spark, data):
    import regex

    ranks = pretokens.read_ranks(RANKS)
    longest, split, known = max(map(len, ranks)), regex.compile(PATTERN), {}
    got = {r.doc_id: r for r in queries.op4_token_counts(spark, data).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert got.keys() == texts.keys() and longest < 1000
    for i, t in texts.items():
        found = [p.encode() for p in split.findall(t)]
        for p in set(found) - known.keys():
            known[p] = cheapest(p, ranks)
        assert (got[i].n_pretokens, got[i].n_tokens, got[i].n_unknown) == (len(found), sum(known[p] for p in found), 0)


def test_token_counts_table(spark):
    got = token_counts.counted(docs_of(spark, [(1, None), (2, ""), (3, "the the"), (3, "the the"), (None, "x" * 30_000)]), RANKS, PATTERN).collect()
    by = {r.doc_id: (r.n_pretokens, r.n_unknown) for r in got}
    assert by == {1: (0, 0), 2: (0, 0), 3: (2, 0), None: (1, 0)} and len(got) == 5
    counts = {r.doc_id: r.n_tokens for r in got}
    assert counts[1] == counts[2] == 0 and counts[3] == sum(cheapest(p, pretokens.read_ranks(RANKS)) for p in (b"the", b" the"))
    assert token_counts.counted(docs_of(spark, []), RANKS, PATTERN).count() == 0


# ---- 5: line dedup ----


def test_line_dedup(spark):
    long = "one two three four five six seven eight nine ten eleven"
    rows = [(2, f"head\n{long}\ntail"), (1, f"{long.upper()}\n\nshort\n{long}"), (3, long), (3, long), (None, f"  {long}  \nx"), (4, None), (5, ""), (6, "short\nshort")]
    got = line_dedup.deduplicated(docs_of(spark, rows).withColumn("Kept", F.lit(1)))
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append((r.text, r.n_units, r.n_removed, [tuple(s) for s in r.removed], [tuple(s) for s in r.kept], r.n_shared_words, r.passage_words))
    n = len(long)
    assert by[1] == [(f"{long.upper()}\n\nshort", 4, 1, [(n + 8, 2 * n + 8)], [(0, n + 7)], 23, 23)]
    assert by[2] == [("head\ntail", 3, 1, [(5, 5 + n)], [(0, 4), (6 + n, 10 + n)], 11, 11)]
    assert by[3] == [("", 1, 1, [(0, n)], [], 11, 11)] * 2
    assert by[None] == [("x", 2, 1, [(0, n + 4)], [(n + 5, n + 6)], 11, 11)]
    assert by[4] == [(None, 0, 0, [], [], 0, 0)] and by[5][0][0] == "" and by[6] == [("", 2, 2, [(0, 5), (6, 11)], [], 2, 2)]
    assert line_dedup.deduplicated(docs_of(spark, [])).count() == 0
    some = {r.doc_id: r.n_removed for r in line_dedup.deduplicated(docs_of(spark, rows), min_words=10).collect()}
    assert some[6] == 0 and some[2] == 1


def test_line_dedup_tells_passages_from_chance(spark, tmp_path):
    passage = "\n".join(prose(7, 30, 300) + f" {i}" for i in range(2))
    rows = [(1, f"own one\n{passage}\n\nmenu"), (2, f"MENU\nown two\n{passage.upper()}"), (3, "own three\nmenu\nown four"), (4, "lone\nlone"), (5, "lone words " * 20_000)]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_removed, r.passage_words, r.has_passage) for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (0, 63, True), 2: (3, 62, True), 3: (1, 1, False), 4: (1, 0, False), 5: (0, 0, False)}


def test_line_dedup_sees_passages_within_lines(spark, tmp_path):
    """A passage of 60 words that begins and ends inside sentences of one long line, in another place of each text."""
    words = prose(11, 60, 5000).split()
    passage = " ".join(w + "." * (k % 7 == 4) for k, w in enumerate(words))
    rows = [(1, f"{prose(1, 30)} {passage} {prose(2, 9)}. {prose(3, 20)}"), (2, f"{prose(4, 3)}. {prose(5, 8)} {passage} {prose(6, 90)}"), (3, f"{prose(7, 200)}. {words[0]}.")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_removed, r.passage_words, r.has_passage) for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (0, 49, True), 2: (0, 49, True), 3: (0, 0, False)}


def test_line_dedup_finds_the_shared_runs_of_the_given_documents(spark):
    """Held against all runs of 51 words, by brute force: at least 0.9 found, at least 0.95 of the rest left alone."""
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text.lower().split()) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    seen, truth = {}, set()
    for i, words in docs:
        for k in range(len(words) - 50):
            other = seen.setdefault(hash(tuple(words[k : k + 51])), i)
            if other != i:
                truth |= {i, other}
    found = {r.doc_id for r in queries.op5_line_dedup(spark, folder).where("has_passage").collect()}
    assert len(found & truth) >= 0.9 * len(truth) and len(found - truth) <= 0.05 * (len(docs) - len(truth))


def test_line_dedup_query_takes_short_lines(spark, tmp_path):
    docs_of(spark, [(1, "a b c\n\nmenu"), (2, "A  b c\nMENU\n\nown"), (3, "one two three four five six seven eight nine")]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.text, r.n_removed, r.removed_spans) for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: ("a b c\n\nmenu", 0, ""), 2: ("\nown", 2, "0:6,7:11"), 3: ("one two three four five six seven eight nine", 0, "")}


# ---- 6: decontamination ----


def test_decontamination_equals_brute_force(spark):
    r = random.Random(2)
    items = [(i, prose(i, n, 5)) for i, n in enumerate([25, 12, 10, 9, 3, 14])] + [(10, prose(0, 25, 5)), (None, prose(40, 11, 5)), (11, None), (12, "!?"), (13, "Éa-ÉB c")]
    docs = [(i, prose(100 + i, r.randint(0, 80), 6)) for i in range(40)]
    docs += [(50, "X " + items[0][1].upper() + " y. " + items[1][1]), (51, None), (52, ""), (53, items[7][1]), (54, "éa éb c Éa,ÉB;C"), (50, "X " + items[0][1].upper() + " y. " + items[1][1]), (None, items[5][1] * 300)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = docs_of(spark, docs).withColumn("N_HIT", F.lit(1))
    for limit in (10**6, 0):
        got = decontamination.scan(df, bench, max_index_words=limit)
        assert sorted(map(str, ((x.doc_id, x.n_words, x.n_hit, list(x.items)) for x in got.collect()))) == sorted(map(str, brute_hits(docs, items)))
    none = spark.createDataFrame([], "item_id bigint, text string")
    for limit in (10**6, -1):
        assert decontamination.scan(df, none, max_index_words=limit).where("n_hit > 0").count() == 0
        assert decontamination.scan(docs_of(spark, []), bench, max_index_words=limit).count() == 0


@pytest.mark.parametrize("max_hashes", [0, 1000])
def test_decontamination_by_join_of_a_window_that_all_have(spark, max_hashes):
    hot, own = prose(1, 12), prose(2, 30)
    rows = [(i, f"{prose(100 + i, i % 40)} {hot} {prose(200 + i, 9)}") for i in range(120)] + [(500, own), (501, " ".join(own.split()[5:14]))]
    items = [(1, hot), (2, hot + " more"), (3, own), (4, "w1 w2")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.scan_by_join(docs_of(spark, rows).repartition(4), bench, max_hashes=max_hashes).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == sorted(brute_hits(rows, items))


def test_decontamination_counts_bytes_before_it_collects(spark):
    bench = spark.createDataFrame([(1, "... " * 5000), (2, "one two three")], "item_id bigint, text string")
    words, size = decontamination.index_size(bench)
    assert words < 10 and size > 20_000
    rows = [(1, "so one two three"), (2, None)]
    by = [sorted((r.doc_id, r.n_hit, r["items"]) for r in decontamination.scan(docs_of(spark, rows), bench, max_index_bytes=limit).collect()) for limit in (1 << 20, 1000)]
    assert by[0] == by[1] == [(1, 3, ["2"]), (2, 0, [])]


def test_decontamination_removes_spans_or_documents(spark):
    test = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = spark.createDataFrame([(1, test)], "item_id bigint, text string")
    df = docs_of(spark, [(1, f"Keep, {test.title()}! é rest"), (2, "clean"), (3, None)])
    assert {r.doc_id: r.text for r in decontamination.clean(df, bench, "spans").collect()} == {1: "Keep, ! é rest", 2: "clean", 3: None}
    assert {r.doc_id for r in decontamination.clean(df, bench).collect()} == {2, 3}


# ---- 7: Jaccard join ----


def test_jaccard_buckets_that_are_nearly_equal_are_not_expanded_again():
    """Of 1,500 near copies each pair is met once, in little more cells than there are pairs."""
    r, n, cells, met = random.Random(1), 1500, 0, set()
    base = [f"w{r.randrange(5000)}" for _ in range(300)]
    texts = [" ".join(f"x{r.randrange(10**6)}" if k in changed else w for k, w in enumerate(base)) for changed in (r.sample(range(300), r.randrange(7)) for _ in range(n))]
    sigs = np.array([jaccard_join.minhash(jaccard_join.shingles(t.encode())) for t in texts])
    keys = jaccard_join.band_keys(sigs)
    for band in range(jaccard_join.BANDS):
        for value in np.unique(keys[:, band]):
            some = np.flatnonzero(keys[:, band] == value)
            for a, b in jaccard_join.apart(keys[some, :band], np.arange(len(some)), None):
                cells += len(a) * (len(a) - 1) // 2 if b is None else len(a) * len(b)
            for i, j in jaccard_join.alive(band, True, [0] * len(some), sigs[some]):
                pairs = np.unique(np.sort(np.stack([some[i], some[j]]), 0), axis=1).T
                assert len(pairs) == len(i)
                met.update(x * n + y for x, y in pairs.tolist())
    assert len(met) > 0.99 * n * (n - 1) / 2 and cells < 2 * n * (n - 1) / 2


def test_jaccard_sql_equals_brute_force(spark):
    rows = [(i, t) for i, t in near_group(3, prose(5, 70), 30, 4, 0)] + [(90, "a b c"), (91, "A b, c"), (92, None), (93, "!"), (94, "a b c d e"), (95, prose(8, 500))]
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.sql(oracles.JACCARD_JOIN).fetchall())
    assert [(d, c, n) for d, _, c, n in want] == sorted(brute_links(rows))
    assert sorted(tuple(r) for r in jaccard_join.join(docs_of(spark, rows)).select("doc_id", "copy_id", "class_id", "n_links").collect()) == want


def near_group(seed, base, n, edits, start):
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = base.split()
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append((start + i, " ".join(w)))
    return out


@pytest.mark.parametrize("chunk", [2048, 7])
def test_jaccard_join_equals_brute_force(spark, chunk):
    rows = near_group(1, prose(1, 120), 60, 5, 0) + near_group(2, prose(2, 60), 20, 2, 100) + [(200 + i, prose(50 + i, 80)) for i in range(20)]
    rows += [(300, "a b c"), (301, "A, b. C"), (302, None), (303, ""), (304, "..."), (305, "a b c d e"), (None, "a b c d e"), (None, "z y x"), (0, rows[0][1]), (0, rows[0][1]), (306, prose(9, 20_000)), (307, prose(9, 20_000) + " end")]
    random.Random(4).shuffle(rows)
    got = jaccard_join.join(docs_of(spark, rows).withColumn("KEY", F.lit("k")), chunk)
    if chunk == 7:  # and groups of verification of a few sets each
        small = jaccard_join.classes(docs_of(spark, rows), chunk, 8_000).select("n_links", "first.doc_id").where("doc_id IS NOT NULL")
        assert sorted(map(str, small.collect())) == sorted(map(str, jaccard_join.classes(docs_of(spark, rows)).select("n_links", "first.doc_id").where("doc_id IS NOT NULL").collect()))
    assert sorted(map(str, ((r.doc_id, r.class_id, r.n_links) for r in got.collect()))) == sorted(map(str, brute_links(rows)))


def test_one_of_each(spark):
    base = prose(1, 100)
    rows = [(5, base), (3, base + " x"), (3, base + " x"), (None, base), (9, prose(3, 50)), (7, None), (8, ""), (None, "p q r")]
    got = jaccard_join.one_of_each(docs_of(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["3", "7", "8", "9", "None"]
    assert jaccard_join.join(docs_of(spark, [])).count() == 0 and jaccard_join.one_of_each(docs_of(spark, [])).count() == 0


def test_bayesian_bounds_rise_and_keep_true_pairs():
    need = jaccard_join.least_matches()
    assert list(need) == list(range(jaccard_join.STEP, jaccard_join.HASHES + 1, jaccard_join.STEP))
    assert all(a < b for a, b in zip(need.values(), list(need.values())[1:], strict=False))
    r = np.random.default_rng(0)
    for n, m in need.items():  # a pair at the threshold falls under the bound about as often as tolerated
        assert (r.binomial(n, jaccard_join.THRESHOLD, 200_000) < m).mean() < 1e-4


def test_crossings_in_slabs(monkeypatch):
    monkeypatch.setattr(jaccard_join, "SLAB", 512)
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    got = jaccard_join._crossings(sets)
    assert all(got[a, b] == len(np.intersect1d(sets[a], sets[b])) for a in range(12) for b in range(12) if a != b)


# ---- 8: PII ----


def brute_base(t):
    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        out += [(m.start(), 2, m.end())] * (12 <= len(d) <= 19 and luhn(d))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_pii_base_equals_brute_force_and_stays(spark):
    r = random.Random(5)
    parts = ["a", "b.", "@", "-", "1", "2", "12", "255", "300", ".", "+", "(", ")", " ", "  ", "\n", "é", "😀", "a@b.co", "1.2.3.4", "4111 1111 1111 1111", "+1 (974) 555-3436", "_", "%", "4111111111111111", "00", "(555) 234-5678"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 40)))) for i in range(1500)]
    rows += [(9001, None), (9002, ""), (9003, "1" * 5000), (9004, "1.2.3.4"), (9004, "1.2.3.4"), (None, "a@b" + ".c" * 5000)]
    got = pii.find(docs_of(spark, rows).withColumn("BASE", F.lit(1))).select("doc_id", pii.listed("base").alias("b"), pii.listed("found").alias("f")).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for x in got:
        assert x.b == brute_base(texts[x.doc_id] or "")
        assert set(filter(None, x.b.split(","))) <= set(x.f.split(","))
    assert pii.find(docs_of(spark, [])).count() == 0


def test_pii_method_adds_secrets_and_redacts(spark):
    secret = "0123456789abcdef0123456789abcdef01234567"
    rows = [(i, f'x{i} token = "{hashlib.sha1(str(i).encode()).hexdigest()}" y') for i in range(40)] + [(100, f'key = "{secret}" mail a@b.com'), (101, "plain text 42"), (102, None)]
    df = docs_of(spark, rows)
    out = {r.doc_id: (r.f, r.t) for r in pii.find(df).select("doc_id", pii.listed("found").alias("f"), pii.redacted().alias("t")).collect()}
    assert out[100] == ("secret:7:47,email:54:61", 'key = "[SECRET]" mail [EMAIL]')
    assert out[101] == ("", "plain text 42") and out[102] == ("", None)


def test_pii_of_very_many_spans(spark):
    """A hundred thousand spans in one text, found and redacted in time that follows their number."""
    n = 100_000
    text = "\ufeffé " + "".join(f"a{i}@b.co 😀 " for i in range(n))
    began = time.time()
    r = pii.find(docs_of(spark, [(1, text)])).select("n_email", pii.listed("found").alias("f"), pii.redacted().alias("t")).first()
    assert r.n_email == n and r.f == brute_base(text) and r.t == "\ufeffé " + "[EMAIL] 😀 " * n
    assert time.time() - began < 60


def brute_added(rows):
    """Spans that the method adds: votes and features in Python, EM and the logistic fit by plain gradient steps."""
    got = [(c, tuple(c[v] for v in c if v.startswith("v_")), tuple(c[f] for f in c if f.startswith("f_"))) for c in rows]
    votes, kinds = np.array([v for _, v, _ in got]), np.array([c["f_kind"] for c, _, _ in got])
    p = np.clip(0.5 + votes.sum(1) / 10, 0.05, 0.95)
    for _ in range(60):
        new = np.empty(len(p))
        for kind in set(kinds.tolist()):
            at = np.flatnonzero(kinds == kind)
            like = np.array([p[at].sum() + 1, (1 - p[at]).sum() + 1])
            for k in at:
                odds = np.log(like[0] / like[1])
                for j in range(5):
                    same = at[votes[at, j] == votes[k, j]]
                    odds += np.log((p[same].sum() + 1) / (p[at].sum() + 3)) - np.log(((1 - p[same]).sum() + 1) / ((1 - p[at]).sum() + 3))
                new[k] = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        p = new
    levels = sorted({(j, f[j]) for _, _, f in got for j in range(len(f))})
    x = np.array([[1.0] + [float(f[j] == v) for j, v in levels] for _, _, f in got])
    w = np.zeros(x.shape[1])
    step = 1 / (np.linalg.norm(x, 2) ** 2 / 4 + 1)
    for _ in range(40_000):
        w += step * (x.T @ (p - 1 / (1 + np.exp(-x @ w))) - w)
    return [c for (c, _, _), z in zip(got, x @ w, strict=True) if z > 0]


def test_pii_added_spans_equal_a_fit_of_another_kind(spark):
    r = random.Random(8)
    rows = [(i, f"k{i} token = {hashlib.sha1(str(i).encode()).hexdigest()} x") for i in range(30)]
    rows += [(100 + i, f"page {r.randrange(10**15, 10**16)} and tel (555) 234-{1000 + i}, ssn 123-45-{6000 + i}") for i in range(30)]
    rows += [(200 + i, f"n {'%x' % r.getrandbits(140)} q 000-12-{3000 + i}") for i in range(20)]
    df = docs_of(spark, rows)
    names = {**{f"v_{k}": v for k, v in pii.LABELERS.items()}, **{f"f_{k}": v for k, v in pii.FEATURES.items()}}
    each = pii.candidates(df).select("doc_id", F.explode("_c").alias("c")).select("doc_id", "c.*", *[F.expr(v).cast("int").alias(k) for k, v in names.items()])
    each = [c.asDict() for c in each.collect()]
    want = {(c["doc_id"], c["start"], c["kind"], c["end"]) for c in each if c["ok"]} | {(c["doc_id"], c["start"], c["kind"], c["end"]) for c in brute_added(each)}
    got = {(x.doc_id, *s) for x in pii.find(df).collect() for s in x.found}
    assert got == want and any(k[2] > 3 for k in got) and len(got) < len(each)


def test_pii_em_recovers_reliabilities():
    r = np.random.default_rng(3)
    y = r.random(4000) < 0.5
    votes = np.stack([np.where(r.random(4000) < acc, np.where(y, 1, -1), np.where(y, -1, 1)) for acc in (0.95, 0.9, 0.8, 0.7, 0.6)], 1)
    p, reliability = pii.reliabilities(votes, np.zeros(4000, int), np.ones(4000))
    assert ((p > 0.5) == y).mean() > 0.95
    assert [round(reliability[0, k], 1) for k in pii.LABELERS] == pytest.approx([0.95, 0.9, 0.8, 0.7, 0.6], abs=0.07)


# ---- 9: licenses ----


def test_license_scan(spark):
    t = license_scan.TEMPLATES
    filler = prose(1, 500)
    rows = [(1, f"{filler}\n{t['GPL-3.0']}\n{filler}"), (2, t["MIT"].upper()), (3, f"x {t['Apache-2.0']} {t['CC-BY-NC-4.0']} {t['Apache-2.0']}"), (4, "licensed under the apache"), (5, None), (6, ""), (6, ""), (7, t["GPL-3.0"].replace("version 3", "version 9")), (8, (filler + " ") * 40 + t["MIT"]), (9, "   " + t["MIT"] + "  ")]
    quoted = {"a 'quoted' name\\#1": "the \"owner\'s\" words are five"}
    assert [x.license for x in license_scan.scan(docs_of(spark, [(1, "x The owner's words are five.")]), quoted).first().licenses] == ["a 'quoted' name\\"]
    got = {r.doc_id: [x.license for x in r.licenses] for r in license_scan.scan(docs_of(spark, rows).withColumn("LICENSES", F.lit(1))).collect()}
    assert got == {1: ["GPL-3.0"], 2: ["MIT"], 3: ["Apache-2.0", "CC-BY-NC-4.0"], 4: [], 5: [], 6: [], 7: ["GPL-3.0"], 8: ["MIT"], 9: ["MIT"]}
    assert license_scan.scan(docs_of(spark, [])).count() == 0
    assert license_scan.scan(docs_of(spark, rows), {}).where("size(licenses) > 0").count() == 0
    with pytest.raises(ValueError, match="words"):
        license_scan.scan(docs_of(spark, rows), {"x": "?! -"})


def test_license_query_knows_texts_headers_and_reworded_notices(spark, tmp_path):
    bank = license_bank.bank()
    text = lambda name: bank[f"{name}#text"]
    near = lambda t, every: " ".join("changed" if i % every == every - 1 else w for i, w in enumerate(t.split()))
    filler = prose(2, 120)
    cases = [
        ("This code is licensed under the MIT License.", "MIT"),
        ("Released under the terms of the MIT License.", "MIT"),
        ("Licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("Licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("Licensed under the GNU General Public License, version 9.", ""),
        ("Licensed under the Apache License 2.0", "Apache-2.0"),
        ("Available under MIT License terms or under the Apache License, Version 2.0", "Apache-2.0,MIT"),
        ("This project is MIT licensed.", "MIT"),
        ("MIT License", "MIT"),
        ("Licensed under MIT or Apache-2.0", "Apache-2.0,MIT"),
        ("The code is licensed under GPLv3.", "GPL-3.0"),
        ("// SPDX-License-Identifier: MIT", "MIT"),
        ("distributed under an MIT-style license", "MIT"),
        ("wir gehen mit ihnen zu isc und zlib", ""),
        ("the license of the driver was renewed under the rules", ""),
        (text("BSD-2-Clause"), "BSD-2-Clause"),
        (text("BSD-3-Clause"), "BSD-3-Clause"),
        (f"{text('BSD-2-Clause')} {filler * 5} {text('BSD-3-Clause')}", "BSD-2-Clause,BSD-3-Clause"),
        (f"{filler} {near(text('MIT'), 40)} {filler}", "MIT"),
        (near(text("MIT"), 8), ""),
        (near(text("Apache-2.0"), 60), "Apache-2.0"),
        (text("ISC"), "ISC"),
        (text("0BSD"), "0BSD"),
        (text("LGPL-3.0"), "LGPL-3.0"),
        (text("MPL-2.0"), "MPL-2.0"),
        (text("GPL-3.0"), "GPL-3.0"),
        (bank["AGPL-3.0#header1"], "AGPL-3.0"),
        (bank["GPL-2.0#header1"].replace("useful", "handy"), "GPL-2.0"),
        (bank["LGPL-2.1#header0"], "LGPL-2.1"),
        (None, ""),
    ]
    docs_of(spark, [(i, t) for i, (t, _) in enumerate(cases)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.licenses for r in queries.op9_license_scan(spark, str(tmp_path)).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {r[0]: r[2] for r in con.sql(queries.oracle_sql()["op9_license_scan"]).fetchall()} == got


def test_license_query_finds_nothing_without_bands(spark, data, monkeypatch):
    found = lambda: {r.doc_id: r.licenses for r in queries.op9_license_scan(spark, data).where("n_licenses > 0").collect()}
    assert len(found()) >= 3
    plain = license_scan._minima
    monkeypatch.setattr(license_scan, "_minima", lambda v, bits=7: plain(v, bits) if v == "s" else f"slice({v}, 1, 0)")
    assert found() == {}


def test_license_bands_retrieve_what_containment_finds(spark, tmp_path, monkeypatch):
    """Worn copies amid other words, in documents of many blocks, against SQL that looks at every window."""
    bank, r = license_bank.bank(), random.Random(11)
    names = [k for k in bank if "citation" not in k and k not in ("GPL-3.0#text", "GPL-2.0#text")]
    rows = []
    for i in range(60):
        t = bank[r.choice(names)].split()
        for _ in range(len(t) * r.randrange(4) // 100):
            t[r.randrange(len(t))] = "worn"
        rows.append((i, f"{prose(i, r.randrange(300))} {' '.join(t)} {prose(-i, r.randrange(300))}"))
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = {r[0]: r[2] for r in con.sql(queries.oracle_sql()["op9_license_scan"]).fetchall()}
    got = {r.doc_id: r.licenses for r in queries.op9_license_scan(spark, str(tmp_path)).collect()}
    assert sum(map(bool, want.values())) > 40 and sum(got[k] == v for k, v in want.items()) >= 0.98 * len(want)
    some = {k: bank[k] for k in ("MIT#text", "ISC#text", "Zlib#text", "MIT#citation3", "ISC#citation0")}
    spans = lambda: {r.doc_id: str(r.licenses) for r in license_scan.scan(docs_of(spark, rows), some).collect()}
    whole = spans()
    monkeypatch.setattr(license_scan, "MAX_SHINGLES", 50)  # the bank is carried in parts
    assert spans() == whole
    monkeypatch.setattr(license_scan, "_minima", lambda v, bits=7: v if v == "s" else f"slice({v}, 1, 0)")  # no bands, no candidates
    assert not any("Row" in v for v in spans().values())


def test_license_span(spark):
    text = license_bank.bank()["MIT#text"]
    words = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", f"{prose(1, 77)} {text} {prose(2, 400)}")
    got = license_scan.scan(docs_of(spark, [(1, " ".join(words))]), {"MIT": text}).first().licenses
    assert [(x.license, words[x.word : x.end]) for x in got] == [("MIT", re.findall(r"[0-9A-Za-z]+", text))]


def test_license_scan_of_four_notices_equals_its_sql(spark, data):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    got = license_scan.scan(spark.read.parquet(f"{data}/documents.parquet"))
    assert {r.doc_id: ",".join(x.license for x in r.licenses) for r in got.collect()} == {r[0]: r[2] for r in con.sql(oracles.license_scan()).fetchall()}


# ---- 10: quality rules ----


def test_statistics_equal_brute_force():
    r = random.Random(1)
    for k in range(800):
        s = "".join(r.choice(["a", "b ", " ", "\n", "\t", "é", "\xa0", "#", "<", "a b\n", "c d e f g h i j ", "\x0b", "\x1c"]) for _ in range(r.randint(0, 120)))
        assert quality_rules.statistics(s)[:5] == brute_statistics(s), repr(s)
    assert quality_rules.statistics(None)[:5] == (0, 0, 0, 0, 0)


def test_decision_list_on_held_out_rows():
    r = np.random.default_rng(0)
    n = 6000
    values = {k: r.random(n) for k in "abc"}
    low = (values["a"] > 0.8) & (values["b"] <= 0.5) | (values["c"] > 0.95)
    rules = quality_rules.learn({k: v[:4000] for k, v in values.items()}, low[:4000])
    hit = np.zeros(2000, bool)
    for rule in rules:
        hit |= rule.mask({k: v[4000:] for k, v in values.items()})
    assert (hit == low[4000:]).mean() > 0.97 and (hit & ~low[4000:]).sum() < 25
    assert quality_rules.learn({k: v[:0] for k, v in values.items()}, low[:0]) == []
    assert quality_rules.learn(values, np.zeros(n, bool)) == []


def test_quality_table(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs_of(spark, [(-1, None), (-2, ""), (-3, "word " * 60), (None, prose(1, 80)), (None, prose(1, 80))]).withColumn("Kept", F.lit("x"))
    got = {r.doc_id: r.kept for r in quality_rules.judge(rows, labels).collect()}
    assert got == {-1: False, -2: False, -3: False, None: True}
    judged = quality_rules.judge(docs, labels)
    assert judged.join(labels, "doc_id").where("quality = 1 and not kept and not base_failed").count() <= 2
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_rules.judge(docs, empty).where("kept = base_failed").count() == 0
    assert quality_rules.judge(docs_of(spark, []), labels).count() == 0
    odd = spark.createDataFrame([(None, 0), (1, None)], "doc_id bigint, quality int")
    assert quality_rules.fit(docs, odd) == []
