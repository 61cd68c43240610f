import html
import random
import re

import pytest

from quarry.llm import dom, wrapper
from quarry.llm.queries import op6_html
from tests.conftest import SF_ORACLE

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header><div id="cookie-notice">We use cookies</div>
<div class="wrap"><div id="sidebar"><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div><div class="c7"><h1>%s</h1><p>%s &lt;b&gt; text &amp; more<br>line two
<p>Second <i>%s</i></p><blockquote>quote %s</blockquote><form><input name=q>Search</form><div class="comments"><p>reader says %s</p></div></div></div>
<div class="foot">Constant line</div><p>All rights reserved</p></body></html>"""


def page(i):
    return PAGE % tuple(f"{x} {i} words go here" for x in "abcde")


def text(i):
    return "\n".join([f"a {i} words go here", f"b {i} words go here <b> text & more line two", f"Second c {i} words go here", f"quote d {i} words go here"])


def test_slots_of_one_host_are_content_and_its_template_is_not(spark, monkeypatch):
    rows = [(i, f"http://h.example/{i}", page(i), "c") for i in range(8)] + [(9, "http://H.example/9", page(1), "c"), (10, "http://h.example/1", page(1), "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    want = {i: text(i) for i in range(8)} | {9: text(1), 10: text(1)}
    assert {r.page_id: r.text for r in wrapper.extract(df).collect()} == want
    monkeypatch.setattr(wrapper, "BROADCAST_BYTES", 0)  # the salted join
    assert {r.page_id: r.text for r in wrapper.extract(df).collect()} == want


def test_awkward_pages(spark):
    pages = [
        (1, None, None), (2, "x", ""), (3, "http://one.example/", "<p>solo page text"), (4, "http://z.example", "<<<>>><a b=\"<p>x"), (5, "http://z.example", "plain &amp; text"),
        (6, "http://deep.example", "<div>" * 3000 + "deep text" + "</div>" * 10), (7, "http://s.example", "<script>if (a<b) '</p>'</script><article><p>kept</article><footer>no"),
        (None, None, "<main>null id</main>"), (8, "http://copies.example", "<article><p>same</p></article>"), (9, "http://copies.example", "<article><p>same</p></article>"),
        (10, "http://copies.example", "<article><p>same</p></article>"), (10, "http://copies.example", "<article><p>same</p></article>"),
    ]
    df = spark.createDataFrame([(*p, "c", "c") for p in pages], "page_id long, url string, html string, template string, text string")
    got = {r.page_id: r.text for r in wrapper.extract(df).collect()}
    assert got[1] == got[2] == "" and got[3] == "solo page text" and got[5] == "plain & text" and got[6] == "deep text"
    assert got[7] == "kept" and got[None] == "null id" and got[8] == got[9] == got[10] == "same"
    assert wrapper.extract(df).count() == len(pages)
    assert wrapper.extract(df.limit(0)).count() == 0


def test_layout_names_do_not_part_the_main_text():
    def host(body):
        pages = [body % (i, i) for i in range(5)]
        template = wrapper._bare(wrapper.page_slots(pages[0])[1])
        for p in pages[1:]:
            wrapper.merge(template, wrapper._bare(wrapper.page_slots(p)[1]))
        return [wrapper.Wrapper(template).text(p) for p in pages]

    want = [f"story {i} goes on for some words" for i in range(5)]
    article, side = "<article><p>story %s goes on for some words</p></article>", '<div class="sidebar"><p>box %s</p></div>'
    for layout in ('class="content-sidebar-wrap"', 'class="has-sidebar"', 'class="with-nav"', 'id="no-header"'):
        assert host(f"<body><div {layout}>{article}{side}</div></body>") == want
        assert host(f"<body><div {layout}><div id=with-menu><main>{article[9:-10]}</main></div>{side}</div></body>") == want
        assert host(f"<body><div {layout}><div><p>story %s goes on for some words</p></div></div>{side}</body>") == want
    teaser = '<div class="related"><article><p>teaser %s</p></article></div>'
    assert host(f'<body><div class="has-sidebar">{article}{teaser}</div></body>') == want
    assert host(f"<body>{article}<div class=comments><p>{'so many words of a reader ' * 20}%s</p></div></body>") == want


def test_constant_boxes_inside_articles_are_template():
    def texts(pages):
        template = wrapper._bare(wrapper.page_slots(pages[0])[1])
        for p in pages[1:]:
            wrapper.merge(template, wrapper._bare(wrapper.page_slots(p)[1]))
        return [wrapper.Wrapper(template).text(p) for p in pages]

    one = '<body><article><h1>Title %s</h1><p>Story %s has <b>Note</b> words</p><div class="letter"><p>Sign up for <i>our</i> letter</p></div><p>Second part %s</p></article></body>'
    pages = [one % (i, i, i) for i in range(6)]
    want = [f"Title {i}\nStory {i} has Note words\nSecond part {i}" for i in range(6)]
    assert texts(pages) == want
    other = pages[0].replace("Sign up for <i>our</i> letter", "A paragraph of this page")
    assert texts([*pages, other])[-1] == "Title 0\nStory 0 has Note words\nA paragraph of this page\nSecond part 0"
    whole = "Title 0\nStory 0 has Note words\nSign up for our letter\nSecond part 0"
    assert texts([pages[0]]) == [whole] and texts([pages[0]] * 5) == [whole] * 5


def folded(pages):
    template = wrapper._bare(wrapper.page_slots(pages[0])[1])
    for p in pages[1:]:
        wrapper.merge(template, wrapper._bare(wrapper.page_slots(p)[1]))
    return template


BOXED = "<body><article><h1>Title %s</h1><p>Story %s</p><div class=box><p>%s</p></div></article></body>"


@pytest.mark.parametrize("partitions", [1, 8, 64])
@pytest.mark.parametrize("odd", ["first", "middle", "last"])
def test_the_order_of_pages_does_not_matter(spark, partitions, odd):
    pages = [BOXED % (i, i, "Sign up for our letter") for i in range(40)]
    pages.insert({"first": 0, "middle": 20, "last": 40}[odd], BOXED % ("x", "x", "A paragraph of this page"))
    rows = [(i, "http://h.example/", p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in wrapper.extract(df.repartition(partitions) if partitions > 1 else df).collect()}
    for i, p in enumerate(pages):
        own = "A paragraph of this page" in p
        assert "letter" not in got[i] and got[i].startswith("Title") and ("A paragraph" in got[i]) == own
    assert sum("A paragraph of this page" in t for t in got.values()) == 1


def test_votes_bound_the_counts_in_any_order():
    rng = random.Random(4)
    for _ in range(200):
        texts = [1] * rng.randint(0, 60) + [rng.randint(2, 9) for _ in range(rng.randint(0, 30))] + list(range(100, 100 + rng.randint(1, 30)))
        rng.shuffle(texts)
        parts = [wrapper.Slot("p") for _ in range(4)]
        for i, t in enumerate(texts):
            parts[i % 4].vote({t: 1}, 0)
        whole = wrapper.Slot("p")
        whole.pages = len(texts)
        for p in parts:
            whole.vote(p.votes, p.lost)
        true = {t: texts.count(t) for t in set(texts)}
        assert all(n <= true[t] <= n + whole.lost for t, n in whole.votes.items())
        assert all(n <= whole.lost for t, n in true.items() if t not in whole.votes)
        most = max(true.values())
        want = most >= max(wrapper.CONSTANT_PAGES, wrapper.CONSTANT_SHARE * len(texts))
        assert whole.constant() in (want, None)


def test_open_counts_are_settled_by_counting_again(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "VOTES", 1)
    boxes = ["Sign up for our letter"] * 81 + [f"own words {i}" for i in range(19)]
    other = ["Sign up for our letter"] * 79 + [f"own words {i}" for i in range(21)]
    rng = random.Random(8)
    rng.shuffle(boxes)
    rng.shuffle(other)
    rows = [(i, "http://most.example/", BOXED % (i, i, b)) for i, b in enumerate(boxes)] + [(1000 + i, "http://less.example/", BOXED % (i, i, b)) for i, b in enumerate(other)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert any(s.constant() is None for s in wrapper._all(folded([r[2] for r in rows[:100]])))
    for n in (1, 7):
        got = {r.page_id: r.text for r in wrapper.extract(df.repartition(n)).collect()}
        assert sum("letter" in t for i, t in got.items() if i < 1000) == 0
        assert sum("letter" in t for i, t in got.items() if i >= 1000) == 79
        assert sum("own words" in t for t in got.values()) == 40


def test_simple_tree_matching_is_the_largest_ordered_matching():
    def tree(x):
        s = wrapper.Slot(x[0])
        s.kids = [tree(k) for k in x[1:]]
        return s

    def plain(a, b):
        if a.sig != b.sig:
            return 0
        m = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
        for i, p in enumerate(a.kids):
            for j, q in enumerate(b.kids):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + plain(p, q))
        return 1 + m[-1][-1]

    a = tree(["r", ["a", ["x"], ["y"]], ["b"], ["c", ["x"]], ["a"]])
    b = tree(["r", ["b"], ["a", ["y"]], ["c", ["x"], ["z"]], ["a", ["x"]]])
    assert wrapper.match(a, b, {}) == plain(a, b) == 6


def test_merging_adds_up_and_keeps_order():
    one, two = (wrapper._bare(wrapper.page_slots(h)[1]) for h in ("<div><p>a<h2>x</h2></div>", "<div><nav>n</nav><p>b<p>c</div>"))
    wrapper.merge(one, two)
    div = one.kids[0]
    assert [k.sig for k in div.kids] == ["nav", "p", "h2"] and div.pages == 2 and div.kids[1].pages == 2
    assert wrapper.Slot.load(one.dump()).dump() == one.dump()


def test_entities_and_blocks():
    root = dom.parse("<div>a&nbsp;b <b>c</b>\n d<p>&lt;e&gt; &am f&#33;<br>g</div><!-- no --><img src=x>h")
    assert dom.blocks(root, lambda n: True) == ["a b c d", "<e> &am f! g", "h"]


def test_query_extracts_the_articles(spark):
    def reference(page):
        body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = [html.unescape(re.sub(r"<[^>]*>", " ", x)) for x in re.split(r"</?(?:p|h1)>", body)]
        return "\n".join(x for x in (re.sub(r"\s+", " ", p).strip() for p in parts) if x)

    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_ORACLE}/pages.parquet").collect()}
    rows = op6_html(spark, SF_ORACLE).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == reference(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text)
