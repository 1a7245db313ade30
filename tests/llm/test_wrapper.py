import html
import re
import time

import pytest
from hirelens.llm import wrapper

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body><header class=top><h1>My site</h1></header><nav><ul><li><a href="/{n}">Link {n}</a></li></ul></nav>
<div id="cookie-notice">We use cookies {n}</div>{open}<h1>Head &amp; {n}</h1><p>First&nbsp;para
  graph {n}<p>Second <b>bold {n}</b><br>line<div class="share"><p>Share {n}</p></div><p>About this magazine</p>
<aside>Side {n}</aside><form><input value=x>Sign {n}</form><!-- <p>no</p> -->{close}
<section class="comments"><p>Reader says {n}</p></section><footer>&copy; site {n}</footer></body></html>"""


def page(n, tag="article"):
    return PAGE.format(n=f"n{n}", open=f"<{tag}>", close=f"</{tag}>")


def texts(df, key="page_id"):
    return {r[key]: r["_text"] for r in wrapper.main_text(df, "url", "html").collect()}


def test_template_and_slots(spark):
    rows = [(i, f"https://Site.example.com/{i}", page(i)) for i in range(12)]
    rows += [(100 + i, f"http://u@plain.example.com:80/{i}", page(i, "div")) for i in range(12)]
    rows += [(200 + i, "https://few.example.com/", page(i)) for i in range(3)]
    found = texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    for i in range(12):
        want = f"Head & n{i}\nFirst para graph n{i}\nSecond bold n{i} line"
        assert found[i] == want  # what all pages say is template
        assert found[100 + i] == want  # also without an article element
    assert found[201] == "Head & n1\nFirst para graph n1\nSecond bold n1 line\nAbout this magazine"  # too few to tell


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, "https://a.example.com/", page(7)) for i in range(40)] + [
        (50 + i, "https://a.example.com/", page(i)) for i in range(3)
    ]
    found = texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert found[0].startswith("Head & n7\nFirst")


def test_odd_rows(spark):
    rows = [
        (1, None, None),
        (2, "no address", ""),
        (3, "https://x.example.com", "just text &lt;b&gt; &am"),
        (4, "https://x.example.com", "<p>un<b>closed <p>two<li>three</i> <"),
        (4, "https://x.example.com", "<p>un<b>closed <p>two<li>three</i> <"),
        (None, "https://x.example.com", "<article>broken off <a href='"),
        (5, "https://x.example.com", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (6, "https://x.example.com", "<p>long</p>" * 20_000),
        (7, "https://x.example.com", "<script>only code"),
    ]
    names = "page_id long, url string, html string, host string, wrapper string, nodes string"
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], names)
    got = wrapper.main_text(df, "url", "html").collect()
    assert len(got) == len(rows) and {(r["host"], r["wrapper"], r["nodes"]) for r in got} == {("x", "y", "z")}
    found = {r["page_id"]: r["_text"] for r in got}
    assert found[1] == found[2] == found[7] == ""
    assert found[3] == "just text <b> &am"
    assert found[4] == "unclosed\ntwo\nthree <"
    assert found[None] == "broken off"
    assert found[5] == "deep"
    assert found[6].count("long") == 20_000
    assert wrapper.main_text(df.limit(0), "url", "html").count() == 0


def test_given_pages(spark):
    """The given pages mark their article; its text is what is left without the markup."""
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    for r in wrapper.main_text(df, "url", "html").join(df, "page_id").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inside)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert r["_text"] == "\n".join(b for b in blocks if b)


def brute_force(a, b):
    """Simple tree matching by its recursive definition."""
    if a.label != b.label:
        return 0
    def best(i, j):
        if not i or not j:
            return 0
        x, y = a.children[i - 1], b.children[j - 1]
        return max(best(i - 1, j), best(i, j - 1), best(i - 1, j - 1) + brute_force(x, y))
    return 1 + best(len(a.children), len(b.children))


def test_tree_matching():
    sources = ["<ul><li>a<b>x</b><li>b</ul><p>c", "<p>c</p><ul><li>b<li><b>x</b><i>y</i></ul>", "<div><p>a<p>b</div><p>c"]
    trees = [wrapper.parse(s)[0] for s in sources]
    for a in trees:
        for b in trees:
            score, pairs = wrapper.aligned(a.children, b.children)
            assert score + 1 == brute_force(a, b)
            assert all(x.label == y.label for x, y in pairs)


def test_time_is_linear_in_the_page():
    took = []
    for n in (2000, 8000):
        source = "<div><p>a <b>b</i> &amp; c</span>" * n
        start = time.process_time()
        wrapper.page_blocks(source, wrapper.induce([page(1)]))
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] + 0.5


KEPT = [
    ('<body class="single has-sidebar"><div>Text here</div></body>', "Text here"),
    ('<div class="content with-header">Text</div>', "Text"),
    ('<div class="elementor-widget">Text</div>', "Text"),
    ('<article class="post tag-promotion">Text</article>', "Text"),
    ('<div class="entry-header"><h1>Head</h1></div><p>body</p>', "Head\nbody"),
    ("<div>long text in plain divs here and more</div><article>teaser</article>", "long text in plain divs here and more\nteaser"),
    ('<article><p>long article text</p><section class="reader-feedback">no</section></article>', "long article text"),
    ("<b>" * 300 + "<script>var x=1</script><nav>menu</nav>text" + "</b>" * 300, "text"),
    ('<div class="site-footer">x</div><div id="cookie-notice">y</div>z', "z"),
]


@pytest.mark.parametrize("page, text", KEPT)
def test_names_and_depth(page, text):
    assert "\n".join(b["text"] for b in wrapper.page_blocks(page, None)) == text


def unnamed_pages(n, paragraphs=4):
    """Pages without an article or telling names: a constant block in front, on one in ten pages another
    one behind, and text of their own between."""
    for i in range(n):
        own = [f"Page {i} says {j} times {i * j} things of its own." for j in range(paragraphs)]
        body = "<div><div class='x1'><p>Same words on all pages.</p></div><div class='x2'>"
        body += "".join(f"<p>{t}</p>" for t in own) + "</div>"
        body += "<div class='x3'><p>Rare words of some pages.</p></div>" if i % 10 == 3 else ""
        yield i, f"http://plain.example/{i}", f"<html><body>{body}</div></body></html>", "\n".join(own)


@pytest.mark.parametrize("n, paragraphs", [(80, 4), (7, 4), (12, 400)])
def test_pages_without_names(spark, n, paragraphs):
    """What all or some pages share goes, also beyond the wrapper's pages and nodes; without the counts over
    all pages it would stay. The plain version looks at every pair of path and text."""
    rows = list(unnamed_pages(n, paragraphs))
    df = spark.createDataFrame([r[:3] + ("user's",) for r in rows], "page_id long, url string, html string, _host string")
    got = wrapper.main_text(df.repartition(3), "url", "html")
    assert got.columns == ["page_id", "url", "_host", "_text"]
    rare = "\nRare words of some pages."
    few = sum(i % 10 == 3 for i in range(n)) < wrapper.SEEN  # too few pages to tell
    want = {i: own + (rare if few and i % 10 == 3 else "") for i, _, _, own in rows}
    assert {r["page_id"]: r["_text"] for r in got.collect()} == want
    alone = {i: "\n".join(b["text"] for b in wrapper.page_blocks(h, None)) for i, _, h, _ in rows}
    assert all(alone[i] != want[i] for i in want)


def test_all_pages_of_a_host_are_folded(spark):
    """A block that 12 of 412 pages have, whose first line is the same there. The line is not on nine of ten pages
    with that path, so only a wrapper that knows the block tells it from their own words."""
    def body(n, more=""):
        return f"<html><body><div><p>Own words of page {n}.</p></div>{more}</body></html>"

    rows = [(i, body(i)) for i in range(400)]
    rows += [(i, body(i, f"<section><p>Note to all readers.</p><p>More of page {i}.</p></section>")) for i in range(400, 412)]
    rows += [(i, body(i, f"<section><p>Only page {i}.</p></section>")) for i in range(412, 420)]
    df = spark.createDataFrame([(i, "http://late.example/", h) for i, h in rows], "page_id long, url string, html string")
    found = texts(df.coalesce(1))
    want = {i: f"Own words of page {i}." for i, _ in rows}
    want |= {i: f"{want[i]}\nMore of page {i}." for i in range(400, 412)}
    want |= {i: f"{want[i]}\nOnly page {i}." for i in range(412, 420)}
    assert found == want


def test_wrappers_of_parts_are_folded(spark):
    """Pages of a host that lie in several tasks give one wrapper, which has the labels of all of them."""
    pages = [(f"h{i % 2}", f"<div class='c{i}'><p>{i}</p></div><p>same</p>", i) for i in range(20)]
    df = spark.createDataFrame(pages, "host string, html string, tie long")

    def labels(slot):
        return {slot.label} | {label for child in slot.children for label in labels(child)}

    for rows in (df.repartition(5), df.coalesce(1)):
        got = {r.host: wrapper.from_json(r.wrapper) for r in wrapper.wrappers(rows).collect()}
        assert set(got) == {"h0", "h1"}
        for h, slot in got.items():
            assert labels(slot) == {"#page", "p"} | {f"div.c{i}" for i in range(20) if f"h{i % 2}" == h}
