"""Element index and selectors on literal pages."""

import time
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import rules
from hirelens.operators import extract, html


def pages(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "url int, html string")


def rows(df, order="url"):
    return [r.asDict() for r in df.orderBy(order).collect()]


def test_tree_of_unclosed_and_void_tags(spark):
    df = html.html_elements(pages(spark, "<p>a<br>b<p>c</i><div x='1'/>d"), ["url"])
    got = [
        (r["node"], r["parent"], r["tag"], r["text"], r["outer_html"]) for r in rows(df, "node")
    ]
    inner = '<p>c<div x="1"></div>d</p>'
    assert got == [
        (0, -1, "p", "abcd", f"<p>a<br/>b{inner}</p>"),
        (1, 0, "br", "", "<br/>"),
        (2, 0, "p", "cd", inner),
        (3, 2, "div", "", '<div x="1"></div>'),
    ]


def test_text_leaves_out_scripts_styles_and_comments(spark):
    page = "<div> a &amp; b <!-- no --><script>x<1</script><style>p{}</style> &eacute;&#146;&nope; </div>"
    (row,) = rows(html.html_elements(pages(spark, page), ["url"]).filter("tag = 'div'"))
    assert row["text"] == "a & bé’&nope"
    assert "<script>x<1</script>" in row["outer_html"] and "a &amp; b" in row["outer_html"]


def test_only_wanted_elements_come_back(spark):
    parsed = html.parse_pages(
        pages(spark, '<div><p class="a">x</p><p>y</p><li>z</li></div>', None),
        ["url"], tags=["p"], attrs=[], bare_tags=["li"],
    )
    got = rows(parsed.select("url", F.transform("elements", lambda e: e["tag"]).alias("tags"), "pieces"))
    assert got == [
        {"url": 0, "tags": ["p", "li"], "pieces": ["x", "y", "z"]},
        {"url": 1, "tags": None, "pieces": None},
    ]


def test_class_selectors(spark):
    page = '<p class="a  b">1</p><p class="b a">2</p><p class="ab">3</p><p id="a">4</p>'
    parsed = html.parse_pages(pages(spark, page), ["url"])

    def first(selector):
        return rows(extract.selector_cascade(parsed, "x", [selector], ["url"]))[0]["x_raw"]

    assert first(("p", "class", "b")) == "1"
    assert first(("p", "class", "b a")) == "2"
    assert first(("p", "class", "ab")) == "3"
    assert first(("p", "id", "a")) == "4"
    assert first(("p", "id", "b")) is None


def test_cascade_tries_only_the_first_element_of_a_selector(spark):
    page = '<i class="a"> </i><i class="a">no</i><b class="c">yes</b>'
    parsed = html.parse_pages(pages(spark, page, "<p>none</p>"), ["url"])
    selectors = [("i", "class", "a"), ("b", "class", "c")]
    assert rows(extract.selector_cascade(parsed, "f", selectors, ["url"])) == [
        {"url": 0, "f_raw": "yes", "f_status": "success", "f_method": 1},
        {"url": 1, "f_raw": None, "f_status": "not_found", "f_method": None},
    ]


def job(spark, *texts):
    return rows(extract.extract_job_pages(pages(spark, *texts)))


MARK = '<div class="show-more-less-html__markup">{}</div>'


def test_description_needs_more_than_fifty_characters(spark):
    fifty, more = "x" * 50, "x" * 51
    block = "<div>" + "y" * 200 + "</div><div>" + "z" * 201 + "</div><div>" + "w" * 201 + "</div>"
    got = job(spark, MARK.format(fifty), MARK.format(more), MARK.format(fifty) + block, None)
    assert [(r["description"], r["description_extract_method"], r["error"]) for r in got] == [
        (None, None, rules.DESCRIPTION_FAILED),
        (more, 0, None),
        ("z" * 201, -1, None),
        (None, None, rules.FETCH_FAILED),
    ]
    # markup counts its tags, so the short text still has its markup
    assert got[0]["description_html"] == MARK.format(fifty)


def test_criteria_a_later_duplicate_wins(spark):
    item = (
        '<li class="description__job-criteria-item"><h3 class="description__job-criteria-subheader">'
        '{}</h3><span class="description__job-criteria-text">{}</span></li>'
    )
    page = MARK.format("x" * 60) + item.format("Seniority level", "Mid") + item.format(
        " Seniority Level ", "Late"
    ) + item.format("Job function", "IT")
    (got,) = job(spark, page)
    assert got["page_metadata"] == {"seniority_level": "Late", "job_function": "IT"}
    assert (got["seniority_raw"], got["job_function_raw"], got["industry_raw"]) == ("Late", "IT", None)
    assert got["selector_hits"] == 3


def test_json_in_scripts(spark):
    ld = '<script type="application/ld+json">{}</script>'
    page = (
        MARK.format("x" * 60) + ld.format("{broken") + ld.format(' {"a": 1} ') + ld.format("{}")
        + '<script>x={"jobPosting":"}"}</script><script>no</script>'
        + '<script>f([{"baseSalary":[1]}],2)</script>'
    )
    (got,) = job(spark, page)
    assert got["embedded_json_ld"] == '{"a": 1}'
    assert got["embedded_job_json"] == '[{"baseSalary":[1]}]'
    assert got["selector_hits"] == 3


def test_insight_takes_the_first_element_even_if_empty(spark):
    page = MARK.format("x" * 60) + (
        '<section class="top-card-layout">no</section><div class="top-card-layout__entity-info"> </div>'
    )
    (got,) = job(spark, page)
    assert got["job_insight_section_raw_text"] == ""


def test_company_page(spark):
    page = (
        '<p class="break-words">too short</p><section data-test-id="about-us">We make things.</section>'
        "<dl><dt>Company size</dt><i>-</i><dd>10</dd><dt>Organization type</dt><dd>Inc</dd>"
        "<dt>Type</dt><dd>Ltd</dd><dt>Founded</dt></dl><dd>1999</dd>"
        '<div data-test-id="about-us__industry">Tools</div>'
    )
    got = rows(extract.extract_company_pages(pages(spark, page, None)))
    assert (got[0]["company_about_raw_text"], got[0]["company_about_method"]) == ("We make things.", 4)
    facts = {n: got[0][f"company_{n}_raw"] for _, n in rules.COMPANY_FACTS}
    assert facts == {
        "industry": "Tools", "size": "10", "headquarters": None, "type": "Ltd",
        "specialties": None, "founded": None, "website": None,
    }
    assert (got[1]["success"], got[1]["error"]) == (False, rules.FETCH_FAILED)


def test_cards(spark):
    card = (
        '<li><a class="base-card__full-link" href="http://j/{0}?t=1"></a>'
        '<h3 class="base-search-card__title"> T{0} </h3></li>'
    )
    got = rows(extract.cards_from_pages(pages(spark, card.format(1) + card.format(2) + "<li></li>"), ["url"]), "card")
    assert [(r["raw_title"], r["job_url"], r["company_url"]) for r in got] == [
        ("T1", "http://j/1", None), ("T2", "http://j/2", None), (None, None, None),
    ]


def _reading_time(page):
    reader = html._PageReader()
    start = time.process_time()
    reader.read(page)
    return time.process_time() - start


def test_reading_is_linear_in_unclosed_tags():
    small, large = (_reading_time("<p>a </i> " * n) for n in (4000, 16_000))
    assert large < 8 * small + 0.2


def test_descendants_and_followers_are_places(spark):
    page = "<dl id=x><dt>a<p>no</p><dd>1</dd><dt>b</dt><dt>c</dt><dd>2</dd><div><dd>in</dd></div></dl><dd>out</dd>"
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    parsed = html.parse_pages(pages, tags=["dl"], attrs=["id"], bare_tags=["dt", "dd"], followers={"dt": "dd"})
    kept = parsed.first()["elements"]
    assert [e["at"] for e in kept] == list(range(len(kept)))
    for e in kept:
        inside = [k["at"] for k in kept if e["ord"] < k["ord"] <= e["ord"] + (e["below"] and 99)]
        assert inside[: e["below"]] == list(range(e["at"] + 1, e["at"] + 1 + e["below"]))
        later = [k["at"] for k in kept if k["tag"] == "dd" and k["parent"] == e["parent"] and k["ord"] > e["ord"]]
        assert e["follower"] == (later[0] if later and e["tag"] == "dt" else -1)


class _Pages:
    """Stands for a table of pages; its ``mapInArrow`` gives the function that tasks would run."""

    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("html", T.StringType())])

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


def test_a_batch_of_pages_is_not_held_as_objects():
    page = "<div>" + "<i>word</i>" * 2000 + "</div>"
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([page] * 200)], ["page_id", "html"])
    run = html.parse_pages(_Pages(), ["page_id"], tags=["div"], attrs=[], bare_tags=["div"])
    tracemalloc.start()
    counts = [out.num_rows for out in run(iter([batch]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(counts) == 200 and most < 50_000_000  # all elements of 200 pages take some 200 MB
