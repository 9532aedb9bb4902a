import html
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylag.llm.extract import DIM, Features, Labeller, blocks_of, extract, plain, train, varied, weak_labels


def texts(page):
    return [b.text for b in blocks_of(page)]


@pytest.mark.parametrize("page, want", [
    (None, []), ("", []), ("  \n ", []), ("plain", ["plain"]),
    ("<p>one<p>two</p>three", ["one", "two", "three"]),
    ("<p>a <b>b</b>c<br>d\n\t e</p>", ["a bc d e"]),
    ("<p>x &amp; y &lt;z&gt; &#233;&eacute; &amp&nbsp;end &am", ["x & y <z> éé & end &am"]),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><p>yes<!-- <p>no</p> --> too", ["yes too"]),
    ("<SCRIPT>no</SCRIPT><P>yes", ["yes"]), ("<script>never closed <p>x", []), ("<!-- never closed <p>x", []),
    ("<p title='a > b'>in</p>", ["in"]), ("a < b <p>c", ["a < b", "c"]), ("<p", ["<p"]), ("</p></div>x", ["x"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"])])
def test_blocks(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page, want", [
    ("<p>a</p><svg/><p>rest</p>", ["a", "rest"]), ("<p>a<math /> b</p>c", ["a b", "c"]),
    ("<svg><path d='M0'/><circle></circle><text>no</text></svg>yes", ["yes"]), ("a<svg><svg>no</svg>no</svg>b", ["ab"]),
    ("<svg><script/><g>no</g></svg>yes", ["yes"]), ("<svg><title>no</title><p>breaks out", ["breaks out"]),
    ("<svg><foreignObject><p>no</p></foreignObject></svg>yes", ["yes"]),
    ("<video-player></video-player><p>a<canvas-chart>b</canvas-chart>", ["a", "b"]), ("<video>no<p>no</p></video>yes", ["yes"]),
    ("<div><button>no</div>yes", ["yes"]), ("<div>a<select><option>no<option>no</select>b</div>", ["ab"]), ("<button>no", []),
    ("<p title=it's>don't</p><p>and 'this'</p>", ["don't", "and 'this'"]), ("<p title=it's>only one", ["only one"]),
    ("<p a=\"b'c\" d='e\"f'>in</p>", ["in"]), ("<p title=a/>in", ["in"]), ("<p a = 'x>y' b>in", ["in"]), ("<a href=>in", ["in"]),
    ("<p =x \"y>in", ["in"]), ("<p title=\"x>never closed", ["never closed"]),
    ("a<!-->b<!--->c<!-- no --!>d<!---->e", ["abcde"]), ("a<!no>b<?no>c</>d</ no>e", ["abcde"]), ("a<![CDATA[no]]>b", ["ab"]),
    ("<script>'<!--'</script >yes<style></styles>no</style>too", ["yestoo"]), ("<textarea><p>no</textarea>yes", ["yes"]),
    ("1 <2 <é </é>x", ["1 <2 <é x"]), ("a </", ["a </"]), ("<h1\n>x</H1\t>y", ["x", "y"]), ("<b>a<p <b>c", ["a", "c"])])
def test_what_browsers_show(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page, blocks", [
    ("<a " * 350_000, 1), ("<div>x " * 100_000, 100_000), ("<div>" * 100_000 + "</p>" * 100_000 + "x", 1), ("<svg>" * 50_000 + "</math>" * 50_000, 0),
    ("<!---->x" * 100_000, 1), ("<p a='" * 100_000, 1), ("<" * 500_000, 1), ("<script>" * 100_000, 0), ("<!-- " * 200_000, 0),
    ("<div class='a b'><p>x</p>" * 50_000, 50_000)])
def test_malformed_pages_take_linear_time(page, blocks):
    start = time.process_time()
    found = plain(blocks_of(page))
    Features().of([found[:2000]])
    assert len(found) == blocks and weak_labels(found) is not None
    assert time.process_time() - start < 10


def test_deep_pages_are_extracted(spark):
    """Nested to 20,000 levels, beside plain pages; the article is found whole."""
    story = [f"Part {i} of a story, told at length, with words enough to be a paragraph of it." for i in range(30)]
    article = "<article>" + "".join(f"<p>{p}</p>" for p in story) + "</article>"
    rows = [(0, "<div>" * 20_000 + article), (1, f"<body><nav>menu</nav>{article}</body>")]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert got[1] == "\n".join(story) and got[0] in (got[1], "")


def test_paths_and_links():
    got = blocks_of('<body><nav class="top-menu"><a href=x>home</a></nav><article id=main><p>text</article><p>after')
    assert [b.path for b in got] == [("body", "nav", "top", "menu"), ("body", "article", "main", "p"), ("body", "p")]
    assert [b.linked for b in got] == [1, 0, 0]
    assert weak_labels(got) == [0, 1, 0]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    rows = [rng.standard_normal((n, DIM)) for n in (3, 5)]
    labels = [np.array([1.0, 0, 1]), np.array([0, 1.0, 1, 0, 0])]
    model = Labeller(1)

    def loss():
        x, turned, real = model._pad(rows)
        z = model._logits(x, turned)[0]
        return sum(np.log1p(np.exp(-z[: len(y), k] * (2 * y - 1))).sum() for k, y in enumerate(labels)) / real.sum()

    # one small step of plain descent along the fitted direction lowers the loss; many steps nearly end it
    before = loss()
    model.fit(list(zip(rows, labels)), steps=60)
    assert loss() < 0.05 * before


def test_a_page_does_not_depend_on_its_batch():
    rng = np.random.default_rng(2)
    rows = [rng.standard_normal((n, DIM)) for n in (7, 1, 600, 30, 2)] + [np.zeros((0, DIM))]
    model = Labeller(3)
    together = model.content(rows)
    for row, got in zip(rows, together):
        assert (model.content([row])[0] == got).all() and len(got) == len(row)


def reference(page):
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    parts = (" ".join(html.unescape(re.sub("<[^>]+>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", inner))
    return "\n".join(p for p in parts if p)


def test_query_gives_the_articles(spark, sf_dir):
    from skylag.llm.queries import QUERIES

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op1_html_extraction"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, reference(pages[r.page_id].html), len(r.text))


def test_other_layouts_are_mostly_right(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    model = train(pages)
    read = [blocks_of(r.html) for r in pages.orderBy("page_id").limit(200).collect()]
    words = [b.text for page in read for b in page]
    rng = random.Random(77)
    examples = [varied(page, weak_labels(page), words, rng) for page in read]
    kept = model.content(Features().of([b for b, _ in examples]))
    right = sum((np.array(y) == k).sum() for (_, y), k in zip(examples, kept))
    assert right >= 0.98 * sum(len(y) for _, y in examples)


def test_awkward_rows(spark, sf_dir):
    model = train(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    article = "<html><body><nav><a>menu</a></nav><article><h1>Head</h1>" + "<p>Some words of a story, told at length.</p>" * 3000 + "</article></body></html>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", article), (3, "u", article), (None, "u", article), (4, "u", "<p>"), (5, "u", "\u0000<p>x" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("own"), "path": F.lit("p")})
    got = extract(pages, model)
    assert got.columns == ["page_id", "url", "path", "text", "n_chars", "n_blocks"] and got.count() == 7
    by_id = {r.page_id: r for r in got.collect()}
    assert (by_id[1].text, by_id[1].n_chars, by_id[2].text, by_id[4].text) == ("", 0, "", "")
    assert by_id[3].text == by_id[None].text == "\n".join(["Head"] + ["Some words of a story, told at length."] * 3000)


def test_empty_table(spark):
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_or_repeated_pages_train_a_model(spark):
    """One page of over 60,000 characters and 400 blocks, and one page in thousands of rows beside a few others."""
    story = [f"Part {i} of a story, told at length, with words enough to be a paragraph of it." for i in range(1000)]

    def page(parts):
        return "<html><body><nav><a>menu</a></nav><article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article><footer>end of page</footer></body></html>"

    one = spark.createDataFrame([(1, page(story))], "page_id long, html string")
    assert len(one.first().html) > 60_000 and extract(one).first().text == "\n".join(story)
    few = [page(story[10 * k : 10 * k + 10]) for k in range(2)]
    many = spark.range(6000).select(F.col("id").alias("page_id"), F.when(F.col("id") < 1, few[1]).otherwise(few[0]).alias("html"))
    got = {r.text: r["count"] for r in extract(many).groupBy("text").count().collect()}
    assert got == {"\n".join(story[:10]): 5999, "\n".join(story[10:20]): 1}


PLAIN = "<html><head><title>Site</title></head><body><nav><a>menu</a></nav><div><article><h1>A head</h1><p>First part, told at length.</p><p>Second part.</p></article></div><div class='ad'>buy</div></body></html>"
MARKED = [
    PLAIN.replace("<body>", "<body class='has-sidebar search skin'>"), PLAIN.replace("<div><article>", "<div class='content no-comments'><article>"),
    PLAIN.replace("<h1>", "<h1 class='entry-title'>"), PLAIN.replace("<html>", "<html class='no-banner'>"),
    PLAIN.replace("<article>", "<article class='post has-share'>")]


@pytest.mark.parametrize("page", MARKED)
def test_words_on_wrappers_do_not_make_boilerplate(page):
    assert [b.text for b, y in zip(blocks_of(page), weak_labels(blocks_of(page))) if y] == ["A head", "First part, told at length.", "Second part."]


def test_a_listing_beside_the_article_is_not_content():
    page = PLAIN.replace("<div class='ad'>buy</div>", "<div class='related'><article>A card</article></div>")
    assert weak_labels(blocks_of(page)) == [0, 0, 1, 1, 1, 0]


def test_articles_under_marked_wrappers_are_given_whole(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    marked = pages.withColumn("html", F.regexp_replace(F.regexp_replace("html", "<body>", "<body class='has-sidebar search'>"), "<h1>", "<h1 class='entry-title'>"))
    want = {r.page_id: reference(r.html) for r in pages.collect()}
    got = extract(marked, train(pages)).collect()
    assert sum(r.text == want[r.page_id] for r in got) == len(want)
