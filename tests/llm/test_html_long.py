"""HTML extraction: long and broken pages in linear time, empty tables, repeated rows and clashing columns."""

import time

import pytest

from agrispark.llm import html_extract

BROKEN = {
    "unmatched ends": "<b>" * 40_000 + "</i>" * 40_000, "behind a cell": "<i><table><td>" + "<b>" * 40_000 + "</i>" * 40_000, "open comments": "<!--" * 100_000,
    "headings in inline": "<b>" * 40_000 + "<h1></h1>" * 20_000, "no end": "<a " * 100_000, "declarations": "<!x" * 100_000, "quotes": '<a ">"' * 40_000, "comments then end": "<!--" * 50_000 + ">" * 50_000,
    "svg": "<svg>" * 40_000 + "</svg>", "scripts": "<script>" * 40_000, "deep": "<div>" * 40_000 + "x", "cdata": "<![CDATA[" * 50_000 + "x>", "iframes": "<iframe>" * 40_000,
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_pages_take_linear_time(name):
    began = time.perf_counter()
    html_extract.main_text(BROKEN[name] + "<p>text</p>", html_extract.Potentials(html_extract.Counter()))
    assert time.perf_counter() - began < 5


def test_text_after_broken_parts_is_kept():
    page = html_extract.parse("<p>one<!-- a > b --> two<!-- open > three</p><p>four <a href=\"x>y\">five</a></p><i><table><td>six</i> seven</table>")
    assert [t for _, t, _ in page.blocks] == ["one two three", "four five", "six seven"]


def test_empty_repeated_and_clashing(spark):
    schema = "page_id bigint, url string, html string"
    none = spark.createDataFrame([], schema)
    assert html_extract.extracted(none, html_extract.trained(none)).count() == 0
    rows = [(1, "u", "<article><p>Some words, here.</p></article>")] * 3 + [(None, None, "<article><p>Some words, here.</p></article>"), (2, "v", None)]
    pages = spark.createDataFrame(rows, schema).selectExpr("*", "'x' as text", "'y' as _id")
    got = html_extract.extracted(pages, html_extract.trained(pages))
    assert got.count() == 5 and {r.text for r in got.where("page_id = 1").collect()} == {"Some words, here."}
