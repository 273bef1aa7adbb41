"""What stands in comments, sidebars, notices and forms goes with them; comments end as browsers end them; parsing is linear."""

import time
from collections import Counter

import pytest

from agrispark.llm import html_extract as H


@pytest.fixture(scope="module")
def learnt(spark):
    return H.trained(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


PAGES = {
    "<article><p>A one, two.</p><div class='comments'><p>Readers say so, and so. It is long.</p></div><p>B.</p></article>": "A one, two.\n\nB.",
    "<div><p>A one, two. Three.</p><p>Second, one.</p></div><section class='reader-comments'><ul><li><p>I like it, a lot. Really.</p></li></ul></section>": "A one, two. Three.\n\nSecond, one.",
    "<article><p>A one, two.</p><aside class='sidebar'><p>See also, this. And that.</p></aside></article>": "A one, two.",
    "<article><p>A one, two.</p><div class='notice'>We use, cookies. Yes we do.</div></article>": "A one, two.",
    "<article><p>A one, two.</p><form><p>Give us your mail, please. Now.</p><label>Mail</label></form></article>": "A one, two.",
    "<article><p>A one <span class='ad'>Buy now</span> two.</p><p hidden>no</p><p style='color:red; display: none'>no</p><p>C</p></article>": "A one two.\n\nC",
    "<article><p>A<datalist><option>x</option></datalist> b<video>no video</video>.</p></article>": "A b .",
    "<article><p>A</p><!--><p>B</p><!-- x --><p>C</p></article>": "A\n\nB\n\nC",
    "<article><p>A</p><!---><p>B</p><!--a--!><p>C</p><!-- > --><p>D</p></article>": "A\n\nB\n\nC\n\nD",
    "<article><p data-hidden='no' class=hidden-gem>A</p><p title='hidden'>B</p></article>": "A\n\nB",
}


@pytest.mark.parametrize("source", PAGES)
def test_regions_and_comments(learnt, source):
    for potentials in (learnt, H.Potentials(Counter())):
        assert H.main_text(f"<html><body>{source}</body></html>", potentials) == PAGES[source]


def test_a_word_for_boilerplate_beside_one_for_content(learnt):
    for name in ("story-header", "reader-story", "article-banner"):
        long = "A first paragraph, which is long, as those of articles are. It has more than one sentence, and commas, too. " * 3
        source = f"<html><body><div class='{name}'><p>{long}</p><p>{long}</p></div></body></html>"
        assert H.main_text(source, H.Potentials(Counter())) == H.main_text(source, learnt) == f"{long.strip()}\n\n{long.strip()}"
    assert H.hint_of("div", " class='post-comments'") == H.hint_of("div", " id=header") == "bad"


@pytest.mark.parametrize("source", ['<a "' * 40_000, "<li " * 60_000, '<a "' * 40_001 + ">", "<!--" * 40_000, "<!-->" * 40_000, "<p hidden " * 40_000, "<p hidden>x" * 40_000, "<span class=ad>x" * 40_000, "<p style='display:" * 40_000, "<!--" + "--!" * 60_000])
def test_linear_time(source):
    began = time.perf_counter()
    H.parse(source)
    assert time.perf_counter() - began < 3
