"""Elements without a closing tag hide no more than themselves."""

import pytest

from agrispark.llm import html_extract

BODY = "<article><p>One text. It goes on.</p><p>Two</p></article>"


def blocks(source):
    return [text for _, text, _ in html_extract.parse(source).blocks]


@pytest.mark.parametrize("before", [
    "<svg a=1 />", "<svg>", "<iframe src=x />", "<iframe src=x>", "<button>", "<select>", "<nav><button></nav>", "<object>", "<canvas>",
    "<svg><path/><text>no</text></svg>", "<button><div>no</div></button>", "<noscript>no<p>no</noscript>", "<script>no</script>", "<iframe>no</iframe>",
])
@pytest.mark.parametrize("after", ["", "<svg>no</svg><iframe>no</iframe><button>no</button><select><option>no</select>"])
def test_article_stays(before, after):
    if before == "<iframe src=x>" and after:
        pytest.skip("raw text up to the next closing tag, as in browsers")
    assert blocks(f"<body>{before}{BODY}{after}</body>") == ["One text. It goes on.", "Two"]


def test_text_about_hidden_elements_is_one_block():
    assert blocks("<p>a <button><div>no</div></button> b <math><mi>x</mi><annotation>no</annotation></math> c</p>") == ["a b x c"]
