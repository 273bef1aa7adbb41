"""The share of capitals is that of the whole text."""

from agrispark.llm import quality


def test_share_of_capitals_of_regular_text():
    for unit, want in (("Abc ", 3), ("\u00c4bc ", 3), ("aBcD", 5)):
        for times in (10, 2000, 4000):
            assert f"\0c{want}" in quality._bins(unit * times, (unit * times).split())
