"""Anchors with many surroundings take the way by strings, with the same spans."""

import numpy as np
import pytest

from agrispark.llm import rindex
from test_llm import repeats_brute
from test_repeat_rows import results, text


def hot_texts():
    """A passage of 130 bytes in other words each time, which leaves its anchors many surroundings; copies, short and empty texts."""
    passage = text(130, 1)
    texts = [text(90 + 7 * k, 100 + k) + passage + text(80 + 5 * k, 300 + k) for k in range(60)]
    texts += [passage, passage[:100], passage[1:], texts[3], texts[3], "", None, text(99, 5), passage + passage, "ab" * 300, "ab" * 200 + passage[:110]]
    return texts


def expected(texts):
    return repeats_brute([t or "" for t in texts])


@pytest.mark.parametrize("least", [1, 8])
def test_hot_anchors_equal_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(rindex, "SAMPLED", 1)
    monkeypatch.setattr(rindex, "HOT", least)
    texts = hot_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(7)
    bits = rindex.hot_slots(docs.selectExpr("doc_id AS doc", "text"), rindex.LENGTH)
    assert 0 < bits.sum() < (10**6 if least == 1 else 60)
    assert [tuple(r)[1:] for r in sorted(results(docs).collect())] == expected(texts)


def test_no_sampled_document_is_fine(spark):
    docs = spark.createDataFrame([], "doc bigint, text string")
    assert not rindex.hot_slots(docs, 100).any()


def test_string_hashes_tell_strings_apart():
    data = np.random.default_rng(1).integers(97, 100, 5_000).astype(np.uint8)
    data[3_000:3_400] = data[:400]
    at = np.arange(len(data) - 39)
    a, b = rindex.string_hashes(data, at, 40, rows=300)
    strings = [data[k : k + 40].tobytes() for k in at]
    for h in (a, b):
        assert len(np.unique(h)) == len(set(strings)) and (h[:361] == h[3_000:3_361]).all()
