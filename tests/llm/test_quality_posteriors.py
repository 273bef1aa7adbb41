"""The classifier against constant answers, and its posteriors against sums in plain Python."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from agrispark.llm import quality

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def decided(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    out = quality.classified(docs, labels.where(~held), F.col("source"), F.col("lang")).toPandas()
    truth = labels.where(held).selectExpr("doc_id AS _id", "quality AS q", "toxic AS t").toPandas()
    return out, out.merge(truth, on="_id")


def balanced(said, true):
    return sum((said[true == v] == v).mean() for v in (0, 1)) / 2


def test_both_tasks_beat_the_constant_answer(decided):
    _, both = decided
    for task, truth in (("quality", "q"), ("toxic", "t")):
        said, true = (both[task] >= 0.5).astype(int), both[truth].astype(int)
        constant = max(true.mean(), 1 - true.mean())
        print(task, (said == true).mean(), constant, balanced(said, true))
        assert (said == true).mean() > constant + 0.02
        assert balanced(said, true) > 0.75  # a constant answer has 0.5


def strength(groups):
    """Prior strength of groups (n, sum, mean) by the method of moments."""
    n = sum(g[0] for g in groups)
    m = [(k, s / k, mu) for k, s, mu in groups]
    spread = sum(k * (x - mu) ** 2 for k, x, mu in m) / n
    noise = sum(x * (1 - x) for _, x, _ in m) / n
    return max(1.0, sum(mu * (1 - mu) for *_, mu in m) / len(m) / max(spread - noise, 1e-6) - 1)


def logit(p):
    p = min(max(p, 1e-9), 1 - 1e-9)
    return math.log(p / (1 - p))


def posteriors(rows):
    """``(path posterior, posterior)`` of rows (host, path, p)."""
    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for h, p, x in rows:
        for d, k in ((hosts, h), (paths, (h, p))):
            d[k][0] += 1
            d[k][1] += x
    mu = (sum(x for *_, x in rows) + 0.5) / (len(rows) + 1)
    k_host = strength([(n, s, mu) for n, s in hosts.values()])
    at_host = {h: (s + k_host * mu) / (n + k_host) for h, (n, s) in hosts.items()}
    k = strength([(n, s, at_host[h]) for (h, _), (n, s) in paths.items()])
    out = []
    for h, p, x in rows:
        n, s = paths[h, p]
        others = (s - x + k * at_host[h]) / (n - 1 + k)
        out.append((others, 1 / (1 + math.exp(-(logit(x) + logit(others) - logit(mu))))))
    return out


def check(out, task):
    rows = list(zip(out["host"].fillna(""), out["path"].fillna(""), out[f"p_{task}"], strict=True))
    for (others, post), a, b in zip(posteriors(rows), out[f"path_{task}"], out[task], strict=True):
        assert math.isclose(others, a, rel_tol=1e-6) and math.isclose(post, b, rel_tol=1e-5, abs_tol=1e-9)


def test_posteriors_equal_plain_sums(decided):
    for task in quality.TASKS:
        check(decided[0], task)


def test_repeated_rows_null_sites_and_long_texts(spark):
    texts = ["good words here"] * 3 + ["bad " * 50_000, None, "", "good words here"]
    rows = [(k % 5, t, [None, "a", "b"][k % 3], [None, "x"][k % 2]) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").withColumn("keep", F.lit("clash")).withColumn("p_toxic", F.lit(0))
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(5)], "doc_id bigint, quality int, toxic int")
    out = quality.classified(docs, labels, F.col("source"), F.col("lang")).toPandas()
    assert len(out) == len(rows) and out[list(quality.TASKS)].notna().all().all()
    for task in quality.TASKS:
        check(out, task)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(rows)
    empty = docs.where("false")
    assert quality.keep_good(empty, labels).count() == 0 and quality.classified(empty, labels, F.col("source"), F.col("lang")).count() == 0
