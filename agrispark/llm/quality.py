"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic model of hashed words, word stems and binned shape features gives each document its own evidence. Sites
are then summed by grouped aggregation: the expected share of good (and of toxic) documents of a host is shrunk
toward the global share, that of a path toward its host's, each with a prior strength estimated from the spread of
the group means (method of moments), so sparse sites lean on what is above them. A document's posterior odds are
its own odds times the odds that its path, without itself, gives over the global ones.

Edge cases: null text counts as empty; null host or path is a group of its own; without labels of both classes the
model falls back to the smoothed label rate; repeated rows are scored alike and all count; extra columns pass
through ``keep_good`` untouched.
"""

from __future__ import annotations

import math
import string
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrispark.llm.common import mapped, row_key, table, written

BITS = 18
#: At most so many labelled documents, those of the smallest hash of their id, fit the document model.
MOST_LABELLED = 10_000
ROUNDS = 120
LEAST_DF = 4
PART = 250
TASKS = ("quality", "toxic")


CAPITALS, SMALL = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()


def _letters(text: str) -> tuple[int, int]:
    """Letters and capitals of the whole text."""
    if not text.isascii():
        return sum(map(str.isalpha, text)), sum(map(str.isupper, text))
    raw = text.encode()
    upper = len(raw) - len(raw.translate(None, CAPITALS))
    return upper + len(raw) - len(raw.translate(None, SMALL)), upper


def _bins(text: str, words: list[str]) -> list[str]:
    """Shape of the text as named bins: repetition, case, marks, lengths."""
    n = len(words)
    unique = len(set(words)) / n if n else 0.0
    letters, capitals = _letters(text)
    upper = capitals / (letters or 1)
    marks = sum(text.count(c) for c in "!|#*%$&@{}<>=_~^") / max(1, n)
    runs = sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, n)
    mean = sum(map(len, words)) / max(1, n)
    return [
        f"\0n{min(12, int(math.log2(n + 1)))}", f"\0u{int(10 * unique)}", f"\0c{int(10 * upper)}",
        f"\0m{min(20, int(10 * marks))}", f"\0r{int(10 * runs)}", f"\0w{min(20, int(mean))}",
    ]


def features(text: str) -> np.ndarray:
    """Sorted distinct feature slots of a text."""
    lower = text.lower()
    words = lower.split()
    kinds = set(words)
    kinds.update([f"\1{w[:5]}" for w in kinds if len(w) > 5])
    kinds.update([w.strip(".,;:!?\"'()") for w in list(kinds)])
    kinds.update(_bins(text, words))
    crc = zlib.crc32
    return np.unique(np.array([crc(w.encode()) for w in kinds], np.uint32) >> np.uint32(32 - BITS))


def fit(rows: list[np.ndarray], y: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Logistic weights (last: bias), each feature scaled by its class log ratio beyond that ratio's noise.

    The scaling lets a few telling words outweigh many chance ones; features of fewer than ``LEAST_DF`` rows get 0.
    Full-batch gradient with momentum, summed over parts of ``PART`` rows so that work arrays stay small. When a class
    is missing, the smoothed rate alone.
    """
    w = np.zeros((1 << BITS) + 1)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = math.log(rate / (1 - rate))
    if not len(y) or y.min() == y.max():
        return w
    held, good = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for r, label in zip(rows, y, strict=True):
        held[r] += 1
        good[r] += label
    used = np.flatnonzero(held >= LEAST_DF)
    if not len(used):
        return w
    pos, neg = good[used] + 0.5, held[used] - good[used] + 0.5
    ratio = np.abs(np.log(pos / (y.sum() + 1) / (neg / (len(y) - y.sum() + 1))))
    scale = np.maximum(0, ratio - 1 / np.sqrt(np.minimum(pos, neg)))
    cost = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    parts = []
    for k in range(0, len(rows), PART):
        own = [place[r] for r in rows[k : k + PART]]
        own = [p[p >= 0] for p in own]
        parts.append((slice(k, k + PART), np.concatenate(own), [len(p) for p in own]))
    v, b, step_v, step_b = np.zeros(len(used)), w[-1], np.zeros(len(used)), 0.0
    for _ in range(rounds):
        weighted, change, bias = v * scale, np.zeros(len(used)), 0.0
        for part, at, sizes in parts:
            z = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weighted[at], len(sizes)) + b
            e = cost[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part])
            change += np.bincount(at, np.repeat(e, sizes), len(used))
            bias += e.sum()
        step_v = 0.9 * step_v - 0.5 * (change * scale / len(rows) + 1e-5 * v)
        step_b = 0.9 * step_b - 0.05 * bias / len(rows)
        v, b = v + step_v, b + step_b
    w[used] = v * scale
    w[-1] = b
    return w


def trained(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, id_col="doc_id", text_col="text") -> np.ndarray:
    """Weights [2, slots + 1] from at most ``most`` labelled documents, a fixed bound."""
    chosen = (
        labels.where(" and ".join(f"{t} is not null" for t in TASKS))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(*(F.max(F.col(t).cast("int")).alias(t) for t in TASKS))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")

    def run(batch: pa.RecordBatch):
        rows = [features(t or "").tobytes() for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.binary()), *(batch.column(k) for k in (1, 2))], names=["f", *TASKS]
        )

    got = mapped(picked.select("text", *TASKS), run, "f binary, quality int, toxic int").orderBy(F.xxhash64("f")).limit(most).collect()
    rows = [np.frombuffer(r["f"], np.uint32) for r in got]
    return np.array([fit(rows, np.array([r[t] for r in got], float)) for t in TASKS])


def evidence(docs: DataFrame, weights: np.ndarray, id_col="doc_id", text_col="text", host: Column | None = None, path: Column | None = None) -> DataFrame:
    """``_id, host, path`` and each task's probability from the text alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batch: pa.RecordBatch):
        w = shared.value
        out = []
        for t in batch.column(1).to_pylist():
            f = features(t or "").astype(np.int64)
            z = w[:, f].sum(axis=1) + w[:, -1]
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30).astype(float))))
        p = np.array(out).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array(p[:, 0]), pa.array(p[:, 1])],
            names=["_id", "host", "path", *(f"p_{t}" for t in TASKS)],
        )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col), host.cast("string").alias("host"), path.cast("string").alias("path"))
    return mapped(rows, run, f"_id {kind}, host string, path string, p_quality double, p_toxic double")


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, n: str, total: str, mean: Column) -> Column:
    """Prior strength, as a number of documents, from the spread of group means about ``mean``."""
    m = F.col(total) / F.col(n)
    spread = F.sum(F.col(n) * (m - mean) ** 2) / F.sum(n)
    noise = F.sum(m * (1 - m)) / F.sum(n)
    return F.greatest(F.lit(1.0), F.avg(mean * (1 - mean)) / F.greatest(spread - noise, F.lit(1e-6)) - 1)


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, dict]:
    """One row per (host, path): its count, sums and the shrunk host share; and the global figures (one row)."""
    paths = scored.groupBy("host", "path").agg(
        F.count("*").alias("n_path"), *(F.sum(f"p_{t}").alias(f"s_path_{t}") for t in TASKS)
    )
    hosts = paths.groupBy(F.col("host").alias("_h")).agg(
        F.sum("n_path").alias("n_host"), *(F.sum(f"s_path_{t}").alias(f"s_host_{t}") for t in TASKS)
    )
    whole = hosts.agg(F.sum("n_host").alias("n"), *(F.sum(f"s_host_{t}").alias(t) for t in TASKS)).first()
    mu = {t: (whole[t] + 0.5) / (whole["n"] + 1) if whole["n"] else 0.5 for t in TASKS}
    at_host = hosts.agg(*(_strength(hosts, "n_host", f"s_host_{t}", F.lit(mu[t])).alias(t) for t in TASKS)).first()
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    for t in TASKS:
        k = at_host[t] or 1.0
        sites = sites.withColumn(f"host_{t}", (F.col(f"s_host_{t}") + k * mu[t]) / (F.col("n_host") + k))
    at_path = sites.agg(*(_strength(sites, "n_path", f"s_path_{t}", F.col(f"host_{t}")).alias(t) for t in TASKS)).first()
    return sites, {t: (mu[t], at_path[t] or 1.0) for t in TASKS}


def classified(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col="doc_id", text_col="text", most_labelled: int = MOST_LABELLED, key_col: str | None = None) -> DataFrame:
    """``_id`` (of ``key_col`` where given, else of ``id_col``, that labels name), site columns, evidence, posteriors ``quality`` and ``toxic``, and the decision ``keep``."""
    weights = trained(docs, labels, most_labelled, id_col, text_col)
    scored = written(evidence(docs, weights, key_col or id_col, text_col, host, path), "evidence")
    sites, figures = site_posteriors(scored)
    sites = written(sites.select("host", "path", "n_path", *(f"{x}_{t}" for t in TASKS for x in ("s_path", "host"))), "sites")
    out = scored.join(
        sites.withColumnsRenamed({"host": "_h", "path": "_p"}),
        F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")), "left",
    ).drop("_h", "_p")
    for t in TASKS:
        mu, k = figures[t]
        others = (F.col(f"s_path_{t}") - F.col(f"p_{t}") + k * F.col(f"host_{t}")) / (F.col("n_path") - 1 + k)
        z = _logit(F.col(f"p_{t}")) + _logit(others) - _logit(F.lit(mu))
        out = out.withColumn(f"path_{t}", others).withColumn(t, 1 / (1 + F.exp(-z)))
    return out.select(
        "_id", "host", "path", *(f"{x}_{t}" for t in TASKS for x in ("p", "host", "path")), *TASKS,
        ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("keep"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", host_col="source", path_col="lang") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their own columns; each row is judged alone, whatever its id."""
    mark = "_" + uuid.uuid4().hex
    keyed = docs.withColumn(mark, row_key(docs))
    decisions = classified(keyed, labels, F.col(host_col), F.col(path_col), id_col, text_col, key_col=mark)
    rejected = decisions.where(~F.col("keep")).select(F.col("_id").alias(mark)).distinct()
    return keyed.join(rejected, mark, "left_anti").select(*docs.columns)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return classified(docs, labels, F.col("source"), F.col("lang")).withColumnRenamed("_id", "doc_id")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))
