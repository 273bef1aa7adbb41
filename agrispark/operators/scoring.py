"""Embeddings and model scores as array expressions, and the fits that the products need."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrispark.functions.dates import in_season, resolve_season_bounds
from agrispark.registry import query


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda t, v: t + v.cast("double"))


def softmax(a: Column) -> Column:
    top = F.array_max(a)
    e = F.transform(a, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / total(e))


def argmax(a: Column) -> Column:
    return F.array_position(a, F.array_max(a)).cast("int") - 1


_LONG = "(SELECT vec_id, unnest(range(0, len(embedding))) AS i, unnest(embedding::DOUBLE[]) AS v FROM embeddings_)"


@query("masked_mean_pool", "embeddings_", sql=f"""SELECT grp, i, round(coalesce(avg(v) FILTER (kept), avg(v)), 5) AS pooled, round(avg(v), 5) AS whole
  FROM (SELECT vec_id // 12 AS grp, i, v, vec_id % 12 BETWEEN 3 AND 8 AND (vec_id // 12) % 4 <> 1 AS kept FROM {_LONG}) GROUP BY 1, 2""")
def q_masked_mean_pool(embeddings: DataFrame) -> DataFrame:
    """Twelve vectors are the steps of a group; the season keeps six of them, or none of some groups."""
    group = F.floor(F.col("vec_id") / 12)
    kept = F.pmod("vec_id", F.lit(12)).between(3, 8) & (group % 4 != 1)
    return masked_mean_pool(embeddings.withColumn("grp", group), kept)


def masked_mean_pool(steps: DataFrame, season: Column, within: Column | None = None) -> DataFrame:
    """Mean of the whole step vectors that a season mask keeps; where it keeps none, that of all steps (of the global mask ``within``)."""
    rows = steps.where(within if within is not None else F.lit(True)).select("grp", season.alias("kept"), F.posexplode("embedding").alias("i", "v"))
    v = F.col("v").cast("double")
    pooled = rows.groupBy("grp", "i").agg(F.avg(F.when(F.col("kept"), v)).alias("p"), F.avg(v).alias("w"))
    return pooled.select("grp", "i", F.round(F.coalesce("p", "w"), 5).alias("pooled"), F.round("w", 5).alias("whole"))


def head_weights(classes: int, dims: int) -> list[list[float]]:
    """Weights of a head that needs no training, as long as the vectors."""
    return [[((31 * c + 17 * i) % 11 - 5) / 10 for i in range(dims)] for c in range(classes)]


def dims_of(embeddings: DataFrame) -> int:
    return embeddings.select(F.max(F.size("embedding"))).first()[0] or 0


def logits(vector: str, weights: list[list[float]], bias: float) -> Column:
    """Vector by weights plus bias, one value a class; the weights are literals of the expression."""
    rows = F.array(*(F.array(*map(F.lit, w)) for w in weights))
    return F.transform(rows, lambda w: total(F.zip_with(w, vector, lambda a, b: a * b)) + bias)


_HEAD = f"""WITH z AS (SELECT vec_id, c, sum(v * ((31 * c + 17 * i) % 11 - 5) / 10e0) + 0.1e0 AS z FROM {_LONG}, range(0, 3) t(c) GROUP BY 1, 2)"""


@query("linear_head_score", "embeddings_", sql=f"{_HEAD} SELECT vec_id, CAST(arg_max(c, z) AS INTEGER) AS label, round(max(exp(z)) / sum(exp(z)), 5) AS prob FROM z GROUP BY vec_id")
def linear_head_score(embeddings: DataFrame, weights: list[list[float]] | None = None, bias: float = 0.1) -> DataFrame:
    """Class and probability of a linear head over whole vectors."""
    weights = weights or head_weights(3, dims_of(embeddings))
    p = embeddings.select("vec_id", logits("embedding", weights, bias).alias("z")).withColumn("p", softmax(F.col("z")))
    return p.select("vec_id", argmax(F.col("p")).alias("label"), F.round(F.array_max("p"), 5).alias("prob"))


@query("train_linear_head", "embeddings_")
def train_linear_head(embeddings: DataFrame, share: float = 0.2) -> DataFrame:
    """Class-balanced multinomial head fitted by Spark ML on what a hash of the id doesn't hold out, and its prediction for each row."""
    held = F.pmod(F.xxhash64("vec_id"), F.lit(1000)) < share * 1000
    rows = embeddings.withColumn("held_out", held)
    counts = rows.where("not held_out").groupBy("label").agg(F.count("*").alias("c"))
    data = rows.join(F.broadcast(counts), "label", "left").select("vec_id", "held_out", F.col("label").cast("double").alias("label"), (1 / F.col("c")).alias("w"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = LogisticRegression(weightCol="w", maxIter=20, regParam=0.01).fit(data.where("not held_out"))
    return model.transform(data).select("vec_id", "held_out", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


@query("quantise_embedding", "embeddings_", sql="""WITH s AS (SELECT vec_id, embedding::DOUBLE[] AS e, greatest((SELECT quantile_cont(abs(v), 0.99) FROM unnest(embedding::DOUBLE[]) u(v)) / 127, 1e-6) AS scale FROM embeddings_)
  SELECT vec_id, round(scale, 7) AS scale, string_agg(CAST(CAST(greatest(-127, least(127, round_even(round(v / scale, 9), 0))) + 128 AS INTEGER) AS VARCHAR), ',' ORDER BY i) AS codes
  FROM (SELECT vec_id, scale, unnest(range(0, len(e))) AS i, unnest(e) AS v FROM s) GROUP BY vec_id, scale""")
def quantise_embedding(embeddings: DataFrame) -> DataFrame:
    """Eight-bit values: the 99th percentile of magnitudes is 127 steps from the middle."""
    sizes = F.array_sort(F.transform("embedding", lambda v: F.abs(v.cast("double"))))
    at = (F.size(sizes) - 1) * 0.99
    low = F.floor(at).cast("int")
    p99 = F.get(sizes, low) + (at - low) * (F.coalesce(F.get(sizes, low + 1), F.get(sizes, low)) - F.get(sizes, low))
    s = embeddings.withColumn("step", F.greatest(p99 / 127, F.lit(1e-6)))
    codes = F.transform("embedding", lambda v: (F.greatest(F.lit(-127.0), F.least(F.lit(127.0), F.rint(F.round(v.cast("double") / F.col("step"), 9)))) + 128).cast("int"))
    return s.select("vec_id", F.round("step", 7).alias("scale"), F.array_join(codes.cast("array<string>"), ",").alias("codes"))


@query("pca_embeddings", "embeddings_")
def pca_embeddings(embeddings: DataFrame, k: int = 3, most: int = 400_000) -> DataFrame:
    """Principal components from about ``most`` rows at most (a fixed bound, by a threshold of a hash), every row projected and scaled to 0-1."""
    data = embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    share = min(1.0, most / max(1, data.count()))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(data.where(F.pmod(F.xxhash64("vec_id"), F.lit(2**30)) < int(share * 2**30)))
    p = model.transform(data).select("vec_id", vector_to_array("p").alias("p"))
    ends = p.agg(*(f(F.get("p", i)).alias(f"{n}{i}") for i in range(k) for n, f in (("a", F.min), ("b", F.max)))).first()
    return p.select("vec_id", *(F.round((F.get("p", i) - ends[f"a{i}"]) / max(ends[f"b{i}"] - ends[f"a{i}"], 1e-12), 4).alias(f"p{i}") for i in range(k)))


@query("embedding_histogram", "embeddings_", sql="""SELECT i, CAST(least(9, greatest(0, floor((v + 4) / 0.8e0))) AS BIGINT) AS bin, count(*) AS n FROM (SELECT unnest(range(0, len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings_) GROUP BY 1, 2""")
def embedding_histogram(embeddings: DataFrame, low: float = -4.0, high: float = 4.0, bins: int = 10) -> DataFrame:
    v = F.col("v").cast("double")
    at = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((v - low) / ((high - low) / bins))))
    return embeddings.select(F.posexplode("embedding").alias("i", "v")).groupBy("i", at.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


@query("season_prediction_records", "embeddings_", sql=f"""{_HEAD}, p AS (SELECT vec_id, CAST(arg_max(c, z) AS INTEGER) AS prediction FROM z GROUP BY vec_id)
  SELECT vec_id, label % 3 AS target, prediction, prediction <> 0 AS rejected, vec_id % 2 = 0 AS in_s1 FROM p JOIN embeddings_ USING (vec_id) WHERE vec_id % 11 > 1""")
def season_prediction_records(embeddings: DataFrame, least_weight: int = 1) -> DataFrame:
    """One record a row with enough weight: class by softmax over the head's scores, rejected by the cropland gate (class 0), season flags."""
    p = softmax(logits("embedding", head_weights(3, dims_of(embeddings)), 0.1))
    r = embeddings.where(F.col("vec_id") % 11 > least_weight).withColumn("prediction", argmax(p))
    day = F.when(F.col("vec_id") % 2 == 0, F.to_date(F.lit("2021-01-15"))).otherwise(F.to_date(F.lit("2021-07-15")))
    s1 = in_season(day, *resolve_season_bounds(day, (11, 1), (4, 30), 1))
    return r.select("vec_id", (F.col("label") % 3).alias("target"), "prediction", (F.col("prediction") != 0).alias("rejected"), s1.alias("in_s1"))


def fit_growths(x: np.ndarray, y: np.ndarray, base: float = 0.11, rounds: int = 60) -> np.ndarray:
    """Rows (a, b, c, r2, rmse) of a * exp(-((x - b) / c)^2 / 2) + base by damped least squares, for each row of ``x`` and ``y``.

    All series take their steps together; each has its own damping. A series whose step no longer changes it is done.
    """
    n = np.arange(len(y))
    p = np.stack([np.maximum(y.max(axis=1) - base, 1e-3), x[n, y.argmax(axis=1)], np.maximum(np.ptp(x, axis=1) / 4, 1e-3)], axis=1)
    error = lambda q, x, y: y - (q[:, :1] * np.exp(-0.5 * ((x - q[:, 1:2]) / q[:, 2:]) ** 2) + base)
    square = lambda r: (r[:, None] @ r[:, :, None])[:, 0, 0]
    damp = np.full(len(y), 1e-2)
    r = error(p, x, y)
    least = square(r)
    at = n  # series under way
    for _ in range(rounds):
        if not len(at):
            break
        xs, ys, ps = x[at], y[at], p[at]
        u = (xs - ps[:, 1:2]) / ps[:, 2:]
        g = np.exp(-0.5 * u * u)
        j = np.stack([g, ps[:, :1] * g * u / ps[:, 2:], ps[:, :1] * g * u * u / ps[:, 2:]], axis=2)
        t = j.transpose(0, 2, 1)
        h = t @ j
        i = np.arange(3)
        damped = h.copy()
        damped[:, i, i] += damp[at, None] * (h[:, i, i] + 1e-9)
        q = ps + np.linalg.solve(damped, t @ r[at][:, :, None])[:, :, 0]
        q[:, 2] = np.maximum(np.abs(q[:, 2]), 1e-3)
        s = error(q, xs, ys)
        size = square(s)
        better = size < least[at]
        good = at[better]
        p[good], r[good], least[good] = q[better], s[better], size[better]
        damp[at] = np.where(better, damp[at] * 0.5, damp[at] * 4)
        at = at[(q != ps).any(axis=1)]
    spread = ((y - y.mean(axis=1, keepdims=True)) ** 2).sum(axis=1)
    share = np.divide(least, spread, out=np.ones(len(y)), where=spread != 0)
    return np.column_stack([p, 1 - share, np.sqrt((r * r).mean(axis=1))])


def fit_growth(x: np.ndarray, y: np.ndarray, base: float = 0.11, rounds: int = 60) -> tuple[float, float, float, float, float]:
    """``fit_growths`` of one series."""
    return tuple(fit_growths(x[None], y[None], base, rounds)[0].tolist())


@query("gaussian_growth_fit", "obs")
def gaussian_growth_fit(obs: DataFrame, least: int = 20) -> DataFrame:
    """Growth curve of each sample with enough observations. A series is one row: its length is bounded by its dates.

    The series of a batch of rows that are equally long are fitted together.
    """

    def fit(batches):
        for batch in batches:
            first, v = batch.column("day"), batch.column("v")
            sizes = np.diff(first.offsets.to_numpy())
            starts = first.offsets.to_numpy()[:-1]
            # of the whole child arrays, as offsets count from their beginning
            days, values = (c.values.to_numpy(zero_copy_only=False).astype(float) for c in (first, v))
            out = np.empty((len(sizes), 5))
            for n in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == n)
                cells = starts[rows, None] + np.arange(n)
                out[rows] = fit_growths(days[cells], values[cells])
            yield pa.RecordBatch.from_arrays([batch.column("sample_id"), pa.array(sizes.astype(np.int64)), *(pa.array(c) for c in out.T)], names=["sample_id", "n", "a", "b", "c", "r2", "rmse"])

    series = obs.select("sample_id", F.datediff("ts", F.to_date(F.lit("1995-01-01"))).alias("day"), (F.col("b04") / 4000).alias("v"))
    rows = series.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("day", "v"))).alias("s")).where(F.size("s") >= least)
    return rows.select("sample_id", "s.day", "s.v").mapInArrow(fit, "sample_id string, n long, a double, b double, c double, r2 double, rmse double")


@query("yield_forecast", "obs", sql="""WITH k AS (SELECT sample_id, month(ts) AS m, avg(b02) AS a, avg(b04) AS b FROM obs GROUP BY 1, 2), f AS (SELECT sample_id, m, round(0.5e0 * a + 0.01e0 * b + 2, 5) AS y FROM k)
  SELECT sample_id, arg_max(y, m) AS forecast FROM f GROUP BY sample_id""")
def yield_forecast(obs: DataFrame, coefficients=(0.5, 0.01, 2.0)) -> DataFrame:
    """Mean signals by sample and month, a linear forecast, and the last month's."""
    a, b, c = coefficients
    k = obs.groupBy("sample_id", F.month("ts").alias("m")).agg(F.avg("b02").alias("a"), F.avg("b04").alias("b"))
    f = k.withColumn("y", F.round(a * F.col("a") + b * F.col("b") + c, 5))
    return f.groupBy("sample_id").agg(F.max_by("y", "m").alias("forecast"))
