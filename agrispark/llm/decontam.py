"""Benchmark decontamination in DataFrame operations: SimHash windows, Hamming blocks, exact weighted shingles.

Texts are words of letters and digits in lower case; a window of a document has as many words as the item it is
tested against. Windows are placed where a document's shingles meet an item's shingles, at the offset that lines them
up, if the weight met there can reach the similarity asked; elsewhere no window is as similar. Each window's SimHash
(64 bits, weighted) is looked up among the items of its size in a multi-index of ``BLOCKS`` blocks: two fingerprints
within ``RADIUS`` bits agree to within ``RADIUS // BLOCKS`` bits in some block; half of these bits are spent on the
side of the items, which are entered under all such neighbours, half on that of the windows. Of unrelated
fingerprints one in seven meets in some block, and fewer than one in a thousand lies within the radius; windows of a
similarity of 0.8 differ from their item in about 10 bits, so 19 loses about one in a thousand of them. What the
index yields is confirmed by the exact weighted Jaccard similarity of the shingle bags.

The weight of a shingle is ln(1 + items / items that hold it), as a whole number of thousandths, so sums don't
depend on order.

Edge cases: null texts count as empty; documents or items of fewer than ``SHINGLE`` words match nothing; equal rows
count once; several texts under one id are judged one by one, and the id has the best of them; rows without an id are
found like others, under a null id; items that repeat count once, an item without an id is reported as null; only
the named columns are read; several windows of a pair give the best one.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrispark.llm.common import row_key, table, written

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 4
#: Item tables of at most so many shingles are broadcast (six numbers, about 80 bytes a row: 20 MB); larger ones are joined by shuffle.
MOST_BROADCAST = 250_000


def with_shingles(rows: DataFrame, text_col: str, k: int = SHINGLE) -> DataFrame:
    """``rows`` without the text, with ``sh``: the 64-bit hashes of its k-word shingles, in order.

    The word hashes are bound once by a lambda over an array of one, so no rewrite of the plan repeats them.
    """
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    words = F.split(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")), " ")

    def run(h: Column) -> Column:
        starts = F.when(F.size(h) >= k, F.sequence(F.lit(0), F.size(h) - k)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(k))))

    made = F.get(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), run), 0)
    return rows.withColumn("sh", made).drop(text_col)


def simhash(bag: str) -> Column:
    """The 64-bit weighted SimHash of an array column of (s, c, w)."""
    total = f"aggregate({bag}, 0L, (acc, x) -> acc + x.c * x.w * (2 * (shiftrightunsigned(x.s, b) & 1L) - 1))"
    return F.expr(f"aggregate(transform(sequence(0, 63), b -> if({total} > 0, shiftleft(1L, b), 0L)), 0L, (acc, v) -> acc | v)")


def in_blocks(prints: DataFrame, near: int, *others: str) -> DataFrame:
    """``(n, block, value, fp, others)``: each block of a fingerprint under all values within ``near`` bits of it."""
    width = 64 // BLOCKS
    mask = F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda m: F.bit_count(m) <= near)
    block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    return prints.select("n", "fp", *others, block.alias("block")).select(
        "n", "block", F.explode(mask).alias("mask"), "fp", *others
    ).select("n", "block", F.expr(f"(shiftrightunsigned(fp, block * {width}) & {(1 << width) - 1}L) ^ mask").alias("value"), "fp", *others)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    k: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(id, item_id, similarity, start, n_words, distance)``: the best window of each document and item that leak."""
    def with_key(rows: DataFrame) -> DataFrame:
        return rows.select(F.xxhash64(F.col("id").isNull(), "id", "t").alias("row"), "id", "t")

    bench = with_key(benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("t"))).dropDuplicates(["row"])
    shingles = written(
        with_shingles(bench, "t", k).select(F.col("row").alias("i"), F.col("id").alias("item"), F.size("sh").alias("n"), F.posexplode("sh").alias("at", "s")),
        "shingles",
    )
    many = shingles.agg(F.count("*").alias("rows"), F.countDistinct("i").alias("n")).first()
    weights = shingles.groupBy("s").agg(
        F.round(1000 * F.log1p(F.lit(float(many["n"])) / F.countDistinct("i"))).cast("long").alias("w")
    )
    shingles = written(shingles.join(weights, "s"), "shingles")
    items = written(
        shingles.groupBy("i", "item", "n", "s", "w").agg(F.count("*").alias("c"))
        .groupBy("i", "item", "n")
        .agg(F.sum(F.col("c") * F.col("w")).alias("total"), F.max("c").alias("times"), F.collect_list(F.struct("s", "c", "w")).alias("bag"))
        .withColumn("fp", simhash("bag")),
        "items",
    )

    # a window as similar as asked holds at least that share of the item's weight, repeats counted
    entries = shingles.join(items.select("i", (similarity * F.col("total") / F.col("times")).alias("least")), "i").select("s", "i", "n", "at", "w", "least")
    rows = with_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")))
    places = written(
        with_shingles(rows.select("row", "t"), "t", k).select("row", F.posexplode("sh").alias("pos", "s"))
        .join(F.broadcast(entries) if many["rows"] <= MOST_BROADCAST else entries, "s")
        .groupBy("row", "i", "n", "least", "s", "w")
        .agg(F.collect_set(F.col("pos") - F.col("at")).alias("starts"))
        .groupBy("row", "i", "n", "least")
        .agg(F.sum("w").alias("met"), F.flatten(F.collect_list("starts")).alias("starts"))
        .where("met >= least")
        .select("row", F.explode(F.transform(F.array_distinct("starts"), lambda x: F.struct(F.col("n"), x.alias("start")))).alias("place"))
        .groupBy("row").agg(F.collect_set("place").alias("places")),
        "places",
    )
    whole = F.expr("slice(sh, greatest(0, place.start) + 1, place.n + least(0, place.start))")
    unknown = round(1000 * math.log1p(max(1, many["n"])))
    windows = written(
        with_shingles(rows.join(places, "row").dropDuplicates(["row"]), "t", k)
        .select("row", "id", "sh", F.explode("places").alias("place"))
        .select("row", "id", "place.n", "place.start", F.explode(whole).alias("s"))
        .groupBy("row", "id", "n", "start", "s").agg(F.count("*").alias("c"))
        .join(shingles.select("s", "w").distinct(), "s", "left").withColumn("w", F.coalesce("w", F.lit(unknown)).cast("long"))
        .groupBy("row", "id", "n", "start")
        .agg(F.sum(F.col("c") * F.col("w")).alias("wtotal"), F.collect_list(F.struct("s", "c", "w")).alias("bag"))
        .withColumn("fp", simhash("bag")),
        "windows",
    )
    half = radius // BLOCKS // 2
    index = in_blocks(items, radius // BLOCKS - half, "i").withColumnRenamed("fp", "ifp")
    near = written(
        in_blocks(windows.select("n", "fp").distinct(), half).join(index, ["n", "block", "value"])
        .select("n", "fp", "i", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))).alias("distance"))
        .where(F.col("distance") <= radius).distinct(),
        "near",
    )
    key = ["row", "id", "n", "start", "wtotal", "i", "distance"]
    both = (
        windows.join(near, ["n", "fp"]).select(*key, F.explode("bag").alias("x")).select(*key, "x.s", "x.c", "x.w")
        .join(items.select("i", "item", "total", F.explode("bag").alias("y")).select("i", "item", "total", F.col("y.s").alias("s"), F.col("y.c").alias("ic")), ["i", "s"])
        .groupBy(*key, "item", "total").agg(F.sum(F.least("c", "ic") * F.col("w")).alias("inter"))
        .withColumn("similarity", F.col("inter") / (F.col("wtotal") + F.col("total") - F.col("inter")))
        .where(F.col("similarity") >= similarity)
    )
    best = F.max(F.struct("similarity", (-F.greatest(F.lit(0), F.col("start"))).alias("back"), "n", "distance")).alias("b")
    return (
        both.groupBy("id", "item").agg(best)
        .select(
            F.col("id").alias(id_col), F.col("item").alias("item_id"), F.col("b.similarity").alias("similarity"),
            (-F.col("b.back")).cast("long").alias("start"), (F.col("b.n") + k - 1).cast("long").alias("n_words"),
            F.col("b.distance").cast("long").alias("distance"),
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, with their own columns; each row is judged alone, whatever its id."""
    mark = "_" + uuid.uuid4().hex
    keyed = docs.withColumn(mark, row_key(docs))
    leaks = contaminated(keyed, benchmark, id_col=mark, text_col=text_col).select(mark).distinct()
    return keyed.join(leaks, mark, "left_anti").select(*docs.columns)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))
