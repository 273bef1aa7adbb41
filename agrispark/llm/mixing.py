"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations only.

Words are dealt out in blocks of equal size. Sources get whole numbers of blocks by highest quotients
``target / (2k + 1)``; each source's blocks are then apportioned the same way over its shards, and within a
shard the quota is spread over the blocks by a seeded phase in integer arithmetic, so that every block is taken
``floor`` or ``ceil`` of quota / blocks times. A shard is a bounded share of a source's documents, dealt by a hash of id and
size, so a source with a third of all rows, or ids in strides, are spread over many tasks.

Edge cases: a null or empty text has size 0 and takes nothing; a null source is a source of its own, last in
order; repeated rows are documents of their own; a table without words has targets 0; other columns are kept by
``mix`` callers through ``doc_id`` only and never clash, as just the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrispark.llm.common import n_words, table, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 32
SHARD_WORDS = 200_000
SEED = 42


def sainte_lague(cells: DataFrame, group: list[str], key: str, weight: str, seats: str) -> DataFrame:
    """``cells`` with ``quota``: the seats of each group given to its cells by highest quotients weight/(2k+1).

    Seats beyond doubt are counted in closed form: with n cells of total weight T, at most T/(2x) + n/2 quotients
    exceed x. Only the quotients between two such bounds, about two a cell, are ranked. Ties go to the smaller key.
    """
    g = Window.partitionBy(*group)
    total, n = F.sum(weight).over(g), F.count(F.when(F.col(weight) > 0, 1)).over(g)
    d = (
        cells.withColumn("_t", total)
        .withColumn("_n", n)
        .withColumn("_hi", F.when(F.col("_t") > 0, (2 * F.col(seats) + F.col("_n")) / F.col("_t")))
        .withColumn("_lo", F.when(F.col("_t") > 0, F.greatest(F.lit(0.0), 2 * F.col(seats) - F.col("_n")) / F.col("_t")))
        .withColumn("_base", F.coalesce(F.floor((F.col(weight) * F.col("_lo") + 1) / 2), F.lit(0)))
        .withColumn("_most", F.coalesce(F.floor((F.col(weight) * F.col("_hi") + 1) / 2) + 1, F.lit(0)))
        .withColumn("_rest", F.greatest(F.lit(0), F.col(seats) - F.sum("_base").over(g)))
    )
    ranked = (
        d.where((F.col(weight) > 0) & (F.col("_rest") > 0))
        .select(*group, key, weight, "_rest", F.explode(F.sequence("_base", "_most")).alias("_k"))
        .withColumn("_q", F.col(weight) / (2 * F.col("_k") + 1))
        .withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_q"), key, "_k")))
        .where("_rank <= _rest")
        .groupBy(*group, key)
        .agg(F.count("*").alias("_more"))
    )
    return (
        d.join(ranked, [*group, key], "left")
        .withColumn("quota", (F.col("_base") + F.coalesce("_more", F.lit(0))).cast("long"))
        .drop("_t", "_n", "_hi", "_lo", "_base", "_most", "_rest", "_more")
    )


def capped_targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """``sources`` (key, source, source_size) with ``target``: weighted shares that stop at cap * size.

    Resharing what capped sources leave until none is above its cap ends at min(cap * size, level * weight) for
    one level: the first, in order of cap * size / weight, that the source at hand doesn't exceed. One row a
    source is sorted here, never one a document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy("_ratio", "key")
    everything = Window.partitionBy(F.lit(0))
    most = cap * F.col("source_size")
    return (
        sources.withColumn("_w", weight)
        .withColumn("_ratio", most / F.col("_w"))
        .withColumn("_full", F.coalesce(F.sum(most).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_open", F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (share * F.sum("source_size").over(everything) - F.col("_full")) / F.col("_open"))
        .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(everything))
        .withColumn("target", F.least(most.cast("double"), F.coalesce(F.col("_level._level"), F.lit(0.0)) * F.col("_w")))
        .drop("_w", "_ratio", "_full", "_open", "_level")
    )


def _phase(seed: int, blocks: str) -> Column:
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), "key", F.col("shard").cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.greatest(F.col(blocks), F.lit(1)))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Per document: ``id_col, source, size, source_size, target, taken`` (words taken, repeats counted)."""
    sized = written(
        docs.select(
            F.col(id_col),
            F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"),
            F.when(F.col(source_col).isNull(), "N").otherwise(F.concat(F.lit("S"), F.col(source_col))).alias("key"),
        ),
        "sized",
    )
    sources = capped_targets(
        sized.groupBy("key", "source").agg(F.sum("size").alias("source_size")), weights, share, cap
    )
    all_sources = Window.partitionBy("one")
    sources = sainte_lague(
        sources.withColumn("one", F.lit(1)).withColumn(
            "seats", F.round(F.sum("target").over(all_sources) / block_words).cast("long")
        ),
        ["one"], "key", "target", "seats",
    ).select(
        "key", "source_size", "target", F.col("quota").alias("source_quota"),
        F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / shard_words).alias("n_shards"),
    )
    sources = written(sources, "sources")
    placed = sized.join(sources.select("key", "n_shards", "source_size", "target", "source_quota"), "key").withColumn(
        "shard", F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.col("size").cast("string"))), 1, 8), 16, 10).cast("long"), F.col("n_shards"))
    )
    cells = sainte_lague(
        placed.groupBy("key", "shard", "source_quota").agg(F.sum("size").alias("words")),
        ["key"], "shard", "words", "source_quota",
    ).withColumn("n_blocks", F.ceil(F.col("words") / block_words))
    cells = cells.select(
        "key", "shard", "n_blocks", _phase(seed, "n_blocks").alias("phase"),
        F.least("quota", cap * F.col("n_blocks")).alias("quota"),
    )
    before = F.coalesce(
        F.sum("size").over(
            Window.partitionBy("key", "shard").orderBy(id_col, "size").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )

    def passes(block: Column) -> Column:
        return F.floor((block * F.col("quota") + F.col("phase")) / F.greatest(F.col("n_blocks"), F.lit(1)))

    def taken_before(words: Column) -> Column:
        block = F.floor(words / block_words)
        return block_words * passes(block) + (words % block_words) * (passes(block + 1) - passes(block))

    return (
        placed.withColumn("_from", before)
        .join(cells, ["key", "shard"])
        .withColumn("taken", (taken_before(F.col("_from") + F.col("size")) - taken_before(F.col("_from"))).cast("long"))
        .select(id_col, "source", "size", "source_size", "target", "taken")
    )


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


#: The same in DuckDB, with production parameters.
OP10_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'N' ELSE 'S' || source END AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), src AS (
  SELECT key, source, CAST(sum(size) AS BIGINT) AS source_size,
         [{', '.join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)}] AS w
  FROM sized GROUP BY key, source
), lv AS (
  SELECT *, {CAP} * source_size / w AS ratio,
         ({SHARE} * sum(source_size) OVER ()
          - coalesce(sum({CAP} * source_size) OVER (ORDER BY {CAP} * source_size / w, key
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY {CAP} * source_size / w, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM src
), tg AS (
  SELECT key, source, source_size,
         least(CAST({CAP} * source_size AS DOUBLE),
               coalesce((SELECT arg_min(lev, ratio) FROM lv WHERE lev <= ratio), 0.0) * w) AS target
  FROM lv
), seats AS (
  SELECT *, CAST(round(sum(target) OVER () / {BLOCK_WORDS}) AS BIGINT) AS h FROM tg
), quo AS (
  SELECT key, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, key, k) AS r, h
  FROM seats, unnest(range(CAST(target / {BLOCK_WORDS} AS BIGINT) + 9)) AS u(k) WHERE target > 0
), sq AS (
  SELECT s.key, s.source_size, s.target, CAST(ceil(greatest(s.source_size, 1) / {SHARD_WORDS}) AS BIGINT) AS n_shards,
         (SELECT count(*) FROM quo q WHERE q.key = s.key AND q.r <= q.h) AS source_quota
  FROM seats s
), placed AS (
  SELECT z.*, q.n_shards, q.source_size, q.target, q.source_quota,
         CAST('0x' || substr(md5(concat_ws('|', CAST(z.doc_id AS VARCHAR), CAST(z.size AS VARCHAR))), 1, 8) AS BIGINT) % q.n_shards AS shard
  FROM sized z JOIN sq q USING (key)
), cell AS (
  SELECT key, shard, source_quota, CAST(sum(size) AS BIGINT) AS words FROM placed GROUP BY ALL
), cq AS (
  SELECT key, shard, row_number() OVER (PARTITION BY key ORDER BY words / (2 * k + 1) DESC, shard, k) AS r, source_quota
  FROM cell, unnest(range(CAST(2 * words / {BLOCK_WORDS} AS BIGINT) + 9)) AS u(k) WHERE words > 0
), shards AS (
  SELECT c.key, c.shard, CAST(ceil(c.words / {BLOCK_WORDS}) AS BIGINT) AS n_blocks,
         (SELECT count(*) FROM cq WHERE cq.key = c.key AND cq.shard = c.shard AND cq.r <= cq.source_quota) AS quota
  FROM cell c
), ph AS (
  SELECT key, shard, n_blocks, least(quota, {CAP} * n_blocks) AS quota,
         CAST('0x' || substr(md5('{SEED}|' || key || '|' || CAST(shard AS VARCHAR)), 1, 8) AS BIGINT)
           % greatest(n_blocks, 1) AS phase
  FROM shards
), pos AS (
  SELECT p.*, coalesce(CAST(sum(size) OVER (PARTITION BY key, shard ORDER BY doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS a FROM placed p
), ends AS (
  SELECT pos.*, h.quota, h.phase, greatest(h.n_blocks, 1) AS nb, a // {BLOCK_WORDS} AS ja, (a + size) // {BLOCK_WORDS} AS jb
  FROM pos JOIN ph h USING (key, shard)
)
SELECT doc_id, source, size, source_size, target,
  CAST({BLOCK_WORDS} * ((jb * quota + phase) // nb)
   + ((a + size) % {BLOCK_WORDS}) * (((jb + 1) * quota + phase) // nb - (jb * quota + phase) // nb)
   - {BLOCK_WORDS} * ((ja * quota + phase) // nb)
   - (a % {BLOCK_WORDS}) * (((ja + 1) * quota + phase) // nb - (ja * quota + phase) // nb) AS BIGINT) AS taken
FROM ends
"""
