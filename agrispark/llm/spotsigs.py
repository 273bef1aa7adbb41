"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

Every common word of a text is an anchor; its signature is the anchor with the next ``CHAIN`` content words. Where
anchors are rarer than one word in ``SPARSE`` (tables, junk, other languages), every run of ``CHAIN + 1`` words is
a signature as well, and a text of fewer words is one signature as a whole. The fingerprint is the sorted set of
32-bit signature hashes as hex text; the likeness of two fingerprints is the Jaccard index of their sets.

Edge cases: a null text counts as empty; the empty text has the empty fingerprint, and two empty fingerprints are
alike (1.0); no cap on text length or signature count; rows with equal ids are ordered by their text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from agrispark.llm.common import mapped, slices, table, written

CHAIN = 2
SPARSE = 20
#: Common words of the corpus languages that serve as anchors (fixed values).
ANCHORS = frozenset(
    """a an and are as at be but by for from had has have he her his if in is it its not of on or she so that the
    their there they this to was we were which will with you
    au aux avec ce ces dans de des du elle en est et il la le les leur mais ne ou par pas pour qui que sa se ses son
    sur un une
    aber als am auch auf aus bei das dem den der des die ein eine einen einer es im ist mit nicht noch oder sich sie
    sind und von vor war wie zu zum zur
    como con del el ella era ese esta las lo los más me mi muy no nos o para pero por sin sobre su sus también
    todo una uno y ya""".split()
)
_WORD = re.compile(r"\w+")


def signatures(text: str) -> set[int]:
    words = _WORD.findall(text.lower())
    found: set[int] = set()
    digest = xxhash.xxh32_intdigest
    anchors, first, second = 0, None, None
    for w in reversed(words):
        if w in ANCHORS:
            anchors += 1
            if second is not None:
                found.add(digest(f"{w} {first} {second}"))
        else:
            first, second = w, first
    if anchors * SPARSE < len(words) or not found:
        if len(words) <= CHAIN:
            whole = text.split()
            if whole:
                found.add(digest(" ".join(words or whole)))
        else:
            found.update(digest(" ".join(x)) for x in zip(words, words[1:], words[2:], strict=False))
    return found


def as_text(found: set[int]) -> str:
    return "".join(f"{x:08x}" for x in sorted(found))


def likeness(a: set[int], b: set[int]) -> float:
    if not a and not b:
        return 1.0
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, its signature hashes (sorted, signed 32 bit as long) and the fingerprint text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch):
        sets = [sorted(signatures(t or "")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.list_(pa.int64())), pa.array([as_text(set(s)) for s in sets], pa.string())],
            names=[id_col, "signatures", "fingerprint"],
        )

    return mapped(
        docs.select(id_col, text_col), run, f"`{id_col}` {kind}, signatures array<bigint>, fingerprint string"
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs ``(fingerprint_a, fingerprint_b, likeness)`` of distinct fingerprints with Jaccard >= threshold.

    Copies are one fingerprint, so groups of copies add no pairs. Sets are partitioned by length into ranges whose
    ends differ by the factor 1/threshold, so only equal and adjacent ranges meet; within them two sets meet only
    on one of their rarest signatures (prefix filter by document frequency), and pairs whose lengths or positions
    rule the threshold out are pruned before the sets are compared. Empty fingerprints pair with nothing.
    """
    distinct = written(
        fingerprints(docs, id_col, text_col).where("fingerprint <> ''").select("fingerprint", "signatures").distinct(),
        "spots",
    )
    sized = distinct.withColumn("n", F.size("signatures")).withColumn(
        "range", F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9)
    )
    rows = sized.select("fingerprint", "n", "range", F.explode("signatures").alias("s"))
    often = rows.groupBy("s").agg(F.count("*").alias("df"))
    ordered = (
        rows.join(often, "s")
        .groupBy("fingerprint", "n", "range")
        .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("o"))
    )
    prefix = ordered.select(
        "fingerprint", "n", "range",
        F.posexplode(F.slice("o", F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))),
    ).select("fingerprint", "n", "range", F.col("pos"), F.col("col.s").alias("s"))
    left = prefix.withColumn("part", F.explode(F.array("range", F.col("range") + 1)))
    right = prefix.withColumn("part", F.col("range"))

    def side(d: DataFrame, tag: str) -> DataFrame:
        return d.select("s", "part", *(F.col(c).alias(f"{c}_{tag}") for c in ("fingerprint", "n", "pos", "range")))

    a, b = side(left, "a"), side(right, "b")
    possible = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    pairs = (
        a.join(b, ["s", "part"])
        .where("n_a < n_b or (n_a = n_b and fingerprint_a < fingerprint_b)")
        .where(F.col("n_a") >= threshold * F.col("n_b") - 1e-9)
        .where(possible * (1 + threshold) >= threshold * (F.col("n_a") + F.col("n_b")) - 1e-9)
        .select("fingerprint_a", "fingerprint_b")
        .distinct()
    )
    for tag in "ab":
        pairs = pairs.join(
            distinct.select(F.col("fingerprint").alias(f"fingerprint_{tag}"), F.col("signatures").alias(tag)),
            f"fingerprint_{tag}",
        )
    both = F.size(F.array_intersect("a", "b"))
    return pairs.select(
        "fingerprint_a", "fingerprint_b", (both / (F.size("a") + F.size("b") - both)).alias("likeness")
    ).where(F.col("likeness") >= threshold - 1e-12)


LOWEST = -(2**63)
MOST_BOUNDS = 4096


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the key, through rows of bounds so that few are compared."""
    width = max(1, math.isqrt(len(bounds)))
    rows = [bounds[k : k + width] for k in range(0, len(bounds), width)]
    heads = F.array(*(F.lit(r[0]) for r in rows))
    at = F.size(F.filter(heads, lambda b: b <= key))
    inside = F.element_at(F.array(*(F.array(*map(F.lit, r)) for r in rows)), at)
    return F.when(at == 0, 0).otherwise((at - 1) * width + F.size(F.filter(inside, lambda b: b <= key)))


def with_next(docs: DataFrame, function, schema: str, id_col: str, text_col: str, rows_a_bucket: int = 1000) -> DataFrame:
    """``function(id, text, next_text)`` of each row and its successor in ascending id, the last row's being the first.

    Rows are dealt by ranges of the id (at most ``MOST_BOUNDS``, a driver-side list of that size); the first row
    of each range is also sent to the range before it, so each range is read in order on its own, with one row in
    hand. Null ids come first.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST))
    keyed = docs.select(key.alias("key"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = keyed.select("key")
    wanted = min(MOST_BOUNDS, ids.count() // rows_a_bucket)
    bounds = sorted({int(x) for x in ids.approxQuantile("key", [k / wanted for k in range(1, wanted)], 0.2 / wanted)}) if wanted > 1 else []
    bucket = _bucket(F.col("key"), bounds) if bounds else F.lit(0)
    firsts = sorted((r["b"], r["k"]) for r in ids.groupBy(bucket.alias("b")).agg(F.min("key").alias("k")).collect())
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}
    own = F.array(F.struct(bucket.cast("int").alias("bucket"), F.lit(0).alias("guest")))
    if firsts:
        ends = F.array(*(F.lit(k) for k in before))
        to = F.array(*(F.lit(b) for b in before.values()))
        place = F.array_position(ends, F.col("key")).cast("int")
        is_first = place > 0
        own = F.when(
            is_first, F.array_append(own, F.struct(F.element_at(to, F.when(is_first, place).otherwise(1)).cast("int").alias("bucket"), F.lit(1).alias("guest")))
        ).otherwise(own)
    dealt = (
        keyed.select("key", "id", "text", F.explode(own).alias("p"))
        .select("p.bucket", "p.guest", "key", "id", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "guest", "key", "text")
    )

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in slices(batches, 500):
            out = []
            for b, guest, i, text in zip(*(part.column(c).to_pylist() for c in (0, 1, 3, 4)), strict=True):
                if held is not None and held[0] == b:
                    out.append(function(held[1], held[2], text))
                held = None if guest else (b, i, text)
            if out:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), target, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    return dealt.mapInArrow(run, schema)


def edited(text: str, after: str) -> str:
    """The last half of the text (rounded down) replaced by as many first code points of the one after it."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _op6_row(doc_id, text: str, after: str) -> tuple:
    new = edited(text, after)
    own, changed, following = signatures(text), signatures(new), signatures(after)
    return (
        doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), as_text(own), as_text(changed),
        likeness(own, changed), likeness(own, following),
    )


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(
        table(spark, sf_dir, "documents"), _op6_row,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
        "doc_id", "text",
    )
