"""Packing of token sequences by best fit, longest first.

Texts become pieces of at most ``LENGTH`` tokens inside the tasks that read them; from there on only lengths move. Best
fit decreasing looks at lengths alone, so it runs on the histogram of lengths (at most ``LENGTH`` rows, whatever the
input): a segment tree over remaining capacities finds the tightest open capacity that holds a length in logarithmic
time, and since the documents of one length go on into the same sequence while they fit, one descent serves all
sequences of that capacity. The outcome is that of packing document by document. It is kept as rules: the pieces of a
length numbered from ``first`` go, ``each`` to a sequence, to the sequences from ``sequence`` on, at ``offset``.

Pieces get their number within their length from two counts: a rank inside (bucket, length), and the sum of the counts
of the buckets before, so that a length that a third of all pieces share is spread over buckets.

Edge cases: a null text is empty and a piece of its own, the end id; rows with equal or null ids are rows of their own;
texts of any length are cut, never dropped; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrispark.llm.common import mapped, slices, table, written

LENGTH, END = 1024, 2
#: Pieces in a bucket of the numbering, at most; there are as many buckets as shuffle partitions at least.
BUCKET = 200_000


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a file of ranks; special tokens in a text are plain text."""
    import public_tokenizers

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of n tokens: whole lengths, the first piece what is left."""
    head = n % length or length
    return [(0, min(n, head)), *((k, length) for k in range(head, n, length))]


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of each piece of each text and its end id; ``ids``: with its token ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * ids

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        rows: list[tuple[int, int, int, int, int]] = []
        parts: list[np.ndarray] = []
        for k, text in enumerate(batch.column(1)):
            own = np.array([*encode(text.as_py() or ""), end], "<u4")
            for n, (start, size) in enumerate(cuts(len(own), length)):
                part = own[start : start + size]
                rows.append((k, n, start, size, zlib.crc32(part.data)))
                if ids:
                    parts.append(part.astype(np.int32))
        k, n, start, size, crc = zip(*rows, strict=True)
        columns = [batch.column(0).take(pa.array(k)), pa.array(n, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, size, crc))]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if ids:
            bounds = np.cumsum([0, *map(len, parts)], dtype=np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return mapped(docs.select(id_col, text_col), run, schema, rows=100)


class Capacities:
    """Which capacities are open: a segment tree whose leaves are the capacities from 0 to ``most``."""

    def __init__(self, most: int) -> None:
        self.width = 1 << most.bit_length()
        self.open = [False] * (2 * self.width)

    def set(self, capacity: int, is_open: bool) -> None:
        k = self.width + capacity
        self.open[k] = is_open
        while k > 1:
            k //= 2
            self.open[k] = self.open[2 * k] or self.open[2 * k + 1]

    def tightest(self, need: int) -> int | None:
        """The least open capacity of at least ``need``."""
        k = self.width + need
        if self.open[k]:
            return need
        while k > 1:
            if k % 2 == 0 and self.open[k + 1]:
                k += 1
                while k < self.width:
                    k = 2 * k if self.open[2 * k] else 2 * k + 1
                return k - self.width
            k //= 2
        return None


def best_fit(histogram: dict[int, int], length: int = LENGTH) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rules ``(size, first, sequence, each, offset)``, sorted, and the number of sequences, from the number of pieces by size."""
    tree = Capacities(length)
    spans: dict[int, list[tuple[int, int]]] = {c: [] for c in range(length + 1)}  # (first sequence, how many) by remaining capacity

    def put(capacity: int, first: int, many: int) -> None:
        if many:
            spans[capacity].append((first, many))
            tree.set(capacity, True)

    rules, sequences = [], 0
    for size in sorted(histogram, reverse=True):
        done, left = 0, histogram[size]
        while left:
            capacity = tree.tightest(size)
            if capacity is None:
                new = -(-left // (length // size))
                put(length, sequences, new)
                sequences += new
                continue
            first, many = spans[capacity].pop()
            if not spans[capacity]:
                tree.set(capacity, False)
            each = min(capacity // size, left)  # fewer than fit only in the last sequence
            used = min(many, left // each)
            rules.append((size, done, first, each, length - capacity))
            done, left = done + used * each, left - used * each
            put(capacity - each * size, first, used)
            put(capacity, first + used, many - used)
    return sorted(rules), sequences


def numbered(parts: DataFrame) -> DataFrame:
    """Pieces with ``number``, from 0 within their length."""
    partitions = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, parts.count() // BUCKET)
    dealt = parts.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("_bucket", "length").agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_bucket", "length").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    return dealt.withColumn("_rank", inside).join(base, ["_bucket", "length"]).withColumn("number", F.col("_base") + F.col("_rank")).drop("_bucket", "_base", "_rank")


def packed(parts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces with the sequence that they go to and their offset in it; reads ``parts`` several times, so give it written."""
    # a row for each length at most
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rules, _ = best_fit(histogram, length)
    keys = [(r[0], r[1]) for r in rules]
    ends = {s: (bisect.bisect_left(keys, (s, 0)), bisect.bisect_left(keys, (s + 1, 0))) for s in histogram}
    first, sequence, each, offset = (np.array([r[k] for r in rules], np.int64) for k in (1, 2, 3, 4))
    given = parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 50_000):
            size = batch.column(given.index("length")).to_numpy()
            number = batch.column(len(given)).to_numpy()
            rule = np.empty(len(size), np.int64)
            for s in np.unique(size):
                lo, hi = ends[int(s)]
                own = size == s
                rule[own] = lo + np.searchsorted(first[lo:hi], number[own], "right") - 1
            k = number - first[rule]
            to, at = sequence[rule] + k // each[rule], offset[rule] + k % each[rule] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(to), pa.array(at)], names=[*given, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return numbered(parts).select(*given, "number").mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packed(written(pieces(table(spark, sf_dir, "documents"), path), "pieces"))
