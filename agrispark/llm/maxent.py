"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax, beside smoothed unigrams.

The probability of a token is that of its class given what stands before it, times that of its part of the class given
the class and the same context, times that of the token within its part. Classes and parts are hashes of words (class 0
is the end token alone). The first two factors are log-linear models over hashed features of the context (word before,
word before that as a skip, both together, and a bias); the third is a smoothed unigram.

Training is by multiplicative gradient updates over all tasks: for a round of documents, each task counts how often
features and outcomes meet and how often the model expects them to; the sums over all tasks, blocks of rows at a time,
move each weight by a step of their log ratio. The sums don't depend on how documents are dealt over tasks, so neither
do weights and scores (but for the last digits of floats). The first round has no weights yet and expects outcomes
to be even; every training document takes part in one round.

The third factor and the base score need the count of every token of the corpus: counts are summed by bucket of the
token's 64-bit id and sent back to the chunks of documents that ask for them, so the vocabulary is never in one place.

Edge cases: a null or empty text is the end token alone; a null id counts as the empty text in the choice of
training documents; unseen tokens have the count 0; without training tokens every probability is uniform and the
base score is 0; repeated rows count and score each time; only the named columns are read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrispark.llm.common import byte_texts, mapped, mixed64, slices, table, words_of, written

#: Classes, and parts of a class.
CLASSES = 32
LEAVES = CLASSES * CLASSES
#: Hashed slots of context features for classes and for parts; each table has its bias rows after them.
CLASS_SLOTS, PART_SLOTS = 1 << 13, 1 << 14
PARTS_AT = CLASS_SLOTS + 1
TABLE = PARTS_AT + PART_SLOTS + CLASSES
ROUNDS = 3
STEP_TOKENS = 4096
#: Tokens whose probabilities are summed at once.
SUM_TOKENS = 32_768
#: Step of a round, and how many occurrences a weight's evidence is shrunk by.
RATE, SHRINK = 0.4, 8.0
BLOCKS = 256
TASKS_A_SUM = 1024
MOST_CACHED = 400_000
ROWS_A_BUCKET = 4_000
ROWS_A_CHUNK = 1_000
#: No word holds white space, so this can stand for the end of a text.
END = b"\n"
_SALTS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


class TokenIds(dict):
    """64-bit id of a word: its hash, with class and part in the low bits. Kept between batches up to a fixed size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_CACHED:
            self.clear()
        kind = 0 if word == END else CLASSES * (1 + zlib.crc32(word[-2:]) % (CLASSES - 1)) + zlib.crc32(word) % CLASSES
        value = self[word] = xxhash.xxh3_64_intdigest(word) // LEAVES * LEAVES + kind
        return value


_IDS = TokenIds()


def encoded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the texts in a row and the number of tokens of each, the end token included."""
    words, sizes = [], []
    for t in texts:
        found = words_of(t)
        words += found
        words.append(END)
        sizes.append(len(found) + 1)
    return np.fromiter(map(_IDS.__getitem__, words), np.uint64, len(words)), np.array(sizes, np.int64)


def leaves_of(ids: np.ndarray) -> np.ndarray:
    return (ids % np.uint64(LEAVES)).astype(np.int64)


def context_slots(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weights [4, tokens] that speak for the class of each token, and for its part; texts begin with two blanks."""
    n = len(ids)
    starts = np.cumsum(sizes) - sizes
    one, two = np.empty(n, np.uint64), np.empty(n, np.uint64)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    one[starts] = two[starts] = 1
    two[np.minimum(starts + 1, n - 1)[sizes > 1]] = 2
    features = (one * _SALTS[0], two * _SALTS[1], one * _SALTS[2] + two * _SALTS[1])
    kind = leaves_of(ids) // CLASSES
    under = kind.astype(np.uint64) * _SALTS[3]
    first = [x >> np.uint64(64 - CLASS_SLOTS.bit_length() + 1) for x in features]
    second = [((x + under) * _SALTS[0] >> np.uint64(64 - PART_SLOTS.bit_length() + 1)) + np.uint64(PARTS_AT) for x in features]
    first.append(np.full(n, CLASS_SLOTS))
    second.append(PARTS_AT + PART_SLOTS + kind)
    return np.stack(first).astype(np.int32), np.stack(second).astype(np.int32)


def shares(weights: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores less their maximum, their exponentials and the sums of those: [tokens, classes] twice and [tokens]."""
    z = weights.take(slots[0], axis=0)
    for row in slots[1:]:
        z += weights.take(row, axis=0)
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return z, e, e.sum(axis=1)


def add_expected(expected: np.ndarray, weights: np.ndarray, slots: np.ndarray) -> None:
    """Add to each row the probabilities that the model gives to the outcomes of the tokens under it, summed outcome by outcome in doubles."""
    for k in range(0, slots.shape[1], SUM_TOKENS):
        part = slots[:, k : k + SUM_TOKENS]
        by_outcome = np.empty((CLASSES, part.shape[1]))
        for j in range(0, part.shape[1], STEP_TOKENS):
            _, p, total = shares(weights, part[:, j : j + STEP_TOKENS])
            p /= total[:, None]
            by_outcome[:, j : j + STEP_TOKENS] = p.T
        for column in part:
            low, high = int(column.min()), int(column.max()) + 1
            if high - low == 1:
                expected[low] += by_outcome.sum(axis=1)
            else:
                at = column.astype(np.intp) - low
                expected[low:high] += np.stack([np.bincount(at, p, high - low) for p in by_outcome], axis=1)


def observed(slots: np.ndarray, outcomes: np.ndarray) -> np.ndarray:
    cells = (slots.astype(np.int64) * CLASSES + outcomes).ravel()
    return np.bincount(cells, minlength=TABLE * CLASSES).reshape(TABLE, CLASSES)


def of_round(rows: DataFrame, r: int) -> DataFrame:
    """Rows of a round; a task takes those of as many partitions as there are rounds, since each task sends sums of a fixed size."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.rdd.getNumPartitions() // ROUNDS))
    return rows.where(F.col("round") == r).coalesce(tasks)


def trained(docs: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Weights [rows, classes], of fixed size, after ``ROUNDS`` rounds over disjoint parts of the training documents."""
    weights = None
    cuts = np.array_split(np.arange(TABLE), BLOCKS)
    rows = docs.select(F.col(id_col), F.col(text_col), F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(ROUNDS)).alias("round"))
    schema = "block int, part int, seen binary, expected binary"

    def add(group: pa.Table) -> pa.Table:
        sums = {c: sum(np.frombuffer(x).copy() for x in group[c].to_pylist()) for c in ("seen", "expected")}
        return pa.table({"block": group["block"][:1], "part": group["part"][:1], **{c: pa.array([x.tobytes()], pa.binary()) for c, x in sums.items()}})

    def first_add(group: pa.Table) -> pa.Table:
        wide = {c: pa.array([np.frombuffer(x, np.float32).astype(float).tobytes() for x in group[c].to_pylist()], pa.binary()) for c in ("seen", "expected")}
        return add(pa.table({"block": group["block"], "part": group["part"], **wide}))

    for r in range(ROUNDS):
        shared = docs.sparkSession.sparkContext.broadcast(weights)

        def run(batches, shared=shared):
            w = shared.value
            seen, expected = np.zeros((TABLE, CLASSES), np.int64), np.zeros((TABLE, CLASSES))
            for batch in slices(batches, 500):
                texts = [
                    t for i, t in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True) if not is_held_out(i)
                ]
                if texts:
                    ids, sizes = encoded(texts)
                    leaves = leaves_of(ids)
                    for slots, outcomes in zip(context_slots(ids, sizes), (leaves // CLASSES, leaves % CLASSES), strict=True):
                        seen += observed(slots, outcomes)
                        if w is not None:
                            add_expected(expected, w, slots)
            if seen.any():
                task = TaskContext.get().partitionId() // TASKS_A_SUM
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(BLOCKS), pa.int32()), pa.array([task] * BLOCKS, pa.int32()),
                        *(pa.array([x[c].astype(np.float32).tobytes() for c in cuts], pa.binary()) for x in (seen, expected)),
                    ],
                    names=["block", "part", "seen", "expected"],
                )

        kept = of_round(rows, r).select(id_col, text_col)
        # sums of bounded groups of tasks, then of those
        sums = kept.mapInArrow(run, schema).groupBy("block", "part").applyInArrow(first_add, schema).groupBy("block").applyInArrow(add, schema)
        seen, expected = np.zeros((2, TABLE, CLASSES))
        for row in sums.collect():
            for total, x in ((seen, row["seen"]), (expected, row["expected"])):
                total[cuts[row["block"]]] = np.frombuffer(x).reshape(-1, CLASSES)
        if weights is None:
            expected += seen.sum(axis=1, keepdims=True) / CLASSES
        change = RATE * np.log((seen + SHRINK) / (expected + SHRINK))
        weights = (change if weights is None else weights + change).astype(np.float32)
    return weights


def _by_bucket(hashes: np.ndarray, buckets: int):
    slot = (mixed64(hashes) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    ids, at = np.unique(slot[order], return_index=True)
    return zip(ids.tolist(), np.split(order, at[1:]), strict=True)


def asked_counts(chunked: DataFrame, buckets: int) -> DataFrame:
    """``(chunk, hashes, counts, n_tokens, n_types, class_tokens, class_types)`` from rows (chunk, id, text).

    Each batch sends the distinct tokens of each chunk to their buckets, with how often its training documents hold
    them. A bucket sums those counts, answers every chunk with the sums of the tokens it asked for, and adds one row
    (chunk null) with the totals of its training tokens.
    """

    def ask(batch: pa.RecordBatch):
        ids, sizes = encoded(byte_texts(batch.column(2)))
        counted = np.repeat(np.array([not is_held_out(i) for i in batch.column(1).to_pylist()], np.int64), sizes)
        owner = np.repeat(np.array(batch.column(0).to_pylist(), np.int64), sizes)
        rows = []
        for chunk in np.unique(owner).tolist():
            own = owner == chunk
            distinct, at = np.unique(ids[own], return_inverse=True)
            counts = np.bincount(at, counted[own], len(distinct)).astype(np.int64)
            rows += [(b, chunk, distinct[i].tobytes(), counts[i].tobytes()) for b, i in _by_bucket(distinct, buckets)]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "chunk", "hashes", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        asked = group["hashes"].to_pylist()
        ids = np.frombuffer(b"".join(asked), np.uint64)
        known, at = np.unique(ids, return_inverse=True)
        count = np.bincount(at, np.frombuffer(b"".join(group["counts"].to_pylist()), np.int64), len(known)).astype(np.int64)
        own = [np.frombuffer(h, np.uint64) for h in asked]
        found = [count[np.searchsorted(known, h)] for h in own]
        seen = count > 0
        kinds = leaves_of(known[seen])
        rows = [(c, h.tobytes(), f.tobytes(), None, None, None, None) for c, h, f in zip(group["chunk"].to_pylist(), own, found, strict=True)]
        rows.append(
            (None, None, None, int(count.sum()), int(seen.sum()), np.bincount(kinds, count[seen], LEAVES).astype(np.int64), np.bincount(kinds, minlength=LEAVES))
        )
        types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["chunk", "hashes", "counts", "n_tokens", "n_types", "class_tokens", "class_types"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows, strict=True), types, strict=True)})

    return (
        mapped(chunked.select("chunk", "id", "text"), ask, "bucket int, chunk int, hashes binary, counts binary", 2000)
        .groupBy("bucket")
        .applyInArrow(answer, "chunk int, hashes binary, counts binary, n_tokens bigint, n_types bigint, class_tokens array<bigint>, class_types array<bigint>")
    )


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each document."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.count()
    buckets, chunks = max(8, rows // ROWS_A_BUCKET), max(8, rows // ROWS_A_CHUNK)
    weights = trained(docs, id_col, text_col)
    # neighbours in id share a chunk, so a batch of the input asks for few of them; rows without a number as id are dealt one by one
    number = F.col(id_col).try_cast("long")
    dealt = F.when(number.isNotNull(), F.xxhash64(F.floor(number / ROWS_A_CHUNK))).otherwise(F.xxhash64(id_col, text_col))
    chunk = F.pmod(dealt, F.lit(chunks)).cast("int")
    chunked = docs.select(chunk.alias("chunk"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    answers = written(asked_counts(chunked, buckets), "counts")
    totals = answers.where("chunk is null")
    whole = totals.agg(F.sum("n_tokens").alias("n"), F.sum("n_types").alias("v")).first()
    by_leaf = {
        r["k"]: (r["n"], r["v"])
        for r in totals.select(F.posexplode(F.arrays_zip("class_tokens", "class_types")).alias("k", "x"))
        .groupBy("k").agg(F.sum("x.class_tokens").alias("n"), F.sum("x.class_types").alias("v")).collect()
    }
    n, v = whole["n"] or 0, whole["v"] or 0
    sizes_of_leaf = np.array([sum(by_leaf.get(k, (0, 0))) + 1 for k in range(LEAVES)], float)
    shared = docs.sparkSession.sparkContext.broadcast((weights, sizes_of_leaf))
    answers = answers.where("chunk is not null").select("chunk", "hashes", "counts")
    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        w, of_leaf = shared.value
        known, count = (
            np.frombuffer(b"".join(right[c].to_pylist() if right.num_rows else []), k) for c, k in (("hashes", np.uint64), ("counts", np.int64))
        )
        known, first = np.unique(known, return_index=True)
        logs, known_count = np.log10(count[first] + 1.0), count[first]
        leaf_logs = np.log10(of_leaf)
        base_whole = math.log10(n + (v + 1))
        out = []
        for batch in slices(left.to_batches(), 200):
            hashes, sizes = encoded(byte_texts(batch.column("text")))
            leaves = leaves_of(hashes)
            at = np.searchsorted(known, hashes)
            c, seen = known_count[at], logs[at]  # a chunk has asked for all of its tokens
            share = np.zeros(len(hashes))
            for slots, outcomes in zip(context_slots(hashes, sizes), (leaves // CLASSES, leaves % CLASSES), strict=True):
                for k in range(0, len(hashes), STEP_TOKENS):
                    part = slice(k, k + STEP_TOKENS)
                    z, _, total = shares(w, slots[:, part])
                    share[part] += z[np.arange(len(z)), outcomes[part]] - np.log(total)
            token = share / math.log(10) + seen - leaf_logs[leaves]
            starts = np.cumsum(sizes) - sizes
            for i, size, known_tokens, base, s in zip(
                batch.column("id").to_pylist(), sizes.tolist(), np.add.reduceat((c > 0).astype(np.int64), starts).tolist(),
                np.add.reduceat(seen, starts).tolist(), np.add.reduceat(token, starts).tolist(), strict=True,
            ):
                out.append((i, is_held_out(i), size, known_tokens, n, base - size * base_whole, s))
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        kinds = [left.schema.field("id").type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({name: pa.array(x, k) for name, x, k in zip(names, columns, kinds, strict=True)})

    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
