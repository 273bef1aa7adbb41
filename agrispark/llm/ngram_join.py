"""N-gram Jaccard self-join by prefix-tree joins.

A document is the set of its k-word shingles (63-bit hashes). Sets have one global order: shingles that many
documents hold come last (their highest bit is set), the others by hash. Two sets with Jaccard similarity t share a
shingle among their first ``n - ceil(t n) + 1``, so only these prefix entries are shuffled, in blocks of numpy arrays
keyed by a bucket of the shingle. Documents with equal sets are one node throughout, so copies cost nothing. An entry
at position i of a set of n can be the first common one only with a partner of at most (n - i) (1 + t) / t - n
shingles, and both sides of a pair must allow the other.

All sets are compared in a trie of ordered shingles (``trie_join``): the members of a group are its leaves, the walk
carries the overlap of all queries of the group down common beginnings at once, and a subtree is left as soon as, for
every query, the overlap plus what remains of the query falls short of the least overlap that any size there allows.

First round: under each shingle, nodes face one pivot, the node with the fewest rare shingles before it, which is
linear in the group. Second round: under shingles whose other nodes still lie in different components, the nodes
outside the largest component there are the queries against all nodes there. They meet as blocks of sets of bounded
size, and a pair counts only under its first common shingle, so that other shingles leave it at once. A block emits a
forest of its verified links, never its pairs. Only where a shingle has fewer queries than a set has prefix places
(few, long sets that meet again and again) are pairs sent singly, bounded by a parity bitmap first.

A shingle with entries of more than ``HOT`` documents is dealt over several groups by node, each with a pivot of its
own, and these pivots face one of them.

Edge cases: null texts and texts without words have the empty set and link with nothing; a text of fewer than k
words is one shingle; repeated rows fall into one node; a row without an id links like any other, and a component's
id is its smallest non-null document id (null if it has none); other columns are never read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrispark.llm.common import WordHashes, byte_texts, connected_components, dropped, freed, mapped, mixed64, row_key, slices, table, words_of, written

BITMAP_WORDS = 8
LATE = np.uint64(1 << 63)
#: Documents of entries that share a bucket of shingles.
ROWS_A_BUCKET = 8_000
#: A shingle of so many documents goes last in the global order, if no more shingles than that are as frequent.
OFTEN, MOST_OFTEN = 32, 500_000
CHUNK = 256
#: Documents that may hold a shingle before it is dealt over several groups.
HOT = 32_000
#: Shingles of the sets on one side of a block, and cells of a walk's tables of queries.
BLOCK = 1_000_000
CELLS = 4_000_000
#: Bits of a sieve of rows: in a piece, which one task makes, and in all (8 MB).
PIECE, MOST_BITS = 1 << 20, 1 << 26


def shingle_set(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; the whole sequence as one when it is shorter."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(k, n)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : n - width + 1 + j]
    return np.unique(mixed64(out) >> np.uint64(1))


def in_order(s: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The set in the global order; often shingles carry the highest bit."""
    if not len(often) or not len(s):
        return s
    late = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s
    return np.concatenate([s[~late], s[late] | LATE])


def set_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity of the shingles in each slot, a slot for two shingles or less: two bitmaps differ in at most as many
    slots as their sets do. Widths are powers of two, so a wider bitmap folds into a narrower one."""
    slots = 64 * BITMAP_WORDS
    while 2 * slots < len(s):
        slots *= 2
    parity = np.bincount((s & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.int64)


def sets_of(batch_texts: list[bytes], k: int) -> list[np.ndarray]:
    hashes = WordHashes()
    return [shingle_set(words_of(t), k, hashes) for t in batch_texts]


def prefix_size(n: int, num: int, den: int) -> int:
    """Length of the prefix in which sets with num/den similarity must meet: n - ceil(n num / den) + 1."""
    return n - -(-n * num // den) + 1


def by_bucket(tokens: np.ndarray, buckets: int):
    """(bucket, positions) for the buckets that tokens fall in."""
    if not len(tokens):
        return []
    slot = (mixed64(tokens ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    ids, starts = np.unique(slot[order], return_index=True)
    return [(int(b), part) for b, part in zip(ids, np.split(order, starts[1:]), strict=True)]


def hashed(docs: DataFrame, k: int, num: int, den: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts: a row ``(_id, _row, key, n, bits)`` of each document, and, in rows with a ``bucket``, how
    many documents of a batch hold each shingle among their first by hash."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["_id", "_row", "key", "n", "bits", "bucket", "tokens", "counts"]
    rows = docs.select(F.col(id_col).alias("_id"), row_of(id_col, text_col).alias("_row"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch):
        sets = sets_of(byte_texts(batch.column(2)), k)
        first = [s[: prefix_size(len(s), num, den) * 3 // 2 + 8] if len(s) else s for s in sets]
        tokens, counts = np.unique(np.concatenate(first), return_counts=True)
        summed = by_bucket(tokens, buckets)
        none = [pa.nulls(len(sets), t) for t in (pa.int32(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([set_key(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())), *none,
            ],
            names=names,
        )
        none = [pa.nulls(len(summed), t) for t in (batch.column(0).type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(
            [
                *none, pa.array([b for b, _ in summed], pa.int32()), pa.array([tokens[i].tobytes() for _, i in summed], pa.binary()),
                pa.array([counts[i].astype(np.uint32).tobytes() for _, i in summed], pa.binary()),
            ],
            names=names,
        )

    return mapped(rows, run, f"_id {kind}, _row bigint, key bigint, n bigint, bits array<bigint>, bucket int, tokens binary, counts binary")


def row_of(id_col: str, text_col: str) -> Column:
    """64 bits that find a row again: its id, null or not, and its text."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col))


def often_shingles(counted: DataFrame, least: int = OFTEN, most: int = MOST_OFTEN) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that at least ``least`` documents hold among their first by hash, and how many do.

    Counts are summed in each batch before they are shuffled. While there are more than ``most`` such shingles, ``least``
    is doubled, so what is collected is bounded. A share of the documents in its place would let the groups of the other
    shingles grow with the input, and with them the sets that are sent under each.
    """

    def add(group: pa.Table) -> pa.Table:
        tokens = np.frombuffer(b"".join(group["tokens"].to_pylist()), np.uint64)
        counts = np.frombuffer(b"".join(group["counts"].to_pylist()), np.uint32)
        distinct, at = np.unique(tokens, return_inverse=True)
        total = np.bincount(at, counts, len(distinct)).astype(np.int64)
        return pa.table({"token": distinct[total >= least].view(np.int64), "held": total[total >= least]})

    held = written(counted.select("bucket", "tokens", "counts").groupBy("bucket").applyInArrow(add, "token bigint, held bigint"), "held")
    while held.where(F.col("held") >= least).count() > most:
        least *= 2
    found = held.where(F.col("held") >= least).collect()
    dropped(held)
    tokens, held = (np.array([r[c] for r in found], np.int64) for c in ("token", "held"))
    order = np.argsort(tokens)
    return tokens[order].view(np.uint64), held[order]


def shared_entries(docs: DataFrame, k: int, num: int, den: int, buckets: int, often: np.ndarray, held: np.ndarray, text_col: str, hot: int = HOT) -> DataFrame:
    """``(token, key, n, most, pivot, lead)`` of prefix entries that could be the first common one of a pair.

    ``most`` is the largest partner that the entry's position allows. The pivot of a shingle is the node whose entry
    leaves most room (``lead``); a node that it rules out is its own. Entries of a hot shingle are dealt by node.
    """
    dealt = often[held > hot]
    spread = max(1, int(held[held > hot].sum()) // ROWS_A_BUCKET)
    last = docs.sparkSession.sparkContext.broadcast((often, dealt))

    def run(batch: pa.RecordBatch):
        late, busy = last.value
        tokens, keys, sizes, most = [], [], [], []
        seen = set()
        for s in sets_of(byte_texts(batch.column(0)), k):
            key = set_key(s)
            if not len(s) or key in seen:
                continue
            seen.add(key)
            p = in_order(s, late)[: prefix_size(len(s), num, den)]
            tokens.append(p)
            keys.append(np.full(len(p), key, np.int64))
            sizes.append(np.full(len(p), len(s), np.int32))
            most.append(((len(s) - np.arange(len(p))) * (num + den) // num - len(s)).astype(np.int32))
        if tokens:
            t, c, n, m = (np.concatenate(x) for x in (tokens, keys, sizes, most))
            over = np.isin(t, busy | LATE)
            rows = [(b, np.flatnonzero(~over)[i]) for b, i in by_bucket(t[~over], buckets)]
            by_node = mixed64(t[over] ^ c[over].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            rows += [(buckets + b, np.flatnonzero(over)[i]) for b, i in by_bucket(by_node, spread)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _ in rows], pa.int32()),
                    *(pa.array([x[i].tobytes() for _, i in rows], pa.binary()) for x in (t, c, n, m)),
                ],
                names=["bucket", "tokens", "keys", "sizes", "most"],
            )

    def firsts(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.append(True, t[1:] != t[:-1])) if len(t) else np.empty(0, np.int64)
        return starts, np.diff(np.append(starts, len(t)))

    def pair(group: pa.Table) -> pa.Table:
        t, c, n, m = (
            np.frombuffer(b"".join(group[name].to_pylist()), kind)
            for name, kind in (("tokens", np.uint64), ("keys", np.int64), ("sizes", np.int32), ("most", np.int32))
        )
        whole = group["bucket"][0].as_py() < buckets
        order = np.lexsort((c, n, t))
        t, c, n, m = (x[order] for x in (t, c, n, m))
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
        t, c, n, m = (x[fresh] for x in (t, c, n, m))
        if whole and len(t):
            # an entry needs another of a size that it allows: the smallest of its group, or the next if that is itself
            starts, counts = firsts(t)
            own = np.repeat(starts, counts)
            other = np.where(np.arange(len(t)) == own, np.minimum(own + 1, len(t) - 1), own)
            able = (other != np.arange(len(t))) & (t[other] == t) & (n[other] <= m)
            t, c, n, m = (x[able] for x in (t, c, n, m))
        order = np.lexsort((c, n - m, t))
        t, c, n, m = (x[order] for x in (t, c, n, m))
        starts, counts = firsts(t)
        first = np.repeat(starts, counts)
        allowed = (n <= m[first]) & (n[first] <= m)
        pivot, lead = np.where(allowed, c[first], c), first == np.arange(len(t))
        kept = np.repeat(counts, counts) > 1 if whole else np.ones(len(t), bool)
        columns = {"token": t.view(np.int64), "key": c, "n": n, "most": m, "pivot": pivot, "lead": lead}
        return pa.table({name: x[kept] for name, x in columns.items()})

    return (
        mapped(docs.select(text_col), run, "bucket int, tokens binary, keys binary, sizes binary, most binary", 2000)
        .groupBy("bucket").applyInArrow(pair, "token bigint, key bigint, n int, most int, pivot bigint, lead boolean")
    )


def may_link(num: int, den: int, a: str = "a", b: str = "b") -> Column:
    """Whether sizes and bitmaps leave room for similarity num/den: |A xor B| <= (den-num)/(den+num) (|A|+|B|).

    Compatible sizes have bitmaps of equal width or of one to two; the wider is folded.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    x, y = F.col(f"{a}.bits"), F.col(f"{b}.bits")

    def narrowed(p: Column, q: Column) -> Column:
        half = F.greatest(F.lit(1), (F.size(p) / 2).cast("int"))
        folded = F.zip_with(F.slice(p, F.lit(1), half), F.slice(p, half + 1, half), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(p) > F.size(q), folded).otherwise(p)

    differ = F.aggregate(
        F.zip_with(narrowed(x, y), narrowed(y, x), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda total, c: total + c
    )
    sizes = F.least(n, m) * den >= F.greatest(n, m) * num
    return F.when(sizes, differ * (den + num) <= (den - num) * (n + m)).otherwise(False)


def trie_join(queries: list[np.ndarray], members: list[np.ndarray], num: int, den: int, under: int | None = None) -> list[tuple[int, int]]:
    """``(query, member)`` positions of the pairs whose similarity is num/den or more; with ``under``, a shingle that all
    hold, only pairs that have no common shingle before it.

    Members in lexicographic order are the leaves of a trie in depth-first order; a member is entered at the depth
    where it leaves the path before it, with the overlaps counted so far for all queries. Below a depth where for
    every query the overlap plus what is left of it falls short of the least overlap of any allowed size, the whole
    subtree is passed over.
    """
    order = sorted(range(len(members)), key=lambda i: members[i].astype(">u8").tobytes())
    found: list[tuple[int, int]] = []
    at = 0
    while at < len(queries):
        size, some = 0, at
        while some < len(queries) and (some == at or (size + len(queries[some])) * (some + 1 - at) <= CELLS):
            size += len(queries[some])
            some += 1
        part = queries[at:some]
        tokens = np.unique(np.concatenate(part))
        held = np.zeros((len(tokens) + 1, len(part)), np.int32)
        for j, q in enumerate(part):
            held[np.searchsorted(tokens, q), j] = 1
        before = np.zeros_like(held)
        np.cumsum(held[:-1], axis=0, out=before[1:])
        n = np.array([len(q) for q in part])
        least_size = -(-n * num // den)
        path, overlap, dead = np.empty(0, np.uint64), np.zeros((1, len(part)), np.int32), None
        for i in order:
            m = members[i]
            common = min(len(path), len(m))
            differ = np.flatnonzero(path[:common] != m[:common])
            depth = int(differ[0]) if len(differ) else common
            if dead is not None and depth >= dead:
                continue
            new = m[depth:]
            left = np.searchsorted(tokens, new)
            hit = tokens[np.minimum(left, len(tokens) - 1)] == new
            overlap = np.concatenate([overlap[: depth + 1], overlap[depth] + np.cumsum(held[np.where(hit, left, len(tokens))], axis=0)])
            path = m
            depths = np.arange(depth, len(m) + 1)
            last = np.searchsorted(tokens, m[depth - 1 : depth], side="right") if depth else np.zeros(1, np.int64)
            used = before[np.concatenate([last, left + hit])]
            need = -(-num * (n + np.maximum(depths[:, None], least_size)) // (num + den))
            alive = overlap[depth:] + n - used >= need
            if under is not None:
                alive &= overlap[np.minimum(depths, np.searchsorted(m, np.uint64(under)))] == 0
            gone = np.flatnonzero(~alive.any(axis=1))
            dead = depth + int(gone[0]) if len(gone) else None
            if dead is None:
                o = overlap[-1]
                found += [(at + int(j), i) for j in np.flatnonzero(alive[-1] & (den * o >= num * (n + len(m) - o)))]
        at = some
    return found


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of links between keys, those that join parts not joined before."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            kept.append((a, b))
    return kept


def sieve(chosen: DataFrame) -> np.ndarray:
    """A bitmap of the hashes ``_row`` by their last bits, sixteen bits a row up to ``MOST_BITS``; made piece by piece."""
    bits = min(MOST_BITS, max(64, 1 << (16 * chosen.count()).bit_length()))
    piece = min(PIECE, bits)

    def mark(group: pa.Table) -> pa.Table:
        held = np.zeros(piece, bool)
        held[group["at"].to_numpy() % piece] = True
        return pa.table({"piece": group["piece"][:1], "held": pa.array([np.packbits(held).tobytes()], pa.binary())})

    at = chosen.select(F.col("_row").bitwiseAND(bits - 1).alias("at")).distinct()
    with freed(chosen.sparkSession):
        found = at.select("at", F.floor(F.col("at") / piece).alias("piece")).groupBy("piece").applyInArrow(mark, "piece bigint, held binary").collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in found:
        out[r["piece"] * piece // 8 :][: piece // 8] = np.frombuffer(r["held"], np.uint8)
    return out


def sets_for(keys: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, often: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``(key, set)`` in the global order, from the text of one row of each node.

    Rows that a sieve of the chosen ones rules out go before anything is shuffled; of the others sets are shuffled, not texts.
    """
    chosen = written(nodes.join(keys, "key").select("_row", "key"), "chosen")
    spark = docs.sparkSession
    last, held = spark.sparkContext.broadcast(often), spark.sparkContext.broadcast(sieve(chosen))

    @F.pandas_udf("boolean")
    def maybe(row: pd.Series) -> pd.Series:
        at = row.to_numpy() & (8 * len(held.value) - 1)
        return pd.Series(held.value[at >> 3] >> (7 - (at & 7)) & 1 == 1)

    def make(batches):
        seen: set[int] = set()  # equal rows
        for batch in slices(batches, 1000):
            rows = batch.column(0).to_pylist()
            new = []
            for i, row in enumerate(rows):
                if row not in seen:
                    seen.add(row)
                    new.append(i)
            sets = sets_of(byte_texts(batch.column(1).take(pa.array(new, pa.int64()))), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[i] for i in new], pa.int64()), pa.array([in_order(s, last.value).tobytes() for s in sets], pa.binary())],
                names=["_row", "set"],
            )

    texts = docs.select(row_of(id_col, text_col).alias("_row"), F.col(text_col).alias("text")).where(maybe("_row"))
    sets = written(texts.mapInArrow(make, "_row bigint, set binary").join(chosen, "_row").select("key", "set"), "sets")
    dropped(chosen)
    return sets


def _walk(num: int, den: int, anchored: bool):
    """Cogroup function: members ``(key, set)`` and queries ``(under, asked, asked_set)`` to a forest of links."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        links = []
        if left.num_rows and right.num_rows:
            sides = []
            for side, key, data in ((right, "asked", "asked_set"), (left, "key", "set")):
                own = dict(zip(side[key].to_pylist(), side[data].to_pylist(), strict=True))
                sides.append((list(own), [np.frombuffer(s, np.uint64) for s in own.values()]))
            (asked, queries), (keys, members) = sides
            under = right["under"][0].as_py() % (1 << 64) if anchored else None
            found = ((asked[q], keys[m]) for q, m in trie_join(queries, members, num, den, under))
            links = forest([x for x in found if x[0] != x[1]])
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The links among pairs ``(a, b)`` of node keys: the nodes that face the same ``a``, in tries of about ``CHUNK`` leaves."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "chunks").alias("chunk"))
    members = dealt.join(sets.withColumnRenamed("key", "b"), "b").select("a", "chunk", F.col("b").alias("key"), "set")
    queries = dealt.select("a", "chunk").distinct().join(sets.withColumnRenamed("key", "a"), "a").select(
        F.col("a").alias("asked"), F.col("chunk").alias("part"), F.col("set").alias("asked_set")
    )
    return members.groupBy("a", "chunk").cogroup(queries.groupBy("asked", "part")).applyInArrow(_walk(num, den, False), "a bigint, b bigint")


def block_links(open_: DataFrame, sets: DataFrame, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """Links among the nodes ``(token, key, n, query)`` of each token: its queries against all, in blocks of sets."""
    sizes = open_.groupBy("token").agg(
        F.ceil(F.sum("n") / block).alias("chunks"), F.ceil(F.sum(F.when(F.col("query"), F.col("n"))) / block).alias("asked")
    )
    dealt = open_.join(sizes, "token")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("asked") - 1)).alias("q")
    members = dealt.select("token", "key", F.pmod(F.xxhash64("key"), "chunks").alias("m"), every).join(sets, "key").select("token", "m", "q", "key", "set")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("qm")
    queries = dealt.where("query").select("token", "key", F.pmod(F.xxhash64("key"), "asked").alias("qq"), every).join(sets, "key").select(
        F.col("token").alias("under"), "qm", "qq", F.col("key").alias("asked"), F.col("set").alias("asked_set")
    )
    return members.groupBy("token", "m", "q").cogroup(queries.groupBy("under", "qm", "qq")).applyInArrow(_walk(num, den, True), "a bigint, b bigint")


def jaccard_components(
    docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, block: int = BLOCK
) -> DataFrame:
    """Per document: ``id_col, n_shingles, component_id``; documents link when den * |A and B| >= num * |A or B|."""
    rows = docs.count()
    buckets = max(8, rows // ROWS_A_BUCKET)
    made = written(hashed(docs, k, num, den, buckets, id_col, text_col), "hashed")
    members = written(made.where("bucket is null").select("_id", "key", "n"), "members")
    nodes = written(
        made.where("bucket is null and n > 0").groupBy("key").agg(
            F.min("_id").alias("_doc"), F.min("_row").alias("_row"), F.first("n").alias("n"), F.first("bits").alias("bits")
        ),
        "nodes",
    )
    often, held = often_shingles(made.where("bucket is not null"))
    dropped(made)
    entries = written(shared_entries(docs, k, num, den, buckets, often, held, text_col, hot), "entries")
    find = (nodes, docs, k, often, id_col, text_col)
    lit = nodes.select("key", "n", "bits")

    def keys_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()

    ends = entries.where("key <> pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b"))
    rest = entries.where("not lead")  # a pivot has faced all others of its shingle
    if (held > hot).any():
        # of the pivots of a shingle that is dealt over several groups, all face the one that leaves most room
        leads = entries.where("lead").groupBy("token").agg(F.max(F.struct(F.col("most") - F.col("n"), "key"))["key"].alias("a"), F.count("*").alias("leads"))
        several = F.broadcast(leads.where("leads > 1").select("token", "a"))  # no more than there are hot shingles
        ends = ends.union(entries.where("lead").join(several, "token").where("key <> a").select("a", F.col("key").alias("b")))
        rest = entries.join(several, "token", "left").where("a is not null or not lead")
    ends = (
        ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().alias("p")
        .join(lit.alias("a"), F.col("p.a") == F.col("a.key")).join(lit.alias("b"), F.col("p.b") == F.col("b.key"))
    )
    tried = written(ends.where(may_link(num, den)).select("p.a", "p.b"), "tried")
    sets = sets_for(keys_of(tried), *find)
    links = written(verified(tried, sets, num, den), "links")
    dropped(sets)
    parts = written(connected_components(links, "a", "b"), "parts")

    placed = rest.select("token", "key", "n", "most").join(parts.withColumnRenamed("node", "key"), "key", "left").select(
        "token", "key", "n", "most", F.coalesce("component", "key").alias("part")
    )
    by_part = placed.groupBy("token", "part").agg(F.count("*").alias("c"), F.sum("n").alias("vol"))
    open_tokens = by_part.groupBy("token").agg(
        F.max(F.struct("c", "part"))["part"].alias("home"), F.sum("c").alias("g"), F.sum("vol").alias("vol"), F.count("*").alias("parts"), F.max("c").alias("most_c")
    ).where("parts > 1")
    # fewer queries than a set has prefix places: pairs cost less than sets under each of them
    singly = (F.col("g") - F.col("most_c")) * F.col("g") * den <= (den - num) * F.col("vol")
    unsettled = written(
        placed.join(open_tokens.select("token", "home", singly.alias("singly")), "token")
        .select("token", "key", "n", "most", "part", (F.col("part") != F.col("home")).alias("query"), "singly"),
        "unsettled",
    )
    dropped(entries)
    few = unsettled.where("singly").join(nodes.select("key", "bits"), "key")
    more = (
        few.where("query").alias("a").join(few.alias("b"), F.col("a.token") == F.col("b.token"))
        .where((F.col("a.part") != F.col("b.part")) & (F.col("a.n") <= F.col("b.most")) & (F.col("b.n") <= F.col("a.most")))
        .where(may_link(num, den))
        .select(F.least("a.key", "b.key").alias("a"), F.greatest("a.key", "b.key").alias("b")).distinct()
    )
    more = written(more.join(tried, ["a", "b"], "left_anti"), "more")
    blocks = unsettled.where("not singly").select("token", "key", "n", "query")
    sets = sets_for(keys_of(more).union(blocks.select("key")).distinct(), *find)
    found = written(verified(more, sets, num, den).unionByName(block_links(blocks, sets, num, den, block)).distinct(), "links")
    dropped(sets, unsettled)
    if not found.isEmpty():
        parts = written(connected_components(links.unionByName(found), "a", "b"), "parts")

    named = nodes.join(parts.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "_doc", F.coalesce("component", "key").alias("part")
    )
    smallest = named.groupBy("part").agg(F.min("_doc").alias("component_id"))
    classes = named.join(smallest, "part").select("key", "component_id")
    return members.join(classes, "key", "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``docs``: that of the smallest id, null ids last, then of the smallest hash of the row.

    Rows are told apart by id and hash, so an id that several texts share, or none, drops nothing but equal rows.
    """
    mark = "_" + uuid.uuid4().hex
    keyed = docs.withColumn(mark, F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), row_key(docs).alias("row")))
    found = jaccard_components(keyed, k, num, den, mark, text_col)
    kept = found.where(F.col(mark) == F.col("component_id")).select(mark).distinct()
    return keyed.join(kept, mark, "left_semi").dropDuplicates([mark]).select(*docs.columns)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)
