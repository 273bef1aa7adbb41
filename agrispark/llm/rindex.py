"""Removal of long repeated byte strings through run-length indexes.

Every 100-byte string contains an anchor, the 32-byte string of smallest hash in it, at a place that its own bytes
decide; equal strings have equal anchors. Only anchors are shuffled, with a hash of the bytes around them, so
strings that could be equal meet in one bucket. Where all bytes around two occurrences agree, the later one repeats
the earlier and nothing more is needed. Where they differ, the distinct surroundings of an anchor are gathered and
indexed: a suffix array, its run-compressed Burrows-Wheeler transform with the suffixes at run ends sampled, and the
longest match of every suffix with its neighbour, found at run heads only and carried on by one byte less for each
step. Suffixes that match over 100 bytes or more form classes; all but the earliest place of a class is marked.

An anchor with thousands of different surroundings would bring them all to one task. A sample of the documents shows
which these are; they are kept as a bitmap of fixed size. Around them each 100-byte string has its own key, 128 bits of
hash, of which a batch sends the earliest place only, so a hot anchor is spread over as many tasks as it has strings.
An anchor that shares its bit takes the same way with the same result.

Edge cases: null texts count as empty; texts of fewer bytes than the length asked keep everything; matches never
cross documents; several texts under one id, or under none, are documents of their own, in the order of a hash of
their text; equal rows of an id are one document; null ids come first, and ids that are no whole numbers are like
null in order; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrispark.llm.common import byte_texts, mapped, mixed64, table, written

LENGTH = 100
GRAM = 32
ROWS_A_BUCKET = 4_000
ROWS_A_CHUNK = 1_000
INDEX_BYTES = 400_000
LOWEST = -(2**63)
#: One document in so many is looked at for hot anchors; so many different surroundings there make one.
SAMPLED = 64
HOT = 32
SLOTS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = mixed64(np.arange(1, 257, dtype=np.uint64))


class RunLengthIndex:
    """Run-length index of texts that are told apart by separators: BWT runs, suffixes at run ends, neighbour matches."""

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(np.append(0, sizes[:-1] + 1)) if len(texts) else np.empty(0, np.int64)
        n = int(sizes.sum() + len(sizes))
        symbols = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        ends = self.starts + sizes
        inside[ends] = False
        symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        self.symbols, self.ends = symbols, ends
        self.suffixes = self._suffix_array(inside)
        before = symbols[self.suffixes - 1]
        # separators differ from one another, so each is a run of its own
        self.heads = np.flatnonzero(np.append(True, (before[1:] != before[:-1]) | (before[1:] == 0))) if n else np.empty(0, np.int64)
        #: The transform as (symbol, run length), and the suffixes sampled at the first and last row of each run.
        self.run_symbols = before[self.heads]
        self.run_lengths = np.diff(np.append(self.heads, n))
        self.head_samples = self.suffixes[self.heads]
        self.tail_samples = self.suffixes[self.heads + self.run_lengths - 1] if n else self.heads

    def _suffix_array(self, inside: np.ndarray) -> np.ndarray:
        """Prefix doubling from packed first symbols; a separator is unlike any other, so ranks end up distinct."""
        n = len(self.symbols)
        if not n:
            return np.empty(0, np.int64)
        padded = np.append(self.symbols, np.zeros(7, np.int64))
        key = np.zeros(n, np.int64)
        stopped = np.zeros(n, bool)
        for j in range(7):
            s = padded[j : j + n]
            key = key * 257 + np.where(stopped, 0, s)
            stopped |= s == 0
        width = 7
        # a separator within reach is told apart by where it stands
        next_end = np.searchsorted(self.ends, np.arange(n))
        to_end = self.ends[next_end] - np.arange(n)
        while True:
            order = np.argsort(key, kind="stable")
            k = key[order]
            near = to_end[order] < width
            new = np.ones(n, bool)
            new[1:] = (k[1:] != k[:-1]) | (near[1:] & near[:-1])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            if new.all():
                return order
            ahead = np.zeros(n, np.int64)
            ahead[: n - width] = rank[width:] if width < n else []
            key = rank * (n + 1) + np.where(to_end < width, 0, ahead)
            width *= 2

    def neighbour_matches(self, most: int) -> np.ndarray:
        """For each suffix, in suffix order, its match with the suffix before it, exact up to ``most``.

        Compared at run heads only; elsewhere the match is that of the text position before, less one.
        """
        n = len(self.symbols)
        here = self.suffixes[self.heads]
        there = self.suffixes[np.maximum(self.heads - 1, 0)]
        length = np.zeros(len(here), np.int64)
        active = np.flatnonzero(self.heads > 0)
        for step in range(most):
            a, b = self.symbols[here[active] + step], self.symbols[there[active] + step]
            active = active[(a == b) & (a != 0)]
            if not len(active):
                break
            length[active] = step + 1
        # a match that reaches ``most`` may be longer: it is taken on until the text ends, then cut
        grow = active
        step = most
        while len(grow):
            a, b = self.symbols[here[grow] + step], self.symbols[there[grow] + step]
            grow = grow[(a == b) & (a != 0)]
            length[grow] = step + 1
            step += 1
        at = np.full(n, -1, np.int64)
        at[here] = length + here
        carried = np.maximum.accumulate(at) - np.arange(n)
        return np.maximum(carried, 0)[self.suffixes]

    def repeats(self, length: int, places: np.ndarray) -> np.ndarray:
        """Which text positions start a string of ``length`` that also starts at a smaller place."""
        classes = np.flatnonzero(np.append(True, self.neighbour_matches(length)[1:] < length)) if len(places) else []
        marked = np.zeros(len(places), bool)
        if len(places):
            ordered = places[self.suffixes]
            first = np.minimum.reduceat(ordered, classes)
            marked[self.suffixes] = ordered > np.repeat(first, np.diff(np.append(classes, len(places))))
        next_end = self.ends[np.searchsorted(self.ends, np.arange(len(places)))] if len(places) else places
        return marked & (next_end - np.arange(len(places)) >= length)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open intervals as sorted disjoint ones; touching ones become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, s[1:] > e[:-1])
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:] - 1, len(e) - 1)]


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``(position, anchor, context)`` of the anchors of concatenated texts, given where each text starts and ends.

    The context is a hash of the bytes that strings of ``length`` around the anchor can cover, within the text.
    """
    n, reach = len(data), length - gram + 1
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    power = np.multiply.accumulate(np.full(n, _BASE))
    back = np.multiply.accumulate(np.full(n, _BASE_INVERSE))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power, out=sums[1:])
    text = np.repeat(np.arange(len(starts)), ends - starts)
    room = ends[text] - np.arange(n)
    g = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    g[: n - gram + 1] = mixed64((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])
    g[room < gram] = np.iinfo(np.uint64).max
    low, width = g, 1
    while 2 * width <= reach:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    low = np.minimum(low[: n - reach + 1], low[reach - width : reach - width + n - reach + 1])
    valid = room[: n - reach + 1] >= length
    # a gram is an anchor if it is the smallest of some string around it: of those, the largest minimum is its own
    least = np.where(valid, low, np.uint64(0))
    high = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
    width = 1
    while 2 * width <= reach:
        high = np.maximum(high[: len(high) - width], high[width:])
        width *= 2
    high = np.maximum(high[: len(high) - (reach - width)], high[reach - width :])[:n]
    at = np.flatnonzero((high == g[: len(high)]) & (high > 0) & (room[: len(high)] >= gram))
    left = np.maximum(at - (reach - 1), starts[text[at]])
    right = np.minimum(at + length, ends[text[at]])
    around = (sums[right] - sums[left]) * back[left]
    return at, g[at], mixed64(around + (at - left).astype(np.uint64) * np.uint64(1009) + (right - at).astype(np.uint64))


def slot_of(anchor: np.ndarray) -> np.ndarray:
    return ((anchor >> np.uint64(12)) % np.uint64(SLOTS)).astype(np.int64)


_POWERS = mixed64(np.arange(1_000, 1_000 + 2 * LENGTH, dtype=np.uint64)).reshape(2, LENGTH) | np.uint64(1)


def string_hashes(data: np.ndarray, at: np.ndarray, length: int, rows: int = 8_192) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the strings of ``length`` that start at the places."""
    powers = _POWERS if length == LENGTH else mixed64(np.arange(1_000, 1_000 + 2 * length, dtype=np.uint64)).reshape(2, length) | np.uint64(1)
    out = np.empty((2, len(at)), np.uint64)
    if len(at):
        strings = np.lib.stride_tricks.sliding_window_view(data, length)
        for k in range(0, len(at), rows):
            values = _BYTE_VALUES[strings[at[k : k + rows]]]
            for j in (0, 1):
                out[j, k : k + rows] = mixed64((values * powers[j]).sum(axis=1, dtype=np.uint64))
    return out[0], out[1]


def hot_slots(keyed: DataFrame, length: int) -> np.ndarray:
    """A bitmap of anchors with many different surroundings, from one document in ``SAMPLED``; at most ``SLOTS`` numbers reach the driver."""

    def probe(batch: pa.RecordBatch):
        data, starts, ends = _concatenated(byte_texts(batch.column(0)))
        _, anchor, context = anchors(data, starts, ends, length)
        columns = [anchor.view(np.int64), context.view(np.int64), slot_of(anchor)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "context", "slot"])

    sample = keyed.where(F.pmod("doc", F.lit(SAMPLED)) == 0).select("text")
    pairs = mapped(sample, probe, "anchor bigint, context bigint, slot bigint", 400).groupBy("anchor", "context").agg(F.min("slot").alias("slot"))
    hot = pairs.groupBy("anchor").agg(F.count("*").alias("k"), F.min("slot").alias("slot")).where(F.col("k") >= HOT).select("slot").distinct()
    bits = np.zeros(SLOTS, bool)
    bits[[r["slot"] for r in hot.collect()]] = True
    return bits


def _concatenated(texts: list[bytes]):
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(texts), np.uint8), ends - sizes, ends


def _packed(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def _unpacked(group: pa.Table, *columns: tuple[str, type]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(x or b"" for x in group[name].to_pylist()), kind) for name, kind in columns]


def _parts(key: np.ndarray):
    order = np.argsort(key, kind="stable")
    ids, at = np.unique(key[order], return_index=True)
    return zip(ids.tolist(), np.split(order, at[1:]), strict=True) if len(ids) else []


def _span_rows(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunks: int) -> list[tuple]:
    """Rows (kind 0, chunk, docs, none, starts, ends) of marked spans, merged within each document."""
    order = np.lexsort((starts, docs))
    docs, starts, ends = docs[order], starts[order], ends[order]
    rows = []
    if len(docs):
        at = np.append(np.flatnonzero(np.append(True, docs[1:] != docs[:-1])), len(docs))
        shift = np.repeat(np.arange(len(at) - 1, dtype=np.int64) << 33, np.diff(at))
        s, e = merged(starts + shift, ends + shift)
        own = docs[at[:-1]][s >> 33]
        s, e = s & ((1 << 33) - 1), e & ((1 << 33) - 1)
        for chunk, i in _parts(np.mod(own, chunks)):
            rows.append((0, chunk, *_packed(own[i]), None, *_packed(s[i].astype(np.int32), e[i].astype(np.int32))))
    return rows


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def order_of(id_col: str) -> Column:
    return F.coalesce(F.expr(f"try_cast(`{id_col}` AS BIGINT)"), F.lit(LOWEST))


def row_of(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col))


def _later(same: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which of sorted entries, ``same`` as the one before or not, come after the first of theirs; equal rows at the same place don't."""
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(same)))) if len(same) else np.arange(0)
    return same & ((doc != doc[lead]) | (place != place[lead]))


def earliest(first: np.ndarray, second: np.ndarray, doc: np.ndarray, number: np.ndarray, place: np.ndarray):
    """``(order, same, later)`` of strings given by two hashes: sorted so that the earliest place of each comes first."""
    order = np.lexsort((place, doc, number, second, first))
    same = np.zeros(len(order), bool)
    same[1:] = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    return order, same, _later(same, doc[order], place[order])


def marked_spans(docs: DataFrame, length: int, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Rows (kind, chunk, docs, ids, starts, ends) of repeated spans, and the number of chunks of documents.

    A document is named by a hash of its id and text (``docs``); ``ids`` give its place in the order."""
    rows = docs.count()
    buckets, chunks = max(8, rows // ROWS_A_BUCKET), max(8, rows // ROWS_A_CHUNK)
    reach = length - GRAM
    keyed = docs.select(order_of(id_col).alias("id"), F.col(text_col).alias("text"), row_of(id_col, text_col).alias("doc"))
    names, binary = ["kind", "chunk", "docs", "ids", "starts", "ends"], "kind int, chunk int, docs binary, ids binary, starts binary, ends binary"
    out_kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    hot = docs.sparkSession.sparkContext.broadcast(np.packbits(hot_slots(keyed, length)))

    def emit(batch: pa.RecordBatch):
        """Anchors by bucket; of equal anchors and surroundings in a batch the first only, the others are spans."""
        data, starts, ends = _concatenated(byte_texts(batch.column(1)))
        ids, own = (batch.column(k).to_numpy() for k in (0, 2))
        at, anchor, context = anchors(data, starts, ends, length)
        text = np.searchsorted(ends, at, side="right")
        place, doc, number = at - starts[text], own[text], ids[text]
        order = np.lexsort((place, doc, number, context, anchor))
        place, doc, number, anchor, context, text = (x[order] for x in (place, doc, number, anchor, context, text))
        same = np.zeros(len(order), bool)
        same[1:] = (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])
        later = _later(same, doc, place)
        size = (ends - starts)[text]
        spans = _span_rows(doc[later], np.maximum(place[later] - reach, 0), np.minimum(place[later] + length, size[later]), 1)
        rows = [(0, int(anchor[0] % np.uint64(buckets)), None, None, *r[2:]) for r in spans]
        known = np.unpackbits(hot.value)[slot_of(anchor)] > 0
        rows += spread(data, starts, ends, own, ids, (starts[text] + place)[known & ~same], text[known & ~same])
        cold = ~same & ~known
        anchor, context, doc, number, place, size = (x[cold] for x in (anchor, context, doc, number, place, size))
        room = np.minimum(size - place, length)
        for bucket, i in _parts((anchor % np.uint64(buckets)).astype(np.int64)):
            short = (anchor[i] >> np.uint64(32)).astype(np.uint32)
            rows.append((1, bucket, *_packed(short, context[i], doc[i], number[i], place[i].astype(np.int32), room[i].astype(np.int32))))
        made = _table(rows, ["kind", "bucket", "anchors", "contexts", "docs", "ids", "starts", "ends"], [pa.int32(), pa.int32(), *[pa.binary()] * 6])
        yield from made.to_batches()

    def spread(data, starts, ends, own, ids, at, text) -> list[tuple]:
        """Rows of kind 2: the strings about hot anchors by hash, the first of each in the batch; the others are spans."""
        low, high = np.maximum(at - reach, starts[text]), np.minimum(at, ends[text] - length)
        fit = high >= low
        sizes = (high - low + 1)[fit]
        begin = np.repeat(low[fit] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        begin, one = np.unique(begin, return_index=True)
        text = np.repeat(text[fit], sizes)[one]
        first, second = string_hashes(data, begin, length)
        doc, number, place = own[text], ids[text], begin - starts[text]
        order, same, later = earliest(first, second, doc, number, place)
        first, second, doc, number, place = (x[order] for x in (first, second, doc, number, place))
        spans = _span_rows(doc[later], place[later], place[later] + length, 1)
        rows = [(0, int(first[0] % np.uint64(buckets)), None, None, *r[2:]) for r in spans]
        first, second, doc, number, place = (x[~same] for x in (first, second, doc, number, place))
        for bucket, i in _parts((first % np.uint64(buckets)).astype(np.int64)):
            rows.append((2, bucket, *_packed(first[i], second[i], doc[i], number[i], place[i].astype(np.int32)), None))
        return rows

    def meet(group: pa.Table) -> pa.Table:
        kinds = np.array(group["kind"].to_pylist())
        given = group.filter(pa.array(kinds == 0))
        found = [_unpacked(given, ("docs", np.int64), ("starts", np.int32), ("ends", np.int32))]
        first, second, doc, number, place = _unpacked(
            group.filter(pa.array(kinds == 2)), ("anchors", np.uint64), ("contexts", np.uint64), ("docs", np.int64), ("ids", np.int64), ("starts", np.int32)
        )
        order, _, later = earliest(first, second, doc, number, place)
        doc, place = doc[order][later], place[order][later]
        found.append([doc, place, place + length])
        anchor, context, doc, number, place, room = _unpacked(
            group.filter(pa.array(kinds == 1)), ("anchors", np.uint32), ("contexts", np.uint64), ("docs", np.int64), ("ids", np.int64), ("starts", np.int32), ("ends", np.int32)
        )
        order = np.lexsort((place, doc, number, context, anchor))
        anchor, context, doc, number, place, room = (x[order] for x in (anchor, context, doc, number, place, room))
        same = np.zeros(len(order), bool)
        same[1:] = (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])
        later = _later(same, doc, place)
        found.append([doc[later], np.maximum(place[later] - reach, 0), place[later] + room[later]])
        rows = _span_rows(*(np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)), chunks)
        # anchors with several surroundings: one place of each is looked at byte by byte
        anchor, doc, number, place = (x[~same] for x in (anchor, doc, number, place))
        several = np.zeros(len(anchor), bool)
        several[1:] |= anchor[1:] == anchor[:-1]
        several[:-1] |= anchor[1:] == anchor[:-1]
        bucket = group["bucket"][0].as_py()
        anchor, doc, number, place = (x[several] for x in (anchor, doc, number, place))
        part = (np.full(len(doc), bucket, np.int64) << 32) + anchor
        for chunk, i in _parts(np.mod(doc, chunks)):
            rows.append((1, chunk, *_packed(doc[i], number[i], place[i], part[i])))
        return _table(rows, names, out_kinds)

    met = written(
        mapped(keyed, emit, "kind int, bucket int, anchors binary, contexts binary, docs binary, ids binary, starts binary, ends binary", 400)
        .groupBy("bucket").applyInArrow(meet, binary),
        "met",
    )

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = dict(zip(left["doc"].to_pylist(), byte_texts(left["text"]), strict=True)) if left.num_rows else {}
        doc, number, place, part = _unpacked(right, ("docs", np.int64), ("ids", np.int64), ("starts", np.int32), ("ends", np.int64))
        rows = []
        for bucket, i in _parts(part >> 32):
            begin = np.maximum(place[i] - reach, 0)
            pieces = [texts.get(d, b"")[s : p + length] for d, s, p in zip(doc[i].tolist(), begin.tolist(), place[i].tolist(), strict=True)]
            sizes = np.array([len(x) for x in pieces], np.int32)
            anchor = (part[i] & 0xFFFFFFFF).astype(np.uint32)
            rows.append((bucket, *_packed(anchor, doc[i], number[i], begin.astype(np.int32), sizes), b"".join(pieces)))
        return _table(rows, ["bucket", "anchors", "docs", "ids", "starts", "sizes", "data"], [pa.int32(), *[pa.binary()] * 6])

    chunked = keyed.select("doc", "text", F.pmod("doc", F.lit(chunks)).cast("int").alias("chunk"))
    gathered = chunked.groupBy("chunk").cogroup(met.where("kind = 1").groupBy("chunk")).applyInArrow(
        gather, "bucket int, anchors binary, docs binary, ids binary, starts binary, sizes binary, data binary"
    )

    def index(group: pa.Table) -> pa.Table:
        """Equal strings have equal anchors, so a bucket is indexed in parts of whole anchors, of about ``INDEX_BYTES`` each."""
        anchor, docs_, numbers, begins, sizes = _unpacked(group, ("anchors", np.uint32), ("docs", np.int64), ("ids", np.int64), ("starts", np.int32), ("sizes", np.int32))
        order = np.lexsort((docs_, numbers))
        ranks = np.empty(len(order), np.int64)
        ranks[order] = np.cumsum(np.append(True, docs_[order][1:] != docs_[order][:-1])) if len(order) else order
        data = b"".join(group["data"].to_pylist())
        at = np.cumsum(sizes, dtype=np.int64) - sizes
        found = []
        for _, i in _parts((anchor % np.uint32(1 + len(data) // INDEX_BYTES)).astype(np.int64)):
            doc, begin, size = docs_[i], begins[i], sizes[i].astype(np.int64)
            built = RunLengthIndex([data[a : a + s] for a, s in zip(at[i].tolist(), size.tolist(), strict=True)])
            rank = ranks[i]
            owner = np.repeat(np.arange(len(i)), size + 1)
            where = begin[owner] + np.arange(len(owner)) - built.starts[owner]
            marked = built.repeats(length, (rank[owner] << 32) + where)
            found.append((doc[owner[marked]], where[marked], where[marked] + length))
        spans = [np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)]
        return _table(_span_rows(*spans, chunks) if found else [], names, out_kinds)

    indexed = gathered.groupBy("bucket").applyInArrow(index, binary)
    return met.where("kind = 0").unionByName(indexed), chunks


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, kept`` (the bytes left), ``n_bytes, n_removed, n_spans`` of each document."""
    kind = docs.schema[id_col].dataType.simpleString()
    spans, chunks = marked_spans(docs, length, id_col, text_col)
    key = row_of(id_col, text_col)
    dealt = docs.select(
        F.pmod(key, F.lit(chunks)).cast("int").alias("chunk"), key.alias("id"), F.col(id_col).alias("own_id"), F.col(text_col).alias("text")
    )

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        doc, start, end = _unpacked(right, ("docs", np.int64), ("starts", np.int32), ("ends", np.int32))
        by_doc = {int(doc[i[0]]): i for _, i in _parts(doc)}
        rows = []
        ids = left["id"].to_pylist() if left.num_rows else []
        for d, text in zip(ids, byte_texts(left["text"]) if ids else [], strict=True):
            kept, s = [text], np.empty(0, np.int64)
            if d in by_doc:
                i = by_doc[d]
                s, e = merged(start[i].astype(np.int64), end[i].astype(np.int64))
                s, e = s[s < len(text)], np.minimum(e[s < len(text)], len(text))
                edges = [0, *np.column_stack([s, e]).ravel().tolist(), len(text)]
                kept = [text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
            kept = b"".join(kept)
            rows.append((kept, len(text), len(text) - len(kept), len(s)))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        own = left["own_id"] if left.num_rows else pa.array([], left.schema.field("own_id").type)
        return pa.table({id_col: own, **{n: pa.array(c, k) for n, c, k in zip(("kept", "n_bytes", "n_removed", "n_spans"), columns, kinds, strict=True)}})

    return dealt.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(
        cut, f"`{id_col}` {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
