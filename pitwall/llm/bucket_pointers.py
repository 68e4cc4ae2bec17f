"""Removal of byte strings that repeat across documents, by bucket-pointer refinement.

Suffixes fall into buckets by a q-gram.  A bucket is refined by the bucket
identifiers of the same suffixes at later offsets, and identifiers made that way
serve the next refinement: the one of 2n bytes at p comes from those of n bytes
at p and p + n, so 32 bytes need five rounds, and the identifiers at p and
p + 18 decide 50 bytes.  Identifiers are hashes of their bytes, so tasks agree on
them without a global rank; 96 bits decide whether two strings are equal.

Not every suffix has to travel.  Each 50-byte string picks one of the 32-grams in
it by a rule on its bytes alone, equal strings pick alike, and neighbouring
strings mostly share the pick.  A run of neighbours with one pick is one suffix:

1. runs go to the bucket of their 32-gram; a bucket that one text alone has is done;
2. equal runs settle as a whole: the smallest doc_id owns them, the others lose them;
3. different runs in one bucket are refined string by string, by (identifier at p, identifier at p + 18).

Tasks combine their own rows before each shuffle, so one bucket sends at most a
few rows a task.  Rows travel as sorted columns of bytes, which compress.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.session import materialise

LENGTH = 50
#: Bytes that a task hashes at a time, and rows it combines before it sends them.
PIECE, FLUSH = 1 << 21, 1 << 20
#: Bytes of text whose buckets make one part of a shuffle.
PART_BYTES = 32 << 20
#: Buckets with this many own runs in a task are refined without asking the others.
MANY = 16

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_LOW = _U((1 << 24) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31))
    x = x * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _U(_ODD))


def _power(n: int) -> np.uint64:
    return _U(pow(_ODD, n, 1 << 64))


class Shape:
    """The lengths that follow from the length of a string: its gram, the later offset, and the pick."""

    def __init__(self, length: int):
        if length < 8:
            raise ValueError("strings need 8 bytes or more")
        self.length = length
        self.gram = 1 << (length.bit_length() - 1)
        self.gram = self.gram // 2 if self.gram == length else self.gram
        self.later = length - self.gram
        self.picks = self.later + 1
        self.key = self.gram % self.picks
        while self.key < min(4, self.gram):
            self.key += self.picks
        self.key = min(self.key, self.gram)


def identifiers(data: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """Identifiers of the strings of each width at all positions, by doubling."""
    level, n, made, out = _BYTES[data], 1, {}, {}
    while True:
        for w in set(widths):
            if w & n:  # the next binary digit of w, in front of what the smaller ones made
                if w not in made:
                    made[w] = (level, n)
                else:
                    tail, m = made[w]
                    size = max(0, len(data) - n - m + 1)
                    made[w] = (level[:size] * _power(m) + tail[n:n + size], n + m)
        if n * 2 > max(widths) or len(level) <= n:
            break
        level, n = level[:-n] * _power(n) + level[n:], n * 2
    for w in widths:
        out[w] = made[w][0] if w in made and made[w][1] == w else np.zeros(0, np.uint64)
    return [out[w] for w in widths]


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    n = 1
    while n * 2 <= width:
        v, n = np.minimum(v[:-n], v[n:]), n * 2
    return v if n == width else np.minimum(v[:len(v) - (width - n)], v[width - n:])


class Runs:
    """Runs of neighbouring strings with one pick in a piece of bytes.

    ``first`` and ``last`` are the positions of a run's first and last string,
    ``doc`` the number of its text in the piece, ``bucket`` and ``key`` 48 bits each.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, shape: Shape):
        n, s = len(data), shape
        starts = np.concatenate(([0], ends[:-1]))
        open_ = np.zeros(n + 1, np.int8)
        whole = ends - starts >= s.length
        np.add.at(open_, starts[whole], 1)
        np.add.at(open_, ends[whole] - s.length + 1, -1)
        here = np.cumsum(open_[:n], dtype=np.int8) > 0
        if not whole.any():
            self.first = self.last = self.doc = np.zeros(0, np.int64)
            self.bucket = self.key = self.code = self.ids = np.zeros(0, np.uint64)
            return
        self.ids, order = identifiers(data, (s.gram, s.key))
        order = (_mix(order) & ~_LOW) | np.arange(len(order), dtype=np.uint64)
        place = np.arange(n - s.length + 1)
        pick = (_least(order, s.length - s.key + 1) & _LOW).astype(np.int64)
        pick = place + (pick - place) % s.picks
        here = here[:len(place)]
        fresh = here.copy()
        fresh[1:] &= ~here[:-1] | (pick[1:] != pick[:-1])
        edge = fresh.copy()
        edge[1:] |= here[:-1] & ~here[1:]
        edges = np.append(np.flatnonzero(edge), len(place))
        self.first = np.flatnonzero(fresh)
        self.last = edges[np.searchsorted(edges, self.first, "right")] - 1
        self.doc = np.searchsorted(ends, self.first, "right")
        i, a, b, later = self.ids, self.first, self.last, s.later
        key = _mix(i[a]) + i[a + later]
        key = _mix(key) + i[b]
        key = _mix(key) + i[b + later] + (b - a).astype(np.uint64)
        self.bucket, self.key = i[pick[a]] >> _U(16), _mix(key) >> _U(16)
        self.code = both(self.bucket, self.key)

    def strings(self, chosen: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(position, run, identifier at it, identifier at the later offset) of each string of the chosen runs."""
        size = self.last[chosen] - self.first[chosen] + 1
        run = np.repeat(np.flatnonzero(chosen), size)
        before = np.repeat(np.cumsum(size) - size, size)
        at = self.first[run] + np.arange(len(run)) - before
        return at, run, self.ids[at] >> _U(16), self.ids[at + shape.later] >> _U(16)


def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for two identifiers."""
    return _mix(_mix(a * _U(_ODD)) + b)


# ------------------------------------------------------------ texts of a batch

def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets) of a string column."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(start in the data, rows, ends) of pieces of bounded size: whole texts, or parts
    of one long text that overlap by a string less a byte.  A text is cut at the same
    places wherever it stands."""
    rows, ends, start = [], [], 0
    for i in range(len(offsets) - 1):
        a, b = int(offsets[i]), int(offsets[i + 1])
        if b - a > PIECE or (rows and b - start > PIECE):
            if rows:
                yield start, np.array(rows), np.array(ends)
            rows, ends = [], []
        if b - a > PIECE:
            for at in range(a, b - length + 1, PIECE):
                stop = min(b, at + PIECE + length - 1)
                yield at, np.array([i]), np.array([stop - at])
        else:
            start = a if not rows else start
            rows.append(i)
            ends.append(b - start)
    if rows:
        yield start, np.array(rows), np.array(ends)


def _all_runs(batch: pa.RecordBatch, shape: Shape) -> Iterator[tuple[int, np.ndarray, Runs]]:
    data, offsets = _bytes_of(batch.column("text"))
    for start, rows, ends in _pieces(data, offsets, shape.length):
        yield start, rows, Runs(data[start:start + int(ends[-1])], ends, shape)


def _among(docs: np.ndarray, codes: np.ndarray, lists: pa.ListArray, rows: np.ndarray) -> np.ndarray:
    """Which codes are in the list of their row."""
    held = [lists.slice(int(r), 1).flatten() for r in rows]
    size = np.array([len(h) for h in held])
    if not size.sum():
        return np.zeros(len(codes), bool)
    known = np.concatenate([h.to_numpy(zero_copy_only=False) for h in held]).view(np.uint64)
    return np.isin(both(docs.astype(np.uint64) + _U(1), codes), both(np.repeat(np.arange(len(rows)), size).astype(np.uint64) + _U(1), known))


# ------------------------------------------------------------ columns of bytes

def _pack(values: np.ndarray, width: int) -> bytes:
    """Numbers below 256 ** width as columns of bytes, highest first."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:].T.tobytes()


def _unpack(packed: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(packed) // width, 8), np.uint8)
    wide[:, 8 - width:] = np.frombuffer(packed, np.uint8).reshape(width, -1).T
    return wide.reshape(-1).view(">u8").astype(np.uint64)


#: Parts of the shuffle tables: entries (head, tail, doc), heads that are shared for sure, and lists of (code, doc) that are known already.
_SENT = "part int, kind int, head binary, tail binary, doc binary"
_ENTRY, _SHARED, _LOST, _REFINE = range(4)
_FOUND = "doc_id long, code long, kind int"


def _send(parts: int, kind: int, head: np.ndarray, tail: np.ndarray, doc: np.ndarray) -> list[tuple]:
    """Rows of heads in ascending order, cut by the leading bits of the head."""
    part = ((head >> _U(16)).astype(np.int64) * parts) >> 32
    cuts = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(part)) if len(part) else np.zeros(1, int)
    return [(int(part[a]), kind, _pack(head[a:b], 6), _pack(tail[a:b], 6) if len(tail) else b"", _pack(doc[a:b].view(np.uint64), 8) if len(doc) else b"")
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _known(parts: int, kind: int, code: np.ndarray, doc: np.ndarray) -> list[tuple]:
    if not len(code):
        return []
    order = np.argsort(doc, kind="stable")
    code, doc = code[order], doc[order]
    # any part will do: what is known passes through
    return [(int(doc[a] % parts), kind, _pack(code[a:a + 65_536], 8), b"", _pack(doc[a:a + 65_536].view(np.uint64), 8))
            for a in range(0, len(code), 65_536)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["part", "kind", "head", "tail", "doc"])


def _sorted_buckets(head: np.ndarray, tail: np.ndarray, doc: np.ndarray):
    """Entries in the order of (head, tail, doc), equal ones once; also where heads and pairs begin."""
    order = np.argsort(head, kind="stable")
    head, tail, doc = head[order], tail[order], doc[order]
    same = np.zeros(len(head), bool)
    same[1:] = head[1:] == head[:-1]
    many = same.copy()
    many[:-1] |= same[1:]
    at = np.flatnonzero(many)  # only buckets with company need the finer order
    fine = np.lexsort((doc[at], tail[at], head[at]))
    tail[at], doc[at] = tail[at][fine], doc[at][fine]
    new_head = ~same
    new_pair = new_head.copy()
    new_pair[1:] |= tail[1:] != tail[:-1]
    keep = new_pair.copy()
    keep[1:] |= doc[1:] != doc[:-1]
    return head[keep], tail[keep], doc[keep], new_head[keep], new_pair[keep]


def _refined(head, tail, doc, shared=None, least=MANY):
    """(lost, shared): entries whose pair a smaller document has, and owners of a pair in a
    bucket with other pairs of another document, more than ``least`` pairs, or a head in ``shared``."""
    head, tail, doc, new_head, new_pair = _sorted_buckets(head, tail, doc)
    if not len(head):
        none = np.zeros(0, bool)
        return head, tail, doc, none, none, new_head
    bucket = np.cumsum(new_head) - 1
    pairs = np.bincount(bucket, weights=new_pair).astype(np.int64)
    edges = np.flatnonzero(new_head)
    low, high = np.minimum.reduceat(doc, edges), np.maximum.reduceat(doc, edges)
    busy = (pairs > 1) & ((low < high) | (pairs > least))
    if shared is not None and len(shared):
        busy |= np.isin(head[edges], shared)
    return head, tail, doc, ~new_pair, new_pair & busy[bucket], new_head


def _send_runs(shape: Shape, parts: int):
    """Texts to entries of their runs, combined in the task."""

    def flush(held: list) -> pa.RecordBatch:
        head, tail, doc = (np.concatenate([h[i] for h in held]) for i in range(3))
        head, tail, doc, lost, busy, new_head = _refined(head, tail, doc)
        code = both(head, tail)
        quiet = ~lost & ~busy
        rows = _send(parts, _ENTRY, head[quiet], tail[quiet], doc[quiet])
        rows += _send(parts, _SHARED, np.unique(head[busy]), head[:0], doc[:0])
        rows += _known(parts, _LOST, code[lost], doc[lost]) + _known(parts, _REFINE, code[busy], doc[busy])
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for _, rows, runs in _all_runs(batch, shape):
                if len(runs.first):
                    held.append((runs.bucket, runs.key, ids[rows[runs.doc]]))
                    size += len(runs.first)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _send_strings(shape: Shape, parts: int):
    """Texts with runs to refine to entries of their strings, combined in the task."""

    def flush(held: list) -> pa.RecordBatch:
        head, tail, doc, _, new_pair = _sorted_buckets(*(np.concatenate([h[i] for h in held]) for i in range(3)))
        rows = _send(parts, _ENTRY, head[new_pair], tail[new_pair], doc[new_pair])
        rows += _known(parts, _LOST, both(head, tail)[~new_pair], doc[~new_pair])
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for _, rows, runs in _all_runs(batch, shape):
                if not len(runs.first):
                    continue
                chosen = _among(runs.doc, runs.code, batch.column("refine"), rows)
                _, run_, now, later = runs.strings(chosen, shape)
                held.append((now, later, ids[rows[runs.doc[run_]]]))
                size += len(now)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _receive(refine: bool):
    """Parts to (doc_id, code, kind): what is lost for sure, and (``refine``) what has to be refined."""

    def found(code, doc, kind) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(code.view(np.int64)), pa.array(np.full(len(doc), kind, np.int32))],
                                          names=["doc_id", "code", "kind"])

    def settle(held, shared) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        head, tail, doc = (np.concatenate([h[i] for h in held]) for i in range(3))
        head, tail, doc, lost, busy, _ = _refined(head, tail, doc, np.concatenate(shared) if shared else None, 1 << 62)
        code = both(head, tail)
        if lost.any():
            yield found(code[lost], doc[lost], _LOST)
        if refine and busy.any():
            yield found(code[busy], doc[busy], _REFINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, shared = None, [], []
        for batch in batches:
            for part, kind, head, tail, doc in zip(*(c.to_pylist() for c in batch.columns)):
                if kind in (_LOST, _REFINE):
                    yield found(_unpack(head, 8), _unpack(doc, 8).view(np.int64), kind)
                    continue
                if part != now:
                    yield from settle(held, shared)
                    now, held, shared = part, [], []
                if kind == _SHARED:
                    shared.append(_unpack(head, 6))
                else:
                    held.append((_unpack(head, 6), _unpack(tail, 6), _unpack(doc, 8).view(np.int64)))
        yield from settle(held, shared)

    return run


_KEPT = "doc_id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a few pieces at a time."""
    _, offsets = _bytes_of(batch.column("text"))
    at = 0
    while at < len(batch):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 4 * PIECE, "right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop


def _gone(batch: pa.RecordBatch, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, which bytes go) of texts that lose some."""
    data, offsets = _bytes_of(batch.column("text"))
    cover = np.zeros(len(data) + 1, np.int32)
    for start, rows, runs in _all_runs(batch, shape):
        if not len(runs.first):
            continue
        lost = _among(runs.doc, runs.code, batch.column("lost"), rows)
        open_ = ~lost & _among(runs.doc, runs.code, batch.column("refine"), rows)
        np.add.at(cover, start + runs.first[lost], 1)
        np.add.at(cover, start + runs.last[lost] + shape.length, -1)
        at, run_, now, later = runs.strings(open_, shape)
        at = at[_among(runs.doc[run_], both(now, later), batch.column("strings"), rows)]
        np.add.at(cover, start + at, 1)
        np.add.at(cover, start + at + shape.length, -1)
    return data, offsets, np.cumsum(cover[:-1], dtype=np.int32) > 0


def _cut(shape: Shape):
    """Texts with their lost runs and strings to spans and what is left."""

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, gone = _gone(batch, shape)
        spans, left = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone[a:b].view(np.int8), [0]))))
            spans.append([{"start": int(x), "length": int(y - x)} for x, y in zip(edge[::2], edge[1::2])])
            left.append(data[a:b][~gone[a:b]].tobytes())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(spans, _SPANS), pa.array(left, pa.binary())],
                                          names=["doc_id", "n_bytes", "spans", "kept"])

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column("text")
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(_bytes_of(text)[1])), pa.array([[]] * len(batch), _SPANS),
                                           text.cast(pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                touched = part.column("touched")
                for mask, made in ((touched, kept), (pa.compute.invert(touched), whole)):
                    rows = part.filter(mask)
                    if len(rows):
                        yield made(rows)

    return run


def _lists(found: DataFrame, doc: str, **kinds: int) -> DataFrame:
    """Codes of each document as one array a kind; a document has no more of them than its text has runs."""
    return found.groupBy(F.col("doc_id").alias(doc)).agg(*[
        F.collect_set(F.when(F.col("kind") == k, F.col("code"))).alias(name) for name, k in kinds.items()])


def remove_repeats(docs: DataFrame, length: int = LENGTH, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of ``docs``.

    Texts are UTF-8 bytes, NULL is empty.  A byte is removed if a string of
    ``length`` bytes covers it that also starts in a document with a smaller
    doc_id; ``spans`` are the maximal removed runs (start, length) and ``kept``
    the other bytes.  Rows that share a doc_id are one document, so they never
    cost each other bytes, whatever their texts.  A row with a NULL doc_id is
    neither smaller nor larger than any other and stays whole.
    """
    shape = Shape(length)
    clean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = clean.where("doc_id is not null")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))

    def meet(sent: DataFrame, refine: bool) -> DataFrame:
        return sent.repartition("part").sortWithinPartitions("part").mapInArrow(_receive(refine), _FOUND)

    runs = materialise(meet(named.mapInArrow(_send_runs(shape, parts), _SENT), True))
    lists = _lists(runs, "d", lost=_LOST, refine=_REFINE)
    joined = named.join(lists, F.col("doc_id") == F.col("d"), "left").drop("d")
    strings = meet(joined.where(F.size("refine") > 0).mapInArrow(_send_strings(shape, parts), _SENT), False)
    ready = joined.join(_lists(strings, "d", strings=_LOST), F.col("doc_id") == F.col("d"), "left").drop("d").withColumn(
        "touched", F.coalesce(F.size("lost") > 0, F.lit(False)) | F.coalesce(F.size("strings") > 0, F.lit(False)))
    alone = clean.where("doc_id is null").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start:long,length:long>>").alias("spans"), F.col("text").cast("binary").alias("kept"))
    return ready.mapInArrow(_cut(shape), _KEPT).unionByName(alone)
