"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two halves.  Two fingerprints that differ in at
most three bits have a half that differs in at most one, so they share the exact
half or that half with one bit left out.  Every distinct fingerprint is indexed
under its 2 x (1 + 32) such keys; rows that meet under a key are verified on all
64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.llm.components import components
from pitwall.session import materialise

HALF = 32
#: Members of one index key that are compared in one go; larger keys are cut by
#: a byte of the other half and dealt again.
KEY_ROWS = 20_000
EDGES = "u long, v long, cut long"


def shingles(text: str | None, width: int) -> Iterator[np.ndarray]:
    """XXH64 hashes of all word shingles of a whole text, in parts (see ``fingerprints``)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both only touch ASCII
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    for at in range(0, len(starts), 65_536):
        yield np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + 65_536], ends[at:at + 65_536])], dtype=np.uint64)


def majority(hashes: Iterable[np.ndarray]) -> int:
    """Signed fingerprint: the bits that more than half of the hashes have."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for h in hashes:
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def simhash(text: str | None, width: int = 3) -> int:
    """Signed 64-bit fingerprint of a whole text (see ``fingerprints``)."""
    return majority(shingles(text, width))


@F.pandas_udf(T.LongType())
def _simhashes(texts: pd.Series) -> pd.Series:
    return pd.Series([simhash(t) for t in texts], dtype="int64")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): majority bits of the XXH64 hashes of all word 3-shingles.

    Words are runs of other characters than ASCII white space, A-Z lower-cased;
    a text with fewer than three words is one shingle, one without words (or
    NULL) has fingerprint zero.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), _simhashes(F.col(text)).alias("fp"))


def _keys(fps: DataFrame) -> DataFrame:
    """(key, fp): 33 keys for each half, one exact and one for each left-out bit."""
    halves = (F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", HALF))
    keys = []
    for s, half in enumerate(halves):
        for bit in range(HALF + 1):
            masked = half if bit == HALF else half.bitwiseAND(F.lit(0xFFFFFFFF & ~(1 << bit)))
            keys.append(masked.bitwiseOR(F.lit((s * (HALF + 1) + bit) << HALF)))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _forest(fps: np.ndarray, side: np.ndarray | None, bits: int) -> tuple[list, list]:
    """Links that connect whatever is within ``bits`` of each other (and on
    different sides, if sides are given): a spanning forest, not all pairs."""
    left, right = [], []
    rest = np.arange(len(fps))
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            at = stack.pop()
            near = np.bitwise_count(fps[rest] ^ fps[at]) <= bits
            if side is not None:
                near &= side[rest] != side[at]
            found = rest[near]
            left += [fps[at]] * len(found)
            right += fps[found].tolist()
            rest = rest[~near]
            stack += found.tolist()
    return left, right


def _left_out(key: int) -> int | None:
    """The bit that an index key leaves out, None for a key on a whole half."""
    half, bit = divmod(key >> HALF, HALF + 1)
    return None if bit == HALF else half * HALF + bit


def _group_links(key: int, fps: np.ndarray, bits: int) -> tuple[list, list]:
    """Verified links among the fingerprints under one key.  Under a key with a
    left-out bit only pairs that differ in it: the others share the whole half."""
    bit = _left_out(key)
    side = None if bit is None else (fps >> np.uint64(bit)) & np.uint64(1)
    if side is not None and (side == side[0]).all():
        return [], []
    if len(fps) == 2:
        near = int(fps[0] ^ fps[1]).bit_count() <= bits
        return ([fps[0]], [fps[1]]) if near else ([], [])
    return _forest(fps, side, bits)


def _linker(bits: int, key_rows: int | None):
    """Maps batches (key, part, fp) sorted by key and part to links, and for keys
    above ``key_rows`` to rows (fp, NULL, key) that have to be cut finer."""

    def batch_of(u: list, v: list, cut: list) -> pa.RecordBatch:
        n, m = len(u), sum(len(f) for _, f in cut)
        signed = lambda x: np.array(x, dtype=np.uint64).view(np.int64)
        late = np.arange(n + m) >= n
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([signed(u), *[f.view(np.int64) for _, f in cut]])),
            pa.array(np.concatenate([signed(v), np.zeros(m, np.int64)]), mask=late),
            pa.array(np.concatenate([np.zeros(n, np.int64), *[np.full(len(f), k) for k, f in cut]]), mask=~late),
        ], names=["u", "v", "cut"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        carry, hot = (empty, empty, empty.view(np.uint64)), None
        last = False
        source = iter(batches)
        while not last:
            batch = next(source, None)
            last = batch is None
            u, v, cut = [], [], []
            if last:
                keys, parts, fps = carry
                whole = len(keys)
            else:
                keys, parts, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                fps = fps.view(np.uint64)
                if hot is not None:  # more rows of a key that was found too large
                    n = int(np.searchsorted(keys, hot, "right"))
                    cut.append((hot, fps[:n]))
                    keys, parts, fps = keys[n:], parts[n:], fps[n:]
                    hot = hot if not len(keys) else None
                keys, parts, fps = (np.concatenate(x) for x in zip(carry, (keys, parts, fps)))
                same = (keys == keys[-1:]) & (parts == parts[-1:])
                whole = len(keys) - int(same.sum())
                carry = keys[whole:], parts[whole:], fps[whole:]
                if key_rows and len(carry[0]) > key_rows:
                    hot = int(keys[-1])
                    cut.append((hot, carry[2]))
                    carry = tuple(x[:0] for x in carry)
            if whole:
                keys, parts, fps = keys[:whole], parts[:whole], fps[:whole]
                first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1]))))
                size = np.diff(np.concatenate((first, [whole])))
                for i, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
                    if key_rows and n > key_rows:
                        cut.append((int(keys[i]), fps[i:i + n]))
                        continue
                    a, b = _group_links(int(keys[i]), fps[i:i + n], bits)
                    u += a
                    v += b
            if u or cut:
                yield batch_of(u, v, cut)

    return link


def links(fps: DataFrame, bits: int = 3, key_rows: int = KEY_ROWS) -> DataFrame:
    """(u, v): links between distinct fingerprints (column ``fp``) at ``bits``
    (at most 3) or fewer differing bits that connect all such pairs.

    Under each key a spanning forest of the verified links is kept, so a dense
    group of n fingerprints yields up to n - 1 links a key instead of all pairs.
    A key with more than ``key_rows`` members is dealt again by one byte of the
    other half (three differing bits leave one of its four bytes equal), so that
    a task compares at most the values of three bytes.
    """
    found = materialise(_keys(fps).select("key", F.lit(0).cast("long").alias("part"), "fp").repartition("key")
                        .sortWithinPartitions("key").mapInArrow(_linker(bits, key_rows), EDGES))
    edges = found.filter("cut is null").select("u", "v")
    cut = found.filter("cut is not null").select(F.col("cut").alias("key"), F.col("u").alias("fp"))
    if cut.isEmpty():
        return edges
    half = F.shiftright("key", HALF) >= HALF + 1
    other = F.when(half, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", HALF))
    parts = F.array(*[F.shiftright(other, 8 * i).bitwiseAND(F.lit(255)) + F.lit(256 * i).cast("long") for i in range(4)])
    finer = (cut.select("key", F.explode(parts).alias("part"), "fp").repartition("key", "part")
             .sortWithinPartitions("key", "part").mapInArrow(_linker(bits, None), EDGES))
    return edges.unionByName(finer.select("u", "v"))


def near_duplicates(docs: DataFrame, bits: int = 3, key_rows: int = KEY_ROWS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable
    over fingerprints that differ in ``bits`` or fewer bits.

    Equal fingerprints are one node, so copies are never paired.  NULL text and
    texts without words share fingerprint zero and link like any other.  A NULL
    doc_id keeps its row and is never a component's id unless all its members
    are NULL.  Repeated rows give repeated rows.
    """
    prints = materialise(fingerprints(docs))
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = materialise(components(links(nodes.select("fp"), bits, key_rows)))
    linked = roots.join(nodes, roots["node"] == nodes["fp"]).select("fp", "root", "rep")
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    labels = linked.join(least, "root").select("fp", "least")
    label = nodes.join(labels, "fp", "left").select("fp", F.coalesce("least", "rep").alias("component_id"))
    return prints.join(label, "fp").select("doc_id", "fp", "component_id")


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the fingerprint in place of the text, a few texts at a time."""
    for batch in batches:
        text, fps = batch.column("text"), []
        for at in range(0, len(text), 256):
            fps += [simhash(t) for t in text.slice(at, 256).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps, pa.int64())], names=["unnamed", "named", "digest", "fp"])


def drop_near_duplicates(docs: DataFrame, bits: int = 3) -> DataFrame:
    """The rows of ``docs`` that stand for their component: of each, the one with the
    smallest doc_id (of several texts under it, the one with the smallest digest).

    Repeated rows of it stay once.  A NULL doc_id comes after all others.
    """
    marked = docs.withColumn("__digest", F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()))
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("named"), F.col("__digest").alias("digest"))
    prints = materialise(marked.select(named.alias("row"), "text").select("row.*", "text").mapInArrow(
        _prints, "unnamed boolean, named long, digest long, fp long"))
    nodes = materialise(prints.select("fp").distinct())
    root = components(links(nodes, bits))
    # a fingerprint without links is its own root
    home = nodes.join(root, nodes["fp"] == root["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    first = prints.join(home, "fp").groupBy("root", "unnamed", "named", "digest").agg(F.count(F.lit(1)).alias("n"))
    stays = materialise(first.groupBy("root").agg(F.min(F.struct("unnamed", "named", "digest", "n")).alias("s")).select(
        *[F.col(f"s.{c}").alias(f"__{c}1") for c in ("unnamed", "named", "digest", "n")]))
    same = ((F.col("doc_id").isNull() == F.col("__unnamed1")) & (F.coalesce("doc_id", F.lit(0)) == F.col("__named1"))
            & (F.col("__digest") == F.col("__digest1")))
    kept = marked.join(stays, same)
    if stays.where("__n1 > 1").isEmpty():  # no row that stays is repeated, so texts need no second sort
        return kept.select(docs.columns)
    once, again = kept.where("__n1 = 1"), kept.where("__n1 > 1").dropDuplicates(["doc_id", "__digest"])
    return once.unionByName(again).select(docs.columns)
