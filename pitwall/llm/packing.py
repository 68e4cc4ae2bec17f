"""Best-fit packing of documents into sequences, by partitions and then up a tree.

Each task packs the pieces of its own partition best-fit.  Bins with little room
left are done; the others go on as items, in fewer and larger groups each round,
until a round no longer saves a bin worth speaking of.  A group never holds more
than ``group_rows`` items, so no task grows with the data.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.session import materialise

CAPACITY = 1024
END_ID = 2
#: Tokens that a finished bin may leave unused.
SLACK = 2
#: Items that one task packs in a later round.
GROUP_ROWS = 200_000
#: A round that saves a smaller share of its bins is the last one.
LEAST_GAIN = 0.002

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACES = PIECES + ", bin long, offset long, filled long"


#: Fixed value: the pattern of byte-level tokenizer files that split "with regex".
#: Runs of one kind are possessive, as nothing follows them that they could give back to.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"""


def _letters_to_bytes() -> dict[str, int]:
    """How byte-level tokenizer files spell bytes: visible Latin-1 characters stand
    for themselves, the other bytes in turn for the characters from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def load(path: str):
    """(encoder of texts without special strings, the tokenizer, its special
    strings), one for each Python worker.

    Where the file is plain byte-level BPE whose ids are its merge order, whole
    texts are encoded by tiktoken with the file's own vocabulary, which takes a
    fraction of the tokenizer library's time.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    before, model = described["pre_tokenizer"], described["model"]
    byte_of = _letters_to_bytes()
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model.get("merges", [])]
    in_order = [model["vocab"][m] for m in merges]
    if (before == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
            and described["normalizer"] is None and model["type"] == "BPE" and not model.get("ignore_merges")
            and in_order == sorted(in_order)):
        import tiktoken

        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        own = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return own.encode_ordinary, encode, special
    return encode, encode, special


def token_ids(text: str | None, path: str, end_id: int = END_ID) -> np.ndarray:
    """Ids of the whole text and the end id, as little-endian unsigned 32-bit integers."""
    plain, encode, special = load(path)
    ids = (encode if any(s in (text or "") for s in special) else plain)(text or "")
    return np.append(np.asarray(ids, dtype="<u4"), np.uint32(end_id)).astype("<u4")


def _cutter(path: str, capacity: int, end_id: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch["text"]):
                ids = token_ids(text, path, end_id)
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                row += [i] * (len(cuts) - 1)
                piece += range(len(cuts) - 1)
                start += cuts[:-1]
                length += [b - a for a, b in zip(cuts, cuts[1:])]
                crc += [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").to_numpy()[row], "piece": piece, "start": start,
                                "length": length, "ids_crc32": crc}).astype({"doc_id": "Int64"})

    return cut


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32.  A document
    longer than ``capacity`` is cut into full pieces after a first one that takes
    the rest; NULL texts count as empty and are just the end id."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(_cutter(path, capacity, end_id), PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, filled) of each item: largest first, each into the fullest bin
    that still takes it.  ``bin`` is the index of the bin's first item; ``filled``
    the tokens in the finished bin.  Bins stand in stacks by the room that is left,
    and a bit mask of the stacks in use finds the next one."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use, room = 0, {}
    order = np.argsort(-sizes, kind="stable").tolist()
    for item in order:
        size = int(sizes[item])
        fitting = in_use >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            at = stacks[left].pop()
            if not stacks[left]:
                in_use &= ~(1 << left)
        else:
            at, left = item, capacity
        bins[item], offsets[item] = at, capacity - left
        left -= size
        room[at] = left
        if left:
            stacks[left].append(at)
            in_use |= 1 << left
    filled = np.array([capacity - room[b] for b in bins.tolist()], dtype=np.int64)
    return bins, offsets, filled


def _packer(capacity: int, group_rows: int | None = None):
    """Packs a task's items; with ``group_rows``, as soon as it holds so many."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for batch in batches:
            rows, held = [*rows, batch], held + len(batch)
            if group_rows and held >= group_rows:
                yield packed(rows)
                rows, held = [], 0
        if held:
            yield packed(rows)

    def packed(rows: list[pd.DataFrame]) -> pd.DataFrame:
        items = pd.concat([b for b in rows if len(b)], ignore_index=True)
        at, offset, filled = best_fit(items["length"].to_numpy(), capacity)
        items["bin"], items["offset"], items["filled"] = items["item"].to_numpy()[at], offset, filled
        return items.drop(columns="item")

    return pack


def _pack_groups(bins: DataFrame, count: int, capacity: int, group_rows: int) -> DataFrame:
    """One round: (bin, into, at, filled) for the bins (bin, length)."""
    groups = max(1, -(-count // group_rows))
    pack = _packer(capacity)

    def round_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in pack(b.assign(item=b["bin"]).rename(columns={"bin": "was"}) for b in batches):
            yield out.rename(columns={"bin": "into", "offset": "at", "was": "bin"})[["bin", "into", "at", "filled"]]

    dealt = bins.repartition(groups, F.xxhash64("bin")) if groups > 1 else bins.coalesce(1)
    return dealt.mapInPandas(round_, "bin long, into long, at long, filled long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, slack: int = SLACK,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: the columns of ``pieces``, sequence_id and offset.

    Every document is in, NULL or empty texts as their end id alone, repeated rows
    each for itself; offsets in a sequence have no gaps.  An empty table gives no
    rows.
    """
    parts = materialise(pieces(docs, path, capacity, end_id).withColumn("item", F.monotonically_increasing_id()))
    placed = materialise(parts.mapInPandas(_packer(capacity, group_rows), PLACES))
    open_bins = materialise(placed.filter(F.col("filled") < capacity - slack).groupBy("bin").agg(F.max("filled").alias("length")))
    moves, count = None, open_bins.count()
    while count > 1:
        step = materialise(_pack_groups(open_bins, count, capacity, group_rows))
        if moves is None:
            moves = step.select("bin", "into", "at")
        else:
            after = step.select(F.col("bin").alias("mid"), F.col("into").alias("then"), F.col("at").alias("more"))
            moves = moves.join(after, F.col("into") == F.col("mid"), "left").select(
                "bin", F.coalesce("then", "into").alias("into"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"))
        moves = materialise(moves)
        open_bins = materialise(step.filter(F.col("filled") < capacity - slack)
                                .groupBy(F.col("into").alias("bin")).agg(F.max("filled").alias("length")))
        bins = step.select("into").distinct().count()
        left = open_bins.count()
        if count - bins < LEAST_GAIN * count or left <= 1 or count <= group_rows:
            break
        count = left
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if moves is None:
        return placed.select(*columns, F.col("bin").alias("sequence_id"), "offset")
    return placed.join(moves, "bin", "left").select(
        *columns, F.coalesce("into", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("at", F.lit(0))).alias("offset"))
