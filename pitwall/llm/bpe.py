"""Byte-level BPE by a table of last tokens.

For each byte prefix of a piece there is one token with which the encoding of
that prefix ends.  It is the vocabulary's suffix of the prefix whose own prefix
ends with a token that may stand before it; two tokens may stand side by side if
no merge over their border would have come first.  The table makes appends exact
(old entries never change) and lets an edit be re-encoded up to where the table
agrees with the old one again.

Short pieces of many texts fill their tables together, byte by byte
(``prefix_steps``); long ones, appends and edits do so one at a time.
"""

from __future__ import annotations

import base64
import functools
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pitwall.llm.chunks import gather, ids_of_texts, numbered
from pitwall.llm.prefix_steps import PrefixSteps

NEVER = 1 << 62
#: Bytes of a piece whose table is shared with other pieces that begin alike.
HEAD = 8
#: Characters beyond a match's end that the split pattern may look at.
LOOK_AHEAD = 4
#: Bytes up to which a piece is encoded together with others.
SHORT = 64
#: Characters of the texts that are encoded together, and pieces whose tables are filled together.
TEXT_BLOCK, PIECE_BLOCK = 2_000_000, 50_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PrefixBpe:
    """Encodes and decodes by the ranks and the split pattern of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pieces: int = 150_000):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length_of = {i: len(b) for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._sizes = np.zeros(max(self.bytes_of) + 1, dtype=np.int64)
        for i, token in self.bytes_of.items():
            self._sizes[i] = len(token)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._bytes = np.frombuffer(b"".join(b for _, b in sorted(self.bytes_of.items())), dtype=np.uint8)
        self._edges: dict[bytes, tuple | None] = {}
        self._pairs: dict[int, bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}
        self._heads: dict[bytes, list[int]] = {}
        self._size = pieces
        self._steps: PrefixSteps | None = None

    @functools.cached_property
    def suffixes(self):
        """Finds all tokens that end at a byte; bytes stand as Latin-1."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            found.add_word(token.decode("latin-1"), (i, len(token)))
        found.make_automaton()
        return found

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes ``token``; None if merges never make it."""
        own, parts = self.ranks[token], [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= own:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(parts)

    def _borders(self, token: bytes) -> tuple[list, list] | None:
        """The tokens that stand at the token's left and right end while it is
        built, each with the rank at which it is merged away."""
        known = self._edges.get(token, False)
        if known is not False:
            return known
        result: tuple | None = ([(token, NEVER)], [(token, NEVER)])
        if len(token) > 1:
            halves = self._halves(token)
            ends = halves and [self._borders(h) for h in halves]
            if not ends or None in ends:
                result = None
            else:
                own = self.ranks[token]
                for side, border in enumerate(result):
                    border += [(t, own if until == NEVER else until) for t, until in ends[side][side]]
        self._edges[token] = result
        return result

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens side by side."""
        a, b = self._borders(self.bytes_of[left]), self._borders(self.bytes_of[right])
        return a is not None and b is not None and not any(
            r < until_x and r <= until_y  # at equal ranks the left merge comes first
            for x, until_x in a[1] for y, until_y in b[0]
            if (r := self.ranks.get(x + y)) is not None)

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Append to ``last`` the token with which the encoding of each longer
        prefix of ``data`` ends, up to data[:stop]."""
        pairs, done = self._pairs, len(last)
        stop = len(data) if stop is None else stop
        begin = max(0, done + 1 - self.longest)
        last += [-1] * (stop - done)
        for end, (token, length) in self.suffixes.iter(data[:stop].decode("latin-1"), begin):
            if end < done or last[end] >= 0:
                continue
            if end + 1 > length:
                pair = last[end - length] << 32 | token
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= 2 * self._size:
                        pairs.clear()
                    fits = pairs[pair] = self.may_follow(last[end - length], token)
            else:
                fits = length == 1 or self._borders(data[:length]) is not None
            if fits:
                last[end] = token
        if stop > done and min(last[done:]) < 0:
            raise ValueError("a single byte is missing from the vocabulary")

    def walk_back(self, last: list[int]) -> list[int]:
        """The ids of the whole, read from the last tokens of its prefixes."""
        out, end, lengths = [], len(last), self.length_of
        while end:
            token = last[end - 1]
            out.append(token)
            end -= lengths[token]
        return out[::-1]

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one match of the split pattern."""
        known = self._pieces.get(text)
        if known is None:
            known = self._old.get(text)
            if known is not None:
                self._pieces[text] = known
        if known is None:
            data = text.encode("utf-8", "replace")
            whole = self.ranks.get(data)
            if whole is None:
                head = self._heads.get(data[:HEAD])
                if head is None:
                    self.extend(data[:HEAD], head := [])
                    if 2 * len(self._heads) >= self._size:
                        self._heads.clear()
                    self._heads[data[:HEAD]] = head
                last = head.copy()
                self.extend(data, last)
                known = tuple(self.walk_back(last))
            else:
                known = (whole,)
            if 2 * len(self._pieces) >= self._size:
                self._old, self._pieces = self._pieces, {}
            if len(text) <= 256:
                self._pieces[text] = known
        return known

    def _together(self) -> PrefixSteps:
        if self._steps is None:
            ids = sorted(self.bytes_of)
            tokens = [self.bytes_of[i] for i in ids]
            place, halves = {t: n for n, t in enumerate(tokens)}, np.full((len(tokens), 2), -1)
            for n, token in enumerate(tokens):  # by rank, so both halves come before
                if len(token) > 1:
                    made = self._halves(token)
                    at = [place[h] for h in made] if made else [-2]
                    halves[n] = -2 if made is None or -2 in halves[at] else at
            self._ids = np.array(ids, dtype=np.int32)
            self._steps = PrefixSteps(tokens, halves)
        return self._steps

    def _pieces_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, number of ids of each)."""
        sizes = np.array([len(p) for p in pieces])
        steps, flats, counts = self._together(), [], []
        for at in range(0, len(pieces), PIECE_BLOCK):
            block = pieces[at:at + PIECE_BLOCK]
            # a piece that is itself in the vocabulary is its own token, whatever its merges
            known = [self.ranks.get(p) for p in block]
            single = {n: [i] for n, i in enumerate(known) if i is not None}
            for n in np.flatnonzero(sizes[at:at + PIECE_BLOCK] > SHORT).tolist():
                if n not in single:
                    self.extend(block[n], last := [])
                    single[n] = self.walk_back(last)
            rest = [n for n in range(len(block)) if n not in single]
            flat, count = steps.encode([block[n] for n in rest])
            flat, size, alone = self._ids[flat], np.zeros(len(block), np.int64), list(single)
            size[rest] = count
            size[alone] = [len(single[n]) for n in alone]
            ends, out = np.cumsum(size), np.empty(int(size.sum()), np.int32)
            own = np.zeros(len(block), bool)
            own[rest] = True
            of = np.repeat(own, size)
            out[of] = flat
            out[~of] = np.fromiter((i for n in sorted(alone) for i in single[n]), np.int32)
            flats.append(out)
            counts.append(size)
        if not flats:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate(flats), np.concatenate(counts)

    def _chunks_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks of text.  Chunks are split together as long as each ends
        visibly and the next begins with a space: matches end there."""
        pieces, begin = [], 0
        for i in range(1, len(chunks) + 1):
            if i == len(chunks) or not chunks[i].startswith(" ") or not chunks[i - 1] or chunks[i - 1][-1].isspace():
                pieces += self.split.findall("".join(chunks[begin:i]))
                begin = i
        code = numbered(pieces)
        flat, sizes = self._pieces_ids([p.encode("utf-8", "replace") for p in code])
        ids, ends = gather(flat, sizes, np.fromiter(map(code.__getitem__, pieces), np.int64, len(pieces)))
        piece_ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        chunk_ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        whole = np.searchsorted(piece_ends, chunk_ends, side="right")  # pieces up to each chunk's end
        return ids, np.diff(np.concatenate([[0], ends])[whole], prepend=0)

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; a block of texts at a time is held beside them."""
        out, block, held = [], [], 0
        for i, text in enumerate(texts):
            block.append(text)
            held += len(text)
            if held >= TEXT_BLOCK or i + 1 == len(texts):
                flat, sizes = ids_of_texts(block, self._chunks_ids)
                out += np.split(flat, np.cumsum(sizes)[:-1])
                block, held = [], 0
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_texts([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids' tokens, gathered from one array of all tokens."""
        ids = np.asarray(ids, dtype=np.int64)
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        places = np.repeat(self._starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])
        return self._bytes[places].tobytes()


class PrefixTable:
    """The last tokens of all prefixes of one piece, open to appends and edits."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.bpe.extend(self.data, self.last)

    def replace(self, at: int, removed: int, inserted: bytes) -> int:
        """Put ``inserted`` in place of ``removed`` bytes; returns how many entries
        were computed.  Once as many entries in a row as a token is long agree with
        the old table, all later ones do."""
        old, shift = self.last, len(inserted) - removed
        edited = at + len(inserted)
        self.data = self.data[:at] + inserted + self.data[at + removed:]
        self.last, agree = old[:at], 0
        for end in range(at + 1, len(self.data) + 1):
            self.bpe.extend(self.data, self.last, end)
            agree = agree + 1 if end > edited and old[end - 1 - shift] == self.last[-1] else 0
            if agree > self.bpe.longest:
                self.last += old[end - shift:]
                return end - at
        return len(self.data) - at

    def ids(self) -> list[int]:
        return self.bpe.walk_back(self.last)


class EncodedText:
    """A text with the ids of its pieces, kept exact under appends and edits.

    Matches of the split pattern depend on the text from their start on and on a
    few characters behind them, so pieces well before a change stay, and those
    behind it stay from the first common start on.
    """

    def __init__(self, bpe: PrefixBpe, text: str = ""):
        self.bpe, self.text = bpe, ""
        self.starts: list[int] = []
        self.pieces: list[tuple[int, ...]] = []
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), 0, text)

    def replace(self, at: int, removed: int, inserted: str) -> int:
        """Returns the number of pieces that were encoded anew."""
        shift, old_starts, old_pieces = len(inserted) - removed, self.starts, self.pieces
        self.text = self.text[:at] + inserted + self.text[at + removed:]
        keep = max(0, bisect_right(old_starts, at - LOOK_AHEAD) - 1)
        while keep and self.text[old_starts[keep] - 1].isspace():  # a run of white space ends by what follows it
            keep -= 1
        begin = old_starts[keep] if keep < len(old_starts) else 0
        later = {s + shift: i for i, s in enumerate(old_starts) if s >= at + removed}
        self.starts, self.pieces, fresh = old_starts[:keep], old_pieces[:keep], 0
        for match in self.bpe.split.finditer(self.text, begin):
            start = match.start()
            if start >= at + len(inserted) and start in later:
                i = later[start]
                self.starts += [s + shift for s in old_starts[i:]]
                self.pieces += old_pieces[i:]
                break
            self.starts.append(start)
            self.pieces.append(self.bpe.piece(match[0]))
            fresh += 1
        return fresh

    def ids(self) -> list[int]:
        return [i for piece in self.pieces for i in piece]


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> PrefixBpe:
    """One encoder for each Python worker and vocabulary."""
    return PrefixBpe(read_ranks(path), pattern)


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about ``TEXT_BLOCK`` bytes, and at least one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = (np.cumsum(sizes) - sizes) // TEXT_BLOCK
        borders = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for begin, end in zip(borders, borders[1:]):
            if end > begin:
                yield batch.slice(begin, end - begin)


def _with_ids(bpe: PrefixBpe, batch: pa.RecordBatch, text: str) -> pa.RecordBatch:
    found = bpe.encode_texts([t or "" for t in batch.column(text).to_pylist()])
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    flat = np.concatenate(found) if found else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                      names=[*batch.schema.names, "ids"])


def _with_bytes(bpe: PrefixBpe, batch: pa.RecordBatch, ids: str) -> pa.RecordBatch:
    lists = batch.column(ids)
    decoded = [bpe.decode(lists[i].values.to_numpy()) if lists[i].is_valid else None for i in range(len(lists))]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"])


IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
DECODED = T.StructField("decoded", T.BinaryType())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with the column ``ids`` (in place of any such column): token ids of
    the whole text, without special tokens.  NULL and empty texts have no ids.
    ``pattern`` must never join a visible character with a following space."""
    kept = docs.drop("ids")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in slices(batches, text):
            yield _with_ids(bpe, batch, text)

    return kept.mapInArrow(add, T.StructType([*kept.schema, IDS]))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded`` (in place of any such column): the
    bytes that the ids stand for; NULL ids give NULL."""
    kept = encoded.drop("decoded")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            yield _with_bytes(bpe, batch, ids)

    return kept.mapInArrow(add, T.StructType([*kept.schema, DECODED]))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass, so that a task needs one Python worker."""
    kept = docs.drop("ids", "decoded")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in slices(batches, text):
            yield _with_bytes(bpe, _with_ids(bpe, batch, text), "ids")

    return kept.mapInArrow(add, T.StructType([*kept.schema, IDS, DECODED]))
