"""Texts cut into chunks whose token ids do not depend on each other.

A byte-level split pattern never joins a visible character with a following
space.  A text may therefore be cut before each single space that stands between
visible characters, and equal chunks have equal ids.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from itertools import chain

import numpy as np

#: A single space between visible characters; the chunk after it begins with it.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def numbered(items: Iterable[str]) -> dict[str, int]:
    """The distinct items, numbered in order."""
    distinct = dict.fromkeys(items)
    return dict(zip(distinct, range(len(distinct))))


def gather(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that ``codes`` name, one after another, and where each of them ends."""
    lengths = sizes[codes]
    ends = np.cumsum(lengths)
    starts = (np.cumsum(sizes) - sizes)[codes]
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(int(lengths.sum()))], ends


def _open(chunk: str) -> bool:
    """Whether white space stands at an end of the chunk, so that it was cut in a run."""
    return not chunk or chunk[0].isspace() or chunk[-1].isspace()


def ids_of_texts(texts: Sequence[str], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, number of ids of each text).

    ``encode`` gives the same for a list of chunks; it sees each of the chunks
    that later spaces begin only once.
    """
    parts = [text.split(" ") for text in texts]
    wrong = {c for c in dict.fromkeys(chain.from_iterable(parts)) if _open(c)}
    if wrong:
        parts = [part if wrong.isdisjoint(part) else _CUT.split(text) for part, text in zip(parts, texts)]
    firsts = [part[0] for part in parts]
    code = numbered(chain.from_iterable(part[1:] for part in parts))
    flat, sizes = encode([" " + c for c in code] + firsts)
    first_code = range(len(code), len(code) + len(firsts))
    counts = np.array([len(part) for part in parts], dtype=np.int64)
    codes = np.fromiter(chain.from_iterable(chain((n,), map(code.__getitem__, part[1:])) for n, part in zip(first_code, parts)),
                        np.int64, int(counts.sum()))
    ids, ends = gather(flat, sizes, codes)
    return ids, np.diff(ends[np.cumsum(counts) - 1], prepend=0)
