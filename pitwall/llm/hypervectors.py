"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram is the product of its
letters' vectors, each rolled by its place; a text is the sum of its n-grams and
a language the sum of its texts.  A text gets the language of the nearest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.session import materialise

DIMENSIONS = 1024
NGRAM = 3
SEED = 11
UNKNOWN = "und"
#: Languages that a model may hold; their prototypes go to every task.
MAX_LANGUAGES = 10_000
_CODE = 21  # bits of a code point


class Letters:
    """Random letter vectors, made from the code point alone, and their n-grams."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = NGRAM, seed: int = SEED):
        self.dimensions, self.n, self.seed = dimensions, n, seed
        self._known: dict[int, np.ndarray] = {}
        self._is_letter = np.array([chr(c).isalpha() for c in range(0x110000)])

    def vector(self, code: int) -> np.ndarray:
        found = self._known.get(code)
        if found is None:
            if len(self._known) > 20_000:
                self._known.clear()
            bits = np.random.Generator(np.random.PCG64([self.seed, code])).integers(0, 2, self.dimensions, dtype=np.int8)
            found = self._known[code] = 2 * bits - 1
        return found

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Packed n-grams of the lower-cased text and their counts; every run of
        other characters than letters is one blank (code 0).  Empty without letters."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        letter = self._is_letter[codes]
        if not letter.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes = np.where(letter, codes, 0)
        codes = np.concatenate(([0], codes, [0]))
        codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
        packed = np.zeros(len(codes) - self.n + 1, dtype=np.int64)
        for i in range(self.n):
            packed = packed << _CODE | codes[i:len(codes) - self.n + 1 + i]
        return np.unique(packed, return_counts=True)

    def gram_vectors(self, packed: np.ndarray) -> np.ndarray:
        out = np.ones((len(packed), self.dimensions), dtype=np.int8)
        for i in range(self.n):
            codes = packed >> _CODE * (self.n - 1 - i) & (1 << _CODE) - 1
            used, at = np.unique(codes, return_inverse=True)
            out *= np.stack([np.roll(self.vector(c), self.n - 1 - i) for c in used.tolist()])[at]
        return out

    def bundles(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, whether there is a letter) of some texts."""
        found = [self.grams(t) for t in texts]
        has = np.array([len(g) > 0 for g, _ in found], dtype=bool)
        out = np.zeros((len(texts), self.dimensions), dtype=np.float64)
        if has.any():
            used, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
            vectors = self.gram_vectors(used).astype(np.float32)
            counts = np.zeros((len(texts), len(used)), dtype=np.float32)
            counts[np.repeat(np.arange(len(texts)), [len(g) for g, _ in found]), at] = np.concatenate([c for _, c in found])
            out = (counts @ vectors).astype(np.float64)  # whole numbers; exact up to 2^24
        return out, has


_LETTERS: dict[tuple, Letters] = {}


def _letters(*settings) -> Letters:
    """One table of letter vectors for each Python worker."""
    if settings not in _LETTERS:
        _LETTERS[settings] = Letters(*settings)
    return _LETTERS[settings]


def _blocks(texts: list, rows: int = 64, chars: int = 400_000) -> Iterator[tuple[int, int]]:
    """Spans of a batch of up to ``rows`` texts and about ``chars`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= rows or size + len(text or "") > chars):
            yield start, i
            start, size = i, 0
        size += len(text or "")
    if len(texts) > start:
        yield start, len(texts)


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, n: int = NGRAM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototype of each non-NULL ``lang``: the sum of the vectors of all its texts.

    Each task adds up its own texts; only sums go through the shuffle.  Texts
    without a letter add nothing.
    """

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, sums = _letters(dimensions, n, seed), {}
        for batch in batches:
            texts = batch["text"].tolist()
            for start, end in _blocks(texts):
                vectors, has = letters.bundles(texts[start:end])
                langs = batch["lang"].to_numpy()[start:end]
                for lang in set(langs[has].tolist()):
                    sums[lang] = sums.get(lang, 0) + vectors[has & (langs == lang)].sum(axis=0)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "total": [v.astype(np.int64) for v in sums.values()]})

    parts = (docs.filter("lang is not null and text is not null").select("text", "lang")
             .mapInPandas(add_up, "lang string, total array<long>"))
    total = materialise(parts.select("lang", F.posexplode("total")).groupBy("lang", "pos").agg(F.sum("col").alias("total"))
                        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "total")))["total"].alias("total")))
    if (count := total.count()) > MAX_LANGUAGES:
        raise ValueError(f"{count} languages; at most {MAX_LANGUAGES} prototypes go to the tasks")
    return {r["lang"]: np.array(r["total"], dtype=np.float64) for r in total.orderBy("lang").collect()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS, n: int = NGRAM,
            seed: int = SEED) -> DataFrame:
    """``docs`` with lang_pred and score (the cosine, 0 if negative), which replace
    any such columns.  ``und`` and 0 for NULL texts, texts without a letter, and
    models without languages; the first language in order wins a tie."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[k] / max(np.linalg.norm(prototypes[k]), 1e-300) for k in names]) if names else None

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = _letters(dimensions, n, seed)
        for texts in batches:
            langs, scores = [], []
            texts = texts.tolist()
            for start, end in _blocks(texts):
                vectors, has = letters.bundles(texts[start:end])
                if matrix is None:
                    has[:] = False
                    cosine = np.zeros((len(has), 1))
                else:
                    cosine = vectors @ matrix.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-300)[:, None]
                best = cosine.argmax(axis=1)
                langs += [names[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist())]
                scores += np.where(has, np.clip(cosine.max(axis=1), 0, 1), 0.0).tolist()
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    result = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    scored = F.pandas_udf(score, result)
    kept = docs.drop("lang_pred", "score")
    return kept.withColumn("_found", scored(F.col("text"))).select(*kept.columns, "_found.lang_pred", "_found.score")


def fold(doc_id: str = "doc_id") -> "Column":  # noqa: F821
    """crc32 of the id as text modulo 4; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def identify(docs: DataFrame, held_out_fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learnt from the rows of
    the other folds.  A row with a NULL doc_id is in no fold: it is neither learnt
    from nor held out."""
    mine = docs.select("doc_id", "text", "lang")
    prototypes = learn(mine.filter(fold() != held_out_fold))
    found = predict(mine.select("doc_id", "text"), prototypes)
    return found.select("doc_id", F.coalesce(fold() == held_out_fold, F.lit(False)).alias("held_out"), "lang_pred", "score")
