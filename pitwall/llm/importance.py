"""Quality by importance resampling: hashed n-gram models of target and raw text.

A text's weight is the ratio of its probability under a model of good labelled
texts to that under a model of all texts.  Texts are drawn without replacement in
proportion to their weights: the k largest sums of log weight and Gumbel noise.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.session import materialise

BUCKETS = 1 << 15
#: Counts that every bucket has besides its own, in each model.
SMOOTHING = 1.0
#: Number of n-grams at which a text's mean and its sum weigh alike.
LENGTH = 100
#: Largest sample of good labelled texts for the cut, taken in hash order.
LABELLED = 100_000
#: Share of good labelled texts that may fall under the cut, and its distance below.
LOST, MARGIN = 0.001, 4.0
SEED = 17

_TOKENS = re.compile(r"\w+|[^\w\s]+")


class Hasher:
    """Buckets of the unigrams and bigrams of lower-cased words and signs."""

    def __init__(self, buckets: int = BUCKETS, size: int = 120_000):
        self.shift, self.size, self.known = np.uint64(64 - (buckets.bit_length() - 1)), size, {}

    def buckets(self, text: str | None) -> np.ndarray:
        tokens = _TOKENS.findall((text or "").lower())
        known = self.known
        if len(known) > self.size:
            known.clear()
        found = list(map(known.get, tokens))
        if None in found:
            for i, code in enumerate(found):
                if code is None:
                    found[i] = known[tokens[i]] = zlib.crc32(tokens[i].encode("utf-8", "surrogatepass")) + 1
        one = np.array(found, dtype=np.uint64)
        two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = np.concatenate((one * np.uint64(0xD6E8FEB86659FD93), two * np.uint64(0xFF51AFD7ED558CCD)))
        return (mixed >> self.shift).astype(np.int64)


def counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of all buckets over all texts: (target, raw), target being the rows
    where ``good`` holds.  Tasks add up their own texts, and the sums of at most
    ``buckets`` rows come to the driver."""

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, sums = Hasher(buckets), np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            for text, good in zip(batch["text"], batch["good"]):
                found = hasher.buckets(text)
                if len(found):
                    of = np.bincount(found, minlength=buckets) if len(found) > buckets // 8 else None
                    for row in ([1, 0] if good else [1]):
                        if of is None:
                            np.add.at(sums[row], found, 1)
                        else:
                            sums[row] += of
        used = np.flatnonzero(sums[1])
        yield pd.DataFrame({"bucket": used, "target": sums[0, used], "raw": sums[1, used]})

    parts = docs.select("text", "good").mapInPandas(add_up, "bucket int, target long, raw long")
    out = np.zeros((2, buckets), dtype=np.float64)
    for r in parts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).collect():
        out[:, r["bucket"]] = r["target"], r["raw"]
    return out


def log_ratios(found: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw of each bucket; the raw model is mixed into the
    target's smoothing, so that buckets without target counts stay near even in small samples."""
    raw = (found[1] + smoothing) / (found[1] + smoothing).sum()
    pseudo = smoothing * len(raw)
    target = (found[0] + pseudo * raw) / (found[0].sum() + pseudo)
    return np.log(target) - np.log(raw)


def _weights(ratios: np.ndarray, length: int):
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher = Hasher(len(ratios))  # goes with the task, so idle workers hold nothing
        for texts in batches:
            out = []
            for text in texts:
                found = hasher.buckets(text)
                out.append(float(ratios[found].sum()) * length / (len(found) + length))
            yield pd.Series(out, dtype="float64")

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, T.DoubleType())


def gumbel(seed: int = SEED) -> "Column":  # noqa: F821
    """Standard Gumbel noise from the document's id; the same on every run."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def threshold(keys: DataFrame, k: int, bins: int = 4096, rounds: int = 5) -> float:
    """The k-th largest value of the column ``key``: counts by bins, narrowed to the
    bin that holds it, until the bin is one value or no wider than rounding."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if k <= 0 or low is None:
        return math.inf
    above = 0
    for _ in range(rounds):
        width = (high - low) / bins
        if not width > abs(high) * 1e-15:
            break
        at = F.least(F.floor((F.col("key") - low) / width), F.lit(bins - 1))
        rows = sorted(keys.filter(F.col("key").between(low, high)).groupBy(at.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect(), reverse=True)
        for row in rows:
            if above + row["n"] >= k:
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
    return low


class Sampler:
    """What a fit learns: log ratios, the threshold of the k-th key."""

    def __init__(self, ratios: np.ndarray, cut: float, least: float, length: int = LENGTH):
        self.ratios, self.cut, self.least, self.length = ratios, cut, least, length

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with log_weight, key and kept, which replace any such columns."""
        mine = docs.drop("log_weight", "key", "kept").withColumn("log_weight", _weights(self.ratios, self.length)(F.col("text")))
        return mine.withColumn("key", F.col("log_weight") + gumbel()).withColumn("kept", F.col("key") >= self.least)


def fit(docs: DataFrame, labels: DataFrame, length: int = LENGTH, labelled: int = LABELLED) -> tuple[Sampler, DataFrame]:
    """(model, scores of all rows).  The raw model counts all texts; the target
    model those labelled good and not toxic, of which up to ``labelled`` ids are
    taken in hash order (so the broadcast is bounded by this parameter).  The
    draw's size k is the number of texts whose weight is not below what nearly
    all good labelled texts reach (less a margin); that is read from a quarter of
    them which the target model has not seen.  Without labels every text is kept."""
    bad = labels.filter("quality = 0 or toxic = 1").select("doc_id").distinct()
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    good = materialise(good.join(bad, "doc_id", "left_anti").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))
    mine = docs.select("doc_id", "text").join(F.broadcast(good.withColumn("good", F.lit(True))), "doc_id", "left")
    held_out = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(4)) == 0
    mine = mine.withColumn("good", F.coalesce("good", F.lit(False)))
    found = counts(mine.withColumn("good", F.col("good") & ~F.coalesce(held_out, F.lit(False))))
    if not found[0].sum():
        sampler = Sampler(np.zeros(BUCKETS), -math.inf, -math.inf, length)
        return sampler, sampler.score(mine.select("doc_id", "text")).drop("text")
    sampler = Sampler(log_ratios(found), 0.0, 0.0, length)
    scored = materialise(sampler.score(mine).select("doc_id", "good", "log_weight", "key"))
    unseen = scored.filter(F.col("good") & held_out).agg(F.percentile("log_weight", F.lit(LOST)).alias("c")).first()["c"]
    sampler.cut = (unseen or 0.0) - MARGIN
    sampler.least = threshold(scored, scored.filter(F.col("log_weight") >= sampler.cut).count())
    return sampler, scored.withColumn("kept", F.col("key") >= sampler.least)


def importance_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, key, kept of every row: kept are the k rows with the
    largest keys, and rows that tie with the last of them.

    NULL and empty texts have weight 0 like a text of average n-grams.  Rows with
    equal doc_id have equal noise, those with a NULL id as well; labels that
    contradict each other count as bad.
    """
    return fit(docs, labels)[1].select("doc_id", "log_weight", "key", "kept")


def keep_sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the sample keeps; scored a second time beside the
    text, so that no text is shuffled."""
    sampler, _ = fit(docs, labels)
    scored = sampler.score(docs.withColumns({f"_{c}": F.col(c) for c in ("log_weight", "key", "kept") if c in docs.columns}))
    back = [F.col(f"_{c}").alias(c) if c in ("log_weight", "key", "kept") else F.col(c) for c in docs.columns]
    return scored.filter("kept").select(*back)
