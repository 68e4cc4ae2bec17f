import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.llm import importance as I
from pitwall.llm import quality_rules as R


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_base_counts_and_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = R.quality_rules(docs).collect()
    assert len(rows) == len(texts)
    good = bad = 0
    for r in rows:
        q = r["q"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == slow_counts(texts[r["doc_id"]])
        assert r["base_failed"] == (q["n_words"] < 10 or 100 * q["n_repeat_words"] > 20 * q["n_words"])
        assert not (r["base_failed"] and r["kept"])
        if (label := labels.get(r["doc_id"])) and not r["base_failed"]:
            good += label["quality"] == 1 and label["toxic"] == 0 and not r["kept"]
            bad += label["quality"] == 0 and r["kept"]
    assert good <= 1 and bad <= 1


def test_estimate_matches_concentration_steps(spark):
    """The fitted core against the same steps in NumPy, up to the width of a bin."""
    rng = np.random.default_rng(4)
    p = len(R.FEATURES)
    mix = rng.normal(size=(p, p)) * 0.4
    x = rng.normal(size=(900, p)) @ mix
    x[:120] += 8
    q = [(i, "en", "s", tuple([100, 500, 0, 0, 0] + [float(v) for v in row])) for i, row in enumerate(x)]
    schema = "doc_id long, lang string, source string, q struct<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in R._SCHEMA) + ">"
    stats = spark.createDataFrame(q, schema)
    row = R.fit(stats).collect()[0]
    floor, factor = np.diag(np.square(list(R.FEATURES.values()))), R.consistency()
    mean = np.median(x, axis=0)
    inverse = np.diag(1 / ((np.subtract(*np.percentile(x, [75, 25], axis=0)) / 1.349) ** 2 + np.diag(floor)))
    for _ in range(R.STEPS):
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        core = x[np.argsort(d)[:int(np.ceil(0.75 * len(x)))]]
        mean, inverse = core.mean(axis=0), np.linalg.inv(factor * np.cov(core.T, bias=True) + floor)
    assert np.allclose(row["mean"], mean, atol=0.15)
    judged = R.judge(stats, R.fit(stats)).collect()
    assert all(not r["kept"] for r in judged if r["doc_id"] < 120) and sum(not r["kept"] for r in judged) == 120
    assert abs(R.chi_square(2 * math.log(2), 2) - 0.5) < 1e-12


def test_pooling(spark):
    rows = [(i, "en", f"s{i % 3}", "one two three four five six seven eight nine ten eleven") for i in range(30)]
    rows += [(100 + i, None, None, f"a{i} b c d e f g h i j k") for i in range(12)] + [(200, "de", "x", "a b c d e f g h i j")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    g = {(r["lang"], r["source"]): r["g"] for r in R.groups(R.with_statistics(docs), least_rows=10).collect()}
    assert len(set(g.values())) == 5 and g["de", "x"] is None and g[None, None] is not None
    pooled = R.groups(R.with_statistics(docs), least_rows=12).collect()
    assert len({r["g"] for r in pooled if r["lang"] == "en"}) == 1


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(100_000))
    rows = [(1, None, "en", "a"), (2, "", None, "a"), (None, "x " * 5, "en", None), (3, long, "en", "a"), (3, long, "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit("x")).withColumn("q", F.lit(1)).withColumn("key", F.lit("y"))
    got = R.quality_rules(docs).collect()
    assert len(got) == 5 and all(r["base_failed"] for r in got if r["doc_id"] != 3)
    assert R.quality_rules(docs.limit(0)).count() == 0 and R.keep_good(docs).columns == docs.columns
    labels = spark.createDataFrame([(3, 1, 0), (1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = I.importance_sample(docs, labels).collect()
    assert len(got) == 5 and all(r["log_weight"] == 0 for r in got if r["doc_id"] in (1, 2))
    assert I.importance_sample(docs.limit(0), labels).count() == 0
    assert all(r["kept"] for r in I.importance_sample(docs, labels.limit(0)).collect())
    assert I.keep_sampled(docs, labels).columns == docs.columns


@pytest.mark.parametrize("k", [1, 7, 500, 999])
def test_threshold_is_the_kth_value(spark, k):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=900) * 100, np.full(99, 3.25), [1e9]])
    df = spark.createDataFrame([(float(v),) for v in values], "key double")
    assert I.threshold(df, k) == sorted(values, reverse=True)[k - 1]


def test_weights_against_counting(spark):
    rows = [(i, ("the cat sat on the mat " if i % 4 else "zz %%% qq ### ") * (3 + i % 5)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(80)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in I.importance_sample(docs, labels).collect()}
    assert all(r["kept"] == (i % 4 > 0) for i, r in got.items())
    hasher, raw = I.Hasher(), Counter()
    for _, text in rows:
        raw.update(hasher.buckets(text).tolist())
    found = I.counts(docs.withColumn("good", F.lit(False)))
    assert {b: found[1][b] for b in raw} == raw and found[0].sum() == 0 and found[1].sum() == sum(raw.values())
    assert len(hasher.buckets("A b, c")) == 4 + 3
