import zlib

import numpy as np
from pyspark.sql import functions as F

from pitwall.llm import hypervectors as H


def slow_bundle(text, letters):
    """Letter by letter, without packing or counts."""
    out, chars = np.zeros(letters.dimensions), [None]
    for c in text.lower():
        if c.isalpha():
            chars.append(c)
        elif chars[-1] is not None:
            chars.append(None)
    if chars[-1] is not None:
        chars.append(None)
    for a, b, c in zip(chars, chars[1:], chars[2:]):
        x, y, z = (letters.vector(ord(q) if q else 0).astype(float) for q in (a, b, c))
        out += np.roll(x, 2) * np.roll(y, 1) * z
    return out


def test_bundles_match_brute_force():
    letters = H.Letters()
    texts = ["Straße, größer! 12 weg", "ab", "x", "日本語 text", "", None, "12 34", "the the the"]
    got, has = letters.bundles(texts)
    for t, v, h in zip(texts, got, has):
        assert h == any(c.isalpha() for c in t or "")
        assert np.array_equal(v, slow_bundle(t or "", letters))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = H.identify(docs).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(6)] + [(10 + i, "le chat et la souris", "fr") for i in range(6)]
    rows += [(30, None, "en"), (31, "", "fr"), (32, "12 !?", None), (None, "the dog", "xx"), (33, "le chat " * 100_000, None), (30, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1))
    got = H.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[30]["lang_pred"] == by[31]["lang_pred"] == by[32]["lang_pred"] == "und" and by[30]["score"] == 0
    assert by[33]["lang_pred"] == "fr" and by[None]["lang_pred"] == "en" and by[None]["held_out"] is False
    assert H.identify(docs.limit(0)).count() == 0
