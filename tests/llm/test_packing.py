import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitwall.llm import packing as K

PATH = P.path("byte_bpe_50k.json")


def check(rows, texts, capacity=1024):
    """Pieces are exact, sequences gapless; returns the number of sequences."""
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or capacity
        for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
            part = np.array(ids[start:start + (capacity if piece else first)], dtype="<u4")
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, want)) == sorted(key((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5, "doc_id")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = K.pack(docs, PATH).collect()
    least = -(-sum(r["length"] for r in rows) // 1024)
    assert check(rows, texts) <= least * 1.03 + 1
    assert check(K.pack(docs, PATH, group_rows=30).collect(), texts) <= least * 1.1 + 1


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (4, "word " * 5000), (5, "a <|endoftext|> b  "), (6, "é\n\n x"), (6, " a b ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bin", F.lit(1)).withColumn("item", F.lit("x"))
    assert check(K.pack(docs, PATH).collect(), rows) == 5  # the long one is four full pieces and a shorter one
    assert K.pack(docs.limit(0), PATH).count() == 0


def test_best_fit_is_tight():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 1024, 5000)
    bins, offset, filled = K.best_fit(sizes, 1024)
    assert len(set(bins.tolist())) <= -(-sizes.sum() // 1024) * 1.01
    for b in set(bins.tolist()):
        of = bins == b
        assert sizes[of].sum() == filled[of][0] <= 1024 and sorted(offset[of])[0] == 0
