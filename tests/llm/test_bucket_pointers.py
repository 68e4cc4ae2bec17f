import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pitwall.llm import bucket_pointers as B

SCHEMA = "doc_id long, text string"


def slow(rows, length):
    """{row number: (spans, kept)} by a dictionary of all strings."""
    least = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1 if doc is not None else 0):
            s = raw[p:p + length]
            least[s] = min(doc, least.get(s, doc))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1 if doc is not None else 0):
            if least[raw[p:p + length]] < doc:
                gone[p:p + length] = b"\1" * length
        spans, at = [], 0
        while (a := gone.find(b"\1", at)) >= 0:
            at = gone.find(b"\0", a)
            at = len(raw) if at < 0 else at
            spans.append((a, at - a))
        out.append((doc, len(raw), tuple(spans), bytes(x for x, g in zip(raw, gone) if not g)))
    return sorted(out, key=str)


def fast(df, **kw):
    return sorted(((r["doc_id"], r["n_bytes"], tuple((s["start"], s["length"]) for s in r["spans"]), bytes(r["kept"]))
                   for r in B.remove_repeats(df, **kw).collect()), key=str)


def test_given_documents(spark):
    for sf in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert fast(docs) == slow(rows, 50)


def passages(rng, n):
    stock = ["".join(rng.choice("ab é") for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    return ["".join(rng.choice(stock) + rng.choice(["", "x", "yz"]) for _ in range(rng.randrange(0, 7))) for _ in range(n)]


def test_shared_passages_ties_and_small_tasks(spark, monkeypatch):
    rng = random.Random(4)
    for length, many in ((50, 16), (20, 0), (33, 2)):
        rows = list(enumerate(passages(rng, 120)))
        rows += [(None, rows[3][1]), (5, rows[9][1]), (5, rows[5][1]), (500, None), (501, ""), (502, "a" * 3000), (503, "a" * 2000 + "b"), (None, None)]
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        assert fast(df, length=length, part_bytes=4000) == slow(rows, length)


def tasks(shape, rows, flush, piece):
    """The task functions by hand, with small limits."""
    B.FLUSH, B.PIECE = flush, piece
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    half = len(rows) // 2

    def meet(sent, refine):
        table = sorted((tuple(r.values()) for b in sent for r in b.to_pylist()), key=lambda r: r[0])
        got = {}
        for b in B._receive(refine)(iter([B._batch(table)])):
            for r in b.to_pylist():
                got.setdefault(r["doc_id"], {}).setdefault(r["kind"], set()).add(r["code"])
        return got

    sent = [b for part in (batch.slice(0, half), batch.slice(half)) for b in B._send_runs(shape, 3)(iter([part]))]
    runs = meet(sent, True)

    def column(found, kind):
        return pa.array([sorted(found.get(r[0], {}).get(kind, ())) for r in rows], pa.list_(pa.int64()))

    more = pa.RecordBatch.from_arrays([*batch.columns, column(runs, B._LOST), column(runs, B._REFINE)], names=["doc_id", "text", "lost", "refine"])
    strings = meet(list(B._send_strings(shape, 3)(iter([more]))), False)
    last = pa.RecordBatch.from_arrays([*more.columns, column(strings, B._LOST), pa.array([True] * len(rows))],
                                      names=["doc_id", "text", "lost", "refine", "strings", "touched"])
    return sorted(((r["doc_id"], r["n_bytes"], tuple((s["start"], s["length"]) for s in r["spans"]), r["kept"])
                   for b in B._cut(shape)(iter([last])) for r in b.to_pylist()), key=str)


def test_long_texts_in_parts():
    rng = random.Random(8)
    flush, piece = B.FLUSH, B.PIECE
    try:
        for _ in range(6):
            rows = list(enumerate(passages(rng, 20)))
            rows.append((77, "".join(passages(rng, 30))))
            rows.append((78, "q" + rows[-1][1][7:900] + "a" * 400))
            rng.shuffle(rows)
            assert tasks(B.Shape(50), rows, 40, 200) == slow(rows, 50)
    finally:
        B.FLUSH, B.PIECE = flush, piece


def test_identifiers_and_packing():
    data = np.frombuffer(b"abracadabra, abracadabra and abracadabra", np.uint8)
    for width, ids in zip((1, 2, 3, 4, 11, 13), B.identifiers(data, (1, 2, 3, 4, 11, 13))):
        assert len(ids) == len(data) - width + 1
        for i in range(len(ids)):
            for j in range(len(ids)):
                assert (ids[i] == ids[j]) == (bytes(data[i:i + width]) == bytes(data[j:j + width]))
    values = np.array([0, 1, 255, 1 << 40, (1 << 48) - 1], np.uint64)
    assert (B._unpack(B._pack(values, 6), 6) == values).all()


def test_every_string_is_in_one_run():
    rng = np.random.default_rng(1)
    for length in (8, 9, 31, 32, 33, 50, 64, 65):
        s = B.Shape(length)
        sizes = [0, 5, length, length + 1, 300, length - 1, 90]
        data = rng.integers(97, 99, sum(sizes)).astype(np.uint8)
        ends = np.cumsum(sizes)
        runs = B.Runs(data, ends, s)
        at, _, _, _ = runs.strings(np.ones(len(runs.first), bool), s)
        want = [p for e, n in zip(ends, sizes) for p in range(e - n, e - length + 1)]
        assert sorted(at.tolist()) == want


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x" * 60), (2, "x" * 60)], SCHEMA)
    wide = df.withColumns({n: F.lit("y") for n in ("d", "lost", "refine", "strings", "part", "touched", "kept")})
    assert fast(wide) == slow([(1, "x" * 60), (2, "x" * 60)], 50)
    assert B.remove_repeats(wide.limit(0)).count() == 0
