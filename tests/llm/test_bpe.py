import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pitwall.llm import bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = B.read_ranks(PATH)
    return B.load(PATH, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="ab '\n\tsé日 .!9", max_size=60), st.text(alphabet="aeinrst", max_size=80)))
def test_equal_to_the_library(text):
    own, other = B.load(PATH, P.PATTERN), _library()
    try:
        want = other.encode_ordinary(text)
    except UnicodeEncodeError:
        return
    assert own.encode(text).tolist() == want
    assert own.decode(want) == text.encode()


_known = []


def _library():
    if not _known:
        _known.append(tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={}))
    return _known[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="ab  \n\u00a0\x1c'sé日.", max_size=30), st.just("x" * 70 + "ing")), max_size=6))
def test_texts_together(texts):
    own = B.load(PATH, P.PATTERN)
    assert [ids.tolist() for ids in own.encode_texts(texts)] == [_library().encode_ordinary(t) for t in texts]


def test_steps_agree_with_single_tables(both):
    own, rng = both[0], random.Random(8)
    ids, steps = sorted(own.bytes_of), both[0]._together()
    pairs = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(20_000)]
    a, b = np.array(pairs).T
    want = [own.may_follow(ids[x], ids[y]) for x, y in pairs]
    assert steps.may_follow(a, b).tolist() == steps.may_follow(a, b).tolist() == want and len(set(want)) == 2
    pieces = [bytes(rng.choice(b"aeinrst ") for _ in range(rng.randrange(1, 60))) for _ in range(2000)]
    flat, sizes = steps.encode(pieces)
    assert own._ids[flat].tolist() == [i for p in pieces for i in B.PrefixTable(own, p).ids()] and len(sizes) == 2000


def test_appends_and_edits(both):
    own, other = both
    rng = random.Random(5)
    words = ["the", " straße", "  ", "\n", "'ll", "1234", " ération", "日本語", "!!", " a", "aaaaaaa", "'", " "]
    text, kept = "", B.EncodedText(own)
    for _ in range(300):
        at, new = rng.randrange(len(text) + 1), rng.choice(words)
        gone = rng.choice([0, 0, 1, 3]) if at + 3 <= len(text) else 0
        if rng.random() < 0.3:
            at, gone = len(text), 0
        text = text[:at] + new + text[at + gone:]
        kept.replace(at, gone, new)
        assert kept.text == text and kept.ids() == other.encode_ordinary(text)
    data = b"".join(rng.choice([b"un", b"able", b"ness", b"tion", b"s"]) for _ in range(200))
    table = B.PrefixTable(own, data)
    for _ in range(60):
        at, gone, new = rng.randrange(len(table.data) - 5), rng.randrange(3), rng.choice([b"", b"x", b"tion"])
        changed = table.data[:at] + new + table.data[at + gone:]
        table.replace(at, gone, new)
        assert table.data == changed and table.ids() == B.PrefixTable(own, changed).ids()
    table.append(b"ing")
    assert table.ids() == B.PrefixTable(own, table.data).ids()


def test_documents_and_odd_rows(spark, sf, both):
    from pitwall.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for r in B.encode(docs, PATH, P.PATTERN).select("text", "ids").collect():
        assert r["ids"] == both[1].encode_ordinary(r["text"])
    rows = [(1, None), (2, ""), (3, "a" * 30_000), (4, " \n " * 1000), (None, "x  y "), (4, "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    got = B.decode(B.encode(odd, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    for r in got:
        assert r["ids"] == both[1].encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert sorted(map(str, B.encode_and_decode(odd.withColumn("ids", odd["text"]), PATH, P.PATTERN).collect())) == sorted(map(str, got))
    assert B.encode(odd.limit(0), PATH, P.PATTERN).count() == 0
    result = QUERIES["op7_bpe_prefix_tables"](spark, sf)
    assert result.count() == docs.count() and result.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
