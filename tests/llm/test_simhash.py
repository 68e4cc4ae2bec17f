import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from pitwall.llm import simhash as S


def slow_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows):
    """rows: {id: fp}; union of all pairs at three bits or fewer."""
    ids, root = sorted(rows), {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (rows[a] ^ rows[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_documents_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    want = {i: slow_print(t) for i, t in texts.items()}
    got = {r["doc_id"]: r for r in S.near_duplicates(docs).collect()}
    assert {i: r["fp"] & (1 << 64) - 1 for i, r in got.items()} == want
    assert {i: r["component_id"] for i, r in got.items()} == slow_components(want)


def test_links_with_small_and_large_keys(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base[:6]:
        for _ in range(60):
            fps.add(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 5))))
    fps = sorted(fps)
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in fps]
    df = spark.createDataFrame(signed, "fp long")
    rows = dict(enumerate(fps))
    want = slow_components(rows)
    for limit in (S.KEY_ROWS, 5):
        edges = S.links(df, key_rows=limit).collect()
        assert all(((e["u"] ^ e["v"]) & (1 << 64) - 1).bit_count() <= 3 for e in edges)
        at = {x: i for i, (x,) in enumerate(signed)}
        roots = {r["node"]: r["root"] for r in S.components(spark.createDataFrame([(e["u"], e["v"]) for e in edges], "u long, v long")).collect()}
        groups = {}
        for (x,) in signed:
            groups.setdefault(roots.get(x, x), set()).add(at[x])
        assert sorted(map(sorted, groups.values())) == sorted(sorted(i for i in want if want[i] == r) for r in set(want.values()))


def test_odd_rows(spark):
    rows = [(1, "a b c d"), (2, None), (3, ""), (4, " \n\t"), (5, "A  b\tC d"), (5, "A  b\tC d"), (None, "x y"), (7, "é x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("key", F.lit(1))
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in S.near_duplicates(docs).collect())
    assert got == [(-1, -1), (1, 1), (2, 2), (3, 2), (4, 2), (5, 1), (5, 1), (7, 7)]
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 7]
    assert S.near_duplicates(docs.limit(0)).count() == 0
    assert S.drop_near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    rows = [(1, "a b c d"), (5, "A b c d"), (5, "quite another text here"), (5, "quite another text here"),
            (None, "copies without a name"), (None, "copies without a name"), (None, "a b c d"), (9, "quite another TEXT here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("named", "digest", "root", "fp")})
    kept = sorted(((r["doc_id"], r["text"]) for r in S.drop_near_duplicates(docs).collect()), key=str)
    assert kept == [(1, "a b c d"), (5, "quite another text here"), (None, "copies without a name")]


def test_very_long_text():
    long = " ".join(f"w{i}" for i in range(200_000))
    assert S.simhash(long) & (1 << 64) - 1 == slow_print(long)
