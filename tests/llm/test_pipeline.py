import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from pitwall.llm import surrogates
from test_quality import slow_counts
from test_simhash import slow_components, slow_print


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 400").cache()
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    tables = [docs]
    for name, stage in C.STAGES:
        tables.append(stage(spark, tables[-1], sf).cache())
    texts = [{r["doc_id"]: r["text"] for r in t.collect()} for t in tables[:-1]]
    for t in tables[1:-1]:
        assert t.columns == docs.columns
    sampled, ruled, unique, private = texts[1:]
    good = {i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
    assert len(good & texts[0].keys() - sampled.keys()) <= 1
    for i in ruled:
        n, _, _, _, again = slow_counts(ruled[i])
        assert n >= 10 and 100 * again <= 20 * n
    component = slow_components({i: slow_print(t) for i, t in ruled.items()})
    assert unique.keys() == set(component.values())
    assert private == {i: surrogates.replace(t, C.SURROGATE_KEY)[0] for i, t in unique.items()}
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lengths = {}
    for r in tables[-1].collect():
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in private.items()}


def test_odd_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs.limit(3).unionByName(docs.limit(1)).withColumns({"kept": F.lit("x"), "q": F.lit(1), "ids": F.lit(2)})
    odd = odd.unionByName(odd.limit(1).withColumns({c: F.lit(None).cast(t) for c, t in odd.dtypes}))
    for table in (odd, odd.limit(0)):
        kept = table
        for i, (_, stage) in enumerate(C.STAGES):
            kept = stage(spark, kept, sf)
            assert i == 4 or kept.columns == table.columns
        kept.count()
