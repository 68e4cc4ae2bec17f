import random

from pyspark.sql import functions as F

from pitwall.operators import sampling as G


def plain(sizes, k):
    loads, out = [0] * k, []
    for s in sizes:
        f = loads.index(min(loads))
        loads[f] += s
        out.append(f)
    return loads, out


def test_level_is_the_plain_loop():
    rng = random.Random(1)
    for _ in range(400):
        k = rng.randrange(2, 7)
        sizes = sorted((rng.choice([1, 2, 3, 7, 50, 400]) for _ in range(rng.randrange(0, 60))), reverse=True)
        loads, got = [0] * k, []
        for s in sorted(set(sizes), reverse=True):
            n = sizes.count(s)
            parts = G._level(loads, s, n)
            for r in range(n):
                start, turn = [p for p in parts if p[0] <= r][-1]
                got.append(turn[(r - start) % len(turn)])
        assert (loads, got) == plain(sizes, k)


def test_groups_go_to_the_lightest_fold(spark):
    rng = random.Random(2)
    sizes = {i: rng.choice([1, 1, 2, 3, 5, 40, 200]) for i in range(150)}
    sizes[None] = 17
    rows = [(g,) for g, n in sizes.items() for _ in range(n)]
    got = G.fold_group(spark.createDataFrame(rows, "g long").repartition(4), "g", k=4).groupBy("fold").count().collect()
    want, _ = plain(sorted(sizes.values(), reverse=True), 4)
    assert sorted(r["count"] for r in got) == sorted(want)
    per = G.fold_group(spark.createDataFrame(rows, "g long"), "g", k=4).groupBy("g").agg(F.count_distinct("fold").alias("n")).collect()
    assert len(per) == 151 and all(r["n"] == 1 for r in per)
