import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from pitwall.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
WELL = re.compile(r"(s?(ua)+)?\Z")


def slow_damage(rows):
    def text(x):
        return " " if x is None else str(x)

    out = []
    for conv, turn, role, said in rows:
        role, said = text(role), text(said)
        d = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        if d == 0:
            continue
        said = "" if d == 1 else re.sub("[.!?]", "", said) if d == 2 else said
        out += [(conv, turn, "user" if d == 4 else role, said)] * (2 if d == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def slow_repair(rows, bad):
    """Least (cost, audit) by trying every way through the rows, cheapest first."""
    import heapq

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, kept = heapq.heappop(heap)
        if i == len(rows) and WELL.match(roles):
            return cost, audit, kept
        if (i, roles) in done:
            continue
        done.add((i, roles))
        if len(roles) <= len(rows) + 2:
            for r in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2, audit + "I", i, roles + r[0], (*kept, (r, ""))))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, roles, kept))
            if bad[i] not in (1, 2):
                extra = int(bad[i] == 3)
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, roles + (role[:1] or "_"), (*kept, (role, text))))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, roles + r[0], (*kept, (r, text))))


def slow_report(conv, rows):
    rows = in_order(rows)
    bad = faults(rows)
    turns = [r[1] for r in rows if r[1] is not None]
    cost, audit, kept = slow_repair(rows, bad)
    initials = [r[2][:1] for r in rows]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, bad.count(1), bad.count(2), bad.count(3),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def check(spark, rows, damaged=True):
    df = spark.createDataFrame(rows, SCHEMA)
    turns = R.damage(df) if damaged else df
    got = sorted((tuple(r) for r in R.repaired_report(turns, df).collect()), key=str)
    after = slow_damage(rows) if damaged else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = []
    for conv in {r[0] for r in rows}:
        want.append(slow_report(conv, [r for r in after if r[0] == conv]))
    assert got == sorted(want, key=str)
    return got


def test_given_conversations(spark):
    for sf in ("sf0.001", "sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select(
            "conv_id", "turn", "role", "text").collect()]
        check(spark, rows)


def random_rows(rng, conv, n):
    roles = ["system", "user", "assistant", "tool", "", "s", None]
    texts = ["Hi.", "Yes!", "well", " \t", "", None, "a b?", "So. \x0b", " ", "no. "]
    return [(conv, None if rng.random() < 0.1 else rng.randrange(12), rng.choice(roles[:3] if rng.random() < 0.8 else roles),
             rng.choice(texts)) for _ in range(n)]


def test_odd_rows_and_small_fragments(spark, monkeypatch):
    rng = random.Random(5)
    rows = list(itertools.chain.from_iterable(random_rows(rng, c, rng.randrange(1, 9)) for c in [None, *range(60)]))
    check(spark, rows)
    check(spark, rows, damaged=False)


def test_fragments_do_not_matter():
    rng = random.Random(9)
    for _ in range(200):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(0, 14))]
        whole = R.parse(rows, {0: (0, "")})
        cut = rng.randrange(len(rows) + 1)
        parts = [R.parse(rows[:cut], {0: (0, "")})]
        merged = {}
        for start, (cost, audit) in parts[0].items():
            for stop, (c, a) in R.parse(rows[cut:], {start: (0, "")}).items():
                merged[stop] = min(merged.get(stop, (99, "")), (cost + c, audit + a))
        assert merged == whole


def test_one_long_conversation_in_many_fragments(spark):
    rng = random.Random(2)
    rows = [(7, i // 2, rng.choice(["user", "assistant"]), f"text {i}" + rng.choice([".", "", "!"])) for i in range(5000)]
    rows += [(8, 0, "user", "x" * 300_000 + "."), (8, 1, "assistant", "y.")]
    df = spark.createDataFrame(rows, SCHEMA)
    report, lines = R.repair(df)
    assert lines.where("conv_id = 7").count() > 4
    found = {r["conv_id"]: r for r in report.collect()}
    assert found[8]["audit"] == "KK" and found[8]["cost"] == 0
    ordered = in_order([r for r in rows if r[0] == 7])
    best = min(v for s, v in R.parse([(r[2][:1], b in (1, 2), b == 3) for r, b in zip(ordered, faults(ordered))], {0: (0, "")}).items()
               if s in R.FINAL)
    assert (found[7]["cost"], found[7]["audit"]) == best
    kept = R.replay([(r[2], r[3]) for r in ordered], best[1], 0)
    got = [(r["role"], r["text"]) for r in R.repaired_rows(lines).where("conv_id = 7").orderBy("part", "seq", "place").collect()]
    assert got == kept
    digest = {r["conv_id"]: r["repaired_sha256"] for r in R.digests(lines).collect()}
    assert digest[7] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], SCHEMA)
    names = ["part", "seq", "blank", "order", "digest", "first", "c", "r", "d", "cost", "__d"]
    wide = df.withColumns({n: F.lit("x") for n in names})
    report, lines = R.repair(wide)
    assert [r["audit"] for r in report.collect()] == ["KK"]
    assert R.repaired_report(R.damage(wide.limit(0)), wide.limit(0)).count() == 0
    assert R.damage(wide).columns == ["conv_id", "turn", "role", "text"]
