import math
import re
from collections import Counter, defaultdict
from itertools import product

from pyspark.sql import functions as F

from pitwall.llm import url_filter as U
from pitwall.llm.queries import RULES


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def slow_rule(host, path):
    fit = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: len(r[1] + r[2]), default=(None, "", ""))


def test_viterbi_is_the_best_of_all_splits():
    known = {"cheap": 50, "pill": 20, "pills": 30, "che": 2, "ap": 3, "s": 1}
    for label in ("cheappills", "pillsx", "apap", "q"):
        def cost(words):
            return sum(math.log(known[w] / 107) if w in known else -math.log(107) - 3.0 * len(w) for w in words)
        splits = []
        for cuts in product([0, 1], repeat=len(label) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(label)]
            splits.append([label[a:b] for a, b in zip(at, at[1:])])
        assert math.isclose(cost(U.viterbi(label, known, 107.0)), max(map(cost, splits)))


def test_pages_match_brute_force(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = pages.collect()
    got = {r["page_id"]: r for r in U.judge(pages, RULES).collect()}
    assert len(got) == len(rows)
    words = Counter()
    for r in rows:
        title = re.search(r"(?is)<title[^>]*>(.*?)</title", r["html"])
        words.update(w for w in re.split(r"[^a-zà-öø-ÿß]+", (slow_parts(r["url"])[1] + " " + (title[1] if title else "")).lower()) if w)
    total = float(sum(words.values()) + 1)

    def tokens(host, path):
        out = []
        for label in host.split(".")[:-1]:
            for run in re.findall(r"[a-z]+|[0-9]+", label):
                out += ["0"] if run.isdigit() else U.viterbi(run, words, total)
        return out + ["0" if t.isdigit() else t for t in re.split(r"[^a-z0-9]+", path.lower()) if t]

    counts, classes = defaultdict(Counter), Counter()
    for r in rows:
        host, path = slow_parts(r["url"])
        verdict = slow_rule(host, path)[0]
        if verdict:
            classes[verdict] += 1
            counts[verdict].update(tokens(host, path))
    vocabulary = set(counts["block"]) | set(counts["allow"])

    def log_p(t, c):
        return math.log((counts[c][t] + 1) / (sum(counts[c].values()) + len(vocabulary)))

    for r in rows:
        host, path = slow_parts(r["url"])
        verdict, rule_host, rule_path = slow_rule(host, path)
        g = got[r["page_id"]]
        assert (g["host"], g["path"], g["rule"]) == (host, path, rule_host + rule_path if verdict else None)
        if verdict:
            assert g["verdict"] == verdict and g["score"] is None
        else:
            score = math.log((classes["block"] + 1) / (classes["allow"] + 1)) + sum(
                log_p(t, "block") - log_p(t, "allow") for t in tokens(host, path) if t in vocabulary)
            assert math.isclose(g["score"], score, abs_tol=1e-6) and g["verdict"] == ("block" if g["score"] > 0 else "allow")


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no scheme", "<title>x"), (None, "HTTP://WWW.Example.COM/en/x?y://z", None),
            (4, "a://b://c/d", ""), (4, "a://b://c/d", ""), (5, "x://" + "q" * 5000 + ".net/es/", ""), (6, "x://net/es/\n1", "é"), (7, "x://a.org#/p", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("verdict", F.lit("z"))
    got = U.judge(pages, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        url = next(u for i, u, _ in rows if i == r["page_id"])
        assert (r["host"], r["path"]) == slow_parts(url) and r["verdict"] in ("allow", "block")
    assert U.judge(pages.limit(0), RULES).count() == 0
