"""URL filter: listed rules, and for the rest naive Bayes over segmented names.

Host labels are split into words by unigram Viterbi; words and path tokens are
scored by multinomial naive Bayes, learnt from the urls that a rule judges.
Word counts, tokens and weights stay tables; nothing of them is collected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.session import materialise

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]
#: Longest word that Viterbi tries; a host label itself has at most 63 characters.
WORD, LABEL = 24, 63
SMOOTHING = 1.0


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the columns host and path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def path_tokens(path: Column) -> Column:
    """Lower-cased runs of letters and digits; numbers are one token."""
    tokens = F.split(F.lower(path), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(tokens, lambda t: t != ""), lambda t: F.when(t.rlike(r"^\p{N}+$"), F.lit("0")).otherwise(t))


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): how often each word stands alone in the paths and page titles of all rows."""
    title = F.coalesce(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title", 1), F.lit(""))
    texts = F.concat_ws(" ", path_of(F.col("url")), title)
    words = pages.select(F.explode(F.split(F.lower(texts), r"[^\p{L}]+")).alias("word"))
    return words.filter("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(label: str, known: dict[str, int], total: float) -> list[str]:
    """The likeliest split of a label; unknown words pay for their length."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - WORD), end):
            n = known.get(label[start:end])
            cost = math.log(n / total) if n else -math.log(total) - 3.0 * (end - start)
            options.append((best[start][0] + cost, -start))
        score, start = max(options)
        best.append((score, -start))
    words, end = [], len(label)
    while end:
        start = best[end][1]
        words.append(label[start:end])
        end = start
    return words[::-1]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _segment(labels: pd.Series, words: pd.Series, counts: pd.Series, totals: pd.Series) -> pd.Series:
    return pd.Series([viterbi(a, dict(zip(w, n)), float(t)) for a, w, n, t in zip(labels, words, counts, totals)], dtype=object)


def segment(labels: DataFrame, words: DataFrame) -> DataFrame:
    """(label, words) of distinct labels (column ``label``, letters, up to 63).

    Each label's substrings meet the word table in a join; a label has at most
    63 x 24 of them, so the split sees all known words of a label and no more.
    """
    cut = F.explode(F.expr(f"flatten(transform(sequence(1, length(label)), i -> transform(sequence(1, least({WORD}, length(label) - i + 1)), k -> substr(label, i, k))))"))
    found = labels.select("label", cut.alias("word")).distinct().join(words, "word", "left").filter("n is not null")
    lists = found.groupBy("label").agg(F.collect_list("word").alias("ws"), F.collect_list("n").alias("ns"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double") + 1.0)
    empty = lambda c: F.coalesce(F.col(c), F.array())
    return (labels.join(lists, "label", "left").crossJoin(F.broadcast(total.toDF("total")))  # one row: the count of all words
            .select("label", _segment("label", empty("ws").cast("array<string>"), empty("ns").cast("array<long>"), "total").alias("words")))


def host_tokens(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, tokens) of distinct hosts: the words of all labels but the last,
    which is the public suffix.  Digits are one token; labels longer than a DNS
    label are kept whole."""
    labels = F.split("host", r"\.")
    inner = F.when(F.size(labels) > 1, F.slice(labels, 1, F.size(labels) - 1)).otherwise(F.array().cast("array<string>"))
    runs = hosts.select("host", F.posexplode(F.flatten(F.transform(inner, lambda x: F.split(x, r"[^\p{L}\p{N}]+|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")))).alias("at", "label")).filter("label != ''")
    runs = materialise(runs)
    split = materialise(segment(runs.filter(rf"label rlike '^\\p{{L}}+$' and length(label) <= {LABEL}").select("label").distinct(), words))
    token = F.when(F.col("label").rlike(r"^\p{N}+$"), F.array(F.lit("0"))).otherwise(F.coalesce("words", F.array("label")))
    return (runs.join(split, "label", "left").select("host", F.posexplode(token).alias("k", "token"))
            .groupBy("host").agg(F.collect_list("token").alias("tokens")))


def weights(names: DataFrame) -> tuple[DataFrame, float]:
    """((token, weight), prior): log P(token|block) - log P(token|allow) of the
    judged names (columns tokens, verdict, n) and the log odds of the classes."""
    known = names.filter("verdict is not null")
    classes = {r["verdict"]: r["n"] for r in known.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}  # two rows
    block, allow = classes.get("block", 0), classes.get("allow", 0)
    of = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0))
    found = materialise(known.select("verdict", "n", F.explode("tokens").alias("token")).groupBy("token").agg(
        of("block").alias("b"), of("allow").alias("a")))
    sums = found.agg(F.count(F.lit(1)).alias("v"), F.sum("b").alias("b"), F.sum("a").alias("a")).first()
    size = SMOOTHING * max(1, sums["v"])
    weight = (F.log((F.col("b") + SMOOTHING) / ((sums["b"] or 0) + size)) - F.log((F.col("a") + SMOOTHING) / ((sums["a"] or 0) + size)))
    return materialise(found.select("token", weight.alias("weight"))), math.log((block + 1) / (allow + 1))


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row.

    score is the log odds of block for names that no rule judges (NULL where one
    does).  Tokens that no judged url has count nothing.  NULL urls and urls
    without :// have an empty host and path and get the classes' odds; on an
    empty table there are no rows.
    """
    mine = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(rules)
    ruled = mine.withColumn("rule", rule).withColumn("verdict", verdict)
    names = materialise(ruled.groupBy("host", "path", "verdict").agg(F.count(F.lit(1)).alias("n")))
    words = materialise(word_counts(pages))
    of_host = materialise(host_tokens(names.select("host").distinct(), words))
    tokens = F.concat(F.coalesce(F.col("tokens"), F.array().cast("array<string>")), path_tokens(F.col("path")))
    names = materialise(names.join(of_host, "host", "left").withColumn("tokens", tokens))
    weight, prior = weights(names)
    scores = (names.filter("verdict is null").select("host", "path", F.explode_outer("tokens").alias("token"))
              .join(weight, "token", "left").groupBy("host", "path").agg((F.coalesce(F.sum("weight"), F.lit(0.0)) + prior).alias("score")))
    scores = materialise(scores)
    return ruled.join(scores, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.when(F.col("verdict").isNull(), F.col("score")).alias("score"))
