"""Nearest neighbours over a hierarchical k-means tree, best bin first.

The tree is fitted on a bounded sample; every vector is dealt to a leaf.  A query
walks the tree with a priority queue, the branch with the largest inner product
bound first, and visits as many leaves as a calibration against brute force asks
for.  Leaves meet their queries in a shuffle, both cut into blocks of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.session import materialise

#: Vectors that the tree is fitted on, taken in hash order; with the branching
#: and the leaf size this bounds the tree that goes to every task.
SAMPLE = 40_000
BRANCHES = 8
#: Largest share of the sample in a leaf, so that the tree has the same size at
#: every number of rows, and sample vectors that are never split further.
LEAF_SHARE, LEAF = 0.01, 16
ROUNDS = 8
#: Queries that the number of visits is calibrated with, and the recall they must reach.
CALIBRATION, RECALL = 200, 0.97
#: Vectors of a leaf in one block, and queries that one task holds against a block.
BLOCK, ASKERS = 4_096, 16_384
SEED = 5


class Tree:
    """Inner nodes hold their children's centroids; a centroid keeps the radius of its sample."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, rounds: int = ROUNDS, seed: int = SEED):
        self.children: list[list[int]] = [[]]
        self.centroids, self.radii = [sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])], [0.0]
        self.leaf_of: dict[int, int] = {}
        rng = np.random.default_rng(seed)
        waiting = [(0, sample)]
        while waiting:
            node, rows = waiting.pop()
            parts = self._split(rows, branches, rounds, rng) if len(rows) > leaf else []
            if len(parts) < 2:
                self.leaf_of[node] = len(self.leaf_of)
                continue
            for part in parts:
                centre = part.mean(axis=0)
                self.children[node].append(len(self.children))
                waiting.append((len(self.children), part))
                self.children.append([])
                self.centroids.append(centre)
                self.radii.append(float(np.sqrt(((part - centre) ** 2).sum(axis=1).max())))
        self.centroids, self.radii = np.array(self.centroids), np.array(self.radii)

    @staticmethod
    def _split(rows: np.ndarray, branches: int, rounds: int, rng) -> list[np.ndarray]:
        centres = rows[rng.choice(len(rows), min(branches, len(rows)), replace=False)]
        for _ in range(rounds):
            at = (rows @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1)
            centres = np.array([rows[at == k].mean(axis=0) if (at == k).any() else centres[k] for k in range(len(centres))])
        return [part for k in range(len(centres)) if len(part := rows[at == k])]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: nearest centroid from level to level."""
        out = np.zeros(len(vectors), dtype=np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            below = self.children[node]
            if not below:
                out[rows] = self.leaf_of[node]
                continue
            centres = self.centroids[below]
            at = (vectors[rows] @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1)
            waiting += [(child, rows[at == k]) for k, child in enumerate(below)]
        return out

    def best_bins(self, query: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves in the order of the priority queue.  A branch
        is rated by its centroid's inner product and a tenth of what its radius could add."""
        length = float(np.linalg.norm(query))
        queue, out = [(0.0, 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                out.append(self.leaf_of[node])
                continue
            rated = self.centroids[below] @ query + 0.1 * length * self.radii[below]
            for child, rate in zip(below, rated.tolist()):
                heapq.heappush(queue, (-rate, child))
        return out


def _matrix(vectors) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64) if len(vectors) else np.zeros((0, 1))


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): rows with an id and a finite, non-zero vector without NULLs, of
    the length that most such vectors have (the smaller one at a tie)."""
    v = F.col("embedding").cast("array<double>")
    size = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        "vec_id is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))").filter(size > 0)
    usual = rows.groupBy(F.size("v").alias("usual")).count().orderBy(F.desc("count"), "usual").limit(1).select("usual")
    return rows.join(F.broadcast(usual), F.size("v") == F.col("usual")).select("vec_id", "v")  # one row


def _assign(rows: DataFrame, tree) -> DataFrame:
    schema = "vec_id long, v array<double>, leaf long"

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(leaf=tree.value.leaves(_matrix(batch["v"])) if len(batch) else np.zeros(0, np.int64))

    return rows.mapInPandas(deal, schema)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: largest score, then smallest id; ties at the border are all looked at."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


_FOUND = "query_id long, vec_id long, score double"


def _search_blocks(candidates: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query in each block of a leaf;
    a group is one block and one part of the leaf's queries."""

    def search(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        ids, vectors = block["vec_id"].to_numpy(), _matrix(block["v"])
        out = []
        for start in range(0, len(queries), 256):
            part = queries.iloc[start:start + 256]
            scores = _matrix(part["v"]) @ vectors.T
            for query, row in zip(part["query_id"].tolist(), scores):
                row[ids == query] = -np.inf
                places = _top(row, ids, k)
                out += [(query, i, s) for i, s in zip(ids[places].tolist(), row[places].tolist()) if i != query]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = "leaf", "block", "part"
    return visits.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(search, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact(rows: DataFrame, queries: DataFrame, k: int, limit: int) -> DataFrame:
    """Brute force for up to ``limit`` queries (which the caller bounds) against all
    rows: each task scores its own rows, and only its k best for each query are
    merged."""
    asked = queries.limit(limit).toPandas()
    ids, wanted = asked["vec_id"].to_numpy(), _matrix(asked["v"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = [(np.zeros(0), np.zeros(0, np.int64)) for _ in ids]
        for batch in batches:
            if not len(batch):
                continue
            own = batch["vec_id"].to_numpy()
            scores = wanted @ _matrix(batch["v"]).T
            for q, row in enumerate(scores):
                s, i = np.concatenate((kept[q][0], row[own != ids[q]])), np.concatenate((kept[q][1], own[own != ids[q]]))
                places = _top(s, i, k)
                kept[q] = s[places], i[places]
        yield pd.DataFrame([(int(ids[q]), int(i), float(s)) for q, (ss, ii) in enumerate(kept) for s, i in zip(ss, ii)],
                           columns=["query_id", "vec_id", "score"])

    return _best(rows.mapInPandas(scan, _FOUND), k).select("query_id", "vec_id", "score", "rank")


def calibrate(tree: Tree, truth: pd.DataFrame, queries: pd.DataFrame, leaf_of: dict[int, int], recall: float) -> int:
    """Fewest visits with which the calibration queries find ``recall`` of their
    true neighbours; twice as many again as a margin below one in twenty leaves."""
    leaves = len(tree.leaf_of)
    place = []
    vectors = dict(zip(queries["vec_id"].tolist(), _matrix(queries["v"])))
    for query, group in truth.groupby("query_id"):
        order = {leaf: n + 1 for n, leaf in enumerate(tree.best_bins(vectors[query], leaves))}
        place += [order[leaf_of[i]] for i in group["vec_id"].tolist()]
    if not place:
        return leaves
    return int(np.sort(place)[min(len(place), math.ceil(recall * len(place))) - 1])


def nearest(embeddings: DataFrame, queries: "Column", k: int = 20, sample: int = SAMPLE, recall: float = RECALL,  # noqa: F821
            block: int = BLOCK, askers: int = ASKERS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found (largest inner product,
    ties to the smaller id) of the rows for which ``queries`` holds, among all
    other rows.

    Equal vectors are one in the index; of their ids the k + 1 smallest are kept,
    as no query can return more, so a vector with very many copies is one row.  A
    leaf with more than ``block`` vectors is cut by a hash of the id, and a query
    asks all its blocks.  Equal queries are searched once, and a leaf that more than
    ``askers`` of them visit meets them in parts of that size.  Rows without an id or a usable vector take no part.
    Rows that repeat an id with an equal vector count once.
    """
    spark = embeddings.sparkSession
    rows = materialise(usable(embeddings).distinct())
    order = Window.partitionBy("v").orderBy("vec_id")
    slim = materialise(rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1))
    heads = slim.filter("n = 1").select("vec_id", "v")
    copies = slim.select("v", F.col("vec_id").alias("copy")).join(heads, "v").select("vec_id", "copy")
    fitted = heads.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    if not len(fitted):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = Tree(_matrix(fitted["v"]), leaf=max(LEAF, math.ceil(LEAF_SHARE * len(fitted))))
    shared = spark.sparkContext.broadcast(tree)  # nodes are bounded by the sample
    dealt = materialise(_assign(heads, shared))
    asked = materialise(rows.filter(queries).select(F.col("vec_id").alias("query_id"), "v")
                        .join(heads.withColumnRenamed("vec_id", "head"), "v").select("query_id", "head"))
    wanted = materialise(heads.join(asked.select(F.col("head").alias("vec_id")).distinct(), "vec_id").select(F.col("vec_id").alias("query_id"), "v"))

    trial = wanted.orderBy(F.xxhash64("query_id", F.lit(SEED)), "query_id").limit(CALIBRATION).select(F.col("query_id").alias("vec_id"), "v")
    trial = materialise(trial)
    truth = exact(heads, trial, k, CALIBRATION).join(dealt.select("vec_id", "leaf"), "vec_id").select("query_id", "vec_id", "leaf").toPandas()
    visits = calibrate(tree, truth, trial.toPandas(), dict(zip(truth["vec_id"].tolist(), truth["leaf"].tolist())), recall)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins = [shared.value.best_bins(v, visits) for v in _matrix(batch["v"])] if len(batch) else []
            lengths = [len(b) for b in bins]
            yield pd.DataFrame({"query_id": np.repeat(batch["query_id"].to_numpy(), lengths),
                                "leaf": np.array([x for b in bins for x in b], dtype=np.int64)})

    walked = materialise(wanted.mapInPandas(walk, "query_id long, leaf long"))
    blocks, parts = (F.ceil(F.count(F.lit(1)) / size).cast("int") for size in (block, askers))
    sizes = materialise(dealt.groupBy("leaf").agg(blocks.alias("blocks")).join(walked.groupBy("leaf").agg(parts.alias("parts")), "leaf"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own_of = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    candidates = dealt.join(sizes, "leaf").select("vec_id", "v", "leaf", own_of("vec_id", "blocks").alias("block"), every("parts").alias("part"))
    visited = walked.join(wanted, "query_id").join(sizes, "leaf").select(
        "query_id", "v", "leaf", every("blocks").alias("block"), own_of("query_id", "parts").alias("part"))
    found = materialise(_best(_search_blocks(candidates, visited, k), k).select("query_id", "vec_id", "score"))
    own = wanted.select("query_id", F.col("query_id").alias("vec_id"), F.aggregate(  # a query's copies are as near as itself
        F.transform("v", lambda x: x * x), F.lit(0.0), lambda a, x: a + x).alias("score"))
    near = found.unionByName(own).join(copies, "vec_id").select("query_id", F.col("copy").alias("vec_id"), "score")
    lists = _best(near, k + 1).groupBy(F.col("query_id").alias("head")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))  # k + 1 entries at most
    mine = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    answers = asked.join(lists, "head").select("query_id", F.posexplode(mine).alias("rank", "hit"))
    return answers.select("query_id", (F.col("rank") + 1).alias("rank"), "hit.vec_id", "hit.score")
