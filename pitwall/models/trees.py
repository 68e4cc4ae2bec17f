"""Forests and boosted trees on the sparse rows of an ``Encoder``.

MLlib's trees keep a bin for each slot of each row, which is rows times categories.
Here a row keeps one number for each column (the slot of its category, the bin of
its number), and a pass costs what is set in a row.  Splits, gains and leaves are
MLlib's: a category's slot against the rest, a number against one of 31 cuts.

A level of all trees is one job: tasks sum up the statistics of their rows by
(node, slot, bin), the sums of a node meet in one task, which returns its best split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.models.dictionary import sparse_parts
from pitwall.session import materialise, passing_shuffles

BINS = 32
#: Rows that the cuts of numbers are taken from (all, if fewer); every row is trained on.
CUT_ROWS = 100_000
#: Sums that a task holds at a time, and rows that it works on at a time.
CELLS, BLOCK = 2_000_000, 65_536
#: Boosting steps after which their sum is written with the rows.
STEPS = 5

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


# ------------------------------------------------------------ rows

@dataclass
class Layout:
    """Slots of the feature vector: categories by their offsets, then numbers with their cuts."""

    size: int
    offsets: list[int]
    cuts: list[list[float]]

    @property
    def first(self) -> int:
        return self.size - len(self.cuts)

    def split_vectors(self, indices: pa.ListArray, values: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each category (-1 for none) and the numbers of each row."""
        ends = indices.offsets.to_numpy()
        row = np.repeat(np.arange(len(indices)), np.diff(ends))
        index = indices.flatten().to_numpy(zero_copy_only=False)
        value = values.flatten().to_numpy(zero_copy_only=False)
        number = index >= self.first
        slots = np.full((len(indices), len(self.offsets)), -1, np.int32)
        slots[row[~number], np.searchsorted(self.offsets, index[~number], "right") - 1] = index[~number]
        numbers = np.zeros((len(indices), self.size - self.first))
        numbers[row[number], index[number] - self.first] = value[number]
        return slots, numbers

    def binned(self, numbers: np.ndarray) -> np.ndarray:
        out = np.empty(numbers.shape, np.uint8)
        for j, cuts in enumerate(self.cuts):
            out[:, j] = np.searchsorted(cuts, numbers[:, j], "left")
        return out

    def matrix(self, indices: pa.ListArray, values: pa.ListArray) -> np.ndarray:
        slots, numbers = self.split_vectors(indices, values)
        return np.asfortranarray(np.column_stack([slots, self.binned(numbers).astype(np.int32)]))


def find_cuts(x: np.ndarray, bins: int = BINS) -> list[float]:
    """Up to ``bins`` - 1 cuts between neighbouring values, with about equally many rows between them."""
    values, counts = np.unique(x, return_counts=True)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle.tolist()
    step = len(x) / bins
    out, seen, target = [], np.cumsum(counts), step
    for i in range(1, len(values)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(float(middle[i - 1]))
            target += step
    return out


def _layout(rows: DataFrame, facts: Mapping, n: int, seed: int) -> Layout:
    plain = Layout(facts["size"], [c["offset"] for c in facts["categories"]], [[]] * len(facts["numbers"]))

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = plain.split_vectors(batch.column("indices"), batch.column("values"))
            yield pa.RecordBatch.from_pydict({"j": np.tile(np.arange(x.shape[1], dtype=np.int32), len(x)), "x": x.ravel()})

    def cut(j: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"j": [j[0]], "cuts": [find_cuts(part["x"].to_numpy())]})

    few = rows if n <= CUT_ROWS else rows.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 32)) < int(CUT_ROWS / n * (1 << 32)))
    found = few.mapInArrow(long, "j int, x double").groupBy("j").applyInPandas(cut, "j int, cuts array<double>").collect() if plain.cuts else []
    by = {r["j"]: list(r["cuts"]) for r in found}  # a row a number
    return Layout(plain.size, plain.offsets, [by.get(j, []) for j in range(len(plain.cuts))])


def _compact(rows: DataFrame, layout: Layout) -> DataFrame:
    """Rows as id, label, weight, slots and bins; written once and read by every level.  ``f`` is the sum of earlier trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, numbers = layout.split_vectors(batch.column("indices"), batch.column("values"))
            bins = layout.binned(numbers)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "label", "weight")] + [
                    pa.array([r.tobytes() for r in slots], pa.binary()), pa.array([r.tobytes() for r in bins], pa.binary())],
                names=["id", "label", "weight", "slots", "bins"])

    made = rows.mapInArrow(run, "id long, label double, weight double, slots binary, bins binary")
    return materialise(made.withColumn("f", F.lit(0.0)))


def _advance(rows: DataFrame, layout: Layout, trees: Sequence[tuple[float, tuple]]) -> DataFrame:
    """Rows with the trees added to ``f``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, f, z in _blocks(iter([batch]), layout):
                f = pa.array(f + _boosted_sum(trees, z, len(layout.offsets)))
                yield batch.set_column(batch.schema.get_field_index("f"), "f", f)

    return materialise(rows.mapInArrow(run, rows.schema))


def _fixed(column: pa.BinaryArray, kind: type, width: int) -> np.ndarray:
    """Binary cells of ``width`` numbers as a matrix, without a copy."""
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    held = np.frombuffer(column.buffers()[2], np.uint8) if width else np.empty(0, np.uint8)
    return held[start:start + len(column) * width * np.dtype(kind).itemsize].view(kind).reshape(len(column), width)


def _blocks(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[tuple[np.ndarray, ...]]:
    """(id, label, weight, sum of earlier trees, matrix) of about ``BLOCK`` rows at a time."""
    categories, numbers = len(layout.offsets), len(layout.cuts)

    def block(held: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
        z = np.empty((sum(b.num_rows for b in held), categories + numbers), np.int32, order="F")
        at = 0
        for b in held:
            z[at:at + b.num_rows, :categories] = _fixed(b.column("slots"), np.int32, categories)
            z[at:at + b.num_rows, categories:] = _fixed(b.column("bins"), np.uint8, numbers)
            at += b.num_rows
        return *(np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("id", "label", "weight", "f")), z

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= BLOCK:
            yield block(held)
            held, n = [], 0
    if held:
        yield block(held)


def _uniform(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A number in [0, 1) for each row, the same in whatever task the row is."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)) / float(1 << 53)


# ------------------------------------------------------------ trees

@dataclass
class Tree:
    """Nodes in lists: the column tested (-1 in a leaf), its slot or bin, the first of two children, the mean."""

    column: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[list[float]] = field(default_factory=lambda: [[]])
    gains: dict[int, float] = field(default_factory=dict)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.column), np.array(self.cut), np.array(self.left), np.array(self.value, dtype=float)


def walk(tree: tuple[np.ndarray, ...], z: np.ndarray, categories: int) -> np.ndarray:
    """The leaf of each row."""
    column, cut, left, _ = tree
    at = np.zeros(len(z), np.int64)
    live = np.arange(len(z)) if column[0] >= 0 else np.empty(0, np.int64)
    cells = z.ravel(order="F")  # a view, columns are kept one after the other
    while len(live):
        node = at[live]
        tested = column[node]
        x, against = cells[tested * len(z) + live], cut[node]
        at[live] = node = left[node] + np.where(tested < categories, x == against, x > against)
        live = live[column[node] >= 0]
    return at


def _boosted_sum(trees: Sequence[tuple[float, tuple]], z: np.ndarray, categories: int) -> np.ndarray:
    """Sum of (factor, tree)."""
    out = np.zeros(len(z))
    for factor, tree in trees:
        out += factor * tree[3][walk(tree, z, categories), 0]
    return out


@dataclass
class _Group:
    """Open nodes of some trees that one job splits: per tree its nodes' numbers within the job, and
    the (node, slot) pairs that may be split on, or None for all."""

    nodes: list[tuple[int, int]]
    pairs: np.ndarray | None  # node * size + slot, ascending


def _sums(layout: Layout, group: _Group, trees: Sequence[tuple], before: Sequence[tuple[float, tuple]], spec: Spec, begun: bool, y0: float, classes: int):
    """Rows to the sums of (rows, weight, targets) by node, slot and bin; slot -1 has the whole node."""
    first, size, categories, numbers = layout.first, layout.size, len(layout.offsets), len(layout.cuts)
    width, count, k = first + numbers * BINS, len(group.nodes), 2 + (classes if classes and not spec.boosted else 1)
    if group.pairs is not None:
        is_number = group.pairs % size >= first
        start = np.concatenate([[0], np.cumsum(np.where(is_number, BINS, 1))])
        number_pairs = np.flatnonzero(is_number)
    cells = count * width if group.pairs is None else int(start[-1])
    place: dict[int, dict[int, int]] = {}
    for i, (tree, node) in enumerate(group.nodes):
        place.setdefault(tree, {})[node] = i

    def targets(label, f, z) -> np.ndarray:
        if spec.boosted:
            y = 2 * label - 1 if classes else label
            if begun:
                f = f + _boosted_sum(before, z, categories)
                y = 4 * y / (1 + np.exp(np.minimum(2 * y * f, 700))) if classes else 2 * (y - f)
            return (y - y0)[:, None]
        return np.eye(classes)[label.astype(int)] if classes else (label - y0)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((k, count)), np.zeros((k, cells))

        def add(where: np.ndarray, stats: np.ndarray) -> None:
            for i in range(k):
                sums[i] += np.bincount(where, stats[i], cells) if len(where) > cells / 8 else 0
            if len(where) <= cells / 8:
                for i in range(k):
                    np.add.at(sums[i], where, stats[i])

        for ids, label, weight, f, z in _blocks(batches, layout):
            y = targets(label, f, z)
            for tree, mine in place.items():
                times = spec.times(ids, tree)
                number = np.full(len(trees[tree][0]), -1)
                number[list(mine)] = list(mine.values())
                node = number[walk(trees[tree], z, categories)]
                keep = np.flatnonzero((node >= 0) & (times > 0))
                if not len(keep):
                    continue
                node, x = node[keep], z[keep]
                w = times[keep] * weight[keep]
                stats = np.vstack([times[keep], w, (y[keep] * w[:, None]).T])
                for i in range(k):
                    total[i] += np.bincount(node, stats[i], count)
                if group.pairs is None:
                    for j in range(categories):
                        held = np.flatnonzero(x[:, j] >= 0)
                        add(node[held] * width + x[held, j], stats[:, held])
                    low = min(mine.values())  # a tree's nodes are neighbours
                    span = max(mine.values()) - low + 1
                    for j in range(numbers):
                        key = (node - low) * BINS + x[:, categories + j]
                        for i in range(k):
                            part = np.bincount(key, stats[i], span * BINS).reshape(span, BINS)
                            sums[i].reshape(count, width)[low:low + span, first + j * BINS:first + (j + 1) * BINS] += part
                    continue
                low, high = np.searchsorted(group.pairs, [min(mine.values()) * size, (max(mine.values()) + 1) * size])
                known = group.pairs[low:high]
                for j in range(categories):
                    wanted = node * size + x[:, j]
                    at = np.minimum(np.searchsorted(known, wanted), max(len(known) - 1, 0))
                    held = np.flatnonzero((x[:, j] >= 0) & (known[at] == wanted)) if len(known) else np.empty(0, int)
                    add(start[low + at[held]], stats[:, held])
                pairs = number_pairs[(number_pairs >= low) & (number_pairs < high)]
                order = np.argsort(node, kind="stable")
                ends = np.searchsorted(node[order], np.arange(count + 1))
                owner = group.pairs[pairs] // size
                lengths = ends[owner + 1] - ends[owner]
                pair = np.repeat(np.arange(len(pairs)), lengths)
                row = order[np.arange(len(pair)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(ends[owner], lengths)]
                column = categories + group.pairs[pairs[pair]] % size - first
                add(start[pairs[pair]] + x[row, column], stats[:, row])
        used = np.flatnonzero(sums[0])
        if group.pairs is None:
            node, rest = used // width, used % width
            slot = np.where(rest < first, rest, first + (rest - first) // BINS)
            at = np.where(rest < first, 0, (rest - first) % BINS)
        else:
            pair = np.searchsorted(start, used, "right") - 1
            node, slot, at = group.pairs[pair] // size, group.pairs[pair] % size, used - start[pair]
        filled = np.flatnonzero(total[0])
        stats = np.concatenate([total[:, filled], sums[:, used]], axis=1)
        whole = np.zeros(len(filled), int)
        columns = [np.concatenate([a, b]).astype(np.int32) for a, b in ((filled, node), (whole - 1, slot), (whole, at))]
        for lo in range(0, len(columns[0]), BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + BLOCK]) for c in (*columns, *stats)],
                                             names=["node", "slot", "bin", *(f"s{i}" for i in range(k))])

    return run, "node int, slot int, bin int, " + ", ".join(f"s{i} double" for i in range(k))


_BEST = "node int, slot int, cut int, gain double, total array<double>, low array<double>"


def _best_splits(first: int, least: int):
    """The best split of each node from the sums of all tasks; slot -1 where none is valid."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        sums = pd.concat(frames).groupby(["node", "slot", "bin"], sort=True).sum().reset_index()
        node, slot, at = (sums[c].to_numpy() for c in ("node", "slot", "bin"))
        stats = sums.iloc[:, 3:].to_numpy()
        whole = slot < 0
        nodes, totals = node[whole], stats[whole]

        category = ~whole & (slot < first)
        number = slot >= first
        key = node[number].astype(np.int64) << 32 | slot[number]
        pairs, pair = np.unique(key, return_inverse=True)
        table = np.zeros((len(pairs), BINS, stats.shape[1]))
        table[pair, at[number]] = stats[number]
        low = np.cumsum(table, axis=1)[:, :-1].reshape(-1, stats.shape[1])

        owner = np.concatenate([node[category], np.repeat(pairs >> 32, BINS - 1)])
        slots = np.concatenate([slot[category], np.repeat(pairs & 0xFFFFFFFF, BINS - 1)])
        cuts = np.concatenate([slot[category], np.tile(np.arange(BINS - 1), len(pairs))])
        total = totals[np.searchsorted(nodes, owner)]
        left = np.concatenate([total[:len(slot[category])] - stats[category], low])
        right = total - left
        valid = (left[:, 0] >= least) & (right[:, 0] >= least) & (left[:, 1] > 0) & (right[:, 1] > 0)
        owner, slots, cuts, total, left, right = (a[valid] for a in (owner, slots, cuts, total, left, right))

        def score(s: np.ndarray) -> np.ndarray:
            return (s[:, 2:] ** 2).sum(axis=1) / s[:, 1]

        gain = (score(left) + score(right) - score(total)) / total[:, 1]
        real = gain > 1e-12 * score(total) / total[:, 1]
        owner, slots, cuts, total, left, gain = (a[real] for a in (owner, slots, cuts, total, left, gain))
        order = np.lexsort((cuts, slots, -gain, owner))
        top = order[np.unique(owner[order], return_index=True)[1]]
        rows = {int(n): (int(n), -1, 0, 0.0, t.tolist(), t.tolist()) for n, t in zip(nodes, totals)}
        for i in top:
            rows[int(owner[i])] = (int(owner[i]), int(slots[i]), int(cuts[i]), float(gain[i]), total[i].tolist(), left[i].tolist())
        yield pd.DataFrame(list(rows.values()), columns=["node", "slot", "cut", "gain", "total", "low"])

    return run


# ------------------------------------------------------------ estimators

@dataclass
class Spec:
    """What is grown: a forest of ``trees``, or as many boosting steps."""

    trees: int
    depth: int
    least: int
    subset: str
    boosted: bool
    classify: bool
    seed: int
    rate: float = 1.0
    share: float = 1.0
    bootstrap: bool = True

    def times(self, ids: np.ndarray, tree: int) -> np.ndarray:
        """How often each row is in the tree's sample."""
        if not self.boosted:
            return np.searchsorted(_POISSON, _uniform(ids, self.seed, tree), "right").astype(float) if self.bootstrap else np.ones(len(ids))
        return np.ones(len(ids)) if self.share >= 1 else (_uniform(ids, self.seed, tree) < self.share).astype(float)

    def slots_a_node(self, size: int) -> int:
        ways = {"sqrt": math.ceil(math.sqrt(size)), "log2": max(1, math.ceil(math.log2(size))), "all": size}
        return ways[self.subset]


def _groups(frontier: list[tuple[int, int]], layout: Layout, spec: Spec) -> Iterator[_Group]:
    """Open nodes in groups whose sums fit a task."""
    chosen = spec.slots_a_node(layout.size)
    every = chosen >= layout.size
    width = layout.first + len(layout.cuts) * BINS if every else chosen * (1 + (BINS - 1) * len(layout.cuts) / layout.size)
    step = max(1, int(CELLS / width))
    for lo in range(0, len(frontier), step):
        nodes = frontier[lo:lo + step]
        if every:
            yield _Group(nodes, None)
            continue
        drawn = [np.sort(np.random.default_rng([spec.seed, *n]).choice(layout.size, chosen, replace=False)) + i * layout.size for i, n in enumerate(nodes)]
        yield _Group(nodes, np.concatenate(drawn))


def _grow(rows: DataFrame, layout: Layout, spec: Spec, number: range, before: Sequence[tuple[float, tuple]], begun: bool, y0: float, classes: int) -> list[Tree]:
    """Trees of the numbers given, level by level."""
    trees = {t: Tree() for t in number}
    dims = 1 if spec.boosted or not classes else classes
    shift = 0.0 if dims > 1 else y0

    def mean(stats: np.ndarray) -> list[float]:
        return (stats[2:] / stats[1] + shift).tolist() if stats[1] > 0 else [shift] * dims

    for tree in trees.values():
        tree.value[0] = [shift] * dims
    frontier = [(t, 0) for t in number]
    for level in range(spec.depth):
        found = []
        for group in _groups(frontier, layout, spec):
            ready = {t: tree.arrays() for t, tree in trees.items()}
            run, schema = _sums(layout, group, ready, before, spec, begun, y0, classes)
            best = rows.mapInArrow(run, schema).repartition("node").mapInPandas(_best_splits(layout.first, spec.least), _BEST)
            with passing_shuffles(rows.sparkSession):
                found += [(*group.nodes[r["node"]], r) for r in best.collect()]  # a row an open node
        frontier = []
        for t, node, r in sorted(found, key=lambda f: f[:2]):
            tree, total, low = trees[t], np.array(r["total"]), np.array(r["low"])
            tree.value[node] = mean(total)
            if r["slot"] < 0:
                continue
            slot = r["slot"]
            column = (int(np.searchsorted(layout.offsets, slot, "right")) - 1 if slot < layout.first
                      else len(layout.offsets) + slot - layout.first)
            tree.column[node], tree.cut[node], tree.left[node] = column, r["cut"], len(tree.column)
            tree.gains[slot] = tree.gains.get(slot, 0.0) + r["gain"] * total[1]
            for stats in (low, total - low):
                if level + 1 < spec.depth and stats[0] >= 2 * spec.least:
                    frontier.append((t, len(tree.column)))
                tree.column.append(-1)
                tree.cut.append(0)
                tree.left.append(0)
                tree.value.append(mean(stats))
        if not frontier:
            break
    return [trees[t] for t in number]


class SparseTrees:
    """fit / transform of a forest or of boosted trees; rows need a bigint ``id``.

    Rows that do not come from an encoder with categories (no sparse slots, or over-sampled rows
    between them) go to ``plain``, MLlib's learner of the same settings.
    """

    def __init__(self, spec: Spec, plain):
        self.spec, self.plain, self.weight = spec, plain, None

    def setWeightCol(self, name: str) -> SparseTrees:
        self.weight = name
        self.plain = self.plain.setWeightCol(name)
        return self

    def fit(self, train: DataFrame):
        facts = train.schema["features"].metadata.get("slots")
        if not facts or not facts["categories"] or "id" not in train.columns:
            return self.plain.fit(train)
        spec = self.spec
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        rows = train.select(F.col("id").cast("long").alias("id"), F.col("label").cast("double").alias("label"), weight.alias("weight"),
                            sparse_parts("features").alias("f")).select("id", "label", "weight", "f.indices", "f.values")
        got = train.agg(F.count("label").alias("n"), F.avg("label").alias("mean"), F.max("label").alias("top")).first()
        if not got["n"]:
            raise ValueError("no rows to grow trees on")
        layout = _layout(rows, facts, got["n"], spec.seed)
        rows = _compact(rows, layout)
        classes = max(int(got["top"]) + 1, 2) if spec.classify else 0
        if not spec.boosted:
            return TreesModel(layout, _grow(rows, layout, spec, range(spec.trees), [], False, got["mean"], classes), spec.rate, False, classes)
        trees: list[Tree] = []
        before: list[tuple[float, tuple]] = []  # trees that ``f`` does not have yet
        for i in range(spec.trees):
            if len(before) == STEPS:
                rows, before = _advance(rows, layout, before), []
            y0 = got["mean"] if i == 0 and not classes else 0.0
            trees += _grow(rows, layout, spec, range(i, i + 1), before, i > 0, y0, classes)
            before.append((spec.rate if i else 1.0, trees[-1].arrays()))
        return TreesModel(layout, trees, spec.rate, True, classes)


class TreesModel(Transformer, MLReadable, MLWritable):
    """Fitted trees; adds ``prediction``, and ``probability`` for classes."""

    def __init__(self, layout: Layout | None = None, trees: Sequence[Tree] = (), rate: float = 1.0, boosted: bool = False, classes: int = 0):
        super().__init__()
        self.layout, self.trees, self.rate, self.boosted, self.classes = layout, list(trees), rate, boosted, classes

    @property
    def featureImportances(self):
        """Gains by slot, adding up to one; those of a forest do so in each tree first."""
        out: dict[int, float] = {}
        for tree in self.trees:
            whole = 1.0 if self.boosted else sum(tree.gains.values())
            for slot, gain in tree.gains.items():
                out[slot] = out.get(slot, 0.0) + gain / whole
        whole = sum(out.values()) or 1.0
        return Vectors.sparse(self.layout.size, {s: g / whole for s, g in out.items()})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        layout, trees, rate, boosted, classes = self.layout, [t.arrays() for t in self.trees], self.rate, self.boosted, self.classes
        categories = len(layout.offsets)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def scores(indices: pa.Array, values: pa.Array) -> pa.Array:
            z = layout.matrix(indices, values)
            if boosted:
                f = _boosted_sum([(rate if i else 1.0, t) for i, t in enumerate(trees)], z, categories)
                p = 1 / (1 + np.exp(-np.clip(2 * f, -700, 700)))
                out = np.column_stack([1 - p, p]) if classes else f[:, None]
            else:
                out = sum(t[3][walk(t, z, categories)] for t in trees) / len(trees)
            ends = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(ends, pa.array(out.ravel(), pa.float64()))

        parts = sparse_parts("features")
        found = dataset.withColumn("__parts", parts).withColumn("__p", scores("__parts.indices", "__parts.values")).drop("__parts")
        if not classes:
            return found.withColumn("prediction", F.col("__p")[0]).drop("__p")
        first = (F.array_position("__p", F.array_max("__p")) - 1).cast("double")
        return found.withColumns({"probability": array_to_vector("__p"), "prediction": first}).drop("__p")

    def write(self) -> MLWriter:
        return _TreesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TreesReader()


_NODES = "tree int, node int, column int, cut int, first int, value array<double>"


class _TreesWriter(MLWriter):
    def __init__(self, model: TreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"trees": {
            "size": m.layout.size, "offsets": m.layout.offsets, "cuts": m.layout.cuts, "rate": m.rate, "boosted": m.boosted,
            "classes": m.classes, "gains": [list(t.gains.items()) for t in m.trees]}})
        rows = [(i, j, *n) for i, t in enumerate(m.trees) for j, n in enumerate(zip(t.column, t.cut, t.left, t.value))]
        spark.createDataFrame(rows, _NODES).write.parquet(f"{path}/nodes")


class _TreesReader(MLReader):
    def load(self, path: str) -> TreesModel:
        facts = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        f = facts["trees"]
        trees = [Tree([], [], [], [], {int(s): g for s, g in gains}) for gains in f["gains"]]
        for r in self.sparkSession.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            t = trees[r["tree"]]
            t.column.append(r["column"])
            t.cut.append(r["cut"])
            t.left.append(r["first"])
            t.value.append(list(r["value"]))
        model = TreesModel(Layout(f["size"], f["offsets"], f["cuts"]), trees, f["rate"], f["boosted"], f["classes"])
        model._resetUid(facts["uid"])
        return model
