"""Gradient-boosted regression trees: histograms of binned features, summed over the partitions level by level."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.session import ensure_checkpoint_dir, ship
from ladle.sources import tables

BINS = 32
# Codes of features that are stored and counted together.
WIDTH = 1024
# Thresholds are chosen on about so many rows, as MLlib's trees choose them; every row is trained on.
THRESHOLD_ROWS = 10_000
# Rows of a block of columns, and the least and the most that a task should hold.
BLOCK_ROWS, LEAST_ROWS, MOST_ROWS = 1 << 16, 1 << 15, 1 << 20
CHECKPOINT_EVERY = 10
# More partial histograms than these are summed on the executors first.
DIRECT_SUMS = 32


def thresholds(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Where a numeric feature is cut: between all its values if they are few, else at about equal shares of the rows."""
    different, counts = np.unique(values, return_counts=True)
    middles = (different[:-1] + different[1:]) / 2
    if len(middles) < bins:
        return middles
    upto, stride = np.cumsum(counts), len(values) / bins
    found, target = [], stride
    for i in range(1, len(different)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


@dataclass
class Layout:
    """How features become codes. Numeric ones (``cuts``) fall into bins by thresholds, the others hold the number of a
    category below their size. Features whose bins multiply to at most WIDTH share a code: fewer columns to store and count."""

    cuts: list[np.ndarray | None]
    sizes: list[int]

    def __post_init__(self):
        self.groups: list[list[int]] = []
        width: list[int] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            g = next((g for g, w in enumerate(width) if w * self.sizes[f] <= WIDTH), len(width))
            if g == len(width):
                self.groups.append([])
                width.append(1)
            self.groups[g].append(f)
            width[g] *= self.sizes[f]
        self.widths = width
        self.group, self.stride = np.zeros(len(self.sizes), np.intp), np.ones(len(self.sizes), np.intp)
        for g, members in enumerate(self.groups):
            for f, after in zip(members, (members[i + 1 :] for i in range(len(members)))):
                self.group[f], self.stride[f] = g, np.prod([self.sizes[m] for m in after], dtype=np.intp)

    def codes(self, columns: list[np.ndarray]) -> np.ndarray:
        """Codes of rows, a row per group of features."""
        rows = np.zeros((len(self.groups), len(columns[0])), np.uint16)
        for f, (cut, values) in enumerate(zip(self.cuts, columns)):
            bins = values if cut is None else np.searchsorted(cut, values, side="left")
            rows[self.group[f]] += (bins * self.stride[f]).astype(np.uint16)
        return rows

    def by_feature(self, g: int, counted: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Of sums per slot and code of a group, those per slot and bin of each of its features."""
        members = self.groups[g]
        cube = counted.reshape(-1, *[self.sizes[f] for f in members])
        for i, f in enumerate(members):
            yield f, cube.sum(axis=tuple(1 + k for k in range(len(members)) if k != i))


@dataclass
class Tree:
    """A tree in heap order: the children of node i are 2i+1 and 2i+2. A row goes right where its bin says so. A node
    without a split sends all rows left, down to a leaf with its own value."""

    feature: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        inner = (1 << depth) - 1
        return Tree(np.zeros(inner, np.intp), np.zeros((inner, BINS), np.uint8), np.zeros(2 * inner + 1))

    @property
    def depth(self) -> int:
        return len(self.value).bit_length() - 1

    def routes(self, layout: Layout, levels: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the nodes of the upper levels, the group each looks at and which of its codes go right."""
        feature = self.feature[: (1 << levels) - 1]
        bins = np.arange(WIDTH) // layout.stride[feature][:, None] % np.array(layout.sizes)[feature][:, None]
        return layout.group[feature], self.right[np.arange(len(feature))[:, None], bins].reshape(-1)

    @staticmethod
    def nodes(codes: np.ndarray, routes: tuple[np.ndarray, np.ndarray], levels: int) -> np.ndarray:
        """The node of each row after so many levels; ``codes`` has a row per group."""
        (group, right), n = routes, codes.shape[1]
        at, flat, rows = np.zeros(n, np.intp), codes.reshape(-1), np.arange(n)
        for level in range(levels):
            code = flat.take(group[at] * n + rows) if level else codes[group[0]]
            at = 2 * at + 1 + right.take(at * WIDTH + code)
        return at


@dataclass
class Model:
    """The trees, each with its weight."""

    layout: Layout
    trees: list[Tree]
    weights: list[float]

    def predict(self, columns: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(columns[0]))
        codes = [self.layout.codes([c[i : i + BLOCK_ROWS] for c in columns]) for i in range(0, len(total), BLOCK_ROWS)]
        for tree, weight in zip(self.trees, self.weights):
            routes = tree.routes(self.layout, tree.depth)
            for i, block in enumerate(codes):
                total[i * BLOCK_ROWS : (i + 1) * BLOCK_ROWS] += weight * tree.value[tree.nodes(block, routes, tree.depth)]
        return total

    def transform(self, rows: DataFrame, features: list[Column], name: str = "prediction") -> DataFrame:
        """Add the prediction of rows, given their features as numbers."""
        context = rows.sparkSession.sparkContext
        ship(context)
        held = context.broadcast(self)

        @F.pandas_udf("double")
        def predicted(*columns: pd.Series) -> pd.Series:
            return pd.Series(held.value.predict([c.to_numpy(np.float64) for c in columns]))

        return rows.withColumn(name, predicted(*[f.cast("double") for f in features]))


def histograms(
    blocks: Iterator[tuple[np.ndarray, np.ndarray]], layout: Layout, tree: Tree, level: int, slots: np.ndarray, used: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and sum of residuals of the nodes of a level that have a slot (others: -1), per slot and bin of all features, one
    feature after the other. Counts are in the smallest type that holds them: a result of less than 64 kB goes back in one
    piece, without waiting."""
    sums = [np.zeros((2, used * width)) for width in layout.widths]
    routes = tree.routes(layout, level)
    for codes, residuals in blocks:
        slot = slots[tree.nodes(codes, routes, level)]
        if level:
            rows = np.flatnonzero(slot >= 0)
            slot, residuals = slot[rows], residuals[rows]
        for code, total, width in zip(codes, sums, layout.widths):
            place = slot * width + (code.take(rows) if level else code)
            total[0] += np.bincount(place, minlength=used * width)
            total[1] += np.bincount(place, residuals, used * width)
    found = np.zeros((2, used, sum(layout.sizes)))
    starts = np.cumsum([0, *layout.sizes])
    for kind in (0, 1):
        for g, total in enumerate(sums):
            for f, counted in layout.by_feature(g, total[kind]):
                found[kind, :, starts[f] : starts[f + 1]] = counted
    return found[0].astype(np.min_scalar_type(int(found[0].max()))), found[1]


def added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0].astype(np.int64) + b[0], a[1] + b[1]


def best_splits(count: np.ndarray, total: np.ndarray, categorical: list[bool]) -> list[tuple[int, np.ndarray] | None]:
    """Per node ([node, feature, bin]) feature and right-going bins of the split that lowers the variance most; None if none
    does.

    Categories are ordered by their mean, empty ones last, which makes the best subset a prefix.
    """
    mean = np.divide(total, count, out=np.full(total.shape, np.inf), where=count > 0)
    order = np.where(np.array(categorical)[:, None], np.argsort(mean, axis=2, kind="stable"), np.arange(BINS))
    n, s = (np.cumsum(np.take_along_axis(a, order, 2), axis=2) for a in (count, total))
    n_all, s_all = n[..., -1:], s[..., -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s**2 / n + (s_all - s) ** 2 / (n_all - n) - s_all**2 / n_all
    gain[(n < 1) | (n_all - n < 1)] = -np.inf
    gain = gain.reshape(len(gain), -1)
    found = []
    for node, place in enumerate(gain.argmax(axis=1)):
        f, cut = divmod(int(place), BINS)
        right = np.zeros(BINS, np.uint8)
        right[order[node, f, cut + 1 :]] = 1
        found.append((f, right) if gain[node, place] > 0 else None)
    return found


def grow(state: RDD, layout: Layout, depth: int) -> Tree:
    """One tree on (codes, residuals) blocks, a job per level. Of two sisters only the one with fewer rows is counted; the
    other is what is left of their mother."""
    tree, parents, small = Tree.empty(depth), {}, {0: None}
    categorical = [cut is None for cut in layout.cuts]
    splits: dict[int, tuple] = {}
    for level in range(depth):
        slots = np.full(2 * len(tree.feature) + 1, -1, np.intp)
        slots[list(small)] = np.arange(len(small))
        used = len(small)

        def count(blocks, tree=tree, level=level, slots=slots, used=used):
            return [histograms(blocks, layout, tree, level, slots, used)]

        parts = state.getNumPartitions()
        summed = state.mapPartitions(count).treeReduce(added, depth=1 if parts <= DIRECT_SUMS else 2)
        summed = np.stack([np.asarray(part, float) for part in summed])
        wide = np.zeros((2, used, len(layout.sizes) * BINS))
        wide[:, :, np.concatenate([f * BINS + np.arange(size) for f, size in enumerate(layout.sizes)])] = summed
        summed = wide.reshape(2, used, len(layout.sizes), BINS)
        known = {}
        for i, (node, sister) in enumerate(small.items()):
            known[node] = summed[:, i]
            if sister is not None:
                known[sister] = parents[(node - 1) // 2] - summed[:, i]
        parents, small = known, {}
        found = best_splits(*np.stack(list(known.values()), axis=1), categorical)
        for (node, (n, s)), split in zip(known.items(), found):
            tree.value[node] = s[0].sum() / n[0].sum()
            if split is None:
                continue
            splits[node] = split
            f, right = split
            tree.feature[node], tree.right[node] = f, right
            left_n, right_n = (n[f][right == side].sum() for side in (0, 1))
            left_s, right_s = (s[f][right == side].sum() for side in (0, 1))
            left, other = 2 * node + 1, 2 * node + 2
            tree.value[left], tree.value[other] = left_s / left_n, right_s / right_n
            small[left if left_n <= right_n else other] = other if left_n <= right_n else left
        if not small:
            break
    for node in range(len(tree.feature)):
        if node not in splits:
            tree.value[2 * node + 1 : 2 * node + 3] = tree.value[node]
    return tree


def fit(
    rows: DataFrame, features: list[Column], categories: list[int | None], label: Column, maxIter: int, maxDepth: int, stepSize: float, seed: int
) -> Model:
    """Boosted trees with squared error, as MLlib's ``GBTRegressor`` defines them: the first tree fits the label, each
    further one the gradient ``2 * (label - prediction)`` and counts ``stepSize``. ``categories`` is how many categories a
    feature has, None if it is numeric. Rows without a label take no part.

    A row is held as its codes and its residual, in blocks of columns in Spark's storage. A level is a job whose
    partial histograms are all that leaves a task; their size depends on depth, features and bins, not on rows.
    """
    spark = rows.sparkSession
    context = spark.sparkContext
    ensure_checkpoint_dir(spark)
    ship(context)
    names = [f"f{i}" for i in range(len(features))]
    rows = rows.filter(label.isNotNull()).select(*[f.cast("double").alias(n) for f, n in zip(features, names)], label.cast("double").alias("y"))
    n = rows.count()
    if not n:
        raise ValueError("no rows to train on")
    sample = rows.drop("y").sample(fraction=THRESHOLD_ROWS / n, seed=seed) if n > THRESHOLD_ROWS else rows.drop("y")
    sample = sample.toPandas()
    cuts = [None if c else thresholds(sample[name].to_numpy()) for name, c in zip(names, categories)]
    layout = Layout(cuts, [c or len(cut) + 1 for c, cut in zip(categories, cuts)])
    model = Model(layout, [], [])
    parallel = context.defaultParallelism
    parts = min(parallel * -(-n // (parallel * MOST_ROWS)), -(-n // LEAST_ROWS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block():
            columns = [np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in range(len(names) + 1)]
            data = [[layout.codes(columns[:-1]).tobytes()], [columns[-1].tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(d, pa.binary()) for d in data], ["codes", "y"])

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(batch.slice(start, BLOCK_ROWS))
                size += held[-1].num_rows
                if size >= BLOCK_ROWS:
                    yield block()
                    held, size = [], 0
        if size:
            yield block()

    def unpack(row) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(row.codes, np.uint16).reshape(len(layout.groups), -1), np.frombuffer(row.y)

    state = rows.repartition(parts).mapInArrow(pack, "codes binary, y binary").rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    before = kept = None
    for i in range(maxIter):
        tree = grow(state, layout, maxDepth)
        weight = stepSize if i else 1.0
        model.trees.append(tree)
        model.weights.append(weight)
        if before is not None:  # the residuals of this round are stored by now
            before.unpersist()
        if state.isCheckpointed():
            if kept:
                tables.delete(spark, kept)
            kept = state.getCheckpointFile()

        def advance(block, tree=tree, weight=weight, scale=1.0 if i else 2.0):
            codes, residuals = block
            leaves = tree.value[tree.nodes(codes, tree.routes(layout, maxDepth), maxDepth)]
            return codes, scale * residuals - 2 * weight * leaves

        before, state = state, state.map(advance).persist(StorageLevel.MEMORY_AND_DISK)
        if (i + 1) % CHECKPOINT_EVERY == 0:
            state.checkpoint()
    before.unpersist()
    state.unpersist()
    if kept:
        tables.delete(spark, kept)
    return model
