"""A random forest over sparse vectors, grown level by level as Spark jobs.

MLlib turns a row into one bin number per feature, 1 MB at 2^18 hash buckets whatever the text holds, and
goes through all features of a node for every row. Here rows stay sparse: a task counts the entries that
differ from zero, and the zeros of a node follow from its total. Thresholds, bagging, subsets of features,
impurity, stopping and pruning are those of MLlib; the random numbers are not the same ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.base import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.session import evaluate_once, materialize, ship

#: Pairs of node and feature that one pass counts. It bounds a task's memory; a level of more takes more passes.
PASS_FEATURES = 1 << 22
#: Cells of a dense block (rows by the features that the trees ask for) that a task fills at a time.
BLOCK_CELLS = 1 << 22
_MASK = (1 << 64) - 1


class SparseForestClassifier(RandomForestClassifier):
    """``RandomForestClassifier`` whose work and storage follow the non-zero entries of the rows.

    Thresholds come from the values of all rows instead of a sample of 10,000. A row's part in a tree follows
    from its content, so a forest does not depend on partitioning. Weights, thresholds of classes, leaf ids and
    least weights of nodes are left to MLlib's own form.
    """

    def _fit(self, dataset: DataFrame):
        if any(self.isSet(p) for p in (self.weightCol, self.thresholds, self.leafCol, self.minWeightFractionPerNode)):
            return super()._fit(dataset)
        ship(dataset.sparkSession)
        rows = materialize(_distinct_rows(dataset, self.getLabelCol(), self.getFeaturesCol()), "forest_rows")
        size, label, n = rows.agg(F.max("size"), F.max("label"), F.sum("copies")).first()
        if not n:
            raise ValueError("no rows to fit a forest on")
        attributes = dataset.schema[self.getLabelCol()].metadata.get("ml_attr", {})
        classes = max(label + 1, len(attributes.get("vals", ())), attributes.get("num_vals", 0))
        cuts = _cuts(rows, size, n, min(self.getMaxBins(), n))
        binned = materialize(_binned(rows, cuts), "forest_bins")
        forest = _grow(self, binned, cuts, size, classes)
        columns = {c: self.getOrDefault(c) for c in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol")}
        return SparseForestModel()._set(forest=forest.pruned().values(cuts), **columns)


def _entries(vector: Column) -> dict[str, Column]:
    """``size``, and ``index`` and ``value`` of the entries of a sparse or dense vector, as arrays."""
    own = F.unwrap_udt(vector)
    size = F.coalesce(own["size"], F.size(own["values"]))
    every = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    return {"size": size, "index": F.coalesce(own["indices"], every), "value": own["values"]}


def _distinct_rows(dataset: DataFrame, label: str, features: str) -> DataFrame:
    """``(label, size, index, value, copies, key)``: each distinct row with its number and a key by content."""
    number = F.col(label).cast("double")
    valid = number.isNotNull() & (number >= 0) & (number == F.floor(number))
    checked = F.when(valid, number.cast("int")).otherwise(F.raise_error(F.lit("a label must be a class index")).cast("int"))
    rows = dataset.select(checked.alias("label"), *[c.alias(name) for name, c in _entries(F.col(features)).items()])
    merged = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    return merged.withColumn("key", F.xxhash64("label", "index", "value"))


@dataclass(frozen=True)
class _Cuts:
    """Thresholds of all features one after the other, where each begins, and the bin of zero."""

    thresholds: np.ndarray
    starts: np.ndarray
    zero: np.ndarray

    def bins(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many thresholds of its feature each value is above: a binary search in all of them at once."""
        low, high = self.starts[index], self.starts[index + 1]
        first = low
        while (wide := low < high).any():
            middle = (low + high) // 2
            above = wide & (self.thresholds[np.where(wide, middle, 0)] < value)
            low, high = np.where(above, middle + 1, low), np.where(wide & ~above, middle, high)
        return low - first


def _thresholds(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Middles between neighbouring values; of more than ``most``, those nearest to equal numbers of rows."""
    middles = (values[1:] + values[:-1]) / 2
    if len(middles) <= most:
        return middles
    stride = counts.sum() / (most + 1)
    chosen, target, upto = [], stride, np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            chosen.append(middles[i - 1])
            target += stride
    return np.array(chosen)


def _cuts(rows: DataFrame, size: int, n: int, bins: int) -> _Cuts:
    """Thresholds by the values of all rows. A feature brings one row per distinct value to its group, and the
    driver at most ``bins - 1`` numbers, as in MLlib."""

    @F.arrow_udf("array<double>")
    def thresholds(found: pa.Array) -> pa.Array:
        ends, pairs = found.offsets.to_numpy(), found.flatten()
        value, count = pairs.field("value").to_numpy(), pairs.field("n").to_numpy()
        cut = []
        for start, end in zip(ends - ends[0], ends[1:] - ends[0]):
            values, counts = value[start:end], count[start:end]
            if (rest := n - counts.sum()) > 0:
                at = np.searchsorted(values, 0.0)
                values, counts = np.insert(values, at, 0.0), np.insert(counts, at, rest)
            cut.append(_thresholds(values, counts, bins - 1))
        return pa.array(cut, pa.list_(pa.float64()))

    entries = rows.select("copies", F.inline(F.arrays_zip("index", "value"))).where("value <> 0")
    values = entries.groupBy("index", "value").agg(F.sum("copies").alias("n"))
    found = values.groupBy("index").agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("found"))
    table = found.select("index", thresholds("found").alias("cuts")).where(F.size("cuts") > 0).toArrow().sort_by("index")
    cuts = table["cuts"].combine_chunks()
    sizes = np.zeros(size + 1, np.int64)
    sizes[table["index"].to_numpy() + 1] = cuts.value_lengths().to_numpy()
    flat, starts = np.append(cuts.flatten().to_numpy(), 0.0), np.cumsum(sizes)
    zero = _Cuts(flat, starts, starts).bins(np.arange(size), np.zeros(size))
    return _Cuts(flat, starts, zero.astype(np.int32))


def _row_numbers(lists: pa.Array) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())


def _binned(rows: DataFrame, cuts: _Cuts) -> DataFrame:
    """``(key, label, copies, index, bin)``: entries in bins; those in the bin of zero are left out like zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, index = _row_numbers(batch["index"]), batch["index"].flatten().to_numpy()
            bins = cuts.bins(index, batch["value"].flatten().to_numpy())
            kept = bins != cuts.zero[index]
            ends = pa.array(np.searchsorted(row[kept], np.arange(len(batch) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(c[kept].astype(np.int32))) for c in (index, bins)]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["label"], batch["copies"], *lists], ["key", "label", "copies", "index", "bin"])

    spark = rows.sparkSession
    found = rows.mapInArrow(run, "key bigint, label int, copies bigint, index array<int>, bin array<int>")
    # growing takes far more time than these rows have bytes, so they are spread over all cores
    return found.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _bags(key: np.ndarray, copies: np.ndarray, seed: int, trees: int, rate: float, bootstrap: bool) -> np.ndarray:
    """How often each row counts in each tree: copies drawn one by one add up to one draw.

    Most rows have no copies, so theirs are drawn together: 64 random bits for each row and tree against the
    distribution's steps.
    """
    found = np.zeros((len(key), trees), np.int16 if copies.max(initial=0) < 256 else np.int64)
    single = copies == 1
    bits = key[single].view(np.uint64)[:, None] ^ np.random.default_rng((seed, 2)).integers(0, _MASK, trees, np.uint64, endpoint=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        bits = (bits ^ (bits >> np.uint64(shift))) * np.uint64(factor)
    drawn, share, upto, n = np.zeros(bits.shape, found.dtype), math.exp(-rate) if bootstrap else 1 - rate, 0.0, 0
    while int((upto := upto + share) * 2.0**64) <= _MASK and (above := bits >= np.uint64(int(upto * 2.0**64))).any():
        drawn, n = drawn + above, n + 1
        share = share * rate / n if bootstrap else rate
    found[single] = drawn
    for i in np.flatnonzero(~single):
        random, n = np.random.default_rng((seed, int(key[i]) & _MASK)), int(copies[i])
        found[i] = random.poisson(n * rate, trees) if bootstrap else random.binomial(n, rate, trees)
    return found


@dataclass
class _Forest:
    """Nodes of all trees, the roots first: feature (-1 for a leaf), bin or value up to which rows go to
    ``left``, the others to ``left + 1``, and counts per class."""

    trees: int
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    tree: np.ndarray
    counts: np.ndarray

    def walk(self, row: np.ndarray, index: np.ndarray, value: np.ndarray, n: int, zero: np.ndarray | None = None) -> np.ndarray:
        """The node that each of ``n`` rows comes to in each tree, from its entries ``(row, index, value)``."""
        used = np.unique(self.feature[self.feature >= 0])
        current = np.tile(np.arange(self.trees), (n, 1))
        if not len(used):
            return current
        block = np.zeros((n, len(used)), value.dtype) if zero is None else np.tile(zero[used].astype(value.dtype), (n, 1))
        at = np.minimum(np.searchsorted(used, index), len(used) - 1)
        asked = used[at] == index
        block[row[asked], at[asked]] = value[asked]
        column, first = np.searchsorted(used, np.maximum(self.feature, used[0])), np.arange(n)[:, None] * len(used)
        while (inner := self.feature[current] >= 0).any():
            above = block.ravel()[first + column[current]] > self.cut[current]
            current = np.where(inner, self.left[current] + above, current)
        return current

    def rows_per_block(self) -> int:
        return max(1, BLOCK_CELLS // max(1, self.trees, len(np.unique(self.feature))))

    def pruned(self) -> _Forest:
        """Two leaves of one class make their parent a leaf. Children stand behind their parents."""
        feature, best = self.feature.copy(), self.counts.argmax(axis=1)
        for i in np.flatnonzero(feature >= 0)[::-1]:
            a, b = self.left[i], self.left[i] + 1
            if feature[a] < 0 and feature[b] < 0 and best[a] == best[b]:
                feature[i] = -1
        return _Forest(self.trees, feature, self.cut, self.left, self.tree, self.counts)

    def values(self, cuts: _Cuts) -> list:
        """Plain lists, with values as thresholds and shares of classes, for the model."""
        inner = self.feature >= 0
        cut = np.where(inner, cuts.thresholds[np.where(inner, cuts.starts[np.maximum(self.feature, 0)] + self.cut, 0)], 0.0)
        shares = self.counts / np.maximum(1, self.counts.sum(axis=1, keepdims=True))
        return [self.trees, *(a.tolist() for a in (self.feature, cut, self.left, self.tree, shares))]


def _blocks(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(batch), rows):
        yield batch.slice(start, rows)


def _summed(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    keys, at = np.unique(key, return_inverse=True)
    sums = np.bincount(at, n, len(keys)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["key", "n"])


def _impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    share = counts / np.maximum(1, counts.sum(axis=-1, keepdims=True))
    if kind == "gini":
        return 1 - (share * share).sum(axis=-1)
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=-1)


def _subset_size(strategy: str, size: int, trees: int) -> int:
    """Features that a node may ask for, by MLlib's names of strategies."""
    if strategy == "auto":
        strategy = "sqrt" if trees > 1 else "all"
    named = {"all": size, "sqrt": math.sqrt(size), "log2": math.log2(max(2, size)), "onethird": size / 3}
    if strategy in named:
        return max(1, math.ceil(named[strategy]))
    if strategy.isdigit():
        return max(1, min(int(strategy), size))
    return max(1, min(math.ceil(float(strategy) * size), size))


def _grow(params: RandomForestClassifier, rows: DataFrame, cuts: _Cuts, size: int, classes: int) -> _Forest:
    """All trees, one level after the other; the driver holds their nodes, as many as the parameters allow."""
    trees, seed = params.getNumTrees(), params.getSeed() & _MASK
    bag = (seed, trees, params.getSubsamplingRate(), params.getBootstrap())
    chosen = _subset_size(params.getFeatureSubsetStrategy(), size, trees)
    kind = params.getImpurity()
    at_once = max(1, PASS_FEATURES // chosen)

    def root_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch, max(1, BLOCK_CELLS // trees)):
                n = _bags(part["key"].to_numpy(), part["copies"].to_numpy(), *bag)
                key = np.arange(trees) * classes + part["label"].to_numpy()[:, None]
                yield _summed(key.ravel(), n.ravel())

    sums = rows.select("key", "label", "copies").mapInArrow(root_counts, "key bigint, n bigint")
    counts = np.zeros((trees, classes), np.int64)
    for row in sums.groupBy("key").agg(F.sum("n").alias("n")).collect():
        counts[divmod(row.key, classes)] = row.n
    ids = np.arange(trees)
    forest = _Forest(trees, np.full(trees, -1), np.zeros(trees, np.int64), np.zeros(trees, np.int64), ids, counts)
    level = np.flatnonzero(_impurity(counts, kind) > 0)
    for _ in range(params.getMaxDepth()):
        parts = [level[i : i + at_once] for i in range(0, len(level), at_once)]
        splits = [row for part in parts for row in _best_splits(params, rows, forest, part, cuts, size, classes, chosen, bag)]
        if not splits:
            break
        splits.sort(key=lambda row: row.node)
        node = np.array([row.node for row in splits])
        feature, cut, left = forest.feature.copy(), forest.cut.copy(), forest.left.copy()
        first, more = len(feature), 2 * len(node)
        feature[node], cut[node] = [row.feature for row in splits], [row.cut for row in splits]
        left[node] = first + 2 * np.arange(len(node))
        below = np.array([row.below for row in splits], np.int64)
        children = np.stack([below, forest.counts[node] - below], axis=1).reshape(more, classes)
        forest = _Forest(
            trees, np.append(feature, np.full(more, -1)), np.append(cut, np.zeros(more, np.int64)), np.append(left, np.zeros(more, np.int64)),
            np.append(forest.tree, np.repeat(forest.tree[node], 2)), np.vstack([forest.counts, children]),
        )
        level = first + np.flatnonzero(_impurity(children, kind) > 0)
    return forest


def _best_splits(params: RandomForestClassifier, rows: DataFrame, forest: _Forest, nodes: np.ndarray, cuts: _Cuts, size: int, classes: int, chosen: int, bag: tuple) -> list:
    """``(node, feature, cut, below)`` of the nodes that can be split, in one pass over the rows.

    Tasks count entries by node, feature, bin and class, merged before the one large shuffle; each pair of node
    and feature then finds its best cut, and each node its best feature, the smaller one of equals.
    """
    seed, trees, codes = bag[0], bag[1], (int(np.diff(cuts.starts).max(initial=0)) + 1) * classes
    least, gain, kind = params.getMinInstancesPerNode(), params.getMinInfoGain(), params.getImpurity()
    totals, tree, zero = forest.counts[nodes], forest.tree[nodes], cuts.zero
    place = np.full(len(forest.feature), -1)
    place[nodes] = np.arange(len(nodes))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subsets = [np.random.default_rng((seed, 1, node)).choice(size, chosen, replace=False, shuffle=False) for node in nodes.tolist()]
        asked = np.concatenate(subsets)
        starts = np.append(0, np.cumsum(np.bincount(asked, minlength=size)))
        # nodes by the feature they ask for, in one plain sort
        asking = np.sort((asked << 32) + np.repeat(np.arange(len(nodes)), chosen)) & 0xFFFFFFFF
        for batch in batches:
            keys, sums = [], []
            for part in _blocks(batch, forest.rows_per_block()):
                index, row = part["index"].flatten().to_numpy(), _row_numbers(part["index"])
                value, label = part["bin"].flatten().to_numpy(), part["label"].to_numpy().astype(np.int64)
                at = place[forest.walk(row, index, value, len(part), zero)]
                n = _bags(part["key"].to_numpy(), part["copies"].to_numpy(), *bag)
                # every entry meets the nodes that ask for its feature, and counts where its row stands
                meets = starts[index + 1] - starts[index]
                entry = np.repeat(np.arange(len(index)), meets)
                node = asking[np.arange(len(entry)) - np.repeat(np.cumsum(meets) - meets, meets) + np.repeat(starts[index], meets)]
                stands = row[entry] * trees + tree[node]
                here = np.where(n > 0, at, -1).ravel()[stands] == node
                entry, node = entry[here], node[here]
                keys.append((node * size + index[entry]) * codes + (value * classes + label[row])[entry])
                sums.append(n.ravel()[stands[here]])
            if keys:
                yield _summed(np.concatenate(keys), np.concatenate(sums))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch, max(1, BLOCK_CELLS // codes)):
                pair, found = part["pair"].to_numpy(), part["found"]
                node, feature = np.divmod(pair, size)
                entries, row = found.flatten(), _row_numbers(found)
                n = np.zeros((len(part), codes), np.int64)
                n[row, entries.field("code").to_numpy()] = entries.field("n").to_numpy()
                n = n.reshape(len(part), -1, classes)
                n[np.arange(len(part)), zero[feature]] += totals[node] - n.sum(axis=1)
                below = np.cumsum(n, axis=1)
                above = totals[node][:, None] - below
                few, many, whole = below.sum(axis=2), above.sum(axis=2), totals[node].sum(axis=1)[:, None]
                gains = _impurity(totals[node], kind)[:, None] - few / whole * _impurity(below, kind) - many / whole * _impurity(above, kind)
                gains = np.where((few >= least) & (many >= least) & (gains >= gain) & (gains > 0), gains, -1.0)
                cut = gains.argmax(axis=1)
                split = np.flatnonzero(gains.max(axis=1) > 0)
                first = below[split, cut[split]]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(split) + 1, dtype=np.int32) * classes), pa.array(first.ravel()))
                columns = [pa.array(c[split].astype(np.int64)) for c in (nodes[node], feature, cut)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(gains[split, cut[split]]), lists], ["node", "feature", "cut", "gain", "below"])

    sums = rows.mapInArrow(counted, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    code = (F.col("key") % codes).cast("int").alias("code")
    pairs = sums.groupBy(F.floor(F.expr(f"key div {codes}")).alias("pair")).agg(F.collect_list(F.struct(code, "n")).alias("found"))
    splits = pairs.mapInArrow(best, "node bigint, feature bigint, cut bigint, gain double, below array<bigint>")
    top = F.max_by(F.struct("feature", "cut", "below"), F.struct("gain", -F.col("feature"))).alias("top")
    return splits.groupBy("node").agg(top).select("node", "top.*").collect()


class SparseForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Votes of the trees: ``rawPrediction`` adds up the shares of the classes in the leaves that a row comes to."""

    forest = Param(Params._dummy(), "forest", "number of trees; features, thresholds, left children, trees and class shares of the nodes")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship(dataset.sparkSession)
        trees, *nodes = self.getOrDefault(self.forest)
        forest = _Forest(trees, *map(np.array, nodes))

        @F.arrow_udf("array<double>")
        def votes(index: pa.Array, value: pa.Array) -> pa.Array:
            found = [np.empty(0)]
            for start in range(0, len(index), rows := forest.rows_per_block()):
                own, part = index.slice(start, rows), value.slice(start, rows)
                nodes = forest.walk(_row_numbers(own), own.flatten().to_numpy(), part.flatten().to_numpy(), len(own))
                found.append(forest.counts[nodes].sum(axis=1).ravel())
            ends = np.arange(len(index) + 1, dtype=np.int32) * forest.counts.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))

        raw, own = F.col("_votes"), dataset.columns
        entries = _entries(F.col(self.getFeaturesCol()))
        voted = evaluate_once(dataset, _votes=votes(entries["index"], entries["value"]))
        total = F.aggregate(raw, F.lit(0.0), lambda a, b: a + b)
        return voted.select(
            *own,
            array_to_vector(raw).alias(self.getRawPredictionCol()),
            array_to_vector(F.transform(raw, lambda v: v / total)).alias(self.getProbabilityCol()),
            (F.array_position(raw, F.array_max(raw)) - 1).cast("double").alias(self.getPredictionCol()),
        )
