"""Boosted trees grown over counted cells.

A tree sees a row only as the bins of its features, its label and its weight, and rows that agree in these always have
the same score. So rows are counted per cell before the shuffle, and boosting runs over the cells, however many rows
they hold. The trees are those of Spark's `GBTClassifier`: its bins, variance gains, logistic loss and early stop.
"""

from __future__ import annotations

import pickle
import sys
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, functions as F

from laurel.session import BROADCAST_ROWS, GROUP_ROWS, stored_copy

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that Spark draws at least to place the bins of a feature with more values than can be counted.
BIN_ROWS = 10_000


def thresholds(values: np.ndarray, weights: np.ndarray, total: float, bins: int) -> np.ndarray:
    """Spark's bin borders of a feature: `values` ascending and different, `total` the weight of all rows."""
    if len(values) <= bins:
        return (values[:-1] + values[1:]) / 2
    stride, target, out = total / bins, total / bins, []
    reached = np.cumsum(weights)
    for k in range(1, len(values)):
        if abs(reached[k - 1] - target) < abs(reached[k] - target):
            out.append((values[k - 1] + values[k]) / 2)
            target += stride
    return np.array(out)


def _drawn(random: np.random.Generator, features: int, some: int) -> list[int]:
    """`some` of the features by a reservoir; its order decides between equal gains."""
    kept = list(range(some))
    for k in range(some, features):
        at = int(random.random() * (k + 1))
        if at < some:
            kept[at] = k
    return kept


def _variance(n, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (q - s * s / n) / n, 0.0)


def grow(slots: np.ndarray, weight: np.ndarray, target: np.ndarray, splits: Sequence[np.ndarray], depth: int, random, some: int):
    """A regression tree as a list of nodes, and the node that each cell ends in.

    A node is [feature, border, left, right, gain, impurity, weight, sum, sum of squares]; -1 stands for none.
    `slots` has the bins of each cell, feature by feature.
    """
    features, bins = len(slots), max([1, *(len(x) + 1 for x in splits)])
    n, s, q = weight.sum(), (weight * target).sum(), (weight * target * target).sum()
    nodes = [[-1, 0.0, -1, -1, -1.0, float(_variance(n, s, q)), n, s, q]]
    node = np.zeros(slots.shape[1], dtype=np.int64)
    open_, at = [0], np.arange(slots.shape[1])
    possible = np.array([[k < len(x) for k in range(bins)] for x in splits])
    for level in range(depth):
        place = np.full(len(nodes), -1)
        place[open_] = np.arange(len(open_))
        base = place[node[at]]
        at, base = at[base >= 0], base[base >= 0]
        w, t = weight[at], target[at]
        wt = w * t
        wtt = wt * t
        chosen = [_drawn(random, features, some) if some < features else range(features) for _ in open_]
        needed = {f for x in chosen for f in x if len(splits[f])}
        best: list = [(0.0, None)] * len(open_)
        found = {}
        for f in needed:
            cell = base * bins + slots[f][at]
            sums = [np.bincount(cell, x, len(open_) * bins).reshape(-1, bins).cumsum(axis=1) for x in (w, wt, wtt)]
            (ln, ls, lq), (n, s, q) = sums, [x[:, -1:] for x in sums]
            rn, rs, rq = n - ln, s - ls, q - lq
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = _variance(n, s, q) - ln / n * _variance(ln, ls, lq) - rn / n * _variance(rn, rs, rq)
            low = 1e-12 * n
            gain = np.where((ln > low) & (rn > low) & possible[f], gain, -np.inf)
            found[f] = gain, sums
        for k, features_of in enumerate(chosen):
            for f in features_of:
                if f in found:
                    b = int(found[f][0][k].argmax())
                    if found[f][0][k, b] > best[k][0]:
                        best[k] = (float(found[f][0][k, b]), (f, b))
        border, of, left = np.full(len(open_), -1), np.zeros(len(open_), dtype=np.int64), np.zeros(len(open_), dtype=np.int64)
        opened = []
        for k, (gain, split) in enumerate(best):
            if split is None:
                continue
            f, b = split
            sums = found[f][1]
            border[k], of[k], left[k] = b, f, len(nodes)
            nodes[open_[k]][:5] = [f, float(splits[f][b]), len(nodes), len(nodes) + 1, gain]
            for n, s, q in ([x[k, b] for x in sums], [x[k, -1] - x[k, b] for x in sums]):
                impurity = float(_variance(n, s, q))
                if level + 1 < depth and abs(impurity) >= np.finfo(float).eps:
                    opened.append(len(nodes))
                nodes.append([-1, 0.0, -1, -1, -1.0, impurity, n, s, q])
        moved = border[base] >= 0
        at, base = at[moved], base[moved]
        node[at] = left[base] + (slots[of[base], at] > border[base])
        open_ = opened
        if not open_:
            break
    return nodes, node


def boost(slots, label, weight, count, held, splits, *, seed, rounds, depth, step, sample, some, tolerance, validate):
    """Trees over cells, the first with weight 1 and the others with `step`; see `models.boosted`.

    `sample` draws rows of each cell for each tree, as many as single draws of its rows would give.
    """
    random, sign = np.random.default_rng(seed), 2.0 * label - 1
    drawn, held_weight = np.where(held, 0, count), np.where(held, weight * count, 0.0)
    score, trees, best, best_error = np.zeros(len(label)), [], 1, None
    while len(trees) < rounds:
        target = 4 * sign / (1 + np.exp(np.minimum(2 * sign * score, 700))) if trees else sign
        rows = random.binomial(drawn, sample) if sample < 1 else drawn
        nodes, node = grow(slots, weight * rows, target, splits, depth, random, some)
        value = np.array([x[7] / x[6] if x[6] > 0 else 0.0 for x in nodes])
        score = score + (step if trees else 1.0) * value[node]
        trees.append(nodes)
        if validate:
            total = held_weight.sum()
            error = (held_weight * 2 * np.logaddexp(0, -2 * sign * score)).sum() / total if total else float("nan")
            if best_error is None:
                best_error = error
            elif best_error - error < tolerance * max(error, 0.01):
                break
            elif error < best_error:
                best, best_error = len(trees), error
    return trees[:best] if validate else trees


class CellBoosting(GBTClassifier):
    """`GBTClassifier` that grows its trees over counted cells in one task, if there are at most `GROUP_ROWS` of them.

    With more cells, or features that are categories, Spark's own learner runs over all rows. Drawn rows and features
    (`subsamplingRate`, `featureSubsetStrategy`) come from the seed and the cells, not from the partitions of the rows.
    """

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        return self.fit_seeds(dataset, [self.getSeed()])[0]

    def fit_seeds(self, dataset: DataFrame, seeds: Sequence[int], max_cells: int = GROUP_ROWS) -> list[GBTClassificationModel]:
        """A model for each seed; the rows are counted once for all of them."""
        learners = [self.copy({self.seed: seed}) for seed in seeds]
        found = self._cells(dataset)
        if found is None or found[0].count() > max_cells:
            return [super(CellBoosting, one)._fit(dataset) for one in learners]
        with ThreadPoolExecutor(len(learners)) as pool:
            return list(pool.map(lambda one: one._boosted(*found), learners))

    def _cells(self, dataset: DataFrame) -> tuple[DataFrame, list[np.ndarray]] | None:
        """Cells with their number of rows, and the borders of the bins; None where Spark's learner has to run."""
        about = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {})
        weighted = self.isDefined("weightCol") and self.getWeightCol()
        held = self.isDefined("validationIndicatorCol") and self.getValidationIndicatorCol()
        rows = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("_x"),
            F.col(self.getLabelCol()).cast("double").alias("_y"),
            (F.col(self.getWeightCol()).cast("double") if weighted else F.lit(1.0)).alias("_w"),
            (F.col(held) if held else F.lit(False)).alias("_held"),
        )
        train = rows.where(~F.col("_held"))
        if set(about.get("attrs", {})) - {"numeric"}:
            return None

        def weights(of: DataFrame) -> pd.DataFrame:
            each = of.select("_w", F.posexplode("_x").alias("feature", "value"))
            sums = each.groupBy("feature", "value").agg(F.sum("_w").alias("w"), F.count(F.lit(1)).alias("n"))
            return sums.limit(BROADCAST_ROWS + 1).toPandas()

        values = weights(train)
        if len(values) > BROADCAST_ROWS:
            n, total = train.agg(F.count(F.lit(1)), F.sum("_w")).first()
            share = min(1.0, max(self.getMaxBins() ** 2, BIN_ROWS) / n)
            values, total = weights(train.sample(share, self.getSeed())), total * share
        else:
            n, total = values.loc[values["feature"] == 0, ["n", "w"]].sum()
        bins, width = int(min(self.getMaxBins(), n)), len(set(values["feature"]))
        if not n or not total or len(values) > BROADCAST_ROWS or bins > 256 or not np.isfinite(values["value"].to_numpy(dtype=float)).all():
            return None
        splits = [np.empty(0)] * width
        for f, part in values.sort_values("value").groupby("feature"):
            splits[f] = thresholds(part["value"].to_numpy(), part["w"].to_numpy(), total, bins)

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.asarray(batch.column(0).flatten()).reshape(-1, width)
                cells = np.stack([np.searchsorted(splits[f], x[:, f]) for f in range(width)], axis=1).astype(np.uint8)
                table = pa.table({"cell": pa.array([c.tobytes() for c in cells], pa.binary()), "y": batch.column(1), "w": batch.column(2), "held": batch.column(3)})
                yield from table.group_by(["cell", "y", "w", "held"]).aggregate([([], "count_all")]).rename_columns(["cell", "y", "w", "held", "n"]).to_batches()

        schema = "cell binary, y double, w double, held boolean, n long"
        cells = rows.mapInArrow(counted, schema).groupBy("cell", "y", "w", "held").agg(F.sum("n").alias("n"))
        cells = stored_copy(cells)
        # Nulls, other labels and weights below 0 are errors that Spark's learner tells.
        good = F.col("y").isin(0, 1) & (F.col("w") >= 0) & (F.col("w") < float("inf")) & F.col("held").isNotNull()
        return None if cells.where(~F.coalesce(good, F.lit(False))).limit(1).count() else (cells, splits)

    def _boosted(self, cells: DataFrame, splits: list[np.ndarray]) -> GBTClassificationModel:
        width, strategy = len(splits), self.getFeatureSubsetStrategy()
        shares = {"auto": width, "all": width, "sqrt": np.ceil(np.sqrt(width)), "log2": max(1, np.ceil(np.log2(width))), "onethird": np.ceil(width / 3)}
        if strategy in shares:
            some = int(shares[strategy])
        else:
            some = min(width, int(strategy)) if strategy.isdigit() and int(strategy) > 0 and strategy != "1" else int(np.ceil(float(strategy) * width))
        settings = {
            "seed": self.getSeed() % 2**63, "rounds": self.getMaxIter(), "depth": self.getMaxDepth(), "step": self.getStepSize(), "some": some,
            "sample": self.getSubsamplingRate(), "tolerance": self.getValidationTol(), "validate": self.isDefined("validationIndicatorCol"),
        }

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [b for b in batches if b.num_rows]
            if not parts:
                return
            # One order of the cells, whatever files they come from.
            table = pa.Table.from_batches(parts).sort_by([(c, "ascending") for c in ("cell", "y", "w", "held")])
            y, w, n = (table[c].to_numpy() for c in ("y", "w", "n"))
            held = table["held"].to_numpy(zero_copy_only=False).astype(bool)
            slots = np.frombuffer(b"".join(table["cell"].to_pylist()), dtype=np.uint8).reshape(-1, width).T.astype(np.int64 if len(y) < 500_000 else np.uint8)
            trees = boost(np.ascontiguousarray(slots), y, w, n, held, splits, **settings)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], names=["trees"])

        trees = pickle.loads(cells.coalesce(1).mapInArrow(run, "trees binary").first()[0])
        return self._copyValues(CellModel(cells.sparkSession.sparkContext, trees, self.getStepSize(), width))


class CellModel(GBTClassificationModel):
    """Spark's model of the trees; the driver's JVM gets them when something but their importances is asked for."""

    def __init__(self, sc, trees: list, step: float, width: int):
        self._grown = sc, trees, step, width
        super().__init__(None)

    @property
    def _java_obj(self):
        if self._made is None and self._grown is not None:
            self._made = _java_model(*self._grown, self.uid)
        return self._made

    @_java_obj.setter
    def _java_obj(self, value):
        self._made = value

    def __del__(self):
        if self._made is not None:
            super().__del__()

    @property
    def featureImportances(self) -> DenseVector:
        """Gain times weight of the nodes that split by a feature, as a share of all."""
        _, trees, _, width = self._grown
        sums = np.zeros(width)
        for feature, _, _, _, gain, _, weight, _, _ in (node for nodes in trees for node in nodes):
            if feature >= 0:
                sums[feature] += gain * weight
        return DenseVector(sums / sums.sum() if sums.sum() else sums)


def _java_model(sc, trees: list, step: float, width: int, uid: str):
    """Spark's own model of the trees."""
    tree, copied = sc._jvm.org.apache.spark.ml.tree, sc._jvm.java.util.Arrays.copyOfRange
    variance = sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    regression = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel

    def doubles(values: list[float]):
        return _py2java(sc, DenseVector(values)).toArray()

    def made(nodes: list, stats, k: int):
        feature, border, left, right, gain, impurity, n, s, _ = nodes[k]
        value, own = float(s / n) if n > 0 else 0.0, variance(copied(stats, 3 * k, 3 * k + 3), round(n))
        if feature < 0:
            return tree.LeafNode(value, impurity, own)
        return tree.InternalNode(value, impurity, gain, made(nodes, stats, left), made(nodes, stats, right), tree.ContinuousSplit(feature, border), own)

    java = sc._gateway.new_array(regression, len(trees))
    for k, nodes in enumerate(trees):
        java[k] = regression(f"dtr_{uuid.uuid4().hex[:12]}", made(nodes, doubles([v for x in nodes for v in x[6:]]), 0), width)
    weights = doubles([1.0, *[step] * (len(trees) - 1)])
    return sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, java, weights, width, 2)
