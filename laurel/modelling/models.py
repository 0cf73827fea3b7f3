"""Models on feature tables: pipelines, classifiers, rankers, search, saved models.

Every fit is a Spark job over the partitions of the training rows; the driver holds coefficients, trees, the weights of
a perceptron and fold metrics only.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, functions as F

from laurel.modelling.boosting import CellBoosting
from laurel.modelling.splits import season_folds
from laurel.operators import ranking
from laurel.operators.ordered import OrderedGroups, Prefix
from laurel.session import BROADCAST_ROWS, GROUP_ROWS, broadcast_checked, stored_copy

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Columns that name the row, hold the answer, or are known only after the season.
NOT_FEATURES = (
    "full_name", "player_id", "pow_player_id", "player_of_the_week", "won_player_of_the_week",
    "all_star_this_season", "mvp_this_season", "all_nba_first_team_this_season",
    "all_nba_second_team_this_season", "all_nba_third_team_this_season", "week_start", "pow_conference",
    "is_win_vs_over_500", "opponent_has_all_nba",
)


def feature_stages(
    df: DataFrame,
    exclude: Sequence[str] = NOT_FEATURES,
    categories: Sequence[str] = (),
    scale: bool = True,
    components: int | None = None,
) -> list:
    """Stages from columns to `features`: index, one-hot, assemble, scale, project.

    Unknown categories of later data get a column of their own instead of an error.
    """
    numeric = [c for c, kind in df.dtypes if c not in exclude and c not in categories and kind not in ("string", "date")]
    stages: list = []
    if categories:
        indexed, hot = [f"{c}_index" for c in categories], [f"{c}_hot" for c in categories]
        stages.append(
            StringIndexer(
                inputCols=list(categories), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=False))
        numeric = numeric + hot
    last = "raw_features" if scale or components else "features"
    stages.append(VectorAssembler(inputCols=numeric, outputCol=last, handleInvalid="error"))
    if scale:
        out = "scaled_features" if components else "features"
        stages.append(StandardScaler(inputCol=last, outputCol=out, withMean=True, withStd=True))
        last = out
    if components:
        stages.append(PCA(k=components, inputCol=last, outputCol="features"))
    return stages


def assemble_features(df: DataFrame, exclude: Sequence[str], categories: Sequence[str] = ()) -> DataFrame:
    """Feature vector of each row beside its columns; leakage and id columns stay outside."""
    return Pipeline(stages=feature_stages(df, exclude, categories, scale=False)).fit(df).transform(df)


def explained_variance(df: DataFrame, columns: Sequence[str], k: int | None = None) -> DataFrame:
    """(component, ratio, cumulative) of a principal component analysis of the scaled columns.

    All components unless `k` is given; a threshold needs all of them.
    """
    frame = df.select(*columns)
    model = Pipeline(stages=feature_stages(frame, exclude=(), components=k or len(columns))).fit(frame)
    total, rows = 0.0, []
    for i, ratio in enumerate(model.stages[-1].explainedVariance, start=1):
        total += float(ratio)
        rows.append((i, float(ratio), total))
    return df.sparkSession.createDataFrame(rows, "component int, ratio double, cumulative double")


def components_for(variance: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Smallest number of components that explain at least `threshold`; an error if those listed do not."""
    reached = variance.agg(F.max("cumulative")).first()[0]
    if reached is None or reached < threshold - 1e-9:
        raise ValueError(f"the components listed explain {reached}, less than {threshold}")
    return variance.where(F.col("cumulative") >= threshold).agg(F.min("component").alias("components"))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight n / (k * n_c) of each row's class."""
    n, positives = df.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 1)).first()
    if not 0 < positives < n:
        raise ValueError("training rows need both classes")
    return df.withColumn(
        name, F.when(F.col(label) == 1, n / (2 * positives)).otherwise(n / (2 * (n - positives)))
    )


def logistic(label: str = "y", weight: str | None = "weight", reg: float = 0.01, max_iter: int = 100):
    model = LogisticRegression(labelCol=label, featuresCol="features", regParam=reg, maxIter=max_iter)
    return model.setWeightCol(weight) if weight else model


def boosted(
    label: str = "y",
    weight: str | None = "weight",
    rounds: int = 20,
    depth: int = 5,
    seed: int = 42,
    step: float = 0.1,
    sample: float = 1.0,
    features: str = "all",
    held: str | None = None,
    tolerance: float = 0.01,
):
    """Boosted trees. With `held`, a column that marks validation rows, `rounds` is a limit only.

    Boosting then stops when a round lowers the loss on the marked rows by less than `tolerance` of it, and the
    model keeps the trees up to the best round. `sample` and `features` draw rows and features for each tree.
    """
    model = CellBoosting(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, seed=seed, stepSize=step,
        subsamplingRate=sample, featureSubsetStrategy=features, validationTol=tolerance,
    )
    if held:
        model = model.setValidationIndicatorCol(held)
    return model.setWeightCol(weight) if weight else model


def fit_side_by_side(jobs: Sequence[Callable[[], object]], most: int = 4) -> list:
    """Results of fits that do not need each other, `most` at a time: their Spark jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=most) as pool:
        return list(pool.map(lambda job: job(), jobs))


@dataclass
class RankingTrees:
    """A boosted ranker: the score of a row is the sum of its trees' predictions times `step`."""

    trees: list
    step: float
    columns: list[str]
    losses: list[float]

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        rows = VectorAssembler(inputCols=self.columns, outputCol="_features").transform(df).withColumn(name, F.lit(0.0))
        for tree in self.trees:
            tree = tree.copy({tree.featuresCol: "_features", tree.predictionCol: "_tree"})
            rows = tree.transform(rows).withColumn(name, F.col(name) + self.step * F.col("_tree")).drop("_tree")
        return rows.drop("_features")


def counted_rows(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Different rows of `columns`, and `_rows`, how often each comes: equal rows of a group have equal gradients."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))


def with_sides(df: DataFrame, keys: Sequence[str], label: str, count: str | None = None) -> DataFrame:
    """`df` with the number of `_winners` and `_losers` of each group; groups without both are left out.

    A row stands for as many as the column `count` says, here and in `margin_gradients`.
    """
    wins, n = F.col(label) == 1, F.col(count) if count else F.lit(1).cast("long")
    sides = df.groupBy(*keys).agg(F.sum(F.when(wins, n).otherwise(0)).alias("_winners"), F.sum(F.when(~wins, n).otherwise(0)).alias("_losers"))
    return df.join(sides.where("_winners > 0 and _losers > 0"), list(keys))


def margin_gradients(
    df: DataFrame, keys: Sequence[str], score: str, label: str, margin: float = 1.0, max_rows: int | None = GROUP_ROWS, count: str | None = None
) -> DataFrame:
    """Rows of `with_sides` with `_pull`, the share of the other side that a row has not yet passed by `margin`.

    A winner is pulled up by the share of its group's losers above `winner - margin`, a loser down by the share of
    the winners below `loser + margin`: the gradient of the mean margin loss over the pairs. No pair is formed:
    losers stand at their score, winners at theirs less the margin, and both shares are running counts in that one
    order. `_weight` makes the winners and the losers of a group count 1 in all each.
    """
    wins, n = F.col(label) == 1, F.col(count) if count else F.lit(1).cast("long")
    placed = df.withColumn("_at", F.when(wins, F.col(score) - margin).otherwise(F.col(score)))
    # Of equal places the loser comes first: a loser just `margin` below costs nothing.
    counted = (
        OrderedGroups(placed, keys, ["_at", F.col(label)], max_rows)
        .add(Prefix("_below_w", "sum", wins.cast("long") * n), Prefix("_below_l", "sum", (~wins).cast("long") * n))
        .result()
    )
    pull = F.when(wins, (F.col("_losers") - F.col("_below_l")) / F.col("_losers")).otherwise(-F.col("_below_w") / F.col("_winners"))
    weight = F.when(wins, n / F.col("_winners")).otherwise(n / F.col("_losers"))
    return counted.withColumns({"_pull": pull, "_weight": weight}).drop("_at", "_below_w", "_below_l")


def fit_ranking_trees(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    held: str,
    label: str = "y",
    rounds: int = 200,
    depth: int = 4,
    step: float = 0.5,
    tolerance: float = 0.01,
    patience: int = 3,
    seed: int = 42,
    max_rows: int = GROUP_ROWS,
) -> RankingTrees:
    """Regression trees on the margin gradients of each group, one a round, for ranking within groups.

    Rows with `held` true are not fitted; their winners' mean pull is the loss that stops the boosting when
    `patience` rounds did not lower it by `tolerance` of it, and trees behind the best round are dropped. `rounds`
    is a limit only. Each round reads the scores of the round before from a stored table, so plans do not nest.
    Rows that agree in group, label and columns are one row with a count and as many times the weight.
    """
    different = counted_rows(df, [*keys, label, held, *columns])
    rows = VectorAssembler(inputCols=list(columns), outputCol="features").transform(with_sides(different, keys, label, "_rows"))
    rows = stored_copy(rows.select(*keys, label, held, "features", "_winners", "_losers", "_rows", F.lit(0.0).alias("score")))
    # The groups stay as they are, so one look says whether any has to be cut into chunks.
    largest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    limit = max_rows if largest > max_rows else None
    trees, losses, best = [], [], 0
    while len(trees) < rounds:
        pulled = stored_copy(margin_gradients(rows, keys, "score", label, max_rows=limit, count="_rows"))
        loss = pulled.where(F.col(held) & (F.col(label) == 1)).agg(F.sum(F.col("_pull") * F.col("_rows")) / F.sum("_rows")).first()[0]
        losses.append(1.0 if loss is None else float(loss))
        best = len(losses) - 1 if losses[-1] < losses[best] * (1 - tolerance) else best
        if len(losses) - 1 - best >= patience or losses[-1] == 0:
            break
        learner = DecisionTreeRegressor(featuresCol="features", labelCol="_pull", weightCol="_weight", predictionCol="_tree", maxDepth=depth, seed=seed + len(trees))
        tree = learner.fit(pulled.where(~F.col(held)))
        trees.append(tree)
        # The next round's scores come out of the table that the gradients are in already.
        rows = tree.transform(pulled).withColumn("score", F.col("score") + step * F.col("_tree")).drop("_tree", "_pull", "_weight")
    return RankingTrees(trees[: max(best, 1)], step, list(columns), losses)


@dataclass
class GroupPerceptron:
    """A perceptron with one output, the score of a row; null features count as 0."""

    layers: list  # (weights, offsets) of each layer
    columns: list[str]
    losses: list[float]

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        layers, width = self.layers, len(self.columns)

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                x = np.vstack(rows.to_numpy()) if len(rows) else np.empty((0, width))
                yield pd.Series(_forward(layers, x)[-1][:, 0])

        return df.withColumn(name, scored(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.columns])))


def _forward(layers: list, x: np.ndarray) -> list[np.ndarray]:
    """Input and outputs of all layers; all but the last are cut at 0."""
    out = [x]
    for k, (weights, offsets) in enumerate(layers):
        x = x @ weights + offsets
        x = x if k == len(layers) - 1 else np.maximum(x, 0)
        out.append(x)
    return out


def _gradient(layers: list, x: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """Sum over rows of the gradient of all weights, flat, where the score of a row has the gradient `-pull`."""
    values, parts = _forward(layers, x), []
    slope = -pull[:, None]
    for k in range(len(layers) - 1, -1, -1):
        parts += [slope.sum(axis=0), (values[k].T @ slope).ravel()]
        if k:
            slope = (slope @ layers[k][0].T) * (values[k] > 0)
    return np.concatenate(parts[::-1])


def fit_group_perceptron(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    label: str = "y",
    hidden: Sequence[int] = (256, 128, 64),
    epochs: int = 60,
    step: float = 0.003,
    margin: float = 1.0,
    seed: int = 42,
    max_rows: int = GROUP_ROWS,
) -> GroupPerceptron:
    """Perceptron that ranks within groups: it lowers the mean margin loss over winner-loser pairs of each group.

    An epoch is one job: tasks score each different row of the columns, `margin_gradients` says how far each row is
    pulled without forming a pair, the pulls of equal rows are added up, and tasks add up the gradients of the weights,
    which are summed weight by weight. Rows that agree in group, label and columns are one row with a count. Only those sums, as many
    as the layers have weights, come to the driver, which steps (Adam). A group may be of any size, and groups weigh
    the same. `losses` has the mean pull of the winners before each step and at the end; the weights with the least
    of them are kept. Groups without both labels are left out; without any group the weights stay as they began.
    """
    features = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]).alias("_x")
    spread = df.sparkSession.sparkContext.defaultParallelism
    different = stored_copy(counted_rows(df.select(*keys, label, features), [*keys, label, "_x"]))
    sided = with_sides(different, keys, label, "_rows")
    # The layers are run once for each different row of the columns; the number that a row refers to is written.
    points = stored_copy(sided.select("_x").distinct().repartition(spread).withColumn("_id", F.monotonically_increasing_id()))
    small = points.count() <= BROADCAST_ROWS

    def hinted(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if small else side

    rows = stored_copy(sided.join(hinted(points), "_x").drop("_x"))
    groups = rows.select(*keys).distinct().count()
    largest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    limit = max_rows if largest > max_rows else None
    random, sizes = np.random.default_rng(seed), [len(columns), *hidden, 1]
    layers = [(random.normal(0, np.sqrt(2 / a), (a, b)), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]
    count, width = sum(w.size + o.size for w, o in layers), len(columns)

    def unpacked(flat: np.ndarray) -> list:
        out, at = [], 0
        for a, b in zip(sizes, sizes[1:]):
            out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return out

    def summed(layers: list) -> tuple[np.ndarray, float]:
        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                yield pd.Series(_forward(layers, np.vstack(x.to_numpy()))[-1][:, 0] if len(x) else [], dtype=float)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, any_rows = np.zeros(count + 1), False
            for batch in batches:
                if not batch.num_rows:
                    continue
                pull, loss = (np.asarray(batch.column(c)) for c in ("_pull", "_loss"))
                x = np.asarray(batch.column("_x").flatten()).reshape(-1, width)
                total[:-1] += _gradient(layers, x, pull)
                total[-1] += loss.sum()
                any_rows = True
            if any_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(count + 1, dtype=np.int32)), pa.array(total)], names=["slot", "value"])

        score = hinted(points.select("_id", scored("_x").alias("_score")))
        pulled = margin_gradients(rows.join(score, "_id"), keys, "_score", label, margin, max_rows=limit, count="_rows")
        force = F.col("_pull") * F.col("_weight")
        pulled = pulled.groupBy("_id").agg(F.sum(force).alias("_pull"), F.sum(F.when(F.col(label) == 1, force).otherwise(0.0)).alias("_loss"))
        pulled = points.join(hinted(pulled), "_id").select("_x", "_pull", "_loss")
        found = pulled.mapInArrow(sums, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).toPandas()
        flat = np.zeros(count + 1)
        flat[found["slot"].to_numpy()] = found["value"].to_numpy()
        return flat[:-1] / max(1, groups), flat[-1] / max(1, groups)

    flat = np.concatenate([part.ravel() for layer in layers for part in layer])
    first, second, losses, best = np.zeros(count), np.zeros(count), [], flat
    for epoch in range(epochs + 1):
        slope, loss = summed(unpacked(flat))
        best = flat if not losses or loss < min(losses) else best
        losses.append(loss)
        if epoch == epochs or loss == 0:
            break
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        scale = np.sqrt(1 - 0.999 ** (epoch + 1)) / (1 - 0.9 ** (epoch + 1))
        flat = flat - step * scale * first / (np.sqrt(second) + 1e-8)
    return GroupPerceptron(unpacked(best), list(columns), losses)


def perceptron(inputs: int, hidden: Sequence[int] = (64, 32), label: str = "y", max_iter: int = 100, seed: int = 42):
    return MultilayerPerceptronClassifier(
        labelCol=label, featuresCol="features", layers=[inputs, *hidden, 2], maxIter=max_iter, seed=seed
    )


def repeat_positives(df: DataFrame, label: str) -> DataFrame:
    """Positive rows repeated until both classes weigh about the same; no row is left out.

    For learners without row weights.
    """
    negatives, positives = df.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    times = max(1, round(negatives / positives)) if positives else 1
    copies = F.when(F.col(label) == 1, F.lit(times)).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def fit(df: DataFrame, stages: Sequence, learner) -> PipelineModel:
    return Pipeline(stages=[*stages, learner]).fit(df)


def fit_seeds(df: DataFrame, stages: Sequence, learner: CellBoosting, seeds: Sequence[int]) -> list[PipelineModel]:
    """A model of `fit` for each seed; the stages are fitted and the rows are counted once for all of them."""
    prepared = Pipeline(stages=list(stages)).fit(df)
    return [PipelineModel([*prepared.stages, m]) for m in learner.fit_seeds(prepared.transform(df), seeds)]


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Probability of class 1 as `score`, beside the input columns and `prediction`."""
    scored = model.transform(df)
    return scored.select(
        *df.columns, F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias(name),
    )


def area_under_roc(scored: DataFrame, label: str = "y") -> float:
    """Area under the ROC curve of Spark's binned evaluator (`ranking.roc_auc` is exact)."""
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="score", metricName="areaUnderROC")
    return evaluator.evaluate(scored)


def winner_differences(df: DataFrame, keys: Sequence[str], columns: Sequence[str], label: str = "y", counted: bool = False) -> DataFrame:
    """One row per loser: the mean of its group's winners minus the loser, as `features`.

    One difference per loser keeps the table as long as its input; with one winner per group it is
    every winner-loser pair. Half of the rows, by hash, are mirrored with label 0, which leaves the
    logistic loss as it is and gives the learner both classes. With `counted`, equal losers of a group are one row
    and `_rows` says how many.
    """
    winners = df.where(F.col(label) == 1).groupBy(*keys).agg(*[F.avg(c).alias(f"_w_{c}") for c in columns])
    losers = df.where(F.col(label) == 0)
    losers = counted_rows(losers, [*keys, *columns]) if counted else losers
    losers = losers.join(broadcast_checked(winners), list(keys))
    sign = F.when(F.pmod(F.xxhash64(*keys, *columns), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    signed = losers.withColumn("_sign", sign).select(
        *[((F.col(f"_w_{c}") - F.col(c)) * F.col("_sign")).alias(c) for c in columns],
        (F.col("_sign") > 0).cast("int").alias("label"),
        *([F.col("_rows").cast("double").alias("_rows")] if counted else []),
    )
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(signed)


def fit_pairwise(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], label: str = "y", reg: float = 0.001, max_iter: int = 100, max_rows: int = GROUP_ROWS
) -> dict[str, float]:
    """Weights w of a linear ranker: winners should score higher than losers of their group.

    The learner keeps its rows on the executors. Of more than `max_rows` losers, equal ones of a group are one row with a
    weight, so that these fit.
    """
    counted = df.where(F.col(label) == 0).limit(max_rows + 1).count() > max_rows
    rows = winner_differences(df, keys, columns, label, counted)
    learner = LogisticRegression(featuresCol="features", labelCol="label", fitIntercept=False, maxIter=max_iter)
    if counted:
        rows = stored_copy(rows)
        n, squares = rows.agg(F.sum("_rows"), F.sum(F.col("_rows") * F.col("_rows"))).first()
        # The learner scales by deviations whose divisor is n - squares / n here and n - 1 for single rows.
        reg, learner = reg * (n - squares / n) / (n - 1) if n else reg, learner.setWeightCol("_rows")
    model = learner.setRegParam(reg).fit(rows)
    return dict(zip(columns, (float(w) for w in model.coefficients)))


def linear_score(df: DataFrame, weights: Mapping[str, float], name: str = "score") -> DataFrame:
    total = F.lit(0.0)
    for c, w in weights.items():
        total = total + F.col(c) * F.lit(w)
    return df.withColumn(name, total)


def importances(model: PipelineModel, inputs: Sequence[str], run: int, spark) -> DataFrame:
    """(run, feature, importance) of a tree model over plain columns."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(run, f, float(v)) for f, v in zip(inputs, values)]
    return spark.createDataFrame(rows, "run int, feature string, importance double")


def season_search(
    df: DataFrame,
    grid: Iterable[Mapping[str, object]],
    fit_and_score: Callable[[DataFrame, DataFrame, Mapping[str, object]], DataFrame],
    keys: Sequence[str],
    candidate: str,
    folds: int = 5,
    label: str = "y",
) -> DataFrame:
    """Top-1 hit rate of every setting on every season-forward fold.

    `fit_and_score(train, validation, setting)` returns the validation rows with a `score`. A fold without
    training rows has 0 groups and a null rate for each setting.
    """
    grid, rows = list(grid), []
    for season, train, validation in season_folds(df, folds):
        if train.isEmpty():
            rows += [(i, str(dict(setting)), season, 0, None) for i, setting in enumerate(grid)]
            continue
        for i, setting in enumerate(grid):
            scored = fit_and_score(train, validation, setting)
            groups, rate = ranking.hit_rates(scored, keys, candidate, (1,), label=label).first()
            rows.append((i, str(dict(setting)), season, groups, rate))
    return df.sparkSession.createDataFrame(
        rows, "setting int, parameters string, season int, groups bigint, top_1_hit_rate double"
    )


def best_setting(search: DataFrame) -> DataFrame:
    """Settings by their mean hit rate over the folds, best first."""
    return (
        search.groupBy("setting", "parameters")
        .agg(F.avg("top_1_hit_rate").alias("mean_top_1"))
        .orderBy(F.desc("mean_top_1"), "setting")
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
