"""Boosting over counted cells against Spark's learner, and its ways out."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from laurel.modelling import boosting, models


def weeks(spark, n=1500, copies=1):
    """Rows of few numbers, as sums of a week are; a fifth is held."""
    rng, data = random.Random(3), []
    for k in range(n):
        games = rng.randint(1, 4)
        points = sum(rng.randint(1, 50) for _ in range(games))
        data.append((float(points), float(games), float(rng.randint(0, games)), int(points + rng.gauss(0, 30) > 120), k % 5 == 0))
    df = spark.createDataFrame(data * copies, "points double, games double, made double, y int, held boolean")
    return models.class_weights(df, "y").repartition(3).cache()


def fitted(df, learner):
    stages = models.feature_stages(df.select("points", "games", "made"), exclude=(), scale=False)
    return models.fit(df, stages, learner)


def same_scores(one, other, df):
    a, b = ([r.score for r in models.score(m, df).orderBy("points", "games", "made", "y", "held").collect()] for m in (one, other))
    assert a == pytest.approx(b)


@pytest.mark.parametrize("settings", [{"rounds": 200, "held": "held", "tolerance": 0.001}, {"rounds": 6, "depth": 3}, {"rounds": 1}])
def test_cells_give_the_trees_of_all_rows(spark, monkeypatch, settings):
    df = weeks(spark)
    cells = fitted(df, models.boosted(**settings))
    monkeypatch.setattr(boosting.CellBoosting, "_fit", GBTClassifier._fit)
    plain = fitted(df, models.boosted(**settings))
    assert cells.stages[-1].getNumTrees == plain.stages[-1].getNumTrees
    assert cells.stages[-1].featureImportances.toArray() == pytest.approx(plain.stages[-1].featureImportances.toArray(), abs=0.01)
    same_scores(cells, plain, df)


def test_work_does_not_grow_with_the_rows_of_a_cell(spark, monkeypatch):
    seen, boosted = [], boosting.CellBoosting._boosted
    monkeypatch.setattr(boosting.CellBoosting, "_boosted", lambda self, cells, splits: seen.append(cells.count()) or boosted(self, cells, splits))
    for copies in (1, 8):
        df = weeks(spark, 400, copies)
        stages = models.feature_stages(df.select("points", "games", "made"), exclude=(), scale=False)
        found = models.fit_seeds(df, stages, models.boosted(rounds=30, depth=3, sample=0.7, features="0.5", held="held"), (1, 2))
        assert [m.stages[-1].getNumTrees > 0 for m in found] == [True, True]
        values = [m.stages[-1].featureImportances.toArray() for m in found]
        assert all(v.sum() == pytest.approx(1) for v in values) and not np.allclose(*values)
    assert len(set(seen)) == 1 and len(seen) == 4


def test_a_seed_repeats_whatever_the_partitions(spark):
    df, settings = weeks(spark, 400), {"rounds": 30, "depth": 3, "seed": 7, "sample": 0.7, "features": "0.5", "held": "held"}
    one, other = (fitted(x, models.boosted(**settings)) for x in (df, df.repartition(7, "points")))
    same_scores(one, other, df)


def test_more_cells_than_the_limit_go_to_the_learner_of_all_rows(spark, tmp_path):
    df = weeks(spark, 300)
    learner = models.boosted(rounds=5, depth=3, held="held")
    prepared = fitted(df, learner)
    features = prepared.stages[0].transform(df)
    (small,), (large,) = learner.fit_seeds(features, [42]), learner.fit_seeds(features, [42], max_cells=10)
    assert isinstance(small, boosting.CellModel) and not isinstance(large, boosting.CellModel)
    a, b = (sorted(r[0][1] for r in m.transform(features).select("probability").collect()) for m in (small, large))
    assert a == pytest.approx(b)
    models.save(prepared, f"{tmp_path}/model")
    same_scores(prepared, models.load(f"{tmp_path}/model"), df)


def test_labels_and_weights_that_no_learner_takes_are_errors(spark):
    for change in ({"y": F.lit(2)}, {"weight": F.lit(-1.0)}, {"points": F.lit(None).cast("double")}):
        with pytest.raises(Exception):
            fitted(weeks(spark, 60).withColumns(change), models.boosted(rounds=2))


def test_borders_of_few_and_of_many_values():
    assert boosting.thresholds(np.array([1.0, 2.0, 4.0]), np.ones(3), 3.0, 3).tolist() == [1.5, 3.0]
    assert boosting.thresholds(np.array([1.0]), np.ones(1), 1.0, 32).tolist() == []
    many = boosting.thresholds(np.arange(1000.0), np.ones(1000), 1000.0, 4)
    assert many.tolist() == [249.5, 499.5, 749.5]


@pytest.mark.parametrize("ranker", ["trees", "perceptron"])
def test_rankers_store_equal_rows_once(spark, monkeypatch, ranker):
    rng, stored, found = random.Random(5), models.stored_copy, {}
    data = [(g, float(rng.randint(0, 6)), float(rng.randint(0, 2)), int(k == 0), g % 4 == 3) for g in range(20) for k in range(12)]
    for copies in (1, 6):
        df, sizes = spark.createDataFrame(data * copies, "g int, x double, z double, y int, held boolean"), []
        monkeypatch.setattr(models, "stored_copy", lambda rows: (out := stored(rows), sizes.append(out.count()))[0])
        if ranker == "trees":
            model = models.fit_ranking_trees(df, ["g"], ["x", "z"], held="held", rounds=2)
        else:
            model = models.fit_group_perceptron(df, ["g"], ["x", "z"], hidden=(8, 4), epochs=1)
        found[copies] = model.losses, max(sizes)
    assert found[1][0] == pytest.approx(found[6][0])
    assert found[1][1] == found[6][1] <= len(set(data))


def test_pairwise_ranker_of_counted_losers(spark):
    rng = random.Random(9)
    data = [(g, float(rng.randint(0, 9)), float(rng.randint(0, 3)), int(k < 2)) for g in range(12) for k in range(30) for _ in range(1 + k % 3)]
    df = spark.createDataFrame(data, "g int, x double, z double, y int")
    plain, counted = (models.fit_pairwise(df, ["g"], ["x", "z"], reg=0.3, max_rows=m) for m in (10_000, 50))
    assert counted == pytest.approx(plain, rel=1e-4)
    once, single = (models.winner_differences(df, ["g"], ["x", "z"], counted=c) for c in (True, False))
    assert once.count() < single.count() == once.agg(F.sum("_rows")).first()[0]
