"""Ranking metrics against brute force, in both the plain and the chunked way."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from laurel.modelling import models, splits
from laurel.operators import ranking


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    data = [(g, i, rng.randint(0, 12) / 2, int(rng.random() < 0.15)) for g in range(4) for i in range(40)]
    data += [(9, i, 1.0, 0) for i in range(5)]  # no winner
    return spark.createDataFrame(data, "g int, id int, score double, y int"), data


@pytest.mark.parametrize("max_rows", [10_000, 7])
def test_margin_loss(scored, max_rows):
    df, data = scored
    losses = [
        max(0.0, 1.5 - (w[2] - l[2])) for w in data for l in data if w[0] == l[0] and w[3] == 1 and l[3] == 0
    ]
    got = ranking.margin_loss(df, ["g"], margin=1.5, max_rows=max_rows).first()
    assert got.pairs == len(losses)
    assert got.margin_loss == pytest.approx(sum(losses) / len(losses))


@pytest.mark.parametrize("max_rows", [10_000, 3])
def test_auc(scored, max_rows):
    df, data = scored
    pos, neg = [d[2] for d in data if d[3]], [d[2] for d in data if not d[3]]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert ranking.roc_auc(df, max_rows=max_rows).first().auc == pytest.approx(wins / len(pos) / len(neg))


def test_hit_rates(scored):
    df, data = scored
    hits = []
    for g in range(4):
        order = sorted((d for d in data if d[0] == g), key=lambda d: (-d[2], d[1]))
        hits.append(max(d[3] for d in order[:3]))
    skipped = ranking.hit_rates(df, ["g"], "id", (3,)).first()
    missed = ranking.hit_rates(df, ["g"], "id", (3,), skip_groups_without_winner=False).first()
    assert (skipped.groups, skipped.top_3_hit_rate) == (4, sum(hits) / 4)
    assert (missed.groups, missed.top_3_hit_rate) == (5, sum(hits) / 5)


def test_predictions(scored):
    df, data = scored
    for r in ranking.predictions(df, ["g"], "id").collect():
        order = sorted((d for d in data if d[0] == r.g), key=lambda d: (-d[2], d[1]))
        assert r.predicted_winner == order[0][1]
        assert [d[3] for d in order].index(1) + 1 == r.winner_rank


def test_top_candidates(scored):
    df, _ = scored
    from pyspark.sql import functions as F

    nested = ranking.top_candidates(df, ["g"], [F.desc("score"), F.asc("id")], ["id", "score"], 5)
    assert all([c.rank for c in r.top] == [1, 2, 3, 4, 5] for r in nested.collect())


def test_stratified_split_is_exact_and_repeats(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "id int, y int")
    first, again = (splits.stratified_split(df, "y", "id") for _ in range(2))
    counts = {(r.y, r.part): r["count"] for r in first.groupBy("y", "part").count().collect()}
    assert counts == {(0, "train"): 144, (0, "test"): 36, (1, "train"): 16, (1, "test"): 4}
    assert sorted(first.collect()) == sorted(again.collect())


def test_folds_do_not_overlap(spark):
    df = spark.createDataFrame([(2000 + i % 6,) for i in range(60)], "season int")
    for season, train, validation in splits.season_folds(df, 3):
        assert train.where(f"season >= {season}").isEmpty()
        assert validation.where(f"season <> {season}").isEmpty()


def test_pairwise_ranker_learns_the_winning_column(spark):
    rng = random.Random(5)
    data = []
    for g in range(40):
        xs = [rng.random() for _ in range(8)]
        data += [(g, i, x, rng.random(), int(x == max(xs))) for i, x in enumerate(xs)]
    df = spark.createDataFrame(data, "g int, id int, good double, noise double, y int")
    weights = models.fit_pairwise(df, ["g"], ["good", "noise"])
    assert weights["good"] > 3 * abs(weights["noise"])
    rate = ranking.hit_rates(models.linear_score(df, weights), ["g"], "id", (1,)).first().top_1_hit_rate
    assert rate > 0.8


def test_repeat_positives_keeps_all_rows(spark):
    df = spark.createDataFrame([(i, int(i < 5)) for i in range(50)], "id int, y int")
    balanced = models.repeat_positives(df, "y")
    assert balanced.select("id").distinct().count() == 50
    assert balanced.where("y = 1").count() == 45


def test_season_search_lists_folds_without_training_rows(spark):
    df = spark.createDataFrame([(1, 1, 1, 1), (1, 1, 2, 0), (2, 2, 1, 1), (2, 2, 2, 0)], "season int, week int, player int, y int")
    score = lambda train, validation, setting: validation.withColumn("score", F.col("y") * 1.0)
    found = models.season_search(df, [{"a": 1}], score, ["week"], "player", folds=5)
    assert rows(found, "season", "groups", "top_1_hit_rate") == [(1, 0, None), (2, 1, 1.0)]
    assert models.best_setting(found).first().mean_top_1 == 1.0


@pytest.mark.parametrize("points", [7, 500])
def test_density_against_all_kernels(spark, points):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(10, 2, 3000), np.repeat([4.0, 4.5, 30.0], 200), rng.exponential(1, 500), [80.0]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 5, "v double")
    got = {r.point: (r.x, r.density) for r in ranking.density(df, "v", points).collect()}
    h = values.std(ddof=1) * len(values) ** -0.2
    assert sorted(got) == list(range(points))
    for p in range(points):
        x = values.min() + (values.max() - values.min()) * p / (points - 1)
        want = np.exp(-(((x - values) / h) ** 2) / 2).sum() / (len(values) * h * np.sqrt(2 * np.pi))
        assert got[p][0] == pytest.approx(x, rel=1e-12) and got[p][1] == pytest.approx(want, rel=1e-9, abs=1e-13)


def test_density_of_columns_without_spread(spark):
    for values in ([], [None, None], [2.0], [2.0, 2.0, 2.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert ranking.density(df, "v").count() == 0
    pair = spark.createDataFrame([(0,), (1,)], "v int")
    assert ranking.density(pair, "v", 3).count() == 3
