"""Boosting that stops early, ranking trees against brute force and a planted rule, functions with state per group."""

import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from laurel.modelling import models
from laurel.operators import groups, ranking


def planted(spark, seasons=4, size=12):
    """Groups whose winner is the row nearest to 5 in x: no linear score finds it."""
    rng, data = random.Random(8), []
    for season in range(seasons):
        for group in range(25):
            xs = [(rng.uniform(0, 10), rng.uniform(0, 1)) for _ in range(size)]
            best = min(range(size), key=lambda k: abs(xs[k][0] - 5))
            data += [(season, group, k, x, z, int(k == best)) for k, (x, z) in enumerate(xs)]
    return spark.createDataFrame(data, "season int, g int, id int, x double, z double, y int")


def test_ranking_trees_find_what_a_linear_ranker_cannot(spark):
    df = planted(spark).withColumn("held", F.col("season") == 2).cache()
    train, test = df.where("season < 3"), df.where("season = 3")
    trees = models.fit_ranking_trees(train, ["season", "g"], ["x", "z"], held="held", rounds=40)
    linear = models.fit_pairwise(train.where("not held"), ["season", "g"], ["x", "z"])
    rate = {}
    for name, scored in (("trees", trees.score(test)), ("linear", models.linear_score(test, linear))):
        rate[name] = ranking.hit_rates(scored, ["season", "g"], "id", (1,)).first()["top_1_hit_rate"]
    assert rate["trees"] > 0.5 > rate["linear"] + 0.1
    assert trees.losses[0] == 1.0 and min(trees.losses) < 0.4 and len(trees.trees) < 40


@pytest.mark.parametrize("max_rows", [None, 4])
def test_margin_gradients_against_pairs(spark, max_rows):
    rng = random.Random(4)
    data = [(g, rng.choice([0.0, 0.5, 1.0, 1.5, 3.0]), int(k < g % 3), k) for g in range(6) for k in range(9)]
    df = models.with_sides(spark.createDataFrame(data, "g int, s double, y int, id int"), ["g"], "y")
    got = {(r.g, r.id): (round(r._pull, 9), round(r._weight, 9)) for r in models.margin_gradients(df, ["g"], "s", "y", max_rows=max_rows).collect()}
    want = {}
    for g, s, y, k in data:
        other = [t for h, t, z, _ in data if h == g and z != y]
        own = sum(1 for h, _, z, _ in data if h == g and z == y)
        if other:
            pull = sum(t > s - 1 for t in other) if y else -sum(t < s + 1 for t in other)
            want[g, k] = (round(pull / len(other), 9), round(1 / own, 9))
    assert got == want


def test_boosting_stops_on_the_held_rows(spark):
    rng = random.Random(1)
    data = [(float(x := rng.random()), int(x + rng.gauss(0, 0.3) > 0.5), k % 4 == 0) for k in range(400)]
    df = models.class_weights(spark.createDataFrame(data, "x double, y int, held boolean"), "y")
    stages = models.feature_stages(df.select("x"), exclude=(), scale=False)
    model = models.fit(df, stages, models.boosted(rounds=60, depth=3, held="held"))
    assert 1 <= model.stages[-1].getNumTrees < 60
    assert models.fit_side_by_side([lambda: 1, lambda: 2, lambda: 3], most=2) == [1, 2, 3]


def test_scan_groups_carries_state_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(6)
        data = [(rng.choice(["a", "b", None, "c"]), k, rng.randint(-5, 9)) for k in range(500)]
        df = spark.createDataFrame(data, "k string, t int, v int").repartition(5)

        def step(state, part):
            seen = []
            for v in part["v"]:
                state = max(0, min(20, state + v))
                seen.append(state)
            return state, pd.DataFrame({"k": part["k"], "t": part["t"], "load": seen})

        def finish(key, state):
            return pd.DataFrame([(key[0], -1, state)], columns=["k", "t", "load"])

        got = rows(groups.scan_groups(df, ["k"], ["t"], lambda: 0, step, finish, "k string, t int, load int"), "k", "t", "load")
        want, loads = [], {}
        for k, t, v in data:
            loads[k] = max(0, min(20, loads.get(k, 0) + v))
            want.append((k, t, loads[k]))
        assert got == sorted(want + [(k, -1, v) for k, v in loads.items()], key=repr)
        assert groups.scan_groups(df.limit(0), ["k"], ["t"], lambda: 0, step, finish, "k string, t int, load int").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_group_perceptron_ranks_by_a_planted_rule(spark):
    df = planted(spark).cache()
    centred = df.withColumns({"x": (F.col("x") - 5) / 3, "z": F.col("z") - 0.5})
    train, test = centred.where("season < 3"), centred.where("season = 3")
    model = models.fit_group_perceptron(train, ["season", "g"], ["x", "z"], hidden=(32, 16), epochs=20, step=0.02)
    begin = models.fit_group_perceptron(train, ["season", "g"], ["x", "z"], hidden=(32, 16), epochs=0)
    assert len(model.losses) == 21 and min(model.losses) < 0.5 * model.losses[0] and begin.losses == model.losses[:1]
    loss = [ranking.margin_loss(m.score(train), ["season", "g"]).first()["margin_loss"] for m in (begin, model)]
    assert loss[1] < 0.5 * loss[0]
    rate = ranking.hit_rates(model.score(test), ["season", "g"], "id", (1,)).first()["top_1_hit_rate"]
    linear = models.linear_score(test, models.fit_pairwise(train, ["season", "g"], ["x", "z"]))
    assert rate > ranking.hit_rates(linear, ["season", "g"], "id", (1,)).first()["top_1_hit_rate"] + 0.2


def test_perceptron_gradient_by_differences():
    rng = np.random.default_rng(1)
    layers = [(rng.normal(size=(3, 5)), rng.normal(size=5)), (rng.normal(size=(5, 4)), rng.normal(size=4)), (rng.normal(size=(4, 1)), rng.normal(size=1))]
    x, pull = rng.normal(size=(20, 3)), rng.normal(size=20)
    got, at = models._gradient(layers, x, pull), 0
    for layer in layers:
        for part in layer:
            for k in range(part.size):
                spots, old = part.reshape(-1), part.reshape(-1)[k]
                ends = []
                for shift in (1e-6, -1e-6):
                    spots[k] = old + shift
                    ends.append(-(pull * models._forward(layers, x)[-1][:, 0]).sum())
                spots[k] = old
                assert got[at] == pytest.approx((ends[0] - ends[1]) / 2e-6, rel=1e-4, abs=1e-6)
                at += 1
    assert at == len(got)


def test_group_perceptron_on_odd_tables(spark):
    schema = "g int, x double, y int"
    one_sided = spark.createDataFrame([(1, 0.5, 1), (2, 0.1, 0), (2, None, 0)], schema)
    for df in (one_sided, one_sided.limit(0)):
        model = models.fit_group_perceptron(df, ["g"], ["x"], hidden=(4,), epochs=2)
        assert model.losses == [0.0]
    scores = {r.x: r.score for r in model.score(one_sided).collect()}
    assert len(scores) == 3 and all(v is not None for v in scores.values())
    # A hot group and a cut into chunks give the same weights.
    hot = spark.createDataFrame([(int(k % 3 == 0), float(k % 17), int(k % 40 == 0)) for k in range(400)], schema)
    a, b = (models.fit_group_perceptron(hot, ["g"], ["x"], hidden=(4,), epochs=2, max_rows=m) for m in (1000, 50))
    assert a.losses == pytest.approx(b.losses)
