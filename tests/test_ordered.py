"""Ordered operators: large groups cut into chunks give the results of the plain windows."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from laurel.operators import ordered, rollup
from laurel.operators.ordered import OrderedGroups, Prefix


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, some rows without a key."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = 0 if i % 3 == 0 else (None if i % 17 == 0 else rng.randint(1, 40))
        data.append((key, i // 60, rng.randint(0, 5), i, rng.randint(0, 1), rng.randint(-5, 9)))
    return spark.createDataFrame(data, "k int, wk int, d int, id int, flag int, v int")


def both_ways(skewed, build, *columns):
    plain = build(OrderedGroups(skewed, ["k"], ["wk", "d", "id"], max_rows=10_000))
    cut = build(OrderedGroups(skewed, ["k"], ["wk", "d", "id"], max_rows=30))
    assert not plain.chunked and cut.chunked
    assert rows(plain.result(), "id", *columns) == rows(cut.result(), "id", *columns)
    return cut.result()


def test_sums_counts_and_maxima(skewed):
    both_ways(
        skewed,
        lambda g: g.add(
            Prefix("n", "count"),
            Prefix("s", "sum", F.col("v")),
            Prefix("m", "max", F.col("v")),
            Prefix("rank", "count", current=True),
            Prefix("upto", "sum", F.col("v"), current=True),
        ),
        "n", "s", "m", "rank", "upto",
    )


def test_reset_within_group(skewed):
    both_ways(
        skewed,
        lambda g: g.add(Prefix("n", "count"), Prefix("s", "sum", F.col("v")), reset=["wk"]),
        "n", "s",
    )


def test_streaks(skewed):
    result = both_ways(skewed, lambda g: g.add_streaks({"streak": "flag"}), "streak")
    groups = {}
    for r in result.collect():
        groups.setdefault(r.k, []).append(r)
    for group in groups.values():
        run = 0
        for r in sorted(group, key=lambda r: (r.wk, r.d, r.id)):
            assert r.streak == run
            run = run + 1 if r.flag else 0


def test_rank_over_the_whole_table(skewed):
    order = [F.desc("v"), F.asc("id")]
    plain = ordered.rank_rows(skewed, [], order, max_rows=10_000)
    cut = ordered.rank_rows(skewed, [], order, max_rows=50)
    assert rows(plain, "id", "rank") == rows(cut, "id", "rank")
    assert sorted(r.rank for r in cut.collect()) == list(range(1, 601))


def test_running_average(skewed):
    plain = ordered.running_average(skewed, ["k"], ["wk", "d", "id"], "v", "a")
    cut = ordered.running_average(skewed, ["k"], ["wk", "d", "id"], "v", "a", max_rows=30)
    assert rows(plain, "id", "a") == rows(cut, "id", "a")


def test_history_stats(skewed):
    plain = ordered.history_stats(skewed, ["k"], ["wk", "d", "id"], ["v"])
    cut = ordered.history_stats(skewed, ["k"], ["wk", "d", "id"], ["v"], max_rows=30)
    for a, b in zip(plain.orderBy("id").collect(), cut.orderBy("id").collect()):
        assert a.v_mean_season == (None if b.v_mean_season is None else pytest.approx(b.v_mean_season))
        assert a.v_std_season == (None if b.v_std_season is None else pytest.approx(b.v_std_season, abs=1e-9))


@pytest.mark.parametrize("max_rows", [None, 3])
def test_history_deviation_of_large_values(spark, max_rows):
    """Values near 1e9 with a spread of a few: the deviation does not depend on how the group is cut."""
    values = [1e9 + (i * 7) % 5 for i in range(40)]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k int, id int, v double")
    got = ordered.history_stats(df, ["k"], ["id"], ["v"], max_rows=max_rows).orderBy("id").collect()
    assert got[0].v_mean_season is None and got[0].v_std_season is None
    for i in range(1, 40):
        assert got[i].v_mean_season == pytest.approx(np.mean(values[:i]), abs=1e-6)
        assert got[i].v_std_season == pytest.approx(np.std(values[:i]), abs=1e-6)


def test_group_numbers_are_dense_and_keep_rows(skewed):
    numbered = ordered.number_groups(skewed, ["k", "wk"])
    assert numbered.count() == skewed.count()
    found = {r.group_id for r in numbered.collect()}
    assert found == set(range(len(found)))


@pytest.mark.parametrize("max_rows", [100_000, 3])
def test_percentiles_match_linear_interpolation(spark, max_rows):
    import numpy as np

    rng = random.Random(3)
    data = [(g, rng.randint(0, 20) / 2) for g in ("a", "b", "b", "b") for _ in range(40)] + [("c", 4.0), ("c", None)]
    df = spark.createDataFrame(data, "g string, x double")
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.p): r.value for r in rollup.percentiles(df, ["g"], "x", ps, max_rows).collect()}
    for g in "abc":
        values = [x for k, x in data if k == g and x is not None]
        for p in ps:
            assert got[g, p] == pytest.approx(np.percentile(values, 100 * p))
    whole = {r.p: r.value for r in rollup.percentiles(df, [], "x", ps, max_rows).collect()}
    for p in ps:
        assert whole[p] == pytest.approx(np.percentile([x for _, x in data if x is not None], 100 * p))


def test_members_are_one_row_per_group(spark):
    df = spark.createDataFrame([(1, i % 25) for i in range(100)] + [(2, 5), (3, None)], "g int, m int")
    got = {r.g: (r.members, r["size"]) for r in rollup.members(df, ["g"], "m").collect()}
    assert got[1] == (list(range(25)), 25) and got[2] == ([5], 1)
    asked = rollup.membership(df, ["g"], "m", {"has_7": (7,), "any_of": (5, 99)}).collect()
    assert sorted(map(tuple, asked)) == [(1, 25, True, True), (2, 1, False, True), (3, 0, False, False)]


def test_cut_plans_grow_with_the_prefixes_only(skewed):
    """A forced cut reads its stored rows as often after five passes as after one."""
    def reads(passes):
        groups = OrderedGroups(skewed, ["k"], ["wk", "d", "id"], max_rows=30)
        for i in range(passes):
            groups.add(Prefix(f"p{i}", "sum", F.col("v")))
        assert groups.chunked
        return groups.hot._jdf.queryExecution().optimizedPlan().toString().count("Relation")

    assert reads(5) == reads(1) == 2


def test_tables_without_keys_are_ranked_in_ranges(spark):
    rows_in = spark.range(5000).withColumn("v", F.col("id") * 37 % 5000)
    groups = OrderedGroups(rows_in, [], ["v"])
    assert groups.chunked and groups.df is None
    got = groups.add(Prefix("rank", "count", current=True)).result()
    assert got.where("rank <> v + 1").count() == 0 and got.count() == 5000
    empty = ordered.rank_rows(rows_in.where("id < 0"), [], ["v"])
    assert empty.count() == 0


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_percentiles_from_brackets(spark, accuracy):
    """Many, few, equal, null and odd values; brackets that hold little of a group, and a third of it under one key."""
    import numpy as np

    rng = random.Random(5)
    data = [("a", rng.gauss(0, 1)) for _ in range(3000)] + [("b", float(rng.randint(0, 3))) for _ in range(2000)]
    data += [(None, rng.random()) for _ in range(700)] + [("c", 1.0), ("c", 2.0), ("d", None), ("a", float("nan"))]
    data += [("e", float("inf")), ("e", 1.0), ("f", -0.0)]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    ps = [0.0, 0.001, 0.2, 0.5, 0.77, 1.0]
    got = {(r.g, r.p): r.value for r in rollup.percentiles(df, ["g"], "x", ps, accuracy=accuracy).collect()}
    groups = ["a", "b", "c", "e", "f", None]
    assert set(got) == {(g, p) for g in groups for p in ps}
    for g in ["a", "b", "c", "f", None]:
        values = [x for k, x in data if k == g and x == x]
        for p in ps:
            assert got[g, p] == pytest.approx(np.percentile(values, 100 * p)), (g, p)
    assert (got["e", 0.0], got["e", 0.5], got["e", 1.0]) == (1.0, float("inf"), float("inf"))
    none = df.where("g = 'd'")
    assert rollup.percentiles(none, ["g"], "x", ps).count() == rollup.percentiles(none, [], "x", ps).count() == 0
    whole = {r.p: r.value for r in rollup.percentiles(df.where("g <> 'e'"), [], "x", ps, accuracy=accuracy).collect()}
    values = [x for k, x in data if k not in (None, "e") and x is not None and x == x]
    for p in ps:
        assert whole[p] == pytest.approx(np.percentile(values, 100 * p))


def test_percentiles_order_only_what_lies_in_brackets(spark, monkeypatch):
    seen = []
    plain = rollup.OrderedGroups
    monkeypatch.setattr(rollup, "OrderedGroups", lambda df, *a: seen.append(df.count()) or plain(df, *a))
    df = spark.range(100_000).selectExpr("id % 2 as g", "cast(id * 7919 % 100003 as double) as x")
    rollup.percentiles(df, ["g"], "x", [0.25, 0.5, 0.75], accuracy=1000).collect()
    assert seen[0] <= 2 * 3 * (5 * 100_000 / 2 / 1000 + 2)
