"""Box scores and award candidates from odd tables, and what their plans shuffle."""

import datetime

import pytest

from laurel.catalog import bindings, model_queries
from laurel.catalog.registry import Tables


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime.datetime
    orders = [(k, k % 3, day(2000, 6, 20) + datetime.timedelta(days=k)) for k in range(30)] + [(3, 0, day(2000, 6, 23)), (40, None, day(2000, 7, 1)), (41, 1, None)]
    lines = [(k % 31, 1 + k % 4, 1 + k % 3, float(k % 50), "N" if k % 2 else "R") for k in range(300)] + [(None, 1, 1, 5.0, "N"), (4, None, 1, 5.0, None), (5, 1, 1, None, "N")]
    made = {
        "nation": spark.createDataFrame([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        "customer": spark.createDataFrame([(0, 0), (1, 1), (1, 1), (2, None)], "c_custkey long, c_nationkey int"),
        "supplier": spark.createDataFrame([(1, 0), (2, 1), (2, 0), (3, 1)], "s_suppkey long, s_nationkey int"),
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string"),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_box_scores_count_every_match_once(tables):
    t = tables
    for name in ("lineitem", "orders", "customer", "supplier"):
        getattr(t, name).createOrReplaceTempView(name)
    want = t.spark.sql("""
        SELECT l_orderkey, l_suppkey, s_nationkey, c_nationkey, o_orderdate, n, q, k, made
        FROM (SELECT l_orderkey, l_suppkey, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS q, SUM(l_linenumber) AS k,
                     SUM(CAST(l_returnflag = 'N' AS INT)) AS made FROM lineitem GROUP BY 1, 2)
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""")
    got = bindings.box_from_lines(t)
    key = lambda r: tuple(map(str, r))
    have = got.select("gameid", "player_id", "teamid", "opponentid", "gamedate", "minutes", "points", "assists", "made").collect()
    expected = [(*r[:4], r[4].date() if r[4] else None, *r[5:]) for r in want.collect()]
    assert sorted(map(key, have)) == sorted(map(key, expected)) and len(have) > 100


def test_candidates_are_scanned_without_a_shuffle(tables):
    rows = model_queries.candidates(tables)
    assert "Exchange hashpartitioning" not in plan(rows)
    assert plan(bindings.box_from_lines(tables)).count("hashpartitioning(l_orderkey") == 1
    plain = bindings.player_weeks_from_box(tables)
    assert rows.count() == plain.join(bindings.conferences(tables), "teamid").count()
    # The weeks of the award list are the same from player-weeks, over the turn of a season too.
    weeks = bindings.scored_weeks_from_box(tables)
    fresh = bindings.box_from_lines(tables).groupBy("player_id", "teamid", "week_start").agg({"points": "sum"})
    assert {(r.player_id, r.teamid, r.week_start, r.points) for r in weeks.collect()} == {(r[0], r[1], r[2], r[3]) for r in fresh.collect()}
