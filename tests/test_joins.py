"""Joins keep rows, pick one dimension row, and honour priorities and gaps."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from laurel.operators import cleaning, entities, joins
from laurel.plans import features


def day(text):
    return dt.date.fromisoformat(text)


def test_dimension_with_two_rows_per_key_does_not_multiply(spark):
    facts = spark.createDataFrame([(1, "Hornets"), (2, "Nets"), (3, "Unknown")], "id int, team string")
    dim = spark.createDataFrame(
        [("Hornets", "East"), ("Hornets", "West"), ("Nets", "East"), ("Nets", "East")], "team string, conference string"
    )
    got = joins.dimension_join(facts, dim, ["team"])
    assert rows(got, "id", "conference") == [(1, "East"), (2, "East"), (3, None)]


def test_salted_join_equals_join(spark):
    facts = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(200)], "id int, k int")
    other = spark.createDataFrame([(k, f"v{k}") for k in range(0, 100, 2)], "k int, v string")
    for how in ("inner", "left"):
        plain = facts.join(other, ["k"], how)
        salted = joins.salted_join(facts, other, ["k"], how, salts=5)
        assert rows(plain, "id", "v") == rows(salted, "id", "v")


def test_interval_overlap_takes_the_first_rule_and_a_gap_gives_null(spark):
    df = spark.createDataFrame([(1, day("1998-03-01")), (2, day("1999-07-15")), (3, day("1997-12-01"))], "id int, d date")
    rules = spark.createDataFrame(
        [(1, day("1998-02-05"), day("1999-06-25"), 1998), (2, day("1997-10-31"), day("1998-06-14"), 1997)],
        "priority int, lo date, hi date, season int",
    )
    got = joins.interval_join(df, rules, "d", "lo", "hi", "season", "priority")
    assert rows(got, "id", "season") == [(1, 1998), (2, None), (3, 1997)]


def test_open_and_reversed_intervals(spark):
    df = spark.createDataFrame([(1, day("1998-03-01")), (2, day("1999-07-15")), (3, day("1997-12-01"))], "id int, d date")
    rules = spark.createDataFrame(
        [(1, day("1999-01-01"), None, 1), (2, day("1998-06-14"), day("1998-01-01"), 2), (3, None, day("1997-12-31"), 3)],
        "priority int, lo date, hi date, season int",
    )
    got = joins.interval_join(df, rules, "d", "lo", "hi", "season", "priority")
    assert rows(got, "id", "season") == [(1, None), (2, 1), (3, 3)]


def test_previous_season_needs_a_next_one(spark):
    df = spark.createDataFrame([(1, 2000, 1), (1, 2001, 0), (2, 2000, 1), (2, 2002, 1)], "player int, season int, star int")
    got = joins.previous_season(df, "player", "season", ["star"])
    assert rows(got, "player", "season", "star_last_season") == [(1, 2001, 1)]


def test_tied_award_labels_both_and_keeps_rows(spark):
    box = spark.createDataFrame([(1, 10, 5, day("2021-01-04")), (1, 11, 5, day("2021-01-04")), (1, 12, 6, day("2021-01-04"))],
                                "gameid int, player_id int, teamid int, week_start date")
    awards = spark.createDataFrame([(10, "E", day("2021-01-04")), (11, "E", day("2021-01-04"))],
                                   "player_id int, conference string, week_start date")
    conferences = spark.createDataFrame([(5, "E"), (6, "W")], "teamid int, conference string")
    got = features.label_winners(box, awards, conferences)
    # Team 6 plays in a conference without an award that week.
    assert rows(got, "player_id", "won_award") == [(10, 1), (11, 1)]


def test_placeholders_fill_every_open_week(spark):
    awards = spark.createDataFrame(
        [(1, "E", day("2021-01-04"), day("2021-01-11")), (2, "W", day("2021-01-04"), day("2021-01-11"))],
        "player_id bigint, conference string, week_start date, date date",
    )
    late = features.placeholder_awards(awards, "2021-01-26").where("player_id is null")
    assert rows(late, "conference", "date") == [
        (c, d) for c in "EW" for d in (day("2021-01-18"), day("2021-01-25"), day("2021-02-01"))
    ]
    early = features.placeholder_awards(awards, "2021-01-12").where("player_id is null")
    assert rows(early, "date") == [(day("2021-01-18"),)] * 2


def test_resolution_order_and_unknown_names(spark):
    df = spark.createDataFrame([(1, "Nikola Đurišić"), (2, "Fat Lever"), (3, "Nobody"), (4, None), (5, "Old Name")], "id int, name string")
    aliases = spark.createDataFrame(
        [("Fat Lever", "Lafayette Lever", 99), ("Old Name", "New Name", 7), ("Older Name", "New Name", 7)],
        "alias string, canonical string, id int",
    )
    lookup = spark.createDataFrame([(77, "Nikola Durisic"), (55, "Lafayette Lever")], "player_id int, player_name string")
    got = entities.resolve_entities(df, "name", aliases, lookup)
    assert rows(got, "id", "player_id", "player_name") == [
        (1, 77, "Nikola Durisic"), (2, 55, "Lafayette Lever"), (3, None, "Nobody"), (4, None, None), (5, 7, "New Name"),
    ]


def test_zero_variance_and_first_week(spark):
    weekly = spark.createDataFrame(
        [(1, 2020, w, 1, 20, 5, 3) for w in range(3)], "player_id int, season int, week_start int, teamid int, points int, assists int, plus_minus int"
    )
    got = features.breakout(weekly)
    assert rows(got, "week_start", "z_points", "breakout_score") == [(1, 0.0, 0.0), (2, 0.0, 0.0)]


def test_mean_fill_and_null_profile(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "id int, x double")
    assert rows(cleaning.fill_with_mean(df, ["x"]), "id", "x") == [(1, 2.0), (2, 3.0), (3, 4.0)]
    assert cleaning.null_profile(df).first().asDict() == {"id_nulls": 0, "x_nulls": 1, "rows_with_null": 1}


def test_one_hot_aligns_to_the_training_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, "new"), (3, None)], "id int, c string")
    got = cleaning.one_hot(df, {"c": ["a", "b"]})
    assert got.columns == ["id", "c_a", "c_b"]
    assert rows(got, "id", "c_a", "c_b") == [(1, 1, 0), (2, 0, 0), (3, 0, 0)]
