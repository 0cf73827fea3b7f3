"""Team history: hand-worked seasons and the invariants of leakage-free features."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from laurel.plans.history import team_game_history, team_rows

SCHEMA = (
    "gameid int, gamedate date, hometeamname string, hometeamid int, awayteamname string, awayteamid int, "
    "homescore int, awayscore int, winner int"
)


def game(i, day, home, away, winner):
    return (i, dt.date.fromisoformat(day), f"T{home}", home, f"T{away}", away, 100, 90, winner)


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame(
        [
            game(1, "2020-12-28", 1, 2, 1),  # team 1: home win
            game(2, "2020-12-30", 2, 1, 1),  # away win
            game(3, "2021-01-02", 1, 2, 2),  # home loss, same ISO week, other calendar year
            game(4, "2021-01-05", 1, 3, 1),  # home win
            game(5, "2021-01-07", 1, 2, 1),  # home win
            game(6, "2021-10-20", 1, 2, 2),  # next season
        ],
        SCHEMA,
    )


def of_team(history, team, *columns):
    return [tuple(r) for r in history.where(F.col("teamid") == team).orderBy("gamedate").select(*columns).collect()]


def test_two_rows_per_game(games):
    assert team_rows(games).count() == 2 * games.count()


def test_hand_worked_team(games):
    history = team_game_history(games)
    got = of_team(history, 1, "wins_prior", "losses_prior", "win_streak_prior", "home_win_streak_prior", "season")
    assert got == [
        (0, 0, 0, 0, 2020),
        (1, 0, 1, 1, 2020),
        (2, 0, 2, 0, 2020),  # the away win ends the home streak
        (2, 1, 0, 0, 2020),
        (3, 1, 1, 1, 2020),
        (0, 0, 0, 0, 2021),
    ]


def test_week_record_spans_new_year(games):
    got = of_team(team_game_history(games), 1, "week_record_prior")
    assert [r[0] for r in got] == ["0-0", "1-0", "2-0", "0-0", "1-0", "0-0"]


def test_unknown_opponent_strength(games):
    rows_ = of_team(team_game_history(games), 1, "gameid", "opp_winrate_prior", "is_win_vs_over_500")
    # Game 4: team 3 has no games yet, so the rate is the default and the flag stays 0.
    assert rows_[3] == (4, 0.5, 0)
    raw = of_team(team_game_history(games, default_winrate=None), 1, "gameid", "opp_winrate_prior")
    assert raw[3] == (4, None)


def test_invariants(games):
    h = team_game_history(games)
    assert h.where("wins_prior + losses_prior <> games_prior").isEmpty()
    assert h.where("home_games_prior + away_games_prior <> games_prior").isEmpty()
    assert h.where("win_streak_prior > wins_prior").isEmpty()
    assert h.where("games_prior = 0 and (wins_prior > 0 or win_streak_prior > 0)").isEmpty()


def test_later_games_change_nothing(games):
    columns = [c for c in team_game_history(games).columns if c != "opponent"]
    full = team_game_history(games).where("gamedate < '2021-01-04'")
    cut = team_game_history(games.where("gamedate < '2021-01-04'"))
    assert rows(full, *columns) == rows(cut, *columns)


def test_chunked_history_equals_plain(games):
    columns = team_game_history(games).columns
    assert rows(team_game_history(games), *columns) == rows(team_game_history(games, max_rows=2), *columns)


def test_filter_is_taken_before_the_records(games):
    got = of_team(team_game_history(games, where="gamedate >= '2021-01-01'"), 1, "gameid", "wins_prior", "losses_prior")
    assert got == [(3, 0, 0), (4, 0, 1), (5, 1, 1), (6, 0, 0)]
