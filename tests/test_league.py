"""The published tables from small raw feeds, checked against a plain Python account."""

import datetime as dt
import random
from collections import defaultdict
from statistics import fmean, pstdev

import pytest

from laurel.plans import features, league, league_values as v

TEAMS = {"Celtics": (1, "Boston Celtics", "East"), "Bulls": (2, "Chicago Bulls", "East"),
         "Lakers": (3, "Los Angeles Lakers", "West"), "Jazz": (4, "Utah Jazz", "West")}
START = dt.date(2021, 11, 1)  # a Monday
WEEKS = 5


def feeds():
    rng = random.Random(1)
    games, box, awards = [], [], []
    gid = 0
    for week in range(WEEKS):
        for day, home, away in ((0, "Celtics", "Lakers"), (0, "Bulls", "Jazz"), (2, "Lakers", "Bulls"), (4, "Jazz", "Celtics"), (5, "Celtics", "Bulls")):
            gid += 1
            date = START + dt.timedelta(days=7 * week + day)
            hs, as_ = rng.sample(range(80, 130), 2)
            winner = TEAMS[home if hs > as_ else away][0]
            games.append({"gameId": gid, "gameDateTimeEst": f"{date} 19:00:00", "hometeamName": home, "hometeamId": TEAMS[home][0],
                          "awayteamName": away, "awayteamId": TEAMS[away][0], "homeScore": hs, "awayScore": as_,
                          "winner": winner, "gameType": "Regular Season"})
            for team, other in ((home, away), (away, home)):
                for n in (1, 2):
                    made = rng.randint(0, 10)
                    box.append({"firstName": f"P{n}", "lastName": team, "personId": float(10 * TEAMS[team][0] + n), "gameId": gid,
                                "gameDateTimeEst": f"{date} 19:00:00", "playerteamName": team, "opponentteamName": other,
                                "win": int(TEAMS[team][0] == winner), "numMinutes": 30.0, "points": float(rng.randint(0, 40)),
                                "assists": float(rng.randint(0, 12)), "plusMinusPoints": float(rng.randint(-20, 20)),
                                "fieldGoalsMade": float(made), "fieldGoalsAttempted": 10.0, "threePointersAttempted": 0.0,
                                **{c: 0.0 for c in ("threePointersMade", "freeThrowsMade", "freeThrowsAttempted", "blocks", "steals",
                                                    "reboundsTotal", "reboundsDefensive", "reboundsOffensive", "turnovers", "foulsPersonal")}})
        monday = START + dt.timedelta(days=7 * (week + 1))
        awards.append({"player_id": 11, "player": "P1 Celtics", "date": monday, "team": "Boston Celtics"})
        awards.append({"player_id": 42, "player": "P2 Jazz", "date": monday, "team": "Utah Jazz"})
    # Did not play, and no player: both vanish.
    box.append({**box[0], "personId": 19.0, "numMinutes": None})
    box.append({**box[0], "personId": None})
    return games, box, awards


def frame(spark, rows, schema):
    from pyspark.sql.types import _parse_datatype_string

    fields = _parse_datatype_string(schema)
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], fields)


@pytest.fixture(scope="module")
def tables(spark):
    games, box, awards = feeds()
    lists = league.clean_honours(
        spark.createDataFrame([(11, 2022)], "player_id int, `Selection Year` int"),
        *[spark.createDataFrame([(i, "2021-22")], "player_id int, Season string") for i in (11, 11, 31, 99)],
    )
    played = (
        league.clean_games(frame(spark, games, v.GAMES_SCHEMA)),
        league.clean_player_statistics(frame(spark, box, v.PLAYER_STATISTICS_SCHEMA)),
    )
    rows = league.game_table(
        *played,
        league.clean_awards(frame(spark, awards, v.AWARDS_SCHEMA), spark),
        lists,
        extended=True,
    ).cache()
    weekly = league.weekly_table(rows, lists, extended=True, played=played).cache()
    return games, box, rows, weekly


def by_week(box):
    weeks = defaultdict(list)
    for r in box:
        if r["personId"] is not None and r["numMinutes"] is not None:
            day = dt.date.fromisoformat(r["gameDateTimeEst"][:10])
            weeks[int(r["personId"]), day - dt.timedelta(days=day.weekday())].append(r)
    return weeks


def running_rates(box, team):
    """Win rate of a team after each of its games, by week."""
    won = {(r["gameDateTimeEst"], r["gameId"]): r["win"] for r in box if r["playerteamName"] == team}
    rates = defaultdict(list)
    for n, (date, game) in enumerate(sorted(won), start=1):
        day = dt.date.fromisoformat(date[:10])
        wins = sum(w for key, w in won.items() if key <= (date, game))
        rates[day - dt.timedelta(days=day.weekday())].append(wins / n)
    return rates


def test_game_rows(tables):
    _, box, rows, _ = tables
    expected = {(r["personId"], r["gameId"]): r for k, rs in by_week(box).items() for r in rs if k[1] != START}
    got = rows.collect()
    assert len(got) == len(expected)
    for r in got:
        source = expected[r.player_id, r.gameid]
        assert r.points == source["points"] and r.season == 2021
        assert r.won_player_of_the_week == int(r.player_id in (11, 42))
        assert r.opponent_has_all_nba == int(source["opponentteamName"] in ("Celtics", "Lakers"))
        assert r.win == source["win"]
        week = by_week(box)[r.player_id, r.week_start]
        assert r.wins == sum(g["win"] for g in week)
        assert r.all_nba_first_team_last_season == 0  # no earlier season


def test_published_columns(tables):
    _, _, rows, weekly = tables
    wanted = {
        "day", "week", "month", "year", "pow_player_id", "player_of_the_week", "pow_conference", "gms", "min_sum",
        "pts_sum", "ast_sum", "pm_mean", "team_pts", "team_gms", "pts_sum_mean_season", "pm_sum_std_season",
        "all_star_this_season", "wins", "all_nba_third_team_last_season", "wins_vs_team_with_all_nba_player", "record_prior", "opp_winrate_prior",
    }
    assert wanted <= set(rows.columns)
    wanted = {
        "team", "games_played_this_week", "wins_this_week", "avg_opp_score", "avg_opp_winrate_prior", "breakout_score",
        "z_pts", "z_pm", "z_s_ast", "freeThrowsPercentage", "games_w_points_between_10_19", "games_w_blocks_15_plus",
        "mvp_last_season", "all_star_last_season", "all_nba_second_team_last_season",
    }
    assert wanted <= set(weekly.columns)


def test_weekly_rows(tables):
    _, box, _, weekly = tables
    weeks = by_week(box)
    got = {(r.player_id, r.week_start): r for r in weekly.collect()}
    players = {p for p, _ in weeks}
    # The game rows lose each player's first week, the weekly scores the next one.
    later = [START + dt.timedelta(days=7 * w) for w in range(2, WEEKS)]
    assert set(got) == {(p, w) for p in players for w in later}
    for (player, week), r in got.items():
        games = weeks[player, week]
        assert r.games_played_this_week == len(games)
        assert r.points == sum(g["points"] for g in games)
        assert r.fieldGoalsPercentage == pytest.approx(sum(g["fieldGoalsMade"] for g in games) / (10 * len(games)))
        assert r.threePointersPercentage == 0
        assert r.games_w_points_between_10_19 == sum(10 <= g["points"] <= 19 for g in games)
        team = [g for (p, w), gs in weeks.items() if w == week and p // 10 == player // 10 for g in gs]
        assert r.team_pts == sum(g["points"] for g in team)
        earlier = [
            sum(g["points"] for g in weeks[player, w])
            for w in (START + dt.timedelta(days=7 * i) for i in range(1, WEEKS))
            if w < week
        ]
        sd = pstdev(earlier)
        z = (r.points - fmean(earlier)) / sd if sd > 0 else 0.0
        assert r.z_pts == pytest.approx(z)
        assert r.z_s_pts == 0  # no earlier season
        rates = running_rates(box, r.team)[week]
        assert r.avg_full_season_win_pct_this_week == pytest.approx(fmean(rates))
        assert r.full_season_win_pct_max_minus_min_this_week == pytest.approx(max(rates) - min(rates))


def test_placeholder_awards_open_the_next_week(spark):
    _, _, awards = feeds()
    clean = league.clean_awards(frame(spark, awards, v.AWARDS_SCHEMA), spark).select(
        "player_id", "conference", "week_start", "date"
    )
    opened = features.placeholder_awards(clean, str(START + dt.timedelta(days=7 * WEEKS + 2)))
    assert opened.where("player_id is null").count() == 2


def test_training_matrix(tables):
    *_, weekly = tables
    matrix, values = league.training_matrix(weekly.where("team <> 'Jazz'"))
    again, _ = league.training_matrix(weekly, values)
    assert matrix.columns == again.columns
    assert "team_Celtics" in matrix.columns and "player_id" not in matrix.columns
    assert "team_Jazz" not in matrix.columns


def test_award_list(spark):
    rows = spark.createDataFrame(
        [("2023-24", "January", "Jan 8", "E", "Fat Lever", 0), ("2023-24", "November", "Nov 27", "W", "Tim Hardaway Jr.", 1)],
        "season string, month string, date string, conference string, player string, tie int",
    )
    got = [tuple(r) for r in league.award_list(rows).select("date", "week", "player", "tie").orderBy("date").collect()]
    assert got == [(dt.date(2023, 11, 27), 48, "Tim Hardaway", 1), (dt.date(2024, 1, 8), 2, "Lafayette Lever", 0)]
