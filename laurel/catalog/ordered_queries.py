"""Checked queries of the ordered operators (WIN) and of sort and top-k (SRT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from laurel.catalog import bindings as b
from laurel.catalog.bindings import oracle
from laurel.catalog.registry import Tables, query
from laurel.operators import ordered
from laurel.operators.ordered import Prefix
from laurel.operators.ranking import top_candidates
from laurel.plans.history import (
    ORDER,
    season_groups,
    team_game_history,
    team_rows,
    with_flags,
)

TEAM_SEASON = ["teamid", "season"]


def flagged(t: Tables):
    return with_flags(team_rows(b.games_table(t)))


@query("win_1", oracle("SELECT gameid, teamid, games_prior FROM priors"))
def win_1(t):
    return ordered.prior_count(flagged(t), TEAM_SEASON, ORDER).select(
        "gameid", "teamid", "games_prior"
    )


@query(
    "win_2",
    oracle(
        "SELECT gameid, teamid, wins_prior, home_games_prior, home_wins_prior, away_wins_prior FROM priors"
    ),
)
def win_2(t):
    sums = {
        "wins_prior": "is_win",
        "home_games_prior": "home",
        "home_wins_prior": "is_home_win",
        "away_wins_prior": "is_away_win",
    }
    return ordered.prior_sum(flagged(t), TEAM_SEASON, ORDER, sums).select("gameid", "teamid", *sums)


@query("win_3", oracle("SELECT gameid, teamid, week_games_prior, week_wins_prior FROM priors"))
def win_3(t):
    groups = season_groups(flagged(t)).add(
        Prefix("week_games_prior", "count"),
        Prefix("week_wins_prior", "sum", F.col("is_win")),
        reset=["week_start"],
    )
    return groups.result().select("gameid", "teamid", "week_games_prior", "week_wins_prior")


@query(
    "win_4",
    oracle("""
SELECT gameid, teamid, games_prior - wins_prior AS losses_prior,
       games_prior - home_games_prior AS away_games_prior,
       home_games_prior - home_wins_prior AS home_losses_prior,
       games_prior - home_games_prior - away_wins_prior AS away_losses_prior FROM priors"""),
)
def win_4(t):
    return team_game_history(b.games_table(t)).select(
        "gameid", "teamid", "losses_prior", "away_games_prior", "home_losses_prior", "away_losses_prior"
    )


@query("win_5", oracle("SELECT gameid, teamid, win_streak_prior FROM streaks"))
def win_5(t):
    return ordered.prior_streak(
        flagged(t), TEAM_SEASON, ORDER, {"win_streak_prior": "is_win"}
    ).select("gameid", "teamid", "win_streak_prior")


@query("win_6", oracle("SELECT gameid, teamid, home_win_streak_prior, away_win_streak_prior FROM streaks"))
def win_6(t):
    streaks = {"home_win_streak_prior": "is_home_win", "away_win_streak_prior": "is_away_win"}
    return ordered.prior_streak(flagged(t), TEAM_SEASON, ORDER, streaks).select(
        "gameid", "teamid", *streaks
    )


@query(
    "win_7",
    oracle("""
SELECT gameid, teamid, opp_wins_prior, opp_losses_prior, ROUND(opp_winrate_prior, 6) AS opp_winrate_prior,
       is_win_vs_over_500, wins_vs_over_500_prior FROM hist"""),
)
def win_7(t):
    return b.history(t).select(
        "gameid",
        "teamid",
        "opp_wins_prior",
        "opp_losses_prior",
        F.round("opp_winrate_prior", 6).alias("opp_winrate_prior"),
        "is_win_vs_over_500",
        "wins_vs_over_500_prior",
    )


HISTORY_SQL = """
SELECT player_id, teamid, season, week_start, {cols} FROM pw
WINDOW p AS (PARTITION BY player_id, season ORDER BY week_start, teamid
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def weekly_history(t):
    return ordered.history_stats(
        b.player_weeks(t), ["player_id", "season"], ["week_start", "teamid"], ["points", "assists"]
    )


@query(
    "win_8",
    oracle(
        HISTORY_SQL.format(
            cols="ROUND(AVG(points) OVER p, 6) AS points_mean_season, "
            "ROUND(AVG(assists) OVER p, 6) AS assists_mean_season"
        )
    ),
)
def win_8(t):
    return weekly_history(t).select(
        "player_id",
        "teamid",
        "season",
        "week_start",
        *[F.round(c, 6).alias(c) for c in ("points_mean_season", "assists_mean_season")],
    )


@query(
    "win_9",
    oracle(
        HISTORY_SQL.format(
            cols="ROUND(STDDEV_POP(points) OVER p, 6) AS points_std_season, "
            "ROUND(STDDEV_POP(assists) OVER p, 6) AS assists_std_season"
        )
    ),
)
def win_9(t):
    return weekly_history(t).select(
        "player_id",
        "teamid",
        "season",
        "week_start",
        *[F.round(c, 6).alias(c) for c in ("points_std_season", "assists_std_season")],
    )


RUNNING_SQL = """
SELECT gameid, teamid, season, week_start, AVG(is_win) OVER (PARTITION BY teamid, season
         ORDER BY gamedate, gameid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS win_pct
FROM flags"""


def running(t):
    return ordered.running_average(flagged(t), TEAM_SEASON, ORDER, "is_win", "win_pct")


@query(
    "win_10",
    oracle("SELECT gameid, teamid, ROUND(win_pct, 6) AS win_pct FROM runpct", runpct=RUNNING_SQL),
)
def win_10(t):
    return running(t).select("gameid", "teamid", F.round("win_pct", 6).alias("win_pct"))


@query(
    "win_11",
    oracle(
        """
SELECT teamid, season, week_start, ROUND(AVG(win_pct), 6) AS avg_pct,
       ROUND(MAX(win_pct) - MIN(win_pct), 6) AS spread FROM runpct GROUP BY teamid, season, week_start""",
        runpct=RUNNING_SQL,
    ),
)
def win_11(t):
    return (
        running(t)
        .groupBy(*TEAM_SEASON, "week_start")
        .agg(
            F.round(F.avg("win_pct"), 6).alias("avg_pct"),
            F.round(F.max("win_pct") - F.min("win_pct"), 6).alias("spread"),
        )
    )


RANKED_SQL = """
SELECT *, ROW_NUMBER() OVER (PARTITION BY week_start, conference ORDER BY score DESC, player_id) AS rank
FROM b9"""
GROUP = ["week_start", "conference"]


def by_score():
    return [F.col("score").desc(), F.col("player_id").asc()]


@query(
    "win_12",
    oracle(
        "SELECT week_start, conference, player_id, CAST(rank AS BIGINT) AS rank FROM ranked WHERE y = 1",
        ranked=RANKED_SQL,
    ),
)
def win_12(t):
    ranked = ordered.rank_rows(b.labelled_weeks(t), GROUP, by_score())
    return ranked.where("y = 1").select("week_start", "conference", "player_id", "rank")


@query(
    "win_13",
    oracle("""
SELECT player_id, season, gameid, teamid,
       CAST(COUNT(*) OVER s AS BIGINT) AS player_games_season_prior,
       CAST(COALESCE(SUM(win) OVER s, 0) AS BIGINT) AS player_wins_season_prior,
       CAST(COUNT(*) OVER w AS BIGINT) AS player_games_week_prior,
       CAST(COALESCE(SUM(win) OVER w, 0) AS BIGINT) AS player_wins_week_prior
FROM (SELECT CASE WHEN b2.player_id % 7 = 0 THEN NULL ELSE b2.player_id END AS player_id, b2.season,
             b2.week_start, b2.gamedate, b2.gameid, b2.teamid, b2.player_id AS raw_id, is_win AS win
      FROM b2 JOIN flags ON b2.gameid = flags.gameid AND b2.teamid = flags.teamid) q
WINDOW s AS (PARTITION BY player_id, season ORDER BY gamedate, gameid, raw_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       w AS (PARTITION BY player_id, season, week_start ORDER BY gamedate, gameid, raw_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
)
def win_13(t):
    rows = (
        b.box(t)
        .join(flagged(t).select("gameid", "teamid", F.col("is_win").alias("win")), ["gameid", "teamid"])
        .withColumn("raw_id", F.col("player_id"))
        .withColumn("player_id", F.when(F.col("player_id") % 7 != 0, F.col("player_id")))
    )
    groups = ordered.OrderedGroups(
        rows, ["player_id", "season"], ["week_start", "gamedate", "gameid", "raw_id"]
    )
    groups.add(
        Prefix("player_games_season_prior", "count"),
        Prefix("player_wins_season_prior", "sum", F.col("win")),
    ).add(
        Prefix("player_games_week_prior", "count"),
        Prefix("player_wins_week_prior", "sum", F.col("win")),
        reset=["week_start"],
    )
    return groups.result().select(
        "player_id",
        "season",
        "gameid",
        "teamid",
        "player_games_season_prior",
        "player_wins_season_prior",
        "player_games_week_prior",
        "player_wins_week_prior",
    )


@query(
    "win_14",
    oracle("""
SELECT player_id, week_start, conference,
       CAST(DENSE_RANK() OVER (ORDER BY week_start, conference) - 1 AS BIGINT) AS group_id FROM b9"""),
)
def win_14(t):
    rows = b.labelled_weeks(t).select("player_id", "week_start", "conference")
    return ordered.number_groups(rows, GROUP)


@query("win_15", oracle("SELECT player_id, conference, week_start, date FROM b3"))
def win_15(t):
    return b.awards_from_games(t)


@query(
    "srt_1",
    oracle("""
SELECT player_id, season, week_start, teamid, CAST(ROW_NUMBER() OVER
         (ORDER BY season DESC, points DESC, player_id, week_start, teamid) AS BIGINT) AS position FROM pw"""),
)
def srt_1(t):
    order = [F.desc("season"), F.desc("points"), "player_id", "week_start", "teamid"]
    # The position makes the order part of the result, as a sorted table has no order in a check.
    return ordered.rank_rows(b.player_weeks(t), [], order, "position").select(
        "player_id", "season", "week_start", "teamid", "position"
    )


@query(
    "srt_2",
    oracle("""
SELECT player_id, CAST(SUM(points) AS BIGINT) AS points FROM b2 GROUP BY player_id
ORDER BY points DESC, player_id LIMIT 30"""),
)
def srt_2(t):
    totals = b.box(t).groupBy("player_id").agg(F.sum("points").alias("points"))
    return totals.orderBy(F.desc("points"), "player_id").limit(30)


@query(
    "srt_3",
    oracle("""
SELECT player_id, teamid, week_start, points FROM pw
ORDER BY points DESC, player_id, week_start, teamid LIMIT 20"""),
)
def srt_3(t):
    weeks = b.player_weeks(t).select("player_id", "teamid", "week_start", "points")
    return weeks.orderBy(F.desc("points"), "player_id", "week_start", "teamid").limit(20)


@query(
    "srt_4",
    oracle(
        "SELECT week_start, conference, player_id, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10",
        ranked=RANKED_SQL,
    ),
)
def srt_4(t):
    return ordered.top_rows(b.labelled_weeks(t), GROUP, by_score(), 10).select(
        *GROUP, "player_id", "rank"
    )


@query(
    "srt_5",
    oracle(
        """
SELECT week_start, conference, CAST(rank AS INTEGER) AS rank, player_id, score, y FROM ranked
WHERE rank <= 5""",
        ranked=RANKED_SQL,
    ),
)
def srt_5(t):
    nested = top_candidates(b.labelled_weeks(t), GROUP, by_score(), ["player_id", "score", "y"], 5)
    return nested.select(*GROUP, F.inline("top"))
