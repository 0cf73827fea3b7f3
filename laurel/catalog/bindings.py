"""Bindings that give the generated test tables the shapes of FIXTURES.md part B.

`SQL` holds the same bindings as named CTEs for the DuckDB oracle; `oracle(...)` puts the needed ones
in front of a query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from laurel.catalog.registry import Tables
from laurel.functions import dates
from laurel.operators import ordered
from laurel.plans.history import GameColumns, team_game_history
from laurel.session import broadcast_checked, stored_copy as stored


def floor_mod_100(column):
    return F.floor(column).cast("bigint") % 100


def games(t: Tables) -> DataFrame:
    """B1, from the stored copy when the query has one."""
    return t.made("games") or games_from_orders(t)


def games_table(t: Tables) -> DataFrame:
    """B1 stored: for queries that scan the games more than once."""
    return t.once("games", lambda: stored(games_from_orders(t)))


def box(t: Tables) -> DataFrame:
    """B2, from the stored copy when the query has one."""
    return t.made("box") or box_from_lines(t)


def box_table(t: Tables) -> DataFrame:
    """B2 stored: for queries that scan the box scores more than once."""
    return t.once("box", lambda: stored(box_from_lines(t)))


def games_from_orders(t: Tables) -> DataFrame:
    """B1: one row per order; teams are nations."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("supp"), F.max("l_extendedprice").alias("px")
    )
    home = t.nation.select(
        F.col("n_nationkey").alias("hometeamid"), F.col("n_name").alias("hometeamname")
    )
    away = t.nation.select(
        F.col("n_nationkey").alias("awayteamid"), F.col("n_name").alias("awayteamname")
    )
    return (
        t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("supp") == F.col("s_suppkey"))
        .where("c_nationkey <> s_nationkey")
        .select(
            F.col("o_orderkey").alias("gameid"),
            F.col("o_orderdate").cast("date").alias("gamedate"),
            F.col("c_nationkey").alias("hometeamid"),
            F.col("s_nationkey").alias("awayteamid"),
            floor_mod_100(F.col("o_totalprice")).alias("homescore"),
            floor_mod_100(F.col("px")).alias("awayscore"),
        )
        .withColumn(
            "winner",
            F.when(F.col("homescore") >= F.col("awayscore"), F.col("hometeamid")).otherwise(
                F.col("awayteamid")
            ),
        )
        .join(home, "hometeamid")
        .join(away, "awayteamid")
    )


def box_from_lines(t: Tables) -> DataFrame:
    """B2: one row per (order, supplier); players are suppliers. Season and week are added."""
    lines = (
        t.lineitem.select(
            "l_orderkey", "l_suppkey", "l_quantity", "l_linenumber", (F.col("l_returnflag") == "N").cast("int").alias("made")
        )
        # Dealt by order alone, the lines are shuffled once for the sums and for the join.
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("minutes"),
            F.sum("l_quantity").cast("bigint").alias("points"),
            F.sum("l_linenumber").alias("assists"),
            F.sum("made").alias("made"),
        )
    )
    played = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderdate", "c_nationkey"
    )
    teams = broadcast_checked(t.supplier.select("s_suppkey", "s_nationkey"))
    return (
        lines.join(played, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(teams, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_orderkey").alias("gameid"),
            F.col("l_suppkey").alias("player_id"),
            F.col("o_orderdate").cast("date").alias("gamedate"),
            F.col("s_nationkey").alias("teamid"),
            F.col("c_nationkey").alias("opponentid"),
            "minutes",
            "points",
            "assists",
            (F.col("points") - 25 * F.col("minutes")).alias("plus_minus"),
            F.col("minutes").alias("attempted"),
            "made",
        )
        .withColumns(
            {
                "season": dates.season_of(F.col("gamedate")),
                "week_start": dates.week_start(F.col("gamedate")),
            }
        )
    )


def conferences(t: Tables) -> DataFrame:
    """Team → conference: nation → region."""
    return t.nation.select(
        F.col("n_nationkey").alias("teamid"), F.col("n_regionkey").alias("conference")
    )


def player_weeks(t: Tables) -> DataFrame:
    """Box scores rolled up per player, team and week, from the stored copy if there is one."""
    return t.made("player_weeks") or player_weeks_from_box(t)


def player_weeks_table(t: Tables) -> DataFrame:
    """Player-weeks stored: for queries that scan them more than once; the award list then comes from them too."""
    return t.once("player_weeks", lambda: stored(player_weeks_from_box(t)))


def player_weeks_from_box(t: Tables) -> DataFrame:
    return (
        box(t)
        .groupBy("player_id", "teamid", "season", "week_start")
        .agg(
            F.count(F.lit(1)).alias("games"),
            *[F.sum(c).alias(c) for c in ("minutes", "points", "assists", "plus_minus", "attempted", "made")],
        )
    )


def scored_weeks(t: Tables) -> DataFrame:
    """Weekly points per player inside (week, conference), from the stored copy if there is one."""
    return t.made("scored_weeks") or scored_weeks_from_box(t)


def scored_weeks_from_box(t: Tables) -> DataFrame:
    """A week of two seasons is one row here; sums over its player-weeks are those over its box scores."""
    return (
        (t.made("player_weeks") or box(t))
        .groupBy("player_id", "teamid", "week_start")
        .agg(F.sum("points").alias("points"), F.sum("assists").alias("assists"))
        .join(conferences(t), "teamid")
    )


def awards_from_games(t: Tables) -> DataFrame:
    """B3: best player per week and conference, dated the Monday after the week."""
    best = ordered.top_rows(
        scored_weeks(t), ["week_start", "conference"], [F.desc("points"), F.asc("player_id")], 1, "rn"
    )
    return best.select(
        "player_id", "conference", "week_start", F.date_add("week_start", 7).alias("date")
    )


def awards(t: Tables) -> DataFrame:
    """B3 as the stored award list: one row per week and conference."""
    return t.once("awards", lambda: stored(awards_from_games(t)))


def season_ranks(t: Tables) -> DataFrame:
    """Stored honour list: the best 20 players per season by their points."""

    def ranked():
        totals = box(t).groupBy("season", "player_id").agg(F.sum("points").alias("points"))
        order = [F.desc("points"), F.asc("player_id")]
        return stored(ordered.top_rows(totals, ["season"], order, 20, "rk"))

    return t.once("season_ranks", ranked)


HONOURS = {
    "mvp": (1, 1),
    "first_team": (1, 5),
    "second_team": (6, 10),
    "third_team": (11, 15),
    "all_star": (1, 20),
}


def honours(t: Tables) -> dict[str, DataFrame]:
    """B4: season honour lists; at most 20 players per season by construction."""
    ranks = season_ranks(t)
    return {
        name: ranks.where(F.col("rk").between(lo, hi)).select("player_id", "season")
        for name, (lo, hi) in HONOURS.items()
    }


def elites(t: Tables) -> DataFrame:
    """Players named in any of the three season teams."""
    return season_ranks(t).where("rk <= 15").select("player_id").distinct()


def labelled_weeks(t: Tables) -> DataFrame:
    """B9: candidates per (week, conference) with y = award winner and score = weekly assists."""
    t.once("scored_weeks", lambda: stored(scored_weeks_from_box(t)))
    won = awards(t).select("player_id", "conference", "week_start", F.lit(1).alias("y"))
    return (
        scored_weeks(t)
        .join(won, ["player_id", "conference", "week_start"], "left")
        .select(
            "player_id",
            "conference",
            "week_start",
            "points",
            F.col("assists").cast("double").alias("score"),
            F.coalesce("y", F.lit(0)).alias("y"),
        )
    )


def history(t: Tables) -> DataFrame:
    return team_game_history(games_table(t), GameColumns())


SQL: dict[str, str] = {
    "b1": """
  SELECT g.*, CASE WHEN homescore >= awayscore THEN hometeamid ELSE awayteamid END AS winner,
         h.n_name AS hometeamname, a.n_name AS awayteamname
  FROM (SELECT o_orderkey AS gameid, CAST(o_orderdate AS DATE) AS gamedate, c_nationkey AS hometeamid,
               s_nationkey AS awayteamid, CAST(FLOOR(o_totalprice) AS BIGINT) % 100 AS homescore,
               CAST(FLOOR(px) AS BIGINT) % 100 AS awayscore
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN (SELECT l_orderkey, MIN(l_suppkey) AS supp, MAX(l_extendedprice) AS px
              FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey
        JOIN supplier ON s_suppkey = supp
        WHERE c_nationkey <> s_nationkey) g
  JOIN nation h ON h.n_nationkey = hometeamid JOIN nation a ON a.n_nationkey = awayteamid""",
    "b2": """
  SELECT gameid, player_id, gamedate, teamid, opponentid, minutes, points, assists,
         points - 25 * minutes AS plus_minus, minutes AS attempted, made,
         CAST(CASE WHEN MONTH(gamedate) >= 7 THEN YEAR(gamedate) ELSE YEAR(gamedate) - 1 END AS INTEGER)
           AS season,
         CAST(date_trunc('week', gamedate) AS DATE) AS week_start
  FROM (SELECT l_orderkey AS gameid, l_suppkey AS player_id, CAST(MIN(o_orderdate) AS DATE) AS gamedate,
               MIN(s_nationkey) AS teamid, MIN(c_nationkey) AS opponentid, COUNT(*) AS minutes,
               CAST(SUM(l_quantity) AS BIGINT) AS points, CAST(SUM(l_linenumber) AS BIGINT) AS assists,
               CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS made
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey, l_suppkey) q""",
    "conf": "SELECT n_nationkey AS teamid, n_regionkey AS conference FROM nation",
    "pw": """
  SELECT player_id, teamid, season, week_start, COUNT(*) AS games,
         CAST(SUM(minutes) AS BIGINT) AS minutes, CAST(SUM(points) AS BIGINT) AS points,
         CAST(SUM(assists) AS BIGINT) AS assists, CAST(SUM(plus_minus) AS BIGINT) AS plus_minus,
         CAST(SUM(attempted) AS BIGINT) AS attempted, CAST(SUM(made) AS BIGINT) AS made
  FROM b2 GROUP BY player_id, teamid, season, week_start""",
    "sw": """
  SELECT player_id, teamid, week_start, CAST(SUM(points) AS BIGINT) AS points,
         CAST(SUM(assists) AS BIGINT) AS assists, MIN(conference) AS conference
  FROM b2 JOIN conf USING (teamid) GROUP BY player_id, teamid, week_start""",
    "b3": """
  SELECT player_id, conference, week_start, CAST(week_start + 7 AS DATE) AS date
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY week_start, conference
                                     ORDER BY points DESC, player_id) AS rn FROM sw) r
  WHERE rn = 1""",
    "b4": """
  SELECT season, player_id, points, rk FROM (
    SELECT season, player_id, CAST(SUM(points) AS BIGINT) AS points,
           ROW_NUMBER() OVER (PARTITION BY season ORDER BY SUM(points) DESC, player_id) AS rk
    FROM b2 GROUP BY season, player_id) r
  WHERE rk <= 20""",
    "b9": """
  SELECT sw.player_id, sw.conference, sw.week_start, sw.points, CAST(sw.assists AS DOUBLE) AS score,
         CAST(CASE WHEN b3.player_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS y
  FROM sw LEFT JOIN b3 ON sw.player_id = b3.player_id AND sw.conference = b3.conference
                      AND sw.week_start = b3.week_start""",
    "sides": """
  SELECT gameid, gamedate, hometeamname AS team, hometeamid AS teamid, awayteamname AS opponent,
         awayteamid AS opponentid, homescore AS team_score, awayscore AS opp_score, winner, 1 AS home
  FROM b1
  UNION ALL
  SELECT gameid, gamedate, awayteamname, awayteamid, hometeamname, hometeamid, awayscore, homescore,
         winner, 0 FROM b1""",
    "flags": """
  SELECT *, CASE WHEN teamid = winner THEN 1 ELSE 0 END AS is_win,
         CASE WHEN teamid = winner THEN home ELSE 0 END AS is_home_win,
         CASE WHEN teamid = winner THEN 1 - home ELSE 0 END AS is_away_win,
         CAST(CASE WHEN MONTH(gamedate) >= 7 THEN YEAR(gamedate) ELSE YEAR(gamedate) - 1 END AS INTEGER)
           AS season,
         CAST(date_trunc('week', gamedate) AS DATE) AS week_start
  FROM sides""",
    "priors": """
  SELECT *, CAST(ROW_NUMBER() OVER o - 1 AS BIGINT) AS games_prior,
         CAST(COALESCE(SUM(is_win) OVER p, 0) AS BIGINT) AS wins_prior,
         CAST(COALESCE(SUM(home) OVER p, 0) AS BIGINT) AS home_games_prior,
         CAST(COALESCE(SUM(is_home_win) OVER p, 0) AS BIGINT) AS home_wins_prior,
         CAST(COALESCE(SUM(is_away_win) OVER p, 0) AS BIGINT) AS away_wins_prior,
         CAST(ROW_NUMBER() OVER wo - 1 AS BIGINT) AS week_games_prior,
         CAST(COALESCE(SUM(is_win) OVER wp, 0) AS BIGINT) AS week_wins_prior
  FROM flags
  WINDOW o AS (PARTITION BY teamid, season ORDER BY gamedate, gameid),
         p AS (PARTITION BY teamid, season ORDER BY gamedate, gameid
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         wo AS (PARTITION BY teamid, season, week_start ORDER BY gamedate, gameid),
         wp AS (PARTITION BY teamid, season, week_start ORDER BY gamedate, gameid
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "lagged": """
  SELECT *, COALESCE(LAG(is_win) OVER o, 0) AS l_w, COALESCE(LAG(is_home_win) OVER o, 0) AS l_h,
         COALESCE(LAG(is_away_win) OVER o, 0) AS l_a
  FROM priors WINDOW o AS (PARTITION BY teamid, season ORDER BY gamedate, gameid)""",
    "islands": """
  SELECT *, SUM(1 - l_w) OVER o AS g_w, SUM(1 - l_h) OVER o AS g_h, SUM(1 - l_a) OVER o AS g_a
  FROM lagged WINDOW o AS (PARTITION BY teamid, season ORDER BY gamedate, gameid
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "streaks": """
  SELECT *,
         CAST(SUM(l_w) OVER (PARTITION BY teamid, season, g_w ORDER BY gamedate, gameid
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS win_streak_prior,
         CAST(SUM(l_h) OVER (PARTITION BY teamid, season, g_h ORDER BY gamedate, gameid
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS home_win_streak_prior,
         CAST(SUM(l_a) OVER (PARTITION BY teamid, season, g_a ORDER BY gamedate, gameid
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS away_win_streak_prior
  FROM islands""",
    "opp": """
  SELECT s.*, x.wins_prior AS opp_wins_prior, x.games_prior - x.wins_prior AS opp_losses_prior,
         x.wins_prior / NULLIF(x.games_prior, 0) AS opp_rate,
         CASE WHEN s.is_win = 1 AND x.wins_prior / NULLIF(x.games_prior, 0) > 0.5 THEN 1 ELSE 0 END
           AS is_win_vs_over_500
  FROM streaks s LEFT JOIN priors x ON s.gameid = x.gameid AND s.opponentid = x.teamid""",
    "hist": """
  SELECT gameid, gamedate, team, teamid, opponent, opponentid,
         CASE WHEN is_win = 1 THEN 'win' ELSE 'loss' END AS outcome, CAST(home AS INTEGER) AS home,
         team_score, opp_score, games_prior, wins_prior, games_prior - wins_prior AS losses_prior,
         wins_prior || '-' || (games_prior - wins_prior) AS record_prior,
         home_games_prior, home_wins_prior, home_games_prior - home_wins_prior AS home_losses_prior,
         home_wins_prior || '-' || (home_games_prior - home_wins_prior) AS home_record_prior,
         games_prior - home_games_prior AS away_games_prior, away_wins_prior,
         games_prior - home_games_prior - away_wins_prior AS away_losses_prior,
         away_wins_prior || '-' || (games_prior - home_games_prior - away_wins_prior)
           AS away_record_prior,
         win_streak_prior, home_win_streak_prior, away_win_streak_prior,
         opp_wins_prior, opp_losses_prior, CAST(COALESCE(opp_rate, 0.5) AS DOUBLE) AS opp_winrate_prior,
         CAST(is_win_vs_over_500 AS INTEGER) AS is_win_vs_over_500,
         CAST(COALESCE(SUM(is_win_vs_over_500) OVER (PARTITION BY teamid, season
              ORDER BY gamedate, gameid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
           AS wins_vs_over_500_prior,
         week_games_prior, week_wins_prior, week_games_prior - week_wins_prior AS week_losses_prior,
         week_wins_prior || '-' || (week_games_prior - week_wins_prior) AS week_record_prior,
         season, week_start
  FROM opp""",
}

_NAME = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_][a-z0-9_]*)")


def oracle(query: str, **extra: str) -> str:
    """`query` with the named bindings it uses, and those they use, as CTEs in front of it."""
    known = {**SQL, **extra}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in known and name not in needed:
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    if not needed:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({known[n]}\n)" for n in needed) + "\n" + query
