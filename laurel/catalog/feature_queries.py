"""Checked queries of the composite features (FEA)."""

from __future__ import annotations

from pyspark.sql import functions as F

from laurel.catalog import bindings as b
from laurel.catalog.bindings import HONOURS, oracle
from laurel.catalog.ordered_queries import flagged
from laurel.catalog.registry import query
from laurel.plans import features
from laurel.plans.history import HISTORY_COLUMNS

STATS = ("minutes", "points", "assists", "plus_minus", "attempted", "made")
AS_OF = "2001-09-15"


def rounded(*columns):
    return [F.round(c, 6).alias(c) for c in columns]


HONOUR_FLAGS = ", ".join(
    f"CAST(CASE WHEN h.rk BETWEEN {lo} AND {hi} THEN 1 ELSE 0 END AS INTEGER) AS {name}"
    for name, (lo, hi) in HONOURS.items()
)
CONTEXT = [
    c for c in HISTORY_COLUMNS if c not in ("gameid", "teamid", "gamedate", "season", "week_start")
]


def features_cte(awards: str) -> str:
    return f"""
  SELECT x.gameid, x.player_id, x.teamid, x.gamedate, x.season, x.week_start, x.minutes, x.points, x.assists,
         x.plus_minus, x.attempted, x.made, {', '.join('hist.' + c for c in CONTEXT)}, conf.conference,
         CAST(CASE WHEN e.gameid IS NULL THEN 0 ELSE 1 END AS INTEGER) AS opponent_has_elite,
         CAST(CASE WHEN w.player_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS won_award, {HONOUR_FLAGS},
         CAST(CASE WHEN hist.outcome = 'win' THEN 1 ELSE 0 END AS INTEGER) AS win,
         CAST(CASE WHEN hist.outcome = 'win' AND e.gameid IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS win_vs_elite
  FROM b2 x JOIN hist ON x.gameid = hist.gameid AND x.teamid = hist.teamid
  JOIN conf ON x.teamid = conf.teamid
  JOIN (SELECT DISTINCT week_start, conference FROM {awards}) o
    ON o.week_start = x.week_start AND o.conference = conf.conference
  LEFT JOIN (SELECT DISTINCT gameid, teamid FROM b2
             WHERE player_id IN (SELECT player_id FROM b4 WHERE rk <= 15)) e
    ON e.gameid = x.gameid AND e.teamid = hist.opponentid
  LEFT JOIN (SELECT DISTINCT week_start, conference, player_id FROM {awards}) w
    ON w.week_start = x.week_start AND w.conference = conf.conference AND w.player_id = x.player_id
  LEFT JOIN b4 h ON h.player_id = x.player_id AND h.season = x.season"""


WEEKLY_COLUMNS = (
    [f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in (*STATS, *features.WEEKLY_SUMS)]
    + [f"AVG({c}) AS avg_{c}" for c in features.WEEKLY_MEANS]
    + [f"MAX({c}) AS {c}" for c in (*features.WEEKLY_MAXIMA, *HONOURS)]
)


def weekly_cte(source: str) -> str:
    return f"""
  SELECT player_id, teamid, season, week_start, conference, COUNT(DISTINCT gameid) AS games_played,
         {', '.join(WEEKLY_COLUMNS)},
         CASE WHEN SUM(attempted) > 0 THEN SUM(made) / SUM(attempted) ELSE 0 END AS made_pct
  FROM {source} GROUP BY player_id, teamid, season, week_start, conference"""


def z_sql(m):
    return f"CASE WHEN {m}_std_season > 0 THEN ({m} - {m}_mean_season) / {m}_std_season ELSE 0 END AS z_{m}"


METRICS = ("points", "assists", "plus_minus")
OVER = ", ".join(
    f"AVG({m}) OVER p AS {m}_mean_season, STDDEV_POP({m}) OVER p AS {m}_std_season" for m in METRICS
)


def breakout_cte(source: str) -> str:
    return f"""
  SELECT *, 0.5 * z_points + 0.3 * z_assists + 0.2 * z_plus_minus AS breakout_score
  FROM (SELECT *, {', '.join(z_sql(m) for m in METRICS)}
        FROM (SELECT *, {OVER} FROM {source}
              WINDOW p AS (PARTITION BY player_id, season ORDER BY week_start, teamid
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) q
        WHERE points_mean_season IS NOT NULL) r"""


CTES = {
    "feat": features_cte("b3"),
    "weekly": weekly_cte("feat"),
    "brk": breakout_cte("weekly"),
    "lastaward": "SELECT MAX(date) AS last FROM b3",
    "open": f"""
  SELECT player_id, conference, week_start, date FROM b3
  UNION ALL
  SELECT NULL, conference, CAST(last + CAST((k - 1) * 7 AS INTEGER) AS DATE), CAST(last + CAST(k * 7 AS INTEGER) AS DATE)
  FROM (SELECT DISTINCT conference, last,
               unnest(range(1, CAST(GREATEST(CEIL(date_diff('day', last, DATE '{AS_OF}') / 7), 1) AS BIGINT) + 1)) AS k
        FROM (SELECT conference, last FROM b3 JOIN lastaward ON TRUE) c) q""",
    "ifeat": features_cte("open"),
    "iweekly": weekly_cte("ifeat"),
    "ibrk": breakout_cte("iweekly"),
}


def sql(text: str) -> str:
    return oracle(text, **CTES)


def player_games(t, awards=None):
    return features.game_features(
        b.box_table(t), b.history(t), b.awards(t) if awards is None else awards, b.honours(t), b.conferences(t), b.elites(t)
    )


def weekly(t, awards=None):
    # (game, player) is the key of the box scores.
    return features.weekly_features(
        player_games(t, awards),
        STATS,
        list(HONOURS),
        ratios={"made_pct": ("made", "attempted")},
        unique_games=True,
    )


@query(
    "fea_1",
    sql(
        "SELECT "
        + ", ".join("ROUND(opp_winrate_prior, 6) AS opp_winrate_prior" if c == "opp_winrate_prior" else c for c in HISTORY_COLUMNS)
        + " FROM hist"
    ),
)
def fea_1(t):
    """Both teams' record going into every game of the table; the operator's filter is an argument of its callers."""
    return b.history(t).withColumn("opp_winrate_prior", F.round("opp_winrate_prior", 6))


ELITE_SQL = """
SELECT x.gameid, x.player_id, x.teamid, x.opponentid, CAST(x.win AS INTEGER) AS win,
       CAST(CASE WHEN e.gameid IS NULL THEN 0 ELSE 1 END AS INTEGER) AS opponent_has_elite,
       CAST(CASE WHEN e.gameid IS NOT NULL AND x.win = 1 THEN 1 ELSE 0 END AS INTEGER) AS win_vs_elite
FROM ({rows}) x
LEFT JOIN (SELECT DISTINCT gameid, teamid FROM b2 WHERE player_id IN (SELECT player_id FROM b4 WHERE rk <= 15)) e
  ON e.gameid = x.gameid AND e.teamid = x.opponentid"""
BOX_WITH_WIN = """
SELECT b2.gameid, b2.player_id, b2.teamid, flags.opponentid, is_win AS win
FROM b2 JOIN flags ON b2.gameid = flags.gameid AND b2.teamid = flags.teamid"""


def box_with_win(t):
    sides = flagged(t).select("gameid", "teamid", "opponentid", F.col("is_win").alias("win"))
    return b.box_table(t).drop("opponentid").join(sides, ["gameid", "teamid"])


@query("fea_2", sql(ELITE_SQL.format(rows=BOX_WITH_WIN)))
def fea_2(t):
    rows = box_with_win(t).select("gameid", "player_id", "teamid", "opponentid", "win")
    return features.elite_opponent(rows, b.elites(t))


@query(
    "fea_3",
    sql("""
SELECT player_id, CAST(SUM(CASE WHEN e.gameid IS NOT NULL AND win = 1 THEN 1 ELSE 0 END) AS BIGINT) AS wins_vs_elite
FROM (SELECT b2.gameid, b2.player_id, b2.teamid,
             CASE WHEN b2.teamid = hometeamid THEN awayteamid ELSE hometeamid END AS opponentid,
             CASE WHEN b2.teamid = winner THEN 1 ELSE 0 END AS win
      FROM b2 LEFT JOIN b1 ON b2.gameid = b1.gameid
      WHERE CAST(b2.gamedate AS VARCHAR) LIKE '1999-%' OR CAST(b2.gamedate AS VARCHAR) LIKE '2000-%') x
LEFT JOIN (SELECT DISTINCT gameid, teamid FROM b2
           WHERE player_id IN (SELECT player_id FROM b4 WHERE rk <= 15)
             AND (CAST(gamedate AS VARCHAR) LIKE '1999-%' OR CAST(gamedate AS VARCHAR) LIKE '2000-%')) e
  ON e.gameid = x.gameid AND e.teamid = x.opponentid
GROUP BY player_id ORDER BY wins_vs_elite DESC, player_id LIMIT 30"""),
)
def fea_3(t):
    day = F.col("gamedate").cast("string")
    rows = features.elite_opponent_by_result(
        b.box_table(t), b.games_table(t), b.elites(t), where=day.startswith("1999-") | day.startswith("2000-")
    )
    totals = rows.groupBy("player_id").agg(F.sum("win_vs_elite").alias("wins_vs_elite"))
    return totals.orderBy(F.desc("wins_vs_elite"), "player_id").limit(30)


FEATURE_COLUMNS = [
    "gameid", "player_id", "teamid", "gamedate", "season", "week_start", *STATS, "conference",
    "opponent_has_elite", "won_award", *HONOURS, "win", "win_vs_elite",
    *[c for c in CONTEXT if c != "opp_winrate_prior"],
]


@query(
    "fea_4",
    sql(f"SELECT {', '.join(FEATURE_COLUMNS)}, ROUND(opp_winrate_prior, 6) AS opp_winrate_prior FROM feat"),
)
def fea_4(t):
    return player_games(t).select(*FEATURE_COLUMNS, *rounded("opp_winrate_prior"))


WEEKLY_OUT = [
    "player_id", "teamid", "season", "week_start", "conference", "games_played", *STATS,
    *features.WEEKLY_SUMS, *features.WEEKLY_MAXIMA, *HONOURS,
]
WEEKLY_FLOATS = [*[f"avg_{c}" for c in features.WEEKLY_MEANS], "made_pct"]


@query(
    "fea_5",
    sql(
        f"SELECT {', '.join(WEEKLY_OUT)}, {', '.join(f'FLOOR({c} * 1e6 + 0.5) / 1e6 AS {c}' for c in WEEKLY_FLOATS)} FROM weekly"
    ),
)
def fea_5(t):
    # Means of a few games often end in exact halves, which the engines round differently.
    return weekly(t).select(
        *WEEKLY_OUT, *[(F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c) for c in WEEKLY_FLOATS]
    )


BREAKOUT_FLOATS = [
    *[f"{m}_{s}_season" for m in METRICS for s in ("mean", "std")],
    *[f"z_{m}" for m in METRICS],
    "breakout_score",
]


@query(
    "fea_6",
    sql(
        "SELECT player_id, teamid, season, week_start, points, assists, plus_minus, won_award, "
        + ", ".join(f"ROUND({c}, 5) AS {c}" for c in BREAKOUT_FLOATS)
        + " FROM brk"
    ),
)
def fea_6(t):
    return features.breakout(weekly(t)).select(
        "player_id", "teamid", "season", "week_start", "points", "assists", "plus_minus", "won_award",
        *[F.round(c, 5).alias(c) for c in BREAKOUT_FLOATS],
    )


LEAGUE_SQL = ", ".join(f"AVG({m}) AS {m}_mean, STDDEV_SAMP({m}) AS {m}_std" for m in METRICS)


@query(
    "fea_7",
    sql(
        "SELECT w.player_id, w.teamid, w.season, w.week_start, "
        + ", ".join(f"ROUND(COALESCE((w.{m} - {m}_mean) / NULLIF({m}_std, 0), 0), 6) AS z_s_{m}" for m in METRICS)
        + f" FROM brk w LEFT JOIN (SELECT season + 1 AS season, {LEAGUE_SQL} FROM brk GROUP BY season) l"
        " ON w.season = l.season"
    ),
)
def fea_7(t):
    # The weekly table is used twice: for its rows and for the league statistics.
    rows = features.league_normalise(b.stored(features.breakout(weekly(t))))
    return rows.select(
        "player_id", "teamid", "season", "week_start", *rounded(*[f"z_s_{m}" for m in METRICS])
    )


@query(
    "fea_8",
    sql(f"""
SELECT p.player_id, p.teamid, p.season, p.week_start, p.games, p.minutes, p.points, p.assists, p.plus_minus,
       team_points, team_assists, team_games, ROUND(p.plus_minus / p.games, 6) AS plus_minus_mean,
       {', '.join(f'ROUND({m}_{s}_season, 6) AS {m}_{s}_season' for m in METRICS for s in ('mean', 'std'))}
FROM (SELECT *, {OVER} FROM pw
      WINDOW p AS (PARTITION BY player_id, season ORDER BY week_start, teamid
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) p
JOIN (SELECT teamid, season, week_start, CAST(SUM(points) AS BIGINT) AS team_points,
             CAST(SUM(assists) AS BIGINT) AS team_assists, COUNT(DISTINCT gameid) AS team_games
      FROM b2 GROUP BY teamid, season, week_start) q
  ON p.teamid = q.teamid AND p.season = q.season AND p.week_start = q.week_start
WHERE points_mean_season IS NOT NULL"""),
)
def fea_8(t):
    rows = features.team_share_features(b.box_table(t))
    return rows.select(
        "player_id", "teamid", "season", "week_start", "games", "minutes", "points", "assists", "plus_minus",
        "team_points", "team_assists", "team_games",
        *rounded("plus_minus_mean", *[f"{m}_{s}_season" for m in METRICS for s in ("mean", "std")]),
    )


@query(
    "fea_9",
    sql("""
SELECT w.player_id, w.teamid, w.season, w.week_start,
       ROUND(COALESCE(avg_pct, AVG(avg_pct) OVER ()), 6) AS avg_win_pct_this_week,
       ROUND(COALESCE(spread, AVG(spread) OVER ()), 6) AS win_pct_spread_this_week
FROM (SELECT pw.*, conference FROM pw JOIN conf ON pw.teamid = conf.teamid) w
LEFT JOIN (
  SELECT teamid, season, week_start, AVG(win_pct) AS avg_pct, MAX(win_pct) - MIN(win_pct) AS spread
  FROM (SELECT *, AVG(win) OVER (PARTITION BY teamid, season ORDER BY gamedate, gameid
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS win_pct
        FROM (SELECT DISTINCT b2.gameid, b2.gamedate, b2.teamid, b2.season, b2.week_start, is_win AS win
              FROM b2 JOIN flags ON b2.gameid = flags.gameid AND b2.teamid = flags.teamid
              JOIN orders ON o_orderkey = b2.gameid
              WHERE CASE WHEN b2.season < 2000 THEN CASE WHEN o_orderstatus = 'P' THEN 'Preseason' ELSE 'Regular Season' END
                         WHEN b2.gamedate < DATE '2000-10-21' THEN 'Preseason'
                         ELSE 'Regular Season' END = 'Regular Season') g) r
  GROUP BY teamid, season, week_start) q
  ON w.teamid = q.teamid AND w.season = q.season AND w.week_start = q.week_start"""),
)
def fea_9(t):
    weeks = b.player_weeks(t).join(b.conferences(t), "teamid")
    types = t.orders.select(
        F.col("o_orderkey").alias("gameid"),
        F.when(F.col("o_orderstatus") == "P", "Preseason").otherwise("Regular Season").alias("gametype"),
    )
    rows = features.win_pct_features(
        weeks, box_with_win(t), types, current_season=2000, opening_day="2000-10-21"
    )
    return rows.select(
        "player_id", "teamid", "season", "week_start",
        *rounded("avg_win_pct_this_week", "win_pct_spread_this_week"),
    )


@query(
    "fea_10",
    sql(
        "SELECT pw.player_id, pw.teamid, pw.season, pw.week_start, "
        + ", ".join(
            f"CAST(CASE WHEN h.rk BETWEEN {lo} AND {hi} THEN 1 ELSE 0 END AS INTEGER) AS {name}_last_season"
            for name, (lo, hi) in HONOURS.items()
        )
        + """ FROM pw
LEFT JOIN (SELECT DISTINCT player_id, season FROM b2) a ON a.player_id = pw.player_id AND a.season = pw.season - 1
LEFT JOIN b4 h ON h.player_id = a.player_id AND h.season = a.season"""
    ),
)
def fea_10(t):
    rows = features.prior_season_honours(b.player_weeks(t), b.box_table(t), b.honours(t))
    return rows.select(
        "player_id", "teamid", "season", "week_start", *[f"{h}_last_season" for h in HONOURS]
    )


@query(
    "fea_11",
    sql("""
SELECT x.gameid, x.player_id, x.teamid, x.week_start, conf.conference,
       CAST(CASE WHEN w.player_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS won_award
FROM b2 x JOIN conf ON x.teamid = conf.teamid
JOIN (SELECT DISTINCT week_start, conference FROM b3) o
  ON o.week_start = x.week_start AND o.conference = conf.conference
LEFT JOIN b3 w ON w.week_start = x.week_start AND w.conference = conf.conference AND w.player_id = x.player_id"""),
)
def fea_11(t):
    rows = b.box_table(t).select("gameid", "player_id", "teamid", "week_start")
    return features.label_winners(rows, b.awards(t), b.conferences(t))


@query("fea_12", sql("SELECT player_id, conference, week_start, date FROM open"))
def fea_12(t):
    return features.placeholder_awards(b.awards(t), AS_OF)


@query(
    "fea_13",
    sql(
        "SELECT player_id, teamid, season, week_start, points, games_played, won_award, "
        "ROUND(breakout_score, 5) AS breakout_score FROM ibrk"
    ),
)
def fea_13(t):
    awards = features.placeholder_awards(b.awards(t), AS_OF)
    return features.breakout(weekly(t, awards)).select(
        "player_id", "teamid", "season", "week_start", "points", "games_played", "won_award",
        F.round("breakout_score", 5).alias("breakout_score"),
    )


@query(
    "fea_14",
    sql("""
SELECT gameid, teamid, player_id, player_played, player_win,
       CAST(COALESCE(SUM(player_played) OVER s, 0) AS BIGINT) AS player_games_season_prior,
       CAST(COALESCE(SUM(player_win) OVER s, 0) AS BIGINT) AS player_wins_season_prior,
       CAST(COALESCE(SUM(player_played) OVER w, 0) AS BIGINT) AS player_games_week_prior,
       CAST(COALESCE(SUM(player_win) OVER w, 0) AS BIGINT) AS player_wins_week_prior
FROM (SELECT hist.gameid, hist.teamid, hist.gamedate, k.player_id, k.season, k.week_start AS award_week,
             CAST(CASE WHEN k.player_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS player_played,
             CAST(CASE WHEN k.player_id IS NOT NULL AND outcome = 'win' THEN 1 ELSE 0 END AS INTEGER) AS player_win
      FROM hist LEFT JOIN (
        SELECT b2.gameid, b2.teamid, b2.player_id, b2.season, b2.week_start
        FROM b2 JOIN (SELECT DISTINCT player_id, week_start FROM b3) a
          ON b2.player_id = a.player_id AND b2.week_start = a.week_start) k
      ON hist.gameid = k.gameid AND hist.teamid = k.teamid) q
WINDOW s AS (PARTITION BY player_id, season ORDER BY award_week, gamedate, gameid, teamid
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       w AS (PARTITION BY player_id, season, award_week ORDER BY gamedate, gameid, teamid
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
)
def fea_14(t):
    return features.player_game_history(b.history(t), b.box_table(t), b.awards(t)).select(
        "gameid", "teamid", "player_id", "player_played", "player_win",
        "player_games_season_prior", "player_wins_season_prior",
        "player_games_week_prior", "player_wins_week_prior",
    )
