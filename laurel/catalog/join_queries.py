"""Checked queries of the joins (JOI) and of entity resolution (ENT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from laurel.catalog import bindings as b
from laurel.catalog.bindings import HONOURS, oracle
from laurel.catalog.ordered_queries import flagged
from laurel.catalog.registry import query
from laurel.functions import dates
from laurel.operators import entities, joins, ordered
from laurel.operators.ordered import Prefix
from laurel.plans import features
from laurel.plans.history import season_groups
from laurel.sources.tables import read_literal

# (priority, first day, last day, season): 1996 and 1997 overlap, and May to August 1999 is a gap.
RULES = [
    (1, "2000-09-01", "2001-08-31", 2000),
    (2, "1999-09-01", "2000-08-31", 1999),
    (3, "1998-09-01", "1999-04-30", 1998),
    (4, "1997-06-01", "1998-08-31", 1997),
    (5, "1996-09-01", "1997-08-31", 1996),
    (6, "1995-09-01", "1996-08-31", 1995),
]


@query(
    "joi_1",
    oracle("""
SELECT b2.gameid, b2.player_id, b2.teamid, b2.points, flags.team_score
FROM b2 JOIN flags ON b2.gameid = flags.gameid AND b2.teamid = flags.teamid"""),
)
def joi_1(t):
    sides = flagged(t).select("gameid", "teamid", "team_score")
    return joins.inner_join(b.box(t), sides, ["gameid", "teamid"]).select(
        "gameid", "player_id", "teamid", "points", "team_score"
    )


@query(
    "joi_2",
    oracle("""
SELECT flags.gameid, flags.teamid, b2.player_id, b2.points
FROM flags LEFT JOIN b2 ON b2.gameid = flags.gameid AND b2.teamid = flags.teamid"""),
)
def joi_2(t):
    rows = b.box(t).select("gameid", "teamid", "player_id", "points")
    return joins.left_join(flagged(t).select("gameid", "teamid"), rows, ["gameid", "teamid"])


@query(
    "joi_3",
    oracle("""
SELECT gameid, hometeamid, n.conference, k.conference AS conference_by_name FROM b1
JOIN conf n ON n.teamid = hometeamid
JOIN (SELECT n_name, MIN(n_regionkey) AS conference FROM nation GROUP BY n_name) k ON k.n_name = hometeamname"""),
)
def joi_3(t):
    by_name = t.nation.select(
        F.col("n_name").alias("hometeamname"), F.col("n_regionkey").alias("conference_by_name")
    )
    twice = by_name.unionByName(by_name.withColumn("conference_by_name", F.lit(99)))
    by_id = b.conferences(t).withColumnRenamed("teamid", "hometeamid")
    rows = joins.dimension_join(b.games(t), by_id, ["hometeamid"], "inner")
    return joins.dimension_join(rows, twice, ["hometeamname"], "inner").select(
        "gameid", "hometeamid", "conference", "conference_by_name"
    )


@query(
    "joi_4",
    oracle(
        "SELECT b2.gameid, b2.player_id, "
        + ", ".join(
            f"CAST(CASE WHEN h.rk BETWEEN {lo} AND {hi} THEN 1 ELSE 0 END AS INTEGER) AS {name}"
            for name, (lo, hi) in HONOURS.items()
        )
        + " FROM b2 LEFT JOIN b4 h ON h.player_id = b2.player_id AND h.season = b2.season"
    ),
)
def joi_4(t):
    rows = joins.membership_flags(b.box_table(t), b.honours(t), ["player_id", "season"])
    return rows.select("gameid", "player_id", *HONOURS)


@query(
    "joi_5",
    oracle("""
SELECT p.gameid, p.teamid, x.wins_prior AS opp_wins_prior, x.games_prior AS opp_games_prior
FROM priors p LEFT JOIN priors x ON p.gameid = x.gameid AND p.opponentid = x.teamid"""),
)
def joi_5(t):
    rows = (
        season_groups(flagged(t))
        .add(Prefix("games_prior", "count"), Prefix("wins_prior", "sum", F.col("is_win")))
        .result()
        .select("gameid", "teamid", "opponentid", "games_prior", "wins_prior")
    )
    return joins.opponent_join(rows, ["wins_prior", "games_prior"]).select(
        "gameid", "teamid", "opp_wins_prior", "opp_games_prior"
    )


@query(
    "joi_6",
    oracle("""
SELECT a.player_id, a.season + 1 AS season, CAST(a.rk AS INTEGER) AS rk_last_season
FROM b4 a JOIN b4 n ON a.player_id = n.player_id AND a.season = n.season - 1"""),
)
def joi_6(t):
    return joins.previous_season(b.season_ranks(t), "player_id", "season", ["rk"])


@query(
    "joi_7",
    oracle("""
SELECT b2.gameid, b2.player_id, a.player_id AS award_player_id, a.conference
FROM b2 JOIN b3 a ON CAST(date_trunc('week', a.date - 1) AS DATE) = b2.week_start"""),
)
def joi_7(t):
    awards = b.awards(t).select(
        F.col("player_id").alias("award_player_id"),
        "conference",
        dates.award_week_start(F.col("date")).alias("week_start"),
    )
    return joins.inner_join(b.box(t), awards, ["week_start"]).select(
        "gameid", "player_id", "award_player_id", "conference"
    )


RULE_SQL = "VALUES " + ", ".join(f"({p}, DATE '{lo}', DATE '{hi}', {s})" for p, lo, hi, s in RULES)


@query(
    "joi_8",
    oracle(f"""
SELECT gameid, player_id, (SELECT CAST(min_by(season, priority) AS INTEGER)
                           FROM ({RULE_SQL}) r(priority, lo, hi, season)
                           WHERE b2.gamedate BETWEEN lo AND hi) AS rule_season FROM b2"""),
)
def joi_8(t):
    rules = read_literal(t.spark, RULES, "priority int, lo date, hi date, rule_season int")
    rows = b.box(t).select("gameid", "player_id", "gamedate")
    return joins.interval_join(rows, rules, "gamedate", "lo", "hi", "rule_season", "priority").drop("gamedate")


@query(
    "joi_9",
    oracle("""
SELECT DISTINCT c_nationkey AS nation,
       CASE WHEN c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) THEN 'both'
            ELSE 'left_only' END AS matched
FROM customer"""),
)
def joi_9(t):
    left = t.customer.select(F.col("c_nationkey").alias("nation"))
    right = t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation"))
    return joins.match_report(left, right, ["nation"])


@query(
    "joi_10",
    oracle("""
SELECT x.gameid, x.player_id, x.opponentid, CAST(CASE WHEN e.gameid IS NULL THEN 0 ELSE 1 END AS INTEGER) AS opponent_has_elite
FROM b2 x LEFT JOIN (SELECT DISTINCT gameid, teamid FROM b2
                     WHERE player_id IN (SELECT player_id FROM b4 WHERE rk <= 15)) e
  ON e.gameid = x.gameid AND e.teamid = x.opponentid"""),
)
def joi_10(t):
    rows = b.box_table(t).withColumn("win", F.lit(0))
    return features.elite_opponent(rows, b.elites(t)).select(
        "gameid", "player_id", "opponentid", "opponent_has_elite"
    )


@query(
    "joi_12",
    oracle("""
SELECT p.player_id, p.teamid, p.season, p.week_start, ROUND(m, 6) AS league_points_mean, ROUND(s, 6) AS league_points_std
FROM pw p LEFT JOIN (SELECT season + 1 AS season, AVG(points) AS m, STDDEV_SAMP(points) AS s FROM pw GROUP BY season) l
  ON p.season = l.season"""),
)
def joi_12(t):
    return features.league_normalise(b.stored(b.player_weeks(t)), ["points"]).select(
        "player_id", "teamid", "season", "week_start",
        *[F.round(c, 6).alias(c) for c in ("league_points_mean", "league_points_std")],
    )


# B5: aliases for even keys; the lookup leaves out every tenth key, which the alias id then fills.
NAMES = {
    "aliases": """
  SELECT replace(s_name, '#', ' ') AS alias, s_name AS canonical, s_suppkey AS id FROM supplier WHERE s_suppkey % 2 = 0""",
    "lookup": "SELECT s_suppkey AS player_id, s_name AS player_name FROM supplier WHERE s_suppkey % 10 <> 4",
    "named": """
  SELECT gameid, points, CASE WHEN gameid % 50 = 0 THEN 'Unknown' WHEN player_id % 2 = 0 THEN replace(s_name, '#', ' ')
                              ELSE s_name END AS player
  FROM b2 JOIN supplier ON player_id = s_suppkey""",
    "resolved": """
  SELECT COALESCE(l.player_id, a.id) AS player_id, COALESCE(a.canonical, n.player) AS player_name, gameid, points
  FROM named n LEFT JOIN aliases a ON n.player = a.alias
  LEFT JOIN lookup l ON l.player_name = COALESCE(a.canonical, n.player)""",
}


def aliases(t):
    return t.supplier.where("s_suppkey % 2 = 0").select(
        F.regexp_replace("s_name", "#", " ").alias("alias"),
        F.col("s_name").alias("canonical"),
        F.col("s_suppkey").alias("id"),
    )


def lookup(t):
    return t.supplier.where("s_suppkey % 10 <> 4").selectExpr("s_suppkey AS player_id", "s_name AS player_name")


def named(t):
    names = t.supplier.selectExpr("s_suppkey AS player_id", "s_name")
    return (
        b.box_table(t)
        .join(names, "player_id")
        .select(
            "gameid",
            "points",
            F.when(F.col("gameid") % 50 == 0, "Unknown")
            .when(F.col("player_id") % 2 == 0, F.regexp_replace("s_name", "#", " "))
            .otherwise(F.col("s_name"))
            .alias("player"),
        )
    )


@query(
    "joi_11",
    oracle("SELECT DISTINCT player, player_name, player_id FROM (SELECT n.player, "
           "COALESCE(a.canonical, n.player) AS player_name, COALESCE(l.player_id, a.id) AS player_id "
           "FROM named n LEFT JOIN aliases a ON n.player = a.alias "
           "LEFT JOIN lookup l ON l.player_name = COALESCE(a.canonical, n.player)) q", **NAMES),
)
def joi_11(t):
    return entities.resolve_names(named(t), "player", aliases(t), lookup(t))


@query("ent_1", oracle("SELECT player_id, player_name, gameid, points FROM resolved", **NAMES))
def ent_1(t):
    return entities.resolve_entities(named(t), "player", aliases(t), lookup(t))


@query(
    "ent_2",
    oracle("""
SELECT s_suppkey AS player_id, CASE WHEN s_suppkey % 7 = 0 THEN s_name || ' Jr.' ELSE s_name END AS player_name,
       s_acctbal FROM supplier"""),
)
def ent_2(t):
    players = t.supplier.selectExpr("s_suppkey AS player_id", "s_name AS player_name", "s_acctbal")
    overrides = t.supplier.where("s_suppkey % 7 = 0").selectExpr(
        "s_suppkey AS player_id", "concat(s_name, ' Jr.') AS player_name"
    )
    return entities.override_names(players, overrides)


@query(
    "ent_3",
    oracle("""
SELECT c_custkey AS person_id, c_name, alias, canonical FROM customer LEFT JOIN aliases ON c_custkey = id""", **NAMES),
)
def ent_3(t):
    people = t.customer.selectExpr("c_custkey AS person_id", "c_name")
    return entities.enrich_by_id(people, aliases(t), "person_id", "id")


@query(
    "ent_4",
    oracle("""
SELECT date, conference, player_name, player_id, CAST(ROW_NUMBER() OVER (ORDER BY date DESC, conference, player_name) AS BIGINT) AS position
FROM (SELECT b3.date, b3.conference, COALESCE(a.canonical, raw) AS player_name, COALESCE(l.player_id, a.id) AS player_id
      FROM (SELECT b3.*, CASE WHEN player_id % 2 = 0 THEN replace(s_name, '#', ' ') ELSE s_name END AS raw
            FROM b3 JOIN supplier ON player_id = s_suppkey) b3
      LEFT JOIN aliases a ON raw = a.alias LEFT JOIN lookup l ON l.player_name = COALESCE(a.canonical, raw)) q""", **NAMES),
)
def ent_4(t):
    names = t.supplier.selectExpr("s_suppkey AS player_id", "s_name")
    raw = b.awards(t).join(names, "player_id").select(
        "date",
        "conference",
        F.when(F.col("player_id") % 2 == 0, F.regexp_replace("s_name", "#", " "))
        .otherwise(F.col("s_name"))
        .alias("player"),
    )
    listed = entities.standardise_awards(raw, "player", aliases(t), lookup(t))
    order = [F.desc("date"), "conference", "player_name"]
    return ordered.rank_rows(listed, [], order, "position")


@query(
    "ent_5",
    oracle("""
SELECT p_name AS name, COUNT(DISTINCT p_partkey) AS ids,
       MAX(CASE WHEN p_name IN (SELECT p_name FROM part WHERE p_size < 3) THEN 0 ELSE 1 END) AS unlisted
FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_partkey) > 1"""),
)
def ent_5(t):
    parts = t.part.selectExpr("p_name AS name", "p_partkey", "p_size")
    listed = parts.where("p_size < 3").selectExpr("name AS player_name")
    missing = entities.unresolved_names(parts, "name", listed).select("name", F.lit(1).alias("unlisted"))
    return (
        entities.ambiguous_names(parts, "name", "p_partkey")
        .join(missing, "name", "left")
        .select("name", "ids", F.coalesce("unlisted", F.lit(0)).alias("unlisted"))
    )
