"""Checked queries of aggregation (AGG), set operations (SET) and reshaping (RSH)."""

from __future__ import annotations

from pyspark.sql import functions as F

from laurel.catalog import bindings as b
from laurel.catalog.bindings import oracle
from laurel.catalog.registry import query
from laurel.operators import rollup
from laurel.operators.joins import member_flag, membership_flags
from laurel.operators.ranking import importance_summary
from laurel.plans.history import team_rows

WEEK_KEYS = ["player_id", "teamid", "season", "week_start"]
BANDS = {
    "points": [(0, 9), (10, 19), (20, 29), (30, 39), (40, 49), (50, 99), (100, None)],
    "assists": [(0, 2), (3, 5), (6, 9), (10, None)],
}
METRICS = ["points", "assists", "plus_minus", "minutes"]


def rounded(*columns, digits=6):
    return [F.round(c, digits).alias(c) for c in columns]


def labelled(t):
    """Player-weeks with label y (award of the week)."""
    won = b.awards(t).select("player_id", "week_start", F.lit(1).alias("y"))
    return b.player_weeks(t).join(won, ["player_id", "week_start"], "left").fillna({"y": 0})


LABELLED = """
SELECT pw.*, CASE WHEN b3.player_id IS NULL THEN 0 ELSE 1 END AS y
FROM pw LEFT JOIN b3 ON pw.player_id = b3.player_id AND pw.week_start = b3.week_start"""


@query(
    "agg_1",
    oracle("""
SELECT player_id, teamid, season, week_start, CAST(SUM(points) AS BIGINT) AS points,
       CAST(SUM(assists) AS BIGINT) AS assists, CAST(SUM(made) AS BIGINT) AS made,
       ROUND(AVG(plus_minus), 6) AS avg_plus_minus, MAX(minutes) AS minutes
FROM b2 GROUP BY player_id, teamid, season, week_start"""),
)
def agg_1(t):
    weeks = rollup.roll_up(
        b.box(t), WEEK_KEYS, sums=["points", "assists", "made"], means=["plus_minus"], maxima=["minutes"]
    )
    return weeks.withColumn("avg_plus_minus", F.round("avg_plus_minus", 6))


@query(
    "agg_2",
    oracle("SELECT teamid, week_start, COUNT(DISTINCT gameid) AS games FROM b2 GROUP BY teamid, week_start"),
)
def agg_2(t):
    return rollup.roll_up(b.box(t), ["teamid", "week_start"], distinct={"games": "gameid"})


def band_sql():
    columns = []
    for metric, ranges in BANDS.items():
        for low, high in ranges:
            test = f"{metric} >= {low}" if high is None else f"{metric} BETWEEN {low} AND {high}"
            name = f"{metric}_{low}_plus" if high is None else f"{metric}_between_{low}_{high}"
            columns.append(f"CAST(SUM(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS games_w_{name}")
    return ", ".join(columns)


@query("agg_3", oracle(f"SELECT player_id, week_start, {band_sql()} FROM b2 GROUP BY player_id, week_start"))
def agg_3(t):
    return rollup.roll_up(b.box(t), ["player_id", "week_start"], bands=BANDS)


@query(
    "agg_4",
    oracle("""
SELECT player_id, teamid, season, week_start, ROUND(COALESCE(made / NULLIF(attempted - 1, 0), 0), 6) AS pct
FROM pw"""),
)
def agg_4(t):
    weeks = b.player_weeks(t).withColumn("attempted", F.col("attempted") - 1)
    return rollup.with_ratios(weeks, {"pct": ("made", "attempted")}).select(*WEEK_KEYS, *rounded("pct"))


@query(
    "agg_5",
    oracle("""
SELECT p.player_id, p.teamid, p.season, p.week_start, p.points, q.team_points, q.team_games
FROM pw p JOIN (SELECT teamid, season, week_start, CAST(SUM(points) AS BIGINT) AS team_points,
                       COUNT(DISTINCT gameid) AS team_games FROM b2 GROUP BY teamid, season, week_start) q
  ON p.teamid = q.teamid AND p.season = q.season AND p.week_start = q.week_start"""),
)
def agg_5(t):
    keys = ["teamid", "season", "week_start"]
    team = rollup.roll_up(b.box(t), keys, sums=["points"], distinct={"team_games": "gameid"})
    return (
        b.player_weeks(t)
        .join(team.withColumnRenamed("points", "team_points"), keys)
        .select(*WEEK_KEYS, "points", "team_points", "team_games")
    )


@query(
    "agg_6",
    oracle("""
SELECT season, ROUND(SUM(mvp) / COUNT(*), 6) AS share_mvp, ROUND(SUM(star) / COUNT(*), 6) AS share_all_star
FROM (SELECT l.season, CASE WHEN rk = 1 THEN 1 ELSE 0 END AS mvp,
             CASE WHEN rk IS NULL THEN 0 ELSE 1 END AS star
      FROM labelled l LEFT JOIN b4 ON l.player_id = b4.player_id AND l.season = b4.season WHERE y = 1) q
GROUP BY season""", labelled=LABELLED),
)
def agg_6(t):
    lists = b.honours(t)
    winners = membership_flags(
        labelled(t).where("y = 1"),
        {"mvp": lists["mvp"], "all_star": lists["all_star"]},
        ["player_id", "season"],
    )
    return rollup.shares(winners, ["season"], ["mvp", "all_star"]).select(
        "season", *rounded("share_mvp", "share_all_star")
    )


@query(
    "agg_7",
    oracle("SELECT event_type, COUNT(*) AS count FROM events GROUP BY event_type ORDER BY 2 DESC, 1 LIMIT 3"),
)
def agg_7(t):
    return rollup.frequencies(t.events, "event_type", 3)


SPANS = """SELECT player_id, date_diff('day', MIN(date), MAX(date)) / 365 AS span_years FROM b3 GROUP BY player_id"""


@query(
    "agg_8",
    oracle("""
SELECT ROUND(AVG(span_years), 6) AS mean, ROUND(MEDIAN(span_years), 6) AS median,
       ROUND(MAX(span_years), 6) AS max, ROUND(MIN(span_years), 6) AS min FROM spans""", spans=SPANS),
)
def agg_8(t):
    spans = rollup.spans(b.awards(t), "player_id", "date")
    middle = rollup.percentiles(spans, [], "span_years", [0.5]).select(F.col("value").alias("median"))
    # Both sides are one-row aggregates.
    return (
        rollup.summary(spans, "span_years")
        .withColumn("median", middle.scalar())
        .select(*rounded("mean", "median", "max", "min"))
    )


@query(
    "agg_9",
    oracle(
        "SELECT metric, ROUND(winners, 6) AS winners, ROUND(others, 6) AS others FROM ("
        + " UNION ALL ".join(
            f"SELECT '{m}' AS metric, AVG(CASE WHEN y = 1 THEN {m} END) AS winners, "
            f"AVG(CASE WHEN y = 0 THEN {m} END) AS others FROM labelled"
            for m in METRICS
        )
        + ") q",
        labelled=LABELLED,
    ),
)
def agg_9(t):
    return rollup.side_by_side(labelled(t), "y", METRICS).select("metric", *rounded("winners", "others"))


@query(
    "agg_10",
    oracle("""
SELECT user_id, CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end, ROUND(AVG(value), 6) AS weekly_value
FROM events GROUP BY 1, 2"""),
)
def agg_10(t):
    return rollup.weekly_mean(t.events, "user_id", "ts", "value", "weekly_value").select(
        "user_id", "week_end", *rounded("weekly_value")
    )


@query(
    "agg_11",
    oracle("""
SELECT week_start, conference, COUNT(*) FILTER (y = 0) AS n_0, COUNT(*) FILTER (y = 1) AS n_1,
       ROUND(SUM(y) / COUNT(*), 6) AS rate FROM b9 GROUP BY week_start, conference"""),
)
def agg_11(t):
    counts = rollup.label_counts(b.labelled_weeks(t), ["week_start", "conference"], "y")
    return counts.withColumn("rate", F.round(F.col("n_1") / (F.col("n_0") + F.col("n_1")), 6))


@query(
    "agg_12",
    oracle("""
SELECT gameid, teamid, CAST(COUNT(DISTINCT player_id) AS INTEGER) AS size,
       string_agg(DISTINCT CAST(player_id AS VARCHAR), ',' ORDER BY CAST(player_id AS VARCHAR)) AS roster
FROM b2 GROUP BY gameid, teamid"""),
)
def agg_12(t):
    players = b.box(t).withColumn("player", F.col("player_id").cast("string"))
    return rollup.members(players, ["gameid", "teamid"], "player").select(
        "gameid", "teamid", "size", F.concat_ws(",", "members").alias("roster")
    )


@query(
    "agg_13",
    oracle("""
SELECT ROUND(AVG(points), 6) AS mean, ROUND(STDDEV_SAMP(points), 6) AS std, ROUND(MEDIAN(points), 6) AS median,
       MIN(points) AS min, MAX(points) AS max FROM b2"""),
)
def agg_13(t):
    rows = b.box(t)
    middle = rollup.percentiles(rows, [], "points", [0.5]).select("value")
    return (
        rollup.summary(rows, "points")
        .withColumn("median", middle.scalar())
        .select(*rounded("mean", "std", "median"), "min", "max")
    )


PERCENTS = [0.10, 0.25, 0.50, 0.75, 0.90]


@query(
    "agg_14",
    oracle(
        " UNION ALL ".join(
            f"SELECT teamid, CAST({p} AS DOUBLE) AS p, "
            f"ROUND(CAST(quantile_cont(points, {p}) AS DOUBLE), 6) AS value FROM b2 GROUP BY teamid"
            for p in PERCENTS
        )
    ),
)
def agg_14(t):
    return rollup.percentiles(b.box(t), ["teamid"], "points", PERCENTS).select("teamid", "p", *rounded("value"))


@query(
    "agg_15",
    oracle("""
SELECT player_id, total FROM (SELECT player_id, CAST(SUM(points) AS BIGINT) AS total FROM b2 GROUP BY player_id) q
WHERE total < (SELECT quantile_cont(total, 0.2) FROM
                 (SELECT SUM(points) AS total FROM b2 GROUP BY player_id) r)"""),
)
def agg_15(t):
    totals = b.box(t).groupBy("player_id").agg(F.sum("points").alias("total"))
    limit = rollup.percentiles(totals, [], "total", [0.2]).select("value")
    return totals.where(F.col("total") < limit.scalar())


@query("agg_16", oracle("SELECT week_start, conference, COUNT(*) AS size FROM b9 GROUP BY week_start, conference"))
def agg_16(t):
    return b.labelled_weeks(t).groupBy("week_start", "conference").agg(F.count(F.lit(1)).alias("size"))


@query(
    "agg_17",
    oracle("""
SELECT teamid AS feature, ROUND(AVG(points), 6) AS importance_mean,
       ROUND(STDDEV_POP(points), 6) AS importance_std
FROM (SELECT teamid, season, SUM(points) / 1000 AS points FROM b2 GROUP BY teamid, season) q GROUP BY teamid"""),
)
def agg_17(t):
    runs = (
        b.box(t)
        .groupBy(F.col("teamid").alias("feature"), F.col("season").alias("run"))
        .agg((F.sum("points") / 1000).alias("importance"))
    )
    return importance_summary(runs).select("feature", *rounded("importance_mean", "importance_std"))


@query(
    "agg_18",
    oracle("""
SELECT positives, negatives, ROUND(negatives / positives, 6) AS imbalance_ratio,
       ROUND((positives + negatives) / (2 * positives), 6) AS weight_1,
       ROUND((positives + negatives) / (2 * negatives), 6) AS weight_0
FROM (SELECT COUNT(*) FILTER (label = 0) AS positives, COUNT(*) FILTER (label <> 0) AS negatives
      FROM embeddings) q"""),
)
def agg_18(t):
    rows = t.embeddings.select((F.col("label") == 0).cast("int").alias("y"))
    return rollup.imbalance(rows, "y").select(
        "positives", "negatives", *rounded("imbalance_ratio", "weight_1", "weight_0")
    )


@query(
    "set_1",
    oracle("""
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST('customer' AS VARCHAR) AS source FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier"""),
)
def set_1(t):
    customers = t.customer.selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "'customer' AS source"
    )
    suppliers = t.supplier.selectExpr("s_acctbal AS balance", "s_suppkey AS id", "s_name AS name")
    return rollup.union_all(customers, suppliers)


@query("set_2", oracle("SELECT DISTINCT player_id FROM b4 WHERE rk <= 15"))
def set_2(t):
    lists = b.honours(t)
    return rollup.distinct_ids(
        "player_id", lists["first_team"], lists["second_team"], lists["third_team"]
    )


@query(
    "set_3",
    oracle("""
SELECT gameid, teamid, CAST(MAX(CASE WHEN player_id IN (SELECT player_id FROM b4 WHERE rk <= 15)
                                THEN 1 ELSE 0 END) AS INTEGER) AS has_elite
FROM b2 GROUP BY gameid, teamid"""),
)
def set_3(t):
    rows = member_flag(b.box(t), b.elites(t), "player_id", "elite")
    return rows.groupBy("gameid", "teamid").agg(F.max("elite").alias("has_elite"))


@query("set_4", oracle("SELECT DISTINCT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000"))
def set_4(t):
    left = t.customer.select(F.col("c_nationkey").alias("nation"))
    right = t.supplier.where("s_acctbal > 9000").select(F.col("s_nationkey").alias("nation"))
    return rollup.missing_from(left, right, ["nation"])


@query(
    "rsh_1",
    oracle("""
SELECT gameid, gamedate, team, teamid, opponent, opponentid, team_score, opp_score, winner,
       CAST(home AS INTEGER) AS home FROM sides"""),
)
def rsh_1(t):
    return team_rows(b.games(t))


@query(
    "rsh_2",
    oracle(
        " UNION ALL ".join(
            f"SELECT player_id, week_start, teamid, season, '{m}' AS metric, {m} AS value FROM pw" for m in METRICS
        )
    ),
)
def rsh_2(t):
    weeks = b.player_weeks(t).select(*WEEK_KEYS, *METRICS)
    return rollup.to_long(weeks, WEEK_KEYS, METRICS)
