"""The two published feature tables from the raw basketball feeds.

`game_table` gives one row per player, game and eligible conference, `weekly_table` its weekly
roll-up with breakout and league scores. Both are lazy plans over the generic operators; this module
only knows the feeds' column names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from laurel.functions import dates, text
from laurel.modelling.models import NOT_FEATURES
from laurel.operators import cleaning
from laurel.plans import features, league_values as v
from laurel.plans.history import GameColumns, team_game_history
from laurel.session import broadcast_bounded
from laurel.sources.tables import read_literal

ELITE_LISTS = ("first_team", "second_team", "third_team")


def teams(spark: SparkSession) -> DataFrame:
    return read_literal(spark, v.TEAMS, "team string, conference string, team_nickname string")


def clean_games(raw: DataFrame) -> DataFrame:
    """Raw games: the timestamp is parsed leniently into `gamedate`, names become lower case."""
    dated = raw.withColumn("gamedate", dates.parse_timestamp(F.col("gameDateTimeEst")).cast("date"))
    return dated.drop("gameDateTimeEst").toDF(
        *[c.lower() for c in dated.columns if c != "gameDateTimeEst"]
    )


def clean_player_statistics(raw: DataFrame) -> DataFrame:
    """Raw box scores: full name, integer ids and counts; rows without a player are dropped."""
    return (
        raw.where(F.col("personId").isNotNull())
        .withColumns(
            {
                "full_name": F.concat("firstName", F.lit(" "), "lastName"),
                "player_id": F.col("personId").cast("bigint"),
                "gamedate": dates.parse_timestamp(F.col("gameDateTimeEst")).cast("date"),
                **{c: F.col(c).cast("int") for c in v.COUNTS},
            }
        )
        .drop("personId", "gameDateTimeEst")
    )


def clean_honours(
    all_stars: DataFrame, mvp: DataFrame, first: DataFrame, second: DataFrame, third: DataFrame
) -> dict[str, DataFrame]:
    """Season lists as (player_id, season). All-star lists name the year after the season's start."""
    by_text = {"mvp": mvp, "first_team": first, "second_team": second, "third_team": third}
    return {
        "all_star": all_stars.select(
            F.col("player_id").cast("bigint").alias("player_id"),
            (F.col("Selection Year") - 1).cast("int").alias("season"),
        ),
        **{
            name: df.select(
                F.col("player_id").cast("bigint").alias("player_id"),
                dates.season_of_text(F.col("Season")).alias("season"),
            )
            for name, df in by_text.items()
        },
    }


def clean_awards(awards: DataFrame, spark: SparkSession) -> DataFrame:
    """Awards with the conference of the winner's team and the Monday of the awarded week."""
    conference = teams(spark).select("team", F.col("conference").alias("_conference"))
    return awards.join(broadcast_bounded(conference), "team").select(
        "player_id",
        "player",
        F.col("_conference").alias("conference"),
        "date",
        dates.award_week_start(F.col("date")).alias("week_start"),
    )


def award_list(rows: DataFrame) -> DataFrame:
    """Dated awards from the rows of an award page (see `sources.pages.extract_award_rows`).

    Month names become numbers, the year follows from the season text, and names are spelled as the
    player list spells them.
    """
    month = dates.month_number(F.col("month"))
    year = dates.award_year(F.col("season"), month)
    day = text.last_word(F.col("date")).try_cast("int")
    name = text.listed_name(F.col("player"))
    return rows.select(
        "season",
        F.make_date(year, month, day).alias("date"),
        year.alias("year"),
        month.alias("month"),
        day.alias("day"),
        "conference",
        name.alias("player"),
        "tie",
    ).withColumn("week", dates.iso_week(F.col("date")))


def game_table(
    games: DataFrame,
    statistics: DataFrame,
    awards: DataFrame,
    honours: Mapping[str, DataFrame],
    since: str = "1979-01-01",
    extended: bool = False,
) -> DataFrame:
    """Player-game features. Inputs come from the `clean_*` functions.

    `extended` adds the honours of the season before.
    """
    spark = games.sparkSession
    conferences = teams(spark).select(F.col("team_nickname").alias("teamid"), "conference")
    history = team_game_history(games, GameColumns(), where=f"gamedate >= '{since}'").withColumnsRenamed(
        {"teamid": "team_number", "opponentid": "opponent_number", "team": "teamid", "opponent": "opponentid"}
    )
    box = statistics.select(
        F.col("gameId").alias("gameid"),
        "gamedate",
        F.col("playerteamName").alias("teamid"),
        F.col("opponentteamName").alias("opponentid"),
        "player_id",
        "firstName",
        "lastName",
        "full_name",
        "numMinutes",
        *v.COUNTS,
        *v.PERCENTAGES,
        dates.season_by_rules(F.col("gamedate"), v.SEASON_RANGES).alias("season"),
        dates.week_start(F.col("gamedate")).alias("week_start"),
    ).where(F.col("season").isNotNull())
    elite = honours[ELITE_LISTS[0]]
    for name in ELITE_LISTS[1:]:
        elite = elite.unionByName(honours[name])
    rows = features.game_features(
        box, history, awards, honours, conferences, elite.select("player_id"), minutes="numMinutes"
    )
    # The award of the row's week and conference, one row for each.
    winners = awards.groupBy("week_start", "conference").agg(
        F.min("player_id").alias("pow_player_id"),
        F.min("player").alias("player_of_the_week"),
        F.min(F.date_sub("date", 1)).alias("pow_last_date_of_week"),
    )
    rows = rows.join(broadcast_bounded(winners), ["week_start", "conference"]).withColumns(
        {
            "day": F.dayofmonth("gamedate"),
            "week": dates.iso_week(F.col("gamedate")),
            "month": F.month("gamedate"),
            "year": F.year("gamedate"),
            "pow_conference": F.col("conference"),
            "team_nickname": F.col("teamid"),
        }
    )
    rows = with_team_shares(rows, conferences)
    if extended:
        rows = features.prior_season_honours(rows, box, honours).withColumnsRenamed(v.PRIOR_HONOUR_COLUMNS)
    return rows


def with_team_shares(rows: DataFrame, conferences: DataFrame) -> DataFrame:
    """Weekly sums of player and team beside each game row; first weeks of a season are dropped."""
    # A team of two conferences has each game row twice; the sums take one of them.
    one = conferences.groupBy("teamid").agg(F.min("conference").alias("conference"))
    single = rows.join(broadcast_bounded(one), ["teamid", "conference"], "left_semi")
    shares = features.team_share_features(
        single,
        stats=("points", "assists", "blocks", "steals"),
        history=("points", "assists", "plusMinusPoints"),
        minutes="numMinutes",
        plus_minus="plusMinusPoints",
        own=("win",),
    )
    names = {
        "games": "gms",
        "numMinutes": "min_sum",
        "points": "pts_sum",
        "assists": "ast_sum",
        "blocks": "blk_sum",
        "steals": "stl_sum",
        "plusMinusPoints": "pm_sum",
        "plusMinusPoints_mean": "pm_mean",
        "win": "wins",
        "team_points": "team_pts",
        "team_assists": "team_ast",
        "team_blocks": "team_blk",
        "team_steals": "team_stl",
        "team_games": "team_gms",
        "points_mean_season": "pts_sum_mean_season",
        "points_std_season": "pts_sum_std_season",
        "assists_mean_season": "ast_sum_mean_season",
        "assists_std_season": "ast_sum_std_season",
        "plusMinusPoints_mean_season": "pm_sum_mean_season",
        "plusMinusPoints_std_season": "pm_sum_std_season",
    }
    return rows.join(shares.withColumnsRenamed(names), list(features.WEEK_KEYS)).withColumnsRenamed(
        {
            "won_award": "won_player_of_the_week",
            "opponent_has_elite": "opponent_has_all_nba",
            "win_vs_elite": "wins_vs_team_with_all_nba_player",
            **v.HONOUR_COLUMNS,
        }
    )


def weekly_table(
    game_rows: DataFrame,
    prior_honours: Mapping[str, DataFrame] | None = None,
    extended: bool = False,
    played: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Weekly features of `game_table` with percentages, breakout and league scores.

    `extended` adds the banded game counts; `prior_honours` adds the honours of the season before;
    `played`, the cleaned games and box scores, adds the team's running win rate of the week.
    """
    prior = list(v.PRIOR_HONOUR_COLUMNS.values())
    inner = game_rows.drop(*prior).withColumnsRenamed(
        {
            "won_player_of_the_week": "won_award",
            "opponent_has_all_nba": "opponent_has_elite",
            "wins_vs_team_with_all_nba_player": "win_vs_elite",
        }
    )
    team_sums = ["team_pts", "team_ast", "team_blk", "team_stl", "team_gms"]
    keys = [
        "player_id", "full_name", "teamid", "season", "week", "week_start", "conference", "pow_conference",
    ]
    weekly = features.weekly_features(
        inner,
        stats=["numMinutes", *v.COUNTS],
        honours=[*v.HONOUR_COLUMNS.values(), *team_sums, "pow_player_id", "player_of_the_week"],
        keys=keys,
        ratios=v.PERCENTAGES,
        bands=v.BANDS if extended else None,
    )
    weekly = features.breakout(weekly, v.BREAKOUT, order=("week_start", "teamid", "conference"))
    weekly = features.league_normalise(weekly, list(v.BREAKOUT))
    if prior_honours:
        weekly = features.prior_season_honours(weekly, inner, prior_honours).withColumnsRenamed(v.PRIOR_HONOUR_COLUMNS)
    if played:
        weekly = with_win_rates(weekly, *played)
    return weekly.withColumnsRenamed(
        {
            "teamid": "team",
            "games_played": "games_played_this_week",
            "win": "wins_this_week",
            "won_award": "won_player_of_the_week",
            "opponent_has_elite": "opponent_has_all_nba",
            "win_vs_elite": "wins_vs_team_with_all_nba_player",
            "z_points": "z_pts",
            "z_assists": "z_ast",
            "z_plusMinusPoints": "z_pm",
            "z_s_points": "z_s_pts",
            "z_s_assists": "z_s_ast",
            "z_s_plusMinusPoints": "z_s_pm",
        }
    )


def with_win_rates(weekly: DataFrame, games: DataFrame, statistics: DataFrame) -> DataFrame:
    """Mean and spread in the week of the team's running win rate over regular-season games."""
    team_games = statistics.select(
        F.col("gameId").alias("gameid"),
        "gamedate",
        F.col("playerteamName").alias("teamid"),
        dates.season_by_rules(F.col("gamedate"), v.SEASON_RANGES).alias("season"),
        dates.week_start(F.col("gamedate")).alias("week_start"),
        "win",
    ).where(F.col("season").isNotNull())
    rows = features.win_pct_features(
        weekly, team_games, games.select("gameid", "gametype"), v.CURRENT_SEASON, v.OPENING_DAY
    )
    return rows.withColumnsRenamed(v.WIN_RATE_COLUMNS)


def write_tables(game_rows: DataFrame, weekly: DataFrame, folder: str) -> None:
    """Both tables under their published names; the game rows are split by season."""
    game_rows.write.mode("overwrite").partitionBy("season").parquet(f"{folder}/features-overall")
    weekly.write.mode("overwrite").parquet(f"{folder}/features-overall-weekly")


def training_matrix(weekly: DataFrame, values: Mapping[str, list] | None = None) -> tuple[DataFrame, dict[str, list]]:
    """Weekly rows without id, answer and end-of-season columns, team and conference one-hot coded.

    The vocabulary comes back so that later rows get the same columns.
    """
    categories = ["team", "conference"]
    values = dict(values or cleaning.vocabulary(weekly, categories))
    rows = weekly.drop(*[c for c in NOT_FEATURES if c in weekly.columns and c != "won_player_of_the_week"])
    return cleaning.one_hot(rows, values), values
