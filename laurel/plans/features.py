"""Feature tables: player-game rows, player-week rows, breakout and league scores, honours, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from laurel.functions import numbers
from laurel.operators import cleaning, joins, ordered, rollup
from laurel.session import broadcast_bounded, broadcast_checked

WEEK_KEYS = ("player_id", "teamid", "season", "week_start")


def label_winners(
    rows: DataFrame, awards: DataFrame, conferences: DataFrame, name: str = "won_award"
) -> DataFrame:
    """Conference and 0/1 label of each row; rows of weeks without an award there are dropped.

    A tied award labels every named player and never doubles a row. A team that is listed in two
    conferences is a candidate in both. The small sides are counted before they are broadcast.
    """
    named = awards.select("week_start", "conference", "player_id").distinct()
    # One row per week and conference.
    open_weeks = named.select("week_start", "conference").distinct()
    winners = named.where(F.col("player_id").isNotNull()).withColumn(name, F.lit(1))
    pairs = conferences.select("teamid", "conference").distinct()
    return (
        rows.join(broadcast_checked(pairs), "teamid")
        .join(broadcast_bounded(open_weeks), ["week_start", "conference"], "left_semi")
        .join(broadcast_checked(winners), ["week_start", "conference", "player_id"], "left")
        .withColumn(name, F.coalesce(name, F.lit(0)))
    )


def elite_opponent(box: DataFrame, elites: DataFrame, win: str = "win") -> DataFrame:
    """Does the opponent field one of `elites`, and was that game won? One row per box row."""
    pairs = joins.plays_against(box, elites, "opponent_has_elite")
    return (
        box.join(pairs, ["gameid", "opponentid"], "left")
        .withColumn("opponent_has_elite", F.coalesce("opponent_has_elite", F.lit(0)))
        .withColumn(
            "win_vs_elite",
            F.when((F.col(win) == 1) & (F.col("opponent_has_elite") == 1), 1).otherwise(0),
        )
    )


def elite_opponent_by_result(
    box: DataFrame, games: DataFrame, elites: DataFrame, where: str | Column | None = None
) -> DataFrame:
    """Like `elite_opponent`, with opponent and result taken from the game table.

    `box` needs game, player and team only; `where` restricts the box rows.
    """
    if where is not None:
        box = box.where(where)
    sides = games.select("gameid", "hometeamid", "awayteamid", "winner")
    at_home = F.col("teamid") == F.col("hometeamid")
    rows = (
        box.select("gameid", "player_id", "teamid")
        .join(sides, "gameid", "left")
        .select(
            "gameid",
            "player_id",
            "teamid",
            F.when(at_home, F.col("awayteamid")).otherwise(F.col("hometeamid")).alias("opponentid"),
            F.coalesce(F.col("teamid") == F.col("winner"), F.lit(False)).cast("int").alias("win"),
        )
    )
    return elite_opponent(rows, elites)


def game_features(
    box: DataFrame,
    history: DataFrame,
    awards: DataFrame,
    honours: Mapping[str, DataFrame],
    conferences: DataFrame,
    elites: DataFrame,
    minutes: str = "minutes",
) -> DataFrame:
    """One row per player and game: box score, team record, honours, elite opponent, award label.

    Everything known per team and game is joined to the team rows first, so that the box scores pass
    one shuffle join only.
    """
    pairs = joins.plays_against(box, elites, "opponent_has_elite")
    team_side = history.drop("gamedate", "season", "week_start").join(
        pairs, ["gameid", "opponentid"], "left"
    )
    played = box.where(F.col(minutes).isNotNull()).drop("opponentid")
    rows = played.join(team_side, ["gameid", "teamid"])
    rows = label_winners(rows, awards, conferences)
    rows = joins.membership_flags(rows, honours, ["player_id", "season"])
    return rows.withColumns(
        {
            "opponent_has_elite": F.coalesce("opponent_has_elite", F.lit(0)),
            "win": (F.col("outcome") == "win").cast("int"),
            "win_vs_elite": F.when(
                (F.col("outcome") == "win") & (F.col("opponent_has_elite") == 1), 1
            ).otherwise(0),
        }
    )


# What the weekly table takes from the game rows besides the box-score sums.
WEEKLY_SUMS = ("win", "win_vs_elite", "is_win_vs_over_500", "opponent_has_elite")
WEEKLY_MEANS = ("opp_score", "opp_winrate_prior", "opp_wins_prior", "opp_losses_prior")
WEEKLY_MAXIMA = (
    "away_games_prior", "away_losses_prior", "away_win_streak_prior", "away_wins_prior",
    "home_games_prior", "home_losses_prior", "home_win_streak_prior", "home_wins_prior",
    "losses_prior", "wins_vs_over_500_prior", "won_award",
)


def weekly_features(
    features: DataFrame,
    stats: Sequence[str],
    honours: Sequence[str] = (),
    keys: Sequence[str] = (*WEEK_KEYS, "conference"),
    ratios: Mapping[str, tuple[str, str]] | None = None,
    bands: Mapping[str, Sequence[tuple[int, int | None]]] | None = None,
    unique_games: bool = False,
) -> DataFrame:
    """Roll-up of `game_features` per player, team and week, in one aggregation.

    `unique_games` states that a player has one row per game and team. Games are then counted
    instead of counted distinct, which saves a shuffle of the unaggregated rows.
    """
    weekly = rollup.roll_up(
        features,
        keys,
        sums=[*stats, *WEEKLY_SUMS],
        means=WEEKLY_MEANS,
        maxima=[*WEEKLY_MAXIMA, *honours],
        distinct=None if unique_games else {"games_played": "gameid"},
        counts={"games_played": "gameid"} if unique_games else None,
        bands=bands,
    )
    return rollup.with_ratios(weekly, ratios) if ratios else weekly


def breakout(
    weekly: DataFrame,
    weights: Mapping[str, float] = numbers.BREAKOUT_WEIGHTS,
    keys: Sequence[str] = ("player_id", "season"),
    order: Sequence[str] = ("week_start", "teamid"),
) -> DataFrame:
    """Z-scores against the player's own earlier weeks of the season, and their weighted sum.

    The first week of a season has no history and is dropped. A group holds one row per week and
    team of one season, so the window needs no size check.
    """
    metrics = list(weights)
    rows = ordered.history_stats(weekly, keys, order, metrics).dropna(
        subset=[f"{metrics[0]}_mean_season"]
    )
    rows = rows.withColumns(
        {
            f"z_{m}": numbers.z_score(F.col(m), F.col(f"{m}_mean_season"), F.col(f"{m}_std_season"))
            for m in metrics
        }
    )
    return rows.withColumn(
        "breakout_score", numbers.composite({f"z_{m}": w for m, w in weights.items()})
    )


def league_stats(weekly: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of each metric, under the season after the one it was taken from."""
    return weekly.groupBy((F.col("season") + 1).alias("season")).agg(
        *[F.avg(m).alias(f"league_{m}_mean") for m in metrics],
        *[F.stddev_samp(m).alias(f"league_{m}_std") for m in metrics],
    )


def league_normalise(
    weekly: DataFrame, metrics: Sequence[str] = ("points", "assists", "plus_minus")
) -> DataFrame:
    """Z-scores against the whole league of the previous season; 0 where there is none.

    The league table holds one row per season, which bounds the broadcast.
    """
    rows = weekly.join(broadcast_bounded(league_stats(weekly, metrics)), "season", "left")
    return rows.withColumns(
        {
            f"z_s_{m}": F.coalesce(
                F.try_divide(F.col(m) - F.col(f"league_{m}_mean"), F.col(f"league_{m}_std")), F.lit(0.0)
            )
            for m in metrics
        }
    )


def team_share_features(
    box: DataFrame,
    stats: Sequence[str] = ("points", "assists"),
    history: Sequence[str] = ("points", "assists", "plus_minus"),
    minutes: str = "minutes",
    plus_minus: str = "plus_minus",
    own: Sequence[str] = (),
) -> DataFrame:
    """Player-week sums beside the team's sums of the week, with the player's earlier weeks.

    `own` are further columns that are summed for the player only. Weeks without history are dropped.
    """
    team_keys = ["teamid", "season", "week_start"]
    team = box.groupBy(*team_keys).agg(
        *[F.sum(s).alias(f"team_{s}") for s in stats],
        F.count_distinct("gameid").alias("team_games"),
    )
    sums = dict.fromkeys([minutes, *stats, *history, *own])
    player = box.groupBy(*WEEK_KEYS).agg(
        F.count_distinct("gameid").alias("games"),
        *[F.sum(c).alias(c) for c in sums],
        F.avg(plus_minus).alias(f"{plus_minus}_mean"),
    )
    rows = player.join(team, team_keys)
    rows = ordered.history_stats(rows, ["player_id", "season"], ["week_start", "teamid"], history)
    return rows.dropna(subset=[f"{history[0]}_mean_season"])


def game_type(
    season: Column, date: Column, listed: Column, current_season: int, opening_day: str
) -> Column:
    """Listed type for past seasons; in the current season games before `opening_day` are preseason."""
    return (
        F.when(season < current_season, listed)
        .when(date < F.lit(opening_day).cast("date"), "Preseason")
        .otherwise("Regular Season")
    )


def win_pct_features(
    weekly: DataFrame,
    team_games: DataFrame,
    game_types: DataFrame,
    current_season: int,
    opening_day: str,
) -> DataFrame:
    """Mean and spread of the running regular-season win rate of the week, joined to `weekly`.

    `team_games` holds team, game, date, season, week and win per box row; it is reduced to one row
    per team and game. Weeks without regular-season games take the mean over all rows.
    """
    games = (
        team_games.select("gameid", "gamedate", "teamid", "season", "week_start", "win")
        .distinct()
        .join(game_types, "gameid")
        .where(
            game_type(
                F.col("season"), F.col("gamedate"), F.col("gametype"), current_season, opening_day
            )
            == "Regular Season"
        )
    )
    running = ordered.running_average(
        games, ["teamid", "season"], ["week_start", "gamedate", "gameid"], "win", "win_pct"
    )
    per_week = running.groupBy("teamid", "season", "week_start").agg(
        F.avg("win_pct").alias("avg_win_pct_this_week"),
        (F.max("win_pct") - F.min("win_pct")).alias("win_pct_spread_this_week"),
    )
    joined = weekly.join(per_week, ["teamid", "season", "week_start"], "left")
    return cleaning.fill_with_mean(joined, ["avg_win_pct_this_week", "win_pct_spread_this_week"])


def prior_season_honours(
    rows: DataFrame, player_seasons: DataFrame, honours: Mapping[str, DataFrame]
) -> DataFrame:
    """Honours of the previous season as 0/1 columns of each row."""
    seasons = player_seasons.select("player_id", "season").distinct()
    flagged = joins.membership_flags(seasons, honours, ["player_id", "season"])
    earlier = joins.previous_season(flagged, "player_id", "season", list(honours))
    names = [f"{h}_last_season" for h in honours]
    return rows.join(earlier, ["player_id", "season"], "left").fillna(0, subset=names)


def placeholder_awards(awards: DataFrame, as_of: str) -> DataFrame:
    """Awards plus one open row (no player) per conference for each week not yet awarded by `as_of`.

    At least one week is opened. Dates follow the last award in steps of a week.
    """
    last = awards.agg(F.max("date")).scalar()
    days = F.datediff(F.lit(as_of).cast("date"), F.col("_last"))
    weeks = F.greatest(numbers.ceil_div(days, 7), F.lit(1)).cast("int")
    open_rows = (
        awards.select("conference")
        .distinct()
        .withColumn("_last", last)
        .withColumn("_k", F.explode(F.sequence(F.lit(1), weeks)))
        .select(
            F.lit(None).cast(awards.schema["player_id"].dataType).alias("player_id"),
            "conference",
            F.date_add("_last", (F.col("_k") - 1) * 7).alias("week_start"),
            F.date_add("_last", F.col("_k") * 7).alias("date"),
        )
    )
    return rollup.union_all(awards, open_rows)


def player_game_history(
    history: DataFrame, box: DataFrame, awards: DataFrame, max_rows: int | None = None
) -> DataFrame:
    """Team games with the award players who took part in the week of their award, and the player's
    games and wins before each game, per season and per week.

    Games without an award player stay, with a NULL player; they form one group, which is as large
    as the table and is cut into chunks like any other large group.
    """
    named = awards.where(F.col("player_id").isNotNull()).select("player_id", "week_start").distinct()
    took_part = (
        box.where("minutes > 0")
        .select("gameid", "teamid", "player_id", "week_start", "season")
        .join(broadcast_checked(named), ["player_id", "week_start"])
        .select("gameid", "teamid", "player_id", "season", F.col("week_start").alias("award_week"))
    )
    rows = (
        history.drop("season", "week_start")
        .join(took_part, ["gameid", "teamid"], "left")
        .withColumn("player_played", F.col("player_id").isNotNull().cast("int"))
        .withColumn(
            "player_win",
            F.when((F.col("player_played") == 1) & (F.col("outcome") == "win"), 1).otherwise(0),
        )
    )
    groups = ordered.OrderedGroups(
        rows,
        ["player_id", "season"],
        ["award_week", "gamedate", "gameid", "teamid"],
        max_rows or ordered.GROUP_ROWS,
    )
    played, won = F.col("player_played"), F.col("player_win")
    groups.add(
        ordered.Prefix("player_games_season_prior", "sum", played),
        ordered.Prefix("player_wins_season_prior", "sum", won),
    ).add(
        ordered.Prefix("player_games_week_prior", "sum", played),
        ordered.Prefix("player_wins_week_prior", "sum", won),
        reset=["award_week"],
    )
    return groups.result()
