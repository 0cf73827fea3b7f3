"""Record of each team going into every game (leakage-free: earlier games only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from laurel.functions import dates
from laurel.operators.ordered import OrderedGroups, Prefix
from laurel.session import GROUP_ROWS


@dataclass(frozen=True)
class GameColumns:
    """Column names of a two-sided game table; `game` is its primary key."""

    game: str = "gameid"
    date: str = "gamedate"
    home_team: str = "hometeamname"
    home_id: str = "hometeamid"
    away_team: str = "awayteamname"
    away_id: str = "awayteamid"
    home_score: str = "homescore"
    away_score: str = "awayscore"
    winner: str = "winner"


HISTORY_COLUMNS = (
    "gameid", "gamedate", "team", "teamid", "opponent", "opponentid", "outcome", "home",
    "team_score", "opp_score", "games_prior", "wins_prior", "losses_prior", "record_prior",
    "home_games_prior", "home_wins_prior", "home_losses_prior", "home_record_prior",
    "away_games_prior", "away_wins_prior", "away_losses_prior", "away_record_prior",
    "win_streak_prior", "home_win_streak_prior", "away_win_streak_prior",
    "opp_wins_prior", "opp_losses_prior", "opp_winrate_prior",
    "is_win_vs_over_500", "wins_vs_over_500_prior",
    "week_games_prior", "week_wins_prior", "week_losses_prior", "week_record_prior",
    "season", "week_start",
)


def team_rows(games: DataFrame, columns: GameColumns = GameColumns()) -> DataFrame:
    """Two rows per game, one for each side, from one scan of the games."""
    c = columns

    def side(team, team_id, opponent, opponent_id, score, other_score, home: int) -> Column:
        return F.struct(
            F.col(team).alias("team"),
            F.col(team_id).alias("teamid"),
            F.col(opponent).alias("opponent"),
            F.col(opponent_id).alias("opponentid"),
            F.col(score).alias("team_score"),
            F.col(other_score).alias("opp_score"),
            F.lit(home).alias("home"),
        )

    both = F.array(
        side(c.home_team, c.home_id, c.away_team, c.away_id, c.home_score, c.away_score, 1),
        side(c.away_team, c.away_id, c.home_team, c.home_id, c.away_score, c.home_score, 0),
    )
    return games.select(
        F.col(c.game).alias("gameid"),
        F.col(c.date).alias("gamedate"),
        F.col(c.winner).alias("winner"),
        F.explode(both).alias("side"),
    ).select("gameid", "gamedate", "side.*", "winner")


def with_flags(rows: DataFrame) -> DataFrame:
    """Outcome flags, season and week of team rows. A game without a winner counts as not won."""
    won = F.coalesce(F.col("teamid") == F.col("winner"), F.lit(False))
    return rows.withColumns(
        {
            "is_win": won.cast("int"),
            "is_home_win": (won & (F.col("home") == 1)).cast("int"),
            "is_away_win": (won & (F.col("home") == 0)).cast("int"),
            "season": dates.season_of(F.col("gamedate")),
            "week_start": dates.week_start(F.col("gamedate")),
        }
    )


# The week leads the order: it agrees with the date and lets week and season windows share one sort.
ORDER = ("week_start", "gamedate", "gameid")


def season_groups(rows: DataFrame, max_rows: int | None = GROUP_ROWS) -> OrderedGroups:
    return OrderedGroups(rows, ["teamid", "season"], ORDER, max_rows)


def other_side(value: str) -> Column:
    """Value of the other team's row of the same game (a game has two rows)."""
    game = Window.partitionBy("gameid")
    of_home = F.max(F.when(F.col("home") == 1, F.col(value))).over(game)
    of_away = F.max(F.when(F.col("home") == 0, F.col(value))).over(game)
    return F.when(F.col("home") == 1, of_away).otherwise(of_home)


def record(wins: str, losses: str) -> Column:
    return F.concat_ws("-", F.col(wins).cast("string"), F.col(losses).cast("string"))


def team_game_history(
    games: DataFrame,
    columns: GameColumns = GameColumns(),
    where: str | None = None,
    default_winrate: float | None = 0.5,
    max_rows: int | None = GROUP_ROWS,
) -> DataFrame:
    """Prior record, streaks, opponent strength and week record of both teams of every game.

    `where` is an optional filter on the game table. `default_winrate` replaces the unknown win rate
    of an opponent without earlier games, after the over-.500 flag is taken.
    """
    if where:
        games = games.where(where)
    groups = season_groups(with_flags(team_rows(games, columns)), max_rows)
    # First only what the other team's row needs: its lookup moves the rows twice, with few columns this way.
    groups.add(
        Prefix("games_prior", "count"),
        Prefix("wins_prior", "sum", F.col("is_win")),
    )
    groups.with_columns(
        {
            "opp_wins_prior": other_side("wins_prior"),
            "_opp_games": other_side("games_prior"),
        }
    )
    rate = F.try_divide(F.col("opp_wins_prior"), F.col("_opp_games"))
    groups.with_columns(
        {"is_win_vs_over_500": F.when((F.col("is_win") == 1) & (rate > 0.5), 1).otherwise(0)}
    )
    groups.add(
        Prefix("home_games_prior", "sum", F.col("home")),
        Prefix("home_wins_prior", "sum", F.col("is_home_win")),
        Prefix("away_wins_prior", "sum", F.col("is_away_win")),
        Prefix("wins_vs_over_500_prior", "sum", F.col("is_win_vs_over_500")),
    )
    groups.add_streaks(
        {
            "win_streak_prior": "is_win",
            "home_win_streak_prior": "is_home_win",
            "away_win_streak_prior": "is_away_win",
        }
    )
    groups.add(
        Prefix("week_games_prior", "count"),
        Prefix("week_wins_prior", "sum", F.col("is_win")),
        reset=["week_start"],
    )
    rows = groups.result().withColumns(
        {
            "opp_losses_prior": F.col("_opp_games") - F.col("opp_wins_prior"),
            "opp_winrate_prior": rate,
            "outcome": F.when(F.col("is_win") == 1, "win").otherwise("loss"),
            "losses_prior": F.col("games_prior") - F.col("wins_prior"),
            "home_losses_prior": F.col("home_games_prior") - F.col("home_wins_prior"),
            "away_games_prior": F.col("games_prior") - F.col("home_games_prior"),
            "week_losses_prior": F.col("week_games_prior") - F.col("week_wins_prior"),
        }
    )
    rows = rows.withColumn(
        "away_losses_prior", F.col("away_games_prior") - F.col("away_wins_prior")
    ).withColumns(
        {
            "record_prior": record("wins_prior", "losses_prior"),
            "home_record_prior": record("home_wins_prior", "home_losses_prior"),
            "away_record_prior": record("away_wins_prior", "away_losses_prior"),
            "week_record_prior": record("week_wins_prior", "week_losses_prior"),
        }
    )
    if default_winrate is not None:
        rows = rows.withColumn(
            "opp_winrate_prior", F.coalesce("opp_winrate_prior", F.lit(default_winrate))
        )
    return rows.select(*HISTORY_COLUMNS)
