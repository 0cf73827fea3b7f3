"""Join operators: dimensions, membership flags, opponents, lagged seasons, intervals, week buckets.

A side is broadcast only when it is counted to be small or bounded by construction. Larger sides are
joined by shuffle, where adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from laurel.operators import ordered
from laurel.session import BROADCAST_ROWS, broadcast_bounded, broadcast_checked


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner equi-join on a composite key; key columns appear once."""
    return left.join(right, list(on), "inner")


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left")


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    how: str = "left",
    prefer: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a dimension that may hold several rows per key, without multiplying facts.

    One row per key is kept: the first in the order of `prefer` (default: all other columns).
    """
    order = list(prefer) or [c for c in dimension.columns if c not in on]
    if order:
        one = ordered.top_rows(dimension, list(on), [F.asc(c) for c in order], 1, "_row").drop("_row")
    else:
        one = dimension.distinct()
    return facts.join(broadcast_checked(one, max_rows), list(on), how)


def salted_join(
    facts: DataFrame, other: DataFrame, on: Sequence[str], how: str = "left", salts: int = 16
) -> DataFrame:
    """Inner or left equi-join that spreads each key of `facts` over `salts` tasks.

    `other` is replicated `salts` times, so this suits a hot key on the fact side and a moderate
    other side that is too large to broadcast. The result equals the plain join.
    """
    # The partition id spreads equal rows, the hash spreads the rows of one partition; both repeat.
    spread = F.xxhash64(*facts.columns, F.spark_partition_id())
    salted = facts.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    copies = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def member_flag(df: DataFrame, ids: DataFrame, key: str, name: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """0/1 flag: is `key` one of `ids`?"""
    marked = ids.select(key).distinct().withColumn(name, F.lit(1))
    joined = df.join(broadcast_checked(marked, max_rows), key, "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(0)))


def membership_flags(
    df: DataFrame, lists: Mapping[str, DataFrame], on: Sequence[str], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """One 0/1 column per list, set where the list holds the row's key.

    The lists are folded into one table with one row per key, so the facts are joined once.
    """
    tagged = [entries.select(*on, F.lit(name).alias("_list")) for name, entries in lists.items()]
    folded = (
        reduce(lambda a, b: a.unionByName(b), tagged)
        .groupBy(*on)
        .agg(*[F.max((F.col("_list") == name).cast("int")).alias(name) for name in lists])
    )
    joined = df.join(broadcast_checked(folded, max_rows), list(on), "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(0)) for name in lists})


def opponent_join(
    rows: DataFrame, values: Sequence[str], game="gameid", team="teamid", opponent="opponentid", prefix="opp_"
) -> DataFrame:
    """Values of the opponent's row of the same game; NULL when that row is missing."""
    other = rows.select(
        game, F.col(team).alias(opponent), *[F.col(v).alias(f"{prefix}{v}") for v in values]
    )
    return rows.join(other, [game, opponent], "left")


def previous_season(
    df: DataFrame, key: str, season: str, values: Sequence[str], suffix="_last_season"
) -> DataFrame:
    """Values of season s under key s + 1, for those keys that also have a season s + 1."""
    distinct = df.select(key, season, *values).distinct()
    earlier = distinct.select(
        key,
        (F.col(season) + 1).alias(season),
        *[F.col(v).alias(f"{v}{suffix}") for v in values],
    )
    return earlier.join(df.select(key, season).distinct(), [key, season], "left_semi")


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `left` without a partner."""
    return left.join(right.select(*on), list(on), "left_anti")


def match_report(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of `left` with `matched` = both or left_only."""
    found = right.select(*on).distinct().withColumn("_hit", F.lit(True))
    return (
        left.select(*on)
        .distinct()
        .join(found, list(on), "left")
        .select(*on, F.when(F.col("_hit"), "both").otherwise("left_only").alias("matched"))
    )


def interval_join(
    df: DataFrame, rules: DataFrame, date: str, first: str, last: str, pick: str, priority: str
) -> DataFrame:
    """`pick` of the lowest-priority-number rule whose closed date range holds `date`, else NULL.

    Each rule is unfolded into its days and the best rule per day is kept, which turns the range
    condition into an equality. A range without a first or last day is open there; if there is one, or if the
    ranges span more than BROADCAST_ROWS days, they are cut to the dates of `df`. So the unfolded table has at
    most one row per calendar day of so many days, or of `df`. A range that ends before it begins holds no day.
    """
    opened = F.count_if(F.col(first).isNull() | F.col(last).isNull())
    low, high, days, opened = rules.agg(F.min(first), F.max(last), F.datediff(F.max(last), F.min(first)), opened).first()
    # Closed ranges over few enough days need no look at the dates of `df`.
    if opened or (days or 0) > BROADCAST_ROWS:
        low, high = df.agg(F.min(date), F.max(date)).first()
    ranges = rules.select(
        F.greatest(F.col(first), F.lit(low)).alias("_lo"), F.least(F.col(last), F.lit(high)).alias("_hi"), pick, priority
    ).where("_lo <= _hi")
    days = ranges.select(F.explode(F.sequence("_lo", "_hi")).alias(date), F.col(pick), F.col(priority))
    best = days.groupBy(date).agg(F.min_by(pick, priority).alias(pick))
    return df.join(broadcast_bounded(best), date, "left")


def plays_against(
    box: DataFrame,
    ids: DataFrame,
    name: str = "opponent_has_elite",
    game="gameid",
    team="teamid",
    opponent="opponentid",
    player="player_id",
) -> DataFrame:
    """Distinct (game, opponent) pairs whose roster holds one of `ids`, flagged 1.

    `opponent` here names the team that holds the player, as seen from the other side's rows.
    """
    holders = box.select(game, team, player).join(
        broadcast_checked(ids.select(player).distinct()), player, "left_semi"
    )
    return holders.select(game, F.col(team).alias(opponent)).distinct().withColumn(name, F.lit(1))
