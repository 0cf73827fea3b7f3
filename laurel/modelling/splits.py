"""Train and test splits that do not leak: by season, by fold, stratified by class."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from laurel.operators import ordered
from laurel.session import broadcast_bounded


def season_split(
    df: DataFrame, season: int | None = None, column: str = "season"
) -> tuple[DataFrame, DataFrame]:
    """Rows of earlier seasons, and rows of that season; the newest one in the data if none is given."""
    if season is None:
        season = df.agg(F.max(column)).first()[0]
    return df.where(F.col(column) < season), df.where(F.col(column) == season)


def stratified_split(df: DataFrame, label: str, key: str, share: float = 0.8) -> DataFrame:
    """Column `part`: train for exactly `share` of each class, else test.

    Rows are taken in the order of a hash of their key, which repeats on every run.
    """
    ranked = ordered.rank_rows(
        df.withColumn("_h", F.md5(F.col(key).cast("string"))), [label], ["_h", key], "_rank"
    )
    # One row per class.
    sizes = df.groupBy(label).agg(F.floor(F.count(F.lit(1)) * share).alias("_take"))
    part = F.when(F.col("_rank") <= F.col("_take"), "train").otherwise("test")
    return (
        ranked.join(broadcast_bounded(sizes), label)
        .withColumn("part", part)
        .drop("_h", "_rank", "_take")
    )


def fold_sizes(df: DataFrame, folds: int = 5, column: str = "season") -> DataFrame:
    """Fold f validates on the f-th newest season and trains on all older ones: rows of both parts.

    The windows run over one row per season.
    """
    seasons = df.groupBy(column).agg(F.count(F.lit(1)).alias("validation_rows"))
    newest_first = Window.orderBy(F.desc(column))
    older = newest_first.rowsBetween(1, Window.unboundedFollowing)
    return (
        seasons.withColumns(
            {
                "fold": F.row_number().over(newest_first),
                "train_rows": F.coalesce(F.sum("validation_rows").over(older), F.lit(0)),
            }
        )
        .where(F.col("fold") <= folds)
        .select("fold", column, "train_rows", "validation_rows")
    )


def season_folds(
    df: DataFrame, folds: int = 5, column: str = "season"
) -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """(validation season, training rows, validation rows), newest season first."""
    newest = df.select(column).distinct().orderBy(F.desc(column)).limit(folds).collect()
    for (season,) in newest:
        yield (season, *season_split(df, season, column))


def standardise(
    train: DataFrame, columns: Sequence[str], *others: DataFrame
) -> tuple[DataFrame, ...]:
    """Scale columns by mean and population deviation of the training rows; constants become 0."""
    # One row of numbers, read once: each later scan of the scaled rows would sum the training rows again.
    stats = train.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()

    def scaled(df: DataFrame) -> DataFrame:
        m, s = ({c: F.lit(stats[f"{kind}_{c}"]).cast("double") for c in columns} for kind in "ms")
        return df.withColumns({c: F.when(s[c] > 0, (F.col(c) - m[c]) / s[c]).otherwise(F.lit(0.0)) for c in columns})

    return tuple(scaled(df) for df in (train, *others))
