"""Ranking metrics on scored groups: winner ranks, hit rates, margin loss, curves, ensembles.

A group is the set of candidates for one award. Its size is not bounded here: ranks come from
`ordered.rank_rows`, which cuts large groups into chunks, and no operator forms pairs of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import factorial, pi, sqrt
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from laurel.operators import ordered, rollup
from laurel.operators.ordered import OrderedGroups, Prefix
from laurel.session import GROUP_ROWS

# Bandwidths from a grid point beyond which a row adds less than 1e-17 of a kernel.
REACH = 9


def top_candidates(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], fields: Sequence[str], k: int = 5, name="top"
) -> DataFrame:
    """Best `k` rows per group as one array of structs, in rank order."""
    best = ordered.top_rows(df, keys, order, k)
    packed = F.sort_array(F.collect_list(F.struct("rank", *fields)))
    return best.groupBy(*keys).agg(packed.alias(name))


def winner_ranks(
    df: DataFrame,
    keys: Sequence[str],
    candidate: str,
    score: str = "score",
    label: str = "y",
    max_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Rank of each positive row in its group by falling score; equal scores by candidate."""
    order = [F.col(score).desc(), F.col(candidate).asc()]
    return ordered.rank_rows(df, keys, order, "rank", max_rows).where(F.col(label) == 1)


def hit_rates(
    df: DataFrame,
    keys: Sequence[str],
    candidate: str,
    ks: Sequence[int] = (1, 3, 5, 10),
    score: str = "score",
    label: str = "y",
    skip_groups_without_winner: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of groups whose winner is among the best k, for each k.

    Groups without a winner are skipped, or counted as a miss. `by` gives one row per value of
    columns that are part of `keys` (a model, a season).
    """
    best = winner_ranks(df, keys, candidate, score, label).groupBy(*keys).agg(F.min("rank").alias("rank"))
    if not skip_groups_without_winner:
        best = df.select(*keys).distinct().join(best, list(keys), "left")
    hits = [
        F.avg(F.when(F.col("rank") <= k, 1.0).otherwise(0.0)).alias(f"top_{k}_hit_rate") for k in ks
    ]
    return best.groupBy(*by).agg(F.count(F.lit(1)).alias("groups"), *hits)


def rank_summary(ranks: DataFrame, probabilities: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """(statistic, value): best, worst and mean winner rank, and percentiles of the ranks."""
    whole = ranks.agg(
        F.min("rank").cast("double").alias("best"),
        F.max("rank").cast("double").alias("worst"),
        F.avg("rank").alias("mean"),
    ).unpivot([], ["best", "worst", "mean"], "statistic", "value")
    marks = rollup.percentiles(ranks, [], "rank", probabilities).select(
        F.concat(F.lit("p"), F.round(F.col("p") * 100).cast("int").cast("string")).alias("statistic"), "value"
    )
    return whole.unionByName(marks)


def predictions(
    df: DataFrame, keys: Sequence[str], candidate: str, score: str = "score", label: str = "y"
) -> DataFrame:
    """Per group with a winner: actual winner, its rank, and the predicted winner."""
    order = [F.col(score).desc(), F.col(candidate).asc()]
    winners = ordered.top_rows(
        winner_ranks(df, keys, candidate, score, label), keys, [F.asc("rank")], 1, "_first"
    ).select(*keys, F.col(candidate).alias("actual_winner"), F.col("rank").alias("winner_rank"))
    predicted = ordered.top_rows(df, keys, order, 1, "_first").select(
        *keys, F.col(candidate).alias("predicted_winner")
    )
    return winners.join(predicted, list(keys))


def margin_loss(
    df: DataFrame,
    keys: Sequence[str],
    score: str = "score",
    label: str = "y",
    margin: float = 1.0,
    max_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Mean of max(0, margin - (winner - loser)) over all winner-loser pairs of a group.

    No pair is formed. Each winner asks for the count and sum of the losers scored above
    `winner - margin`; both are running totals over losers and questions in falling score order.
    Equal scores are folded into one row first.
    """
    value, is_winner = F.col(score), F.col(label) == 1
    points = (
        df.where(value.isNotNull() & F.col(label).isin(0, 1))
        .select(
            *keys,
            F.when(is_winner, value - margin).otherwise(value).alias("_at"),
            is_winner.cast("int").alias("_asks"),
        )
        .groupBy(*keys, "_at", "_asks")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_n", F.when(F.col("_asks") == 0, F.col("_rows")).otherwise(0))
    )
    # A loser at the very point of a question costs nothing, so the order among equals is free.
    totals = (
        OrderedGroups(points, keys, [F.desc("_at"), F.asc("_asks")], max_rows)
        .add(Prefix("_above", "sum", F.col("_n")), Prefix("_sum", "sum", F.col("_n") * F.col("_at")))
        .result()
    )
    cost = F.col("_rows") * (F.col("_sum") - F.col("_above") * F.col("_at"))
    per_group = totals.groupBy(*keys).agg(
        F.sum(F.when(F.col("_asks") == 1, cost)).alias("_loss"),
        (F.sum(F.col("_asks") * F.col("_rows")) * F.sum("_n")).alias("_pairs"),
    )
    return (
        per_group.where(F.col("_pairs") > 0)
        .agg(F.sum("_loss").alias("_loss"), F.sum("_pairs").alias("pairs"))
        .select("pairs", F.coalesce(F.try_divide("_loss", "pairs"), F.lit(0.0)).alias("margin_loss"))
    )


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Counts of the four outcomes with accuracy, precision, recall and F1 of class 1."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
    )


def roc_auc(df: DataFrame, score: str = "score", label: str = "y", max_rows: int = GROUP_ROWS) -> DataFrame:
    """Exact area under the ROC curve by the rank-sum formula; equal scores count half.

    Rows are counted per distinct score first.
    """
    counts = df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")
    )
    placed = OrderedGroups(counts, [], [score], max_rows).add(Prefix("_below", "sum", F.col("_n"))).result()
    return placed.agg(
        F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2)).alias("_u"),
        F.sum("_p").cast("double").alias("_pos"),
        F.sum("_n").alias("_neg"),
    ).select(F.try_divide(F.col("_u"), F.col("_pos") * F.col("_neg")).alias("auc"))


def ensemble(*scored: DataFrame, keys: Sequence[str], label: str = "y") -> DataFrame:
    """Mean score per row over the scored tables of several models."""
    return (
        rollup.union_all(*scored)
        .groupBy(*keys)
        .agg(F.avg("score").alias("score"), F.max(label).alias(label))
    )


def importance_summary(runs: DataFrame) -> DataFrame:
    """Mean and population deviation of each feature's importance over several models."""
    return runs.groupBy("feature").agg(
        F.avg("importance").alias("importance_mean"),
        F.stddev_pop("importance").alias("importance_std"),
    )


def low_importance(summary: DataFrame, share: float = 0.2) -> DataFrame:
    """Features whose mean importance lies below the given quantile."""
    limit = rollup.percentiles(summary, [], "importance_mean", [share]).select("value").scalar()
    return summary.where(F.col("importance_mean") < limit)


def _hermite(orders: int) -> list[list[float]]:
    """Coefficients of He_k(u) / k!, lowest power first, for k below `orders`."""
    rows = [[1.0], [0.0, 1.0]]
    for k in range(1, orders - 1):
        up, down = [0.0, *rows[k]], [*rows[k - 1], 0.0, 0.0]
        rows.append([a - k * b for a, b in zip(up, down)])
    return [[c / factorial(k) for c in row] for k, row in enumerate(rows[:orders])]


def density(df: DataFrame, value: str, points: int = 500, cells: int = 4, orders: int = 10) -> DataFrame:
    """Gaussian kernel density of a column on an even grid from its minimum to its maximum.

    Bandwidth is sd * n^(-1/5). Rows are summed up to moments about the middle of cells of a `cells`-th of the
    bandwidth; a cell then gives its part to the grid points within REACH bandwidths by the Hermite series of the
    kernel, which these moments cut below 1e-11 of a row's own part. So a task sends a row per cell, and there are
    about n^(1/5) * cells * range / sd of them, however many rows or values there are. Null values are left out; a
    column without spread has no density, and the result is empty.
    """
    v, s = F.col(value).cast("double"), F.col("_s")
    stats = df.agg(
        F.struct(
            F.min(v).alias("low"),
            F.max(v).alias("high"),
            F.count(v).alias("n"),
            (F.stddev_samp(v) * F.pow(F.count(v), F.lit(-0.2))).alias("h"),
        )
    ).scalar()
    # All places are in bandwidths from the minimum.
    place = (F.col("_v") - s["low"]) / s["h"]
    placed = (
        df.where(v.isNotNull()).select(v.alias("_v")).withColumn("_s", stats).where(s["h"] > 0)
        .select(place.alias("_v")).withColumn("_cell", F.floor(F.col("_v") * cells))
    )
    middle = (F.col("_cell") + 0.5) / cells
    moments = [F.sum(F.pow(F.col("_v") - middle, F.lit(k))).alias(f"_m{k}") for k in range(orders)]
    cells_of = placed.groupBy("_cell").agg(*moments).withColumn("_s", stats)
    series = _hermite(orders)
    powers = [reduce(add, (F.col(f"_m{k}") * row[j] for k, row in enumerate(series) if len(row) > j)) for j in range(orders)]
    spacing = (s["high"] - s["low"]) / s["h"] / (points - 1)
    near = F.sequence(
        F.greatest(F.ceil((middle - REACH) / spacing), F.lit(0)), F.least(F.floor((middle + REACH) / spacing), F.lit(points - 1))
    )
    # A grid coarser than the kernel has cells that are near none of its points.
    any_near = F.ceil((middle - REACH) / spacing) <= F.floor((middle + REACH) / spacing)
    shared = cells_of.where(any_near).select(
        F.explode(near).alias("point"), middle.alias("_middle"), spacing.alias("_spacing"), F.array(*powers).alias("_c")
    )
    u = F.col("_u")
    total = reduce(lambda acc, j: acc * u + F.col("_c")[j], range(orders - 2, -1, -1), F.col("_c")[orders - 1])
    sums = (
        shared.withColumn("_u", F.col("point") * F.col("_spacing") - F.col("_middle"))
        .groupBy("point").agg(F.sum(total * F.exp(-u * u / 2)).alias("_sum"))
    )
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point")).withColumn("_s", stats).where(s["h"] > 0)
    x = s["low"] + (s["high"] - s["low"]) * F.col("point") / (points - 1)
    height = F.greatest(F.coalesce("_sum", F.lit(0.0)), F.lit(0.0)) / (s["n"] * s["h"] * sqrt(2 * pi))
    return grid.join(sums.withColumn("point", F.col("point").cast("int")), "point", "left").select("point", x.alias("x"), height.alias("density"))


def density_peak(curve: DataFrame) -> DataFrame:
    """Grid value with the highest density (the lowest such value)."""
    return curve.agg(F.min_by("x", F.struct(-F.col("density"), "point")).alias("peak"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows per bin of equal width; the last bin holds the maximum."""
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    e = F.col("_e")
    share = F.try_divide(F.col(value) - e["low"], e["high"] - e["low"])
    bin_ = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
    return (
        df.where(F.col(value).isNotNull())
        .select(value)
        .withColumn("_e", ends)
        .groupBy(bin_.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
