"""Aggregations, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from laurel.functions import dates, numbers
from laurel.operators.ordered import OrderedGroups, Prefix
from laurel.session import GROUP_ROWS, stored_copy

# A quantile sketch is off by one part in so many of its rows; it holds a few times as many values.
SKETCH_ACCURACY = 10_000


def roll_up(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str] = (),
    means: Sequence[str] = (),
    maxima: Sequence[str] = (),
    distinct: Mapping[str, str] | None = None,
    counts: Mapping[str, str] | None = None,
    bands: Mapping[str, Sequence[tuple[int, int | None]]] | None = None,
) -> DataFrame:
    """Grouped sums, means (`avg_x`), maxima, counts, exact distinct counts and banded counts in one pass."""
    columns = [
        *[F.count(c).alias(out) for out, c in (counts or {}).items()],
        *[F.count_distinct(c).alias(out) for out, c in (distinct or {}).items()],
        *[F.sum(c).alias(c) for c in sums],
        *[F.avg(c).alias(f"avg_{c}") for c in means],
        *[F.max(c).alias(c) for c in maxima],
        *[c for metric, ranges in (bands or {}).items() for c in band_counts(metric, ranges)],
    ]
    return df.groupBy(*keys).agg(*columns)


def band_counts(metric: str, ranges: Sequence[tuple[int, int | None]], prefix="games_w") -> list[Column]:
    """Rows whose `metric` lies in each closed range; `None` as upper end leaves the band open."""
    counts = []
    for low, high in ranges:
        value = F.col(metric)
        inside = value >= low if high is None else value.between(low, high)
        name = (
            f"{prefix}_{metric}_{low}_plus" if high is None else f"{prefix}_{metric}_between_{low}_{high}"
        )
        counts.append(F.sum(F.when(inside, 1).otherwise(0)).alias(name))
    return counts


def with_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """`{output: (part, whole)}` → part / whole, 0 where there is nothing to divide by."""
    return df.withColumns({out: numbers.safe_ratio(F.col(a), F.col(b)) for out, (a, b) in ratios.items()})


def shares(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Share of rows per group for which each 0/1 flag is set."""
    return df.groupBy(*keys).agg(*[F.avg(f).alias(f"share_{f}") for f in flags])


def frequencies(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Value counts, most frequent first; equal counts in value order."""
    counts = df.groupBy(column).count().orderBy(F.desc("count"), column)
    return counts if n is None else counts.limit(n)


def spans(df: DataFrame, key: str, date: str, name="span_years") -> DataFrame:
    """Years from the first to the last date of each key."""
    days = F.datediff(F.max(date), F.min(date))
    return df.groupBy(key).agg((days / 365).alias(name))


def compare_populations(df: DataFrame, label: str, metrics: Sequence[str]) -> DataFrame:
    """(metric, label, mean, std) for each value of `label`, one aggregation for all metrics."""
    wide = df.groupBy(label).agg(
        *[F.avg(m).alias(f"mean_{m}") for m in metrics],
        *[F.stddev_samp(m).alias(f"std_{m}") for m in metrics],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"), F.col(f"mean_{m}").alias("mean"), F.col(f"std_{m}").alias("std")
            )
            for m in metrics
        ]
    )
    return wide.select(label, F.inline(rows))


def side_by_side(df: DataFrame, label: str, metrics: Sequence[str]) -> DataFrame:
    """(metric, winners, others): mean of each metric for label 1 and label 0."""
    long = compare_populations(df, label, metrics)
    return long.groupBy("metric").agg(
        F.max(F.when(F.col(label) == 1, F.col("mean"))).alias("winners"),
        F.max(F.when(F.col(label) == 0, F.col("mean"))).alias("others"),
    )


def weekly_mean(df: DataFrame, key: str, date: str, value: str, name: str) -> DataFrame:
    """Mean per key and week; the week is labelled by its Sunday."""
    return df.groupBy(key, dates.week_end(F.col(date)).alias("week_end")).agg(F.avg(value).alias(name))


def label_counts(df: DataFrame, keys: Sequence[str], label: str, values: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows per label value as columns `n_<value>`, 0 where a group has none."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(label) == v).alias(f"n_{v}") for v in values])


def members(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Distinct members per group as a sorted array `members` and their number `size`; one row per group.

    For groups whose members fit one cell, such as rosters. `membership` answers questions about sets of
    any size without an array.
    """
    listed = F.sort_array(F.collect_list(member)).alias("members")
    return df.select(*keys, member).distinct().groupBy(*keys).agg(listed).withColumn("size", F.size("members"))


def membership(df: DataFrame, keys: Sequence[str], member: str, asked: Mapping[str, Sequence]) -> DataFrame:
    """Per group its number of distinct members `size` and, for each name in `asked`, whether any listed value is one.

    A plain aggregation: one row per group however many members it has.
    """
    flags = [F.coalesce(F.bool_or(F.col(member).isin(list(values))), F.lit(False)).alias(n) for n, values in asked.items()]
    return df.groupBy(*keys).agg(F.count_distinct(member).cast("int").alias("size"), *flags)


def summary(df: DataFrame, column: str) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of a whole column in one pass."""
    return df.agg(
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probabilities: Iterable[float],
    max_rows: int = GROUP_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group and probability.

    Two scans. A quantile sketch, merged from the tasks' own, brackets each percentile between two values of its
    group. The second scan counts what lies below a bracket and keeps the values inside it, about four in
    `accuracy` of the group, equal ones counted before the shuffle; only these are ordered. So neither the
    number of values nor a hot group decides what is shuffled or ranked. The sketch's error is bounded, and the
    ranks are counted: were a bracket to miss its percentile, the query would fail, never return a near value.
    Nulls and NaN are left out; groups without values have no row.
    """
    marks = sorted(set(map(float, probabilities)))
    kind = df.schema[column].dataType.typeName()
    values = df.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(column).alias("_v")).where("_v is not null")
    if kind in ("float", "double"):
        values = values.where(~F.isnan("_v"))
    own = [f"_key{i}" for i in range(len(keys))]
    # The sketch is off by a share 1 / accuracy of the rows at most.
    margin = 2 / accuracy
    asked = [F.lit(min(1.0, max(0.0, p + side))) for p in marks for side in (-margin, margin)]
    edges = F.percentile_approx("_v", F.array(*asked), F.lit(accuracy)).alias("_edges")
    sketch = values.groupBy(*own).agg(F.count(F.lit(1)).alias("_total"), edges)
    if keys:
        # Stored, so that its size is known when the join is planned.
        sketch = stored_copy(sketch.toDF(*[f"_g{i}" for i in range(len(keys))], "_total", "_edges"))
        on = reduce(lambda a, c: a & c, [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(own)])
        values = values.join(sketch, on)
    else:
        bounds = sketch.select(F.struct("_total", "_edges").alias("s")).scalar()
        values = values.withColumn("_s", bounds).select("_v", "_s._total", "_s._edges")
    # Side of each bracket that a value lies on: below, inside or above.
    sides = []
    for i, p in enumerate(marks):
        low, high = F.col("_edges")[2 * i], F.col("_edges")[2 * i + 1]
        side = F.when(F.col("_v") < low, -1).when(F.col("_v") > high, 1).otherwise(0)
        sides.append(F.struct(F.lit(p).alias("p"), side.alias("side")))
    sided = values.select(*own, "_v", "_total", F.explode(F.array(*sides)).alias("_x"))
    inside = F.when(F.col("_x.side") == 0, F.col("_v")).alias("_in")
    cells = sided.groupBy(*own, F.col("_x.p").alias("p"), F.col("_x.side").alias("_side"), inside).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.max("_total").alias("_total")
    )
    placed = OrderedGroups(stored_copy(cells), [*own, "p"], ["_side", "_in"], max_rows).add(Prefix("_before", "sum", F.col("_n"))).result()
    at = F.col("p") * (F.col("_total") - 1)
    last = F.col("_before") + F.col("_n") - 1

    def value_at(place: Column) -> Column:
        # Of the values below a bracket the last one is known, of those above it the first.
        held = (F.col("_before") <= place) & (last >= place)
        known = F.when(F.col("_side") == 0, F.col("_in")).when((F.col("_side") < 0) & (place == last), F.col("_most"))
        return F.max(F.when(held, known.when((F.col("_side") > 0) & (place == F.col("_before")), F.col("_least"))))

    ends = placed.groupBy(*own, "p").agg(
        value_at(F.floor(at)).alias("_lo"), value_at(F.ceil(at)).alias("_hi"), F.max(at - F.floor(at)).alias("_part")
    )
    between = F.col("_lo") + F.col("_part") * (F.col("_hi") - F.col("_lo"))
    found = F.when(F.col("_part") == 0, F.col("_lo")).otherwise(between)
    missed = F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double")
    return ends.select(
        *[F.col(k).alias(name) for k, name in zip(own, keys)], "p", F.coalesce(found.cast("double"), missed).alias("value")
    )


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, the balanced weight n / (k * n_c), and the ratio of negatives to positives."""
    return df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    ).select(
        "positives",
        "negatives",
        F.try_divide("negatives", "positives").alias("imbalance_ratio"),
        F.try_divide(F.col("positives") + F.col("negatives"), 2 * F.col("positives")).alias("weight_1"),
        F.try_divide(F.col("positives") + F.col("negatives"), 2 * F.col("negatives")).alias("weight_0"),
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name; missing columns are NULL."""
    return reduce(lambda a, c: a.unionByName(c, allowMissingColumns=True), frames)


def distinct_ids(column: str, *frames: DataFrame) -> DataFrame:
    """Distinct values of one column over several tables."""
    return reduce(lambda a, c: a.unionByName(c), [f.select(column) for f in frames]).distinct()


def missing_from(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of `left` that `right` lacks."""
    return left.select(*on).distinct().join(right.select(*on), list(on), "left_anti")


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One (metric, value) row per metric column."""
    return df.unpivot(list(ids), list(metrics), "metric", "value")
