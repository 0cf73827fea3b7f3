"""Ordered operators: running totals, prior values, streaks and ranks per group.

Every operator takes a total order. Groups whose rows fit one task are done with a plain window.
Groups that do not fit are found by a count and cut into ordered chunks by a range repartition on
(keys, order); each chunk is scanned on its own and receives the totals of the chunks before it, so
one hot key never ends up in one task and no row is left out. A table without keys is one group and
is always cut, without a count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from laurel.session import BROADCAST_ROWS, GROUP_ROWS, stored_copy

CHUNK = "_chunk"


@dataclass(frozen=True)
class Prefix:
    """One running value: `kind` is sum, count or max; `current` includes the row itself."""

    name: str
    kind: str
    value: Column | None = None
    current: bool = False


def _aggregate(prefix: Prefix) -> Column:
    if prefix.kind == "count":
        return F.count(F.lit(1)) if prefix.value is None else F.count(prefix.value)
    return {"sum": F.sum, "max": F.max}[prefix.kind](prefix.value)


def _same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)], F.lit(True))


class OrderedGroups:
    """Rows of `df` per `keys` in the total order `order`; `add` appends running values."""

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str | Column],
        max_rows: int | None = GROUP_ROWS,
    ):
        """`max_rows=None` states that group sizes are bounded by construction (no check)."""
        self.keys = list(keys)
        self.order = [F.col(c) if isinstance(c, str) else c for c in order]
        self.order_names = [c if isinstance(c, str) else None for c in order]
        # Rows of groups that fit one task (None if all are cut), and the rows of the large groups.
        self.df: DataFrame | None = df
        self.hot: DataFrame | None = None
        self._hot_is_stored = False
        self._whole: DataFrame | None = None
        self.chunked = False
        if max_rows is None:
            return
        if not self.keys:
            self._cut_everything()
            return
        counts = df.groupBy(*self.keys).count().where(F.col("count") > max_rows)
        large, rows = counts.agg(F.count("count"), F.sum("count")).first()
        if large:
            self._cut(counts.drop("count"), large, max(2, ceil(2 * rows / max_rows)))

    def _cut_everything(self) -> None:
        """Cut a table without keys; adaptive execution decides how many ranges its size needs."""
        chunks = int(self.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.carry_is_small = chunks <= BROADCAST_ROWS
        self._store_chunks(self.df.repartitionByRange(*self.order))
        self.df = None

    def _cut(self, large_keys: DataFrame, large: int, parts: int) -> None:
        """Separate the rows of large groups and give them chunk numbers; all other rows have chunk -1."""
        self.carry_is_small = large + parts <= BROADCAST_ROWS
        # At most (all rows / max_rows) keys, written so that both joins see the same list.
        listed = stored_copy(large_keys.toDF(*[f"_h{i}" for i in range(len(self.keys))]))
        if large <= BROADCAST_ROWS:
            listed = F.broadcast(listed)
        on = _same_keys(
            [self.df[k] for k in self.keys], [listed[f"_h{i}"] for i in range(len(self.keys))]
        )
        hot = self.df.join(listed, on, "left_semi")
        self.df = self.df.join(listed, on, "left_anti").withColumn(CHUNK, F.lit(-1))
        self._store_chunks(
            hot.repartitionByRange(parts, *[F.col(k) for k in self.keys], *self.order)
        )

    def _store_chunks(self, ranged: DataFrame) -> None:
        """Number the ranges. The written copy freezes the chunk of a row: bounds come from a sample."""
        self.chunked = True
        self.hot = stored_copy(ranged.withColumn(CHUNK, F.spark_partition_id()))
        self._hot_is_stored = True

    def _union(self) -> DataFrame:
        return self.hot if self.df is None else self.df.unionByName(self.hot)

    def with_columns(self, columns: dict[str, Column]) -> OrderedGroups:
        """Append columns; their windows may span rows of large and of other groups."""
        if self.chunked:
            whole = self._union() if self._whole is None else self._whole
            self._whole = whole.withColumns(columns)
        else:
            self.df = self.df.withColumns(columns)
        return self

    def _store_hot(self) -> None:
        """Before a scan the rows of large groups are a written table, so that plans do not nest."""
        if self._whole is not None:
            whole = stored_copy(self._whole)
            self._whole = None
            if self.df is not None:
                self.df = whole.where(F.col(CHUNK) < 0)
            self.hot = whole.where(F.col(CHUNK) >= 0)
        elif not self._hot_is_stored:
            self.hot = stored_copy(self.hot)

    def add(self, *prefixes: Prefix, reset: Sequence[str] = ()) -> OrderedGroups:
        """Append running values; they restart at every new value of the `reset` columns."""
        keys = self.keys + list(reset)
        if self.chunked:
            self._store_hot()
            self.hot = self._chunked_scan(keys, prefixes)
            self._hot_is_stored = False
        if self.df is not None:
            self.df = self.df.withColumns(self._window_columns(keys, prefixes, fill=True))
        return self

    def add_streaks(self, flags: dict[str, str]) -> OrderedGroups:
        """`{output: 0/1 column}` → number of consecutive ones that end at the previous row.

        With S the prior sum of the flag, the streak is S minus the largest S seen at an earlier
        zero, because S does not fall along the order.
        """
        self.add(*[Prefix(f"_s_{out}", "sum", F.col(flag)) for out, flag in flags.items()])
        self.add(
            *[
                Prefix(f"_z_{out}", "max", F.when(F.col(flag) == 0, F.col(f"_s_{out}")))
                for out, flag in flags.items()
            ]
        )
        streaks = {
            out: (F.col(f"_s_{out}") - F.coalesce(F.col(f"_z_{out}"), F.lit(0))).cast("bigint") for out in flags
        }
        helpers = [f"{p}{out}" for out in flags for p in ("_s_", "_z_")]
        if self.df is not None:
            self.df = self.df.withColumns(streaks).drop(*helpers)
        if self.hot is not None:
            self.hot = self.hot.withColumns(streaks).drop(*helpers)
        return self

    def result(self) -> DataFrame:
        if not self.chunked:
            return self.df
        return (self._union() if self._whole is None else self._whole).drop(CHUNK)

    def _window_columns(self, keys, prefixes, fill: bool) -> dict[str, Column]:
        # A reset column is constant inside its window; left out of the order, the windows with and
        # without it need the same sort.
        order = [c for name, c in zip(self.order_names, self.order) if name not in keys]
        window = Window.partitionBy(*keys).orderBy(*(order or self.order))
        columns = {}
        for p in prefixes:
            frame = window.rowsBetween(Window.unboundedPreceding, 0 if p.current else -1)
            value = _aggregate(p).over(frame)
            columns[p.name] = F.coalesce(value, F.lit(0)) if fill and p.kind == "sum" else value
        return columns

    def _chunked_scan(self, keys, prefixes) -> DataFrame:
        chunk_keys = [*keys, CHUNK]
        rows = self.hot.withColumns(self._window_columns(chunk_keys, prefixes, fill=False))
        earlier = (
            Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        )
        totals = self.hot.groupBy(*chunk_keys).agg(
            *[_aggregate(p).alias(f"_t{i}") for i, p in enumerate(prefixes)]
        )
        # One row per chunk and group of the large keys: the window sees few rows per group.
        carry = totals.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(chunk_keys)],
            *[
                (F.max if p.kind == "max" else F.sum)(f"_t{i}").over(earlier).alias(f"_c{i}")
                for i, p in enumerate(prefixes)
            ],
        )
        if self.carry_is_small and keys == self.keys:
            carry = F.broadcast(carry)
        on = _same_keys(
            [rows[k] for k in chunk_keys], [carry[f"_k{i}"] for i in range(len(chunk_keys))]
        )
        merged = {}
        for i, p in enumerate(prefixes):
            here, before = F.col(p.name), F.col(f"_c{i}")
            merged[p.name] = (
                F.greatest(here, before)
                if p.kind == "max"
                else F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
            )
        helpers = [f"_k{i}" for i in range(len(chunk_keys))] + [f"_c{i}" for i in range(len(prefixes))]
        return rows.join(carry, on, "left").withColumns(merged).drop(*helpers)


def prior_count(df, keys, order, name="games_prior", max_rows=GROUP_ROWS) -> DataFrame:
    """0-based position of a row in its group."""
    return OrderedGroups(df, keys, order, max_rows).add(Prefix(name, "count")).result()


def prior_sum(df, keys, order, sums: dict[str, str], reset=(), max_rows=GROUP_ROWS) -> DataFrame:
    """`{output: column}` → sum over the earlier rows of the group, 0 on the first row."""
    prefixes = [Prefix(out, "sum", F.col(column)) for out, column in sums.items()]
    return OrderedGroups(df, keys, order, max_rows).add(*prefixes, reset=reset).result()


def prior_streak(df, keys, order, flags: dict[str, str], max_rows=GROUP_ROWS) -> DataFrame:
    """`{output: 0/1 column}` → run of ones that ends just before the row."""
    return OrderedGroups(df, keys, order, max_rows).add_streaks(flags).result()


def running_average(df, keys, order, value: str, name: str, max_rows=GROUP_ROWS) -> DataFrame:
    """Average of `value` from the start of the group up to and including the row."""
    return (
        OrderedGroups(df, keys, order, max_rows)
        .add(
            Prefix("_sum", "sum", F.col(value), current=True),
            Prefix("_n", "count", F.col(value), current=True),
        )
        .result()
        .withColumn(name, F.try_divide(F.col("_sum").cast("double"), F.col("_n")))
        .drop("_sum", "_n")
    )


def rank_rows(df, keys, order, name="rank", max_rows=GROUP_ROWS) -> DataFrame:
    """1-based rank of every row of its group in a total order."""
    return OrderedGroups(df, keys, order, max_rows).add(Prefix(name, "count", current=True)).result()


def top_rows(df, keys, order, k: int, name="rank") -> DataFrame:
    """Best `k` rows per group. Spark keeps only `k` rows per group and task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def history_stats(
    df, keys, order, columns: Sequence[str], suffix="season", max_rows: int | None = None
) -> DataFrame:
    """Mean and population deviation of each column over the earlier rows; NULL on the first row.

    Period roll-ups have at most one row per period and team of a season and need no size check
    (`max_rows=None`). With a limit, larger groups are done from the merged moments of chunks.
    """
    groups = OrderedGroups(df, keys, order, max_rows)
    if groups.df is not None:
        frame = (
            Window.partitionBy(*keys).orderBy(*groups.order).rowsBetween(Window.unboundedPreceding, -1)
        )
        stats = {}
        for c in columns:
            stats[f"{c}_mean_{suffix}"] = F.avg(c).over(frame)
            stats[f"{c}_std_{suffix}"] = F.stddev_pop(c).over(frame)
        groups.df = groups.df.withColumns(stats)
    if groups.chunked:
        groups.hot = _merged_stats(groups, columns, suffix)
    return groups.result()


def _merged_moments(a: Column, b: Column) -> Column:
    """Count, mean and summed square deviation of two parts together, from those of each."""
    n = a["n"] + b["n"]
    away = b["mean"] - a["mean"]
    mean = a["mean"] + F.try_divide(away * b["n"], n)
    m2 = a["m2"] + b["m2"] + F.try_divide(away * away * a["n"] * b["n"], n)
    zero = F.lit(0.0)
    return F.struct(n.alias("n"), F.coalesce(mean, zero).alias("mean"), F.coalesce(m2, zero).alias("m2"))


def _moments(c: str, over: Window | None = None) -> Column:
    """Moments of a column, 0 without values: aggregated, or over a window."""
    place = (lambda x: x.over(over)) if over is not None else (lambda x: x)
    n, mean, spread = place(F.count(c)), place(F.avg(c)), place(F.var_pop(c))
    zero = F.lit(0.0)
    return F.struct(
        n.cast("double").alias("n"), F.coalesce(mean, zero).alias("mean"), F.coalesce(spread * n, zero).alias("m2")
    )


def _merged_stats(groups: OrderedGroups, columns: Sequence[str], suffix: str) -> DataFrame:
    """`history_stats` of the rows of groups that are cut into chunks.

    Moments of the earlier rows of a row's chunk are merged with those of the earlier chunks; no squares of
    the values themselves are summed, so large values with a small spread keep their deviation.
    """
    chunk_keys = [*groups.keys, CHUNK]
    before = Window.partitionBy(*chunk_keys).orderBy(*groups.order).rowsBetween(Window.unboundedPreceding, -1)
    rows = groups.hot.withColumns({f"_m_{c}": _moments(c, before) for c in columns})
    totals = groups.hot.groupBy(*chunk_keys).agg(*[_moments(c).alias(f"_t_{c}") for c in columns])
    earlier = Window.partitionBy(*groups.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    none = F.struct(*[F.lit(0.0).alias(x) for x in ("n", "mean", "m2")])
    carry = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(chunk_keys)],
        # One entry per earlier chunk of the group.
        *[F.aggregate(F.collect_list(f"_t_{c}").over(earlier), none, _merged_moments).alias(f"_c_{c}") for c in columns],
    )
    on = _same_keys([rows[k] for k in chunk_keys], [carry[f"_k{i}"] for i in range(len(chunk_keys))])
    joined = rows.join(carry, on, "left")
    stats = {}
    for c in columns:
        moments = _merged_moments(F.coalesce(F.col(f"_c_{c}"), none), F.col(f"_m_{c}"))
        some = moments["n"] > 0
        stats[f"{c}_mean_{suffix}"] = F.when(some, moments["mean"])
        stats[f"{c}_std_{suffix}"] = F.when(some, F.sqrt(moments["m2"] / moments["n"]))
    helpers = [f"_k{i}" for i in range(len(chunk_keys))] + [f"{p}{c}" for c in columns for p in ("_m_", "_c_")]
    return joined.withColumns(stats).drop(*helpers)


def number_groups(df, keys, name="group_id", max_rows=GROUP_ROWS) -> DataFrame:
    """0-based number of each distinct key tuple in key order, joined back to the rows.

    NULL keys get a number too. The distinct keys are numbered, never the rows.
    """
    distinct = df.select(*keys).distinct()
    numbered = OrderedGroups(distinct, [], list(keys), max_rows).add(Prefix(name, "count")).result()
    small = numbered.select(*[F.col(k).alias(f"_n_{k}") for k in keys], name)
    on = _same_keys([df[k] for k in keys], [small[f"_n_{k}"] for k in keys])
    return df.join(small, on, "inner").drop(*[f"_n_{k}" for k in keys])
