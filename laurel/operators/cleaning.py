"""Column selection, conforming, conditional columns, encoding, filters and NULL handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from laurel.operators.ordered import OrderedGroups, Prefix, top_rows


def conform(df: DataFrame, schema: T.StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, lower-case all names, cast to `schema` (bad values → NULL), keep its columns in order."""
    named = df.withColumnsRenamed(dict(renames or {}))
    named = named.toDF(*[c.lower() for c in named.columns])
    return named.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def keys_first(df: DataFrame, keys: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Drop columns and move the keys to the front."""
    rest = [c for c in df.columns if c not in keys and c not in drop]
    return df.select(*keys, *rest)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; an unknown condition gives 0."""
    return F.when(condition, 1).otherwise(0)


def choose(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first case that holds."""
    result = F.lit(default)
    for condition, value in reversed(list(cases)):
        result = F.when(condition, value).otherwise(result)
    return result


def one_hot(
    df: DataFrame, vocabulary: Mapping[str, Sequence[object]], drop_first: bool = False
) -> DataFrame:
    """Replace each column by 0/1 columns, one for each value of its vocabulary (training values).

    Values outside the vocabulary give all zeros; values that do not occur give a zero column.
    """
    dummies = [
        F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in vocabulary.items()
        for v in (values[1:] if drop_first else values)
    ]
    return df.select(*[c for c in df.columns if c not in vocabulary], *dummies)


def vocabulary(df: DataFrame, columns: Sequence[str], max_values: int = 1000) -> dict[str, list]:
    """Sorted distinct values per category column; refuses columns that are no categories."""
    found = {}
    for c in columns:
        values = [r[0] for r in df.select(c).distinct().limit(max_values + 1).collect()]
        if len(values) > max_values:
            raise ValueError(f"column {c} has more than {max_values} values: use index_category")
        found[c] = sorted(v for v in values if v is not None)
    return found


def index_category(df: DataFrame, column: str, name: str) -> DataFrame:
    """0-based code of each value in value order; NULL for NULL. Codes are given to distinct values."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    coded = OrderedGroups(values, [], [column]).add(Prefix(name, "count")).result()
    return df.join(coded, column, "left")


def fill_with_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULL by the mean of the column over the whole table (a one-row aggregate)."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return (
        df.withColumn("_means", means)
        .withColumns({c: F.coalesce(F.col(c), F.col(f"_means.{c}")) for c in columns})
        .drop("_means")
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column and rows with any NULL, in one pass."""
    columns = list(columns or df.columns)
    any_null = F.array_contains(F.array(*[F.col(c).isNull() for c in columns]), True)
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
        F.count_if(any_null).alias("rows_with_null"),
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in a total order (repeatable, unlike dropping any duplicate)."""
    return top_rows(df, list(keys), list(order), 1, "_row").drop("_row")
