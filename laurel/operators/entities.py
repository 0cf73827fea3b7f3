"""Entity resolution: names of several sources → canonical name and id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from laurel.functions.text import strip_accents
from laurel.operators import joins
from laurel.operators.ordered import top_rows
from laurel.session import BROADCAST_ROWS, broadcast_checked, stored_copy

# Ids whose listed name is shared by two players → the name that tells them apart.
DISTINGUISHED_NAMES = (
    (2399, "Mike Dunleavy Sr."),
    (76616, "Mike Dunleavy Jr."),
    (121, "Patrick Ewing Sr."),
    (201607, "Patrick Ewing Jr."),
    (779, "Glen Rice Sr."),
    (203318, "Glen Rice Jr."),
    (77144, "Eddie L. Johnson"),
    (698, "Eddie A. Johnson"),
    (77156, "Larry O. Johnson"),
    (913, "Larry D. Johnson"),
    (200848, "Steven A. Smith"),
    (120, "Steven D. Smith"),
    (2229, "Mike L. James"),
    (1628455, "Mike P. James"),
)


def resolve_names(names: DataFrame, name: str, aliases: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row per distinct `name`: canonical name and id.

    `aliases` has alias, canonical, id; `lookup` has player_id, player_name. The id comes from the
    lookup, else from the alias row, else from another alias row of the same canonical name. A name
    listed under several ids takes the smallest one.
    """
    distinct = (
        names.select(name).distinct().withColumn("_clean", strip_accents(F.col(name)))
    )
    by_alias = top_rows(aliases, ["alias"], [F.asc_nulls_last("id"), "canonical"], 1, "_r").select(
        F.col("alias").alias("_clean"), F.col("canonical").alias("_canonical"), F.col("id").alias("_alias_id")
    )
    by_canonical = aliases.groupBy(F.col("canonical").alias("player_name")).agg(F.min("id").alias("_canonical_id"))
    listed = (
        lookup.select("player_id", strip_accents(F.col("player_name")).alias("player_name"))
        .groupBy("player_name")
        .agg(F.min("player_id").alias("_lookup_id"))
    )
    return (
        distinct.join(by_alias, "_clean", "left")
        .withColumn("player_name", F.coalesce("_canonical", "_clean"))
        .join(listed, "player_name", "left")
        .join(by_canonical, "player_name", "left")
        .select(
            name,
            "player_name",
            F.coalesce("_lookup_id", "_alias_id", "_canonical_id").alias("player_id"),
        )
    )


def resolve_entities(
    df: DataFrame, name: str, aliases: DataFrame, lookup: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Replace `name` by player_id and player_name, in front of the other columns.

    Every distinct name is cleaned and resolved once, however often it occurs. Rows with a NULL name
    stay and get no id.
    """
    # Stored, so that the count and the resolution do not read the facts again.
    names = stored_copy(df.where(F.col(name).isNotNull()).select(name).distinct())
    resolved = resolve_names(names, name, aliases, lookup)
    rest = [c for c in df.columns if c != name]
    return df.join(broadcast_checked(resolved, max_rows, counted=names), name, "left").select(
        "player_id", "player_name", *rest
    )


def override_names(df: DataFrame, overrides: DataFrame, key="player_id", name="player_name") -> DataFrame:
    """Names replaced by those that `overrides` (key, name) lists for the id."""
    listed = overrides.select(key, F.col(name).alias("_listed"))
    joined = joins.dimension_join(df, listed, [key], "left")
    return joined.withColumn(name, F.coalesce("_listed", name)).drop("_listed").select(*df.columns)


def enrich_by_id(df: DataFrame, mapping: DataFrame, key: str, mapping_key: str) -> DataFrame:
    """Columns of the mapping beside each row; one mapping row per id, rows are never multiplied."""
    side = mapping.withColumnRenamed(mapping_key, key)
    return joins.dimension_join(df, side, [key], "left")


def standardise_awards(
    awards: DataFrame, name: str, aliases: DataFrame, lookup: DataFrame, order: Sequence[str] = ("conference",)
) -> DataFrame:
    """Resolved award list, newest award first."""
    resolved = resolve_entities(awards, name, aliases, lookup)
    return resolved.orderBy(F.desc("date"), *order, "player_name")


def ambiguous_names(df: DataFrame, name: str, key: str) -> DataFrame:
    """Names that stand for more than one id, with the number of ids."""
    return (
        df.groupBy(name).agg(F.count_distinct(key).alias("ids")).where(F.col("ids") > 1)
    )


def unresolved_names(df: DataFrame, name: str, lookup: DataFrame) -> DataFrame:
    """Distinct names that the lookup does not list, with their rows."""
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("rows"))
    return joins.unmatched(counts, lookup.select(F.col("player_name").alias(name)), [name])
