"""Mixing sources to target weights by systematic sampling; DataFrame operations only."""

from __future__ import annotations

import math
import random
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from laurel.session import stored_copy

# Documents of equal source and size are ranked together if their ids differ in these low bits only.
ID_BITS = 20


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Target of each source from its `source_size`, as (source, source_size, target).

    Sources by code point, null last, weigh `cycle` in turn and share the sum of all sizes; a target stops
    at `most` times its source's size and the excess is shared again by weight. That fixed point is a
    water level: target = min(cap, level * weight). Sources are put in the order of cap / weight, and the
    level is the first one that the next source's ratio does not undercut. `sizes` has one row per source,
    which bounds the windows without keys.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    place = (F.row_number().over(by_name) - 1) % len(cycle)
    ranked = sizes.withColumn("weight", F.get(weights, place)).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").isNull(), F.encode("source", "utf-8"))
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))),
    )
    reached = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    level = F.first(reached, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return filled.withColumn("water", level).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("cap"), F.col("water") * F.col("weight")), F.col("cap")).alias("target"),
    )


def group_starts(groups: DataFrame) -> DataFrame:
    """Number of documents ahead of each (source, size, span) group in the order of (size, span) in its source.

    `groups` has n, the documents of each group. A prefix sum in two steps, so that no window grows with
    the documents of a source: over its different sizes, then over the id spans of one size.
    """
    sizes = groups.groupBy("source", "size").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("source", "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("smaller")).alias("s")
    spans = Window.partitionBy("source", "size").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    ahead = groups.withColumn("ahead", F.coalesce(F.sum("n").over(spans), F.lit(0))).alias("g")
    same = F.col("g.source").eqNullSafe(F.col("s.source")) & (F.col("g.size") == F.col("s.size"))
    start = (F.col("ahead") + F.col("smaller")).alias("start")
    return ahead.join(sizes, same).select("g.source", "g.size", "g.span", start)


GROUP_KEYS = ("_no_source", "_source", "_size", "_no_span", "_span")


def _group_keys(source: Column, size: Column, span: Column) -> list[Column]:
    """Source, size and id span as GROUP_KEYS, none of which is null."""
    values = (source.isNull(), F.coalesce(source, F.lit("")), size, span.isNull(), F.coalesce(span, F.lit(0)))
    return [v.alias(k) for v, k in zip(values, GROUP_KEYS)]


def mixed_copies(
    documents: DataFrame, cycle: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken, and `row`, the input row.

    Every document of a source expects target / source_size copies. With the expected copies summed in the
    order of (size, doc_id) and one random offset added, a document is taken once for each whole number
    that its stretch of the sum crosses. In that order neighbours have like sizes, so the words taken of a
    source are close to its target, and no document is taken more than ceil(expected) times.

    Null texts and texts without words have size 0 and count as documents; a null source is a source of its
    own, the last; a source without words has target 0 and gives no copies; null ids are ranked first and
    repeated ids by a hash of their texts; equal rows are interchangeable. An empty table gives an empty
    one. Further columns, whatever their names, are in `row`. Reruns agree: the offset comes from `seed`.
    The table is read twice: for the counts, which are stored, and for the result.
    """
    docs = documents.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.shiftright("doc_id", ID_BITS).alias("span"),
        F.xxhash64("text").alias("tie"),
        F.struct("*").alias("row"),
    )
    groups = stored_copy(docs.groupBy("source", "size", "span").agg(F.count("*").alias("n")))
    sizes = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, cycle, most).alias("t")
    # Targets join the groups, so that rows with their texts never meet by source alone.
    starts = group_starts(groups).alias("s").join(targets, F.col("s.source").eqNullSafe(F.col("t.source")))
    starts = starts.select("s.*", "source_size", "target")
    # Window and join have the same keys without nulls, so the rows with their texts are shuffled once.
    docs = docs.select(*_group_keys(F.col("source"), F.col("size"), F.col("span")), "*")
    starts = starts.select(*_group_keys(F.col("source"), F.col("size"), F.col("span")), "start", "source_size", "target").alias("g")
    # At most 2 ** ID_BITS documents with different ids meet in one window.
    inside = Window.partitionBy(*GROUP_KEYS).orderBy("doc_id", "tie")
    placed = docs.withColumn("within", F.row_number().over(inside)).alias("d")
    same = reduce(lambda a, b: a & b, [F.col(f"d.{k}") == F.col(f"g.{k}") for k in GROUP_KEYS])
    out = placed.join(starts, same)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("start") + F.col("within")
    offset = F.lit(random.Random(seed).random())
    crossed = F.floor(rate * place + offset) - F.floor(rate * (place - 1) + offset)
    copies = F.least(F.greatest(crossed, F.lit(0)), F.lit(math.ceil(most))).cast("long")
    out = out.select("d.doc_id", "d.size", "g.source_size", "g.target", copies.alias("copies"), "d.row")
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def mix(documents: DataFrame, cycle: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with the columns of `documents`."""
    counted = mixed_copies(documents, cycle, most, seed).where("copies > 0")
    repeated = counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select("row.*")
