"""Shards of near-equal bytes by sampled splitters."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from laurel.session import stored_copy

# Bytes that a record has besides its text.
RECORD_BYTES = 16


def sampled_splitters(keyed: DataFrame, ranges: int, per_range: int) -> np.ndarray:
    """Key boundaries of `ranges` ranges of about equal size, from a size-weighted sample.

    A record is drawn with a probability in proportion to its size, by a hash of its key and id, so reruns
    draw the same records. About ranges * per_range keys come to the driver, at every corpus size.
    """
    total = keyed.agg(F.sum("size")).first()[0]
    if not total:
        return np.empty(0, np.int64)
    chance = F.col("size") * F.lit(ranges * per_range / total)
    draw = F.pmod(F.xxhash64("key", "doc_id", F.lit("splitter")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = keyed.where(draw < chance).select("key").toPandas()["key"].to_numpy(np.int64)
    drawn.sort()
    if not len(drawn):
        return np.empty(0, np.int64)
    places = np.arange(1, ranges) * len(drawn) // ranges
    return np.unique(drawn[places])


def shard_records(
    documents: DataFrame, shards: int = 40, ranges_per_shard: int = 64, per_range: int = 16
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, and `row`, the input row.

    Law `bytes`: the shards' sizes are near equal. The key is a hash of the text, so equal texts, whatever
    their number, are neighbours in key order and in the same shard as long as they fit. Splitters drawn
    from a size-weighted sample cut the keys into many ranges; ranges larger than twice the aim are
    subdivided by a hash of the ids, and those parts in turn hold whole records. Copies of one text and one id
    (null or not) that are larger than such a part by themselves are told apart by numbers that are stored
    with the rows, so they spread as well. With the exact bytes of
    every range, ranges are dealt in order to the shard that holds the middle of their stretch of bytes,
    so a shard differs from the mean by about one range. Slots count from 0 in each shard, by range and
    then by (key, doc_id).

    Null and empty texts have size RECORD_BYTES and crc32 0; null and repeated ids are records like others;
    an empty table gives an empty one; further columns, whatever their names, are in `row`.
    """
    keyed = documents.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        F.struct("*").alias("row"),
        F.lit(0).cast("long").alias("copy"),
    )
    light = stored_copy(keyed.select("doc_id", "size", "key", "copy"))
    ranges = shards * ranges_per_shard
    splitters = sampled_splitters(light, ranges, per_range)

    @F.pandas_udf("int")
    def range_of(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for key in keys:
            yield pd.Series(np.searchsorted(splitters, key.to_numpy(np.int64), side="right").astype(np.int32))

    ranged = light.withColumn("range", range_of("key"))
    total = light.agg(F.sum("size")).first()[0] or 0
    aim = max(1, total // ranges)
    whole = ranged.groupBy("range").agg(F.sum("size").alias("bytes"))
    # An overfull range, such as one of a single hot text, is cut into as many parts as it needs.
    parts = whole.select("range", F.when(F.col("bytes") > 2 * aim, F.ceil(F.col("bytes") / F.lit(aim))).otherwise(F.lit(1)).alias("parts"))
    part = F.pmod(F.xxhash64("doc_id", "copy", F.lit("part")), F.col("parts")).cast("int")
    # One row per range: `ranges` of them at most, times the parts of overfull ones (twice as many in all).
    parts = F.broadcast(stored_copy(parts))
    repeated = ranged.join(parts.where("parts > 1"), "range").groupBy("key", "doc_id").agg(F.sum("size").alias("bytes"))
    if not repeated.where(F.col("bytes") > aim).isEmpty():
        # Ids do not tell these rows apart. Numbers do, once they are stored.
        keyed = stored_copy(keyed.withColumn("copy", F.monotonically_increasing_id()))
        ranged = keyed.select("doc_id", "size", "key", "copy").withColumn("range", range_of("key"))
    cut = ranged.join(parts, "range").withColumn("part", part)
    pieces = cut.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    order = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("ahead", F.coalesce(F.sum("bytes").over(order), F.lit(0)))
    middle = (F.col("ahead") + F.col("bytes") / 2) * F.lit(shards) / F.lit(max(1, total))
    pieces = pieces.withColumn("shard", F.least(F.floor(middle), F.lit(shards - 1)).cast("int"))
    within = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("range", "part", "shard", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("first_slot"))
    pieces = F.broadcast(stored_copy(pieces))
    full = keyed.withColumn("range", range_of("key")).join(parts, "range").withColumn("part", part)
    place = Window.partitionBy("range", "part").orderBy("key", "doc_id", "copy")
    full = full.withColumn("within", F.row_number().over(place) - 1).join(pieces, ["range", "part"])
    slot = (F.col("first_slot") + F.col("within")).cast("long").alias("slot")
    return full.select("doc_id", "size", "text_crc32", "shard", slot, "row")


def write_shards(records: DataFrame, path: str, shards: int = 40) -> None:
    """Write the input rows of `records` with shard and slot, one folder per shard, in slot order.

    The folders' column is `_shard` and the slots' `_slot`, with more underscores behind where a row has such a column.
    """
    fields = [f.lower() for f in records.schema["row"].dataType.names]
    shard, slot = (next(n for n in itertools.accumulate(itertools.repeat("_"), initial=c) if n not in fields) for c in ("_shard", "_slot"))
    out = records.select("row.*", F.col("shard").alias(shard), F.col("slot").alias(slot))
    out.repartitionByRange(shards, shard).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def numbered_records(documents: DataFrame, shards: int = 40) -> DataFrame:
    """`documents` with shard and slot; columns of theirs with those names give way."""
    taken = ("shard", "slot")
    held = [F.col(f"row.`{c}`") for c in documents.columns if c.lower() not in taken]
    return shard_records(documents, shards).select(*held, *taken)
