"""Structured Streaming forms: incremental ingest, weekly aggregates, running totals kept as state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from laurel.operators.ordered import OrderedGroups, Prefix
from laurel.session import GROUP_ROWS, stored_copy

# Keys of running sums are dealt to so many buckets; a bucket is copied together at so many folders of rows.
BUCKETS = 64
MOST_FOLDERS = 16


def read_new_files(
    spark: SparkSession, folder: str, schema, glob: str | None = None, file_format: str = "parquet", files_per_batch: int = 100
) -> DataFrame:
    """Stream over the files of a folder; each file is read once, over all runs."""
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def ingest(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything new to the `target` table and stop; a later run takes up from there."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _week(time: str) -> Column:
    # Windows are laid out from 1970-01-01, a Thursday: four days later is a Monday.
    return F.window(time, "7 days", "7 days", "4 days")


def _totals(rows: DataFrame, time: str, keys: Sequence[str], value: str) -> DataFrame:
    return (
        rows.groupBy(_week(time).alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total"))
        .select(F.col("window.start").cast("date").alias("week_start"), *keys, "rows", "total")
    )


def weekly_totals(stream: DataFrame, time: str, keys: Sequence[str], value: str, delay: str) -> DataFrame:
    """Count and sum per key and Monday-to-Sunday week, for live streams.

    A row more than `delay` behind the newest row of an earlier batch is dropped. A backlog whose files come in
    no order of time has such rows however punctual they were: load it with `add_weekly_totals`.
    """
    return _totals(stream.withWatermark(time, delay), time, keys, value)


def keep_updates(aggregated: DataFrame, target: str, checkpoint: str) -> int:
    """Write the changed groups of every micro-batch below `target`, then stop.

    A batch that is repeated after a failure replaces its own folder. Returns how many partial groups the
    watermark dropped, over the batches whose progress the session remembers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    query = (
        aggregated.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def latest(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Current value of every group that `keep_updates` wrote: that of its last batch."""
    updates = spark.read.parquet(target)
    values = [c for c in updates.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch").alias("_v")
    return updates.groupBy(*keys).agg(newest).select(*keys, "_v.*")


def add_weekly_totals(
    stream: DataFrame, time: str, keys: Sequence[str], value: str, target: str, checkpoint: str
) -> None:
    """Add the weekly totals of each micro-batch to those below `target`, whatever the order of the rows.

    A batch writes the counts and sums of its own rows to its own folder, which a repeated batch replaces.
    Nothing is held as state, so no row can be too late. `summed_totals` reads the result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _totals(batch, time, keys, value).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def summed_totals(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Weekly totals over all batches of `add_weekly_totals`."""
    parts = spark.read.parquet(target)
    return parts.groupBy("week_start", *keys).agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


class _Index:
    """Which folders of a running-sums table are in force after a batch: for each bucket its state and its rows.

    One row per bucket and folder, written with every batch; what a batch put out of force is listed once more, as
    dead, and deleted when the next batch begins, so that a repeated batch finds all that it read.
    """

    SCHEMA = "buckets int, bucket int, kind string, folder int, live boolean"

    def __init__(self, spark: SparkSession, target: str, batch_id: int, buckets: int):
        self.spark, self.target, self.buckets = spark, target, buckets
        self.state: dict[int, int] = {}
        self.rows: dict[int, list[int]] = {}
        self.dead: list[tuple[int, str, int]] = []
        if batch_id < 0:
            return
        for row in spark.read.schema(self.SCHEMA).parquet(f"{target}/index/batch={batch_id}").collect():
            if row.buckets != buckets:
                raise ValueError(f"the table has {row.buckets} buckets, not {buckets}")
            if not row.live:
                self.dead.append((row.bucket, row.kind, row.folder))
            elif row.kind == "state":
                self.state[row.bucket] = row.folder
            else:
                self.rows.setdefault(row.bucket, []).append(row.folder)

    def delete_dead(self, batch_id: int) -> None:
        """Remove what the batch before put out of force, and older indexes."""
        paths = [f"{self.target}/{kind}/batch={folder}/_bucket={bucket}" for bucket, kind, folder in self.dead]
        paths.append(f"{self.target}/index/batch={batch_id - 2}")
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for path in map(jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(conf).delete(path, True)
        self.dead = []

    def put(self, kind: str, bucket: int, batch_id: int, alone: bool) -> None:
        """A folder of this batch comes into force, `alone` in place of the earlier ones of its bucket."""
        if kind == "state":
            if bucket in self.state:
                self.dead.append((bucket, kind, self.state[bucket]))
            self.state[bucket] = batch_id
        else:
            held = self.rows.get(bucket, [])
            self.dead += [(bucket, kind, folder) for folder in held] if alone else []
            self.rows[bucket] = [batch_id] if alone else [*held, batch_id]

    def write(self, batch_id: int) -> None:
        lines = [(self.buckets, b, "state", f, True) for b, f in self.state.items()]
        lines += [(self.buckets, b, "rows", f, True) for b, folders in self.rows.items() for f in folders]
        lines += [(self.buckets, b, kind, f, False) for b, kind, f in self.dead]
        table = self.spark.createDataFrame(lines, self.SCHEMA).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.target}/index/batch={batch_id}")

    def folders(self, kind: str, buckets: Sequence[int] | None = None) -> list[str]:
        held = {b: [f] for b, f in self.state.items()} if kind == "state" else self.rows
        return [f"{self.target}/{kind}/batch={f}/_bucket={b}" for b in sorted(held) if buckets is None or b in buckets for f in held[b]]


def _stored_folders(spark: SparkSession, target: str, kind: str, folders: Sequence[str]) -> DataFrame:
    """Rows of some (batch, bucket) folders; only these are listed and read."""
    return spark.read.option("basePath", f"{target}/{kind}").parquet(*folders).drop("batch")


def running_rows(spark: SparkSession, target: str) -> DataFrame:
    """Rows that `prior_sums` wrote, with `prior_sum`, as of its last batch."""
    last = spark.read.parquet(f"{target}/index").agg(F.max("batch"), F.max_by("buckets", "batch")).first()
    index = _Index(spark, target, last[0], last[1])
    return _stored_folders(spark, target, "rows", index.folders("rows")).drop("_bucket")


def prior_sums(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    target: str,
    checkpoint: str,
    max_rows: int = GROUP_ROWS,
    buckets: int = BUCKETS,
    most_folders: int = MOST_FOLDERS,
) -> None:
    """Running sum of `value` before each row, carried over micro-batches; `running_rows` reads the result.

    Keys are dealt to `buckets` by hash. State (total and last place of each key) and rows lie in a folder per
    batch and bucket; a batch reads the state of the buckets it touches and writes it anew. Rows that follow all
    earlier rows of their key in `order` are added as new folders. If a row of a key does not, the rows of that
    key's bucket, and of no other, are read and the key is written anew; the rest of the bucket is copied, and its
    older folders go. A bucket of more than `most_folders` is copied into one in the same way. So what a late key
    costs is its bucket, and folders stay few however many batches there are. A repeated batch replaces its own
    folders. `buckets` stays the same for the life of a table; choose it so that a bucket is worth a few tasks.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        index = _Index(spark, target, batch_id - 1, buckets)
        index.delete_dead(batch_id)
        columns = batch.columns
        batch = stored_copy(batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        place = F.struct(*order)
        key = ["_bucket", *keys]
        sums = stored_copy(batch.groupBy(*key).agg(F.sum(value).alias("_sum"), F.min(place).alias("_first"), F.max(place).alias("_last")))
        touched = [r[0] for r in sums.select("_bucket").distinct().collect()]
        held = index.folders("state", touched)
        state = _stored_folders(spark, target, "state", held) if held else spark.createDataFrame([], sums.select(*key, "_sum", "_last").schema)
        state = state.select(*key, F.col("_sum").alias("_held"), F.col("_last").alias("_held_last"))
        met = sums.join(state, _same(sums, state, key), "left")
        met = stored_copy(met.select(*[sums[c] for c in sums.columns], state._held, state._held_last))
        late = met.where("_first <= _held_last").select(*key)
        rewritten = {r[0] for r in late.select("_bucket").distinct().collect()}
        rewritten |= {b for b in touched if len(index.rows.get(b, ())) >= most_folders}
        rows, kept = batch, None
        earlier = index.folders("rows", rewritten)
        if earlier:
            found = _stored_folders(spark, target, "rows", earlier)
            kept = found.join(late, _same(found, late, key), "left_anti")
            again = found.join(late, _same(found, late, key), "left_semi").select(*columns, "_bucket")
            rows = batch.unionByName(again)
        ranked = OrderedGroups(rows, key, order, max_rows).add(Prefix("_before", "sum", F.col(value))).result()
        # Keys written anew are complete, so nothing is carried over to them.
        carry = met.select(*key, F.when(F.col("_first") > F.col("_held_last"), F.col("_held")).alias("_carry"))
        joined = ranked.join(carry, _same(ranked, carry, key), "left")
        prior_sum = (ranked._before + F.coalesce(carry._carry, F.lit(0))).alias("prior_sum")
        out = joined.select(*[ranked[c] for c in columns], ranked._bucket, prior_sum)
        out = out if kept is None else out.unionByName(kept.select(*columns, "_bucket", F.col("prior_sum").cast(out.schema["prior_sum"].dataType)))
        out.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{target}/rows/batch={batch_id}")
        total = (F.coalesce("_sum", F.lit(0)) + F.coalesce("_held", F.lit(0))).alias("_sum")
        updated = met.select(*key, total, F.greatest("_last", "_held_last").alias("_last"))
        rest = state.join(met, _same(state, met, key), "left_anti").select(*key, F.col("_held").alias("_sum"), F.col("_held_last").alias("_last"))
        updated.unionByName(rest).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{target}/state/batch={batch_id}")
        for bucket in touched:
            index.put("state", bucket, batch_id, alone=True)
            index.put("rows", bucket, batch_id, alone=bucket in rewritten)
        index.write(batch_id)

    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
