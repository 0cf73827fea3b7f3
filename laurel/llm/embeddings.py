"""Near-duplicate vectors by collision counting over sorted one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from laurel.llm.components import components
from laurel.llm.tasks import Forest
from laurel.session import stored_copy

# Projections that deal the vectors into cells, and those whose window collisions are counted.
CELL_PROJECTIONS = 3
COUNTED_PROJECTIONS = 24
# Half widths of windows, in standard deviations of the difference of a pair at the threshold.
CELL_WINDOW = 3.3
COUNT_WINDOW = 1.645
# Chance of one counted window to hold such a pair (two-sided normal), and the recall of the count.
COUNT_CHANCE = 0.90
RECALL = 0.999
# Vectors of one side of a block that a task compares.
BLOCK = 2048


def collisions_needed(windows: int = COUNTED_PROJECTIONS, chance: float = COUNT_CHANCE, recall: float = RECALL) -> int:
    """Largest count that a pair at the threshold reaches with probability `recall`, windows being independent."""
    tail = 0.0
    for count in range(windows, -1, -1):
        tail += comb(windows, count) * chance**count * (1 - chance) ** (windows - count)
        if tail >= recall:
            return count
    return 0


def directions(dim: int, count: int) -> np.ndarray:
    """Random directions (dim, count), orthogonal in groups of `dim`, of length sqrt(dim)."""
    random = np.random.Generator(np.random.PCG64(dim))
    groups = [np.linalg.qr(random.standard_normal((dim, dim)))[0] for _ in range(-(-count // dim))]
    return np.concatenate(groups, axis=1)[:, :count] * np.sqrt(dim)


def _projected(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, same, vector, places) of usable vectors; places are the projections of the unit vector."""
    schema = pa.schema([
        ("vec_id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("vector", pa.binary()), ("places", pa.list_(pa.float64())),
    ])
    count = CELL_PROJECTIONS + COUNTED_PROJECTIONS

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = []
            for key, label, values in zip(*(batch.column(c) for c in ("vec_id", "label", "embedding"))):
                values = values.values
                if not len(values) or values.null_count:
                    continue
                vector = np.asarray(values, np.float64)
                top = np.abs(vector).max()
                if not np.isfinite(top) or top == 0:
                    continue
                if len(vector) not in axes:
                    axes[len(vector)] = directions(len(vector), count)
                # Scaled first, so that no square overflows.
                unit = vector / top
                unit /= np.sqrt(unit @ unit)
                rows.append({"vec_id": key.as_py(), "label": label.as_py(), "dim": len(vector), "vector": vector.tobytes(), "places": (unit @ axes[len(vector)]).tolist()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    usable = vectors.where("vec_id is not null and label is not null and embedding is not null")
    usable = usable.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    return usable.mapInArrow(projected, "vec_id long, label long, dim int, vector binary, places array<double>")


def _linked_block(least: float) -> callable:
    needed = collisions_needed()

    def linked(table: pa.Table) -> pa.Table:
        """Verified links of one block: n_links of each home vector, and links that join something."""
        home = np.asarray(table.column("home"))
        nodes, copies = np.asarray(table.column("node")), np.asarray(table.column("copies"))
        dim = table.column("dim")[0].as_py()
        vectors = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(-1, dim)
        places = np.asarray(table.column("places").combine_chunks().flatten()).reshape(len(nodes), -1)[:, CELL_PROJECTIONS:]
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        lengths = np.sqrt((vectors**2).sum(axis=1))
        h, g = np.flatnonzero(home), np.flatnonzero(~home)
        counts = np.zeros(len(h), np.int64)
        forest, edges = Forest(len(nodes)), []
        if len(h) and len(g):
            half = COUNT_WINDOW * np.sqrt(2 - 2 * least)
            orders = np.argsort(places[g], axis=0, kind="stable")
            ranked = np.take_along_axis(places[g], orders, axis=0)
            low = np.stack([np.searchsorted(ranked[:, k], places[h, k] - half, side="left") for k in range(ranked.shape[1])])
            high = np.stack([np.searchsorted(ranked[:, k], places[h, k] + half, side="right") for k in range(ranked.shape[1])])
            # Same vectors in both roles share a node, so a link is between nodes, not rows.
            first = {}
            line = np.array([first.setdefault(n, k) for k, n in enumerate(nodes.tolist())])
            for k in range(len(h)):
                hits = np.zeros(len(g), np.uint8)
                for j in range(ranked.shape[1]):
                    hits[orders[low[j, k] : high[j, k], j]] += 1
                near = g[hits >= needed]
                near = near[nodes[near] != nodes[h[k]]]
                if not len(near):
                    continue
                cosine = (vectors[near] @ vectors[h[k]]) / (lengths[near] * lengths[h[k]])
                near = near[cosine >= least]
                counts[k] = copies[near].sum()
                for x in near.tolist():
                    if forest.join(int(line[h[k]]), int(line[x])):
                        edges.append((nodes[h[k]], nodes[x]))
        ends = np.array(edges, np.int64).reshape(-1, 2)
        own = nodes[h]
        return pa.table({
            "a": pa.array(np.append(own, ends[:, 0]), pa.int64()),
            "b": pa.array(np.append(own, ends[:, 1]), pa.int64()),
            "n_links": pa.array(np.append(counts, np.zeros(len(ends), np.int64)), pa.int64()),
        })

    return linked


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of equal label (not null) and length are linked if their cosine, in double precision, is at least
    `least`; component_id is the smallest vec_id reachable, and that vector is kept.

    Every vector is projected onto random directions. A few projections, cut into slabs, make cells: a vector
    is at home in one cell and a guest in each cell that its windows touch, so a pair meets in the home cell
    of either side. There the other projections are sorted, the guests in each home vector's centred windows
    are counted, and pairs whose count a pair at the threshold reaches with probability RECALL are verified.
    With CELL_PROJECTIONS windows of 3.3 deviations, a pair at the threshold is found with about 0.996, a
    closer one almost surely; nothing below the threshold is linked.

    Equal vectors are one node with its number of copies. A crowded cell is cut into blocks on both sides, so
    no task holds more than two blocks; tasks return a count per home vector and the links that join
    something, not pairs. Vectors that are null, empty or zero, or hold null or non-finite values, and rows with a
    null label or vec_id link with nothing. Rows that repeat a vec_id count as one vector if they are equal,
    and otherwise add up their links. Further columns are ignored. An empty table gives an empty one.
    """
    made = stored_copy(_projected(vectors).distinct())
    classes = made.groupBy("label", "dim", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("places").alias("places"))
    classes = stored_copy(classes)
    spread = float(np.sqrt(2 - 2 * least))
    window, width = CELL_WINDOW * spread, 3 * CELL_WINDOW * spread
    place = lambda k: F.get("places", F.lit(k))
    slab = lambda x: F.floor(x / F.lit(width)).cast("int")
    held = ["label", "dim", "node", "copies", "vector", "places"]
    cells = [f"c{k}" for k in range(CELL_PROJECTIONS)]
    homes = classes.select(*held, F.lit(True).alias("home"), *(slab(place(k)).alias(c) for k, c in enumerate(cells)))
    guests = classes.select(*held, F.lit(False).alias("home"))
    for k, c in enumerate(cells):
        guests = guests.withColumn(c, F.explode(F.sequence(slab(place(k) - window), slab(place(k) + window))))
    rows = stored_copy(homes.unionByName(guests))
    keys = ["label", "dim", *cells]
    blocks = lambda side: F.ceil(F.sum(F.when(side, 1).otherwise(0)) / F.lit(BLOCK)).cast("int")
    counts = rows.groupBy(*keys).agg(blocks(F.col("home")).alias("h"), blocks(~F.col("home")).alias("g")).where("h > 0 and g > 0")
    dealt = rows.join(counts, keys)
    block = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("h")).otherwise(F.col("g"))).cast("int")
    dealt = dealt.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("g")).otherwise(F.col("h")) - 1)))
    dealt = dealt.withColumn("hb", F.when(F.col("home"), F.col("own")).otherwise(F.col("other"))).withColumn("gb", F.when(F.col("home"), F.col("other")).otherwise(F.col("own")))
    found = dealt.groupBy(*keys, "hb", "gb").applyInArrow(_linked_block(least), "a long, b long, n_links long")
    found = stored_copy(found)
    # A node of several labels has a row in each.
    links = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("others"))
    members = made.join(classes.select("label", "dim", "vector", "node", "copies"), ["label", "dim", "vector"]).select("vec_id", "node", "copies")
    ties = found.where("a <> b").select("a", "b").union(members.where("vec_id <> node").select("node", "vec_id"))
    reached = components(ties.distinct()).withColumnRenamed("node", "vec_id")
    counted = members.join(links, "node", "left").groupBy("vec_id").agg(F.sum(F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    ids = vectors.select(F.col("vec_id").cast("long"))
    out = ids.join(counted, "vec_id", "left").join(reached, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
