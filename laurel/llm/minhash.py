"""Near-duplicate documents by SuperMinHash signatures, banding, exact confirmation and union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from laurel.llm.components import components
from laurel.llm.tasks import Forest, gram_hashes, lower_ascii, mixed, sliced, string_bytes, word_hashes
from laurel.session import stored_copy

# Text held at once by a task.
BATCH_BYTES = 1 << 20
# Sets that one task compares with each other; larger families are compared block by block.
BLOCK = 1500
_GOLDEN = 0x9E3779B97F4A7C15


def _step(k: int) -> np.uint64:
    """The k-th constant of a sequence spread over 64 bits."""
    return np.uint64(_GOLDEN * k & (1 << 64) - 1)


def super_minhash(elements: np.ndarray, owner: np.ndarray, count: int, slots: int) -> np.ndarray:
    """Signatures (count, slots) of sets; `elements` are hashes, `owner` the set of each, ascending.

    Every element draws a random permutation of the slots, one place a step, and offers step + fraction to
    the slot drawn at that step. Ranks of one element differ between slots, which lowers the variance. All
    elements take a step together; a set stops as soon as each of its slots holds a value of an earlier
    step, since later offers cannot be smaller. Long sets so stop after about one step.
    """
    width = count * slots
    value = np.full(width, np.inf)
    rows = np.arange(len(elements))
    perms = None
    for step in range(slots):
        if not len(rows):
            break
        draw = mixed(elements[rows] + _step(step + 1))
        fraction = (draw >> np.uint64(32)).astype(np.float64) / 2.0**32
        # Fisher-Yates: swap the slot at `step` with one at or behind it.
        other = step + ((draw & np.uint64(0xFFFFFFFF)) % np.uint64(slots - step)).astype(np.int64)
        if perms is None:
            slot = other
            if slots > 1:
                kept_other = other
        else:
            line = np.arange(len(rows))
            slot = perms[line, other].astype(np.int64)
            perms[line, other] = perms[line, step]
        np.minimum.at(value, owner[rows] * slots + slot, fraction + step)
        full = (value.reshape(count, slots) < step + 1).all(axis=1)
        left = ~full[owner[rows]]
        if perms is None and left.any():
            perms = np.tile(np.arange(slots, dtype=np.int16), (int(left.sum()), 1))
            line = np.arange(len(perms))
            perms[line, kept_other[left]] = perms[line, 0]
            rows = rows[left]
        elif perms is not None and not left.all():
            perms, rows = perms[left], rows[left]
        elif perms is None:
            rows = rows[left]
    # Equal values come from equal elements only, up to 32 bits of fraction.
    return value.reshape(count, slots)


def shingle_sets(batch: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text and the offsets of the texts.

    Fewer words than a shingle make one shorter shingle; no words make none.
    """
    data, ends = string_bytes(batch.column("text"))
    words, at = word_hashes(lower_ascii(data), ends)
    sizes = np.diff(at)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    grams = gram_hashes(words, shingle)
    place = np.arange(len(grams))
    within = place + shingle <= at[owner[: len(grams)] + 1]
    hashes, owners = grams[within], owner[: len(grams)][within]
    short = np.flatnonzero((sizes > 0) & (sizes < shingle))
    if len(short):
        extra = [gram_hashes(words[at[k] : at[k + 1]], int(sizes[k]))[0] for k in short]
        hashes, owners = np.append(hashes, np.array(extra, np.uint64)), np.append(owners, short)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[new], owners[new]
    return hashes, np.searchsorted(owners, np.arange(len(sizes) + 1))


def _signed_documents(documents: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, keys): a 128-bit hash of the set and its band keys; null for an empty set."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            hashes, at = shingle_sets(batch, shingle)
            sizes = np.diff(at)
            some = np.flatnonzero(sizes)
            digests, keys = [None] * len(sizes), [None] * len(sizes)
            if len(some):
                sums = [np.add.reduceat(mixed(hashes + _step(k + 77)), at[some]) for k in range(2)]
                digest = np.stack([mixed(x) for x in sums], axis=1)
                owner = np.repeat(np.arange(len(some)), sizes[some])
                parts = super_minhash(hashes, owner, len(some), bands * rows).view(np.uint64).reshape(len(some), bands, rows)
                key = np.tile(np.array([_step(k + 1) for k in range(bands)]), (len(some), 1))
                for k in range(rows):
                    key = mixed((key ^ parts[:, :, k]) * _step(1))
                for line, k in enumerate(some):
                    digests[k], keys[k] = digest[line].tobytes(), key[line].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_hash", "keys"],
            )

    return documents.mapInArrow(signed, "doc_id long, n_shingles long, set_hash binary, keys array<long>")


def linked_sets(hashes: np.ndarray, at: np.ndarray, left: int, percent: int, forest: Forest) -> list[tuple[int, int]]:
    """Pairs (i, j) of sets at `percent` or more whose link joins two trees of `forest`, which takes them.

    Sets up to `left` are compared with all later ones if left is their number, otherwise with those from
    `left` on. Pairs that are joined already are not compared: they add nothing to the components.
    """
    count = len(at) - 1
    sizes = np.diff(at)
    _, codes = np.unique(hashes, return_inverse=True)
    seen = np.zeros(len(codes) and int(codes.max()) + 1, bool)
    roots = forest.roots()
    found = []
    for i in range(left):
        first = left if left < count else i + 1
        if first >= count:
            continue
        least = -(-percent * sizes[i] // 100)
        fits = (sizes[first:] >= least) & (sizes[first:] * percent <= 100 * sizes[i]) & (roots[first:] != roots[i])
        others = np.flatnonzero(fits) + first
        if not len(others):
            continue
        own = codes[at[i] : at[i + 1]]
        seen[own] = True
        if 2 * len(others) > count - first:
            common = np.add.reduceat(seen[codes[at[first] :]].astype(np.int64), at[first:-1] - at[first])[others - first]
        else:
            common = np.array([np.count_nonzero(seen[codes[at[j] : at[j + 1]]]) for j in others])
        seen[own] = False
        linked = others[100 * common >= percent * (sizes[i] + sizes[others] - common)]
        for j in linked:
            if forest.join(i, int(j)):
                found.append((i, int(j)))
        if len(linked):
            # Relabel only the trees that were joined.
            joined = np.isin(roots, roots[np.append(linked, i)])
            roots[joined] = forest.root(i)
    return found


def _confirmed_links(documents: DataFrame, families: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) that span the true components of each family of candidates.

    `families` is (node, family). A family up to BLOCK documents is one group; of a larger one every pair of
    blocks is a group, so that no task holds more than two blocks and no pair is left out.
    """
    sizes = families.groupBy("family").agg(F.count("*").alias("n"))
    dealt = families.join(sizes, "family").withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # Group (p, q), p <= q, compares block p with block q.
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("node", "family", "block", partner)
    dealt = dealt.select(
        "node",
        F.col("family").alias("family"),
        F.least("block", "other").alias("p"),
        F.greatest("block", "other").alias("q"),
        "block",
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            hashes, at = shingle_sets(batch, shingle)
            blobs = [hashes[at[k] : at[k + 1]].tobytes() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(blobs, pa.binary())], names=["node", "grams"])

    held = documents.join(families.select(F.col("node").alias("doc_id")), "doc_id").select("doc_id", "text")
    grams = held.mapInArrow(sets, "node long, grams binary")
    groups = dealt.join(grams, "node")

    def link(table: pa.Table) -> pa.Table:
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        nodes, blocks = np.asarray(table.column("node")), np.asarray(table.column("block"))
        order = np.lexsort((nodes, blocks != p))
        blobs = table.column("grams")
        parts = [np.frombuffer(blobs[int(k)].as_py(), np.uint64) for k in order]
        nodes = nodes[order]
        at = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        left = len(nodes) if p == q else int((blocks == p).sum())
        found = linked_sets(np.concatenate(parts), at, left, percent, Forest(len(nodes))) if left else []
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(nodes[pairs[:, 0]], pa.int64()), "b": pa.array(nodes[pairs[:, 1]], pa.int64())})

    return groups.groupBy("family", "p", "q").applyInArrow(link, "a long, b long")


def near_duplicates(
    documents: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 25, rows: int = 5
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A document's set holds the distinct shingles of its words (A-Z in lower case). Documents with
    100 * intersection >= percent * union are linked; component_id is the smallest doc_id reachable, and
    that document is kept. Candidates come from bands of SuperMinHash signatures; a pair at Jaccard 0.8
    shares one of 25 bands of 5 ranks with probability 0.99995; at 0.85, 21 bands of 6 ranks do the same. Links are confirmed on
    the full sets of 64-bit shingle hashes.

    Copies of a set are one node, so thousands of copies cost one signature. Band buckets are tied to their
    smallest node (no pairs); what is tied together is a family of candidates, and only the sets of families
    are shuffled, once, to be compared inside tasks. Tasks return the links that join something, at most one
    per document and group, never all pairs.

    Empty and null texts have n_shingles 0 and are their own component. Rows with a null doc_id are kept, with
    a null component, and link with nothing. Rows that repeat a doc_id with another text count as one
    document for linking (links of either). Further columns are ignored. An empty table gives an empty one.
    """
    documents = documents.select("doc_id", "text")
    own = stored_copy(_signed_documents(documents, shingle, bands, rows))
    usable = own.where("doc_id is not null and set_hash is not null")
    # Equal sets have equal keys, so any of them serves.
    firsts = stored_copy(usable.groupBy("set_hash").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys")))
    keyed = firsts.select("node", F.explode("keys").alias("band_key"))
    least = keyed.groupBy("band_key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    ties = keyed.join(least, "band_key").where("node <> first").select("first", "node").distinct()
    families = components(ties, "first", "node").withColumnRenamed("component", "family")
    families = stored_copy(families)
    links = stored_copy(_confirmed_links(documents, families, shingle, percent))
    copies = usable.join(firsts.drop("keys"), "set_hash").where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    joined = components(links.select("a", "b").union(copies).distinct())
    out = own.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id").alias("component_id")
    out = out.select("doc_id", "n_shingles", component)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80, **how: int) -> DataFrame:
    """`documents` with one document of each group of near duplicates: the one of the smallest doc_id.

    Rows with null ids, and those whose id stands for several texts, are judged by the 64-bit hash of their text
    in place of the id, so none is lost for another one's text; a null id comes after all others. Rows without
    words stay. Of rows that repeat both id and text all stay, as they are one document.
    """
    text_hash = F.xxhash64("text")
    texts = documents.where("doc_id is not null").groupBy("doc_id").agg(F.min(text_hash).alias("low"), F.max(text_hash).alias("high"))
    several = stored_copy(texts.where("low <> high").select(F.col("doc_id").alias("_several")))
    # The hash of a null is a small number, which may be some document's id.
    named = documents.where("text is not null").select("doc_id", "text").join(several, F.col("doc_id") == F.col("_several"), "left")
    key = F.when(F.col("doc_id").isNull() | F.col("_several").isNotNull(), text_hash).otherwise(F.col("doc_id"))
    named = named.select("doc_id", "text", key.alias("key"))
    found = near_duplicates(named.select(F.col("key").alias("doc_id"), "text"), shingle, percent, **how)
    groups = found.where("n_shingles > 0").select(F.col("doc_id").alias("key"), "component_id").distinct()
    rows = stored_copy(named.select("doc_id", "key", text_hash.alias("text_hash")).distinct().join(groups, "key"))
    order = F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "text_hash")
    best = rows.groupBy("component_id").agg(F.min(order).alias("best"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    gone = stored_copy(rows.join(best, "component_id").where(~stays).select(F.col("doc_id").alias("gone_id"), "text_hash"))
    same = documents["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(documents["text"]) == gone["text_hash"])
    return documents.join(gone, same, "left_anti")
