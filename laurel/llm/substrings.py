"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from laurel.llm.tasks import gram_hashes, mixed, sliced, string_bytes, word_hashes
from laurel.session import scratch_path, stored_copy

# Text of one reference block.
BLOCK_BYTES = 4 << 20
# Phrases of one index bucket, about.
BUCKET_PHRASES = 1 << 20
# Place of rows without an id: no id is larger, so they are references for none.
NO_ID = np.iinfo(np.int64).max
BLOCK_SCHEMA = "block long, n_words long, ids array<long>, texts array<string>"


def _blocks(documents: DataFrame) -> DataFrame:
    """The corpus as reference blocks, one row each, documents in the order of their ids; stored once.

    No shuffle: a block holds neighbouring rows of one task. The table is bucketed by block, so the later
    passes meet their index answers without moving the text again.
    """

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        for number, batch in enumerate(sliced(batches, "text", BLOCK_BYTES)):
            ids = batch.column("doc_id").cast(pa.int64())
            order = np.argsort(_places(ids), kind="stable")
            texts = batch.column("text").fill_null("").take(pa.array(order))
            words = sum(len(x.as_py().encode().split()) for x in texts)
            yield pa.RecordBatch.from_pylist(
                [{"block": (partition << 32) | number, "n_words": words, "ids": ids.take(pa.array(order)).to_pylist(), "texts": texts.to_pylist()}],
                schema=pa.schema([("block", pa.int64()), ("n_words", pa.int64()), ("ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.string()))]),
            )

    spark = documents.sparkSession
    path, count = scratch_path(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"blocks_{path.rsplit('-', 1)[-1]}"
    made = documents.select("doc_id", "text").mapInArrow(gathered, BLOCK_SCHEMA)
    made.write.option("path", path).option("compression", "zstd").bucketBy(count, "block").saveAsTable(name)
    stored = spark.read.table(name)
    stored.schema  # the files stay when the name goes
    spark.sql(f"DROP TABLE {name}")
    return stored


def _places(ids: pa.Array) -> np.ndarray:
    return np.asarray(ids.fill_null(NO_ID))


class Phrases:
    """Phrases (windows of `size` words) of one block and the anchor of each.

    A phrase's anchor is the smallest hash of the shorter grams inside it, so equal phrases have equal
    anchors, and neighbouring phrases mostly share theirs.
    """

    def __init__(self, texts: pa.Array, size: int):
        data, ends = string_bytes(texts)
        words, self.at = word_hashes(data, ends)
        self.sizes = np.diff(self.at)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        gram = max(1, min(5, size))
        grams = gram_hashes(words, gram)
        count = max(0, len(words) - size + 1)
        within = np.arange(count) + size <= self.at[owner[:count] + 1] if count else np.empty(0, bool)
        # First word and document of each phrase that lies inside one document.
        self.first = np.flatnonzero(within)
        self.doc = owner[self.first]
        least, span, width = grams, 1, size - gram + 1
        while span < width:
            step = min(span, width - span)
            least = np.minimum(least[: len(least) - step], least[step:])
            span += step
        self.anchor = mixed(least[self.first]) if count else np.empty(0, np.uint64)
        self.words, self.size = words, size

    def hashes(self, chosen: np.ndarray) -> np.ndarray:
        whole = gram_hashes(self.words, self.size)
        return whole[self.first[chosen]]


def _bucket_edges(values: np.ndarray, buckets: int) -> np.ndarray:
    """Offsets of the buckets in ascending 64-bit `values`; bucket = value * buckets / 2**64."""
    width = -(-(1 << 64) // buckets)
    edges = np.array([k * width for k in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]]).astype(np.int64)


def _anchor_slices(blocks: DataFrame, size: int, buckets: int) -> DataFrame:
    """(bucket, block, marks, twice): 32-bit marks of a block's distinct anchors and whether two of its documents hold each."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts in zip(batch.column("block").to_pylist(), batch.column("texts")):
                phrases = Phrases(texts.values, size)
                anchors, twice = _distinct_anchors(phrases)
                edges = _bucket_edges(anchors, buckets)
                rows = [
                    {"bucket": k, "block": block, "marks": _marks(anchors[a:b]).tobytes(), "twice": np.packbits(twice[a:b]).tobytes()}
                    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:]))
                    if b > a
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=SLICES)

    return blocks.select("block", "texts").mapInArrow(slices, "bucket int, block long, marks binary, twice binary")


SLICES = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("marks", pa.binary()), ("twice", pa.binary())])


def _marks(anchors: np.ndarray) -> np.ndarray:
    """32 bits of a hash beside the bucket's; equal marks of different anchors only cost work."""
    return mixed(anchors).astype(np.uint32)


def _distinct_anchors(phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(phrases.anchor, kind="stable")
    value, doc = phrases.anchor[order], phrases.doc[order]
    if not len(value):
        return value, np.empty(0, bool)
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    last = np.append(head[1:], len(value)) - 1
    # The sort is stable, so documents ascend among equal anchors.
    return value[head], doc[head] != doc[last]


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """One bucket of the anchor index: which marks of each block are in several blocks or documents."""
    blobs = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("marks")]
    sizes = [len(x) for x in blobs]
    marks = np.concatenate(blobs)
    twice = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n).astype(bool) for x, n in zip(table.column("twice"), sizes)]
    _, code, count = np.unique(marks, return_inverse=True, return_counts=True)
    several = count > 1
    several[code[np.concatenate(twice)]] = True
    answer = np.split(several[code], np.cumsum(sizes)[:-1])
    return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "bits": pa.array([np.packbits(x).tobytes() for x in answer], pa.binary())})


def _phrase_slices(blocks: DataFrame, size: int, buckets: int) -> DataFrame:
    """(bucket, block, hashes, docs, places): a block's distinct phrases with repeated anchors, first occurrence of each."""
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("base", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("places", pa.binary())])

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column("block")[row].as_py()
                phrases, ids = Phrases(batch.column("texts")[row].values, size), _places(batch.column("ids")[row].values)
                _, value, head, _ = _candidates(phrases, ids, batch.column("answers")[row].as_py(), buckets)
                if not len(value):
                    continue
                doc = ids[phrases.doc[head]]
                place = (phrases.first[head] - phrases.at[phrases.doc[head]]).astype(np.uint32)
                edges = _bucket_edges(value, buckets)
                rows = []
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    if b > a:
                        base = int(doc[a:b].min())
                        rows.append({"bucket": k, "block": block, "base": base, "hashes": value[a:b].tobytes(), "docs": _packed(doc[a:b], base), "places": place[a:b].tobytes()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return blocks.mapInArrow(slices, "bucket int, block long, base long, hashes binary, docs binary, places binary")


def _packed(ids: np.ndarray, base: int) -> bytes:
    """Ids as differences from `base`, in 4 bytes each if they fit and in 8 otherwise."""
    away = (ids - base).astype(np.uint64)
    return away.astype(np.uint32).tobytes() if not len(away) or int(away.max()) < 1 << 32 else away.tobytes()


def _unpacked(blob: bytes, base: int, count: int) -> np.ndarray:
    kind = np.uint32 if len(blob) == 4 * count else np.uint64
    return np.frombuffer(blob, kind).astype(np.int64) + base


def _candidates(phrases: Phrases, ids: np.ndarray, answers: list | None, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases whose anchor is repeated: (which, distinct hashes ascending, first occurrence of each, code of each)."""
    anchors, _ = _distinct_anchors(phrases)
    edges = _bucket_edges(anchors, buckets)
    repeated = np.zeros(len(anchors), bool)
    for answer in answers or []:
        a, b = edges[answer["bucket"]], edges[answer["bucket"] + 1]
        repeated[a:b] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=b - a).astype(bool)
    which = np.flatnonzero(repeated[np.searchsorted(anchors, phrases.anchor)]) if len(anchors) else np.empty(0, np.int64)
    value, head, code = np.unique(phrases.hashes(which), return_index=True, return_inverse=True)
    return which, value, which[head] if len(which) else head, code


def _first_phrases(table: pa.Table) -> pa.Table:
    """One bucket of the phrase index: for each block's phrases that a smaller document holds, its first occurrence."""
    hashes = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")]
    sizes = np.array([len(x) for x in hashes])
    docs = np.concatenate([_unpacked(x.as_py(), b.as_py(), n) for x, b, n in zip(table.column("docs"), table.column("base"), sizes)])
    places = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("places")])
    whole = np.concatenate(hashes)
    order = np.lexsort((places, docs, whole))
    new = np.append(True, whole[order][1:] != whole[order][:-1])
    first = np.empty(len(order), np.int64)
    first[order] = order[new][np.cumsum(new) - 1]
    later = docs[first] < docs
    rows = []
    for k, (a, b) in enumerate(zip(np.cumsum(sizes) - sizes, np.cumsum(sizes))):
        hit = later[a:b]
        if hit.any():
            source = docs[first[a:b][hit]]
            base = int(source.min())
            rows.append({
                "bucket": table.column("bucket")[k].as_py(), "block": table.column("block")[k].as_py(), "base": base, "bits": np.packbits(hit).tobytes(),
                "docs": _packed(source, base), "places": places[first[a:b][hit]].tobytes(),
            })
    return pa.Table.from_pylist(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("base", pa.int64()), ("bits", pa.binary()), ("docs", pa.binary()), ("places", pa.binary())]))


def factorise(place: np.ndarray, ref_doc: np.ndarray, ref_place: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, length, reference document, its start) of one document.

    `place` holds the first words of the phrases found in the references, ascending. A factor grows as long
    as the next phrase continues in the same reference. Where it ends, the phrases that straddle its end are
    checked too: one that is found elsewhere begins the next factor, cut to the words not yet covered.
    """
    if not len(place):
        return []
    goes_on = (np.diff(place) == 1) & (ref_doc[1:] == ref_doc[:-1]) & (np.diff(ref_place) == 1)
    begin = np.flatnonzero(np.append(True, ~goes_on))
    end = np.append(begin[1:], len(place)) - 1
    factors, covered = [], 0
    for a, b in zip(begin, end):
        start, stop = max(int(place[a]), covered), int(place[b]) + size
        if stop > start:
            factors.append((start, stop - start, int(ref_doc[a]), int(ref_place[a]) + start - int(place[a])))
            covered = stop
    return factors


def _parsed(blocks: DataFrame, size: int, anchor_buckets: int, buckets: int) -> DataFrame:
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ref_doc", pa.int64()), ("ref_start", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("factors", pa.list_(kind)), ("kept_text", pa.string())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield parsed_block(batch, row)

    def parsed_block(batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        texts, own = batch.column("texts")[row].values, batch.column("ids")[row].values
        ids = _places(own)
        phrases = Phrases(texts, size)
        which, value, head, code = _candidates(phrases, ids, batch.column("answers")[row].as_py(), anchor_buckets)
        # The first occurrence in the block, unless the index knows an earlier one.
        ref_doc = ids[phrases.doc[head]].copy() if len(head) else np.empty(0, np.int64)
        ref_place = phrases.first[head] - phrases.at[phrases.doc[head]] if len(head) else np.empty(0, np.int64)
        edges = _bucket_edges(value, buckets)
        for answer in batch.column("found")[row].as_py() or []:
            a, b = edges[answer["bucket"]], edges[answer["bucket"] + 1]
            hit = a + np.flatnonzero(np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=b - a))
            ref_doc[hit] = _unpacked(answer["docs"], answer["base"], len(hit))
            ref_place[hit] = np.frombuffer(answer["places"], np.uint32)
        smaller = ref_doc[code] < ids[phrases.doc[which]] if len(which) else np.empty(0, bool)
        which, code = which[smaller], code[smaller]
        owners = phrases.doc[which]
        cuts = np.searchsorted(owners, np.arange(len(ids) + 1))
        places = phrases.first[which] - phrases.at[owners] if len(which) else np.empty(0, np.int64)
        removed, factors, kept = [], [], []
        for k in range(len(ids)):
            a, b = cuts[k], cuts[k + 1]
            words = texts[k].as_py().encode().split()
            found = factorise(places[a:b], ref_doc[code[a:b]], ref_place[code[a:b]], size) if b > a else []
            if found:
                parts, at = [], 0
                for start, length, _, _ in found:
                    parts += words[at:start]
                    at = start + length
                words = parts + words[at:]
            removed.append(int(phrases.sizes[k]) - len(words))
            factors.append([dict(zip(("start", "length", "ref_doc", "ref_start"), f)) for f in found])
            kept.append(b" ".join(words).decode())
        return pa.RecordBatch.from_arrays([own, pa.array(phrases.sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(factors, schema.field("factors").type), pa.array(kept, pa.string())], schema=schema)

    factors = "array<struct<start: long, length: long, ref_doc: long, ref_start: long>>"
    return blocks.mapInArrow(parse, f"doc_id long, n_words long, n_removed long, factors {factors}, kept_text string")


def substring_dedup(documents: DataFrame, size: int = 13) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, factors, kept_text.

    Relative Lempel-Ziv: the corpus is cut into reference blocks, each indexed by its phrases of `size` words,
    and each document is factored greedily against all blocks' documents with a smaller doc_id. Factors are
    (start, length, ref_doc, ref_start); their words are removed. Every word of a phrase that also starts in a
    document with a smaller id is covered, phrases across factor boundaries included; phrases are judged on
    the input. kept_text joins the other words by one space.

    The index is cut by hash range into buckets. It takes two rounds: first the blocks' anchors, in 4 bytes
    each, to find those that more than one document holds; then only the phrases with such anchors. A block
    sends each phrase once, however many of its documents hold it, so a passage that a third of all documents
    share costs an entry per block; buckets are even, as hashes are. Answers return to the blocks through a
    table bucketed by block, so the text never moves.

    Phrases are compared by 64-bit hashes. Words are runs of bytes other than ASCII white space; nulls and
    empty texts have none and keep an empty text. Rows with a null doc_id come last: words of theirs are removed, they
    are no references, and for them the id 2^63 - 1 is none either. Rows that repeat an id are no references for each other. Further columns are ignored.
    """
    blocks = _blocks(documents)
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    fewest = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # About a fifth of the phrases have an anchor of their own.
    buckets = max(fewest, words // 5 // BUCKET_PHRASES)

    def asked(found: DataFrame, *fields: str) -> DataFrame:
        # Bounded: one row per bucket, and all of them together are smaller than the block.
        return found.groupBy("block").agg(F.collect_list(F.struct("bucket", *fields)).alias("got"))

    anchors = _anchor_slices(blocks, size, buckets).groupBy("bucket").applyInArrow(_repeated_anchors, "bucket int, block long, bits binary")
    answers = asked(stored_copy(anchors), "bits").withColumnRenamed("got", "answers").hint("shuffle_hash")
    answered = blocks.join(answers, "block", "left").select("block", "ids", "texts", "answers")
    phrases = _phrase_slices(answered, size, buckets).groupBy("bucket")
    found = phrases.applyInArrow(_first_phrases, "bucket int, block long, base long, bits binary, docs binary, places binary")
    found = asked(stored_copy(found), "base", "bits", "docs", "places").withColumnRenamed("got", "found").hint("shuffle_hash")
    both = answered.join(found, "block", "left").select("block", "ids", "texts", "answers", "found")
    return _parsed(both, size, buckets, buckets)


def digests(parsed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept text."""
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
