"""Token ids in ORC: integer run-length encoding, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from laurel.llm.tasks import sliced

# Text encoded at once by a task.
BATCH_BYTES = 4 << 20
# Encoded pieces that a worker remembers, about.
REMEMBERED = 500_000
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": 64 << 20,
    "orc.row.index.stride": 1000,
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": 0.01,
}
# The byte-level splitter always splits around white space, a single space going with the word behind it,
# behind letters that no other letter follows, and behind plain punctuation that letters, digits or white
# space follow. Only for texts whose white space is the four characters below.
_PIECE = re.compile(
    r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+(?![^\W\d_])"
    r"| ?[!-&(-/:-@\[-`{-~]+(?=[A-Za-z0-9 \t\n\r]|\Z)"
    r"| ?[^ \t\n\r]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)
_OTHER_SPACE = re.compile("[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """A byte-level tokenizer that remembers pieces of texts; gives ids as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text, as the tokenizer gives them."""
        if len(self.known) > REMEMBERED:
            # Frequent pieces come early, so the older half stays.
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))
        usual = [not _OTHER_SPACE.search(t) and not any(s in t for s in self.special) for t in texts]
        split = [_PIECE.findall(t) if u else () for t, u in zip(texts, usual)]
        missing = set().union(*split).difference(self.known)
        words = [p for p in missing if p[0] == " " and p[1:].isalpha()]
        for k in range(0, len(words), 1000):
            self.known.update(zip(words[k : k + 1000], self._words(words[k : k + 1000])))
        others = list(missing.difference(words))
        self.known.update(zip(others, self._whole(others)))
        known = self.known.__getitem__
        return [b"".join(map(known, pieces)) if u else self._whole([t])[0] for t, u, pieces in zip(texts, usual, split)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that each begin with a space: in one text they are one splitter's word each."""
        made = self.tokenizer.encode("".join(words), add_special_tokens=False)
        ids = np.array(made.ids, dtype="<u4")
        owner = np.array(made.word_ids, dtype=np.int64)
        if not len(owner) or owner[-1] != len(words) - 1:
            return self._whole(words)
        ends = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:])]

    def _whole(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, dtype="<u4").tobytes() for e in made]


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2, **options: object) -> None:
    """Encode every whole text and write (doc_id, part, start_in_part, n_tokens, ids) as ORC at `path`.

    Documents are range-partitioned by doc_id and sorted, so files, stripes and row groups hold ascending
    ids; null ids come first, repeated ids by a checksum of the text. The text is shuffled rather than the
    ids, which are larger. `end_id` is appended to each document; null and empty texts have that id alone.
    start_in_part counts the ids ahead in the same part, so the place of a document in the whole stream needs
    only the parts' sums. Further columns are not written. `tokenizer` is the path of a tokenizer file.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
    end = np.array([end_id], dtype="<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, ahead = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in sliced(batches, "text", BATCH_BYTES):
            blobs = [x + end for x in encoder.encode(batch.column("text").fill_null("").to_pylist())]
            counts = np.array([len(x) // 4 for x in blobs], np.int64)
            stops = np.append(0, np.cumsum(counts))
            values = pa.array(np.frombuffer(b"".join(blobs), "<u4").astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), values)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(np.full(len(counts), part, np.int32)), pa.array(ahead + stops[:-1]), pa.array(counts), lists]
            ahead += int(stops[-1])
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ordered = (
        documents.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.crc32(F.coalesce("text", F.lit(""))), F.xxhash64("text"))
    )
    rows = ordered.mapInArrow(encoded, "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>")
    rows.write.options(**{k: str(v) for k, v in (ORC_OPTIONS | options).items()}).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files at `path`: start is the number of ids of all documents before.

    Stripes are read in parallel. With `doc_ids`, min/max statistics, row indexes and Bloom filters on doc_id
    leave out the files, stripes and row groups without them.
    """
    stored = spark.read.schema("doc_id long, part int, start_in_part long, n_tokens long, ids array<int>").orc(path)
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part, the partitions of the writing job.
    parts = F.broadcast(sums.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")))
    if doc_ids is not None:
        stored = stored.where(F.col("doc_id").isin(list(doc_ids)))
    start = (F.col("before") + F.col("start_in_part")).alias("start")
    return stored.join(parts, "part").select("doc_id", start, "n_tokens", "ids")


def id_checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): checksum of the ids as little-endian unsigned 32-bit integers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            stops, values = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4")
            crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(stops[:-1], stops[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")
