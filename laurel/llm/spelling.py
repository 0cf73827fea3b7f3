"""Spelling variants: exact neighbours of words by pairs of trie nodes."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from laurel.llm.tasks import sliced
from laurel.session import stored_copy

BATCH_BYTES = 1 << 20
# Distinct words that a task counts before it hands them on.
COUNTED = 200_000
# A skipped position and the code point put there: (prefix node, suffix node) of words without one position,
# and of whole words.
SKIPPED, WHOLE = 0, 1


def variant_words(documents: DataFrame, least_length: int = 6, least_count: int = 5, one_in: int = 199) -> DataFrame:
    """(word, n): words of all texts with at least `least_length` code points and `least_count` occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. Let h be the crc32 of
    `doc_id:word` in UTF-8; where `one_in` divides h, the occurrence loses its code point h % length. A null text
    has no words; a null doc_id is an empty string. Each task counts its words before the shuffle.
    """
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        found: dict[str, int] = {}
        for batch in sliced(batches, "text", BATCH_BYTES):
            ids = batch.column("doc_id").cast(pa.string()).fill_null("").to_pylist()
            # Bytes in lower case change A-Z only.
            texts = [t.lower().decode() for t in batch.column("text").fill_null("").cast(pa.binary()).to_pylist()]
            for doc_id, text in zip(ids, texts):
                start = zlib.crc32(f"{doc_id}:".encode())
                cut: dict[str, str] = {}
                for word in pattern.findall(text):
                    own = cut.get(word)
                    if own is None:
                        own, h = word, zlib.crc32(word.encode(), start)
                        if h % one_in == 0:
                            gone = h % len(word)
                            own = word[:gone] + word[gone + 1 :]
                        cut[word] = own
                    if len(own) >= least_length:
                        found[own] = found.get(own, 0) + 1
                if len(found) > COUNTED:
                    yield made()
                    found = {}
        yield made()

    counted = documents.select("doc_id", "text").mapInArrow(counts, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Code points that two words begin with alike."""
    limit = min(len(a), len(b))
    return next((k for k in range(limit) if a[k] != b[k]), limit)


def _stack(words: Iterator[str], offset: int, word: str, nodes: list[int]) -> Iterator[list[int]]:
    """Node numbers of the prefixes of sorted words; `word` and its `nodes` come before them.

    The node of a prefix is the number of code points of all words before the first one with it, plus the length
    of the prefix: unlike for all prefixes. The empty prefix is node 0.
    """
    for own in words:
        shared = min(_shared(word, own), len(nodes))
        nodes = nodes[:shared] + list(range(offset + shared + 1, offset + len(own) + 1))
        word = own
        offset += len(own)
        yield nodes


def numbered_nodes(words: DataFrame, key: str, schema: str, emit) -> DataFrame:
    """Number the trie nodes of the distinct strings in column `key` and pass the rows on to `emit`.

    The strings are ranged and sorted, so that a node's words are neighbours. A first pass gives, for each
    part, the code points in it, its first and last string and the nodes of the last one; the driver chains these
    (two strings a part) to find what each part takes over from those before it. In the second pass
    emit(columns, nodes) makes a batch of its rows, `nodes` being a list of node numbers per row.
    """
    ordered = words.repartitionByRange(key).sortWithinPartitions(key)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(places)], names=[*batch.schema.names, "part", "place"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    stored = stored_copy(ordered.mapInArrow(placed, f"{kinds}, part int, place long"))
    columns = words.columns

    def edges(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(frames):
            total, first, last, nodes = 0, None, "", []
            for batch in rows:
                names = batch.column(key).to_pylist()
                first = names[0] if first is None else first
                for nodes in _stack(iter(names), total, last, nodes):
                    pass
                total += sum(map(len, names))
                last = names[-1]
            yield pa.RecordBatch.from_pydict({"part": [part], "total": [total], "first": [first], "last": [last], "nodes": [nodes]}, pa.schema([("part", pa.int32()), ("total", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("nodes", pa.list_(pa.int64()))]))

    by_part = stored.repartition("part").sortWithinPartitions("part", "place")
    summary = by_part.select("part", key).mapInArrow(edges, "part int, total long, first string, last string, nodes array<long>")
    taken: dict[int, tuple[int, str, list[int]]] = {}
    offset, word, nodes = 0, "", []
    for row in sorted(summary.collect(), key=lambda r: r.part):
        shared = _shared(word, row.first)
        taken[row.part] = (offset, word[:shared], nodes[:shared])
        # Prefixes that the part's first string brought in by itself begin at its offset; others were taken over.
        held = min(shared, _shared(row.first, row.last))
        nodes = nodes[:held] + [offset + x for x in row.nodes[held:]]
        offset, word = offset + row.total, row.last

    def emitted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(frames):
            offset, word, nodes = taken[part]
            for batch in rows:
                names = batch.column(key).to_pylist()
                # Long words have many nodes, so a batch goes on in slices.
                for start in range(0, len(names), 1000):
                    own = names[start : start + 1000]
                    stacks = list(_stack(iter(own), offset, word, nodes))
                    offset, word, nodes = offset + sum(map(len, own)), own[-1], stacks[-1]
                    yield emit(batch.slice(start, len(own)).select(columns), stacks)

    return by_part.select(*columns, "part").mapInArrow(emitted, schema)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Batches of sorted rows by their column `part`: (part, its batches), to be read in this order."""
    pending: list[pa.RecordBatch] = []

    def pieces() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            parts = np.asarray(batch.column("part"))
            cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1), len(parts)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b > a:
                    yield int(parts[a]), batch.slice(a, b - a)

    source = pieces()

    def of(part: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch
        for found, more in source:
            if found != part:
                pending.append((found, more))
                return
            yield more

    while True:
        item = pending.pop() if pending else next(source, None)
        if item is None:
            return
        yield item[0], of(*item)


def node_pairs(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words, pairs): words with their numbers, and the pairs (p, s) of each word, as rows (p, s, kind, first, id, n).

    p is the node of a prefix and s that of a suffix in the trie of the reversed words. A word gives the pair
    around each of its positions (SKIPPED) and the pair at each of its cuts (WHOLE). `first` marks positions whose
    code point differs from the one before: leaving out any other gives the same word again.
    """

    def forward(batch: pa.RecordBatch, stacks: list[list[int]]) -> pa.RecordBatch:
        names = batch.column("word").to_pylist()
        ids = [s[-1] - len(w) for s, w in zip(stacks, names)]
        return pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(ids, pa.int64()), pa.array(stacks, pa.list_(pa.int64()))], names=["word", "n", "id", "prefixes"])

    named = stored_copy(numbered_nodes(vocabulary.select("word", "n"), "word", "word string, n long, id long, prefixes array<long>", forward))

    def backward(batch: pa.RecordBatch, stacks: list[list[int]]) -> pa.RecordBatch:
        out: list[list[np.ndarray]] = [[], [], [], [], [], []]
        names = batch.column("backward").to_pylist()
        for name, n, word_id, prefixes, suffixes in zip(names, batch.column("n").to_pylist(), batch.column("id").to_pylist(), batch.column("prefixes").to_pylist(), stacks):
            length = len(name)
            p = np.array([0, *prefixes], np.int64)
            # Node of the suffix that begins at each place; the empty one last.
            s = np.array([0, *suffixes], np.int64)[::-1]
            points = np.frombuffer(name[::-1].encode("utf-32-le"), np.uint32)
            first = np.append(True, points[1:] != points[:-1])
            columns = (
                np.concatenate([p[:-1], p]), np.concatenate([s[1:], s]), np.repeat([SKIPPED, WHOLE], [length, length + 1]),
                np.append(first, np.zeros(length + 1, bool)), np.full(2 * length + 1, word_id), np.full(2 * length + 1, n),
            )
            for held, column in zip(out, columns):
                held.append(column)
        kinds = (np.int64, np.int64, np.int8, bool, np.int64, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(k)) for c, k in zip(out, kinds)], names=["p", "s", "kind", "first", "id", "n"])

    reversed_words = named.select(F.reverse("word").alias("backward"), "n", "id", "prefixes")
    pairs = numbered_nodes(reversed_words, "backward", "p long, s long, kind byte, first boolean, id long, n long", backward)
    return named.select("word", "n", "id"), pairs


def group_neighbours(p: np.ndarray, s: np.ndarray, kind: np.ndarray, first: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per row of whole groups, sorted by (p, s, kind, -n, id): near words met there, and n and id of the best one.

    Skipped rows of a group differ by one replaced code point. The whole row, one at most, has one code point
    less than the skipped rows; it counts those marked `first` only, so that no two words meet twice. Work and
    memory are linear in the rows.
    """
    rows = np.arange(len(p))
    head = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (s[1:] != s[:-1])))
    size = np.diff(np.append(head, len(p)))
    group = np.repeat(np.arange(len(head)), size)
    tail = head + size - 1
    has_whole = kind[tail] == WHOLE
    skipped = size - has_whole
    marked = np.add.reduceat(first.astype(np.int64), head)
    none = len(p)
    best_marked = np.minimum.reduceat(np.where(first, rows, none), head)
    whole = kind == WHOLE
    # The best other skipped row: the group's first one, or for that one the second.
    other = np.where(rows == head[group], np.where(skipped[group] > 1, rows + 1, none), head[group])
    short = np.where(has_whole[group] & first, tail[group], none)
    other, short = np.where(whole, best_marked[group], other), np.where(whole, none, short)
    met = np.where(whole, marked[group], skipped[group] - 1 + (has_whole[group] & first))
    n_or, id_or = np.append(n, -1), np.append(ids, np.iinfo(np.int64).max)
    better = (n_or[short] > n_or[other]) | ((n_or[short] == n_or[other]) & (id_or[short] < id_or[other]))
    best = np.where(better, short, other)
    return met, n_or[best], id_or[best]


def near_counts(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best_id): number of near words of each word that has some, and the one of largest n.

    Pairs are grouped by (p, s). A group has as many rows as there are code points in the alphabet, and one.
    Groups are streamed in sorted order; of ties the smallest id, which is the first in code-point order.
    """
    names = ["p", "s", "kind", "first", "id", "n"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, t) for t in (np.int64, np.int64, np.int8, bool, np.int64, np.int64)]

        def made(columns: list[np.ndarray]) -> pa.RecordBatch:
            met, best_n, best_id = group_neighbours(*columns)
            keep = met > 0
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (columns[4], met.astype(np.int64), best_n, best_id)], names=["id", "n_near", "best_n", "best_id"])

        for batch in batches:
            own = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            own = [np.concatenate(x) for x in zip(rest, own)]
            p, s = own[0], own[1]
            if not len(p):
                continue
            # The last group may go on in the next batch.
            open_rows = np.flatnonzero((p != p[-1]) | (s != s[-1]))
            cut = int(open_rows[-1]) + 1 if len(open_rows) else 0
            if cut:
                yield made([x[:cut] for x in own])
            rest = [x[cut:] for x in own]
        if len(rest[0]):
            yield made(rest)

    ordered = pairs.repartition("p", "s").sortWithinPartitions("p", "s", "kind", F.desc("n"), "id")
    met = ordered.select(*names).mapInArrow(task, "id long, n_near long, best_n long, best_id long")
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("minus"))).alias("best")
    summed = met.groupBy("id").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.minus")).alias("best_id"))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(id, root) of the rows (id, form): where following the forms ends. Chains have at most `steps` links.

    Each round follows the chains twice as far.
    """
    hops = forms.select("id", F.col("form").alias("root"))
    while steps > 1:
        hops = stored_copy(hops)
        onward = hops.select(F.col("id").alias("root"), F.col("root").alias("far"))
        hops = hops.join(onward, "root", "left").select("id", F.coalesce("far", "root").alias("root"))
        steps = (steps + 1) // 2
    return hops


def spelling_groups(vocabulary: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n) of a vocabulary.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of
    largest n (ties: the first in code-point order) if that n is at least `times` its own, else null; its root is
    where its forms end, or itself. Words without near words have n_near 0. An empty vocabulary gives no rows.

    Two words that differ at one position share the prefix node before it and the suffix node behind it, so the
    work is a join of integer pairs, two for each code point of the vocabulary, in place of a comparison of words.
    """
    words, pairs = node_pairs(stored_copy(vocabulary.select("word", "n")))
    near = stored_copy(near_counts(pairs))
    joined = words.join(near, "id", "left")
    has_form: Column = F.col("best_n") >= F.col("n") * times
    joined = stored_copy(joined.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best_id")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n")))
    forms = joined.where("form is not null").select("id", "form")
    # Each link of a chain has at least `times` the n of the one before.
    most, steps = joined.agg(F.max("n")).first()[0] or 1, 1
    while times**steps <= most:
        steps += 1
    ends = roots(forms, steps).join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    names = forms.join(words.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
    linked = stored_copy(names.select("id", "form_word").join(ends.select("id", "root_word"), "id"))
    result = joined.join(linked, "id", "left")
    root = F.coalesce("root_word", "word").alias("root")
    return result.select("word", F.col("form_word").alias("form"), root, "n", "n_near", "form_n")
