"""Helpers that several operators use inside tasks: Arrow columns as arrays, words, hashes, union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Words of every contract: maximal runs of bytes other than these.
SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
WORD = "[^\\x20\\x09-\\x0D]+"

_SEED = 20240607
_TABLE: dict[str, np.ndarray] = {}


def _byte_table() -> np.ndarray:
    """Random 64-bit value of each (place in word, byte); the same in every worker."""
    if "bytes" not in _TABLE:
        random = np.random.Generator(np.random.PCG64(_SEED))
        _TABLE["bytes"] = random.integers(0, 2**64, size=256 * 256, dtype=np.uint64)
    return _TABLE["bytes"]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over their whole range (the splitmix64 finaliser)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its values; a null is an empty value."""
    column = column.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first, last = (ends[0], ends[-1]) if len(ends) else (0, 0)
    return whole[first:last], ends - first


def solid_bytes(separators: bytes) -> np.ndarray:
    """Table of the bytes that words are made of: all but `separators`."""
    solid = np.ones(256, dtype=bool)
    solid[list(separators)] = False
    return solid


_WORD_BYTES = solid_bytes(SPACES)


def word_hashes(
    data: np.ndarray, ends: np.ndarray, solid: np.ndarray = _WORD_BYTES, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """64-bit hash of every word, in order, the word offsets of the values, and hashes of word beginnings.

    `data` and `ends` are what `string_bytes` returns. Tabulation hashing over (place, byte). For each of
    `prefixes` there is one more array: the hash of so many first bytes of each word, 0 for shorter words.
    """
    inside = solid[data]
    if not inside.any():
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64), *(np.empty(0, np.uint64) for _ in prefixes)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(data)]
    starts[heads] |= inside[heads]
    hashes, begin, *more = run_hashes(data, inside, starts, prefixes)
    return hashes, np.searchsorted(begin, ends).astype(np.int64), *more


def run_hashes(
    data: np.ndarray, inside: np.ndarray, starts: np.ndarray, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """Hashes and first places of the runs of bytes `inside` that begin at `starts`, and hashes of beginnings."""
    begin = np.flatnonzero(starts)
    letters = data[inside]
    # Places of the words among the bytes that are no spaces.
    before = np.cumsum(inside, dtype=np.int64)
    first = before[begin] - 1
    length = np.diff(np.append(first, len(letters)))
    place = np.arange(len(letters), dtype=np.int64) - np.repeat(first, length)
    value = _byte_table()[((place & 255) << 8) | letters]
    far = place > 255
    if far.any():
        value[far] *= (place[far].astype(np.uint64) >> np.uint64(8)) * np.uint64(2) + np.uint64(1)
    more = []
    for k in prefixes:
        head = mixed(np.add.reduceat(np.where(place < k, value, np.uint64(0)), first) + np.uint64(k))
        more.append(np.where(length >= k, head, np.uint64(0)))
    return mixed(np.add.reduceat(value, first)), begin, *more


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; the last n - 1 places have none."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[k : k + len(out)]
    return mixed(out)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case; other letters stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def sliced(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of each is at most `limit` bytes, or one row.

    Bounds what a task holds at once, however long the texts are.
    """
    for batch in batches:
        sizes = np.diff(string_bytes(batch.column(text))[1])
        start = 0
        while start < batch.num_rows:
            held = np.cumsum(sizes[start:])
            rows = max(1, int(np.searchsorted(held, limit, side="right")))
            yield batch.slice(start, rows)
            start += rows
        # Arrow's allocator otherwise keeps what the largest batch took.
        pa.default_memory_pool().release_unused()


class Forest:
    """Union-find over 0..n-1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.parent))], dtype=np.int64)
