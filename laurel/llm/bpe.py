"""Exact BPE ids by dynamic programming over the prefixes of words, and the texts of ids."""

from __future__ import annotations

import json
import re
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from laurel.llm.tasks import sliced

# Text encoded at once by a task, and ids decoded at once.
BATCH_BYTES = 2 << 20
# Encoded pieces, transitions and tested pairs that a worker remembers, each, about.
REMEMBERED = 500_000
# Longer pieces are encoded anew each time.
LONGEST_REMEMBERED = 64

_NEVER = 1 << 60
# Two numbers below 2 ** SHIFT, such as ids and states, make one key.
SHIFT = 24
# The ends of pieces: what Unicode calls white space. `str.split` also splits at the four separators below.
_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
_SEPARATORS = re.compile("[\\x1c-\\x1f]")
# Fixed value: a splitter under which letters in front of plain punctuation are one word each.
_LETTERS_APART = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Letters that are composed already and have one lower-case letter each.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_MODELS: dict[str, "Model"] = {}
_TOKENS: dict[str, list[str]] = {}


def tokens_by_id(parts: dict) -> list[str]:
    """Token of each id of a parsed file, special ones included; empty where an id has none."""
    held = {i: token for token, i in parts["model"]["vocab"].items()} | {t["id"]: t["content"] for t in parts["added_tokens"]}
    return [held.get(i, "") for i in range(max(held) + 1)]


class Model:
    """A BPE file as an automaton over its symbols, with the merges that build its tokens.

    The file must drop white space when it splits, merge by rank only (no dropout, no unknown token), and have
    no decoder, so that the text of ids is their tokens joined by a space. Other files raise ValueError. The
    tokenizers library only normalises and splits text into words here; the ids come from `word_ids`.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model, splitters = parts["model"], (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        drops = splitters[0].get("type") == "Split" and splitters[0]["behavior"] == "Removed" and splitters[0]["invert"]
        if model["type"] != "BPE" or not plain or not drops or parts["decoder"] or parts["post_processor"]:
            raise ValueError(f"{path}: needs a plain BPE model whose splitter drops white space, without decoder")
        library = Tokenizer.from_file(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.tokens = tokens_by_id(parts)
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        # How the splitter writes the bytes of letters beyond ASCII.
        self.byte_letters = {}
        for letter in map(chr, range(0xC0, 0x100)):
            written = "".join(word for word, _ in self.split(letter)) if letter not in "×÷" else ""
            self.byte_letters.update(zip(letter.encode(), written) if len(written) == 2 else ())
        lower = (parts["normalizer"] or {}).get("normalizers", [])
        self.letters_apart = splitters[0]["pattern"] == {"Regex": _LETTERS_APART} and [n["type"] for n in lower] == ["NFC", "Replace", "Lowercase"]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        # Rank of each merge, and of each token the merge and the parts that make it.
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, token = self.vocabulary[a], self.vocabulary[b], self.vocabulary[a + b]
            if token in self.made or any(self.made[t][0] > rank for t in (left, right) if t in self.made):
                raise ValueError(f"{path}: merge {rank} does not follow the merges of its parts")
            self.rank[left, right] = rank
            self.made[token] = (rank, left, right)
        self.tested: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self._build_automaton()

    def _build_automaton(self) -> None:
        """Trie over the symbols of all tokens, suffix links, and the tokens that end in each state, longest first."""
        symbols = {t: (t,) for t in self.vocabulary.values() if t not in self.made}
        whole = set(symbols)
        for token, (_, left, right) in self.made.items():
            symbols[token] = symbols[left] + symbols[right]
            # Of tokens that BPE would write otherwise, none is in any encoding.
            if left in whole and right in whole and self.meeting(left, right) == (left, right):
                whole.add(token)
        # Next state of (state, symbol), both in one number.
        self.step: dict[int, int] = {}
        children: list[list[tuple[int, int]]] = [[]]
        ends: list[tuple[int, ...]] = [()]
        for token in whole:
            state = 0
            for symbol in symbols[token]:
                key = state << SHIFT | symbol
                if key not in self.step:
                    self.step[key] = len(children)
                    children[state].append((symbol, len(children)))
                    children.append([])
                    ends.append(())
                state = self.step[key]
            ends[state] = (token,)
        self.link = [0] * len(children)
        queue = deque(state for _, state in children[0])
        while queue:
            state = queue.popleft()
            ends[state] += ends[self.link[state]]
            for symbol, child in children[state]:
                queue.append(child)
                self.link[child] = self._after(self.link[state], symbol)
        self.ends = [tuple((t, len(symbols[t])) for t in own) for own in ends]
        self.length = {t: len(symbols[t]) for t in whole}
        self.transitions = len(self.step) + REMEMBERED

    def _after(self, state: int, symbol: int) -> int:
        """State after `symbol`: the longest beginning of a token that the symbols so far end with."""
        while state and state << SHIFT | symbol not in self.step:
            state = self.link[state]
        return self.step.get(state << SHIFT | symbol, 0)

    def _rim(self, token: int, part: int) -> list[tuple[int, int]]:
        """What stands at the edge of `token` while it is built: (token, rank of the merge that takes it up).

        `part` is 1 for its left edge and 2 for its right one; the symbol comes first, the whole token last.
        """
        rim = [(token, _NEVER)]
        while token in self.made:
            rank = self.made[token][0]
            token = self.made[token][part]
            rim.append((token, rank))
        return rim[::-1]

    def meeting(self, a: int, b: int) -> tuple[int, int] | None:
        """The first two tokens that merge across the boundary when `a` is followed by `b`; None if none do.

        Merges come by rank, of equal ranks the left one first.
        """
        left, right = self._rim(a, 2), self._rim(b, 1)
        i = j = 0
        while True:
            (x, x_goes), (y, y_goes) = left[i], right[j]
            rank = self.rank.get((x, y), _NEVER)
            if rank < x_goes and rank <= y_goes and rank != _NEVER:
                return x, y
            if x_goes == y_goes == _NEVER:
                return None
            if x_goes <= y_goes:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves `a` and `b` as they are when `b` follows `a`."""
        found = self.tested.get(a << SHIFT | b)
        if found is None:
            if len(self.tested) > REMEMBERED:
                self.tested.clear()
            found = self.tested[a << SHIFT | b] = self.meeting(a, b) is None
        return found

    def word_ids(self, symbols: list[int]) -> list[int]:
        """Ids of one word. Each prefix has one encoding, so its last token is stored and the rest is behind it.

        The last token of a prefix is the one among the tokens that end there that is compatible with the last
        token of the prefix before it.
        """
        step, ends, length, tested = self.step.get, self.ends, self.length, self.tested.get
        last: list[int] = []
        state = 0
        for place, symbol in enumerate(symbols, 1):
            key = state << SHIFT | symbol
            state = step(key)
            if state is None:
                state = self._after(key >> SHIFT, symbol)
                if len(self.step) < self.transitions:
                    self.step[key] = state
            for token, size in ends[state]:
                if size == place:
                    break
                found = tested(last[-size] << SHIFT | token)
                if found or found is None and self.compatible(last[-size], token):
                    break
            else:
                raise ValueError(f"no encoding of the prefix of {place} symbols")
            last.append(token)
        ids = []
        place = len(symbols)
        while place:
            ids.append(last[place - 1])
            place -= length[ids[-1]]
        return ids[::-1]

    def words_ids(self, word: str) -> bytes:
        """Ids of one word of the splitter, remembered."""
        ids = self.words.get(word)
        if ids is None:
            symbols = [self.vocabulary[c] for c in word[:-1]]
            symbols.append(self.vocabulary[word[-1] + self.suffix])
            ids = array("I", self.word_ids(symbols)).tobytes()
            if len(word) <= LONGEST_REMEMBERED:
                self.words[word] = ids
        return ids

    def plain_ids(self, piece: str) -> bytes | None:
        """Ids of common letters with punctuation behind them; None for other pieces."""
        letters = piece.rstrip(_PUNCTUATION)
        if not _LETTERS.fullmatch(letters):
            return None
        word = letters.lower()
        ids = self.words_ids(word if word.isascii() else word.encode().decode("latin-1").translate(self.byte_letters))
        return ids + self.words_ids(piece[len(letters) :]) if len(letters) < len(piece) else ids

    def pieces_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of texts without white space and special tokens, normalised and split as one line."""
        line = self.normalise(" ".join(pieces))
        parts = line.split(" ")
        if len(parts) != len(pieces):
            raise ValueError("the normaliser moved white space")
        found: list[list[bytes]] = [[] for _ in pieces]
        k, end = 0, len(parts[0])
        for word, (start, _) in self.split(line):
            while start >= end:
                k += 1
                end += 1 + len(parts[k])
            found[k].append(self.words_ids(word))
        return [b"".join(x) for x in found]

    def special_ids(self, piece: str) -> bytes:
        """Ids of a text without white space that holds special tokens."""
        ids = b""
        for part in self.special_pattern.split(piece):
            if part in self.special:
                ids += array("I", [self.special[part]]).tobytes()
            elif part:
                ids += self.pieces_ids([part])[0]
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit integers. Words never span white space."""
        for memory in ("known", "words"):
            held = getattr(self, memory)
            if len(held) > REMEMBERED:
                # Frequent pieces come early, so the older half stays.
                setattr(self, memory, dict(islice(held.items(), REMEMBERED // 2)))
        split = [_SPACE.sub(" ", t).strip(" ").split(" ") if _SEPARATORS.search(t) else t.split() for t in texts]
        known = self.known
        fresh: dict[str, bytes | None] = dict.fromkeys(set().union(*split).difference(known, ("",)))
        if any(token in t for token in self.special for t in texts):
            fresh.update((p, self.special_ids(p)) for p in fresh if self.special_pattern.search(p))
        if self.letters_apart:
            fresh.update((p, self.plain_ids(p)) for p, x in fresh.items() if x is None)
        other = [p for p, x in fresh.items() if x is None]
        for k in range(0, len(other), 1000):
            fresh.update(zip(other[k : k + 1000], self.pieces_ids(other[k : k + 1000])))
        known.update((p, x) for p, x in fresh.items() if len(p) <= LONGEST_REMEMBERED)
        known, fresh[""] = known.get, b""
        return [b"".join([known(p) or fresh[p] for p in pieces]) for pieces in split]


def model(path: str) -> Model:
    """The model of a file, built once in a worker."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def tokens_of(path: str) -> list[str]:
    """`tokens_by_id` of a file, read once in a worker."""
    if path not in _TOKENS:
        with open(path, encoding="utf-8") as file:
            _TOKENS[path] = tokens_by_id(json.load(file))
    return _TOKENS[path]


def encode(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of the whole text of every row, by the BPE file at `path`, without added tokens.

    Null and empty texts, and those of white space only, have no ids. Strings of special tokens in a text become
    their ids, as in the tokenizers library. Null and repeated doc_ids are rows like others; an empty table gives
    an empty one; further columns, whatever their names, are not looked at. Rows stay where they are: nothing is
    shuffled, and a task holds a slice of text and its ids.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path)
        for batch in sliced(batches, "text", BATCH_BYTES):
            blobs = known.encode(batch.column("text").fill_null("").to_pylist())
            counts = np.array([len(x) // 4 for x in blobs], np.int64)
            values = pa.array(np.frombuffer(b"".join(blobs), "<u4").astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), lists], names=["doc_id", "n_tokens", "ids"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(encoded, f"doc_id {kind}, n_tokens long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """`tokens` (doc_id, n_tokens, ids) with the text of the ids: their tokens joined by a space.

    Special tokens are part of it. Null ids give an empty text; an id that the file does not have is an error.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens_of(path).__getitem__
        for batch in batches:
            ids = batch.column("ids")
            stops = np.asarray(ids.offsets)
            start = 0
            while start < batch.num_rows:
                rows = max(1, int(np.searchsorted(stops[start + 1 :] - stops[start], BATCH_BYTES // 4, side="right")))
                part = batch.slice(start, rows)
                texts = pa.array([" ".join(map(token, x or ())) for x in part.column("ids").to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, "text"])
                start += rows

    kind = tokens.schema["doc_id"].dataType.simpleString()
    rows = tokens.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(decoded, f"doc_id {kind}, n_tokens long, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of `decode`: hashes of the decimal ids joined by a space, and of the text."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", "n_tokens", F.sha2(decimal, 256).alias("ids_sha256"), F.sha2(F.col("text"), 256).alias("decoded_sha256"))
