"""Benchmark decontamination by template canonicalisation: typed slots, hashed windows, slot consistency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from laurel.llm.tasks import gram_hashes, mixed, run_hashes, sliced, string_bytes
from laurel.session import stored_copy

BATCH_BYTES = 1 << 20
WINDOW = 5
# Words of a window that may not be slots.
LITERALS = 3
# Covered words that are no chance, and the share of an item's words that shorter items need in their place.
SURE_WORDS = 13
SHORT_SHARE = 0.8
# Items with fewer words must be met whole and with their own values: their templates are common phrases.
WHOLE_BELOW = 8
# Size of the filter that spares most windows of the corpus the join, in bits; fixed, whatever the benchmark.
FILTER_BITS = 1 << 24
# Words for numbers and units.
NUMBER_WORDS = "zero two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million billion".split()
UNITS = (
    "km kilometer kilometers kilometre kilometres m meter meters metre metres cm centimeter centimeters mm mile miles "
    "yard yards foot feet ft inch inches kg kilogram kilograms g gram grams mg lb lbs pound pounds ounce ounces oz ton tons "
    "liter liters litre litres ml gallon gallons second seconds sec minute minutes min hour hours day days week weeks "
    "month months year years dollar dollars cent cents euro euros usd eur percent degree degrees mph kmh kwh watt watts"
).split()
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0xA3EC647659359ACD, 0x5851F42D4C957F2D, 0x14057B7EF767814F))
_CODES = np.arange(256)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_LETTER = ((_CODES >= 65) & (_CODES <= 90)) | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)
_FIXED: dict[str, np.ndarray] = {}


def _lower(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in lower case (A-Z and the Latin-1 letters) and where a capital was."""
    plain = (data >= 65) & (data <= 90)
    wide = np.zeros(len(data), bool)
    wide[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    capital = plain.copy()
    capital[:-1] |= wide[1:]
    return np.where(plain | wide, data + np.uint8(32), data), capital


def _fixed(words: list[str]) -> np.ndarray:
    data, ends = string_bytes(pa.array(words))
    starts = np.zeros(len(data), bool)
    starts[ends[:-1]] = True
    return run_hashes(data, np.ones(len(data), bool), starts)[0]


def canonical_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, named, slots, offsets) of all texts.

    Words are runs of letters or of digits (with points and commas inside); punctuation is left out. `words`
    has hashes of the lower-case words with numbers and units replaced by their types; in `named`, names are
    too: words with a capital that do not begin a sentence. `slots` has the value of each slot and 0 for
    literal words.
    """
    for key, words in (("numbers", NUMBER_WORDS), ("units", UNITS)):
        if key not in _FIXED:
            _FIXED[key] = _fixed(words)
    data, ends = string_bytes(column)
    if not len(data):
        empty = np.empty(0, np.uint64)
        return empty, empty, empty, np.zeros(len(ends), np.int64)
    lower, capital = _lower(data)
    digit, letter = _DIGIT[data], _LETTER[data]
    heads = ends[:-1][ends[:-1] < len(data)]
    point = np.zeros(len(data), bool)
    point[1:-1] = ((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]
    point[heads] = False
    number = digit | point
    inside = number | letter
    starts = inside.copy()
    starts[1:] &= ~((letter[1:] & letter[:-1]) | (number[1:] & number[:-1]))
    starts[heads] |= inside[heads]
    if not inside.any():
        empty = np.empty(0, np.uint64)
        return empty, empty, empty, np.zeros(len(ends), np.int64)
    values, begin = run_hashes(lower, inside, starts)
    at = np.searchsorted(begin, ends).astype(np.int64)
    is_number = digit[begin] | np.isin(values, _FIXED["numbers"])
    is_unit = np.isin(values, _FIXED["units"]) & ~is_number
    stop = np.isin(data, np.frombuffer(b".!?:\n\r", np.uint8)) & ~point
    stops = np.cumsum(stop)
    opens = np.append(True, stops[begin[1:]] != stops[begin[:-1]])
    opens[at[:-1][at[:-1] < len(begin)]] = True
    is_name = capital[begin] & ~opens & ~is_number & ~is_unit
    words = np.where(is_number, _NUMBER, np.where(is_unit, _UNIT, values))
    named = np.where(is_name, _NAME, words)
    slots = np.where(is_number | is_unit | is_name, values | np.uint64(1), np.uint64(0))
    return words, named, slots, at


def _windows(column: pa.Array, size: int) -> tuple[np.ndarray, ...]:
    """(hash, text number, first word, slot values of the window) of every window, in all readings.

    Names are words, or slots, in windows of at least LITERALS words. A window with more slots than that is
    taken with its real words and no placeholders, so that verbatim copies match whatever their share of slots.
    """
    words, named, slots, at = canonical_words(column)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    count = max(0, len(words) - size + 1)
    if not count:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, size), np.uint64)
    within = np.arange(count) + size <= at[owner[:count] + 1]
    views = np.lib.stride_tricks.sliding_window_view
    out = []
    typed = (words == _NUMBER) | (words == _UNIT)
    dense = views(typed, size).sum(axis=1) > size - LITERALS
    for reading, values in ((0, words), (1, named), (2, np.where(typed, slots, words))):
        fixed = typed | (values == _NAME)
        if reading == 0:
            use = within & ~dense
        elif reading == 1:
            use = within & (views(fixed, size).sum(axis=1) <= size - LITERALS) & views(values != words, size).any(axis=1)
        else:
            use = within & dense
        first = np.flatnonzero(use)
        kept = np.where(fixed, slots, np.uint64(0))
        out.append((gram_hashes(values, size)[first], owner[first], first - at[owner[first]], views(kept, size)[first]))
    return tuple(np.concatenate(x) for x in zip(*out))


_ROWS = "key long, id long, place int, slots array<long>"


def _window_rows(texts: DataFrame, id_column: str, size: int, bits: np.ndarray | None = None) -> DataFrame:
    """(key, id, place, slots) of the windows of `texts`, with `bits` those that pass the filter only."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            key, number, place, slots = _windows(batch.column("text"), size)
            if bits is not None:
                held = np.ones(len(key), bool)
                for spot in _spots(key):
                    held &= (bits[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1
                key, number, place, slots = key[held], number[held], place[held], slots[held]
            ids = batch.column("id").cast(pa.int64()).take(pa.array(number))
            offsets = pa.array(np.arange(len(key) + 1, dtype=np.int32) * size)
            lists = pa.ListArray.from_arrays(offsets, pa.array(slots.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids, pa.array(place.astype(np.int32)), lists], names=["key", "id", "place", "slots"])

    return texts.select(F.col(id_column).alias("id"), "text").where("id is not null and text is not null").mapInArrow(rows, _ROWS)


def _spots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each key in the filter."""
    spread = mixed(keys)
    mask = np.uint64(FILTER_BITS - 1)
    return (spread & mask).astype(np.int64), ((spread >> np.uint64(32)) & mask).astype(np.int64)


def _filter_bits(windows: DataFrame) -> np.ndarray:
    """Bloom filter of the keys of `windows`; FILTER_BITS / 64 rows reach the driver at most."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = np.unique(np.concatenate(_spots(np.asarray(batch.column("key")).view(np.uint64))))
            bit = np.left_shift(np.uint64(1), (spot & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(spot >> 6), pa.array(bit)], names=["word", "bit"])

    set_words = windows.select("key").mapInArrow(words, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[set_words["word"].to_numpy(np.int64)] = set_words["bits"].to_numpy(np.int64).view(np.uint64)
    return bits


def leaks(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, least: float = 0.5, consistent: float = 0.8) -> DataFrame:
    """Leaked items: (doc_id, item_id, covered, item_words, share, slots, consistency), one row per document and item.

    Texts become templates: numbers, units and names give way to typed slots, in one reading with names as
    words and in one with names as slots. Windows of `size` template words, of which at least LITERALS are
    words, are joined by hash; windows with fewer are joined by their real words. In a stretch of the document twice as long as the item, the item's words that
    matched windows cover must be a share of `least` or more, and SURE_WORDS words or a share SHORT_SHARE, so that a
    phrase which a short item shares with clean texts does not do; of items below WHOLE_BELOW words all, with their
    own values. Slots must be filled consistently: a value
    of the item goes to one value of the document for at least a share `consistent` of its values, as in a
    question asked again with other numbers. Of several stretches the best counts. A word of the item that
    windows align with several places, as clauses of one template do, takes its value from the alignment that
    covers most words of the item, or its own value where it met that: whichever agrees better.

    Windows of the corpus are first held against a Bloom filter of the benchmark's windows. The filter has a
    fixed size, so it may be sent to every task whatever the benchmark; what passes is joined by shuffle.
    A passage that many documents hold joins once per document and item. Items with fewer words than a window
    are not looked for. Null texts and ids match nothing; rows that repeat an id count as one document or item;
    further columns are ignored; an empty table on either side gives no leaks.
    """
    items = stored_copy(_window_rows(benchmark, "item_id", size).distinct())
    lengths = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").alias("id"), "text").mapInArrow(_lengths, "item_id long, item_words long")
    lengths = stored_copy(lengths.groupBy("item_id").agg(F.max("item_words").alias("item_words")))
    found = _window_rows(documents, "doc_id", size, _filter_bits(items))
    own = items.select("key", F.col("id").alias("item_id"), F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    met = found.join(own, "key").join(lengths, "item_id").select(
        F.col("id").alias("doc_id"), "item_id", "place", "item_place", "slots", "item_slots", "item_words"
    )
    # Stretches of two item lengths, one beginning at each multiple of the length.
    start = F.floor((F.col("place") - F.col("item_place")) / F.col("item_words"))
    met = met.withColumn("stretch", F.explode(F.array(start, start - 1)))
    pairs = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(size - 1)).alias("k"), "item_slots", "slots")).alias("x")
    # All that follows is grouped within a document and item, so this is the only shuffle of the matches.
    met = met.repartition("doc_id", "item_id")
    met = met.select("doc_id", "item_id", "stretch", "item_words", "item_place", (F.col("place") - F.col("item_place")).alias("shift"), pairs)
    zone = ["doc_id", "item_id", "stretch", "item_words"]
    words = met.select(*zone, "shift", (F.col("item_place") + F.col("x.k")).alias("word"), F.col("x.item_slots").alias("asked"), F.col("x.slots").alias("given"))
    # In one alignment a word meets one word; a reading that has it as a slot goes before one that does not.
    own = F.col("asked") == F.col("given")
    value = F.max(F.struct((F.col("asked") != 0).alias("slot"), own.alias("own"), "asked", "given")).alias("value")
    words = words.groupBy(*zone, "shift", "word").agg(value).select(*zone, "shift", "word", "value.*")
    words = words.withColumn("reach", F.count("*").over(Window.partitionBy(*zone, "shift")))
    # Two choices for each word: what the alignment of most words gives it, and its own value where it met that.
    aligned = F.max(F.struct("reach", "own", "slot", "asked", "given", "shift")).alias("aligned")
    equal = F.max(F.struct("own", "slot", "reach", "asked", "given", "shift")).alias("equal")
    words = words.groupBy(*zone, "word").agg(aligned, equal)
    # Bounded by the words of the item.
    sets = []
    for choice in ("aligned", "equal"):
        slot = F.col(f"{choice}.slot")
        sets.append(F.size(F.collect_set(F.when(slot, F.struct(f"{choice}.asked", f"{choice}.given")))).alias(f"{choice}_pairs"))
        sets.append(F.size(F.collect_set(F.when(slot, F.col(f"{choice}.asked")))).cast("long").alias(f"{choice}_slots"))
    zones = words.groupBy(*zone).agg(F.count("*").alias("covered"), F.count_if("equal.own").alias("own"), *sets)

    def judged(choice: str) -> Column:
        # Every value beyond one for a slot value is a contradiction.
        pairs, slots = F.col(f"{choice}_pairs"), F.col(f"{choice}_slots")
        agreed = F.when(slots > 0, 1 - (pairs - slots) / slots).otherwise(F.lit(1.0))
        return F.struct(F.greatest(agreed, F.lit(0.0)).alias("consistency"), slots.alias("slots"))

    zones = zones.withColumn("judged", F.greatest(judged("aligned"), judged("equal"))).select(*zone, "covered", "own", "judged.*")
    zones = zones.withColumn("share", F.col("covered") / F.col("item_words"))
    long_enough = (F.col("covered") >= SURE_WORDS) | (F.col("share") >= SHORT_SHARE)
    whole = (F.col("item_words") >= WHOLE_BELOW) | (F.col("own") == F.col("item_words"))
    zones = zones.where((F.col("share") >= least) & long_enough & whole & (F.col("consistency") >= consistent))
    best = F.max(F.struct("covered", "consistency", "slots", "share")).alias("best")
    out = zones.groupBy("doc_id", "item_id", "item_words").agg(best)
    return out.select("doc_id", "item_id", "best.covered", "item_words", "best.share", "best.slots", "best.consistency")


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = canonical_words(batch.column("text"))[3]
        yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(np.diff(at), pa.int64())], names=["item_id", "item_words"])


def drop_leaked(documents: DataFrame, benchmark: DataFrame, **how: float) -> DataFrame:
    """`documents` without those that hold an item of `benchmark`.

    Whether a row goes rests on its text alone, by its 64-bit hash, so rows with null or repeated ids are judged
    like others.
    """
    texts = documents.select(F.xxhash64("text").alias("doc_id"), "text")
    leaked = stored_copy(leaks(texts, benchmark, **how).select(F.col("doc_id").alias("text_hash")).distinct())
    return documents.join(leaked, F.xxhash64(documents["text"]) == leaked["text_hash"], "left_anti")
