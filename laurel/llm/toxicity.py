"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from laurel.llm.language import held_out
from laurel.llm.tasks import SPACES, sliced, solid_bytes, string_bytes, word_hashes
from laurel.session import stored_copy

BATCH_BYTES = 1 << 20
# Labelled rows that the models are fitted on at most, about; with fewer labels all are used.
TRAINING_ROWS = 60_000
# Terms of the learnt lexicon at most, and documents of label 1 that a term needs.
TERMS = 5000
LEAST_DOCUMENTS = 4
LEAST_WEIGHT = 2.0
# Word beginnings, in bytes, that count as terms besides whole words.
PREFIXES = (4, 5, 6)
NEAR = 6
# Second-person words.
SECOND_PERSON = (
    "you your yours yourself ya u du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "usted ustedes ti tus contigo vosotros"
).split()
# Characters that stand for letters in disguised words.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LETTERS = solid_bytes(bytes(range(33)) + bytes(c for c in range(33, 128) if not chr(c).isalpha()))
FEATURES = (
    "log_words", "hits", "density", "weight", "strongest", "near_second_person", "second_person",
    "capitals", "shouted", "punctuation", "exclamations", "digits", "disguised", "disguised_hits", "stretched",
)


def _terms(column: pa.Array) -> tuple[np.ndarray, ...]:
    data, ends = string_bytes(pc.utf8_lower(column.fill_null("")))
    return word_hashes(data, ends, _LETTERS, PREFIXES)


def learn_lexicon(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Terms (hashes, ascending) that mark documents of label 1, and their log-odds, from rows (text, label).

    A term is a word in lower case or its beginning. Document counts are summed in tasks before the shuffle;
    at most TERMS rows come to the driver.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            words, at, *heads = _terms(batch.column("text"))
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            term = np.concatenate([words, *heads])
            pairs = np.stack([np.tile(owner, 1 + len(heads)).astype(np.uint64), term])[:, term != 0]
            order = np.lexsort(pairs)
            doc, term = pairs[0][order].astype(np.int64), pairs[1][order]
            new = np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])) if len(term) else np.empty(0, bool)
            term, label = term[new], np.asarray(batch.column("label").cast(pa.int64()))[doc[new]]
            value, code = np.unique(term, return_inverse=True)
            ones = np.bincount(code, weights=label, minlength=len(value)).astype(np.int64)
            both = np.bincount(code, minlength=len(value)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(ones), pa.array(both)], names=["term", "ones", "both"])

    sizes = labelled.agg(F.sum("label").alias("ones"), F.count("*").alias("both")).first()
    ones, zeros = int(sizes.ones or 0), int(sizes.both - (sizes.ones or 0))
    summed = labelled.select("text", "label").mapInArrow(counts, "term long, ones long, both long").groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("both").alias("both"))
    weight = F.log((F.col("ones") + 0.5) / F.lit(ones + 1.0)) - F.log((F.col("both") - F.col("ones") + 0.5) / F.lit(zeros + 1.0))
    chosen = summed.where(F.col("ones") >= LEAST_DOCUMENTS).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
    rows = chosen.orderBy(F.desc(F.col("weight") * F.log1p("ones")), "term").limit(TERMS).select("term", "weight").toPandas()
    terms = rows["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(terms)
    return terms[order], rows["weight"].to_numpy(float)[order]


def _looked_up(words: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weight of each word, 0 for those that are no terms."""
    if not len(terms) or not len(words):
        return np.zeros(len(words))
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    return np.where(terms[at] == words, weights[at], 0.0)


def _per_text(values: np.ndarray, at: np.ndarray, ufunc: np.ufunc = np.add) -> np.ndarray:
    out = np.zeros(len(at) - 1)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        out[some] = ufunc.reduceat(values.astype(float), at[some])
    return out


def text_features(column: pa.Array, terms: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Dense features of each whole text; all 0 for null and empty texts."""
    column = column.fill_null("")
    words, at, *heads = _terms(column)
    weight = _looked_up(words, terms, weights)
    for head in heads:
        weight = np.maximum(weight, _looked_up(head, terms, weights))
    hit = weight > 0
    you = np.isin(words, _second_person())
    count = np.maximum(np.diff(at), 1)
    # A hit is near a second-person word of the same text if at most NEAR words lie between.
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place, seats = np.flatnonzero(hit), np.flatnonzero(you)
    near = np.zeros(len(words), bool)
    if len(place) and len(seats):
        after = np.searchsorted(seats, place)
        for side in (np.minimum(after, len(seats) - 1), np.maximum(after - 1, 0)):
            near[place] |= (np.abs(seats[side] - place) <= NEAR) & (owner[seats[side]] == owner[place])
    data, ends = string_bytes(column)
    kinds = _kinds()
    per_byte = lambda mask: _per_text(mask, ends)
    size = np.maximum(np.diff(ends), 1)
    upper = kinds["upper"][data]
    shouted = np.zeros(len(data), bool)
    shouted[1:] = upper[1:] & upper[:-1]
    stretched = np.zeros(len(data), bool)
    stretched[2:] = kinds["letter"][data[2:]] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    # Disguised words: look-alikes become letters, other punctuation between letters goes.
    plain = kinds["plain"][data]
    keep = (plain != 0) | kinds["space"][data]
    kept_ends = np.append(0, np.cumsum(keep))[ends]
    shown, shown_at, *shown_heads = word_hashes(np.where(kinds["space"][data], data, plain)[keep], kept_ends)
    disguise = kinds["disguise"][data]
    token_hit = _looked_up(shown, terms, weights) > 0
    odd_inside = np.zeros(len(data), bool)
    odd_inside[1:-1] = disguise[1:-1] & kinds["letter"][data[:-2]] & kinds["letter"][data[2:]]
    hits = _per_text(hit, at)
    features = {
        "log_words": np.log1p(np.diff(at)),
        "hits": np.log1p(hits),
        "density": hits / count,
        "weight": _per_text(weight, at) / count,
        "strongest": _per_text(weight, at, np.maximum),
        "near_second_person": _per_text(near, at) / count,
        "second_person": _per_text(you, at) / count,
        "capitals": per_byte(upper) / size,
        "shouted": per_byte(shouted) / size,
        "punctuation": per_byte(kinds["punctuation"][data]) / size,
        "exclamations": per_byte(data == 33) / size,
        "digits": per_byte(kinds["digit"][data]) / size,
        "disguised": per_byte(odd_inside) / count,
        "disguised_hits": np.maximum(_per_text(token_hit, shown_at) - _per_text(_looked_up(words, terms, weights) > 0, at), 0),
        "stretched": per_byte(stretched) / size,
    }
    return {name: features[name] for name in FEATURES}


_CACHED: dict[str, object] = {}


def _second_person() -> np.ndarray:
    if "you" not in _CACHED:
        data, ends = string_bytes(pa.array(SECOND_PERSON))
        _CACHED["you"] = word_hashes(data, ends, _LETTERS)[0]
    return _CACHED["you"]


def _kinds() -> dict[str, np.ndarray]:
    if "kinds" not in _CACHED:
        code = np.arange(256)
        letter = ((code >= 65) & (code <= 90)) | ((code >= 97) & (code <= 122)) | (code >= 128)
        plain = np.where((code >= 65) & (code <= 90), code + 32, np.where(letter, code, 0)).astype(np.uint8)
        for sign, meant in LOOKALIKES.items():
            plain[ord(sign)] = ord(meant)
        flag = lambda chars: np.isin(code, list(chars))
        _CACHED["kinds"] = {
            "letter": letter, "upper": (code >= 65) & (code <= 90), "plain": plain, "space": flag(SPACES),
            "punctuation": flag(_PUNCTUATION), "digit": (code >= 48) & (code <= 57),
            "disguise": flag("".join(LOOKALIKES).encode() + b"*#_-."),
        }
    return _CACHED["kinds"]


def with_features(documents: DataFrame, terms: np.ndarray, weights: np.ndarray, held: Sequence[str] = ()) -> DataFrame:
    """doc_id, FEATURES and the columns `held` of each row of `documents`."""
    kept = documents.select("doc_id", "text", *held)
    types = {f.name: f.dataType.simpleString() for f in kept.schema}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            found = text_features(batch.column("text"), terms, weights)
            columns = [batch.column("doc_id").cast(pa.int64()), *(pa.array(found[n]) for n in FEATURES), *(batch.column(c) for c in held)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *FEATURES, *held])

    made = [f"{n} double" for n in FEATURES] + [f"{c} {types[c]}" for c in held]
    return kept.mapInArrow(rows, "doc_id long, " + ", ".join(made))


def labelled_rows(documents: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, text, label, stands_for, fold) to learn from: labelled, not held out, a sample of about `most` rows.

    The sample goes by a hash of the id, and keeps all of the rarer label that half of `most` allows. `stands_for`
    is the number of rows that a drawn one stands for; as weights, they keep the labels in their true proportion.
    Ids with contradicting labels give the larger label. An id gives one row, however often it occurs: with the
    least of its texts in code-point order.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    known = known.where(~held_out(F.col("doc_id")))
    share = F.lit(most / 2) / F.col("n")
    sizes = known.groupBy("label").agg(F.count("*").alias("n"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # Two rows, one per label.
    stands_for = F.greatest(1 / share, F.lit(1.0)).alias("stands_for")
    drawn = known.join(F.broadcast(sizes), "label").where(draw < share).select("doc_id", "label", stands_for)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(10)).cast("int").alias("fold")
    # About `most` rows of three numbers at every corpus size, so only texts that are learnt from are shuffled, one
    # of each id and task.
    text = F.coalesce("text", F.lit(""))
    found = documents.select("doc_id", text.alias("text")).join(F.broadcast(drawn), "doc_id")
    return found.groupBy("doc_id", "label", "stands_for").agg(F.min("text").alias("text")).select("doc_id", "text", "label", "stands_for", fold)


def toxicity(
    documents: DataFrame, labels: DataFrame, rounds: int = 20, depth: int = 4, seed: int = 11, most: int = TRAINING_ROWS
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The labelled documents that are not held out, a bounded sample of them, are dealt into folds: five teach
    the lexicon, three the trees and two the isotonic calibration, so that no part is fitted on what an
    earlier one has seen. Trees and calibration weigh each row by those it was drawn for, so a score is a chance
    under the labels' own proportion, however much was thinned. Scores use the whole text of every document
    and nothing else; empty and null texts have features 0 and a score like others. Repeated and null ids get
    a row each; an id that repeats is learnt from once. Without labels of both kinds the score is the share of label 1 (0 without any). Further
    columns are ignored.
    """
    training = stored_copy(labelled_rows(documents, labels, most))
    held = held_out(F.col("doc_id")).alias("held_out")
    kinds = {r.label: r.n for r in training.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        share = float(next(iter(kinds), 0))
        flat = documents.select("doc_id", held, F.lit(share).alias("score"))
        return flat.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    terms, weights = learn_lexicon(training.where("fold < 5"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    rest = training.where("fold >= 5")
    features = stored_copy(with_features(rest, terms, weights, held=("label", "stands_for", "fold")))
    rest = assembler.transform(features).select("features", F.col("label").cast("double").alias("label"), "stands_for", "fold")
    grown = rest.where("fold < 8").cache()
    if grown.select("label").distinct().count() < 2:
        grown = rest.cache()
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=seed, weightCol="stands_for", minInstancesPerNode=5, maxBins=64).fit(grown)
    grown.unpersist()
    raw = vector_to_array("probability")[1].alias("raw")
    calibration = trees.transform(rest.where("fold >= 8")).select(raw, "label", "stands_for")
    calibrated = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="stands_for").fit(calibration) if not calibration.isEmpty() else None
    scored = trees.transform(assembler.transform(with_features(documents, terms, weights))).select("doc_id", raw)
    if calibrated is not None:
        scored = calibrated.transform(scored).withColumnRenamed("prediction", "score")
    else:
        scored = scored.withColumnRenamed("raw", "score")
    score = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score")
    return scored.select("doc_id", held, score).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
