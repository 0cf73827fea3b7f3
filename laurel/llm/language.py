"""Language of texts by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from laurel.llm.tasks import sliced

BATCH_BYTES = 1 << 19
# N-grams of a language's profile and of a document's.
PROFILE = 300
UNKNOWN = "und"
_SPACE = 0x20
_LETTER: list[np.ndarray] = []


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 0 by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once in a worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of letters of a text in lower case; runs of other characters are one space.

    Empty without letters. A code holds up to three code points of 21 bits; grams of spaces alone are left out.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    line = np.where(letter, points, _SPACE)[keep]
    line = np.concatenate([[_SPACE], line, [_SPACE]] if line[-1] != _SPACE else [[_SPACE], line]).astype(np.int64)
    two = (line[:-1] << 21) | line[1:]
    three = (two[:-1] << 21) | line[2:]
    return np.concatenate([line[line != _SPACE], two, three])


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    head = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[head], np.diff(np.append(head, len(codes)))


def ranked(codes: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The `most` most frequent codes in the order of their ranks; ties by code."""
    if len(codes) > 4 * most:
        cut = np.partition(counts, len(counts) - most)[len(counts) - most]
        near = counts >= cut
        codes, counts = codes[near], counts[near]
    return codes[np.lexsort((codes, -counts))[:most]]


def learn_profiles(labelled: DataFrame, most: int = PROFILE) -> dict[str, list[int]]:
    """Profile of each language: its `most` most frequent n-grams over all rows of (text, lang), by rank.

    Counts are summed in each task before the shuffle. The driver gets `most` codes per language. Rows whose
    text or lang is null, or without letters, teach nothing.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", BATCH_BYTES):
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for lang in dict.fromkeys(langs):
                whole = [grams(t) for t, x in zip(texts, langs) if x == lang]
                codes, n = counted(np.concatenate(whole))
                if len(codes):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(n.astype(np.int64))], names=["lang", "code", "n"])

    known = labelled.where("text is not null and lang is not null").select("text", "lang")
    summed = known.mapInArrow(counts, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code")).alias("place")
    rows = summed.select("lang", "code", place).where(F.col("place") <= most).orderBy("lang", "place").collect()
    profiles: dict[str, list[int]] = {}
    for row in rows:
        profiles.setdefault(row.lang, []).append(row.code)
    return profiles


class Profiles:
    """Ranks of the n-grams of all languages, for the distance of a document to each."""

    def __init__(self, profiles: dict[str, list[int]], most: int = PROFILE):
        self.langs, self.most = sorted(profiles), most
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], np.int64))
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[k, np.searchsorted(self.codes, profiles[lang])] = np.arange(len(profiles[lang]))

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language of the smallest out-of-place distance (ties: by name), and a score from 0 to 1.

        An n-gram that a profile lacks counts `most` places. The score is 1 less the share that the distance
        is of the largest possible one.
        """
        own = grams(text) if text else np.empty(0, np.int64)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        top = ranked(*counted(own), self.most)
        at = np.searchsorted(self.codes, top)
        known = (at < len(self.codes)) & (self.codes[np.minimum(at, len(self.codes) - 1)] == top)
        ranks = self.ranks[:, np.where(known, at, len(self.codes))]
        away = np.where(ranks < 0, self.most, np.abs(ranks - np.arange(len(top))))
        total = np.minimum(away, self.most).sum(axis=1)
        best = int(np.argmin(total))
        return self.langs[best], float(1 - total[best] / (self.most * len(top)))


def identify(documents: DataFrame, profiles: dict[str, list[int]], most: int = PROFILE) -> DataFrame:
    """(lang_pred, score, row) of each row of `documents`: the language of its whole text, and the input row.

    lang_pred is 'und' and score 0 if the text is null or has no letter. Only the text is looked at. Further
    columns, whatever their names, are in `row`; an empty table gives an empty one.
    """

    @F.pandas_udf("lang_pred string, score double")
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Profiles(profiles, most)
        for texts in parts:
            yield pd.DataFrame([known.judge(t) for t in texts], columns=["lang_pred", "score"])

    found = documents.select(judged("text").alias("judged"), F.struct("*").alias("row"))
    return found.select("judged.lang_pred", "judged.score", "row")


def language_of_documents(documents: DataFrame) -> DataFrame:
    """`identify` with profiles learnt from the documents that are not held out; adds doc_id and held_out."""
    training = documents.where(~held_out(F.col("doc_id")))
    found = identify(documents, learn_profiles(training))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "row")


def keep_known_languages(documents: DataFrame) -> DataFrame:
    """`documents` without those whose language cannot be told: no text, or not a letter in it.

    Also where nothing was learnt, as without any language given: texts with a letter stay. Rows pass through
    the task in slices of text and come out as they are.
    """
    profiles = learn_profiles(documents.where(~held_out(F.col("doc_id"))))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles)
        for batch in sliced(batches, "text", BATCH_BYTES):
            texts = batch.column("text").to_pylist()
            if profiles:
                stays = [known.judge(t)[0] != UNKNOWN for t in texts]
            else:
                stays = [bool(t) and any(c.isalpha() for c in t.lower()) for t in texts]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return documents.mapInArrow(kept, documents.schema)
