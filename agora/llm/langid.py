"""Language identification by a blended-spectrum string kernel.

Two texts are compared by the n-grams (1 to ``LONGEST`` bytes, hashed to ``BINS`` bins) that both hold: the kernel is the
number of shared bins over the root of the product of their numbers of bins. Landmark texts span a Nyström space, and
one ridge regression per language, one versus rest, is solved in it. Scoring is one matrix product of a batch's presence
rows with the landmarks' and one with the regression weights.

The model is learned from a bounded sample: of every language the different rows whose hash of id and text is below a
rate, about ``PER_LANGUAGE`` of them at most, copies counting once; so neither one id nor one text on very many rows
makes it larger or empties it. Each text is used whole, in training and in scoring.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.hashing import texts_of
from agora.llm.text import bucket, fitted

LONGEST = 4
BINS = 1 << 14
PER_LANGUAGE = 800
LANDMARKS = 192
RIDGE = 1e-3
SHARPNESS = 4.0  # of the softmax that turns the regressions into a score between 0 and 1
ROWS = 256  # texts of one matrix product
PIECE = 1 << 18  # bytes that are hashed at a time
UNKNOWN = "und"

_LETTER = np.full(256, 0x20, dtype=np.uint32)
_LETTER[128:] = np.arange(128, 256)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_STEPS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def presence(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 0/1 row of hashed n-grams for each text; text i is data[bounds[i]:bounds[i + 1]]."""
    out = np.zeros((len(bounds) - 1, BINS), dtype=np.float32)
    lo, hi = int(bounds[0]), int(bounds[-1])
    for at in range(lo, hi, PIECE):
        piece = _LETTER[data[at : min(at + PIECE + LONGEST - 1, hi)]]
        count = min(PIECE, hi - at)
        places = np.arange(at, at + len(piece))
        owner = np.searchsorted(bounds, places, side="right") - 1
        code = np.zeros(count, dtype=np.uint32)
        for n in range(LONGEST):
            size = min(count, len(piece) - n)
            if size <= 0:
                break
            code = code[:size] * np.uint32(31) + piece[n : n + size] * _STEPS[n]
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
            mixed = (mixed ^ (mixed >> np.uint32(12))) * np.uint32(0x297A2D39)
            inside = owner[n : n + size] == owner[:size]
            out[owner[:size][inside], (mixed[inside] >> np.uint32(18))] = 1.0
    return out


def _batches(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for at in range(0, len(offsets) - 1, ROWS):
        yield at, min(at + ROWS, len(offsets) - 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    landmarks: np.ndarray  # presence rows over the root of their sums, transposed
    weights: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1.0))
        margins = ((rows @ self.landmarks) / size) @ self.weights
        raised = np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
        return raised / raised.sum(axis=1, keepdims=True)


def fit(languages: list[str], texts: list[str]) -> LanguageModel | None:
    """The model of labelled texts, in the given order; None without any."""
    names = sorted(set(languages))
    if not names:
        return None
    column = pa.array(texts, type=pa.string())
    data, offsets = texts_of(column)
    label = np.array([names.index(x) for x in languages])
    # Landmarks: the first texts of each language in turn.
    turn = np.empty(len(label), dtype=np.int64)
    for k in range(len(names)):
        turn[label == k] = np.arange((label == k).sum())
    chosen = np.sort(np.lexsort((label, turn))[:LANDMARKS])
    spots = [presence(data, offsets[i : i + 2]) for i in chosen]
    marks = np.concatenate(spots)
    marks /= np.sqrt(np.maximum(marks.sum(axis=1, keepdims=True), 1.0))
    kernel = []
    for at, end in _batches(offsets):
        rows = presence(data, offsets[at : end + 1])
        kernel.append((rows @ marks.T) / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1.0)))
    to_marks = np.concatenate(kernel).astype(np.float64)
    values, vectors = np.linalg.eigh(to_marks[chosen])
    keep = values > 1e-6 * max(values.max(), 1e-12)
    half = vectors[:, keep] / np.sqrt(values[keep])
    features = to_marks @ half
    wanted = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    gram = features.T @ features + RIDGE * len(label) * np.eye(features.shape[1])
    return LanguageModel(names, marks.T.copy(), (half @ np.linalg.solve(gram, features.T @ wanted)).astype(np.float32))


def learn(docs: DataFrame, divisor: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Fit on the documents with a language and a text whose bucket is not ``held_out``."""
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("langid"), F.col("text"))
    known = docs.where("lang is not null and text is not null").where(bucket(F.col("doc_id"), divisor) != held_out)
    known = known.select(F.col("lang").cast("string").alias("lang"), "text", key.alias("key"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()
    rate = F.lit(0)
    for r in counts:
        rate = F.when(F.col("lang") == r["lang"], int((1 << 30) * min(1.0, per_language / max(1, r["n"])))).otherwise(rate)
    picked = known.where(F.pmod("key", F.lit(1 << 30)) < rate)
    # Copies of a row, however many, are one row of the sample.
    sample = picked.groupBy("key", "lang").agg(F.first("text").alias("text"))
    return fitted(sample, lambda rows: fit([lang for _, lang, _ in rows], [text for _, _, text in rows]))


def has_letter(text: str | None) -> bool:
    return text is not None and any(unicodedata.category(c)[0] == "L" for c in text)


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred and score for every row of (doc_id, text).

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: landmarks x bins and languages

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column(1)
            lettered = [has_letter(x) for x in (y.as_py() for y in column)]
            names, best = [UNKNOWN] * len(column), np.zeros(len(column))
            if model is not None:
                data, offsets = texts_of(column)
                for at, end in _batches(offsets):
                    scores = model.scores(presence(data, offsets[at : end + 1]))
                    first = scores.argmax(axis=1)
                    for i in range(at, end):
                        if lettered[i]:
                            names[i] = model.languages[first[i - at]]
                            best[i] = scores[i - at, first[i - at]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, type=pa.string()), pa.array(best)], names=["doc_id", "lang_pred", "score"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {id_type}, lang_pred string, score double")


def document_languages(docs: DataFrame) -> DataFrame:
    """The result of the query. A null id counts as the empty text when rows are held out."""
    found = predict(docs, learn(docs))
    return found.select("doc_id", (bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
