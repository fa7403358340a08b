"""Words, sizes and small helpers that the operators of this subpackage share."""

from __future__ import annotations

import pickle
import string
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the plain kind is a run of anything but these characters.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` alone would also change other scripts."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    """Number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def bucket(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


Model = TypeVar("Model")


def fitted(sample: DataFrame, fit: Callable[[list[tuple]], Model]) -> Model:
    """The model that ``fit`` makes of a bounded sample's rows, in the order of their values.

    One task holds the sample, so the driver gets no texts, only the model.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(sorted(rows)))], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(found[0]["model"])) if found else fit([])
