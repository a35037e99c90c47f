"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents a classifier is fitted on, whatever the size of the corpus.
SAMPLE = 20_000


def fold(key: str, folds: int) -> Column:
    """The unsigned crc32 of the key's decimal text, modulo ``folds``; null stays null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, size: int = SAMPLE
) -> DataFrame:
    """Rows (doc_id, text, label) of up to ``size`` labelled keys outside the held-out fold.

    Keys are taken in the order of their hash, so the sample does not depend on how tables are
    laid out. Null labels and keys are passed over; of several labels of a key the smallest counts.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .dropna()
        .filter(fold("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
    )
    return docs.join(F.broadcast(chosen), "doc_id")  # ``size`` rows of two numbers
