"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run``
writes every stage's result as Parquet, reads it again for the next, and removes what is read no
more. All stages but the last return the columns of ``documents``.

Rows without an id go through every stage. The near-duplicate stage keeps one row of each group of
near copies, one without an id only if no row of the group has one. It tells rows apart by all their
columns, so texts that share an id are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, packing, pii, quality, simhash
from ledgerline.llm.common import drop_written, n_written, table, written

#: Columns of the near-duplicate stage: hashes of the text and of the whole row.
_TOLD, _WHOLE = "_text_hash", "_row_hash"


def _aside(docs: DataFrame) -> DataFrame:
    """The rows with all columns but id and text under names that no operator uses."""
    kept = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_aside_{i}") for i, c in enumerate(kept)])


def _back(rows: DataFrame, like: DataFrame, new_text: bool = True) -> DataFrame:
    """The columns of ``like`` from rows set aside; ``n_chars`` is the length of the present text."""
    kept = [c for c in like.columns if c not in ("doc_id", "text")]
    place = {c: F.col(f"_aside_{i}") for i, c in enumerate(kept)}
    if new_text and "n_chars" in place:
        place["n_chars"] = F.length("text").cast("long")
    return rows.select(*[place.get(c, F.col(c)).alias(c) for c in like.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the boosted trees score at their threshold or above."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: the first by id (null last), then by the hash
    of its text, then by the hash of the whole row."""
    given, docs = docs, _aside(docs)
    every = [f"`{c}`" for c in docs.columns]
    marked = docs.withColumns(
        {_TOLD: F.xxhash64("text"), _WHOLE: F.xxhash64(*every, *[F.col(c).isNull() for c in every])}
    )
    prints = written(simhash.fingerprints(marked, carry=(_TOLD, _WHOLE)), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _TOLD, _WHOLE)
    classes = simhash.classes(prints.groupBy("bits").agg(F.min(order).alias("first")), rows=prints.count())
    first = classes.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    same = marked["doc_id"].eqNullSafe(first["doc_id"])
    for c in (_TOLD, _WHOLE):
        same = same & (marked[c] == first[c])
    kept = marked.join(first, same, "left_semi")
    if not prints.groupBy("doc_id", _TOLD, _WHOLE).count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", _TOLD, _WHOLE])  # rows repeated whole
    return _back(kept, given, new_text=False)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with test items."""
    found = decontaminate.contamination(_aside(docs), table(spark, sf_dir, "benchmark"), remove=True)
    return _back(found, docs)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data, checked over the whole table."""
    return _back(pii.verified(_aside(docs), pii.run_key(spark), counted=None), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", pii_surrogates),
    ("best-fit packing", best_fit_packing),
]

#: Trained trees, fingerprints and tokens are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = n_written()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        # What the stage worked with, its input among it, is read no more.
        drop_written(spark, before, keep=1)
    return docs
