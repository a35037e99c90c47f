"""Toxicity by a factorization machine over hashed terms.

A word gives four terms: itself and its first four, five and six letters (insults that take
endings share these). Terms are hashed to 32 bits. A bounded sample of labelled documents is
counted in Spark, and the ``TERMS`` hashes whose presence depends most on the label (chi-square)
enter the machine: a bias, a weight each, and a short vector each, whose inner products weigh
every pair of terms present, such as an insult with the name of a group. Terms that say nothing alone
enter as well if some pair of them does: the ``PAIR_TERMS`` commonest others are counted two by two.
Repetition does not count: a term is present or not, so that long texts are not toxic by length.

Rows: a null or empty text has no term and gets the bias's score; repeated rows get equal
scores; a null key is not held out and keeps its row. Without labels of both kinds the score is
the share of ones (0.5 without labels).
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_block, keyed_text, written
from ledgerline.llm.labels import SAMPLE, labelled
from ledgerline.llm.quality import verdicts

FOLDS, HELD_OUT = 4, 2
TERMS, FACTORS = 4096, 8
#: A term enters if this many sampled documents have it, and its chi-square is at least this.
LEAST_DOCS, LEAST_CHI = 5, 25.0
#: Other terms that are looked at in pairs, the sampled documents that must have one, and the chi-square by which
#: the presence of both must depend on the label (two million pairs reach 30 by chance).
PAIR_TERMS, LEAST_PAIR_DOCS, LEAST_PAIR_CHI = 2048, 20, 60.0


def hashed_terms(word: str) -> list[int]:
    word = word.lower().strip(string.punctuation)
    if not word:
        return []
    prefixes = [f"{word[:k]}~" for k in (4, 5, 6) if len(word) >= k]
    return [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in [word, *prefixes]]


def terms_in(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, term) of the terms present, each once, in order; of ``wanted`` (sorted) only.

    With ``wanted`` the second of the pair is the term's place there.
    """
    words = pc.utf8_split_whitespace(texts)
    edges = words.offsets.to_numpy()
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    distinct = words.flatten().dictionary_encode()
    found = [hashed_terms(w) for w in distinct.dictionary.to_pylist()]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    terms = np.fromiter((t for f in found for t in f), np.int64, int(counts.sum()))
    word = np.repeat(np.arange(len(found)), counts)
    if wanted is not None:
        place = np.searchsorted(wanted, terms)
        good = wanted[np.minimum(place, len(wanted) - 1)] == terms if len(wanted) else np.zeros(len(terms), bool)
        terms, word = place[good], word[good]
        counts = np.bincount(word, minlength=len(found))
    first = np.cumsum(counts) - counts
    used = distinct.indices.to_numpy()
    each = counts[used]
    ends = np.cumsum(each)
    at = np.arange(int(each.sum())) + np.repeat(first[used] - (ends - each), each)
    pairs = np.unique((np.repeat(owner, each) << 32) | terms[at])
    return pairs >> 32, pairs & 0xFFFFFFFF


@dataclass
class Machine:
    terms: np.ndarray  # sorted
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margin(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        out = self.bias + np.bincount(row, self.weights[term], rows)
        for v in self.vectors.T:
            out += 0.5 * (np.bincount(row, v[term], rows) ** 2 - np.bincount(row, v[term] ** 2, rows))
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        margin = self.margin(*terms_in(texts, self.terms), len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(
    terms: np.ndarray, row: np.ndarray, term: np.ndarray, y: np.ndarray,
    factors: int = FACTORS, steps: int = 500, rate: float = 0.1, decay: float = 5e-4,
) -> Machine:
    """Minimise the logistic loss by Adam over all rows at once. (row, term): terms present."""
    ones = float(y.mean()) if len(y) else 0.5
    m, n = len(terms), len(y)
    start = np.log(ones / (1 - ones)) if 0 < ones < 1 else {0.0: -30.0, 1.0: 30.0}.get(ones, 0.0)
    vectors = np.random.default_rng(0).normal(0, 0.05, (m, factors))
    machine = Machine(terms, float(start), np.zeros(m), vectors)
    if not m or not n or not 0 < ones < 1:
        return machine
    theta = np.concatenate(([start], machine.weights, vectors.ravel()))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        machine.bias, machine.weights = theta[0], theta[1 : m + 1]
        machine.vectors = v = theta[m + 1 :].reshape(m, factors)
        off = 1 / (1 + np.exp(-np.clip(machine.margin(row, term, n), -30, 30))) - y
        weight = np.bincount(term, off[row], m)
        pairs = np.empty_like(v)
        for k in range(factors):
            whole = np.bincount(row, v[term, k], n)
            pairs[:, k] = np.bincount(term, (off * whole)[row], m) - v[:, k] * weight
        grad = np.concatenate(([off.sum()], weight, pairs.ravel())) / n
        grad[1:] += decay * theta[1:]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    machine.bias, machine.weights = float(theta[0]), theta[1 : m + 1]
    machine.vectors = theta[m + 1 :].reshape(m, factors)
    return machine


def _chi(n, ones_among, ones, total):
    """The chi-square of a presence (in n documents, of which some are ones) against the label."""
    expected = n * ones / max(total, 1)
    return (ones_among - expected) ** 2 * total / (expected * (1 - ones / max(total, 1)) * (total - n) + 1e-9)


def telling_pairs(row: np.ndarray, term: np.ndarray, y: np.ndarray, m: int) -> np.ndarray:
    """The terms (numbers below m) of pairs whose joint presence depends on the label."""
    both, both_ones = np.zeros((m, m), np.float32), np.zeros((m, m), np.float32)
    edges = np.searchsorted(row, np.arange(0, len(y) + 2000, 2000))
    for at, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        here = y[at * 2000 : (at + 1) * 2000]
        present = np.zeros((len(here), m), np.float32)
        present[row[a:b] - at * 2000, term[a:b]] = 1
        both += present.T @ present
        both_ones += present[here == 1].T @ present[here == 1]
    np.fill_diagonal(both, 0)
    # Pairs that exclude a label tell as much as pairs that make it.
    chi = np.where(both >= LEAST_DOCS, _chi(both, both_ones, float(y.sum()), len(y)), 0)
    return np.flatnonzero((chi >= LEAST_PAIR_CHI).any(axis=1))


def train(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", size: int = SAMPLE
) -> Machine:
    """Fit on up to ``size`` labelled documents outside the held-out fold."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        row, term = terms_in(block.column("text"))
        edges = np.searchsorted(row, np.arange(block.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(term))
        return pa.RecordBatch.from_arrays(
            [block.column("doc_id"), block.column("label"), lists], ["doc_id", "label", "terms"]
        )

    sample = labelled(keyed_text(df, key, text), labels, "toxic", FOLDS, HELD_OUT, size)
    sample = written(
        sample.mapInArrow(by_block(work), "doc_id long, label int, terms array<long>"), "toxicity-sample"
    )
    total, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    counted = sample.select("label", F.explode("terms").alias("term")).groupBy("term")
    counted = counted.agg(F.count("*").alias("n"), F.sum("label").alias("n1")).filter(F.col("n") >= LEAST_DOCS)
    counted = written(counted.withColumn("chi", _chi(F.col("n"), F.col("n1"), F.lit(ones), total)), "toxicity-terms")
    alone = counted.filter(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "term").limit(TERMS)
    others = counted.filter((F.col("chi") < LEAST_CHI) & (F.col("n") >= LEAST_PAIR_DOCS))
    others = others.orderBy(F.desc("n"), "term").limit(PAIR_TERMS)
    listed = lambda chosen: chosen.select("term").toArrow().column("term").to_numpy()
    terms, others = listed(alone), listed(others)
    looked_at = np.sort(np.concatenate((terms, others)))
    row, term, y = _presence(sample, looked_at, size)
    is_other = np.isin(looked_at, others)
    number = np.cumsum(is_other) - 1
    chosen = ~is_other
    here = is_other[term]
    chosen[np.flatnonzero(is_other)[telling_pairs(row[here], number[term[here]], y, len(others))]] = True
    place, kept = np.cumsum(chosen) - 1, chosen[term]
    return fit(looked_at[chosen], row[kept], place[term[kept]], y)


def _presence(sample: DataFrame, terms: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the terms (sorted) each sampled document has: (row, place of the term), and the labels."""
    sent = sample.sparkSession.sparkContext.broadcast(terms)  # TERMS and PAIR_TERMS bound it

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        for batch in batches:
            lists = batch.column("terms")
            values = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            place = np.searchsorted(wanted, values)
            good = wanted[np.minimum(place, len(wanted) - 1)] == values if len(wanted) else np.zeros(len(values), bool)
            edges = np.searchsorted(owner[good], np.arange(batch.num_rows + 1)).astype(np.int32)
            kept = pa.ListArray.from_arrays(pa.array(edges), pa.array(place[good].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), kept], ["doc_id", "label", "at"])

    rows = sample.mapInArrow(places, "doc_id long, label int, at array<int>").orderBy("doc_id", "label").limit(size)
    found = rows.toArrow().combine_chunks()
    lists = found.column("at").combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int32()))
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    row = np.repeat(np.arange(found.num_rows), np.diff(lists.offsets.to_numpy()) if len(lists) else 0)
    return row, lists.flatten().to_numpy(), found.column("label").to_numpy().astype(float)


def scored(df: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, score."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        score = pa.array(machine.score(block.column("text")))
        return pa.RecordBatch.from_arrays([block.column("doc_id"), score], ["doc_id", "score"])

    return keyed_text(df, key, text).mapInArrow(by_block(work), "doc_id long, score double")


def toxicity(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    return verdicts(scored(df, train(df, labels, key, text), key, text), FOLDS, HELD_OUT)
