"""Quality scores by histogram gradient-boosted trees over document statistics.

Each text is reduced to ``STATISTICS``. A bounded sample of labelled documents is binned by
quantiles, and trees are grown level by level from histograms of the logistic loss's gradients
in those bins. The trees are flattened into arrays (feature, threshold, left child, value) that
travel to the tasks, where a whole block of documents goes down each tree in step.

Rows: a null text is an empty one, whose statistics are all zero; it gets the score of that leaf.
Repeated rows get equal scores; a null key is not held out and keeps its row. Without any label
of both kinds the score is the share of ones (0.5 without labels).
"""

from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_block, keyed_text
from ledgerline.llm.labels import SAMPLE, fold, labelled

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3

STATISTICS = (
    "words_log", "mean_word", "spread_word", "longest_word_log", "short_words", "distinct_words",
    "top_word", "repeated_neighbours", "distinct_pairs", "distinct_lines", "mean_line_log",
    "upper", "digits", "blanks", "marks", "symbols", "bars", "cries", "stops", "beyond_ascii",
)

_CLASSES = {
    "upper": range(65, 91), "digits": range(48, 58), "blanks": (32, 10, 9), "marks": b".,;:'\"()-?",
    "symbols": b"#*$%&<>", "bars": b"|", "cries": b"!", "stops": b".", "beyond_ascii": range(128, 256),
}
_MEMBERS = np.zeros((256, len(_CLASSES)))
for _i, _bytes in enumerate(_CLASSES.values()):
    _MEMBERS[list(_bytes), _i] = 1


def statistics(text: str) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    shares = np.bincount(raw, minlength=256) @ _MEMBERS / len(raw)
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float(lengths.std()),
        float(np.log1p(lengths.max())),
        float((lengths <= 3).mean()),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / max(n - 1, 1),  # noqa: B905
        len(set(lines)) / max(len(lines), 1),
        float(np.log1p(n / max(len(lines), 1))),
        *shares.tolist(),
    ]


@dataclass
class Trees:
    """Boosted trees, their nodes in shared arrays; a leaf is its own child."""

    base: float
    roots: list[int]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray  # the right child follows the left one
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                inner = self.left[node] > node
                right = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, least: int = 20, shrink: float = 1.0,
) -> Trees:
    """Trees for labels 0 and 1. ``least``: rows a leaf must hold."""
    ones = float(y.mean()) if len(y) else 0.5
    none = np.zeros(0)
    if not len(y) or not 0 < ones < 1:
        margin = {0.0: -30.0, 1.0: 30.0}.get(ones, 0.0)
        return Trees(margin, [], none.astype(int), none, none.astype(int), none, 0)
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    codes = np.stack([np.searchsorted(edges[f], x[:, f]) for f in range(width)], axis=1)
    cells = codes + np.arange(width) * bins
    margin = np.full(n, np.log(ones / (1 - ones)))
    base = float(margin[0])
    feature, threshold, left, value, roots = [], [], [], [], []

    def node(members: np.ndarray, g: np.ndarray, h: np.ndarray) -> int:
        feature.append(0)
        threshold.append(np.inf)
        left.append(len(left))
        value.append(-rate * g[members].sum() / (h[members].sum() + shrink))
        return len(left) - 1

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        everything = np.arange(n)
        roots.append(node(everything, g, h))
        level = [(roots[-1], everything)]
        for _ in range(depth):
            below = []
            for at, members in level:
                flat = cells[members].ravel()
                size = width * bins
                sums = [
                    np.bincount(flat, np.repeat(w[members], width), size).reshape(width, bins).cumsum(1)
                    for w in (g, h, np.ones(n))
                ]
                gl, hl, nl = (s[:, :-1] for s in sums)
                gt, ht, nt = (s[:1, -1:] for s in sums)
                gain = gl**2 / (hl + shrink) + (gt - gl) ** 2 / (ht - hl + shrink) - gt**2 / (ht + shrink)
                gain = np.where((nl >= least) & (nt - nl >= least), gain, 0)
                f, cut = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[f, cut] <= 1e-6:
                    continue
                goes_left = codes[members, f] <= cut
                feature[at], threshold[at] = int(f), float(edges[f][cut])
                parts = members[goes_left], members[~goes_left]
                left[at] = node(parts[0], g, h)
                node(parts[1], g, h)
                below += [(left[at], parts[0]), (left[at] + 1, parts[1])]
            level = below
        tree = Trees(0.0, roots[-1:], *map(np.array, (feature, threshold, left, value)), depth)
        margin = margin + tree.margin(x)
    return Trees(base, roots, *map(np.array, (feature, threshold, left, value)), depth)


def described(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, label (where docs has one) and x, the statistics of its text."""
    extra = [c for c in docs.columns if c not in ("doc_id", "text")]

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        x = [statistics(t) for t in block.column("text").to_pylist()]
        columns = [block.column("doc_id"), *(block.column(c) for c in extra), pa.array(x, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *extra, "x"])

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    return docs.mapInArrow(by_block(work), f"doc_id long{kinds}, x array<double>")


def train(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", size: int = SAMPLE) -> Trees:
    """Fit on up to ``size`` labelled documents outside the held-out fold."""
    sample = described(labelled(keyed_text(df, key, text), labels, "quality", FOLDS, HELD_OUT, size))
    rows = sample.dropDuplicates(["doc_id", "x"]).orderBy("doc_id", "x").limit(size).toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(STATISTICS))
    return fit(x, rows.column("label").to_numpy().astype(float))


def scored(df: DataFrame, trees: Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, score."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(t) for t in block.column("text").to_pylist()]).reshape(-1, len(STATISTICS))
        return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(trees.score(x))], ["doc_id", "score"])

    return keyed_text(df, key, text).mapInArrow(by_block(work), "doc_id long, score double")


def verdicts(scores: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    return scores.select(
        "doc_id",
        F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(df: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores at least the threshold, with all their columns."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        texts = block.column(text).cast(pa.string()).to_pylist()
        x = np.array([statistics(t or "") for t in texts]).reshape(-1, len(STATISTICS))
        return block.filter(pa.array(trees.score(x) >= THRESHOLD))

    return df.mapInArrow(by_block(work, text), df.schema)
