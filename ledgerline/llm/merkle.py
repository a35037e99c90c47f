"""A Merkle manifest of a table: a digest for each row, tree and table, and proofs for each row.

The rows of a tree (one source, say) stand in order, and every ``FAN`` consecutive digests become one, level
by level, until one is left, the subroot; the subroots in the order of their trees become the root in
the same way. A digest is the hexadecimal SHA-256 of what it covers, joined as text.

Checkpoint and recompute: of the levels only every ``EVERY``-th is written, beginning with the leaves. Between
two written levels lie aligned subtrees of at most ``FAN`` ** ``EVERY`` nodes. Proofs go from the root
down: a task takes the stored children of one aligned subtree and its top's path, regenerates the
missing nodes between, emits for every child the siblings on its way up, and discards the nodes.

Digests are computed where the rows lie; only they travel. Rows are numbered within their tree by a
range sort over all tasks, so a tree that holds most rows is the work of many, and no step takes
more than one subtree at a time. Levels of at most ``_AT_ONCE`` nodes in all, as the upper ones are, are not
dealt over tasks: one takes them, subtree by subtree like the others, and a level costs no shuffle.

Rows: a null cell is ``-``, any other its number of UTF-8 bytes, ``:`` and the value as text. Null
trees and null ids come first; rows that share an id stand by their digest, so repeated rows are leaves
of their own; an empty table has no rows in any level and no proofs. Other columns do not come along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import written

FAN, EVERY = 16, 2
SPAN = FAN**EVERY
_AT_ONCE = 4096


def joined_digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(columns: Sequence[Column]) -> Column:
    """The digest of a row's cells."""
    text = [c.cast("string") for c in columns]
    told = [F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in text]
    return F.sha2(F.concat(*told), 256)


def interior(digests: list[str], n: int) -> list[list[str] | None]:
    """The levels of an aligned subtree from its lowest nodes up to, but without, its top.

    ``n`` nodes stand on the lowest level of the whole tree; a level that is already the tree's top has
    no runs and is None.
    """
    levels, nodes = [], digests
    for _ in range(EVERY):
        if n == 1:
            levels.append(None)
        else:
            levels.append(nodes)
            nodes = [joined_digest(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
            n = -(-n // FAN)
    return [*levels, nodes]


def siblings(levels: list[list[str] | None], place: int) -> list[tuple[str, str]]:
    """What stands left and right of a node in its run, level by level."""
    path = []
    for nodes in levels[:-1]:
        if nodes is not None:
            start = place - place % FAN
            path.append(("".join(nodes[start:place]), "".join(nodes[place + 1 : start + FAN])))
        place //= FAN
    return path


def folded(digest: str, path: Sequence[tuple[str, str]]) -> str:
    """The top that a node and its siblings give."""
    for left, right in path:
        digest = joined_digest((left, digest, right))
    return digest


# Building


@dataclass(frozen=True)
class Manifest:
    """Where the levels are: ``leaves/0``, ``leaves/1`` ... and ``roots/0`` ..., each every ``EVERY`` levels.

    A level's rows: tree, index, digest, n (nodes of that level in the tree); the lowest has the carried columns too.
    """

    path: str
    #: Nodes of each written level, or somewhat more.
    leaf_sizes: tuple[int, ...]
    root_sizes: tuple[int, ...]

    def level(self, spark: SparkSession, part: str, k: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{part}/{k}")

    def root(self, spark: SparkSession) -> str | None:
        """The digest of the whole table; none of an empty one."""
        top = self.level(spark, "roots", len(self.root_sizes) - 1).first()
        return top and top["digest"]


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with their ``index`` within their tree and its size ``n``."""
    by = ["tree", *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(placed.withColumn("place", F.monotonically_increasing_id()), "merkle-sorted")
    # One row for each task a tree reaches into; a task numbers its rows from its own first place on.
    task = F.shiftright("place", 33)
    runs = placed.groupBy("tree", task.alias("task")).agg(F.min("place").alias("first"), F.count("*").alias("held"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("tree").alias("run_tree"), "task",
        (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(tree).alias("n"),
    )
    same = placed["tree"].eqNullSafe(runs["run_tree"]) & (task == runs["task"])
    return placed.join(runs, same).select(*rows.columns, (F.col("place") + F.col("shift")).alias("index"), "n")


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """The rows of each subtree in one task and in order."""
    dealt = rows.coalesce(1) if size <= _AT_ONCE else rows.repartition("tree", "subtree")
    return dealt.sortWithinPartitions("tree", "subtree", "index")


def _subtrees(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows of one tree and subtree."""
    at, held = None, []
    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
            if row[:2] != at:
                if held:
                    yield at, held
                at, held = row[:2], []
            held.append(row)
    if held:
        yield at, held


def _batches(rows: Iterator[dict], like: pa.Schema) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) == _AT_ONCE:
            yield pa.RecordBatch.from_pylist(some, schema=like)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema=like)


def _above(level: DataFrame, size: int) -> DataFrame:
    """The next written level of one of ``size`` nodes."""
    schema = T.StructType([level.schema["tree"], *T.StructType.fromDDL("index bigint, digest string, n bigint").fields])
    like = to_arrow_schema(schema)
    rows = level.select("tree", F.expr(f"index div {SPAN}").alias("subtree"), "index", "digest", "n")
    rows = _dealt(rows, size)
    names = rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops() -> Iterator[dict]:
            for (tree, subtree), held in _subtrees(batches, names):
                n = held[0][4]
                top = interior([row[3] for row in held], n)[-1]
                yield {"tree": tree, "index": subtree, "digest": top[0], "n": -(-n // SPAN)}

        yield from _batches(tops(), like)

    return rows.mapInArrow(work, schema)


def _forest(rows: DataFrame, path: str) -> tuple[tuple[int, ...], int]:
    """Write every ``EVERY``-th level of the trees; returns how many nodes each has at most, and the number of trees."""
    spark = rows.sparkSession
    rows.write.parquet(f"{path}/0")
    told = spark.read.parquet(f"{path}/0").agg(F.max("n"), F.count("*"), F.count_if(F.col("index") == 0))
    most, held, trees = told.first()
    sizes = [held]
    while (most or 0) > 1:
        k = len(sizes)
        _above(spark.read.parquet(f"{path}/{k - 1}"), sizes[-1]).write.parquet(f"{path}/{k}")
        sizes.append(sizes[-1] // SPAN + trees)
        most = -(-most // SPAN)
    return tuple(sizes), trees


def build(leaves: DataFrame, order: Sequence[str], path: str) -> Manifest:
    """Write the manifest of leaves (tree, digest, the columns to order by, and others to carry along)."""
    sizes, trees = _forest(_numbered(written(leaves, "merkle-leaves"), [*order, "digest"]), f"{path}/leaves")
    spark = leaves.sparkSession
    tops = spark.read.parquet(f"{path}/leaves/{len(sizes) - 1}").select("tree", "digest")
    subroots = tops.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "digest")
    if trees <= _AT_ONCE:
        row = F.row_number().over(Window.partitionBy("tree").orderBy("source"))
        placed = subroots.coalesce(1).select("*", (row - 1).cast("bigint").alias("index"), F.lit(trees).cast("bigint").alias("n"))
    else:
        placed = _numbered(subroots, ["source"])
    return Manifest(path, sizes, _forest(placed, f"{path}/roots")[0])


# Proofs

_PATH = "path array<struct<left: string, right: string>>, subroot string, root string"


def _below(level: DataFrame, size: int, paths: DataFrame, carry: Sequence[str], columns: str, told) -> DataFrame:
    """``told(carried, digest, path, subroot, root)`` for each of ``size`` stored nodes below the tops of ``paths``."""
    names = ["tree", "subtree", "index", "digest", "n", *carry]
    children = level.select("tree", F.expr(f"index div {SPAN}").alias("subtree"), "index", "digest", "n", *carry)
    above = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(_PATH).fields]
    none = [F.lit(None).cast(children.schema[c].dataType).alias(c) for c in names[2:]]
    tops = paths.select("tree", F.col("index").alias("subtree"), *none, "path", "subroot", "root")
    both = tops.union(children.select("*", *above))
    # The top's path stands before its children, which have an index.
    both = _dealt(both, size)
    schema = T.StructType([children.schema["tree"], *T.StructType.fromDDL(f"index bigint, digest string, {columns}").fields])
    schema = T.StructType([*schema.fields, *[children.schema[c] for c in carry]])
    like, all_names = to_arrow_schema(schema), both.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[dict]:
            for (tree, _), (top, *held) in _subtrees(batches, all_names):  # every top has children
                path, subroot, root = top[-3:]
                upper = [(p["left"], p["right"]) for p in path]
                levels = interior([row[3] for row in held], held[0][4])
                for place, row in enumerate(held):
                    carried = dict(zip(carry, row[5:], strict=False))
                    own = siblings(levels, place) + upper
                    found = told(carried, row[3], own, subroot, root)
                    yield {"tree": tree, "index": row[2], "digest": row[3], **carried, **found}

        yield from _batches(nodes(), like)

    return both.mapInArrow(work, schema)


def _with_path(carried: dict, digest: str, path: list, subroot: str | None, root: str) -> dict:
    return {"path": [{"left": a, "right": b} for a, b in path], "subroot": subroot, "root": root}


def _with_subroot(carried: dict, digest: str, path: list, subroot: str | None, root: str) -> dict:
    return _with_path(carried, digest, path, digest, root)


def proofs(spark: SparkSession, manifest: Manifest, carry: Sequence[str], columns: str = "", told=None) -> DataFrame:
    """Per leaf: tree, index, digest, the carried columns, and its proof: path (the siblings left and right of it
    and of the nodes above it, joined, from its own run to the root's), subroot, root.

    With ``told(carried, digest, path, subroot, root)``, what it returns (``columns``) stands in place
    of path, subroot and root; the paths then never leave their task.
    """
    leaves, roots = manifest.leaf_sizes, manifest.root_sizes
    top = manifest.level(spark, "roots", len(roots) - 1)
    empty = F.array().cast("array<struct<left: string, right: string>>").alias("path")
    paths = top.select("tree", "index", empty, F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    for k in _downwards(len(roots)):
        level = manifest.level(spark, "roots", k)
        paths = _below(level, roots[k], paths, [] if k else ["source"], _PATH, _with_subroot)
    at_top = F.lit(0).cast("bigint").alias("index")
    paths = written(paths.select(F.col("source").alias("tree"), at_top, "path", "subroot", "root"), "merkle-paths")
    *upper, lowest = _downwards(len(leaves))
    for k in upper:
        level = manifest.level(spark, "leaves", k)
        paths = written(_below(level, leaves[k], paths, (), _PATH, _with_path), "merkle-paths")
    return _below(manifest.level(spark, "leaves", lowest), leaves[lowest], paths, carry, columns or _PATH, told or _with_path)


def _downwards(n_levels: int) -> range:
    """The levels whose nodes stand below a path; a single level stands below itself."""
    return range(max(n_levels - 2, 0), -1, -1)


# Documents

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaves by source: tree, doc_id, digest; ``other`` is the digest with the text's A-Z in lower case
    where ``tampered`` says so."""
    own = [F.col(c) for c in COLUMNS]
    changed = [F.translate(c, _UPPER, _UPPER.lower()) if n == "text" else c for n, c in zip(COLUMNS, own, strict=True)]
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(changed))
    return docs.select(
        F.col("source").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf(own).alias("digest"), other.alias("other"),
    )


def verdict(carried: dict, digest: str, path: list, subroot: str, root: str) -> dict:
    """The proof's digest, and what the leaf found now folds to."""
    told = hashlib.sha256()
    for left, right in path:
        told.update((left + right).encode())
    now = folded(carried["other"] or digest, path)
    return {"subroot": subroot, "root": root, "proof_sha256": told.hexdigest(),
            "folded_root": now, "verified": now == root}


VERDICT = "subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def audited(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, its leaf, subroot, root and proof's digest, and whether the text found now, changed where
    the checksum of its id is divisible by five, still folds to the root."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = build(document_leaves(docs, changed), ["doc_id"], path)
    found = proofs(docs.sparkSession, manifest, ["doc_id", "other"], VERDICT, verdict)
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
