"""The manifest against digests computed row by row, and SQL."""

import hashlib
import os
import random
import zlib

import duckdb
import pytest

from ledgerline.llm import answers, merkle, registry

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if c is None else f"{len(str(c).encode())}:{c}" for c in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def climb(forest, place):
    """Per level below the top: the siblings left and right."""
    for nodes in forest[:-1]:
        start = place - place % 16
        yield nodes[start:place], nodes[place + 1 : start + 16]
        place //= 16


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        trees[s] = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    forests = {s: levels([leaf(r) for r in trees[s]]) for s in sources}
    top = levels([forests[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for place, row in enumerate(trees[s]):
            path = [*climb(forests[s], place), *climb(top, at)]
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                now = (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))
            fold = leaf(now)
            for left, right in path:
                fold = digest("".join([*left, fold, *right]))
            told = digest("".join("".join(left + right) for left, right in path))
            root = top[-1][0]
            out.append((row[0], leaf(row), forests[s][-1][0], root, told, fold, fold == root))
    return sorted(out, key=repr)


def in_sql(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    return con.execute(answers.MERKLE_MANIFEST)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(12)
    texts = [None, "", "Plain TEXT", "naïve ÉTÉ", "lower", "x" * 100_000, "-", "3:abc"]
    rows = []
    for source, n in ((None, 40), ("", 1), ("one", 1), ("hot", 700), ("é", 16), ("z", 17), ("A", 257), ("B", 2)):
        for i in range(n):
            lang = rng.choice([None, "en"])
            rows.append((rng.choice([i, i, None, 5]), source, lang, rng.choice([None, 0, i]), rng.choice(texts)))
    return rows + rows[:30] + [(i, f"many {i % 40}", "en", 1, "T") for i in range(90)]


def test_proofs_of_odd_rows(spark, odd_rows, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(*r, 1, 2) for r in odd_rows], SCHEMA + ", n int, tree int").write.parquet(path)
    got = registry.QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns == names
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == expected(odd_rows)
    found = in_sql(f"{path}/*.parquet")
    assert [d[0] for d in found.description] == names
    assert sorted(found.fetchall(), key=repr) == rows


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_small_tables(spark, n, tmp_path):
    rows = [(i, None, "en", 3, "Abc") for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, merkle.audited(docs, str(tmp_path / "m")).collect()), key=repr) == expected(rows)


def test_the_given_table(spark, sf_oracle):
    got = registry.QUERIES["op12_merkle_manifest"](spark, sf_oracle)
    found = in_sql(os.path.join(sf_oracle, "documents.parquet")).fetchall()
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted(found, key=repr)
    assert {r[-1] for r in rows} == {True, False}


def test_only_every_other_level_is_written(spark, odd_rows, tmp_path):
    """Proofs fold to the root, though the levels between are not stored."""
    docs = spark.createDataFrame(odd_rows, SCHEMA)
    manifest = merkle.build(merkle.document_leaves(docs), ["doc_id"], str(tmp_path / "m"))
    assert sorted(os.listdir(tmp_path / "m" / "leaves")) == ["0", "1", "2"]  # 700 leaves: 44, 3 and 1 above
    hot = [manifest.level(spark, "leaves", k).where("tree = 'hot'").count() for k in range(3)]
    assert hot == [sum(r[1] == "hot" for r in odd_rows), 3, 1]
    root = manifest.root(spark)
    for r in merkle.proofs(spark, manifest, ["doc_id"]).collect():
        assert merkle.folded(r["digest"], [(p["left"], p["right"]) for p in r["path"]]) == root == r["root"]
        assert merkle.folded("0" * 64, [(p["left"], p["right"]) for p in r["path"]]) != root


def test_small_levels_cost_no_shuffle(spark, odd_rows, tmp_path, monkeypatch):
    """Levels that are not dealt over tasks hold what dealt ones hold, and are one file each."""
    docs = spark.createDataFrame(odd_rows, SCHEMA)
    monkeypatch.setattr(merkle, "_AT_ONCE", 200)  # fewer than the leaves, more than the sources and the nodes above
    one = merkle.build(merkle.document_leaves(docs), ["doc_id"], str(tmp_path / "one"))
    files = lambda part, k: [f for f in os.listdir(tmp_path / "one" / part / str(k)) if f.startswith("part")]
    assert [len(files(*level)) for level in (("leaves", 2), ("roots", 0), ("roots", 1))] == [1, 1, 1]
    monkeypatch.setattr(merkle, "_AT_ONCE", 1)
    many = merkle.build(merkle.document_leaves(docs), ["doc_id"], str(tmp_path / "many"))
    assert len(one.leaf_sizes) == len(many.leaf_sizes) == 3 and len(one.root_sizes) == len(many.root_sizes) == 2
    for part, sizes in (("leaves", one.leaf_sizes), ("roots", one.root_sizes)):
        for k, size in enumerate(sizes):
            rows = [sorted(map(tuple, m.level(spark, part, k).collect()), key=repr) for m in (one, many)]
            assert rows[0] == rows[1] and len(rows[0]) <= size
    monkeypatch.setattr(merkle, "_AT_ONCE", 200)
    for path in ("audited", "audited again"):
        assert sorted(map(tuple, merkle.audited(docs, str(tmp_path / path)).collect()), key=repr) == expected(odd_rows)
        monkeypatch.setattr(merkle, "_AT_ONCE", 1)
