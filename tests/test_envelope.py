"""Envelope documents: headers, orders, ragged and unreadable input, long files."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, STRICT, ColumnSpec, Contract
from ledgerline.errors import ContractViolation
from ledgerline.operators.checks import schema_drift
from ledgerline.plans.loads import envelopes_to_raw
from ledgerline.sources.envelope import (
    check_names,
    envelope_columns,
    envelope_rows,
    first_header,
    header_names,
    quarantined_rows,
    read_envelopes,
    to_raw,
)
from ledgerline.sources.long_documents import cut_documents


def envelope(names, rows, **more):
    return {"meta": {"view": {"columns": [{"name": n, "type": "x"} for n in names]}}, "data": rows, **more}


def write(folder, documents):
    folder.mkdir(exist_ok=True)
    for name, body in documents.items():
        text = body if isinstance(body, str) else json.dumps(body)
        (folder / f"{name}.json").write_text(text)
    return str(folder)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_columns_and_rows(spark, tmp_path):
    path = write(tmp_path / "in", {"a": envelope(["x", "VIN (1-10)"], [[1, "p"], [None, "q"]])})
    documents = read_envelopes(spark, path)
    assert [(r["position"], r["name"]) for r in envelope_columns(documents).collect()] == [
        (0, "x"), (1, "VIN (1-10)"),
    ]
    rows = envelope_rows(documents).orderBy("_pos").collect()
    assert [(r["_pos"], r["_row"], r["_status"]) for r in rows] == [
        (0, ["1", "p"], "ok"), (1, [None, "q"], "ok"),
    ]
    assert first_header(documents) == ["x", "VIN (1-10)"]


def test_header_orders_are_resolved_by_name(spark, tmp_path):
    path = write(
        tmp_path / "in",
        {"a": envelope(["x", "y"], [[1, 2]]), "b": envelope(["y", "x", "z"], [[20, 10, 30]])},
    )
    documents = read_envelopes(spark, path)
    names = header_names(documents)
    assert sorted(names) == ["x", "y", "z"]
    raw = to_raw(envelope_rows(documents, ["x", "y", "z"]), ["x", "y", "z"])
    assert rows_of(raw) == [("1", "2", None), ("10", "20", "30")]
    assert all(f.dataType.simpleString() == "string" and f.nullable for f in raw.schema)


def test_cells_keep_their_text(spark, tmp_path):
    text = (
        '{"meta":{"view":{"columns":[{"name":"a"},{"name":"b"},{"name":"c"},{"name":"d"}]}},'
        '"data":[[1.50, true, [null,"47.6",{"a":1}], "é\\"]\\n"]]}'
    )
    raw = to_raw(envelope_rows(read_envelopes(spark, write(tmp_path / "in", {"a": text})), list("abcd")), list("abcd"))
    assert tuple(raw.first()) == ("1.5", "true", '[null,"47.6",{"a":1}]', 'é"]\n')


BAD_HEADERS = [
    (["a", "a"], "duplicate column names in .*bad.json: a, a"),
    (["sid", "SID"], "duplicate column names in .*bad.json"),
    (["a", None], "nameless column in .*bad.json"),
]


@pytest.mark.parametrize("names, message", BAD_HEADERS)
def test_one_bad_header_is_quarantined(spark, tmp_path, names, message):
    path = write(tmp_path / "in", {"bad": envelope(names, [[1, 2]]), "good": envelope(["x"], [[1]])})
    for size in (0, 1 << 20):
        run = dict(raw_path=str(tmp_path / "raw"), long_file_bytes=size)
        found, counts = envelopes_to_raw(spark, path, quarantine_path=str(tmp_path / "bad"), **run)
        assert found == ["x"] and (counts["n_ok"], counts["n_corrupt"]) == (1, 1)
        refused = spark.read.parquet(str(tmp_path / "bad")).collect()
        assert [(r["_file"].split("/")[-1], r["reason"]) for r in refused] == [("bad.json", "corrupt")]
        if size:
            with pytest.raises(Exception, match=message):
                envelopes_to_raw(spark, path, policy=STRICT, **run)


def test_names_differing_by_case_between_documents(spark, tmp_path):
    path = write(tmp_path / "in", {"a": envelope(["x"], [[1]]), "b": envelope(["X"], [[2]])})
    with pytest.raises(ContractViolation, match="case alone"):
        header_names(read_envelopes(spark, path))
    assert len(check_names([str(i) for i in range(3000)])) == 3000


def test_ragged_and_unreadable(spark, tmp_path):
    path = write(
        tmp_path / "in",
        {
            "good": envelope(["x", "y"], [[1, 2], [3], [4, 5, 6]]),
            "cut": '{"meta": {"view": {"columns": [{"name": "x"}]}}, "data": [[1], [2',
            "none": envelope(["x", "y"], []),
        },
    )
    rows = envelope_rows(read_envelopes(spark, path), ["x", "y"])
    assert rows_of(to_raw(rows, ["x", "y"])) == [("1", "2")]
    out = [(r["reason"], r["_pos"], r["n_names"], r["n_cells"]) for r in quarantined_rows(rows).collect()]
    assert sorted(out, key=repr) == [
        ("corrupt", None, None, None), ("ragged", 1, 2, 1), ("ragged", 2, 2, 3),
    ]
    with pytest.raises(Exception, match="row does not match its header"):
        good = read_envelopes(spark, path + "/good.json", STRICT)
        to_raw(envelope_rows(good, ["x", "y"]), ["x", "y"], STRICT).collect()
    with pytest.raises(Exception, match="unreadable document .*cut.json"):
        envelope_rows(read_envelopes(spark, path + "/cut.json", STRICT)).collect()
    assert read_envelopes(spark, path, headers_only=True).where("names is not null").count() == 2


def test_one_document_per_line(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [json.dumps(envelope(["x"], [[i]])) for i in range(5)]
    (folder / "a.json").write_text("\n".join(lines))
    rows = envelope_rows(read_envelopes(spark, str(folder), one_per_line=True), ["x"])
    assert rows_of(to_raw(rows, ["x"])) == [(str(i),) for i in range(5)]


def test_raw_copy_finds_all_columns_and_counts(spark, tmp_path):
    path = write(
        tmp_path / "in",
        {
            "a": envelope(["x", "y"], [[1, 2], [3]]),
            "b": envelope(["y", "w", "x"], [[5, 6, 4]]),
            "c": '{"meta": {',
        },
    )
    names, counts = envelopes_to_raw(
        spark, path, str(tmp_path / "raw"), quarantine_path=str(tmp_path / "bad")
    )
    assert sorted(names) == ["w", "x", "y"]
    assert (counts["n_ok"], counts["n_ragged"], counts["n_corrupt"]) == (2, 1, 1)
    raw = spark.read.parquet(str(tmp_path / "raw")).select("x", "y", "w")
    assert rows_of(raw) == [("1", "2", None), ("4", "5", "6")]
    envelopes_to_raw(spark, path, str(tmp_path / "placed"), lineage=True)
    placed = spark.read.parquet(str(tmp_path / "placed"))
    file = F.element_at(F.split("_file", "/"), -1)
    assert rows_of(placed.select(file, "_pos", "x")) == [("a.json", 0, "1"), ("b.json", 0, "4")]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_schema_drift(spark, tmp_path):
    contract = Contract("c", (ColumnSpec("x", "X"), ColumnSpec("y", "Y"), ColumnSpec("z", "Z")))
    path = write(
        tmp_path / "in",
        {"a": envelope(["x", "y", "z"], []), "b": envelope(["y", "x", "w"], [[1, 2, 3]])},
    )
    got = rows_of(schema_drift(read_envelopes(spark, path), contract))
    assert got == [
        ("w", "extra", 1), ("x", "reordered", 1), ("y", "reordered", 1), ("z", "missing", 1),
    ]


# Strings holding brackets, quotes, escapes and key look-alikes; nested cells; layouts.
TRICKY = [
    "plain", "a]b", "[", "]", '"', '\\', '\\"', '"data": [', ', "data" : [[', "\n]\n", "é ", "",
    "x\\\\", "[[", "{]}", ']"', '"]', None, 1.5, True, [1, "]", ["[", {"data": [1, 2]}]],
    {"data": [[1], ["]"]], "k": "]"}, [], {},
]


def settled(record):
    """A collected row with nested cells as compact JSON: their white space may differ."""
    file, i, row, *rest = record
    cells = []
    for cell in row:
        try:
            nested = json.loads(cell) if cell is not None else None
        except ValueError:
            nested = None
        cells.append(json.dumps(nested) if isinstance(nested, (list, dict)) else repr(cell))
    return file, i, cells, rest


@pytest.mark.parametrize("layout", ["compact", "indented", "row_lines", "data_first", "tail"])
def test_long_documents_equal_a_whole_parse(spark, tmp_path, layout, monkeypatch):
    if layout in ("compact", "tail"):
        monkeypatch.setattr("ledgerline.sources.long_documents._RUN_PIECES", 3)
    rng = random.Random(layout)
    folder = tmp_path / "in"
    folder.mkdir()
    want = {}
    for n in range(3):
        names = ["x", "y ]", "z"]
        rows = [[rng.choice(TRICKY) for _ in names] for _ in range(rng.choice([0, 1, 300]) if n else 400)]
        rows = [[i, *row[1:]] for i, row in enumerate(rows)]
        body = envelope(names, rows)
        body["meta"]["view"]["note"] = 'see "data": [ or ] here'
        body["meta"]["view"]["tags"] = [["a"], ["]"], {"data": [[1]]}]
        if layout == "data_first":
            body = {"data": body["data"], "meta": body["meta"]}
        if layout == "tail":
            body = {"before": ["]", [1]], **body, "after": [[1, 2], ["x"]], "end": "]"}
        if layout == "indented":
            text = json.dumps(body, indent=2)
        elif layout == "row_lines":
            lines = "\n, ".join(json.dumps(r) for r in rows)
            text = '{ "meta": %s,\n "data" : [ %s ]\n}\n' % (json.dumps(body["meta"]), lines)
        else:
            text = json.dumps(body, separators=(",", ":"))
        (folder / f"d{n}.json").write_text(text)
        want[f"d{n}.json"] = rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        cut = cut_documents(spark, str(folder), 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r["names"]) for r in cut.headers.collect()] == [("x", "y ]", "z")] * 3
    names = ["z", "x", "absent", "y ]"]
    whole = envelope_rows(read_envelopes(spark, str(folder)), names)
    whole = whole.where(F.col("_status") != "empty")
    key = [F.element_at(F.split("_file", "/"), -1).alias("f"), F.element_at("_row", 1).cast("int").alias("i")]
    columns = [*key, "_row", "_status", "_at", "_others", "_pos"]
    cut_rows = cut.rows(names).where(F.col("_status") != "empty")
    got = sorted(settled(r) for r in cut_rows.select(*columns).collect())
    assert got == sorted(settled(r) for r in whole.select(*columns).collect())
    assert len(got) == sum(len(r) for r in want.values())
    # Positions put the rows of a document back into their order.
    ordered = cut.rows().where(F.col("_file").endswith("d0.json")).orderBy("_pos").collect()
    assert [r["_pos"] for r in ordered] == list(range(len(ordered)))
    assert [int(r["_row"][0]) for r in ordered] == list(range(len(want["d0.json"])))


def whole(rows):
    return '{"meta": {"view": {"columns": [{"name": "x"}]}}, "data": %s}' % rows


# Text of a document with one column, and what is found in it: (position, status, cells).
UNREADABLE = [(None, "corrupt", None)]
ONE_MEANING = {
    "two": (whole("[[1], [2]]") + whole("[[3]]"), UNREADABLE),
    "garbage": (whole("[[1]]") + " garbage [", UNREADABLE),
    "word": (whole("[[1]]") + " garbage", UNREADABLE),
    "bracket": (whole("[[1]]") + "]", UNREADABLE),
    "bracket_line": (whole("[[1]]") + "]\n", UNREADABLE),
    "brace": (whole("[[1]]") + "}", UNREADABLE),
    "listed": ("[" + whole("[[1]]") + "]", UNREADABLE),
    "line_end": (whole("[[1]]") + "\n\n", [(0, "ok", ["1"])]),
    "null": (whole('[["x"], null, ["z"]]'), [(0, "ok", ["x"]), (1, "ragged", None), (2, "ok", ["z"])]),
    "object": (
        whole('[[1], {"a": [2, 3]}, [3], {"b": 1}]'),
        [(0, "ok", ["1"]), (1, "ragged", ['{"a":[2,3]}']), (2, "ok", ["3"]), (3, "ragged", ['{"b":1}'])],
    ),
    "scalars": (
        whole('[5, "[6]", [1], true , null ]'),
        [
            (0, "ragged", ["5"]), (1, "ragged", ["[6]"]), (2, "ok", ["1"]), (3, "ragged", ["true"]),
            (4, "ragged", None),
        ],
    ),
    "only_scalar": (whole("[7]"), [(0, "ragged", ["7"])]),
    "widths": (whole("[[1], [], [2, 3]]"), [(0, "ok", ["1"]), (1, "ragged", []), (2, "ragged", ["2", "3"])]),
    "token": (whole("[[1], [bad], [3]]"), UNREADABLE),
    "no_comma": (whole("[[1] [2]]"), UNREADABLE),
    "last_comma": (whole("[[1], ]"), UNREADABLE),
    "first_comma": (whole("[, [1]]"), UNREADABLE),
    "mismatch": (whole("[[1}]]"), UNREADABLE),
    "truncated": (whole("[[1], [2]]")[:-8], UNREADABLE),
    "no_rows": (whole("[]"), [(None, "empty", None)]),
    "data_null": (whole("null"), [(None, "empty", None)]),
    "data_number": (whole("5"), UNREADABLE),
    "no_names": ('{"data": [[1]]}', UNREADABLE),
    "no_document": ("x" * 50 + "[" * 5, UNREADABLE),
}


@pytest.mark.parametrize("run_pieces", [1, 3, 1 << 16])
def test_long_and_short_documents_have_one_meaning(spark, tmp_path, monkeypatch, run_pieces):
    monkeypatch.setattr("ledgerline.sources.long_documents._RUN_PIECES", run_pieces)
    path = write(tmp_path / "in", {name: text for name, (text, _) in ONE_MEANING.items()})
    short = envelope_rows(read_envelopes(spark, path), ["x"])
    cut = cut_documents(spark, path, 0)
    for rows in [short, cut.rows(["x"])] if run_pieces == 1 else [cut.rows(["x"])]:
        got = {name: [] for name in ONE_MEANING}
        for r in rows.collect():
            got[r["_file"].split("/")[-1].removesuffix(".json")].append((r["_pos"], r["_status"], r["_row"]))
        assert {k: sorted(v, key=repr) for k, v in got.items()} == {k: v for k, (_, v) in ONE_MEANING.items()}


@pytest.mark.parametrize("name", ["two", "word", "bracket", "token", "last_comma", "truncated"])
def test_strict_refuses_unreadable_documents_of_any_size(spark, tmp_path, name):
    path = write(tmp_path / "in", {name: ONE_MEANING[name][0]})
    for size in (0, 1 << 20):
        with pytest.raises(Exception, match=f"unreadable document .*{name}.json"):
            envelopes_to_raw(spark, path, str(tmp_path / "raw"), STRICT, names=["x"], long_file_bytes=size)


def test_refused_lines_keep_their_text(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(whole("[[1]]") + "\n" + whole("[[2]]") + " tail\n")
    rows = envelope_rows(read_envelopes(spark, str(folder), one_per_line=True), ["x"])
    assert [r["_row"] for r in quarantined_rows(rows).collect()] == [[whole("[[2]]") + " tail"]]


def test_names_reach_long_rows_by_a_salted_join(spark, tmp_path, monkeypatch):
    path = write(
        tmp_path / "in",
        {"a": envelope(["x", "y"], [[i, 1] for i in range(200)]), "b": envelope(["y", "x"], [[2, -1]])},
    )
    cut = cut_documents(spark, path, 0)
    broadcast = rows_of(to_raw(cut.rows(["x", "y"]), ["x", "y"]))
    monkeypatch.setattr("ledgerline.sources.long_documents.BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(to_raw(cut.rows(["x", "y"]), ["x", "y"])) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(broadcast) == 201 and ("-1", "2") in broadcast
    shared = spark.conf.get("spark.checkpoint.dir")
    cut.discard()
    assert not any(k.startswith(shared) and os.path.exists(k) for k in cut.kept)


def test_long_and_short_documents_together(spark, tmp_path):
    path = write(
        tmp_path / "in",
        {"big": envelope(["x", "y"], [[i, i] for i in range(500)]), "small": envelope(["y", "x"], [[7, 8]])},
    )
    names, counts = envelopes_to_raw(spark, path, str(tmp_path / "raw"), LENIENT, long_file_bytes=1000)
    assert sorted(names) == ["x", "y"] and counts["n_ok"] == 501
    raw = spark.read.parquet(str(tmp_path / "raw")).select("x", "y")
    assert rows_of(raw) == sorted([(str(i), str(i)) for i in range(500)] + [("8", "7")], key=repr)
