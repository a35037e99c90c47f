"""Conversations: repair against exhaustive search and SQL."""

import hashlib
import os
import random
import zlib
from functools import cache

import duckdb
import pytest

from ledgerline.llm import answers, conversation_repair, registry

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        told = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(told.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def repaired(rows):
    """The report on one conversation's damaged rows, by trying every edit."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(i, last, inserted):
        """The least (cost, audit, repaired rows) from row i on, after a row of initial ``last``."""
        ways = []
        if i == len(rows):
            if last in ("", "a"):
                ways.append((0, "", ()))
        else:
            role, text = rows[i][2:]
            extra = 3 * (faults[i] == "truncated")
            cost, audit, out = best(i + 1, last, 0)
            ways.append((cost + 4, "D" + audit, out))
            if faults[i] not in ("blank", "duplicate"):
                for new, price, edit in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if new[:1] and new[:1] in FOLLOWS[last]:
                        cost, audit, out = best(i + 1, new[0], 0)
                        ways.append((cost + price + extra, edit + audit, (f"{new}:{text}", *out)))
        if inserted < 3:
            for new in ("user", "assistant"):
                if new[0] in FOLLOWS[last]:
                    cost, audit, out = best(i, new[0], inserted + 1)
                    ways.append((cost + 3, "I" + audit, (f"{new}:", *out)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, out = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    counts = [sum(f == kind for f in faults) for kind in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def expected(rows, keys):
    return sorted(((k, *repaired([r for r in rows if r[0] == k])) for k in keys), key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(11)
    texts = ["Yes.", "No", "Why?", "", " \t", None, "Go!  ", "so ...x", "è.", "a\n"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "ux"]
    rows = []
    for conv in [None, *range(120)]:
        for i in range(rng.randint(1, 9)):
            turn = rng.choice([i, i, i, i + 2, None, 0])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows + rows[:20]


def in_sql(sql, **tables):
    con = duckdb.connect()
    for name, found in tables.items():
        if isinstance(found, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{found}'")
        else:
            con.register(name, found)
    return con.execute(sql)


@pytest.mark.parametrize("block_rows", [1 << 16, 1, 2])
def test_repair_by_exhaustive_search(spark, odd_rows, monkeypatch, block_rows):
    monkeypatch.setattr(conversation_repair, "BLOCK_ROWS", block_rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in odd_rows], SCHEMA + ", copies int, conv string").repartition(3)
    told = conversation_repair.damaged(df)
    got = conversation_repair.reports(told, every=df)
    assert got.columns == ["conv_id", *conversation_repair._SUMS, "audit", "repaired_sha256"]
    want = expected(damaged(odd_rows), {r[0] for r in odd_rows})
    assert sorted(map(tuple, got.collect()), key=repr) == want
    # The rows themselves: legal, numbered, and with the same digest.
    by_key = {}
    for r in sorted(conversation_repair.repaired(told).collect(), key=lambda r: (str(r["conv"]), r["position"])):
        by_key.setdefault(r["conv"], []).append(r)
    digests = {k: hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in rows).encode()).hexdigest() for k, rows in by_key.items()}
    assert all(digests.get(w[0], hashlib.sha256().hexdigest()) == w[-1] for w in want)
    assert all([r["position"] for r in rows] == list(range(len(rows))) for rows in by_key.values())


def test_repair_in_sql(spark, odd_rows, tmp_path):
    df = spark.createDataFrame(odd_rows, SCHEMA)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = registry.QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    found = in_sql(answers.CONVERSATION_REPAIR, conversations=f"{tmp_path}/conversations.parquet/*.parquet").fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(found, key=repr) == expected(damaged(odd_rows), {r[0] for r in odd_rows})


def test_repair_of_the_given_table(spark, sf_oracle):
    got = registry.QUERIES["op11_conversation_repair"](spark, sf_oracle)
    found = in_sql(answers.CONVERSATION_REPAIR, conversations=os.path.join(sf_oracle, "conversations.parquet"))
    assert sorted(got.columns) == sorted(d[0] for d in found.description)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(found.fetchall(), key=repr)


def test_repair_of_one_long_conversation(spark, monkeypatch):
    """Thousands of turns in blocks over several tasks; equal rows of a turn count as one."""
    monkeypatch.setattr(conversation_repair, "BLOCK_ROWS", 64)
    rng = random.Random(3)
    rows = [(7, i, rng.choice(["user", "assistant", "assistant", "tool"]), f"turn {rng.randrange(1500)}{rng.choice('.! ')}") for i in range(3000)]
    rows += [(7, 5, "user", "again.")] * 500
    got = conversation_repair.reports(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    steps = {}
    order = sorted(rows, key=lambda r: (r[1], r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    seen = set()
    ways = {"": (0, ""), "s": None, "u": None, "a": None}
    for _, _, role, text in order:  # forward, with the audits themselves
        must = (role, text) in seen
        seen.add((role, text))
        extra = 3 * (text.strip()[-1] not in ".!?")
        steps = {}

        def put(to, cost, audit):
            if steps.get(to) is None or (cost, audit) < steps[to]:
                steps[to] = (cost, audit)

        for state, held in ways.items():
            if held is None:
                continue
            put(state, held[0] + 4, held[1] + "D")
            at, spent, audit = state, held[0], held[1]
            for _ in range(3):
                for new, price, edit in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if not must and new[0] in FOLLOWS[at]:
                        put(new[0], spent + price + extra, audit + edit)
                at, spent, audit = ("a" if at == "u" else "u"), spent + 3, audit + "I"
        ways = {s: steps.get(s) for s in ways}
    cost, audit = min([ways["a"], (ways["u"][0] + 3, ways["u"][1] + "I")])
    assert len(got) == 1 and (got[0]["cost"], got[0]["audit"]) == (cost, audit)
    assert got[0]["duplicate"] == len(rows) - len(seen)


def test_repair_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.reports(none).count() == conversation_repair.repaired(none).count() == 0
    gone = conversation_repair.reports(none, every=spark.createDataFrame([(3,), (None,)], "conv_id long")).collect()
    assert {tuple(r) for r in gone} == {(k, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for k in (3, None)}
