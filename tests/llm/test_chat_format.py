"""Chat formatting: read back against the rows, SQL, and templates that look or reach back."""

import hashlib
import os
import random

import duckdb
import pytest

from ledgerline.llm import answers, chat_format, registry

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["[INST]", "[/INST]", "<s>", "</s>", "[\\INST]", "<\\\\/s>", "[ROLE] ", " [/SYS]", "\\", "<", "[", " ", "word", "è\n", "]", "text", "/s>", "INST]"]


def expected(rows):
    by_key = {}
    for conv, turn, role, text in rows:
        by_key.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = []
    for conv, turns in by_key.items():
        turns = [(r.decode(), t.decode()) for _, _, r, t in sorted(turns)]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest(), len(chat_format.tagged(turns))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(13)
    roles = ["system", "user", "assistant", "assistant", "tool", None, "", "[INST] x", " [/ROLE] "]
    rows = []
    for conv in [None, *range(150)]:
        for i in range(rng.randint(1, 8)):
            text = rng.choice([None, "", "".join(rng.choices(BITS, k=rng.randint(1, 12)))])
            rows.append((conv, rng.choice([i, i, None]), rng.choice(roles), text))
    return rows + rows[:9] + [(999, 0, "assistant", "</s> long " * 30_000), (999, 1, "user", "x")]


def in_sql(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    return con.execute(answers.CHAT_FORMAT)


def test_escaping_is_reversible():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choices(BITS, k=rng.randint(0, 9)))
        plain = chat_format.escaped(text)
        assert chat_format.unescaped(plain) == text
        assert not any(c in plain for c in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]"))


@pytest.mark.parametrize("part_chars,window", [(1 << 22, 64), (1, 64), (40, 4)])
def test_odd_rows_read_back(spark, odd_rows, tmp_path, monkeypatch, part_chars, window):
    monkeypatch.setattr(chat_format, "PART_CHARS", part_chars)
    monkeypatch.setattr(chat_format, "WINDOW_TURNS", window)
    df = spark.createDataFrame([(*r, 1, "x") for r in odd_rows], SCHEMA + ", part int, last string").repartition(3)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = registry.QUERIES["op13_chat_format"](spark, str(tmp_path))
    rows = sorted(map(tuple, got.collect()), key=repr)
    trap = [(-7, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))]
    assert rows == expected(odd_rows + trap)
    found = in_sql(f"{tmp_path}/conversations.parquet/*.parquet")
    assert sorted(d[0] for d in found.description) == sorted(got.columns)
    assert sorted(found.fetchall(), key=repr) == rows


def test_the_given_table(spark, sf_oracle):
    got = registry.QUERIES["op13_chat_format"](spark, sf_oracle).collect()
    assert sorted(map(tuple, got)) == sorted(in_sql(os.path.join(sf_oracle, "conversations.parquet")).fetchall())


def turns(n, rng):
    return [(("user", "assistant")[i % 2], "".join(rng.choices(BITS[:10] + ["word "], k=5))) for i in range(n)]


def added(template, said):
    now = chat_format.Rendering(template)
    for role, text in said:
        now.add(role, text)
    return now, *now.taken()


def plain(rows):
    return "".join(f"{r}: {t}\n" for r, t in rows)


TEMPLATES = {
    "plain": plain,
    "trimmed": lambda rows: "".join(f"<{r}>{t.strip()}" for r, t in rows),
    "numbered": lambda rows: "".join(f"#{i} {t}" for i, (_, t) in enumerate(rows)),
    "no user": lambda rows: plain([r for r in rows if r[0] != "user"]),
    "system folded into the first user turn": lambda rows: plain(
        [("user", rows[0][1] + " / " + rows[1][1]), *rows[2:]] if len(rows) > 1 and rows[0][0] == "system" else rows
    ),
    "closed": lambda rows: plain(rows) + "<end>",
    "last reasoning only": lambda rows: plain([(r, t if i > len(rows) - 3 else "...") for i, (r, t) in enumerate(rows)]),
}


@pytest.mark.parametrize("name", TEMPLATES)
@pytest.mark.parametrize("system", [False, True])
def test_any_template(name, system, monkeypatch):
    """The parts are the whole rendering, every span holds its text, and rewriting is noticed."""
    monkeypatch.setattr(chat_format, "WINDOW_TURNS", 12)
    said = [("system", "be brief")] * system + turns(40, random.Random(name))
    template = TEMPLATES[name]
    now, text, spans = added(template, said)
    assert text == template(said) and len(spans) == len(said)
    first = {"closed": 1, "last reasoning only": 2, "system folded into the first user turn": 1 if system else None}
    assert now.rewritten_at == first.get(name)
    for (role, said_), (got_role, _, _, start, end) in zip(said, spans, strict=True):
        assert role == got_role
        if start is not None:
            assert text[start:end] == (said_.strip() if name == "trimmed" else said_)
    shown = [s[3] is not None for s in spans]
    assert all(shown) or name in ("no user", "last reasoning only")
    assert now.far == (name == "numbered")


def test_long_conversations_take_linear_work():
    calls = [0]

    def counting(rows):
        calls[0] += len(rows)
        return chat_format.tagged(rows)

    said = turns(3000, random.Random(2))
    _, text, _ = added(counting, said)
    assert text == chat_format.tagged(said) and calls[0] < 3000 * 2 * (chat_format.WINDOW_TURNS + 8)


def once_in(n, change):
    """The plain template, changed from the n-th turn on."""
    return lambda rows: change(rows) if len(rows) >= n else plain(rows)


LATE = TEMPLATES | {
    "closed late": once_in(30, lambda rows: plain(rows) + "<end>"),
    "reasoning dropped late": once_in(25, lambda rows: plain([(r, t if i > 20 else "") for i, (r, t) in enumerate(rows)])),
    "nothing shown of old turns": lambda rows: plain([("old", "")] * max(0, len(rows) - 33) + list(rows[-33:])),
    "counts late": lambda rows: "".join(f"{t}#{i if i > 27 else ''}" for i, (_, t) in enumerate(rows)),
    "quotes the first": lambda rows: "".join(t + (f" as in {rows[2]}" if i == 34 else "") for i, (_, t) in enumerate(rows)),
    "tagged": chat_format.tagged,
}


@pytest.mark.parametrize("name", LATE)
def test_length_decides_nothing(name, monkeypatch):
    """Whatever a template does, and however late, small parts and short histories give what large ones do."""
    said = [("system", "be brief"), *turns(40, random.Random(name)), ("user", "è\ud800")]
    (want,) = chat_format.rendered(LATE[name], said)
    assert want[1] == LATE[name](said)
    monkeypatch.setattr(chat_format, "WINDOW_TURNS", 8)
    for part_chars in (1 << 22, 150, 1):
        monkeypatch.setattr(chat_format, "PART_CHARS", part_chars)
        parts = list(chat_format.rendered(LATE[name], iter(said)))
        assert [p[3] for p in parts] == [False] * (len(parts) - 1) + [True]
        assert "".join(p[1] for p in parts) == want[1]
        if name != "nothing shown of old turns":  # each prefix of which changed the one before
            assert parts[-1][0] == want[0] and {p[0] for p in parts[:-1]} <= {None}
        at, spans = 0, []
        for _, text, some, _ in parts:
            spans += [(role, *(None if x is None else x + at for x in span)) for role, *span in some]
            at += len(text)
        assert [(s[0], *s[3:]) for s in spans] == [(s[0], *s[3:]) for s in want[2]]
        assert want[0] is not None or part_chars > 150 or len(parts) > 1


def test_a_local_template_that_rewrites_is_an_error_at_any_length(monkeypatch):
    template = lambda rows: plain(rows) + "<end>"
    template.local = True
    for n in (2, 200):
        with pytest.raises(ValueError, match="rewrites history at turn 1"):
            list(chat_format.rendered(template, turns(n, random.Random(1))))


def test_late_rewriting_in_a_table(spark):
    """More characters than a part has, then a turn that changes the past."""
    n = chat_format.PART_CHARS // 1000 // 2
    rows = [(c, i, "user", "x" * 2000 if i < n + 40 else "end") for c in (1, 2) for i in range(n + 40 + c % 2)]

    def template(said):  # of its own, so that it travels to the tasks
        return "".join(f"{r}: {t}\n" for r, t in said[-1:] if t == "end") or "".join(f"{r}: {t}\n" for r, t in said)

    got = {}
    for r in chat_format.formatted(spark.createDataFrame(rows, SCHEMA), template).orderBy("conv_id", "part").collect():
        got.setdefault(r["conv_id"], []).append(r)
    (one,) = got[1]
    assert (one["rewritten_at"], one["text"], one["last"], len(one["turns"])) == (n + 40, "user: end\n", True, n + 41)
    assert len(got[2]) == 2 and [r["last"] for r in got[2]] == [False, True] and sum(len(r["turns"]) for r in got[2]) == n + 40


def test_rewriting_and_other_columns_in_a_table(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "v")]
    df = spark.createDataFrame(rows, SCHEMA)

    def template(said):  # of its own, so that it travels to the tasks
        if len(said) > 1 and said[0][0] == "system":
            said = [("user", said[0][1] + " / " + said[1][1]), *said[2:]]
        return "".join(f"{r}: {t}\n" for r, t in said)

    got = {r["conv_id"]: r for r in chat_format.formatted(df, template).collect()}
    assert got[1]["rewritten_at"] == 1 and got[2]["rewritten_at"] is None
    assert got[1]["text"] == "user: s / u\nassistant: a\n" and [t["loss"] for t in got[1]["turns"]] == [False, False, True]
    last = got[1]["turns"][2]
    assert got[1]["text"][last["text_start"] : last["text_end"]] == "a"
    assert chat_format.digests(chat_format.formatted(df.limit(0))).count() == 0
