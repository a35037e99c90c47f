"""Surrogates for personal data: keyed, of the same type and shape, distinct, coreferent.

Entities are found by pattern. Each is normalised to an identity (an address's letter case or a
number's grouping is not part of it), and its surrogate depends on the identity and a secret key
alone, so one entity has one surrogate wherever it occurs, without a table of entities and
without a shuffle.

Within a type and a shape, all values are put in a circle by a keyed permutation (a Feistel network
over the digits and letters, or over the names of a group), and each is replaced by the next. That
is one to one and leaves nothing as it was, so two identities never share a surrogate. Where a
shape must also satisfy a rule (a card's check digit), the walk goes on until the rule holds,
which keeps it one to one.
``verified`` checks this over a whole table, after the fact: no surrogate stands for two identities,
no identity has two surrogates, and no surrogate is itself an identity that really occurs. Each entity that
breaks this gets the first of further surrogates, under other derived keys, that neither occurs nor is taken; however
many they are, they stay in tables, and only rows that hold one are changed. Where the values that occur fill a
shape's space (all two-letter names, most one-digit addresses), no key avoids them: then that shape's first
permutation stands, distinct and coreferent as it is, and each row counts those of its entities whose surrogate
occurs (``n_occurring``). This is settled shape by shape, so what one shape holds changes no other: how full a shape
is decides, and neither the size of the table nor the number of conflicts. Data never ends a run.
Names of the lists below are drawn from their own group, so there a surrogate is a name that may
occur and is not counted. ``collisions`` lists what breaks distinctness.

The secret has no default: whoever knows it can take surrogates back.

Shape: digits stay digits, letters stay letters of the same script and case, punctuation and
lengths stay. Given names are replaced by names of the same gender and script, family names by
family names of the script.

Rows: a null text stays null and has no entities; empty texts and texts without entities stay as
they are; repeated rows get equal answers; all other columns are carried along.
"""

from __future__ import annotations

import hashlib
import hmac
import os
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from ledgerline.llm.common import by_block, merged, written

#: Setting that names the secret of a run; without it every run makes its own.
SECRET = "spark.ledgerline.pii.secret"
_ROUNDS = 8
_AT_ONCE = 1024
#: Keys that an entity's surrogate is sought under, and entities that one task gives surrogates anew. Where the
#: values that occur fill a third of a shape or less, each key fails for two thirds at most.
TURNS, ANEW = 64, 100_000

# Letters by script and case, and given and family names by script and gender.
_LETTERS = (
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "0123456789",
)
_NAMES = {
    "female latin": "Alice Anna Barbara Carla Carmen Charlotte Clara Diana Elena Elizabeth Emma Eva Hannah Helen Ines "
    "Jane Julia Karen Laura Linda Lucia Maria Marta Mary Monica Nora Olivia Paula Rosa Sarah Sofia Susan",
    "male latin": "Adam Albert Andrew Anton Bruno Carlos Charles Daniel David Diego Edward Frank George Hans Henry "
    "Hugo James Jean John Jorge Karl Louis Luis Mark Martin Michael Oliver Paul Peter Robert Thomas William",
    "female cyrillic": "Анна Вера Галина Дарья Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия",
    "male cyrillic": "Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей Юрий",
    "family latin": "Adams Baker Bauer Becker Bernard Brown Clark Cruz Davis Dubois Fischer Garcia Gomez Green Hall "
    "Harris Jackson Johnson Jones Klein Lewis Lopez Martin Meyer Miller Moore Moreau Müller Perez Petit Smith Weber",
    "family cyrillic": "Волков Иванов Козлов Лебедев Морозов Новиков Павлов Петров Попов Семёнов Смирнов Соколов",
}
_GROUPS = {group: names.split() for group, names in _NAMES.items()}
_GROUP_OF = {name: group for group, names in _GROUPS.items() if not group.startswith("family") for name in names}

#: Country codes of two digits; those that start with 1 or 7 have one, all others three.
_TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98".split()
)

_GIVEN = "|".join(sorted(_GROUP_OF))
#: Types in the order in which they claim text; a name needs a title or a known given name before it.
_PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b\s*[=:]\s*[\"']?)"
    r"(?P<secret>[A-Za-z0-9+/_-]{8,})",
    "key": r"\b(?:AKIA|ASIA)(?P<key>[A-Z0-9]{16})\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![\w-])(?:\d{4}[ -]?){3}\d{1,7}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-])",
    "long_phone": r"(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)",
    "name": rf"\b(?:(?:Mr|Mrs|Ms|Dr|Prof)\.? (?P<titled>[A-ZА-Я][a-zа-яäöüßéèñ]+)"
    rf"|(?P<given>{_GIVEN}) (?P<family>[A-ZА-Я][a-zа-яäöüßéèñ]+))\b",
}
_ENTITY = re.compile("|".join(f"(?P<t_{t}>{p})" for t, p in _PATTERNS.items()))
#: Texts without any of these have no entity; most texts end here.
_SIGN = re.compile(r"[0-9@=:]")
_NAMED = re.compile(rf"\b(?:(?:Mr|Mrs|Ms|Dr|Prof)\.? |(?:{_GIVEN}) )")


def run_key(spark: SparkSession) -> bytes:
    """The secret the session names, or a new one for this run."""
    named = spark.conf.get(SECRET, None)
    return named.encode() if named else os.urandom(32)


class Surrogates:
    """The keyed replacements."""

    def __init__(self, key: bytes):
        self.key = key
        self.later: dict[int, Surrogates] = {}

    def at(self, turn: int) -> Surrogates:
        """The replacements of one turn: under a key of their own from the second on."""
        if not turn:
            return self
        if turn not in self.later:
            self.later[turn] = Surrogates(hmac.digest(self.key, f"turn {turn}".encode(), "sha256"))
        return self.later[turn]

    def _sealed(self, domain: str, value: int, size: int, back: bool) -> int:
        """The place of ``value`` under a keyed permutation of range(size), or the way back."""
        half = max(1, -(-(size - 1).bit_length() // 2))
        mask = (1 << half) - 1
        while True:  # the network permutes a larger range; walk on until inside again
            left, right = value >> half, value & mask
            if back:
                left, right = right, left
            for r in range(_ROUNDS)[:: -1 if back else 1]:
                seal = hmac.digest(self.key, f"{domain}|{size}|{r}|{right}".encode(), "sha256")
                left, right = right, left ^ (int.from_bytes(seal[:16], "big") & mask)
            if back:
                left, right = right, left
            value = left << half | right
            if value < size:
                return value

    def _number(self, domain: str, value: int, size: int, good: Callable[[int], bool] = lambda v: True) -> int:
        """The next number in a keyed order of range(size) that satisfies the rule.

        ``value`` must satisfy it too. Going on by one place in a circle is one to one, and leaves
        nothing where it was.
        """
        while True:
            place = (self._sealed(domain, value, size, False) + 1) % size
            value = self._sealed(domain, place, size, True)
            if good(value):
                return value

    def shaped(self, domain: str, text: str, alphabets: tuple[str, ...] = _LETTERS) -> str:
        """Letters and digits permuted together within the text's shape; all else stays."""
        places = [(i, kind) for i, c in enumerate(text) for kind in alphabets if c in kind]
        shape = "".join(str(alphabets.index(k)) for _, k in places)
        # Long texts in parts, each sealed by the parts before it: still one to one.
        out, before = list(text), ""
        for at in range(0, len(places), 32):
            part = places[at : at + 32]
            value, size = 0, 1
            for i, kind in part:
                value, size = value * len(kind) + kind.index(text[i]), size * len(kind)
            value = self._number(f"{domain}|{shape}|{at}|{before}", value, size)
            for i, kind in reversed(part):
                value, digit = divmod(value, len(kind))
                out[i] = kind[digit]
            before = hashlib.sha256((before + "".join(text[i] for i, _ in part)).encode()).hexdigest()
        return "".join(out)

    def _digits(self, domain: str, text: str, good: Callable[[str], bool] = lambda d: True, keep: int = 0) -> str:
        """The digits after the first ``keep`` permuted, the rule holding after as before."""
        digits = _digits_of(text)
        head, tail = digits[:keep], digits[keep:]
        size = 10 ** len(tail)
        known = good(digits)
        new = self._number(
            f"{domain}|{head}|{known}", int(tail or 0), size, lambda v: good(head + f"{v:0{len(tail)}}") == known
        )
        fresh = iter(head + (f"{new:0{len(tail)}}" if tail else ""))
        return "".join(next(fresh) if c.isdecimal() else c for c in text)

    def replace(self, kind: str, text: str) -> str:
        if kind == "email":
            local, _, domain = text.rpartition("@")
            name, _, top = domain.rpartition(".")
            new = f"{self.shaped('email', local.lower())}@{self.shaped('email domain', name.lower())}.{top}"
            return new if text != text.upper() else new.upper()
        if kind == "ip":
            parts = [int(p) for p in text.split(".")]
            widths = [(0, 10), (10, 100), (100, 256)]  # a part keeps its number of digits
            value, size, bounds = 0, 1, []
            for p in parts:
                low, high = next(w for w in widths if p < w[1])
                bounds.append((low, high))
                value, size = value * (high - low) + p - low, size * (high - low)
            value = self._number(f"ip|{bounds}", value, size)
            out = []
            for low, high in reversed(bounds):
                value, p = divmod(value, high - low)
                out.append(str(low + p))
            return ".".join(reversed(out))
        if kind == "card":
            return self._digits("card", text, _checks, keep=1)
        if kind in ("phone", "long_phone"):
            return self._digits("phone", text, keep=_country_code(_digits_of(text)))
        if kind == "ssn":
            return self._digits("ssn", text)
        if kind == "iban":
            return text[:2] + self.shaped(f"iban|{text[:2]}", text[2:])
        if kind == "secret" and re.fullmatch("[0-9a-f]+", text):
            return self.shaped("hexadecimal", text, ("0123456789abcdef",))
        return self.shaped(kind, text)

    def of(self, label: str, text: str) -> str:
        """The surrogate for what an entity's label, rather than its kind, stands beside."""
        return self.name(text, label == "family") if label in ("given", "family") else self.replace(label, text)

    def name(self, word: str, family: bool) -> str:
        """A name of the same group, or a shaped word for a name outside all groups."""
        script = "cyrillic" if "а" <= word[-1] <= "я" else "latin"
        group = f"family {script}" if family else _GROUP_OF.get(word, "")
        names = _GROUPS.get(group, [])
        if word in names:
            return names[self._number(group, names.index(word), len(names))]
        while True:  # outside the group before and after
            word = self.shaped("name", word)
            if word not in names:
                return word


def _digits_of(text: str) -> str:
    """The decimal digits of a text, those of other scripts as ASCII."""
    digits = re.sub(r"\D", "", text)
    return digits if digits.isascii() else "".join(str(unicodedata.decimal(c)) for c in digits)


def _country_code(digits: str) -> int:
    """How many of a phone number's digits are its country code; none of ten or fewer. It depends on the
    digits alone, as the identity does, and not on how they are written."""
    if len(digits) <= 10:
        return 0
    return 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGIT_CODES else 3


def _checks(digits: str) -> bool:
    """Luhn's rule."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


#: The part of a match that is replaced, where that is not all of it.
_PARTS = {"secret": ("secret",), "key": ("key",), "name": ("titled", "given", "family")}


def identity(kind: str, text: str) -> str:
    """What two mentions of one entity have in common."""
    if kind == "email":
        return text.lower()
    if kind in ("card", "phone", "long_phone", "ssn"):
        return _digits_of(text)
    return text


def replaced(text: str, surrogates: Surrogates) -> tuple[str, list[dict]]:
    """The text with surrogates, and what was replaced: type, start, end (in the text given),
    identity, surrogate; further its place in the new text (from, to) and what the text said."""
    out, found, at, size = [], [], 0, 0
    if not _SIGN.search(text) and not _NAMED.search(text):
        return text, found
    for m in _ENTITY.finditer(text):
        kind = m.lastgroup if m.lastgroup.startswith("t_") else next(g for g in _KINDS if m[g] is not None)
        kind = kind[2:]
        for part in _PARTS.get(kind, (f"t_{kind}",)):
            old = m[part]
            if old is None:
                continue
            label = {"long_phone": "phone", "name": "given" if part == "given" else "family"}.get(kind, kind)
            who = identity(kind, old)
            new = surrogates.of(label, old)
            out += [text[at : m.start(part)], new]
            size += m.start(part) - at + len(new)
            at = m.end(part)
            found.append(
                {"type": label, "start": m.start(part), "end": at, "identity": who,
                 "surrogate": identity(kind, new), "from": size - len(new), "to": size, "said": old}
            )
    out.append(text[at:])
    return "".join(out), found


_KINDS = [f"t_{t}" for t in _PATTERNS]
_FOUND = T.ArrayType(
    T.StructType().add("type", "string").add("start", "integer").add("end", "integer")
    .add("identity", "string").add("surrogate", "string")
)


#: Where the surrogates of a row stand in its new text, and what stood there; in the order of its entities.
_PUT, _PUT_TYPE = "_put", T.ArrayType(T.StructType().add("from", "integer").add("to", "integer").add("said", "string"))


def pseudonymised(
    df: DataFrame, key: bytes, text: str = "text", entities: str | None = "entities", put: str | None = None
) -> DataFrame:
    """The rows with surrogates in ``text``; a column ``entities`` (replacing one of that name)
    lists what was replaced, unless None is given for it. ``put``: a column for what ``_turned`` needs."""
    kept = df.drop(entities) if entities else df
    names = kept.columns
    schema = T.StructType(list(kept.schema.fields))
    added = {name: kind for name, kind in ((entities, _FOUND), (put, _PUT_TYPE)) if name}
    for name, kind in added.items():
        schema = schema.add(name, kind)

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        surrogates = Surrogates(key)
        both = [(None, []) if t is None else replaced(t, surrogates) for t in block.column(text).to_pylist()]
        columns = [
            pa.array([b[0] for b in both], pa.string()) if n == text else block.column(n) for n in names
        ]
        columns += [pa.array([b[1] for b in both], to_arrow_type(kind)) for kind in added.values()]
        return pa.RecordBatch.from_arrays(columns, [*names, *added])

    return kept.mapInArrow(by_block(work, text), schema)


def collisions(found: DataFrame, entities: str = "entities") -> DataFrame:
    """Per type and surrogate that breaks distinctness: type, surrogate, n_identities (that it
    stands for), occurs (whether it is itself the identity of another entity of the table)."""
    each = found.select(F.explode(entities).alias("e")).select("e.type", "e.identity", "e.surrogate").distinct()
    each = written(each, "entities")
    several = each.groupBy("type", "surrogate").agg(F.count("*").alias("n_identities"))
    real = each.select("type", F.col("identity").alias("surrogate"), F.lit(True).alias("occurs")).distinct()
    both = several.join(real, ["type", "surrogate"], "left")
    both = both.withColumn("occurs", F.coalesce("occurs", F.lit(False)))
    return both.filter((F.col("n_identities") > 1) | F.col("occurs"))


def conflicts(found: DataFrame, entities: str = "entities") -> DataFrame:
    """Entities (type, identity, n_surrogates) that share a surrogate, have several, or whose
    surrogate is the identity of an entity of the table (but for names of the lists)."""
    return _conflicting(_each(found, entities))


def _each(found: DataFrame, entities: str) -> DataFrame:
    """The table's entities, once for each surrogate: type, identity, surrogate; written."""
    each = found.select(F.explode(entities).alias("e")).select("e.type", "e.identity", "e.surrogate").distinct()
    # Without letters or digits there is nothing to replace.
    return written(each.filter(F.col("surrogate").rlike(r"[\p{L}\p{N}]")), "entities")


def _conflicting(each: DataFrame) -> DataFrame:
    shared = each.groupBy("type", "surrogate").agg(F.count("*").alias("n")).filter("n > 1")
    split = each.groupBy("type", "identity").agg(F.count("*").alias("n_surrogates"))
    real = each.select("type", F.col("identity").alias("surrogate")).distinct()
    listed = F.col("type").isin("given", "family") & F.col("surrogate").isin(sorted({n for g in _GROUPS.values() for n in g}))
    rows = each.count()
    hit = each.join(merged(shared, rows), ["type", "surrogate"], "left_semi").union(
        each.filter(~listed).join(merged(real, rows), ["type", "surrogate"], "left_semi")
    )
    hit = hit.select("type", "identity", F.lit(True).alias("hit")).distinct()
    both = split.join(merged(hit, rows), ["type", "identity"], "left")
    return both.filter(F.col("hit") | (F.col("n_surrogates") > 1)).drop("hit")


def verified(
    df: DataFrame, key: bytes, text: str = "text", entities: str = "entities", counted: str | None = "n_occurring"
) -> DataFrame:
    """``pseudonymised`` rows, written and checked for ``conflicts``.

    ``counted`` (replacing a column of that name, unless None) is the number of a row's entities that are among
    the conflicts left, 0 wherever the shapes have room.
    """
    if counted:
        df = df.drop(counted)
    zero = [F.lit(0).cast("long").alias(counted)] if counted else []
    plain = written(pseudonymised(df, key, text, entities, _PUT), "pseudonymised")
    each = _each(plain, entities)
    left = written(_conflicting(each), "conflicts")
    if left.isEmpty():
        return plain.drop(_PUT).select("*", *zero)
    turns, found = _turns(each, left, key), plain
    if not turns.isEmpty():
        found = written(_turned(plain, turns, key, text, entities), "pseudonymised")
    if not counted:
        return found.drop(_PUT)
    if found is not plain:
        left = written(conflicts(found, entities), "conflicts")
    return _with_counts(found, entities, counted, left).drop(_PUT)


def _turns(each: DataFrame, left: DataFrame, key: bytes) -> DataFrame:
    """The entities not at their first turn: type, identity, turn.

    An entity in ``left`` gets the first turn whose surrogate is neither an entity of the table, nor any entity's at its
    first turn, nor another's by now; of several that come to one value at once the least keeps it. So whoever stays at
    the first turn shares its surrogate with nobody who left it. Entities with several surrogates stay there, and all of
    a shape in which some find none. A surrogate follows from identity and turn, so the rows wait.
    """
    entity, value = ["type", "identity"], ["type", "surrogate"]
    taken = each.select(*value).union(each.select(*entity))
    waiting = written(left.filter("n_surrogates = 1").select(*entity), "entities")
    placed = written(waiting.limit(0).select("*", F.lit(0).alias("turn"), F.lit("").alias("surrogate")), "entities")

    def work(turns: range) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            surrogates = Surrogates(key)
            for batch in batches:
                for some in range(0, batch.num_rows, _AT_ONCE):
                    told = [
                        {**r, "turn": turn, "surrogate": identity(r["type"], surrogates.at(turn).of(r["type"], r["identity"]))}
                        for r in batch.slice(some, _AT_ONCE).to_pylist() for turn in turns
                    ]
                    # An address must be one in capitals too, whichever way a text writes it.
                    told = [r for r in told if r["type"] != "email" or r["surrogate"].upper().lower() == r["surrogate"]]
                    yield pa.RecordBatch.from_pylist(told, schema=like)

        return task

    like = to_arrow_schema(placed.schema)
    start, n = 1, waiting.count()
    most = n
    while start < TURNS and n:
        turns = range(start, min(2 * start, TURNS))  # few turns for the many, many for the few that are left
        start = turns.stop
        tried = waiting.repartition(-(-n // ANEW), *entity).mapInArrow(work(turns), placed.schema)
        tried = written(tried, "entities")
        values = merged(tried.select(*value).distinct(), n * len(turns))
        hit = taken.union(placed.select(*value)).join(values, value, "left_semi").distinct()
        free = tried.join(merged(hit, n * len(turns)), value, "left_anti")
        first = free.groupBy(*entity).agg(F.min(F.struct("turn", "surrogate")).alias("own"))
        kept = first.groupBy("type", "own.surrogate").agg(F.min(F.struct("identity", "own.turn")).alias("who"))
        kept = kept.select("type", "who.identity", "who.turn", "surrogate")
        placed = written(placed.unionByName(kept), "entities")
        waiting = written(waiting.join(merged(placed, most), entity, "left_anti"), "entities")
        n = waiting.count()
    full = waiting.select("type", _shape().alias("shape")).distinct()
    turned = placed.withColumn("shape", _shape()).join(merged(full, n), ["type", "shape"], "left_anti")
    return merged(turned.select(*entity, "turn"), most)


def _shape() -> Column:
    """An identity with the kind of each letter and digit in its place; its surrogates have the same."""
    return F.translate("identity", "".join(_LETTERS), "".join(str(i) * len(kind) for i, kind in enumerate(_LETTERS)))


def _placed() -> list[Column]:
    """The place of a row in a written table."""
    return [F.col("_metadata.file_path").alias("_in_file"), F.col("_metadata.row_index").alias("_at_row")]


def _turned(plain: DataFrame, turns: DataFrame, key: bytes, text: str, entities: str) -> DataFrame:
    """Rows of a written table, those with entities in ``turns`` with the surrogates of these."""
    each = plain.select(*_placed(), F.explode(entities).alias("_e")).select("_in_file", "_at_row", "_e.type", "_e.identity")
    some = each.distinct().join(turns, ["type", "identity"]).groupBy("_in_file", "_at_row")
    some = some.agg(F.collect_list(F.struct("type", "identity", "turn")).alias("_turns"))
    rows = plain.select(F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("_row"), *_placed())
    both = rows.join(some, ["_in_file", "_at_row"], "left").select("_row.*", "_turns")
    schema = plain.drop(_PUT).schema

    def again(said: str, found: list[dict], put: list[dict], own: dict, surrogates: Surrogates) -> str:
        out, at = [], 0
        for e, p in zip(found, put, strict=True):
            new = said[p["from"] : p["to"]]
            if turn := own.get((e["type"], e["identity"])):
                new = surrogates.at(turn).of(e["type"], p["said"])
                e["surrogate"] = identity(e["type"], new)
            out += [said[at : p["from"]], new]
            at = p["to"]
        return "".join([*out, said[at:]])

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        surrogates = Surrogates(key)
        turned = block.column("_turns").to_pylist()
        if any(turned):
            texts, found, put = (block.column(n).to_pylist() for n in (text, entities, _PUT))
            for i, own in enumerate(turned):
                if own:
                    own = {(t["type"], t["identity"]): t["turn"] for t in own}
                    texts[i] = again(texts[i], found[i], put[i], own, surrogates)
            new = {text: pa.array(texts, pa.string()), entities: pa.array(found, to_arrow_type(_FOUND))}
        else:
            new = {}
        return pa.RecordBatch.from_arrays([new.get(n, block.column(n)) for n in schema.names], schema.names)

    return both.mapInArrow(by_block(work, text), schema)


def _with_counts(found: DataFrame, entities: str, counted: str, left: DataFrame) -> DataFrame:
    """Rows of a written table with the number of their entities that conflict."""
    place = _placed()
    each = found.select(*place, F.explode(entities).alias("_e")).select("_in_file", "_at_row", "_e.type", "_e.identity")
    counts = each.join(left, ["type", "identity"], "left_semi").groupBy("_in_file", "_at_row").agg(F.count("*").alias("_n"))
    rows = found.select(F.struct(*[F.col(f"`{c}`") for c in found.columns]).alias("_row"), *place)
    both = rows.join(counts, ["_in_file", "_at_row"], "left")
    return both.select("_row.*", F.coalesce("_n", F.lit(0)).cast("long").alias(counted))
