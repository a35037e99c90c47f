"""Token ids of whole texts from a public tokenizer file, each distinct word encoded once.

A tokenizer that cuts at white space and drops it gives a text the ids of its words, one after
the other. Words (cut at blanks and line ends only) are looked up in a table kept with the
worker process; what is missing is encoded by the tokenizers library. When the table holds
``KEPT_WORDS`` words, those met only once are forgotten, which bounds memory and changes no id.
Texts go through the library whole if the file describes a tokenizer of another kind.
"""

from __future__ import annotations

import json
import os
import re
import sys
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
#: Words a worker keeps the ids of; about 200 bytes each.
KEPT_WORDS = 600_000
#: Stems that are encoded in one string.
_JOINED = 256
#: Letters that keep their number under lower-casing and composition (the I with a dot does not).
_PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"

#: How a byte-level vocabulary writes the bytes that have no sign of their own, the blank left out.
_SIGNLESS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_BYTES = {chr(b): chr(256 + i) for i, b in enumerate(_SIGNLESS) if b != 32}
_TO_SIGN = re.compile(f"[{re.escape(''.join(_BYTES))}]")


class WordIds:
    """Ids of words; ``flat[first[c]:first[c] + count[c]]`` are those of the word with code c."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as lines:
            described = json.load(lines)
        self.by_word = _drops_white_space(described)
        if not self.by_word:
            return
        vocabulary = self.tokenizer.get_vocab()
        suffix = described["model"]["end_of_word_suffix"]
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        # Small letters alone need neither normalizing nor further cuts, and arrive with their bytes
        # already written as the vocabulary's letters. Most of them come once: no cache of the library's.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        if hasattr(self.letters.model, "_resize_cache"):
            self.letters.model._resize_cache(0)
        self.marks = {m: self._whole(m)[0] for m in ".,"}
        self._keep([], np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _keep(self, words: list[str], counts: np.ndarray, flat: np.ndarray) -> None:
        """Start the table with these words; code 0 is the empty word."""
        self.code = dict(zip(["", *words], range(len(words) + 1), strict=True))
        self.count = np.concatenate(([0], counts))
        self.first = np.cumsum(self.count) - self.count
        self.flat = flat
        self.uses = np.zeros(len(self.code), np.int64)

    def _forget(self) -> None:
        often = self.uses > 1
        often[0] = False
        if 2 * np.count_nonzero(often) > KEPT_WORDS:
            often[:] = False
        words = list(chain.from_iterable([w] if k else [] for w, k in zip(self.code, often.tolist(), strict=True)))
        codes = np.flatnonzero(often)
        self._keep(words, self.count[codes], self.flat[_ranges(self.first[codes], self.count[codes])])

    def _learn(self, words: list[str]) -> None:
        column = pa.array(words, pa.string())
        last = pc.utf8_slice_codeunits(column, -1)
        closed = pc.is_in(last, pa.array(list(self.marks)))
        body = pc.if_else(closed, pc.utf8_slice_codeunits(column, 0, -1), column)
        # Letters are cut from a closing mark anyway, and their case plays no part.
        plain = pc.match_substring_regex(body, _PLAIN)
        bodies = pc.utf8_lower(body.filter(plain)).dictionary_encode()
        names = _texts(bodies.dictionary)
        others = _texts(column.filter(pc.invert(plain)))
        plain = plain.to_numpy(zero_copy_only=False)
        marks = np.zeros(len(words), np.uint32)
        for mark, number in self.marks.items():
            marks[pc.equal(last, mark).to_numpy(zero_copy_only=False) & plain] = number
        joined = [_signed(" ".join(names[i : i + _JOINED])) for i in range(0, len(names), _JOINED)]
        found = [e.ids for e in self.letters.encode_batch_fast(joined, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        ends = np.flatnonzero(self.ends_word[flat]) + 1
        if len(ends) != len(names):
            raise ValueError("a word without an end")
        firsts = np.concatenate(([0], ends[:-1]))[: len(names)]
        counts = ends - firsts
        rest = [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        rest_counts = np.fromiter(map(len, rest), np.int64, len(rest))
        firsts = np.concatenate((firsts, len(flat) + np.cumsum(rest_counts) - rest_counts))
        counts = np.concatenate((counts, rest_counts))
        flat = np.concatenate((flat, np.fromiter(chain.from_iterable(rest), np.uint32, int(rest_counts.sum()))))
        which = np.empty(len(words), np.int64)
        which[plain] = bodies.indices.to_numpy()
        which[~plain] = len(names) + np.arange(len(rest))
        # A place is kept free behind the ids of words with a closing mark.
        body_counts = counts[which]
        counts = body_counts + (marks > 0)
        new = np.zeros(int(counts.sum()), np.uint32)
        begin = np.cumsum(counts) - counts
        new[_ranges(begin, body_counts)] = flat[_ranges(firsts[which], body_counts)]
        new[(begin + body_counts)[marks > 0]] = marks[marks > 0]
        self.code.update(zip(words, range(len(self.code), len(self.code) + len(words)), strict=True))
        self.first = np.concatenate((self.first, len(self.flat) + begin))
        self.count = np.concatenate((self.count, counts))
        self.flat = np.concatenate((self.flat, new))
        self.uses = np.concatenate((self.uses, np.zeros(len(words), np.int64)))

    def _codes(self, words: list[str]) -> np.ndarray:
        if len(self.code) > KEPT_WORDS:
            self._forget()
        known = len(self.code)
        codes = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            self._learn([words[i] for i in missing.tolist()])  # the words are distinct
            codes[missing] = known + np.arange(len(missing))
        return codes

    def encode(self, texts: pa.Array, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each text's followed by the id ``last``, and how many
        each text has."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not self.by_word:
            whole = [np.array([*self._whole(t), last], np.uint32) for t in texts.to_pylist()]
            return np.concatenate(whole), np.fromiter(map(len, whole), np.int64, len(whole))
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        edges = words.offsets.to_numpy()
        distinct = words.flatten().dictionary_encode()
        used = self._codes(_texts(distinct.dictionary))
        codes = used[distinct.indices.to_numpy()]
        self.uses += np.bincount(codes, minlength=len(self.uses))
        counts = self.count[codes]
        ids = self.flat[_ranges(self.first[codes], counts)]
        ends = np.concatenate(([0], np.cumsum(counts)))[edges]
        return np.insert(ids, ends[1:], last), np.diff(ends) + 1


def _texts(column: pa.Array) -> list[str]:
    """A column's texts, without a scalar of Arrow's for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _signed(text: str) -> str:
    """The UTF-8 bytes of a text as the vocabulary's letters."""
    if text.isascii():  # small letters and blanks, which stand for themselves
        return text
    return _TO_SIGN.sub(lambda m: _BYTES[m[0]], text.encode().decode("latin-1"))


def _ranges(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each range, one range after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    small = np.int32 if max(total, int(firsts.max(initial=0))) < 1 << 30 else np.int64
    return np.arange(total, dtype=small) + np.repeat((firsts - (ends - counts)).astype(small), counts)


def _drops_white_space(described: dict) -> bool:
    """Whether the file's tokenizer works on words between white space, none affecting another."""
    normalizers = [n["type"] for n in (described["normalizer"] or {}).get("normalizers", [])]
    cuts = (described["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return (
        normalizers == ["NFC", "Replace", "Lowercase"]
        and described["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and cuts[0].get("type") == "Split"
        and cuts[0]["behavior"] == "Removed"
        and cuts[0]["invert"]
        and cuts[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and [c["type"] for c in cuts[1:]] == ["ByteLevel"]
        and not cuts[1]["add_prefix_space"]
        and bool(described["model"].get("end_of_word_suffix"))
    )


def word_ids(file: str) -> WordIds:
    """The table of this worker process, which Spark gives to one task after another."""
    kept = vars(sys).setdefault("_ledgerline_word_ids", {})
    if file not in kept:
        kept[file] = WordIds(file)
    return kept[file]


def vocabulary_path(name: str) -> str:
    """Where the installed public vocabulary files have this one."""
    import public_tokenizers

    return public_tokenizers.path(name)
