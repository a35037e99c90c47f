"""Main text of web pages: the contiguous region of highest score.

A page is read as a sequence of tags and stretches of words. Words score by where they stand (the
kind of element around them), tags score below zero, and a linear scan finds the stretch of the
page whose scores sum highest. Weights come from labelled pages: those whose own markup names the
article say which words and tags lie inside it. A kind of word weighs the logarithm of its share
of the words inside over its share of those outside; tags weigh the same way, but never above
``TAG_AT_MOST``. The labelled pages are a bounded sample; kinds it does not show keep
``UNSEEN``.

Elements that are no article text wherever they stand (adverts, forms, notices, reader comments and
so on, by element or by the names in class, id and role) are left out and weigh nothing, so they
neither end a region nor begin one. A name counts as a whole: ``comments`` and ``cookie-notice`` do,
``comments-open`` and ``no-sidebar`` do not. No name leaves out an article or main element, unless it
stands inside another, or what the page's first one stands in. Blocks are joined by a line end; a
line break or white space inside a block is one space.

Rows: a null or empty page has the empty text, as has a page without a stretch of positive score;
repeated rows are answered row by row; null ids and urls are kept.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_block

TRAIN_PAGES = 2_000
#: Kinds of words and tags that get weights, the commonest first.
KINDS = 1_000
TAG_AT_MOST = -0.05
#: Weights of kinds that no labelled page shows: words of articles, words elsewhere, tags.
UNSEEN = {"in": 1.0, "out": -1.0, "tag": -0.3}

# Elements of HTML by their role on a page.
_RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "select")
_BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
_HOLDS = frozenset(
    "nav footer aside header form article main div section ul ol table figure button label dialog".split()
)
_NEVER = frozenset("nav footer aside form button label dialog menu".split())
_MAIN = frozenset(("article", "main"))
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs pager pagination sidebar widget footer masthead cookie cookies consent gdpr notice "
    "alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related "
    "recommended comment comments reply replies discussion disqus respond".split()
)
#: Parts that say nothing beside one of these.
_NEUTRAL = frozenset(
    "area bar block body bottom box button buttons container content footer form group header holder inner item items "
    "left link links list main middle module outer panel right row section slot text title top unit wrap wrapper".split()
)

# Nothing here is tried twice over the same text: names and attributes give nothing back once read.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>\"']*+)")
_REST = re.compile(r"(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>")
_SPECIAL = re.compile(r"[<>\"']")
_ENDS = {name: re.compile(rf"</{name}\b", re.I) for name in _RAW}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]{2,}")


def _unwanted(rest: str) -> bool:
    """Whether the names in class, id and role say that an element is no article text."""
    return any(_dismisses(name) for found in _NAMED.findall(rest) for name in "".join(found).lower().split())


@lru_cache(maxsize=1 << 16)
def _dismisses(name: str) -> bool:
    parts = set(_PART.findall(name))
    return not _NAMES.isdisjoint(parts) and parts <= _NAMES | _NEUTRAL


class _Closing:
    """Whether a tag whose attributes begin at a place is ever closed by a > outside quotes.

    Worked out from the page's end, once, and only for a page on which some tag is not.
    """

    def __init__(self, page: str):
        self.places: list[int] = []
        self.closed: list[bool] = []
        plain = double = single = False  # outside quotes, and in either kind
        for m in reversed([(m.start(), m[0]) for m in _SPECIAL.finditer(page)]):
            place, c = m
            plain, double, single = (
                c == ">" or (double if c == '"' else single if c == "'" else plain),
                plain if c == '"' else double,
                plain if c == "'" else single,
            )
            self.places.append(-place)
            self.closed.append(plain)

    def __call__(self, at: int) -> bool:
        i = bisect.bisect_right(self.places, -at) - 1
        return i >= 0 and self.closed[i]


def _markup(page: str) -> Iterator[tuple[str | None, bool, str]]:
    """Texts (no name) and tags with their attributes in order, in time linear in the page; without comments,
    declarations and the insides of raw elements."""
    at, closes = 0, None
    last = page.rfind(">")
    while at < len(page):
        here = page.find("<", at)
        if here < 0:
            here = len(page)
        if here > at:
            yield None, False, page[at:here]
            at = here
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        rest = None
        for tag in (_TAG, _PLAIN_TAG) if at < last else ():
            start = tag.match(page, at)
            if start and (closes is None or closes(start.end())):
                rest = _REST.match(page, start.end())
                if rest:
                    break
                closes = closes or _Closing(page)
        if rest:
            at = rest.end()
            name, closing, told = start[2].lower(), bool(start[1]), rest[0][:-1]
            if name in _ENDS and not closing and not told.endswith("/"):
                end = _ENDS[name].search(page, at)
                end = page.find(">", end.end()) if end else -1
                at = end + 1 if end >= 0 else len(page)
                continue
            yield name, closing, told
        elif at < last and page[at + 1] in "!?/":
            at = page.find(">", at) + 1
        else:
            yield None, False, "<"
            at += 1


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """Tags and texts in order: (kind, text, inside the named article, to be left out)."""
    # Elements that hold others: name, left out (1 by the element, 2 by a name, 0 not), article.
    open_: list[tuple[str, int, bool]] = []
    left_out = article = links = 0
    held: Counter[str] = Counter()  # their names
    first = True
    block = ""
    for name, closing, rest in _markup(page):
        if name is None:
            where = "out" if left_out else "link" if links else block or "body"
            yield f"word@{where}", rest, bool(article), left_out > 0
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "body" or name == "head":
            block = name
        elif name in _BLOCK:
            links = 0
            block = "" if closing else name
        if name in _HOLDS:
            if not closing:
                if name in _NEVER or (name == "header" and not article):
                    drop = 1
                elif name in _MAIN and not article:
                    drop = 0
                else:
                    drop = 2 * _unwanted(rest)
                if name in _MAIN and first:
                    first = False
                    left_out -= sum(x[1] == 2 for x in open_)
                    open_ = [(n, 0 if d == 2 else d, m) for n, d, m in open_]
                open_.append((name, drop, name in _MAIN))
                held[name] += 1
                left_out += drop > 0
                article += name in _MAIN
            elif held[name]:
                while True:
                    last, drop, main = open_.pop()
                    held[last] -= 1
                    left_out -= drop > 0
                    article -= main
                    if last == name:
                        break
        yield f"{'/' if closing else ''}{name}", "", bool(article), left_out > 0


class Weights:
    """The weight of each kind of word and tag."""

    def __init__(self, inside: Counter | None = None, outside: Counter | None = None):
        self.known: dict[str, float] = {}
        inside, outside = inside or Counter(), outside or Counter()
        for words in (True, False):
            kinds = [k for k in {*inside, *outside} if k.startswith("word@") == words]
            ins, outs = (sum(c[k] for k in kinds) for c in (inside, outside))
            if not ins or not outs:
                continue
            for k in kinds:
                ratio = np.log((inside[k] + 1) / (ins + len(kinds))) - np.log((outside[k] + 1) / (outs + len(kinds)))
                self.known[k] = float(ratio) if words else min(float(ratio), TAG_AT_MOST)

    def __call__(self, kind: str) -> float:
        if kind in self.known:
            return self.known[kind]
        if not kind.startswith("word@"):
            return UNSEEN["tag"]
        return UNSEEN["out" if kind in ("word@out", "word@link", "word@head") else "in"]


def counted(page: str) -> tuple[Counter, Counter]:
    """Kinds of tokens inside and outside the article that a page's markup names."""
    inside, outside = Counter(), Counter()
    for kind, text, article, left_out in tokens(page):
        n = len(text.split()) if kind.startswith("word@") else 1
        if n:
            (inside if article and not left_out else outside)[kind] += n
    return inside, outside


def main_text(page: str, weights: Weights) -> str:
    """The text of the highest-scoring region."""
    found = list(tokens(page))
    best = total = 0.0
    start = region = 0
    end = 0
    for i, (kind, text, _, left_out) in enumerate(found):
        if left_out:
            continue
        total += weights(kind) * (len(text.split()) if kind.startswith("word@") else 1)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, region, end = total, start, i + 1
    blocks, parts = [], []
    for kind, text, _, left_out in found[region:end]:
        name = kind.lstrip("/")
        if kind.startswith("word@"):
            if not left_out:
                parts.append(text)
        elif name == "br":
            parts.append(" ")
        elif name in _BLOCK:
            blocks.append("".join(parts))
            parts = []
    blocks.append("".join(parts))
    settled = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in settled if b)


def train(pages: DataFrame, key: str = "page_id", page: str = "html", size: int = TRAIN_PAGES) -> Weights:
    """Weights from up to ``size`` pages whose markup names an article, in the order of their hash."""
    named = pages.select(F.col(key).alias("key"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"))
    keys = (
        named.filter(F.col("html").rlike("(?i)<(article|main)[ >]"))
        .select("key")
        .distinct()
        .orderBy(F.xxhash64("key"), "key")
        .limit(size)
    )
    sample = named.join(F.broadcast(keys), "key", "left_semi").select("html")  # ``size`` keys

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        both = Counter()
        for text in block.column("html").to_pylist():
            for side, counts in zip((True, False), counted(text), strict=True):
                both.update({(side, k): n for k, n in counts.items()})
        sides, kinds = zip(*both, strict=True) if both else ((), ())
        columns = [pa.array(sides, pa.bool_()), pa.array(kinds, pa.string()), pa.array(list(both.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["inside", "kind", "n"])

    counts = sample.mapInArrow(by_block(work, "html"), "inside boolean, kind string, n long")
    sides = {True: Counter(), False: Counter()}
    commonest = counts.groupBy("inside", "kind").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "kind", "inside")
    for row in commonest.limit(KINDS).collect():
        sides[row["inside"]][row["kind"]] = row["n"]
    return Weights(sides[True], sides[False])


def extracted(
    pages: DataFrame, weights: Weights, key: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p, weights) for p in block.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                block.column("page_id"),
                block.column("url"),
                pa.array(texts, pa.string()),
                pa.array(list(map(len, texts)), pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )

    kept = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"),
    )
    return kept.mapInArrow(by_block(work, "html"), "page_id long, url string, text string, n_chars long")
