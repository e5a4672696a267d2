"""Main text of pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi.

It is trained on a bounded sample of labelled pages: those that mark their article with an
``article`` or ``main`` element, where a block is text if it stands within, and not within an element that
says it is something else. So that it also knows pages that mark less or otherwise, each is taught a
second time with the article in a plain ``div`` and blocks of other kinds put around and into it.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedloom.llm.common import modest, slices, strings
from feedloom.llm.page_blocks import Block, Element, Marks, blocks_of, nested

FEATURES = 1 << 14
#: Labelled pages to train on, about, and the longest that is taken for it.
SAMPLE = 300
SAMPLE_BYTES = 1 << 18
#: Elements around a block at most, of a page to train on.
SAMPLE_DEPTH = 256

# What elements and names say about the text within.
ARTICLE_TAGS = ("article", "main")
ARTICLE_NAMES = ("content", "post", "entry", "story", "body", "text", "article", "main")
OTHER_TAGS = ("nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog")
OTHER_NAMES = (
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "comment", "comments", "cookie", "copyright", "disclaimer",
    "footer", "form", "header", "login", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup",
    "promo", "reader", "readers", "related", "replies", "reply", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "toc", "toolbar", "widget",
)
_OTHER = frozenset(OTHER_TAGS) | {"." + name for name in OTHER_NAMES}
_MARKED = r"(?i)<(?:article|main)[\s>]"
_SIGNS = frozenset("©®|•·")


def label(block: Block) -> int:
    """1 if the page itself says that the block is of its article."""
    marks = {m for element in block.around for m in element}
    return int(bool(marks & set(ARTICLE_TAGS)) and not marks & _OTHER)


@lru_cache(1 << 16)
def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def _around(within: Element | None) -> list[int]:
    found, element = [], within
    while element:
        found += _entered(element)
        element = element.above
    return found + _innermost(within)


def _entered(element: Element) -> list[int]:
    return [_feature(f"in:{m}") for m in element.fresh]


def _innermost(within: Element | None) -> list[int]:
    return [_feature(f"at:{m}") for m in dict.fromkeys(within.marks)] if within else []


def _bucket(value: float, edges: tuple) -> int:
    return sum(value >= edge for edge in edges)


def features(block: Block) -> list[int]:
    """Of the text, and of the elements around."""
    return [*_of_text(block), *_around(block.within)]


def _of_text(block: Block) -> list[int]:
    """Length, share of links, how it ends and begins, digits, signs."""
    text, size = block.text, len(block.text)
    names = (
        "bias", f"length:{_bucket(size, (10, 25, 50, 100, 200, 400))}", f"links:{_bucket(block.linked / size, (0.05, 0.3, 0.7, 0.99))}",
        f"ends:{text[-1] in '.!?…:;»”\"'}", f"begins:{text[0].isupper()}",
        f"digits:{_bucket(sum(map(str.isdigit, text)) / size, (0.02, 0.1, 0.3))}",
        f"signs:{not _SIGNS.isdisjoint(text)}", f"commas:{_bucket(text.count(','), (1, 3))}",
    )
    return [*map(_feature, names)]


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis)
    return top + np.log(np.exp(values - np.expand_dims(top, axis)).sum(axis))


class Field:
    """Weights of features for both labels, of a label after another, and of the first."""

    def __init__(self):
        self.of = np.zeros((FEATURES, 2))
        self.step = np.zeros((2, 2))
        self.first = np.zeros(2)

    def emissions(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.of[row].sum(0) for row in rows])

    def marginals(self, rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each label at each block, and of each pair of labels of neighbours (forward-backward)."""
        score = self.emissions(rows)
        count = len(score)
        ahead, back = np.zeros((count, 2)), np.zeros((count, 2))
        ahead[0] = self.first + score[0]
        for t in range(1, count):
            ahead[t] = score[t] + _logsum(ahead[t - 1][:, None] + self.step, 0)
        for t in range(count - 2, -1, -1):
            back[t] = _logsum(self.step + (score[t + 1] + back[t + 1])[None, :], 1)
        whole = _logsum(ahead[-1], 0)
        pairs = ahead[:-1, :, None] + self.step + (score[1:] + back[1:])[:, None, :] - whole
        return np.exp(ahead + back - whole), np.exp(pairs)

    def scores(self, blocks: list[Block]) -> np.ndarray:
        """The emissions of the blocks' features; what elements around weigh is added up once for each element."""
        known: dict[int, np.ndarray] = {}

        def around(within: Element | None) -> np.ndarray | float:
            line, element = [], within
            while element and id(element) not in known:
                line.append(element)
                element = element.above
            total = known[id(element)] if element else np.zeros(2)
            for element in reversed(line):
                if element.fresh:
                    total = total + self.of[_entered(element)].sum(0)
                known[id(element)] = total
            return total

        rows = [_of_text(b) + _innermost(b.within) for b in blocks]
        ends = np.cumsum([len(row) for row in rows])
        own = np.add.reduceat(self.of[np.array(list(chain.from_iterable(rows)), np.int64)], np.concatenate([[0], ends[:-1]])) if rows else 0
        return np.array([around(b.within) for b in blocks]).reshape(-1, 2) + own

    def viterbi(self, rows: list[list[int]]) -> list[int]:
        return self.decode(self.emissions(rows)) if rows else []

    def decode(self, score: np.ndarray) -> list[int]:
        """The likeliest labels; a tie goes to 1, text."""
        if not len(score):
            return []
        (aa, ab), (ba, bb) = self.step.tolist()
        zero, one = (self.first + score[0]).tolist()
        came: list[tuple[int, int]] = []
        for x, y in score[1:].tolist():
            from_zero, from_one = int(one + ba >= zero + aa), int(one + bb >= zero + ab)
            came.append((from_zero, from_one))
            zero, one = x + (one + ba if from_zero else zero + aa), y + (one + bb if from_one else zero + ab)
        best = [int(one >= zero)]
        for step in reversed(came):
            best.append(step[best[-1]])
        return best[::-1]


def fit(chains: list[tuple[list[list[int]], list[int]]], passes: int = 6, rate: float = 0.3, l2: float = 1e-4) -> Field:
    """Raise the likelihood of the labels, page by page, with rates that fall for each weight (AdaGrad)."""
    field = Field()
    spent_of, spent_step, spent_first = np.full((FEATURES, 2), 1e-6), np.full((2, 2), 1e-6), np.full(2, 1e-6)
    order = random.Random(1)
    for _ in range(passes):
        for at in order.sample(range(len(chains)), len(chains)):
            rows, labels = chains[at]
            single, pairs = field.marginals(rows)
            error = -single
            error[np.arange(len(labels)), labels] += 1
            used = np.concatenate([np.array(row) for row in rows])
            places, inverse = np.unique(used, return_inverse=True)
            gradient = np.zeros((len(places), 2))
            np.add.at(gradient, inverse, np.repeat(error, [len(row) for row in rows], 0))
            gradient -= l2 * field.of[places]
            spent_of[places] += gradient ** 2
            field.of[places] += rate * gradient / np.sqrt(spent_of[places])
            step = -pairs.sum(0)
            np.add.at(step, (labels[:-1], labels[1:]), 1)
            spent_step += step ** 2
            field.step += rate * step / np.sqrt(spent_step)
            spent_first += error[0] ** 2
            field.first += rate * error[0] / np.sqrt(spent_first)
    return field


def _renamed(block: Block, marks: Marks) -> Block:
    around = tuple(marks if element[0] in ARTICLE_TAGS else element for element in block.around)
    return Block(block.text, nested(around), block.linked)


def taught_otherwise(blocks: list[Block], labels: list[int], rng: random.Random) -> tuple[list[Block], list[int]]:
    """The page with its article in a plain element, named or not, and with blocks of other kinds, their texts taken from the page."""
    marks = (rng.choice(("div", "div", "section")), *(["." + rng.choice(ARTICLE_NAMES)] if rng.random() < 0.6 else []))
    page = [_renamed(b, marks) for b in blocks]
    labels = list(labels)
    # The elements around the article itself, without what its blocks have of their own.
    inside = next((b.around[:-1] for b, of in zip(page, labels) if of and len(b.around) > 1), (("body",),))
    for _ in range(rng.randint(2, 5)):
        if rng.random() < 0.5:
            element = (rng.choice(OTHER_TAGS),)
        else:
            element = (rng.choice(("div", "section", "ul", "p")), "." + rng.choice(OTHER_NAMES))
        within = rng.random() < 0.5
        inner = rng.choice(((), (("p",),), (("ul",), ("li",)), (("div",),)))
        around = (*(inside if within else (("html",), ("body",))), element, *inner)
        lines = [Block(b.text, nested(around), len(b.text) if rng.random() < 0.3 else 0) for b in rng.sample(blocks, min(len(blocks), rng.randint(1, 3)))]
        article = [n for n, of in enumerate(labels) if of]
        at = rng.randint(article[0], article[-1] + 1) if within and article else rng.choice((0, len(page)))
        page[at:at] = lines
        labels[at:at] = [0] * len(lines)
    return page, labels


def train(pages: DataFrame, html_col: str = "html", *, sample: int = SAMPLE) -> Field:
    """Learn from about ``sample`` labelled pages of all such, chosen by a hash of the text; equal ones count once.

    Without labelled pages the field knows nothing, and every block counts as text.
    """
    rows = pages.select(F.col(html_col).alias("html"), F.xxhash64(html_col, F.lit("page sample")).alias("salt")) \
        .where(F.col("html").rlike(_MARKED) & (F.octet_length("html") <= SAMPLE_BYTES))
    count = rows.select("salt").distinct().count()
    share = min(1.0, sample / max(count, 1))
    chosen = rows.where(F.pmod("salt", F.lit(1 << 40)) < share * (1 << 40)).select("html").distinct().collect()
    chains = []
    for html in sorted(row.html for row in chosen):
        blocks = blocks_of(html)
        if max((b.within.depth for b in blocks if b.within), default=0) > SAMPLE_DEPTH:
            continue
        labels = [label(b) for b in blocks]
        if any(labels):
            rng = random.Random(zlib.crc32(html.encode()))
            for page, told in ((blocks, labels), taught_otherwise(blocks, labels, rng)):
                chains.append(([features(b) for b in page], told))
    return fit(chains)


_PIECES = re.compile(r"[\ud800-\udfff]")


def main_text(html: str, field: Field) -> str:
    blocks = blocks_of(html)
    kept = field.decode(field.scores(blocks))
    # A reference to half a character cannot be written.
    return _PIECES.sub("�", "\n".join(b.text for b, of in zip(blocks, kept) if of))


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of each row: the main text, its blocks joined by a line break; null html: empty.

    Null ids and urls stay null, repeated rows come out each, an empty table gives no rows, and columns other than the three named
    are not read. Elements may be nested to any depth.
    """
    sent = pages.sparkSession.sparkContext.broadcast(field)
    rows = modest(pages).select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 22):
                texts = [main_text(html, sent.value) for html in strings(part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["id", "url", "text", "n_chars"])

    return rows.mapInArrow(read, f"id {rows.schema['id'].dataType.simpleString()}, url string, text string, n_chars long")
