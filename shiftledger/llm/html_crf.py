"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, with the tags around them.
Tags that were left open are closed the way browsers do it where it matters here. Each block has
features of its ancestors (tag names, words of class, id and role) and of its text (length, links,
punctuation, signs). The field scores the features of each block and the change from block to
block; Viterbi gives the best labelling, and the blocks labelled as main text are joined.

The field is trained on the labelled pages of ``labelled_pages``; no page of a table is learned
from. Scripts, styles, comments and what is never shown are not text. Character references are
decoded, white space in a block becomes one space. A page is read in time that grows with its length,
whatever its tags: quotes without partner, tags without end and deep nesting included. A null or empty page, or one without main text,
gives an empty text; repeated rows are treated alike; nothing is cut off, whatever the length.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .labelled_pages import labelled_pages

BUCKETS = 1 << 14
EPOCHS = 12
RATE = 0.3
PENALTY = 1e-4

_OPENING = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
#: Attributes up to the end of their tag, a quote without its partner, or the end of the page.
_ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
#: Elements whose content is not text, by the end tag that is looked for. Without one, the first
#: four run to the end of the page as in browsers; of the others only the tag is left out.
_RAW = frozenset("script style textarea title".split())
_SKIPPED = {
    tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in [*_RAW, *"template noscript svg select iframe object".split()]
}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-label)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")
_SPACES = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big button cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: What an opening tag closes if it is open, up to the nearest of the tags that follow the bar.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


@dataclass(eq=False, slots=True)
class Node:
    """An open block-level element. All blocks in it share it, so a path is a chain, not a copy."""

    tag: str
    parent: Node | None
    depth: int
    #: feature buckets of its tag and of the words of its attributes that no ancestor has
    fresh: tuple[int, ...]


@dataclass
class Block:
    text: str
    node: Node | None
    #: characters inside links
    linked: int


def _words_of(attributes: str) -> tuple[str, ...]:
    return _short_words(attributes) if len(attributes) < 1000 else _all_words(attributes)


def _all_words(attributes: str) -> tuple[str, ...]:
    words = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value = a or b or c
        if name.lower() == "hidden" or name.lower() == "style" and re.search(r"display\s*:\s*none", value, re.I):
            words.append("hidden!")
        elif name.lower() != "style":
            words += [w.lower() for w in _NAME.findall(value)]
    return tuple(dict.fromkeys(words))


_short_words = lru_cache(maxsize=4096)(_all_words)


@dataclass(slots=True)
class Tag:
    """A tag from ``start`` to ``end``; what is no element (comments, declarations) has no name."""

    start: int
    end: int
    name: str = ""
    closing: bool = False
    attributes: str = ""
    empty: bool = False


class Tags:
    """The tags of a page, each character read a bounded number of times.

    A quote in a tag goes with the next one of its kind; one without partner is a sign like others. A
    tag without an end outside quotes ends at its first ``>``, and from the first such tag on
    quotes are not looked at. A tag without any ``>``, as on a page cut off, takes the rest of it.
    """

    def __init__(self, page: str):
        self.page = page
        self.quotes = True

    def _end(self, at: int) -> int:
        """Where the tag's ``>`` is, -1 if there is none."""
        page, begin = self.page, at
        while self.quotes:
            at = _ATTRIBUTES.match(page, at).end()
            if at == len(page):
                self.quotes = False
            elif page[at] == ">":
                return at
            else:
                at += 1  # each kind of quote lacks its partner once at most
        return page.find(">", begin)

    def next(self, at: int) -> Tag | None:
        """The first tag from ``at`` on."""
        found = _OPENING.search(self.page, at)
        if not found:
            return None
        start, name = found.start(), found.group(3)
        if found.group(1):
            end = self.page.find("-->", found.end())
            return Tag(start, end + 3 if end >= 0 else len(self.page))
        end = self._end(found.end()) if name else self.page.find(">", found.end())
        if end < 0:
            return Tag(start, len(self.page))
        if not name:
            return Tag(start, end + 1)
        empty = self.page[end - 1] == "/" and end > found.end()
        return Tag(start, end + 1, name.lower(), bool(found.group(2)), self.page[found.end() : end - empty], empty)


def _all_features(tag: str, words: tuple[str, ...]) -> tuple[int, ...]:
    return tuple(dict.fromkeys(_bucket(n) for n in [f"in={tag}", *(f"word={w}" for w in words)]))


_element_features = lru_cache(maxsize=4096)(_all_features)


class _Open:
    """The open elements, and where the last one of each tag is."""

    def __init__(self):
        self.tags: list[str] = []
        self.nodes: list[Node | None] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.met: dict[int, int] = {}
        self.owned: list[tuple[int, ...]] = []

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def node(self) -> Node | None:
        return self.nodes[-1] if self.nodes else None

    def open(self, tag: str, words: tuple[str, ...]) -> None:
        parent, own = self.node(), ()
        node = parent
        if tag not in _INLINE:
            own = _element_features(tag, words) if len(words) < 100 else _all_features(tag, words)
            met = self.met
            fresh = tuple([f for f in own if not met.get(f)])
            for f in own:
                met[f] = met.get(f, 0) + 1
            node = Node(tag, parent, parent.depth + 1 if parent else 1, fresh)
            self.blocks.append(len(self.tags))
        self.places.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)
        self.nodes.append(node)
        self.owned.append(own)

    def close(self, upto: int) -> None:
        while len(self.tags) > upto:
            self.places[self.tags.pop()].pop()
            self.nodes.pop()
            for f in self.owned.pop():
                self.met[f] -= 1
        while self.blocks and self.blocks[-1] >= upto:
            self.blocks.pop()

    def end(self, tag: str, block: bool) -> None:
        at = self.last([tag])
        # an inline end tag does not reach beyond its block
        if at >= 0 and (block or not self.blocks or at >= self.blocks[-1]):
            self.close(at)

    def make_room(self, tag: str) -> None:
        """Close what the opening tag of a block closes."""
        if tag in _CLOSES:
            closed, bounds = _CLOSES[tag]
            at = self.last(closed)
            if at > self.last(bounds):
                self.close(at)
        elif self.blocks and self.tags[self.blocks[-1]] == "p":
            self.close(self.blocks[-1])


def leaf_blocks(page: str) -> list[Block]:
    """Blocks of text in page order; blocks of white space only are left out."""
    blocks: list[Block] = []
    tags, open_ = Tags(page), _Open()
    pieces: list[str] = []
    linked = 0
    last = 0
    endless: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = _SPACES.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                blocks.append(Block(text, open_.node(), linked))
            pieces.clear()
        linked = 0

    while last < len(page):
        tag = tags.next(last)
        upto = tag.start if tag else len(page)
        if upto > last:
            pieces.append(page[last:upto])
            if open_.places.get("a"):
                linked += upto - last
        if not tag:
            break
        last = tag.end
        name = tag.name
        if not name:
            continue
        if name in _SKIPPED and not tag.closing:
            if name == "svg" and tag.empty or name in endless:
                continue
            end = _SKIPPED[name].search(page, last)
            close = page.find(">", end.end()) if end else -1
            if close >= 0:
                last = close + 1
            elif name in _RAW:
                last = len(page)
            else:
                endless.add(name)
            continue
        if name == "br":
            pieces.append(" ")
            continue
        block = name not in _INLINE and name != "img" and name != "input"
        if block:
            flush()
        if tag.closing:
            open_.end(name, block)
        elif name not in _VOID and not tag.empty:
            if block:
                open_.make_room(name)
            open_.open(name, _words_of(tag.attributes))
    flush()
    return blocks


@lru_cache(maxsize=200_000)
def _bucket(name: str) -> int:
    return zlib.crc32(name.encode()) % BUCKETS


@lru_cache(maxsize=4096)
def _leaf_features(tag: str, up: str, depth: int) -> tuple[int, ...]:
    """Features of the end of a path."""
    names = [f"leaf={tag}", f"depth={depth}"]
    if up:
        names.append(f"up={up}>{tag}")
    return tuple(map(_bucket, names))


def _leaf_of(node: Node | None) -> tuple[int, ...]:
    if not node:
        return _leaf_features("none", "", 0)
    return _leaf_features(node.tag, node.parent.tag if node.parent else "", min(node.depth, 8))


def _path_features(node: Node | None) -> list[int]:
    """Features of all elements around a block."""
    found = []
    while node:
        found += node.fresh
        node = node.parent
    return found


def _grade(n: float, *steps: float) -> int:
    return sum(n >= s for s in steps)


def _text_features(block: Block) -> tuple[int, ...]:
    text = block.text
    n = len(text)
    words = text.count(" ") + 1
    stops = sum(text.count(c) for c in ".!?")
    names = [
        f"chars={_grade(n, 10, 25, 60, 120, 250, 600)}",
        f"words={_grade(words, 2, 4, 8, 16, 40)}",
        f"links={_grade(block.linked / n, 0.01, 0.3, 0.7, 0.95)}",
        f"stops={_grade(stops, 1, 2, 4, 8)}",
        f"end={text[-1] if text[-1] in '.!?:,;|»…' else 'other'}",
    ]
    if "©" in text:
        names.append("sign=copyright")
    if "|" in text or "·" in text or "»" in text:
        names.append("sign=divider")
    if words <= 3 and not stops:
        names.append("bare")
    return tuple(_bucket(n) for n in names)


def own_features(blocks: list[Block]) -> list[tuple[int, ...]]:
    """Features of each block but those of its path: its text, its leaf, and the leaves beside it."""
    leaves = ["start", *[b.node.tag if b.node else "none" for b in blocks], "end"]
    out = []
    for i, block in enumerate(blocks):
        near = (_bucket(f"before={leaves[i]}"), _bucket(f"after={leaves[i + 2]}"))
        out.append((*_leaf_of(block.node), *_text_features(block), *near))
    return out


def features_of(blocks: list[Block]) -> list[tuple[int, ...]]:
    """All feature buckets of each block."""
    return [(*own, *_path_features(b.node)) for own, b in zip(own_features(blocks), blocks)]


@dataclass
class Field:
    """Weights by feature for 'main' against 'other', and scores of changes ``[from, to]``."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def unary(self, rows: list[tuple[int, ...]]) -> np.ndarray:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((f for r in rows for f in r), np.int64, int(sizes.sum()))
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes)

    def scores(self, blocks: list[Block]) -> np.ndarray:
        """The same as ``unary(features_of(blocks))``, with each element of the page added up once."""
        summed: dict[Node | None, float] = {None: 0.0}
        paths = np.zeros(len(blocks))
        for i, block in enumerate(blocks):
            chain, node = [], block.node
            while node not in summed:
                chain.append(node)
                node = node.parent
            for node in reversed(chain):
                summed[node] = summed[node.parent] + float(sum(self.weights[f] for f in node.fresh))
            paths[i] = summed[block.node]
        return paths + self.unary(own_features(blocks))

    def decode(self, unary: np.ndarray) -> list[int]:
        """The best labels by Viterbi."""
        (oo, om), (mo, mm) = self.moves.tolist()
        other, main = self.start.tolist()
        values = unary.tolist()
        main += values[0]
        back = []
        for value in values[1:]:
            a, b = other + oo, main + mo
            c, d = other + om, main + mm
            back.append((b > a, d > c))
            other = b if b > a else a
            main = (d if d > c else c) + value
        label = int(main > other)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]

    def marginals(self, unary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of 'main' for each block, and the expected number of each change."""
        n = len(unary)
        score = np.stack((np.zeros(n), unary), axis=1)
        forward, backward = np.empty((n, 2)), np.zeros((n, 2))
        forward[0] = self.start + score[0]
        for i in range(1, n):
            forward[i] = np.logaddexp(*(forward[i - 1][:, None] + self.moves)) + score[i]
        for i in range(n - 2, -1, -1):
            backward[i] = np.logaddexp(*(self.moves + score[i + 1] + backward[i + 1]).T)
        total = np.logaddexp(*forward[-1])
        pairs = np.zeros((2, 2))
        for i in range(1, n):
            pairs += np.exp(forward[i - 1][:, None] + self.moves + score[i] + backward[i] - total)
        return np.exp(forward[:, 1] + backward[:, 1] - total), pairs


def train(pages: list[tuple[str, list[int]]], epochs: int = EPOCHS, seed: int = 5) -> Field:
    """A field from pages and the labels of their blocks, by stochastic gradient ascent."""
    field = Field(np.zeros(BUCKETS), np.zeros((2, 2)), np.zeros(2))
    squares = {"w": np.full(BUCKETS, 1e-2), "m": np.full((2, 2), 1e-2), "s": np.full(2, 1e-2)}
    examples = []
    for page, labels in pages:
        rows = features_of(leaf_blocks(page))
        if len(rows) != len(labels):
            raise ValueError("a labelled page needs one label per block")
        if rows:
            examples.append((rows, np.array(labels)))
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in draw.permutation(len(examples)):
            rows, labels = examples[i]
            chance, pairs = field.marginals(field.unary(rows))
            sizes = np.array([len(r) for r in rows])
            flat = np.array([f for r in rows for f in r])
            unique, inverse = np.unique(flat, return_inverse=True)
            g = np.bincount(inverse, weights=np.repeat(labels - chance, sizes)) - PENALTY * field.weights[unique]
            squares["w"][unique] += g * g
            field.weights[unique] += RATE * g / np.sqrt(squares["w"][unique])
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            g = seen - pairs - PENALTY * field.moves
            squares["m"] += g * g
            field.moves += RATE * g / np.sqrt(squares["m"])
            g = np.array([1 - labels[0], labels[0]]) - np.array([1 - chance[0], chance[0]])
            squares["s"] += g * g
            field.start += RATE * g / np.sqrt(squares["s"])
    return field


@lru_cache(maxsize=1)
def trained_field() -> Field:
    """The field over all labelled pages; training takes seconds and is the same every time."""
    return train(labelled_pages())


def main_text(page: str, field: Field) -> str:
    blocks = leaf_blocks(page)
    if not blocks:
        return ""
    labels = field.decode(field.scores(blocks))
    return "\n\n".join(b.text for b, label in zip(blocks, labels) if label)


def main_text_column(page: Column, field: Field | None = None) -> Column:
    """Main text of an HTML page."""
    field = field or trained_field()

    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p, field) if p else "" for p in pages.to_pylist()], pa.string())

    return F.arrow_udf(extract, "string")(page)
