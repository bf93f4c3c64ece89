"""Main text of web pages: a linear-chain CRF over the leaf blocks of the document tree."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake.llm.html_pages import labelled_pages

#: The bound of the training set: so many labelled pages, and steps over all of them.
TRAINING_PAGES = 800
STEPS = 120
SEED = 29
#: Paths of elements whose weights a worker remembers.
REMEMBERED = 50_000

#: Fixed: elements that never hold others.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Fixed: elements whose content is no text of the page.
RAW = frozenset(
    "script style title textarea template noscript iframe svg math object select xmp".split()
)
#: Fixed: elements that end the block before them and start one.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Fixed: any heading's end tag ends an open heading.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Fixed: a start tag closes an open element of its row, up to the nearest of its scope.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_START = re.compile(
    r"""<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)""", re.DOTALL
)
_ATTRIBUTES = re.compile(r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+(?:>|\Z)""")
_STOPS = re.compile(r"""[>"']""")
_NAMED = re.compile(
    r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE
)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORDS = re.compile(r"\w+")


@dataclass
class Block:
    """Text between block boundaries, the path of elements around it, and its share in links."""

    path: tuple[tuple[str, str], ...]
    text: str
    linked: float


class _Tags:
    """Tags, comments and declarations of a page, in time that grows with its length alone.

    A tag ends at the first ``>`` outside quotes, or with the page; one whose quotes do not close
    is text. Where a quote opens decides the rest, so that is remembered by quote once a page has
    such a tag.
    """

    def __init__(self, page: str):
        self.page = page
        self.stops: list[int] | None = None
        self.ends: dict[int, int | None] = {}

    def search(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, slash, name and attributes of the next one; no name but of tags."""
        while found := _START.search(self.page, at):
            if not found[2]:
                return found.start(), found.end(), "", "", ""
            name = found[2]
            # A name that holds quotes may also end before one of them.
            cuts = [len(name), *[i for i in range(len(name) - 1, 0, -1) if name[i] in "'\""]]
            for cut in cuts:
                begin = found.start(2) + cut
                end = self._end(begin)
                if end is not None:
                    return found.start(), end, found[1], name[:cut], self.page[begin:end]
            at = found.start() + 1
        return None

    def _end(self, at: int) -> int | None:
        if self.stops is None:
            found = _ATTRIBUTES.match(self.page, at)
            if found:
                return found.end()
            self.stops = [m.start() for m in _STOPS.finditer(self.page)]
        page, opened, end = self.page, [], None
        while True:
            n = bisect_left(self.stops, at)
            if n == len(self.stops):
                end = len(page)
                break
            stop = self.stops[n]
            if page[stop] == ">":
                end = stop + 1
                break
            if stop in self.ends:
                end = self.ends[stop]
                break
            opened.append(stop)
            closed = page.find(page[stop], stop + 1)
            if closed < 0:
                break
            at = closed + 1
        self.ends.update(dict.fromkeys(opened, end))
        return end


def _ends_raw(name: str, page: str, at: int) -> tuple[int, int]:
    """Start and end of the end tag of a raw element from ``at`` on; the page's end if none."""
    end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
    return end.span() if end else (len(page), len(page))


def leaf_blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a whole page in page order; null and empty pages have none.

    Tags may be unclosed or misplaced: an end tag without a start only ends the block, a
    paragraph ends where the next block starts, and lists, rows and cells end their like.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked, links, at = 0, 0, 0
    page = page or ""

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(Block(tuple(stack), text, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked += len(text)

    def close(names: set[str], scope: set[str]) -> None:
        nonlocal links
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in names:
                links -= sum(name == "a" for name, _ in stack[depth:])
                del stack[depth:]
                return
            if stack[depth][0] in scope:
                return

    tags = _Tags(page)
    while found := tags.search(at):
        start, end, slash, name, attributes = found
        take(page[at:start])
        at = end
        if not name:
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        if slash:
            close(HEADINGS if name in HEADINGS else {name}, set())
            continue
        if name == "br":
            parts.append("\n")
        if name in VOID:
            continue
        if name in RAW:
            at = _ends_raw(name, page, at)[1]
            continue
        if name in BLOCK and name not in ("html", "body"):
            close({"p"}, BLOCK - {"p"})
        if name in CLOSES:
            close(*CLOSES[name])
        named = " ".join(x for m in _NAMED.findall(attributes) for x in m if x) if attributes else ""
        stack.append((name, named))
        links += name == "a"
    take(page[at:])
    flush()
    return blocks


def path_features(path: tuple[tuple[str, str], ...]) -> set[str]:
    """The element of a block, its ancestors, and the words of their classes, ids and roles."""
    out = {f"a:{name}" for name, _ in path if name not in ("html", "body")}
    blocks = [name for name, _ in path if name in BLOCK]
    out.add(f"self:{blocks[-1] if blocks else ''}")
    for _, named in path:
        for one in named.split():
            parts = [p.lower() for p in _NAME_PART.findall(one)]
            out.update(f"c:{p}" for p in parts)
            out.update(f"c:{a}{b}" for a, b in zip(parts, parts[1:]))
    return out


def text_features(block: Block) -> list[str]:
    words = len(_WORDS.findall(block.text))
    link = "none" if not block.linked else "some" if block.linked < 0.5 else "most"
    return [
        f"words:{min(6, int(words).bit_length())}",
        f"link:{link}",
        f"end:{block.text[-1] in '.!?:;…'}",
    ]


@dataclass
class Crf:
    """Two-label chain: weights of features for main text, and scores of label pairs."""

    weights: dict[str, float] = field(default_factory=dict)
    start: tuple[float, float] = (0.0, 0.0)
    pairs: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def decode(self, scores: list[float]) -> list[bool]:
        """The best labelling of a page by Viterbi; ``scores`` speak for main text."""
        if not scores:
            return []
        (oo, om), (mo, mm) = self.pairs
        other, main = self.start[0], self.start[1] + scores[0]
        back = []
        for score in scores[1:]:
            a, b, c, d = other + oo, main + mo, other + om, main + mm
            back.append((b > a, d > c))
            other, main = max(a, b), max(c, d) + score
        label = main > other
        out = [label]
        for from_other, from_main in reversed(back):
            label = from_main if label else from_other
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[bool]]], steps: int = STEPS) -> Crf:
    """Fit a chain on pages of (features per block, label per block) by maximum likelihood.

    Gradients come from forward and backward sums over all pages at once, padded to the longest;
    Adam steps, a small penalty on weights, no randomness.
    """
    names = {f: i for i, f in enumerate(sorted({f for x, _ in pages for b in x for f in b}))}
    longest = max(len(y) for _, y in pages)
    page, slot, feature = [], [], []
    label = np.zeros((len(pages), longest), int)
    live = np.zeros((len(pages), longest), bool)
    for i, (blocks, labels) in enumerate(pages):
        live[i, : len(labels)] = True
        label[i, : len(labels)] = labels
        for j, block in enumerate(blocks):
            for f in block:
                page.append(i)
                slot.append(j)
                feature.append(names[f])
    cell = np.array(page) * longest + np.array(slot)
    feature = np.array(feature)
    params = np.zeros(len(names) + 6)
    first, second = np.zeros_like(params), np.zeros_like(params)
    both = live[:, 1:] & live[:, :-1]
    pair_seen = np.bincount((label[:, :-1] * 2 + label[:, 1:])[both], minlength=4)
    start_seen = np.bincount(label[:, 0], minlength=2)
    for step in range(1, steps + 1):
        weights, start, pair = params[:-6], params[-6:-4], params[-4:].reshape(2, 2)
        score = np.bincount(cell, weights[feature], label.size).reshape(label.shape)
        emit = np.stack([np.zeros_like(score), score], axis=2)
        ahead = np.zeros_like(emit)
        ahead[:, 0] = start + emit[:, 0]
        for j in range(1, longest):
            moved = np.logaddexp(ahead[:, j - 1, :1] + pair[0], ahead[:, j - 1, 1:] + pair[1])
            ahead[:, j] = np.where(both[:, j - 1, None], moved + emit[:, j], ahead[:, j - 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        behind = np.zeros_like(emit)
        expected_pair = np.zeros(4)
        for j in range(longest - 2, -1, -1):
            after = behind[:, j + 1] + emit[:, j + 1]
            joint = ahead[:, j, :, None] + pair + after[:, None, :] - total[:, None, None]
            expected_pair += np.exp(joint)[both[:, j]].sum(axis=0).ravel()
            moved = np.logaddexp(pair[:, 0] + after[:, :1], pair[:, 1] + after[:, 1:])
            behind[:, j] = np.where(both[:, j, None], moved, 0.0)
        chance = np.exp(ahead + behind - total[:, None, None])
        off = np.where(live, label - chance[:, :, 1], 0.0).ravel()
        gradient = np.concatenate(
            (
                np.bincount(feature, off[cell], len(names)),
                start_seen - chance[:, 0].sum(axis=0),
                pair_seen - expected_pair,
            )
        )
        gradient = gradient / len(pages) - 1e-3 * params
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.15 / np.sqrt(second / (1 - 0.99**step) + 1e-12)
        params = params + rate * first / (1 - 0.9**step)
    pair = params[-4:].reshape(2, 2)
    return Crf(
        {name: float(params[i]) for name, i in names.items()},
        tuple(params[-6:-4].tolist()),
        tuple(map(tuple, pair.tolist())),
    )


def features(block: Block) -> list[str]:
    return ["bias", *sorted(path_features(block.path)), *text_features(block)]


def page_examples(count: int, seed: int) -> list[tuple[list[list[str]], list[bool]]]:
    """Labelled pages as blocks: a mark before each fragment says which block is whose."""
    out = []
    for parts in labelled_pages(count, seed):
        page = "".join(body for body, _ in parts)
        blocks = leaf_blocks(page)
        labels = []
        seen = ""
        edges = []
        for body, label in parts:
            seen += body
            edges.append((len(leaf_blocks(seen)), label))
        for i in range(len(blocks)):
            labels.append(bool(next(label for n, label in edges if n > i)))
        if blocks:
            out.append(([features(b) for b in blocks], labels))
    return out


@lru_cache(maxsize=2)
def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Crf:
    """The model, trained once per session on labelled pages of a fixed seed."""
    return train(page_examples(pages, seed))


class Extractor:
    """Main text of pages, with the weights of element paths remembered up to a bound."""

    def __init__(self, model: Crf):
        self.model = model
        self.paths: dict[tuple, float] = {}

    def _path(self, path: tuple[tuple[str, str], ...]) -> float:
        value = self.paths.get(path)
        if value is None:
            if len(self.paths) >= REMEMBERED:
                self.paths.clear()
            weight = self.model.weights.get
            value = sum(weight(f, 0.0) for f in path_features(path)) + weight("bias", 0.0)
            self.paths[path] = value
        return value

    def text(self, page: str | None) -> str:
        """Blocks decoded as main text, joined by an empty line; empty if there are none."""
        blocks = leaf_blocks(page)
        weight = self.model.weights.get
        scores = [
            self._path(b.path) + sum(weight(f, 0.0) for f in text_features(b)) for b in blocks
        ]
        return "\n\n".join(b.text for b, kept in zip(blocks, self.model.decode(scores)) if kept)


def main_text(page: Column, model: Crf) -> Column:
    """Main text of a whole page; never null. Null, empty and text-less pages give ''."""

    @F.arrow_udf("string")
    def extract(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        extractor = Extractor(model)
        for part in parts:
            yield pa.array([extractor.text(x) for x in part.to_pylist()], pa.string())

    return extract(page)
