"""Main text of web pages: a bidirectional LSTM reads a page's blocks in order and labels each.

A block is a run of text between block-level tags. Its vector holds hashed tag-path parts (tags,
classes and ids of its ancestors), hashed words and a few measures; the recurrent net carries what
stands before and after it, so a block is judged by the whole document. Blocks labelled main are
joined by line ends.

The net is fitted on the driver, in numpy, to ``PAGES`` generated pages of many layouts (see
``layouts``); no given page is learned from. Pages run through it in padded batches inside tasks.

Null html is empty and gives an empty text. Malformed markup never fails: unclosed tags end with
their parent, an unclosed script or comment runs to the end, an unclosed quote ends with its tag.
Pages are read once from left to right, whatever their depth and quotes. Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import layouts
from .common import ship, steps

# Elements that part text, that have no end tag, and whose content is no text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("script style noscript template svg textarea iframe object head title math".split())
RAW_TAGS = frozenset("script style textarea title iframe noscript".split())
#: An open element is ended by the start of one of these.
ENDED_BY = {
    "p": BLOCK_TAGS - {"body", "html"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}, "head": {"body"},
}

TAG = re.compile(r"<(/?)(?:(?<=/)\s*)?([a-zA-Z][\w:-]*)")
QUOTE = re.compile("[>\"']")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
PARTS = re.compile(r"[a-z]+")
WHITE = re.compile(r"[ \t\n\r\f\v  -     　 \u0085]+")

PATH_BUCKETS, WORD_BUCKETS, MEASURES = 256, 64, 8
INPUT = PATH_BUCKETS + WORD_BUCKETS + MEASURES
HIDDEN = 24
PAGES, ROUNDS, BATCH, RATE = 600, 3, 24, 0.02
#: Blocks that one batch of pages holds at most, a longer page alone excepted.
STEP_BLOCKS = 4096


# ---- blocks -------------------------------------------------------------------------------


@dataclass
class Block:
    path: list[int]  # buckets of the names, classes and ids of the ancestors
    text: str
    linked: int  # characters inside links


class Tags:
    """Markup of a page from left to right, in one pass: what was looked for in vain is not looked for again.

    A quote that is never closed is an ordinary sign, so its tag ends at the next ``>``. Where quotes swallow the
    whole rest, they count as ordinary signs from there on. A tag that never ends is text.
    """

    def __init__(self, html: str):
        self.html = html
        self.absent: set[str] = set()
        self.quoting = True

    def find(self, sign: str, at: int) -> int:
        if sign in self.absent:
            return -1
        found = self.html.find(sign, at)
        if found < 0:
            self.absent.add(sign)
        return found

    def close(self, at: int) -> int:
        """Where the tag ends whose name ends at ``at``: the first ``>`` outside quotes."""
        after = at
        while self.quoting and (found := QUOTE.search(self.html, after)) is not None:
            if found.group() == ">":
                return found.start()
            end = self.find(found.group(), found.end())
            after = end + 1 if end >= 0 else found.end()
        self.quoting = False
        return self.find(">", at)

    def __iter__(self) -> Iterator[tuple[int, int, str, str, str]]:
        """``start, end, slash, name, attributes``; comments and declarations have no name."""
        at = self.find("<", 0)
        while at >= 0:
            html, end, slash, name, attributes = self.html, -1, "", "", ""
            if html.startswith("<!--", at):
                end = self.find("-->", at + 4)
                end = len(html) if end < 0 else end + 3
            elif html.startswith(("<!", "<?"), at):
                end = self.find(">", at) + 1
            elif (tag := TAG.match(html, at)) is not None:
                slash, name = tag.groups()
                stop = self.find(">", tag.end()) if slash or ">" in self.absent else self.close(tag.end())
                attributes, end = html[tag.end() : stop], stop + 1
            if end > 0:
                at = (yield at, end, slash, name.lower(), attributes) or end
                at = self.find("<", at)
            else:
                at = self.find("<", at + 1)


class Open:
    """The open elements, with what a block needs to know of them kept as they come and go."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, list[int]]] = []
        self.named: Counter[str] = Counter()
        self.held = [0] * PATH_BUCKETS
        self.blocks: list[int] = []  # places of the block elements

    def push(self, name: str, parts: list[int]) -> None:
        if name in BLOCK_TAGS:
            self.blocks.append(len(self.stack))
        self.stack.append((name, parts))
        self.named[name] += 1
        for bucket in parts:
            self.held[bucket] += 1

    def pop(self) -> str:
        name, parts = self.stack.pop()
        self.named[name] -= 1
        for bucket in parts:
            self.held[bucket] -= 1
        if self.blocks and self.blocks[-1] == len(self.stack):
            self.blocks.pop()
        return name

    def path(self) -> list[int]:
        return [bucket for bucket, n in enumerate(self.held) if n]


def blocks(html: str) -> list[Block]:
    """Text runs of a page in order, with the path buckets of their ancestors."""
    out: list[Block] = []
    opened_now = Open()
    stack = opened_now.stack
    words: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = WHITE.sub(" ", unescape("".join(words))).strip(" ")
        words.clear()
        if text:
            out.append(Block(opened_now.path(), text, linked))
        linked = 0

    def pop() -> None:
        if stack[-1][0] in BLOCK_TAGS:
            flush()
        opened_now.pop()

    def add(text: str) -> None:
        nonlocal linked
        if text and not any(map(opened_now.named.__getitem__, SILENT_TAGS)):
            words.append(text)
            if opened_now.named["a"]:
                linked += len(text)

    tags = Tags(html)
    walk = iter(tags)
    tag = next(walk, None)
    while tag is not None:
        start, end, slash, name, attributes = tag
        add(html[at:start])
        at, skip = end, None
        if slash:
            if opened_now.named[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name == "p":
                flush()
            elif name == "br":
                add(" ")
        elif name:
            while stack and name in ENDED_BY.get(stack[-1][0], ()):
                pop()
            inner = opened_now.blocks[-1] if opened_now.blocks else None
            if inner is not None and name in ENDED_BY.get(stack[inner][0], ()):
                while len(stack) > inner:  # inline elements left open end with their block
                    pop()
            if name in BLOCK_TAGS:
                flush()
            if name in VOID_TAGS:
                add(" ")
            else:
                names = [n for found in NAMES.findall(attributes) for n in PARTS.findall("".join(found).lower())]
                opened_now.push(name, [_path_bucket(n) for n in (name, *("." + n for n in names))])
                if name in RAW_TAGS and not attributes.rstrip().endswith("/"):
                    close = re.compile(rf"</\s*{name}\b", re.IGNORECASE).search(html, at)
                    skip = at = close.start() if close else len(html)
        try:
            tag = walk.send(skip)
        except StopIteration:
            tag = None
    add(html[at:])
    while stack:
        pop()
    flush()
    return out


# ---- vectors ------------------------------------------------------------------------------


@lru_cache(4096)
def _path_bucket(part: str) -> int:
    return zlib.crc32(part.encode("utf-8", "surrogatepass")) % PATH_BUCKETS


def _word_buckets(words: set[str]) -> set[int]:
    return {zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS + PATH_BUCKETS for w in words}


def vectors(page: list[Block]) -> np.ndarray:
    out = np.zeros((len(page), INPUT), np.float32)
    for i, block in enumerate(page):
        row = out[i]
        row[block.path] = 1
        found = block.text.lower().split(" ")
        row[list(_word_buckets(set(found)))] = 1 / 8
        n = len(block.text)
        row[-MEASURES:] = (
            min(1.0, n / 400), min(1.0, len(found) / 60), min(1.0, block.linked / max(1, n)),
            sum(map(block.text.count, ".,;:!?")) / n, block.text[-1] in ".!?:", i / len(page),
            1 - i / len(page), 1,
        )
    return out


# ---- the net ------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gates(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    h = HIDDEN
    return _sigmoid(raw[:, :h]), _sigmoid(raw[:, h : 2 * h] + 1), _sigmoid(raw[:, 2 * h : 3 * h]), np.tanh(raw[:, 3 * h :])


def _forward(x: np.ndarray, present: np.ndarray, w: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, list]:
    """One direction over [time, page, input]; absent steps carry the state on."""
    drawn = x @ w.astype(np.float32)
    hidden, cell, kept = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN)), []
    out = np.empty((*x.shape[:2], HIDDEN))
    for t in range(len(x)):
        i, f, o, g = _gates(drawn[t] + hidden @ u)
        here = present[t][:, None]
        fresh = f * cell + i * g
        squashed = np.tanh(fresh)
        kept.append((i, f, o, g, cell, squashed, hidden))
        cell = np.where(here, fresh, cell)
        hidden = np.where(here, o * squashed, hidden)
        out[t] = hidden
    return out, kept


def _backward(x, present, u, kept, d_out):
    """Gradients of one direction's weights."""
    d_w_in, d_u = np.zeros((*x.shape[:2], 4 * HIDDEN)), np.zeros_like(u)
    d_h, d_c = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, before, squashed, hidden = kept[t]
        here = present[t][:, None]
        d_h = d_h + d_out[t]
        d_fresh = np.where(here, d_c + d_h * o * (1 - squashed**2), 0)
        d_raw = np.concatenate(
            [d_fresh * g * i * (1 - i), d_fresh * before * f * (1 - f),
             np.where(here, d_h * squashed, 0) * o * (1 - o), d_fresh * i * (1 - g**2)], axis=1
        )
        d_w_in[t] = d_raw
        d_u += hidden.T @ d_raw
        d_h = d_raw @ u.T + np.where(here, 0, d_h)
        d_c = np.where(here, d_fresh * f, d_c)
    return np.einsum("tpi,tpg->ig", x, d_w_in, optimize=True), d_u


@dataclass
class Net:
    """Weights of both directions and of the label."""

    parts: list[np.ndarray]  # w, u forward; w, u backward; label weights and bias

    @staticmethod
    def fresh(random: np.random.Generator) -> Net:
        def some(*shape: int) -> np.ndarray:
            return random.normal(0, 1 / np.sqrt(shape[0]), shape)

        return Net([
            some(INPUT, 4 * HIDDEN), some(HIDDEN, 4 * HIDDEN), some(INPUT, 4 * HIDDEN), some(HIDDEN, 4 * HIDDEN),
            some(2 * HIDDEN, 1)[:, 0], np.zeros(1),
        ])

    def run(self, pages: list[np.ndarray]):
        """Probability of being main for every block, as [time, page], and what training needs."""
        longest = max(map(len, pages))
        x = np.zeros((longest, len(pages), INPUT), np.float32)
        present = np.zeros((longest, len(pages)), bool)
        for k, page in enumerate(pages):
            x[: len(page), k], present[: len(page), k] = page, True
        w1, u1, w2, u2, v, b = self.parts
        ahead, kept1 = _forward(x, present, w1, u1)
        back, kept2 = _forward(x[::-1], present[::-1], w2, u2)
        both = np.concatenate([ahead, back[::-1]], axis=2)
        return _sigmoid(both @ v + b), (x, present, both, kept1, kept2)

    def gradients(self, pages: list[np.ndarray], truth: list[np.ndarray]) -> list[np.ndarray]:
        probability, (x, present, both, kept1, kept2) = self.run(pages)
        wrong = np.zeros_like(probability)
        for k, own in enumerate(truth):
            wrong[: len(own), k] = probability[: len(own), k] - own
        wrong /= present.sum()
        _, u1, _, u2, v, _ = self.parts
        d_both = wrong[:, :, None] * v
        first = _backward(x, present, u1, kept1, d_both[:, :, :HIDDEN])
        second = _backward(x[::-1], present[::-1], u2, kept2, d_both[::-1, :, HIDDEN:])
        return [*first, *second, np.einsum("tp,tph->h", wrong, both), wrong.sum(keepdims=True)[0]]

    def main(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Which blocks of each page are main text. Pages of like length share a batch."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= STEP_BLOCKS:
                end += 1
            found, _ = self.run([pages[i] for i in order[at:end]])
            for k, i in enumerate(order[at:end]):
                out[i] = found[: len(pages[i]), k] > 0.5
            at = end
        return out


def fit(n_pages: int = PAGES, seed: int = 11) -> Net:
    """Adam on generated pages; the labels come from the generator, by the marks in its text."""
    random = np.random.default_rng(seed)
    pages, truth = [], []
    for _ in range(n_pages):
        found = blocks(layouts.page(random))
        if found:
            truth.append(np.array([layouts.MARK in b.text for b in found], float))
            for b in found:
                b.text = b.text.replace(layouts.MARK, "").strip() or "."
            pages.append(vectors(found))
    net = Net.fresh(random)
    first, second, n = [np.zeros_like(p) for p in net.parts], [np.zeros_like(p) for p in net.parts], 0
    by_size = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    batches = [by_size[k : k + BATCH] for k in range(0, len(by_size), BATCH)]
    for _ in range(ROUNDS):
        for b in random.permutation(len(batches)):
            n += 1
            gradients = net.gradients([pages[i] for i in batches[b]], [truth[i] for i in batches[b]])
            for p, g, m, s in zip(net.parts, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= RATE * (m / (1 - 0.9**n)) / (np.sqrt(s / (1 - 0.999**n)) + 1e-8)
    return net


def main_texts(pages: list[str | None], net: Net) -> list[str]:
    found = [blocks(p or "") for p in pages]
    chosen = net.main([vectors(f) for f in found])
    return ["\n".join(b.text for b, main in zip(f, c, strict=True) if main) for f, c in zip(found, chosen, strict=True)]


def extract(pages: DataFrame, net: Net | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    ship(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(net or fit())  # about 0.5 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "html", 1 << 20):
                texts = main_texts(part.column("html").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                        pa.array(list(map(len, texts)), pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
