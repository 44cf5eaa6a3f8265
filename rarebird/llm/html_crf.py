"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A block is the text between two block-level tags; inline tags do not cut it. Each block has features
of its ancestors (tag names, and the words of their classes, ids and roles) and of its text (length,
link share, punctuation, marks of boilerplate); blocks are decoded jointly by Viterbi. The model is
trained on the labelled pages of ``html_pages`` by gradient ascent on the conditional likelihood
(forward-backward, Adagrad) on the driver: the pages are few and fixed.

Scripts, styles, comments, markup and the head are never blocks. Character references are decoded,
white space inside a block becomes one space, ends are trimmed, and blocks are joined by one newline.

Edge cases: null or empty html gives an empty text; unclosed and stray tags are read as a browser
would roughly read them (a new paragraph or item ends the one before; a closing tag without an
opening one is ignored; an unclosed script runs to the end); plain text without markup is one block;
ties of the decoder go to content; repeated rows give equal texts; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: element names of HTML by the way they are read
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: contents that are never text of a page
RAW = frozenset("script style title textarea template iframe select button".split())
ENDS_SAME = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
#: block elements that end an open paragraph
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
header hr main menu nav ol p pre section table ul""".split())
#: elements that an implied end tag never leaves
SCOPE = frozenset("article aside body div footer form header html main nav section table ul ol dl".split())

SECTIONS = frozenset("article aside details dialog fieldset footer form header main menu nav section table".split())
#: elements that start and end blocks; all others, unknown ones included, are read as part of their block
BLOCKS = ENDS_P | SECTIONS | SCOPE | frozenset("""head title li dt dd tr td th thead tbody tfoot caption legend summary center dir
frameset noframes hgroup search option optgroup""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"©|\b(?:copyright|all rights|cookies?|privacy|subscribe|newsletter|sign (?:in|up)|log ?in|adverts?|advertisement|"
                    r"sponsor(?:ed)?|share|tweet|related|read more|comments?|reply|leave a)\b", re.I)
BITS = 18


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, frozenset[str]], ...]  # (tag, name words) of the ancestors, outermost first
    linked: int  # characters inside links


def blocks_of(html: str) -> list[Block]:
    """The leaf blocks of a page, in order, with decoded and normalised text."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    pieces: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, tuple(stack), linked))
            pieces.clear()
        linked = 0

    while True:
        found = _TAG.search(html, at)
        end = found.start() if found else len(html)
        if end > at:
            pieces.append(html[at:end])
            if in_link:
                linked += end - at
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                pieces.append(found[0][9:].removesuffix("]]>"))
            continue
        closing, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if name in RAW and not closing:
            if not attributes.endswith("/"):
                close = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(html, at)
                at = close.end() if close else at if name == "button" else len(html)
            continue
        if name not in BLOCKS:
            if name == "a":
                in_link = not closing
            if name == "br":
                pieces.append(" ")
            continue
        flush()
        in_link = False
        if closing:
            if any(x[0] == name for x in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        ends = ENDS_SAME.get(name, set()) | ({"p"} if name in ENDS_P else set())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ends:
                del stack[k:]
                break
            if stack[k][0] in SCOPE and stack[k][0] not in ends:
                break
        if name not in VOID and not attributes.endswith("/"):
            words: list[str] = []
            if attributes:
                for m in _NAMES.finditer(attributes):
                    words += [w.lower() for w in _TOKEN.findall(m[1] or m[2] or m[3] or "")]
                if _HIDDEN.search(attributes):
                    words.append("hidden")
            stack.append((name, frozenset(words)))
    flush()
    return out


@lru_cache(maxsize=1 << 16)
def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) & ((1 << BITS) - 1)


@lru_cache(maxsize=1 << 12)
def _path_slots(path: tuple[tuple[str, frozenset[str]], ...]) -> tuple[int, ...]:
    f = set()
    for depth, (tag, words) in enumerate(reversed(path)):
        f.add(f"in {tag}")
        f.update(f"named {w}" for w in words)
        if depth == 0:
            f.add(f"leaf {tag}")
            f.update(f"leaf named {w}" for w in words)
        if depth == 1:
            f.add(f"leaf {path[-1][0]} of {tag}")
    # the innermost names and the innermost section say most
    f.update(f"near {w}" for w in next((words for _, words in reversed(path) if words), ()))
    f.update(f"near {tag}" for tag in [next((t for t, _ in reversed(path) if t in SECTIONS), None)] if tag)
    return tuple(map(_slot, f))


def features(block: Block, k: int, n: int) -> list[int]:
    """Hashed features of the k-th of n blocks."""
    text, size = block.text, len(block.text)
    stops = text.count(".") + text.count("!") + text.count("?")
    f = ["bias", f"length {min(size.bit_length(), 10)}", f"linked {min(4, 4 * block.linked // max(size, 1))}",
         f"stops {min(4, stops)}", f"commas {min(3, text.count(','))}", f"ends {text[-1] if text[-1] in '.!?:;|…»' else 'word'}"]
    if size < 400:
        f += {f"mark {m.lower()}" for m in _MARKS.findall(text)}
    if k == 0:
        f.append("first")
    if k == n - 1:
        f.append("last")
    return [*map(_slot, f), *_path_slots(block.path)]


@dataclass
class Crf:
    """Weights of features for content (against boilerplate), and of label pairs (from, to)."""

    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, page: Sequence[Sequence[int]]) -> np.ndarray:
        return np.array([self.weights[f].sum() for f in page])

    def decode(self, page: Sequence[Sequence[int]]) -> list[bool]:
        """Viterbi: the most likely labels of the blocks (true: content)."""
        if not len(page):
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        back: list[tuple[int, int]] = []
        b, c = 0.0, None
        for e in self.emissions(page).tolist():
            if c is None:
                b, c = 0.0, e
                continue
            from_b, from_c = (0, 1), (0, 1)
            to_b = (b + m00, c + m10)
            to_c = (b + m01, c + m11)
            from_b, from_c = int(to_b[1] >= to_b[0]), int(to_c[1] >= to_c[0])
            back.append((from_b, from_c))
            b, c = to_b[from_b], to_c[from_c] + e
        label = int(c >= b)
        out = [bool(label)]
        for step in reversed(back):
            label = step[label]
            out.append(bool(label))
        return out[::-1]


def train(pages: Sequence[tuple[Sequence[Sequence[int]], Sequence[bool]]], epochs: int = 16, rate: float = 0.4,
          l2: float = 1e-4) -> Crf:
    """Maximises the conditional log likelihood of (features, labels) pages, page by page."""
    model = Crf(np.zeros(1 << BITS), np.zeros((2, 2)))
    square, square_moves = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(pages)):
            page, gold = pages[k]
            n = len(page)
            if not n:
                continue
            e = np.zeros((n, 2))
            e[:, 1] = model.emissions(page)
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = e[0]
            for t in range(1, n):
                ahead[t] = e[t] + np.logaddexp(ahead[t - 1, 0] + model.moves[0], ahead[t - 1, 1] + model.moves[1])
            for t in range(n - 2, -1, -1):
                after = e[t + 1] + behind[t + 1]
                behind[t] = np.logaddexp(model.moves[:, 0] + after[0], model.moves[:, 1] + after[1])
            total = np.logaddexp(*ahead[-1])
            y = np.array(gold, int)
            error = y - np.exp(ahead[:, 1] + behind[:, 1] - total)
            pull = np.zeros((2, 2))
            for t in range(1, n):
                both = ahead[t - 1][:, None] + model.moves + (e[t] + behind[t])[None, :] - total
                pull -= np.exp(both)
                pull[y[t - 1], y[t]] += 1
            for t in np.flatnonzero(np.abs(error) > 1e-6):
                slots = page[t]
                g = error[t] - l2 * model.weights[slots]
                square[slots] += g * g
                model.weights[slots] += rate * g / np.sqrt(square[slots])
            square_moves += pull * pull
            model.moves += rate * pull / np.sqrt(square_moves)
    return model


@lru_cache(maxsize=1)
def default_model() -> Crf:
    """The field trained on the labelled pages."""
    from rarebird.llm.html_pages import labelled_pages

    pages = []
    for html, content in labelled_pages():
        blocks = blocks_of(html)
        pages.append(([features(b, k, len(blocks)) for k, b in enumerate(blocks)], [b.text in content for b in blocks]))
    return train(pages)


def main_text(html: str, model: Crf) -> str:
    blocks = blocks_of(html)
    labels = model.decode([features(b, k, len(blocks)) for k, b in enumerate(blocks)])
    return "\n".join(b.text for b, on in zip(blocks, labels, strict=True) if on)


def extract(pages: DataFrame, model: Crf | None = None, html: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text and n_chars (code points) of every row; one narrow stage."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())
    names = [*keep, "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                part = whole.slice(start, 200)
                texts = [main_text(h.as_py() or "", shared.value) for h in part.column("__html")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html).cast("string").alias("__html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
