"""Pages as sequences of leaf blocks: what a block is, and what describes it.

A block is the text between two block-level tags. Inline tags leave no trace, ``br``
is white space, character references are decoded, white space becomes one space.
Scripts, styles, templates, drawings, text areas, the head's title and comments of the
markup hold no blocks. Unclosed tags end where the next tag of their kind or their
parent's end says so; an unclosed comment or script reaches to the end of the page.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np

PATH, WORDS, FIGURES = 128, 64, 6  # numbers that describe a block's tag path, its words, its form
FADES = 0.85  # weight of an element in the path of its child

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT_TAGS = frozenset("iframe math noembed noframes noscript object script style svg template textarea title xmp".split())
# What an opening tag closes, if it is the innermost open element; every block closes a paragraph.
CLOSES = {
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "td", "th", "tr"},
    "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
}

NAME = re.compile(r"/?[a-zA-Z][^\s/>]*+")
ATTRIBUTES = re.compile(r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+)*+>""")
DESCRIBING = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block(NamedTuple):
    path: np.ndarray  # PATH numbers
    text: str
    linked: float  # the part of its characters that are in links
    mark: str | None  # of the innermost element that has the marking attribute


@lru_cache(maxsize=4096)
def _element(tag: str, attributes: str) -> np.ndarray:
    """The vector of one element: its tag and the words of class, id and role."""
    tokens = {f"<{tag}"}
    for value in DESCRIBING.findall(attributes):
        tokens.update(part.lower() for part in PARTS.findall(value))
    return hashed(sorted(tokens), PATH)


def hashed(tokens: list[str], size: int) -> np.ndarray:
    """Every token at two places of a vector, with a sign each."""
    found = np.zeros(size, np.float32)
    for token in tokens:
        h = zlib.crc32(token.encode("utf-8", "replace"))
        found[h % size] += 1 - 2 * (h >> 31)
        found[(h >> 10) % size] += 1 - 2 * ((h >> 30) & 1)
    return found


def blocks(page: str, marking: str | None = None) -> list[Block]:
    """The page's blocks in order. ``marking`` names an attribute that training pages have."""
    found: list[Block] = []
    open_tags = ["#page"]
    paths = [np.zeros(PATH, np.float32)]
    marks: list[str | None] = [None]
    counts: dict[str, int] = {}
    pieces: list[str] = []
    linked = link_depth = 0  # link_depth: elements open where the link began, 0 outside links
    marked = marking and re.compile(rf'\b{marking}="([^"]*)"')

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            pieces.append(piece)
            if link_depth:
                linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join(html.unescape(raw).split())
            if text:
                found.append(Block(paths[-1], text, linked / len(raw), marks[-1]))
            pieces.clear()
            linked = 0

    def close() -> None:
        nonlocal link_depth
        counts[open_tags.pop()] -= 1
        paths.pop()
        marks.pop()
        if link_depth > len(open_tags):
            link_depth = 0

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        name = NAME.match(page, lt + 1)
        if name is None:
            follows = page[lt + 1 : lt + 2]
            if follows not in ("!", "?", "/"):  # no markup
                add(page[at : lt + 1])
                at = lt + 1
                continue
            add(page[at:lt])
            comment = page.startswith("<!--", lt)
            stop = page.find("-->" if comment else ">", lt + 2)
            at = end if stop < 0 else stop + (3 if comment else 1)
            continue
        add(page[at:lt])
        attributes = ATTRIBUTES.match(page, name.end())
        if attributes is None:  # a quote that never ends
            stop = page.find(">", name.end())
            stop = end if stop < 0 else stop + 1
        else:
            stop = attributes.end()
        given, at = page[name.end() : stop - 1], stop
        tag = name.group().lower()
        if tag in SILENT_TAGS:
            over = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = over.start() if over else end
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if tag == "a":
                link_depth = 0
            elif tag in BLOCK_TAGS:
                flush()
                if counts.get(tag):
                    while open_tags[-1] != tag:
                        close()
                    close()
        elif tag == "br":
            add(" ")
        elif tag == "a":
            link_depth = len(open_tags)
        elif tag in BLOCK_TAGS:
            flush()
            closed = CLOSES.get(tag, {"p"})
            while open_tags[-1] in closed:
                close()
            if tag not in VOID_TAGS:
                mark = marked.search(given) if marked else None
                paths.append(paths[-1] * np.float32(FADES) + _element(tag, given))
                marks.append(mark.group(1) if mark else marks[-1])
                open_tags.append(tag)
                counts[tag] = counts.get(tag, 0) + 1
    flush()
    return found


def features(found: list[Block], sizes_of_pages: list[int], opening: bool = True) -> np.ndarray:
    """One row for each block: hashed tag path, hashed words, figures of its form.

    ``found`` are the blocks of pages put together, ``opening`` says whether they start them.
    """
    made = np.zeros((len(found), PATH + WORDS + FIGURES), np.float32)
    hashes: list[int] = []
    sizes = np.zeros(len(found), np.int64)
    crc = zlib.crc32
    for i, block in enumerate(found):
        words = block.text.lower().encode("utf-8", "replace").split()
        hashes.extend(map(crc, words))
        sizes[i] = len(words)
        text = block.text
        made[i, :PATH] = block.path
        made[i, PATH + WORDS :] = (
            math.log1p(len(words)) / 4, math.log1p(len(text) / len(words)) / 2, block.linked,
            text[-1] in ".!?…:;\"'»”", len(words) < 3, 0,
        )
    first = 0
    for size in sizes_of_pages if opening else ():
        made[first : first + min(size, 3), -1] = 1
        first += size
    h = np.array(hashes, np.int64)
    at = np.repeat(np.arange(len(found)), sizes) * WORDS + h % WORDS
    bags = np.bincount(at, 1.0 - 2.0 * (h >> 31), len(found) * WORDS).reshape(-1, WORDS)
    made[:, PATH : PATH + WORDS] = 2 * bags / np.maximum(np.linalg.norm(bags, axis=1, keepdims=True), 1)
    return made
