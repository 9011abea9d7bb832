"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of a page.

A block is the text between two block-level tags. Its features are the tags and names of
the elements around it, and its links, length and marks. The field is trained on labelled
pages; Viterbi decoding gives the best sequence of labels of a page, and the blocks
labelled as article make its text.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from passagecraft.llm import labelled_pages
from passagecraft.llm.words import slices

TRAINING_PAGES, ROUNDS, RATE, PENALTY = 800, 250, 0.08, 1e-4
# Elements by how they are treated.
RAW = {"script", "style", "title", "textarea"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "nobr",
    # Formulas stand in the text around them.
    "math", "semantics", "annotation", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "merror",
    "mpadded", "mphantom", "mfenced", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts",
    "mtable", "mtr", "mtd",
}
# Start tags that end an open element of the same group.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
ENDS_PARAGRAPH = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "pre", "section", "table", "ul",
}
OPENS = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
QUOTED_END = re.compile(r"(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>")
# Tags of a page whose quotes never close; from then on a tag of the page ends at the first ``>``.
MOST_UNQUOTED = 8
# Elements nested deeper give their blocks nothing of their own.
DEEPEST = 512
NAMED = re.compile(r"(?:\s|^)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
RAW_ENDS = {tag: re.compile(f"</{tag}", re.I) for tag in RAW}
PIECE = re.compile(r"[a-z]+|[0-9]+")
KINDS = {piece: kind for kind, names in labelled_pages.NAMES.items() for name in names for piece in name.split("-") if piece not in ("page", "site", "main", "list", "more", "box", "body", "reader", "slot", "entry")}
# Words that make a name of several tell a state and not a part of the page: ``has-sidebar``, ``comments-open``.
STATES = {"has", "no", "not", "with", "without", "is", "open", "opened", "closed", "enabled", "disabled", "visible", "and"}
# An article or main element with so much of the page's text is no part named after its classes.
MAIN_SHARE = 0.3
LENGTHS = (1, 2, 5, 10, 25, 60)

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(labelled_pages)


def _own_features(tag: str, attributes: str, named: bool) -> frozenset:
    """Features that an element gives to all blocks inside; those of its class and id only if ``named``."""
    out = {f"t:{tag}"} | ({"hidden"} if tag == "template" else set())
    for m in NAMED.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            for name in value.split() if named else ():
                pieces = PIECE.findall(name)
                if not STATES.isdisjoint(pieces):
                    out.add(f"n:{name}")
                    continue
                for piece in pieces:
                    out.add(f"n:{piece}")
                    if piece in KINDS or piece.rstrip("s") in KINDS:
                        out.add(f"k:{KINDS.get(piece) or KINDS[piece.rstrip('s')]}")
        elif key == "role":
            out.add(f"r:{value}")
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.add("hidden")
    return frozenset(out)


def markup(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Comments and tags in order: start, end, ``/`` of an end tag, name (empty for comments and declarations), attributes.

    Each character is read a bounded number of times. A ``<`` after which no ``>`` follows
    is text. The receiver may send the place to go on from.
    """
    at, unquoted = 0, 0
    while m := OPENS.search(page, at):
        if m[1]:
            end = page.find("-->", m.end())
            end = len(page) if end < 0 else end + 3
        else:
            shut = QUOTED_END.match(page, m.end()) if m[3] and unquoted < MOST_UNQUOTED else None
            if shut:
                end = shut.end()
            else:
                unquoted += m[3] is not None
                end = page.find(">", m.end()) + 1
                if not end:
                    # No tag can end any more, only a comment may still begin.
                    start = page.find("<!--", m.start() + 1)
                    if start < 0:
                        return
                    at = start
                    continue
        at = (yield m.start(), end, m[2] or "", m[3] or "", page[m.end() : end - 1] if m[3] else "") or end


class Blocks:
    """Reads pages into leaf blocks. What elements give to their blocks is remembered from page to page."""

    MOST_REMEMBERED = 50_000

    def __init__(self):
        self.own, self.joined = {}, {}

    def _own(self, tag: str, attributes: str, named: bool) -> frozenset:
        own = self.own.get((tag, attributes, named))
        if own is None:
            if len(self.own) > self.MOST_REMEMBERED:
                self.own, self.joined = {}, {}
            own = self.own[tag, attributes, named] = _own_features(tag, attributes, named)
        return own

    def of(self, page: str) -> list[tuple[str, frozenset, str, float]]:
        """Text, features from around, innermost tag and share of linked characters of each block.

        Of the outermost ``article`` and ``main`` elements the one with the most text, if it
        holds ``MAIN_SHARE`` of the page's, gives its blocks no features of its class and id,
        which tell its topic or state there; but for those of reader comments.
        """
        blocks, held, comments = self._read(page, -1)
        most = max(held, key=held.get, default=-1)
        if most >= 0 and most not in comments and held[most] >= MAIN_SHARE * sum(len(b[0]) for b in blocks):
            blocks = self._read(page, most)[0]
        return blocks

    def _read(self, page: str, unnamed: int) -> tuple[list, dict[int, int], set[int]]:
        """Blocks, the text in each outermost article or main element with names, and which of these hold comments."""
        out, text, linked, size, links = [], [], 0, 0, 0
        # Tag, features around and, of outermost article and main elements, the number; -1 for others.
        stack, open_tags = [("html", frozenset(), -1)], {}
        main, n_main, held, comments = -1, 0, {}, set()
        at, tags = 0, markup(page)

        def flush():
            nonlocal text, linked, size
            if text:
                whole = " ".join(html.unescape("".join(text)).split())
                if whole:
                    tag, around, _ = stack[-1]
                    out.append((whole, around, tag, linked / max(size, 1)))
                    if main in held:
                        held[main] += len(whole)
            text, linked, size = [], 0, 0

        def close():
            nonlocal main
            tag, _, number = stack.pop()
            open_tags[tag] -= 1
            main = -1 if number >= 0 else main

        found = next(tags, None)
        while True:
            stop = found[0] if found else len(page)
            if stop > at:
                piece = page[at:stop]
                text.append(piece)
                size += len(piece)
                linked += len(piece) if links else 0
            if not found:
                break
            _, at, closing, name, attributes = found
            tag = name.lower()
            if tag in RAW and not closing:
                shut = RAW_ENDS[tag].search(page, at)
                at = shut.start() if shut else len(page)
                try:
                    found = tags.send(at)
                except StopIteration:
                    found = None
                continue
            found = next(tags, None)
            if not tag or tag in RAW:
                continue
            if tag in INLINE:
                if tag == "a":
                    links = 0 if closing else 1
                continue
            if tag == "br":
                text.append(" ")
                continue
            flush()
            if closing:
                if open_tags.get(tag):
                    while stack[-1][0] != tag:
                        close()
                    close()
                links = 0 if tag in ENDS_PARAGRAPH else links
                continue
            ends = CLOSES.get(tag) or ({"p"} if tag in ENDS_PARAGRAPH else ())
            while len(stack) > 1 and stack[-1][0] in ends:
                close()
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                around, number = stack[-1][1], -1
                if len(stack) <= DEEPEST:
                    named = tag not in ("html", "body")
                    if tag in ("article", "main") and main < 0:
                        main = number = n_main
                        n_main += 1
                        named = number != unnamed
                    own = self._own(tag, attributes, named)
                    if number >= 0 and any(f[:2] == "n:" for f in own):
                        held[number] = 0
                        if "k:comments" in own:
                            comments.add(number)
                    inside = self.joined.get((around, own))
                    if inside is None:
                        inside = self.joined[around, own] = around | own
                    around = inside
                stack.append((tag, around, number))
                open_tags[tag] = open_tags.get(tag, 0) + 1
        flush()
        return out, held, comments


def block_features(text: str, tag: str, linked: float) -> list[str]:
    """Features of a block's own text."""
    n = text.count(" ") + 1
    out = [f"in:{tag}", f"len:{sum(n >= k for k in LENGTHS)}"]
    if linked >= 0.5:
        out.append("linked")
    elif linked > 0.1:
        out.append("part-linked")
    if text[-1] in ".!?…":
        out.append("stop")
    if "©" in text or text[:9].lower() == "copyright":
        out.append("copyright")
    return out


class Field:
    """Weights of a chain with two labels: 0 for the rest of the page, 1 for the article."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray, first: np.ndarray):
        self.weights, self.moves, self.first = weights, moves, first
        self.around: dict[frozenset, float] = {}

    def score(self, text: str, around: frozenset, tag: str, linked: float) -> float:
        """How much label 1 is ahead of label 0 for a block by itself."""
        outer = self.around.get(around)
        if outer is None:
            if len(self.around) > Blocks.MOST_REMEMBERED:
                self.around = {}
            outer = self.around[around] = self.weights["bias"] + sum(self.weights.get(f, 0.0) for f in around)
        return outer + sum(self.weights.get(f, 0.0) for f in block_features(text, tag, linked))

    def decode(self, scores: list[float]) -> list[int]:
        """The best sequence of labels (Viterbi)."""
        (m00, m01), (m10, m11) = self.moves.tolist()
        zero, one, back = float(self.first[0]), float(self.first[1]) + scores[0], []
        for s in scores[1:]:
            to_zero, to_one = zero + m00 < one + m10, zero + m01 < one + m11
            back.append((int(to_zero), int(to_one)))
            zero, one = (one + m10 if to_zero else zero + m00), (one + m11 if to_one else zero + m01) + s
        labels = [int(one > zero)]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


def train(pages: list[str], rounds: int = ROUNDS) -> Field:
    """Maximise the likelihood of the labels of ``pages``; texts of the article start with ``KEEP``."""
    reader, rows = Blocks(), []
    for page in pages:
        blocks = reader.of(page)
        if blocks:
            rows.append([(int(labelled_pages.KEEP in text), ["bias", *around, *block_features(text.replace(labelled_pages.KEEP, ""), tag, linked)])
                         for text, around, tag, linked in blocks])
    names = {f: k for k, f in enumerate(sorted({f for page in rows for _, fs in page for f in fs}))}
    n, longest = len(rows), max(map(len, rows))
    mask, gold = np.zeros((n, longest), bool), np.zeros((n, longest), int)
    index, cell = [], []
    for p, page in enumerate(rows):
        for t, (label, fs) in enumerate(page):
            mask[p, t], gold[p, t] = True, label
            index.extend(names[f] for f in fs)
            cell.extend([p * longest + t] * len(fs))
    index, cell = np.array(index), np.array(cell)
    params = [np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)]
    pairs = mask[:, 1:] & mask[:, :-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
    moments = [(0.0, 0.0)] * 3
    for step in range(1, rounds + 1):
        w, moves, first = params
        scores = np.zeros((n, longest, 2))
        scores[:, :, 1] = np.bincount(cell, w[index], n * longest).reshape(n, longest)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = first + scores[:, 0]
        for t in range(1, longest):
            reach = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None], reach, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            reach = np.logaddexp.reduce(moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(mask[:, t + 1, None], reach, 0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        share = np.exp(ahead + behind - total[:, None, None])
        error = np.where(mask, share[:, :, 1] - gold, 0)
        both = np.exp(ahead[:, :-1, :, None] + moves + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None])
        at_first = np.array([(gold[:, 0] == k).sum() for k in (0, 1)])
        grads = [
            np.bincount(index, error.ravel()[cell], len(names)) / n + PENALTY * w,
            (np.where(pairs[:, :, None, None], both, 0).sum((0, 1)) - seen) / n + PENALTY * moves,
            (share[:, 0].sum(0) - at_first) / n + PENALTY * first,
        ]
        for k, g in enumerate(grads):
            m, v = moments[k]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            moments[k] = m, v
            params[k] = params[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Field({f: float(params[0][k]) for f, k in names.items()}, params[1], params[2])


def main_text(page: str, reader: Blocks, field: Field) -> tuple[str, int, int]:
    """Text of the article, its blocks joined by two line ends; how many blocks the page has and how many are kept."""
    blocks = reader.of(page)
    if not blocks:
        return "", 0, 0
    labels = field.decode([field.score(*b) for b in blocks])
    kept = [b[0] for b, label in zip(blocks, labels) if label]
    return "\n\n".join(kept), len(blocks), len(kept)


def _extracted(batches: Iterator[pa.RecordBatch], field) -> Iterator[pa.RecordBatch]:
    reader, model = Blocks(), field.value
    for batch in slices(batches, "html"):
        rows = [main_text(page, reader, model) for page in batch["html"].to_pylist()]
        texts, blocks, kept = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(blocks, pa.int32()), pa.array(kept, pa.int32())],
            ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_kept``: the article of every page from its whole markup.

    Character references are decoded, white space in a block is one space, blocks are
    trimmed and joined by two line ends. A null or empty html has an empty text. Repeated
    rows and null ids or urls get a row each. Other columns are not looked at. The time for
    a page grows with its length, however broken its markup.
    """
    field = field or train(labelled_pages.pages(TRAINING_PAGES))
    shared = pages.sparkSession.sparkContext.broadcast(field)
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        lambda b: _extracted(b, shared), "page_id long, url string, text string, n_chars long, n_blocks int, n_kept int")
