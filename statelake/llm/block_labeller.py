"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf blocks, in order. Each block becomes a vector: hashed
tokens of its tag path (tags, classes and ids of all ancestors), hashed words, and a
few measures. A bidirectional LSTM in numpy reads the page's whole sequence and labels
every block, main text or not. It is trained here, on a bounded sample of pages, against
a structural teacher; copies with anonymous tags and with planted comments, notices and
sidebars make it use words and context besides the tags.

Reading is linear in the page: tags are found without going back, a stray closing tag is
passed over at once, and a block's features are carried down from its parent.

Defined results: null or blank html gives an empty text; an unclosed tag ends with what
contains it, an unclosed script or style with the page; a quote that nothing closes is an
ordinary character; no-break spaces are no white space and stay as they are; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, bounded_sample, small_batches

#: Pages the labeller is trained on (about so many, never over twice), taken by the hash of their html.
SAMPLE = 300
PATH_DIMS, WORD_DIMS, HIDDEN, EPOCHS = 48, 32, 16, 10
OPENS = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
# Elements whose content is no text, and where each ends.
DROPPED = re.compile(r"<(script|style|noscript|template)\b", re.I)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template")}
# The end of a tag, or the quote that begins a value.
STOP = re.compile(r">|=[\x20\x09-\x0D]*([\"'])")
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"[\x20\x09-\x0D]+")
# HTML elements that stand in a line of text, and those without content.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MEASURES = 7

# What the structural teacher goes by.
BODY = frozenset({"article", "main"})
ASIDE = frozenset(
    "nav aside footer header form head title button select textarea ad ads advert advertisement banner menu sidebar comment comments reply respond notice cookie consent promo related share social newsletter subscribe breadcrumb".split())
ANONYMOUS = {"article": "div", "main": "div", "nav": "div", "footer": "div", "header": "div", "aside": "div", "section": "div"}
PLANTED = [
    ("div", "comments", "p"), ("section", "comment", "div"), ("aside", "sidebar", "p"), ("div", "cookie", "notice", "p"), ("form", "newsletter", "label"),
    ("div", "related", "ul", "li"), ("header", "banner", "p"), ("div", "advert", "p"),
]


class Path:
    """An element's place: its tokens (tag, classes, id, role) behind those of its ancestors.

    Children are kept by tokens, and what the features need of all ancestors is carried from
    parent to child, so a block costs the same at any depth.
    """

    __slots__ = ("parent", "tokens", "tail", "aside", "body", "children", "sums")

    def __init__(self, parent: Path | None = None, tokens: tuple[str, ...] = ()):
        self.parent, self.tokens = parent, tokens
        above = parent or self
        self.tail = ((above.tail if parent else ()) + tokens)[-2:]
        self.aside = bool(parent and parent.aside) or not ASIDE.isdisjoint(tokens)
        self.body = bool(parent and parent.body) or not BODY.isdisjoint(tokens)
        self.children: dict[tuple[str, ...], Path] = {}
        self.sums: np.ndarray | None = None

    def child(self, tokens: tuple[str, ...]) -> Path:
        if tokens not in self.children:
            self.children[tokens] = Path(self, tokens)
        return self.children[tokens]

    def vector(self) -> np.ndarray:
        """Half a count of every token, and a whole one of the last two."""
        waiting, node = [], self
        while node.sums is None:
            waiting.append(node)
            if node.parent is None:
                break
            node = node.parent
        for node in reversed(waiting):
            node.sums = np.zeros(PATH_DIMS) if node.parent is None else node.parent.sums.copy()
            for token in node.tokens:
                node.sums[_place(token, PATH_DIMS)] += 0.5
        out = self.sums.copy()
        for token in self.tail:
            out[_place(token, PATH_DIMS)] += 0.5
        return out

    def __iter__(self) -> Iterator[str]:
        nodes, node = [], self
        while node is not None:
            nodes.append(node)
            node = node.parent
        return (token for node in reversed(nodes) for token in node.tokens)


def pieces(page: str) -> Iterator[tuple[str, re.Match | None]]:
    """A page's texts, and its tags with the attributes' text; every character is looked at a bounded number of times.

    A quote begins a value only behind an equals sign. One that nothing closes is an ordinary
    character; where all ends of tags are in quotes, quotes count no more from there on.
    """
    at, size, last_end = 0, len(page), page.rfind(">")
    absent: set[str] = set()
    quoted = True

    def end_of(start: int) -> int:
        nonlocal quoted
        to = start
        while quoted and (m := STOP.search(page, to)):
            if m[1] is None:
                return m.start()
            close = -1 if m[1] in absent else page.find(m[1], m.end())
            if close < 0:
                absent.add(m[1])
            to = max(m.end(), close + 1)
        quoted = False
        return page.find(">", start)

    while at < size:
        if page[at] != "<":
            to = page.find("<", at)
            to = size if to < 0 else to
            yield page[at:to], None
            at = to
        elif page.startswith("<!--", at):
            to = page.find("-->", at + 4)
            at = size if to < 0 else to + 3
        elif dropped := DROPPED.match(page, at):
            end = ENDS[dropped[1].lower()].search(page, dropped.end())
            at = size if end is None else end.end()
        elif at < last_end and (tag := OPENS.match(page, at)):
            to = end_of(tag.end())
            yield page[tag.end():to], tag
            at = to + 1
        elif at < last_end and page[at + 1] in "!?":
            at = page.find(">", at) + 1
        else:
            yield "<", None
            at += 1


def blocks(page: str | None) -> list[tuple[Path, str, int]]:
    """(tag path, text, characters in links) of each leaf block."""
    found: list[tuple[Path, str, int]] = []
    root = Path()
    stack: list[tuple[str, Path]] = [("", root)]
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked = in_link = 0

    def close() -> None:
        nonlocal linked
        joined = SPACE.sub(" ", html.unescape("".join(text))).strip(" ") if text else ""
        if joined:
            found.append((stack[-1][1], joined, linked))
        text.clear()
        linked = 0

    def leave() -> None:
        opened[stack.pop()[0]] -= 1

    for part, m in pieces(page or ""):
        if m is None:
            text.append(part)
            if in_link:
                linked += len(part)
            continue
        tag = m[2].lower()
        if tag == "a":
            in_link = 0 if m[1] else 1
        if tag in INLINE:
            continue
        if tag in VOID:
            if tag == "hr":
                close()
            else:
                text.append(" ")
            continue
        close()
        if m[1]:
            # A closing tag ends everything inside its element; one without an element is passed over.
            if opened[tag]:
                while stack[-1][0] != tag:
                    leave()
                leave()
        else:
            if stack[-1][0] == "p" or stack[-1][0] == tag == "li":
                leave()
            names = [w.lower() for g in NAMED.findall(part) for w in re.split(r"[^a-zA-Z]+", "".join(g)) if w] if part else []
            stack.append((tag, stack[-1][1].child((tag, *names))))
            opened[tag] += 1
    close()
    return found


def teacher(path: Path, text: str, linked: int, has_body: bool) -> int:
    if path.aside:
        return 0
    if has_body:
        return int(path.body)
    return int(len(text.split()) >= 15 and 3 * linked < len(text))


def _place(token: str, dims: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % dims


class Features:
    def __init__(self) -> None:
        self.words = Memo(lambda w: _place(w.lower(), WORD_DIMS), 200_000)

    def __call__(self, leaves: list[tuple[Path, str, int]]) -> np.ndarray:
        n = len(leaves)
        split = [text.split() for _, text, _ in leaves]
        counts = np.array([len(w) for w in split])
        who = np.repeat(np.arange(n), counts)
        ids = np.fromiter((self.words[w] for words in split for w in words), np.int64, int(counts.sum()))
        words = np.bincount(who * WORD_DIMS + ids, minlength=n * WORD_DIMS).reshape(n, WORD_DIMS) / np.maximum(counts, 1)[:, None]
        sizes = np.array([len(text) for _, text, _ in leaves])
        measures = np.stack([
            np.log1p(sizes) / 5, np.minimum(1, np.array([linked for *_, linked in leaves]) / sizes), np.log1p(counts) / 4,
            np.array([text[-1] in ".!?:;\"'" for _, text, _ in leaves], float), np.arange(n) / max(1, n - 1), np.arange(n) == 0, np.arange(n) == n - 1,
        ], 1)
        return np.concatenate([np.array([path.vector() for path, *_ in leaves]), 2 * words, measures], 1)


INPUT = PATH_DIMS + WORD_DIMS + MEASURES


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Network:
    """Bidirectional LSTM with one logistic output for each step; gates in the order input, forget, output, cell."""

    def __init__(self, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.w = {}
        for d in "fb":
            self.w[f"x{d}"] = draw.normal(0, 0.1, (INPUT, 4 * HIDDEN))
            self.w[f"h{d}"] = draw.normal(0, 0.1, (HIDDEN, 4 * HIDDEN))
            self.w[f"b{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.w["o"], self.w["c"] = draw.normal(0, 0.1, 2 * HIDDEN), np.zeros(1)

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray):
        steps, n = mask.shape
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        gates = x @ self.w[f"x{d}"] + self.w[f"b{d}"]
        out, kept = np.zeros((steps, n, HIDDEN)), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates[t] + h @ self.w[f"h{d}"]
            s = sigmoid(z[:, :3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            on = mask[t][:, None]
            c_new = (f * c + i * g) * on
            tc = np.tanh(c_new)
            kept.append((t, h, c, i, f, o, g, tc, on))
            h, c = o * tc * on, c_new
            out[t] = h
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray):
        f, kf = self._run("f", x, mask)
        b, kb = self._run("b", x, mask)
        both = np.concatenate([f, b], 2)
        return sigmoid(both @ self.w["o"] + self.w["c"]), both, kf, kb

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, both, kf, kb = self.forward(x, mask)
        dz = (p - y) * mask / mask.sum()
        grads = {"o": np.einsum("tn,tnh->h", dz, both), "c": np.array([dz.sum()])}
        d_both = dz[:, :, None] * self.w["o"]
        for d, kept, d_out in (("f", kf, d_both[:, :, :HIDDEN]), ("b", kb, d_both[:, :, HIDDEN:])):
            gates = np.zeros((*mask.shape, 4 * HIDDEN))
            gh = np.zeros_like(self.w[f"h{d}"])
            dh, dc = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
            for t, h, c, i, f, o, g, tc, on in reversed(kept):
                dh = (dh + d_out[t]) * on
                dc = (dc + dh * o * (1 - tc * tc)) * on
                dg = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
                gates[t] = dg
                gh += h.T @ dg
                dh, dc = dg @ self.w[f"h{d}"].T, dc * f
            grads[f"x{d}"] = np.einsum("tni,tng->ig", x, gates)
            grads[f"b{d}"], grads[f"h{d}"] = gates.sum((0, 1)), gh
        return grads


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(r) for r in rows)
    x, mask = np.zeros((steps, len(rows), INPUT)), np.zeros((steps, len(rows)))
    for j, r in enumerate(rows):
        x[:len(r), j], mask[:len(r), j] = r, 1
    return x, mask


def train(pages: list[str], epochs: int = EPOCHS) -> Network:
    """Adam over minibatches of pages of similar length, in a fixed order."""
    draw, features = np.random.default_rng(5), Features()
    rows = []
    texts = [text for page in pages for _, text, _ in blocks(page)[-3:]]
    for page in pages:
        leaves = blocks(page)
        if not leaves:
            continue
        has_body = any(path.body for path, *_ in leaves)
        y = [teacher(*leaf, has_body) for leaf in leaves]
        rows.append((features(leaves), np.array(y, float)))
        bare = [(Path(Path(), tuple(ANONYMOUS.get(t, t) for t in path)), *rest) for path, *rest in leaves]
        if draw.random() < 0.3:
            rows.append((features(bare), np.array(y, float)))
        mixed, labels = list(leaves), list(y)
        for _ in range(int(draw.integers(1, 4))):
            at, kind = int(draw.integers(0, len(mixed) + 1)), PLANTED[int(draw.integers(0, len(PLANTED)))]
            base = tuple(mixed[min(at, len(mixed) - 1)][0])[:-1] if draw.random() < 0.5 else ("html", "body")
            for _ in range(int(draw.integers(1, 4))):
                mixed.insert(at, (Path(Path(), (*base, *kind)), texts[int(draw.integers(0, len(texts)))], 0))
                labels.insert(at, 0)
        rows.append((features(mixed), np.array(labels, float)))
    net, rate, step = Network(), 0.01, 0
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    rows.sort(key=lambda r: len(r[1]))
    batches = [rows[i:i + 16] for i in range(0, len(rows), 16)]
    for _ in range(epochs):
        for at in draw.permutation(len(batches)):
            x, mask = padded([r[0] for r in batches[at]])
            y = np.zeros_like(mask)
            for j, (_, labels) in enumerate(batches[at]):
                y[:len(labels), j] = labels
            step += 1
            for k, g in net.gradients(x, mask, y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.w[k] = net.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def main_texts(pages: list[str | None], net: Network | None, features: Features) -> list[str]:
    """The kept blocks of each page, joined by a line feed."""
    leaves = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, b in enumerate(leaves) if b), key=lambda i: len(leaves[i]))
    at = 0
    while net is not None and at < len(order):
        # About 20,000 steps of padded input at once.
        to = at + 1
        while to < len(order) and (to + 1 - at) * len(leaves[order[to]]) <= 20_000:
            to += 1
        part = order[at:to]
        x, mask = padded([features(leaves[i]) for i in part])
        p = net.forward(x, mask)[0]
        for j, i in enumerate(part):
            out[i] = "\n".join(text for (_, text, _), good in zip(leaves[i], p[:, j], strict=False) if good > 0.5)
        at = to
    return out


def learn(pages: DataFrame, sample: int = SAMPLE) -> Network | None:
    known = pages.select(F.col("html").cast("string").alias("html")).where("html IS NOT NULL")
    texts = [t for t in bounded_sample(known, "html", known.count(), sample) if blocks(t)]
    return train(texts) if texts else None


RESULT = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text, n_chars: one row for each page."""
    small_batches(pages.sparkSession)
    net = learn(pages, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            texts = main_texts(batch.column("html").to_pylist(), net, features)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, RESULT)
