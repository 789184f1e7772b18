"""Main text of HTML pages by a recurrent block labeller.

A page is a sequence of leaf blocks (see ``html_blocks``). Each block becomes a vector: signed hashes of the names on its tag path, hashed word vectors, and
a few shares. A bidirectional LSTM in numpy reads the whole sequence, so each block is classified in view of all others; the text is that of the blocks it
keeps, one line each.

The labeller is trained on a bounded, documented sample of the pages (about TRAIN_PAGES, by the id's hash), at the start of each job. No labels are given,
so a teacher names the training blocks by the meaning of HTML elements, usual class names and the share of the text that an element holds: what lies inside an article or content
element, and not inside a menu, header, footer, sidebar, notice, advert, form or comment section within it. Copies of the sampled pages keep these labels and take other layouts, content
without any name and misleading names around the page among them, so that the labeller must also go by text, links and neighbours. At extraction the teacher is not asked.

Defined cases: a null or empty page, and one without kept blocks, has an empty text; broken markup is read as browsers do in the common cases (unclosed
elements, stray end tags, unclosed comments and scripts); pages of any length are read whole; equal rows give equal rows; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import query, table, with_text
from rowmill.llm.html_blocks import Block, Path, blocks
from rowmill.llm.units import Memo

PATH_SIZE = 96
WORD_SIZE = 16
WORD_ROWS = 1024
SHARES = 9
INPUT = PATH_SIZE + WORD_SIZE + SHARES
HIDDEN = 16
TRAIN_PAGES = 300
TRAIN_BLOCKS = 64
TRAIN_PARTS = 4000  # of TRAIN_BLOCKS blocks at most
COPIES = 3  # of each page; more where few pages are sampled
EPOCHS = 24
SEED = 1
CELLS = 1 << 15  # blocks, padding included, that go through the network at once

#: Elements without meaning; like numbers, they give a path no vector.
PLAIN = frozenset("div section table tbody tr td center".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre".split())
MAIN = frozenset("article main .article .main .content .post .entry .story .body".split())
SIDE = frozenset(
    "nav header footer aside form button menu dialog .nav .navbar .navigation .menu .header .footer .sidebar .aside .widget .ad .ads .advert .advertisement .sponsor .sponsored .promo "
    ".banner .cookie .cookies .consent .notice .alert .popup .modal .newsletter .subscribe .form .login .search .comment .comments .respond .disqus .share .social .related "
    ".recommended .breadcrumb .breadcrumbs .pagination .pager .tags .copyright .legal .complementary .contentinfo".split()
)
#: Side names that stay so however much of the page they hold; other ones tell nothing on an element with most of the text (``header-fixed``, ``has-sidebar``).
REPLIES = frozenset(".comment .comments .respond .disqus".split())
FIRM = frozenset("nav header footer aside button menu dialog".split()) | REPLIES
#: Layouts of sections, of content elements and of elements around the page for the copies; ".?" is a name without meaning.
SECTIONS = [
    ("nav", "ul", "li"), ("div .menu", "ul", "li"), ("div .navbar", "li"), ("header", "div"), ("div .header", "p"), ("footer", "p"), ("div .footer", "div"), ("aside", "p"),
    ("div .sidebar", "p"), ("div .sidebar", "ul", "li"), ("div .widget", "div"), ("div .ad",), ("div .ads", "p"), ("div .advert",), ("div .sponsored", "p"), ("section .promo", "p"),
    ("div .banner",), ("div .cookie .notice",), ("div .notice", "p"), ("div .consent", "p"), ("div .alert",), ("div .popup", "p"), ("form",), ("form", "p"), ("form", "div"),
    ("div .newsletter", "form"), ("div .subscribe", "p"), ("section .comments", "div .comment", "p"), ("div .comments", "p"), ("ol .comment .list", "li", "p"), ("div .comment",),
    ("div .share",), ("div .social", "ul", "li"), ("div .related", "ul", "li"), ("div .breadcrumb",), ("div .pagination",), ("div .copyright",), ("button",), ("div .tags",),
]
LINKS = [("div", "ul", "li"), ("ul", "li"), ("div .?", "div"), ("div", "p"), ("div .? .?", "ul", "li")]
COMMENTS = [("section .comments", "div .comment", "p"), ("div .comments", "p"), ("ol .comment .list", "li", "p"), ("div .?", "div .comment .?", "p"), ("section .comments", "article .comment", "p"),
            ("div .comments", "div .comment", "div", "p"), ("div .respond", "div", "div .comment", "div", "p"), ("div", "ul .comments", "li .comment", "p")]
CONTENTS = [
    ("article",), ("main",), ("main", "article"), ("div .content",), ("div .post",), ("div .entry .content",), ("div .article .body",), ("section .story",), ("div .main .content",),
    ("div",), ("div .?",), ("div .? .?", "div"), ("section .?",), ("div", "div .?"),
]
HEADS, LINES = ["h1", "h1", "h2", "h3"], ["p", "p", "p", "div", "li", "blockquote"]
AROUND = "header fixed has sidebar nav open menu page body wrap container single ad free content main site post no footer sticky layout widget notice".split()


def _elements(at: Path | None) -> list[Path]:
    """A path's elements, the outermost first."""
    out = []
    while at is not None:
        out.append(at)
        at = at.parent
    return out[::-1]


def _held(page: list[Block]) -> dict[Path, tuple[int, int]]:
    """Of every element: the characters of all blocks inside it, outside links and within. Parents follow their children in one pass over the elements."""
    own: dict[Path, list[int]] = {}
    for b in page:
        at, linked = b.at, min(b.link_chars, len(b.text))
        mine = own.setdefault(at, [0, 0])
        mine[0] += len(b.text) - linked
        mine[1] += linked
        while at.parent is not None and at.parent not in own:
            at = at.parent
            own[at] = [0, 0]
    for at in sorted(own, key=lambda e: -e.depth):
        if at.parent is not None:
            up = own[at.parent]
            up[0] += own[at][0]
            up[1] += own[at][1]
    return {at: (plain, linked) for at, (plain, linked) in own.items()}


def _is_large(at: Path, held: dict[Path, tuple[int, int]], total: int) -> bool:
    """Does an element hold more than half of the page's text outside links?"""
    return 2 * held[at][0] > total


def _is_frame(at: Path) -> bool:
    return not at.names or at.names[0] in ("html", "body")


def teacher(page: list[Block]) -> np.ndarray:
    """1 for the blocks inside a content element and not inside a side section.

    The names of html and body tell nothing, nor do layout names of an element with most of the text. A content element with another one that holds half of its text is only the frame
    of that one. Without any content element, it is the one with the most words in blocks that are not links.
    """
    held, total = _held(page), sum(max(0, len(b.text) - b.link_chars) for b in page)
    side: dict[Path | None, bool] = {None: False}
    inner: set[Path] = set()
    order = sorted(held, key=lambda e: e.depth)
    for at in order:
        names = () if _is_frame(at) else at.names
        loose = _is_large(at, held, total)
        side[at] = side[at.parent] or any(n in SIDE and (n in FIRM or not loose) for n in names)
        if not side[at] and any(n in MAIN for n in names):
            inner.add(at)
    frames: set[Path] = set()
    marked: dict[Path | None, Path | None] = {None: None}
    for at in order:
        outer = marked[at.parent]
        marked[at] = at if at in inner else outer
        if at in inner and outer is not None and 2 * held[at][0] >= held[outer][0]:
            frames.add(outer)
    real = inner - frames
    within: dict[Path | None, bool] = {None: False}
    for at in order:
        within[at] = within[at.parent] or at in real
    found = np.array([within[b.at] and not side[b.at] or (b.at.names[:1] == ("h1",) and marked[b.at] is not None and not side[b.at]) for b in page], float)
    if found.any():
        return found
    plain = [not side[b.at] and 3 * b.link_chars < len(b.text) for b in page]
    words: dict[Path | None, int] = {}
    around = [b.at.parent if b.at.names[:1] and b.at.names[0] in LEAVES else b.at for b in page]
    for b, good, at in zip(page, plain, around, strict=True):
        if good and (count := b.text.count(" ") + 1) >= 8:
            words[at] = words.get(at, 0) + count
    best = max(words, key=lambda at: words[at], default=None)
    return np.array([bool(words) and good and at is best for good, at in zip(plain, around, strict=True)], float)


_WORDS = np.random.default_rng(SEED).normal(size=(WORD_ROWS, WORD_SIZE))
_NAMES: dict[str, np.ndarray] = {}


def _name_vector(name: str) -> np.ndarray:
    if name not in _NAMES:
        if len(_NAMES) > 1 << 14:
            _NAMES.clear()
        _NAMES[name] = np.random.default_rng(zlib.crc32(name.encode())).choice([-1.0, 1.0], PATH_SIZE)
    return _NAMES[name]


def _row(word: str) -> int:
    return zlib.crc32(word.encode()) % WORD_ROWS


_ROWS = Memo(_row, 1 << 17)


def _path_sum(at: Path | None, sums: dict[Path, tuple[np.ndarray, int]], held: dict[Path, tuple[int, int]], total: int) -> tuple[np.ndarray, int]:
    """The sum of the vectors of all names of a path, and their number; each element adds to what its parent has. Names of an element with most of the page's text are names of their own."""
    new = []
    while at is not None and at not in sums:
        new.append(at)
        at = at.parent
    mean, near = sums[at] if at is not None else (np.zeros(PATH_SIZE), 0)
    for element in reversed(new):
        if not _is_frame(element):
            large, names = "^" if _is_large(element, held, total) else "", [n for n in element.names if n not in PLAIN and not n.lstrip(".").isdigit()]
            mean = sum((_name_vector(large + n) for n in names), mean)
            near += len(names)
        sums[element] = mean, near
    return mean, near


def vectors(page: list[Block]) -> np.ndarray:
    """(blocks, INPUT)."""
    out = np.zeros((len(page), INPUT))
    if not page:
        return out
    held, all_chars = _held(page), sum(max(0, len(b.text) - b.link_chars) for b in page)
    sums: dict[Path, tuple[np.ndarray, int]] = {}
    words = [b.text.split(" ") for b in page]
    counts = np.array([len(w) for w in words])
    rows = np.fromiter((_ROWS[w] for some in words for w in some), np.int64, int(counts.sum()))
    means = np.add.reduceat(_WORDS[rows], np.cumsum(counts) - counts) / counts[:, None]
    shares = []
    for i, b in enumerate(page):
        total, near = _path_sum(b.at, sums, held, all_chars)
        out[i, :PATH_SIZE] = total / np.sqrt(max(4, near))
        data = b.text.encode()
        marks, digits = len(data) - len(data.translate(None, b".,;:!?")), len(data) - len(data.translate(None, b"0123456789"))
        around, linked = held[b.at.parent or b.at]
        shares.append((
            min(1.0, b.link_chars / len(b.text)), marks / counts[i], digits / len(data), min(1.0, b.at.depth / 10), 1.0 if b.text[-1] in ".!?" else 0.0,
            around / max(1, all_chars), linked / max(1, around + linked),
        ))
    out[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = means
    out[:, -SHARES] = np.log1p(counts) / 4
    out[:, 1 - SHARES] = np.arange(len(page)) / len(page)
    out[:, 2 - SHARES :] = shares
    return out


@dataclass
class Labeller:
    """Both directions: gate weights (INPUT + HIDDEN + 1, 4 HIDDEN); and the output layer over both states and the block's vector."""

    ahead: np.ndarray
    back: np.ndarray
    last: np.ndarray

    @staticmethod
    def fresh() -> Labeller:
        rng = np.random.default_rng(SEED)
        gates = lambda: rng.normal(size=(INPUT + HIDDEN + 1, 4 * HIDDEN)) * 0.15
        return Labeller(gates(), gates(), rng.normal(size=2 * HIDDEN + 1) * 0.1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _read(w: np.ndarray, x: np.ndarray, real: np.ndarray, keep: bool = False):
    """States (steps, pages, HIDDEN) of one direction over x (steps, pages, INPUT); padding leaves the state as it is."""
    steps, pages, _ = x.shape
    h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    states, tape = np.empty((steps, pages, HIDDEN)), []
    given = x @ w[:INPUT] + w[-1]
    inner = w[INPUT:-1]
    for t in range(steps):
        z = given[t] + h @ inner
        s = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
        m = real[t][:, None]
        c2 = np.where(m, f * c + i * g, c)
        h2 = np.where(m, o * np.tanh(c2), h)
        if keep:
            tape.append((h, c, c2, i, f, o, g))
        h, c = h2, c2
        states[t] = h
    return states, tape


def _unread(w: np.ndarray, x: np.ndarray, real: np.ndarray, tape: list, d_states: np.ndarray) -> np.ndarray:
    """Gradient of ``w`` for the gradients of the states."""
    grad = np.zeros_like(w)
    dh, dc = np.zeros_like(d_states[0]), np.zeros_like(d_states[0])
    inner = w[INPUT:-1]
    for t in range(len(tape) - 1, -1, -1):
        h, c, c2, i, f, o, g = tape[t]
        m = real[t][:, None]
        dh = dh + d_states[t]
        th = np.tanh(c2)
        do, d2 = dh * th, dc + dh * o * (1 - th * th)
        dz = np.concatenate([d2 * g * i * (1 - i), d2 * c * f * (1 - f), do * o * (1 - o), d2 * i * (1 - g * g)], axis=1) * m
        grad[:INPUT] += x[t].T @ dz
        grad[INPUT:-1] += h.T @ dz
        grad[-1] += dz.sum(axis=0)
        dh = np.where(m, dz @ inner.T, dh)
        dc = np.where(m, d2 * f, dc)
    return grad


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, real = np.zeros((steps, len(pages), INPUT)), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k], real[: len(p), k] = p, True
    return x, real


def _turned(x: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Each page's own steps in reverse order, padding left at the end."""
    sizes = real.sum(axis=0)
    at = np.where(real, sizes - 1 - np.arange(len(x))[:, None], np.arange(len(x))[:, None])
    return x[at, np.arange(x.shape[1])]


def label_pages(model: Labeller, pages: list[np.ndarray]) -> list[np.ndarray]:
    """The probability of main text for each block of each page; pages of like length go together."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
    while order:
        longest = len(pages[order[-1]])
        some = order[-max(1, CELLS // longest) :]
        del order[-len(some) :]
        x, real = _padded([pages[i] for i in some])
        a = _read(model.ahead, x, real)[0]
        b = _turned(_read(model.back, _turned(x, real), real)[0], real)
        p = _sigmoid(a @ model.last[:HIDDEN] + b @ model.last[HIDDEN:-1] + model.last[-1])
        for k, i in enumerate(some):
            out[i] = p[: len(pages[i]), k]
    return out


def fit(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01) -> Labeller:
    """Backpropagation through time with Adam steps on the mean log-loss of the blocks."""
    model, rng = Labeller.fresh(), np.random.default_rng(SEED)
    params = [model.ahead, model.back, model.last]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(pages))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            x, real = _padded([pages[i] for i in some])
            y = np.zeros(real.shape)
            for k, i in enumerate(some):
                y[: len(labels[i]), k] = labels[i]
            back_x = _turned(x, real)
            a, tape_a = _read(model.ahead, x, real, True)
            b, tape_b = _read(model.back, back_x, real, True)
            turned = _turned(b, real)
            p = _sigmoid(a @ model.last[:HIDDEN] + turned @ model.last[HIDDEN:-1] + model.last[-1])
            d = np.where(real, p - y, 0) / real.sum()
            g_last = np.concatenate([np.einsum("tp,tph->h", d, a), np.einsum("tp,tph->h", d, turned), [d.sum()]])
            g_a = _unread(model.ahead, x, real, tape_a, d[:, :, None] * model.last[:HIDDEN])
            g_b = _unread(model.back, back_x, real, tape_b, _turned(d[:, :, None] * model.last[HIDDEN:-1], real))
            step += 1
            for w, g, m, v in zip(params, (g_a, g_b, g_last), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def _named(layout: tuple[str, ...], rng: np.random.Generator) -> list[tuple[str, ...]]:
    """Elements of a layout; names without meaning are drawn anew, and some are added."""
    out = []
    for element in layout:
        names = element.split(" ")
        while rng.random() < 0.25:
            names.append(".?")
        out.append(tuple(f".x{rng.integers(10_000)}" if n == ".?" else n for n in names))
    return out


def varied(page: list[Block], labels: np.ndarray, pool: list[Block], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A copy in another layout, and its labels: the content element renamed or without a name, layout names around the whole page, side sections between and inside
    the content, unnamed lists of links, and sometimes comments, more than there is content. A label belongs to its block, whatever names the copy gives it."""
    top = Path(Path(None, ("html",)), ("body",))
    while rng.random() < 0.5:
        top = Path(top, ("div", *(f".{AROUND[rng.integers(len(AROUND))]}" for _ in range(rng.integers(0, 4)))))

    def grown(at: Path, elements: list[tuple[str, ...]]) -> Path:
        for e in elements:
            at = Path(at, e)
        return at

    content = grown(top, _named(CONTENTS[rng.integers(len(CONTENTS))], rng))
    swaps = {"h1": HEADS[rng.integers(len(HEADS))], "p": LINES[rng.integers(len(LINES))]}
    places: dict[Path, Path] = {}
    out: list[Block] = []
    made: list[float] = []

    def some_text(short: float) -> str:
        text = pool[rng.integers(len(pool))].text
        return " ".join(text.split(" ")[: rng.integers(1, 12)]) if rng.random() < short else text

    def side(layouts: list[tuple[str, ...]], at: Path, count: int, short: float, linked: bool) -> None:
        layout = _named(layouts[rng.integers(len(layouts))], rng)
        at = grown(at, layout[:-1])
        for _ in range(count):
            text = some_text(short)
            out.append(Block(text, Path(at, layout[-1]), len(text) if linked or layout[-1][0] == "li" and rng.random() < 0.7 else 0))
            made.append(0.0)

    for b, label in zip(page, labels, strict=True):
        while rng.random() < 0.12:
            side(SECTIONS, content if label and rng.random() < 0.4 else top, int(rng.integers(1, 5)), 0.4, False)
        if rng.random() < 0.06:
            side(LINKS, content if label and rng.random() < 0.2 else top, int(rng.integers(3, 9)), 0.9, True)
        if b.at not in places:
            tail = [e.names for e in _elements(b.at) if not _is_frame(e) and not (label and any(n in MAIN for n in e.names))]
            places[b.at] = grown(content if label else top, _named(tuple(" ".join((swaps.get(names[0], names[0]), *names[1:])) for names in (tail[-1:] if label else tail)), rng))
        out.append(Block(b.text, places[b.at], b.link_chars))
        made.append(label)
    if rng.random() < 0.4:
        side(COMMENTS, content if rng.random() < 0.3 else top, int(rng.integers(2, 3 + 2 * len(page))), 0.2, False)
    return out, np.array(made)


def chosen(key: str, html: str, share: float) -> Column:
    """True for about this share of the rows, however small: by 62 bits of a hash of id and page."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), F.col(html).cast("string")), 2) < F.lit(int(share * (1 << 62)))


def _with_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([bool(blocks(v.as_py() or "")) for v in batch.column(0)], pa.bool_()))


def train(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = TRAIN_PAGES) -> Labeller | None:
    """The labeller, or None if no page has text. If no sampled page has text, the sample is taken from all pages that have some."""
    source = F.col(html).cast("string").alias("html")
    read = lambda some: [b for (page,) in some.orderBy(F.xxhash64("html"), "html").limit(2 * sample).collect() if (b := blocks(page or ""))]
    parsed = read(pages.where(chosen(key, html, min(1.0, sample / max(1, pages.count())))).select(source))
    parsed = parsed or read(pages.select(source).mapInArrow(_with_blocks, "html string"))
    if not parsed:
        return None
    rng = np.random.default_rng(SEED)
    pool = [b for page in parsed for b in page]
    taught = [(page, teacher(page)) for page in parsed]
    copies = max(COPIES, min(TRAIN_PAGES * COPIES // len(parsed), 16_000 // len(pool)))
    taught += [varied(page, labels, pool, rng) for page, labels in taught for _ in range(copies)]
    given = [(vectors(page), labels) for page, labels in taught]
    cut = [(v[at : at + TRAIN_BLOCKS], y[at : at + TRAIN_BLOCKS]) for v, y in given for at in range(0, len(v), TRAIN_BLOCKS)]
    if len(cut) > TRAIN_PARTS:
        cut = [cut[i] for i in np.sort(rng.choice(len(cut), TRAIN_PARTS, replace=False))]
    return fit([v for v, _ in cut], [y for _, y in cut])


def texts(model: Labeller | None, sources: list[str]) -> list[str]:
    """The main text of each page. Without a labeller no page may have text: none is given an empty text unread."""
    parsed = [blocks(s) for s in sources]
    if model is None:
        if any(parsed):
            raise ValueError("pages with text need a labeller")
        return [""] * len(parsed)
    kept = label_pages(model, [vectors(page) for page in parsed])
    return ["\n".join(b.text for b, p in zip(page, ps, strict=True) if p >= 0.5) for page, ps in zip(parsed, kept, strict=True)]


def extract(pages: DataFrame, model: Labeller | None, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), group: int = 256) -> DataFrame:
    """``keep``, text and n_chars, a row for each row."""
    fields = [pages.schema[c] for c in keep] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, group):
                part = batch.slice(at, group)
                found = texts(model, [v.as_py() or "" for v in part.column(len(keep))])
                made = [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *made], names=[f.name for f in fields])

    return with_text(pages, keep, html).mapInArrow(extracted, T.StructType(fields))


@query("op1_html_extraction")
def extracted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
