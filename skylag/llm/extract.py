"""Main text of HTML pages by a recurrent block labeller.

A page becomes a row of leaf blocks: runs of text between block-level tags, each with its tag path. A block's vector
holds its path (hashed names of the open elements and of their class, id and role words), its hashed words and a
few measures. A bidirectional LSTM in numpy reads the row both ways, so each block is judged with the whole page in
view, and blocks labelled as content are joined.

The labeller is trained here on at most ``sample_pages`` distinct pages, chosen by a hash; of a long one, on windows: element names say what
most blocks are, and copies of the pages with renamed content elements and with boilerplate put in at random
places teach it the rest. Only this sample is bounded; every page is read whole.

Defined cases: a null or empty page gives an empty text; text outside any element is a block; comments, scripts, styles
and other elements without running text are dropped; tags, attributes, comments and self-closed svg are read as browsers
read them, in time linear in the page; references without a semicolon are decoded as browsers do; ``br`` is
white space; unclosed elements end with their parent, unclosed comments and scripts with the page, and an unclosed tag
is text; extra columns pass through, and text, n_chars and n_blocks replace
columns of these names; an empty table gives an empty result.
"""

import html
import operator
import pickle
import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import WordHashes, slices

PATH_DIM, WORD_DIM, MEASURES = 160, 16, 5
DIM = PATH_DIM + WORD_DIM + MEASURES
HIDDEN = 16
SAMPLE_PAGES, SAMPLE_CHARS = 250, 60_000
#: Innermost path words of a training block, and path words from which deeper is the same.
SAMPLE_PATH, DEEPEST = 200, 40
STEPS, BATCH, RATE = 240, 24, 0.01
#: Pages longer than this many blocks are labelled by themselves, so that padding stays small.
WIDE = 400

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img br input".split())
#: Elements without running text: those whose content is not markup, and those whose markup is passed over.
RAW = frozenset("script style textarea iframe noscript noembed noframes xmp".split())
FOREIGN = frozenset("svg math".split())
SILENT = FOREIGN | frozenset("template select object canvas audio video button".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
#: Start tags that end an svg or math element they stand in.
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split())

# Words in class, id and role attributes and elements that mark what is not the article.
BOILERPLATE = frozenset(
    "nav header footer aside form menu navbar navigation sidebar widget ad ads advert advertisement sponsor sponsored promo "
    "banner cookie consent notice popup modal newsletter subscribe signup login search share social related recommended "
    "trending breadcrumb breadcrumbs pagination pager comment comments reply replies respond discussion disclaimer copyright "
    "legal toolbar topbar masthead skip complementary contentinfo dialog alert title".split())
CONTENT = frozenset("article main".split())
CONTENT_NAMES = [("article",), ("main",), ("div", "content"), ("div", "post"), ("div", "article", "body"), ("section", "entry", "content"),
                 ("main", "article"), ("div", "story"), ("div", "main", "content")]
WRAPPER_WORDS = sorted(BOILERPLATE - {"title", "nav", "footer", "aside", "form", "header"})
PUT_IN = [("header",), ("header", "masthead"), ("div", "header"), ("nav",), ("nav", "ul", "li"), ("ul", "menu", "li"), ("div", "navbar"),
          ("aside",), ("aside", "p"), ("div", "sidebar"), ("div", "sidebar", "widget", "p"), ("div", "ad"), ("div", "ads"), ("div", "advert"),
          ("div", "advertisement"), ("div", "sponsored", "p"), ("div", "promo"), ("div", "banner"), ("div", "cookie", "banner"),
          ("div", "cookie", "notice", "p"), ("div", "consent"), ("div", "notice"), ("div", "popup"), ("form",), ("form", "p"),
          ("form", "newsletter"), ("form", "search"), ("div", "subscribe"), ("div", "share"), ("div", "social"), ("div", "related", "ul", "li"),
          ("div", "breadcrumb"), ("div", "comments", "p"), ("section", "comments", "p"), ("section", "comments", "div", "comment", "p"),
          ("ol", "comment", "list", "li", "p"), ("div", "comment"), ("div", "reply"), ("footer",), ("footer", "p"), ("div", "footer"),
          ("div", "copyright"), ("div", "legal"), ("div", "disclaimer"), ("div", "login"), ("div", "pagination"), ("title",)]

#: A start or end tag as browsers read it; no part of it is tried in two ways.
TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:\s++|/(?!>)|(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+)*+)(/?)>""")
COMMENT_END = re.compile("--!?>")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
NAME = re.compile(r"[a-z]+")


def tags(page: str, silent: list):
    """(start, end, closing, name, attributes, self-closed) of what is not text, in order, in time linear in the page.

    The name is None for comments, declarations and raw elements with their content. What is not closed at all reaches
    to the end, but for a tag, which is text. ``silent`` has the reader's open elements without running text.
    """
    at, end = page.find("<"), len(page)
    while at >= 0:
        after, third = page[at + 1 : at + 2], page[at + 2 : at + 3]
        if after in ("!", "?") or after == "/" and third and not (third.isascii() and third.isalpha()):
            if page.startswith("<!--", at):
                if page.startswith((">", "->"), at + 4):
                    stop = page.index(">", at) + 1
                else:
                    found = COMMENT_END.search(page, at + 4)
                    stop = found.end() if found else end
            else:
                stop = page.find(">", at) + 1 or end
            yield at, stop, False, None, "", False
        elif m := TAG.match(page, at):
            name, stop = m[2].lower(), m.end()
            if name in RAW and not m[1] and not (m[4] and silent and silent[0] in FOREIGN):
                found = RAW_END[name].search(page, stop)
                stop = page.find(">", found.start()) + 1 or end if found else end
                name = None
            yield at, stop, bool(m[1]), name, m[3], bool(m[4])
        elif after == "/" or after.isascii() and after.isalpha():
            return  # a tag without end
        else:
            stop = at + 1
        at = page.find("<", stop)


class Node:
    """An open element, with what its chain of parents says, so that no chain is walked for each block."""

    __slots__ = ("parent", "name", "marks", "top", "named", "words", "holds", "kind")

    def __init__(self, parent: "Node | None", name: str = "", marks: tuple = ()):
        self.parent, self.name, self.marks = parent, name, marks
        own = name in CONTENT or name not in ("html", "body") and not CONTENT.isdisjoint(marks)
        #: the outermost content element, and whether a boilerplate element is round this one or is it
        self.top = (parent.top if parent else None) or (self if own else None)
        self.named = parent is not None and (parent.named or name in BOILERPLATE)
        self.words, self.holds = 0, False
        #: set by ``plain``: (bits, number of path words, any boilerplate word, any content word)
        self.kind = None if parent else (0, 0, False, False)

    def own(self) -> tuple:
        """Its path words: 'title' counts as a name alone, and marks of html, body and holders of the article say little."""
        if self.name in ("html", "body"):
            return (self.name,)
        return self.name, *[m for m in self.marks if m != "title" and not (self.holds and m in BOILERPLATE)]

    def path(self, most: int = 1 << 60) -> tuple:
        """Path words, the innermost ``most`` or some more."""
        out, node, n = [], self, 0
        while node.parent and n < most:
            out.append(node.own())
            n += len(out[-1])
            node = node.parent
        return tuple(w for words in reversed(out) for w in words)

    def settle(self) -> tuple:
        """Its kind, from that of its parents."""
        chain, node = [], self
        while node.kind is None:
            chain.append(node)
            node = node.parent
        for node in reversed(chain):
            node.kind = tuple(f(a, b) for f, a, b in zip(JOINED, node.parent.kind, kind_of(node.own())))
        return self.kind


class Block:
    """A run of text with the element it stands in, or with path words alone."""

    __slots__ = ("node", "words", "text", "linked", "kind")

    def __init__(self, path: "tuple | Node", text: str, linked: float, kind: tuple | None = None):
        self.node, self.words = (path, None) if isinstance(path, Node) else (None, path)
        self.text, self.linked, self.kind = text, linked, kind

    @property
    def path(self) -> tuple:
        return self.words if self.node is None else self.node.path()


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order: path words, text with white space made single, share of link text."""
    out, text, linked, in_link, at = [], [], 0, 0, 0
    stack, opened = [Node(None)], {}  # opened: how many elements of each name are open
    silent, held = [], {}  # open elements from one without running text on, and how many of each name

    def flush():
        nonlocal linked
        raw = "".join(text)
        if raw:
            words = (html.unescape(raw) if "&" in raw else raw).split()
            if words:
                out.append(Block(stack[-1], " ".join(words), min(1.0, linked / len(raw))))
                stack[-1].words += len(words)
            text.clear()
        linked = 0

    def add(piece: str):
        nonlocal linked
        if piece and not silent:
            text.append(piece)
            if in_link:
                linked += len(piece)

    def hush(name: str):
        silent.append(name)
        held[name] = held.get(name, 0) + 1

    def speak():
        silent.clear()
        held.clear()

    def passed_over(closing: bool, name: str, closed: bool) -> bool:
        """Whether a tag inside an element without running text changes nothing outside it."""
        if closing:
            if held.get(name):
                while (last := silent.pop()) != name:
                    held[last] -= 1
                held[name] -= 1
                return True
            if name in INLINE or not opened.get(name):
                return True
            speak()  # its parent ends
            return False
        if silent[0] in FOREIGN and name in BREAKS_OUT and not held.get("foreignobject"):
            speak()
            return False
        # of what is open in here only names that can end it matter
        if (name in SILENT or name == "foreignobject") and not (closed and silent[0] in FOREIGN):
            hush(name)
        return True

    def close():
        opened[stack.pop().name] -= 1

    page = page or ""
    for start, end, closing, name, attributes, closed in tags(page, silent):
        add(page[at:start])
        at = end
        if name is None or silent and passed_over(closing, name, closed):
            continue
        if name in SILENT:
            if not closing and not (closed and name in FOREIGN):
                hush(name)
            continue
        if name in INLINE:
            if name == "br":
                add(" ")
            elif name == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        if closing:
            if opened.get(name):
                while stack[-1].name != name:
                    close()
                close()
                in_link = 0
            continue
        if name in CLOSES_ITSELF and stack[-1].name == name:
            close()
        if name in VOID:
            continue
        marks = () if not attributes else tuple(w for v in MARKS.findall(attributes) for w in NAME.findall(v.lower()))
        stack.append(Node(stack[-1], name, marks))
        opened[name] = opened.get(name, 0) + 1
    add(page[at:])
    flush()
    return out


_bits: dict[str, int] = {}


def bit_of(word: str) -> int:
    """The place of a path word among the path bits."""
    got = _bits.get(word)
    if got is None:
        if len(_bits) > 50_000:
            _bits.clear()
        got = _bits[word] = 1 << (xxhash.xxh64_intdigest(word, 3) % PATH_DIM)
    return got


def kind_of(words) -> tuple:
    """(bits, number of path words, any boilerplate word, any content word)."""
    bits = 0
    for w in words:
        bits |= bit_of(w)
    return bits, len(words), not BOILERPLATE.isdisjoint(words), not CONTENT.isdisjoint(words)


JOINED = (operator.or_, operator.add, operator.or_, operator.or_)


class Features:
    """Vectors of blocks; paths seen before are kept."""

    def __init__(self):
        self.paths: dict[int, np.ndarray] = {}
        self.words = WordHashes()

    def path(self, bits: int) -> np.ndarray:
        got = self.paths.get(bits)
        if got is None:
            raw = np.frombuffer(bits.to_bytes(PATH_DIM // 8, "little"), np.uint8)
            got = self.paths[bits] = np.unpackbits(raw, bitorder="little").astype(float)
        return got

    def of(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """One array a page, a row for each block."""
        if len(self.paths) > 50_000:
            self.paths.clear()
        blocks = [b for page in pages for b in page]
        out = np.zeros((len(blocks), DIM))
        if blocks:
            words = [b.text.encode().split() for b in blocks]
            n = np.fromiter(map(len, words), np.int64, len(words))
            buckets = (self.words.of([w for some in words for w in some]) % np.uint64(WORD_DIM)).astype(np.int64)
            spread = np.bincount(np.repeat(np.arange(len(n)), n) * WORD_DIM + buckets, minlength=len(n) * WORD_DIM)
            kinds = [b.kind or kind_of(b.path) for b in blocks]
            out[:, :PATH_DIM] = [self.path(k[0]) for k in kinds]
            out[:, PATH_DIM : PATH_DIM + WORD_DIM] = spread.reshape(-1, WORD_DIM) / n[:, None]
            ends = np.array([b.text.count(".") + b.text.count(",") for b in blocks])
            out[:, -MEASURES:] = np.column_stack([
                np.log1p(n) / 5, [b.linked for b in blocks], np.minimum(1, ends / n), [min(k[1], DEEPEST) / 10 for k in kinds], np.ones(len(n))])
        return np.split(out, np.cumsum([len(page) for page in pages])[:-1])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction; sequences are padded at their end, arrays are (time, sequence, value)."""

    def __init__(self, rng):
        self.wx = rng.standard_normal((DIM, 4 * HIDDEN)) / np.sqrt(DIM)
        self.wh = rng.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)
        self.b = np.zeros(4 * HIDDEN)
        self.b[HIDDEN : 2 * HIDDEN] = 1

    def params(self):
        return [self.wx, self.wh, self.b]

    def forward(self, x, keep=False):
        steps, n = x.shape[:2]
        z_in = x @ self.wx + self.b
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out, saved = np.zeros((steps, n, HIDDEN)), []
        for t in range(steps):
            z = z_in[t] + h @ self.wh
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before_h, before_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = out[t] = o * tc
            if keep:
                saved.append((i, f, o, g, before_h, before_c, tc))
        return out, saved

    def backward(self, x, saved, d_out):
        d_wx, d_wh, d_b = (np.zeros_like(p) for p in self.params())
        d_h = d_c = np.zeros(d_out.shape[1:])
        for t in range(len(saved) - 1, -1, -1):
            i, f, o, g, before_h, before_c, tc = saved[t]
            d_h = d_h + d_out[t]
            d_c = d_c + d_h * o * (1 - tc * tc)
            d_z = np.concatenate([
                d_c * g * i * (1 - i), d_c * before_c * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - g * g)], axis=1)
            d_wx += x[t].T @ d_z
            d_wh += before_h.T @ d_z
            d_b += d_z.sum(axis=0)
            d_h, d_c = d_z @ self.wh.T, d_c * f
        return [d_wx, d_wh, d_b]


class Labeller:
    """Bidirectional LSTM with one logit a block."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.ahead, self.back = Lstm(rng), Lstm(rng)
        self.out = rng.standard_normal(2 * HIDDEN + DIM) * 0.05
        self.bias = np.zeros(1)

    def params(self):
        return [*self.ahead.params(), *self.back.params(), self.out, self.bias]

    @staticmethod
    def _pad(rows: list[np.ndarray]):
        sizes = np.array([len(r) for r in rows])
        x = np.zeros((sizes.max(), len(rows), DIM))
        for k, r in enumerate(rows):
            x[: len(r), k] = r
        step = np.arange(len(x))[:, None]
        turned = np.where(step < sizes, sizes - 1 - step, step)  # each sequence from its end; padding stays
        return x, turned, step < sizes

    def _logits(self, x, turned, keep=False):
        cols = np.arange(x.shape[1])
        x_back = x[turned, cols]
        fore, saved_fore = self.ahead.forward(x, keep)
        back, saved_back = self.back.forward(x_back, keep)
        joined = np.concatenate([fore, back[turned, cols], x], axis=2)
        return joined @ self.out + self.bias, joined, x_back, saved_fore, saved_back

    def content(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """For each page, which blocks are content."""
        out = [np.zeros(0, bool)] * len(rows)
        order = sorted((i for i in range(len(rows)) if len(rows[i])), key=lambda i: len(rows[i]))
        at = 0
        while at < len(order):
            longest, n = len(rows[order[at]]), 1
            while at + n < len(order) and n < 256 and len(rows[order[at + n]]) <= 1.5 * longest + 4 and len(rows[order[at + n]]) <= WIDE:
                n += 1
            some = order[at : at + n]
            x, turned, _ = self._pad([rows[i] for i in some])
            logits = self._logits(x, turned)[0]
            for k, i in enumerate(some):
                out[i] = logits[: len(rows[i]), k] > 0
            at += n
        return out

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, seed: int = 0) -> "Labeller":
        """Adam on batches of (vectors, labels) pages."""
        rng = random.Random(seed)
        mean, square = ([np.zeros_like(p) for p in self.params()] for _ in range(2))
        for step in range(1, steps + 1):
            some = rng.sample(examples, min(BATCH, len(examples)))
            x, turned, real = self._pad([e[0] for e in some])
            y = np.zeros(real.shape)
            for k, (_, labels) in enumerate(some):
                y[: len(labels), k] = labels
            logits, joined, x_back, saved_fore, saved_back = self._logits(x, turned, True)
            d = (_sigmoid(logits) - y) * real / real.sum()
            d_joined = d[:, :, None] * self.out
            cols = np.arange(x.shape[1])
            grads = [
                *self.ahead.backward(x, saved_fore, d_joined[:, :, :HIDDEN]),
                *self.back.backward(x_back, saved_back, d_joined[:, :, HIDDEN : 2 * HIDDEN][turned, cols]),
                (d[:, :, None] * joined).sum(axis=(0, 1)), np.array([d.sum()])]
            for p, g, m, s in zip(self.params(), grads, mean, square):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        return self


def plain(blocks: list[Block]) -> list[Block]:
    """The blocks with kinds that say what is content: without the marks of html and body, of the main content element
    and of the elements round it, as these hold the article and more; 'title' stays only as an element name.

    The main content element is the outermost article or main (by name or mark) with the most words, one without
    boilerplate marks first. Called once on the blocks of a page.
    """
    words: dict[Node, int] = {}
    for node in dict.fromkeys(b.node for b in blocks if b.node):
        if node.top:
            words[node.top] = words.get(node.top, 0) + node.words
    holder = max(words, key=lambda t: (BOILERPLATE.isdisjoint(t.marks) and not t.parent.named, words[t]), default=None)
    while holder:
        holder.holds = True
        holder = holder.parent
    return [b if b.node is None else Block(b.node, b.text, b.linked, b.node.settle()) for b in blocks]


def weak_labels(blocks: list[Block]) -> list[int]:
    """1 for what element names say is content. A page that names no content element counts its long paragraphs."""
    if any(b.node and b.kind is None for b in blocks):
        blocks = plain(blocks)
    kinds = [b.kind or kind_of(b.path) for b in blocks]
    named = any(k[3] for k in kinds)
    return [int(not k[2] and bool(k[3] if named else len(b.text.split()) >= 20)) for b, k in zip(blocks, kinds)]


def varied(blocks: list[Block], labels: list[int], texts: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A copy of a page with its content elements renamed and boilerplate put in before, inside and behind."""
    name = rng.choice(CONTENT_NAMES)
    # words of the wrappers of a page mean nothing
    if rng.random() < 0.3:
        name = (*name, *rng.sample(WRAPPER_WORDS, 2))
    out = []
    for b, label in zip(blocks, labels):
        path = []
        for word in b.path:
            path += name if word in CONTENT else [word]
        if not label and rng.random() < 0.3:
            continue
        out.append((Block(tuple(path), b.text, b.linked), label))
    inside = next((b.path for b, label in out if label), ("html", "body"))
    for _ in range(rng.randint(1, 6)):
        container = rng.choice(PUT_IN)
        base = inside[: rng.choice((2, len(inside)))]
        words = rng.choice(texts).split()
        size = rng.choice((3, 8, 30, 200))
        at = rng.randint(0, len(out))
        put = [(Block((*base, *container), " ".join(words[: rng.randint(1, size)]), float(rng.random() < 0.3)), 0) for _ in range(rng.randint(1, 4))]
        out[at:at] = put
    return [b for b, _ in out], [label for _, label in out]


def windows(blocks: list[Block], labels: list[int]) -> list[tuple[list[Block], list[int]]]:
    """A page as a whole if it is short, else its begin, middle and end, each bounded in blocks and characters."""
    most = WIDE - 24  # varied() puts in up to so many

    def cut(at):
        got, held = [], 0
        for b in blocks[at : at + most]:
            if got and held + len(b.text) > SAMPLE_CHARS:
                break
            got.append(Block(b.words if b.node is None else b.node.path(SAMPLE_PATH), b.text[:SAMPLE_CHARS], b.linked))
            held += len(b.text)
        return got, labels[at : at + len(got)]

    first = cut(0)
    n = len(first[0])
    if n == len(blocks):
        return [first] if n else []
    return [cut(at) for at in dict.fromkeys((0, (len(blocks) - n) // 2, max(0, len(blocks) - n)))]


def sampled(pages: DataFrame, sample_pages: int) -> list:
    """Windows of the distinct pages with the smallest hashes: (blocks, labels) each, in the order of the hashes."""
    keyed = pages.where(F.length("html") > 0).select("html", F.xxhash64("html").alias("order"))
    first = [r["order"] for r in keyed.select("order").distinct().orderBy("order").limit(sample_pages).toArrow().to_pylist()]
    chosen = keyed.where(F.col("order").isin(first)).groupBy("order").agg(F.min("html").alias("html"))

    def run(batches):
        for part in slices(batches, "html"):
            out = []
            for page in part.column("html").to_pylist():
                blocks = plain(blocks_of(page))
                out.append(pickle.dumps([([(b.path, b.text, b.linked) for b in some], own) for some, own in windows(blocks, weak_labels(blocks))]))
            yield pa.RecordBatch.from_arrays([part.column("order"), pa.array(out, pa.binary())], ["order", "windows"])

    got = sorted(chosen.mapInArrow(run, "order long, windows binary").toArrow().to_pylist(), key=lambda r: r["order"])
    return [([Block(*b) for b in some], own) for r in got for some, own in pickle.loads(r["windows"])]


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Labeller | None:
    """A labeller fitted to a bounded sample of the pages; None if no page has a block."""
    read = sampled(pages, sample_pages)
    rng, features = random.Random(0), Features()
    if not read:
        return None
    texts = [b.text for page, _ in read for b in page]
    examples = []
    for page, labels in read:
        for blocks, own in [(page, labels), *[varied(page, labels, texts, rng) for _ in range(3)]]:
            if blocks:
                examples.append((features.of([blocks])[0], np.array(own, float)))
    return Labeller().fit(examples)


def extract(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """``pages`` without html but with text, n_chars and n_blocks (blocks kept)."""
    model = pages.sparkSession.sparkContext.broadcast(labeller or train(pages))
    new = ("text", "n_chars", "n_blocks")
    rest = [c for c in pages.columns if c not in (*new, "html")]

    def run(batches):
        features = Features()
        for part in slices(batches, "html"):
            read = [plain(blocks_of(h)) for h in part.column("html").to_pylist()]
            kept = model.value.content(features.of(read)) if model.value else [[] for _ in read]
            texts = ["\n".join(b.text for b, k in zip(blocks, keep) if k) for blocks, keep in zip(read, kept)]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in rest], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                 pa.array([int(np.sum(k)) for k in kept], pa.int64())], [*rest, *new])

    zero = F.lit(0).cast("long")
    schema = pages.select(*[F.col(f"`{c}`") for c in rest]).withColumns({"text": F.lit(""), "n_chars": zero, "n_blocks": zero}).schema
    return pages.select(*[F.col(f"`{c}`") for c in (*rest, "html")]).mapInArrow(run, schema)
