"""Main text of web pages by a recurrent block labeller: a bidirectional LSTM in numpy.

A page becomes its sequence of leaf blocks (runs of text between block tags).  Each block has a vector:
hashed tags of its path, hashed class and id words along the path, hashed words of its text, and
lengths, links and places.  A forward and a backward LSTM read the whole sequence, so each
block is labelled in the light of all others; labelled blocks are joined in page order.

The labeller is trained here, on at most ``sample`` pages chosen by a hash of the id (the documented
bound of the classifier), labelled by what their own markup says, and on pages composed from the
texts of those pages in common layouts.  Every page is then labelled whole.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import read
from docloom.llm.registry import query

_RAW = "script|style|template|noscript|svg|iframe|select|textarea|button|object|math"
_REST = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
#: Raw elements go with all they hold.  A self-closed or never closed one ends at its own tag (code at the next tag).
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:{_RAW})\b{_REST}/>"
    rf"|<(?P<code>script|style)\b{_REST}>(?:.*?</(?P=code)\s*>|[^<]*)|<(?P<raw>{_RAW})\b{_REST}>(?:.*?</(?P=raw)\s*>)?"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>{_REST})>|<[!?][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PIECE = re.compile(r"[a-z]+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("title head".split())  # text in them is no block
#: A start tag that ends open elements of these kinds, up to a container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "body": {"head", "title"},
}
P_ENDS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
NOISE = {
    "nav", "footer", "aside", "form", "dialog",
    "header", "ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "sidebar", "widget", "cookie", "cookies", "consent", "notice",
    "alert", "popup", "modal", "comment", "comments", "disqus", "replies", "respond", "discussion", "related", "share", "social", "newsletter", "subscribe",
    "breadcrumb", "breadcrumbs", "pagination", "menu", "navbar", "navigation", "contentinfo", "complementary", "masthead", "signup", "login", "search",
}
MAIN = {"article", "main", "articlebody"}


@dataclass
class Block:
    text: str
    path: list[tuple[str, tuple[str, ...]]]
    linked: int


def blocks_of(source: str | None) -> list[Block]:
    """Leaf blocks in page order: references decoded, white space to single spaces, empty ones left out."""
    out: list[Block] = []
    if not source:
        return out
    path: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = in_link = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not any(t in HEAD for t, _ in path):
                out.append(Block(text, list(path), linked))
            parts.clear()
        linked = 0

    at = 0
    for m in TOKEN.finditer(source):
        if m.start() > at:
            parts.append(source[at : m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        tag = m.group("tag")
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if m.group("close") else 1
            elif tag in ("br", "wbr", "img", "input"):
                parts.append(" " if tag == "br" else "")
            continue
        flush()
        if m.group("close"):
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == tag:
                    del path[i:]
                    break
            continue
        if tag in P_ENDS and path and path[-1][0] == "p":
            path.pop()
        ends = CLOSES.get(tag)
        while ends and path and path[-1][0] in ends:
            path.pop()
        if tag in VOID or m.group("rest").endswith("/") and tag not in P_ENDS:
            continue
        names = []
        rest = m.group("rest")
        if "=" in rest:
            for groups in NAMES.findall(rest):
                names += PIECE.findall("".join(groups).lower())
        path.append((tag, tuple(names[:12])))
    if at < len(source):
        parts.append(source[at:])
    flush()
    return out


def noisy(path: list[tuple[str, tuple[str, ...]]]) -> bool:
    """A name of the path tells of something beside the text.  Plain forms and the footers of quotations do not."""
    inside = quoted = False
    for tag, names in path:
        here = {tag, *names}
        inside |= bool(here & MAIN)
        quoted |= tag == "blockquote"
        found = here & NOISE
        if found and found != {"form"} and not (inside and tag == "header" or quoted and found == {"footer"}):
            return True
    return False


def said(block: Block) -> bool | None:
    """What the markup says of a block: inside an article, inside something else, or nothing.

    A form around an article is the page's own; one inside an article, or without one, is something else.
    """
    if noisy(block.path):
        return False
    inside = None
    for tag, names in block.path:
        if {tag, *names} & MAIN:
            inside = True
        elif "form" in (tag, *names):
            inside = False
    return inside


TAGS, CLASSES, WORDS, NUMBERS = 32, 48, 24, 15
WIDTH = TAGS + CLASSES + WORDS + NUMBERS
_seen: dict[str, int] = {}


def _bucket(s: str, n: int) -> tuple[int, float]:
    h = _seen.get(s)
    if h is None:
        if len(_seen) > 200_000:
            _seen.clear()
        h = _seen[s] = zlib.crc32(s.encode("utf-8", "replace")) * 0x9E3779B1 & 0xFFFFFFFF
    return (h >> 8) % n, 1.0 if h & 1 else -1.0


def vectors(blocks: list[Block]) -> np.ndarray:
    x = np.zeros((len(blocks), WIDTH), np.float32)
    n = len(blocks)
    held: dict[int, int] = {}  # characters in each form; its entry is one object in all paths
    for b in blocks:
        for e in b.path:
            if e[0] == "form":
                held[id(e)] = held.get(id(e), 0) + len(b.text)
    whole = sum(len(b.text) for b in blocks)
    for i, b in enumerate(blocks):
        row = x[i]
        for depth, (tag, names) in enumerate(reversed(b.path)):
            j, s = _bucket("t:" + tag, TAGS)
            row[j] += s * (1.0 if depth < 4 else 0.5)
            for w in names:
                j, s = _bucket("c:" + w, CLASSES)
                row[TAGS + j] += s
        words = b.text.split(" ")
        if len(words) <= 32:  # the words of a short block tell its kind; of a long one only their shape
            for w in words:
                j, s = _bucket("w:" + w.lower(), WORDS)
                row[TAGS + CLASSES + j] += s / 4
        size = len(b.text)
        row[-NUMBERS:] = (
            np.log1p(size) / 5, np.log1p(len(words)) / 4, min(1.0, b.linked / size), sum(map(b.text.count, ".!?")) / len(words),
            b.text.count(",") / len(words), i / n, 1 - i / n, 1.0, b.path[-1][0] == "p" if b.path else 0, b.path[-1][0] in ("h1", "h2", "h3") if b.path else 0,
            noisy(b.path), any({t, *names} & MAIN for t, names in b.path), any(t == "blockquote" for t, _ in b.path),
            max((1 - held[id(e)] / whole for e in b.path if e[0] == "form"), default=0), sum(e[0] == "form" for e in b.path) / 2,
        )
    return np.clip(x, -3, 3)


def _sigmoid(z):
    return 1 / (1 + np.exp(-z))


@dataclass
class Labeller:
    """Two LSTMs and a logistic output; ``w[d]``: input, state and bias of the four gates of direction d."""

    hidden: int = 16
    seed: int = 7
    w: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None

    def __post_init__(self):
        r = np.random.default_rng(self.seed)
        if not self.w:
            for _ in range(2):
                m = r.normal(0, 0.15, (WIDTH + self.hidden + 1, 4 * self.hidden)).astype(np.float32)
                m[-1, self.hidden : 2 * self.hidden] = 1  # remember at first
                self.w.append(m)
            self.out = r.normal(0, 0.2, 2 * self.hidden + 1).astype(np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, w: np.ndarray, keep: bool):
        """States of one direction over ``x`` (time, batch, width)."""
        t, n, _ = x.shape
        h = self.hidden
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        drive = x @ w[:WIDTH] + w[-1]
        states, trace = np.zeros((t, n, h), np.float32), []
        for i in range(t):
            z = drive[i] + state @ w[WIDTH:-1]
            gates = _sigmoid(z[:, : 3 * h])
            new = np.tanh(z[:, 3 * h :])
            a, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            c = f * cell + a * new
            tc = np.tanh(c)
            if keep:
                trace.append((state, cell, a, f, o, new, tc))
            m = mask[i][:, None]
            cell, state = np.where(m, c, cell), np.where(m, o * tc, state)
            states[i] = state
        return states, trace

    def probabilities(self, x: np.ndarray, mask: np.ndarray):
        ahead, _ = self._pass(x, mask, self.w[0], False)
        back, _ = self._pass(x[::-1], mask[::-1], self.w[1], False)
        return _sigmoid(np.concatenate([ahead, back[::-1]], axis=2) @ self.out[:-1] + self.out[-1])

    def gradients(self, x, mask, y):
        h = self.hidden
        runs = [(x, mask), (x[::-1], mask[::-1])]
        passed = [self._pass(a, m, w, True) for (a, m), w in zip(runs, self.w)]
        both = np.concatenate([passed[0][0], passed[1][0][::-1]], axis=2)
        p = _sigmoid(both @ self.out[:-1] + self.out[-1])
        d = np.where(mask, p - y, 0) / max(1, mask.sum())
        g_out = np.append(np.einsum("tn,tnh->h", d, both), d.sum()).astype(np.float32)
        g_w = []
        for k, ((a, m), (_, trace), w) in enumerate(zip(runs, passed, self.w)):
            own = d[:, :, None] * self.out[k * h : (k + 1) * h]
            own = own[::-1] if k else own
            g = np.zeros_like(w)
            d_state = np.zeros((a.shape[1], h), np.float32)
            d_cell = np.zeros_like(d_state)
            for i in range(len(a) - 1, -1, -1):
                state, cell, gi, gf, go, new, tc = trace[i]
                mm = m[i][:, None]
                ds = own[i] + d_state
                dc = d_cell + ds * go * (1 - tc * tc)
                dz = np.concatenate([dc * new * gi * (1 - gi), dc * cell * gf * (1 - gf), ds * tc * go * (1 - go), dc * gi * (1 - new * new)], axis=1)
                dz = np.where(mm, dz, 0)
                g[:WIDTH] += a[i].T @ dz
                g[WIDTH:-1] += state.T @ dz
                g[-1] += dz.sum(axis=0)
                d_state = np.where(mm, dz @ w[WIDTH:-1].T, ds)
                d_cell = np.where(mm, dc * gf, d_cell)
            g_w.append(g)
        return g_w, g_out

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 10, batch: int = 32, rate: float = 0.01) -> Labeller:
        r = np.random.default_rng(self.seed)
        params = [*self.w, self.out]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        by_size = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        batches = [by_size[i : i + batch] for i in range(0, len(pages), batch)]
        for _ in range(epochs):
            for k in r.permutation(len(batches)):
                x, mask, y = padded([pages[i] for i in batches[k]])
                g_w, g_out = self.gradients(x, mask, y)
                step += 1
                for j, g in enumerate([*g_w, g_out]):
                    g = np.clip(g, -1, 1)
                    first[j] = 0.9 * first[j] + 0.1 * g
                    second[j] = 0.99 * second[j] + 0.01 * g * g
                    params[j] -= rate * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.99**step)) + 1e-6)
        return self


def padded(pages: list[tuple[np.ndarray, np.ndarray]]):
    t = max(len(y) for _, y in pages)
    x, mask, y = np.zeros((t, len(pages), WIDTH), np.float32), np.zeros((t, len(pages)), bool), np.zeros((t, len(pages)), np.float32)
    for i, (a, b) in enumerate(pages):
        x[: len(b), i], mask[: len(b), i], y[: len(b), i] = a, True, b
    return x, mask, y


def composed(good: list[str], r: random.Random) -> tuple[str, list[bool]]:
    """A page in a common layout, made from paragraphs, with the label of each block."""
    labels: list[bool] = []

    def text(short: bool) -> str:
        words = html.escape(r.choice(good)).split()
        n = r.randint(1, 6) if short else r.randint(4, 120)
        k = r.randrange(max(1, len(words) - n))
        return " ".join(words[k : k + n])

    def some(n: int, short: bool, label: bool, tag: str = "p") -> str:
        labels.extend([label] * n)
        return "".join(f"<{tag}>{text(short)}</{tag}>" for _ in range(n))

    def noise(name: str) -> str:
        kind = r.random()
        if kind < 0.4:
            n = r.randint(1, 8)
            labels.extend([False] * n)
            body = "<ul>" + "".join(f'<li><a href="#">{text(True)}</a></li>' for _ in range(n)) + "</ul>"
        elif kind < 0.7:
            body = some(r.randint(1, 5), r.random() < 0.5, False, r.choice(["p", "div", "p"]))
        else:
            body = some(1, True, False, r.choice(["h2", "h3", "h4"])) + some(r.randint(1, 4), r.random() < 0.4, False)
        tag, _, names = name.partition(".")
        how = r.choice(["class", "class", "id"])
        return f'<{tag} {how}="{names}">{body}</{tag}>' if names else f"<{tag}>{body}</{tag}>"

    top = ["nav", "header", "div.header", "div.menu", "div.cookie-notice", "div.ad", "div.banner", "ul.breadcrumbs", "div.masthead", "div.notice", "nav.menu", "div.promo", "form.search"]
    side = ["aside", "div.sidebar", "div.widget", "section.related", "aside.sidebar", "div.ad", "div.newsletter", "form.subscribe", "div.social-share"]
    after = ["footer", "div.footer", "section.comments", "div.comment-list", "div.comments", "section.discussion", "ol.comments", "div.related", "div.cookie-consent", "form", "div.replies"]
    mid = ["aside", "div.ad", "div.share", "div.related", "div.advert", "div.newsletter", "form.signup", "div.promo"]
    out = [noise(r.choice(top)) for _ in range(r.randint(0, 4))]
    if r.random() < 0.3:
        out.append(noise(r.choice(side)))
    main = r.choice(["article", "article", "main", "div.content", "div.article-body", "div.post", "div.entry-content", "section.story", "div.main", "div.text"])
    tag, _, names = main.partition(".")
    inner = []
    if r.random() < 0.8:
        inner.append(some(1, r.random() < 0.5, True, r.choice(["h1", "h1", "h2"])))
    for _ in range(r.randint(1, 12)):
        kind = r.random()
        if kind < 0.12:
            inner.append(noise(r.choice(mid)))
        elif kind < 0.22:
            inner.append(some(1, True, True, r.choice(["h2", "h3"])))
        elif kind < 0.26:
            inner.append("<blockquote>" + some(r.randint(1, 2), False, True) + some(1, True, True, "footer") + "</blockquote>")
        elif kind < 0.32:
            n = r.randint(1, 4)
            labels.extend([True] * n)
            inner.append("<ul>" + "".join(f"<li>{text(False)}</li>" for _ in range(n)) + "</ul>")
        else:
            inner.append(some(1, r.random() < 0.15, True, r.choice(["p", "p", "p", "blockquote"])))
    if r.random() < 0.25:
        inner.append(noise(r.choice(["section.comments", "div.comments", "div.comment-list", "ol.comments"])))
    if r.random() < 0.1:
        inner.append(noise("footer"))
    body = "".join(inner)
    form = "<form " + r.choice(['id="aspnetForm"', 'id="form1" method="post"', 'method="post" action="./"', ""]) + ">"
    wrapped = r.random()
    if wrapped < 0.1:  # a form around the article
        out.append(form)
    out.append(f'<{tag} class="{names}">{body}</{tag}>' if names else f"<{tag}>{body}</{tag}>")
    if wrapped < 0.1:
        out.append("</form>")
    out += [noise(r.choice(side)) for _ in range(r.randint(0, 2))] + [noise(r.choice(after)) for _ in range(r.randint(0, 3))]
    if wrapped > 0.8:  # a form around the page
        out = [form, *out, "</form>"]
    return "<html><body>" + "".join(out) + "</body></html>", labels


@dataclass(frozen=True)
class HtmlOptions:
    """``sample``: pages the training may use at most; ``composed``: pages composed from them; ``epochs``; ``seed``."""

    sample: int = 300
    composed: int = 900
    epochs: int = 8
    seed: int = 7


def fit(sources: list[str], o: HtmlOptions = HtmlOptions()) -> Labeller:
    """Train on pages whose markup names its article, and on pages composed from their texts."""
    r = random.Random(o.seed)
    pages, good = [], ["A page has text. Another sentence follows it, longer than the first one, and then it ends."]
    for s in sources:
        b = blocks_of(s)
        marks = [said(x) for x in b]
        if any(m for m in marks):
            pages.append((vectors(b), np.array([bool(m) for m in marks], np.float32)))
            good += [x.text for x, m in zip(b, marks) if m and len(x.text) > 60]
    for _ in range(o.composed):
        s, labels = composed(good, r)
        b = blocks_of(s)
        if len(b) == len(labels):
            pages.append((vectors(b), np.array(labels, np.float32)))
    return Labeller(seed=o.seed).train(pages, o.epochs)


def main_texts(labeller: Labeller, sources: list[str | None], run: int = 1 << 14) -> list[str]:
    """Main text of each page; pages of like length step through the network together, ``run`` blocks at most."""
    pages = [blocks_of(s) for s in sources]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    i = 0
    while i < len(order):
        n = 1
        while i + n < len(order) and (n + 1) * len(pages[order[i + n]]) <= run:
            n += 1
        batch = order[i : i + n]
        x, mask, _ = padded([(vectors(pages[k]), np.zeros(len(pages[k]))) for k in batch])
        p = labeller.probabilities(x, mask)
        for j, k in enumerate(batch):
            kept = [b.text for b, q in zip(pages[k], p[:, j]) if q >= 0.5]
            out[k] = "\n\n".join(kept)
        i += n
    return out


def _extract(shared, rows: int = 512):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = shared.value
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                texts = main_texts(labeller, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, options: HtmlOptions = HtmlOptions()) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    A null or empty page, and one without any main block, has the text ``""``.  Repeated rows are rows of
    their own; nulls in other columns stay.  No rows give no rows; further columns are ignored.
    """
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    chosen = p.filter("html is not null").select("page_id").orderBy(F.xxhash64("page_id", F.lit(options.seed)), "page_id").limit(options.sample)
    sample = p.join(F.broadcast(chosen.distinct()), "page_id", "left_semi").select("html").limit(options.sample)
    labeller = fit(sorted(r[0] for r in sample.toLocalIterator() if r[0]), options)
    shared = pages.sparkSession.sparkContext.broadcast(labeller)
    return p.mapInArrow(_extract(shared), "page_id long, url string, text string, n_chars long")


@query("op10_html_extraction")
def op10_html_extraction(spark, sf):
    return extract(read(spark, sf, "pages"))
