"""Operator 2: main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks, each with the path of tags (and their class and id words) above it and its text.
A bidirectional LSTM in numpy reads the blocks' vectors (hashed path tokens, hashed words, lengths, share of link text,
place in the page) in page order, so that each block's label depends on the whole page, and marks it as main text or
not. It is trained on about `max_train` pages of the table, chosen by a hash of page_id and labelled by their semantic
tags (inside article or main, outside nav, aside, footer, form ...), and on pages that are put together from their
blocks in many layouts with class names instead of semantic tags, side bars, notices, forms and reader comments.

Text: character references decoded, white space in a block made one blank, blocks joined by two line feeds. Scripts,
styles, templates, the title and form controls carry no block.

Defined cases: a null or empty page, or one without main blocks, gives an empty string and n_chars 0; broken markup is
read as far as it goes (an unclosed script ends with the page); a page with very many blocks is one long sequence;
repeated rows give equal rows; a table without usable training pages leaves the composed pages of built-in words.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varzea.llm.common import bounded_sample, chunks, fields_of, hide, show, table

PATH_DIM, WORD_DIM, STATS, HIDDEN = 128, 32, 10, 16
#: blocks of a page that are scored at once, and characters of the pages that are read together (one page at least)
STRETCH, BATCH_CHARS = 4_096, 2_000_000
DIM = PATH_DIM + WORD_DIM + STATS
#: bounds of the training sample: pages of the table, characters and blocks of each; composed pages
MAX_TRAIN, MAX_TRAIN_CHARS, MAX_TRAIN_BLOCKS, COMPOSED, EPOCHS, BATCH, RATE = 300, 1_000_000, 500, 900, 6, 24, 0.01
# Elements that end a block, elements whose content is no text, void elements.
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
OPAQUE = set("script style template noscript title svg iframe object canvas audio video textarea select button option datalist".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_CLOSE = {t: re.compile(rf"</{t}\s*>", re.I) for t in OPAQUE}


# Tags and class words that mark what is no main text, and what is.
SIDE_TAGS = set("nav aside footer header form menu dialog".split())
SIDE_WORDS = set(
    "ad ads advert advertisement banner promo sponsor sponsored cookie consent notice alert popup modal newsletter subscribe nav navbar menu breadcrumb breadcrumbs sidebar widget related share social comments comment reply respond footer header masthead pagination pager login signup search toolbar copyright legal tags meta".split()
)
MAIN_TAGS, MAIN_WORDS = ("article", "main"), "content article post entry story body text main".split()


class Path:
    """The open tags above a block, a link to the tag above each: tags that are nested very deeply cost no more than others.
    `inside` and `beside` are what the teacher reads off the path; `sum` adds up the tokens' hashed slots."""

    __slots__ = ("above", "tokens", "inside", "beside", "sum")

    def __init__(self, above: Path | None, tokens: tuple[str, ...]):
        self.above, self.tokens, self.sum = above, tokens, None
        self.inside, self.beside = (above.inside, above.beside) if above else (False, False)
        for t in tokens:
            if t in MAIN_TAGS:
                self.inside, self.beside = True, False
            elif t in SIDE_TAGS or (t[0] == "." and t[1:] in SIDE_WORDS):
                self.beside = True

    def last(self, n: int) -> list[str]:
        """The last n tokens."""
        out: list[str] = []
        at = self
        while at and len(out) < n:
            out = [*at.tokens, *out]
            at = at.above
        return out[-n:]

    def vector(self) -> np.ndarray:
        """The sum over all tokens; worked out from the nearest path above that has it."""
        todo, at = [], self
        while at and at.sum is None:
            todo.append(at)
            at = at.above
        total = at.sum if at else np.zeros(PATH_DIM, dtype=np.float32)
        for p in reversed(todo):
            if p.tokens:
                total = total.copy()
                for t in p.tokens:
                    slot, sign = path_slot(t)
                    total[slot] += sign
            if p is not self:  # what lies above is shared by many blocks, the block's own tag by few
                p.sum = total
        return total


def blocks(page: str) -> list[tuple[Path, str, int]]:
    """(path, text, characters of link text) of the leaf blocks in page order."""
    out: list[tuple[Path, str, int]] = []
    root = Path(None, ())
    stack: list[tuple[str, Path]] = []
    is_open: Counter[str] = Counter()
    text: list[str] = []
    linked, at, begun = 0, 0, False
    path = root

    def flush():
        nonlocal text, linked, begun
        said = " ".join(htmllib.unescape("".join(text)).split())
        if said:
            out.append((path, said, min(linked, len(said))))
        text, linked, begun = [], 0, False

    def pop(to: int):
        for name, _ in stack[to:]:
            is_open[name] -= 1
        del stack[to:]

    def close(names: tuple[str, ...], until: tuple[str, ...], deepest: int | None = None):
        """Close the nearest open one of `names`, unless one of `until` is nearer."""
        if not any(is_open[n] for n in names):
            return
        for i in range(len(stack) - 1, -1 if deepest is None else max(-1, len(stack) - 1 - deepest), -1):
            if stack[i][0] in names:
                pop(i)
                return
            if stack[i][0] in until:
                return

    while True:
        m = _TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece:
            if not begun and not piece.isspace():
                path, begun = stack[-1][1] if stack else root, True
            text.append(piece)
            linked += len(piece) if is_open["a"] else 0
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attrs = (m[1], m[3]) if m[2] else (m[4], m[6])
        if name in OPAQUE and not closing:
            if not attrs.rstrip().endswith("/"):
                end = _CLOSE[name].search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in BLOCKS:
            flush()
        elif name in ("br", "img", "input"):
            text.append(" ")
        if closing:
            close((name,), () if name in BLOCKS else ("td", "table", "article", "body"))
        elif name not in VOID and not attrs.rstrip().endswith("/"):
            if name in BLOCKS:  # a new block ends an open paragraph and what is in it
                close(("p",), (), 11)
            if name == "li":
                close(("li",), ("ul", "ol"))
            words = [w for a in _ATTR.findall(attrs) for w in _NAME.findall("".join(a[1:]).lower())]
            stack.append((name, Path(stack[-1][1] if stack else root, (name, *(f".{w}" for w in words)))))
            is_open[name] += 1
    flush()
    return out


def _slot(token: str, size: int) -> tuple[int, float]:
    h = xxhash.xxh64_intdigest(token, 3)
    return (h >> 1) % size, 1.0 if h & 1 else -1.0


_slots: dict[str, tuple[int, float]] = {}


def path_slot(token: str) -> tuple[int, float]:
    at = _slots.get(token)
    if at is None:
        at = _slot(token, PATH_DIM)
        if len(_slots) < 50_000:
            _slots[token] = at
    return at


def vectors(page: list[tuple[Path, str, int]], begin: int = 0, end: int | None = None) -> np.ndarray:
    """A row for each block, or for some of them. Of the path's tokens the last three count fully, the others less."""
    end = len(page) if end is None else min(end, len(page))
    x = np.zeros((end - begin, DIM), dtype=np.float32)
    for i in range(begin, end):
        path, text, linked = page[i]
        row = x[i - begin]
        row[:PATH_DIM] = 0.7 * path.vector()
        for token in path.last(3):
            slot, sign = path_slot(token)
            row[slot] += 0.3 * sign
        words = text.split(" ")
        for w, times in Counter(text.lower().split(" ")).items():
            h = xxhash.xxh64_intdigest(w, 3)
            row[PATH_DIM + (h >> 1) % WORD_DIM] += (1.0 if h & 1 else -1.0) * times / len(words)
        n = len(text)
        ends = text[-1] in ".!?…\"»”"
        row[-STATS:] = (
            np.log1p(n) / 6, np.log1p(len(words)) / 4, linked / n, ends, sum(map(text.count, ".,;:!?")) / len(words), text[0].isupper(),
            i / len(page), (len(page) - i) / len(page), sum(map(text.count, "|©»·")) > 0, np.log1p(len(page)) / 5,
        )
    return x


def _sig(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """A bidirectional LSTM and a logistic output. Sequences are padded at their ends; `mask` marks real blocks."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {}
        for side in "fb":
            self.p[f"W{side}"] = r.normal(0, 1 / np.sqrt(DIM), (DIM, 4 * HIDDEN))
            self.p[f"R{side}"] = r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            self.p[f"c{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.p |= {"O": r.normal(0, 0.2, (2 * HIDDEN, 1)), "S": np.zeros((DIM, 1)), "o": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _step(self, pre, h, c, m, side):
        """The states after a step, and what its gradients need. `pre` is the step's input times its weights, `m` marks real blocks."""
        z = pre + h @ self.p[f"R{side}"]
        i, f, o, g = _sig(z[:, :HIDDEN]), _sig(z[:, HIDDEN : 2 * HIDDEN]), _sig(z[:, 2 * HIDDEN : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        new = f * c + i * g
        tc = np.tanh(new)
        return np.where(m, o * tc, h), np.where(m, new, c), (h, c, i, f, o, g, tc, m)

    def _run(self, x, mask, side, kept=None, h=None, c=None):
        """The hidden states of all steps and the last states, from the states h and c (zeros at a sequence's start). `kept` gets what gradients need."""
        n, steps, _ = x.shape
        h, c = (np.zeros((n, HIDDEN), np.float32) if s is None else s for s in (h, c))
        pre = x @ self.p[f"W{side}"] + self.p[f"c{side}"]
        out = np.zeros((n, steps, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            h, c, cache = self._step(pre[:, t], h, c, mask[:, t : t + 1], side)
            out[:, t] = h
            if kept is not None:
                kept[t] = cache
        return out, h, c

    def forward(self, x, mask, training: bool = False):
        fk, bk = ([None] * x.shape[1] if training else None for _ in range(2))
        both = np.concatenate([self._run(x, mask, "f", fk)[0], self._run(x, mask, "b", bk)[0]], axis=2)
        return _sig((both @ self.p["O"] + x @ self.p["S"] + self.p["o"])[:, :, 0]), (both, fk, bk)

    def label_long(self, page) -> np.ndarray:
        """Probabilities of one page's blocks, STRETCH of them at a time: once forward and once backward, the states carried on."""
        score = np.full(len(page), self.p["o"][0], dtype=np.float32)
        begins = range(0, len(page), STRETCH)
        for side, order, weights in (("f", begins, self.p["O"][:HIDDEN]), ("b", reversed(begins), self.p["O"][HIDDEN:])):
            h = c = None
            for begin in order:
                x = vectors(page, begin, begin + STRETCH)[None]
                out, h, c = self._run(x, np.ones(x.shape[:2], np.float32), side, None, h, c)
                score[begin : begin + STRETCH] += (out @ weights)[0, :, 0] + ((x @ self.p["S"])[0, :, 0] if side == "f" else 0)
        return _sig(score)

    def gradients(self, x, mask, y):
        prob, (both, fk, bk) = self.forward(x, mask, training=True)
        d = ((prob - y) * mask / mask.sum())[:, :, None].astype(np.float32)
        g = {"O": np.einsum("nth,nto->ho", both, d), "S": np.einsum("ntd,nto->do", x, d), "o": d.sum((0, 1))}
        dboth = d @ self.p["O"].T
        for side, kept, dh_out in (("f", fk, dboth[:, :, :HIDDEN]), ("b", bk, dboth[:, :, HIDDEN:])):
            steps = x.shape[1]
            dz_all = np.zeros((x.shape[0], steps, 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((x.shape[0], HIDDEN), np.float32)
            rec = np.zeros_like(self.p[f"R{side}"])
            for t in range(steps - 1, -1, -1) if side == "f" else range(steps):
                h0, c0, i, f, o, gg, tc, m = kept[t]
                dh = dh + dh_out[:, t]
                live = dh * m
                dct = dc * m + live * o * (1 - tc * tc)
                dz = np.concatenate([dct * gg * i * (1 - i), dct * c0 * f * (1 - f), live * tc * o * (1 - o), dct * i * (1 - gg * gg)], axis=1)
                dz_all[:, t] = dz
                rec += h0.T @ dz
                dh = dz @ self.p[f"R{side}"].T + dh * (1 - m)
                dc = dct * f + dc * (1 - m)
            g[f"R{side}"] = rec
            g[f"W{side}"] = np.einsum("ntd,ntk->dk", x, dz_all)
            g[f"c{side}"] = dz_all.sum((0, 1))
        return g

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probabilities of main text, page by page; pages of like length are padded together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and end - begin < 128 and len(pages[order[end]]) <= 1.25 * len(pages[order[begin]]) + 4:
                end += 1
            group = order[begin:end]
            x, mask = padded([pages[i] for i in group])
            prob, _ = self.forward(x, mask)
            for j, i in enumerate(group):
                out[i] = prob[j, : len(pages[i])]
            begin = end
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, DIM), np.float32), np.zeros((len(pages), steps), np.float32)
    for i, p in enumerate(pages):
        x[i, : len(p)], mask[i, : len(p)] = p, 1
    return x, mask


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 3) -> Labeller:
    model, rng = Labeller(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(pages))
        for i in range(0, len(order), BATCH):
            b = order[i : i + BATCH]
            x, mask = padded([pages[j] for j in b])
            y = np.zeros_like(mask)
            for r, j in enumerate(b):
                y[r, : len(labels[j])] = labels[j]
            step += 1
            for k, g in model.gradients(x, mask, y).items():
                g = g / max(1.0, float(np.linalg.norm(g)))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model.p[k] = (model.p[k] - RATE * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def teacher(path: Path) -> float | None:
    """The label by semantic tags: 1 in an article, 0 beside it, None where the tags do not say."""
    return 0.0 if path.beside else 1.0 if path.inside else None


def compose(rng: np.random.Generator, pool: list[str]) -> tuple[str, list[int]]:
    """A page in a random layout, and the label of each of its blocks in order."""
    pick = lambda: pool[rng.integers(len(pool))]
    few = lambda n: " ".join(pick().split(" ")[: 1 + int(rng.integers(n))])
    chance = lambda p: rng.random() < p
    word = lambda options: options[rng.integers(len(options))]
    parts: list[str] = []
    y: list[int] = []

    def add(markup: str, labels: list[int]):
        parts.append(markup)
        y.extend(labels)

    def attribute(w: str) -> str:
        if chance(0.3):  # names that say nothing: the block's text and its place must tell
            w = word([f"c{rng.integers(99)}", "row", "col", "inner", "block", "section", "css", "grid"])
            return f' class="{w}"' if chance(0.7) else ""
        return word([f' class="{w}"', f' id="{w}"', f' class="{w}-{word(["box", "wrap", "list", "top", "main", "area"])}"', f" class='{w} {word(['left', 'clear', 'col'])}'"])

    def menu(tag: str):
        n = int(rng.integers(2, 9))
        items = "".join(f'<li><a href="/{i}">{few(3)}</a></li>' for i in range(n))
        add(f"<{tag}><ul>{items}</ul></{tag.split(' ')[0]}>", [0] * n)

    def side(tag: str, n: int | None = None):
        n = n or int(rng.integers(1, 4))
        add(f"<{tag}>" + "".join(f"<p>{few(24)}</p>" if chance(0.6) else f"<div>{few(12)}</div>" for _ in range(n)) + f"</{tag.split(' ')[0]}>", [0] * n)

    def comments():
        n = int(rng.integers(1, 6))
        outer = word([f"section{attribute(word(['comments', 'respond', 'discussion']))}", f"div{attribute(word(['comments', 'comment', 'replies']))}"])
        add(f"<{outer}>", [])
        if chance(0.6):
            add(f"<h3>{word(['Comments', 'Reader comments', 'Kommentare', 'Commentaires', 'Comentarios', few(3)])}</h3>", [0])
        for _ in range(n):
            k = word(['<p>{}</p>', '<div class="comment"><p>{}</p></div>', '<li class="comment">{}</li>', '<article class="comment"><p>{}</p></article>'])
            add(k.format(few(40)), [0])
        add(f"</{outer.split(' ')[0]}>", [])

    if chance(0.5):
        side(word(["header", f"div{attribute(word(['header', 'masthead', 'top', 'banner']))}"]), 1)
    if chance(0.8):
        menu(word(["nav", "nav", f"div{attribute(word(['menu', 'nav', 'navbar', 'breadcrumb']))}"]))
    if chance(0.5):
        side(f"div{attribute(word(['ad', 'ads', 'advert', 'banner', 'sponsored', 'promo']))}", 1)
    if chance(0.4):
        side(f"div{attribute(word(['cookie', 'notice', 'consent', 'alert', 'popup', 'newsletter']))}", 1)
    if chance(0.25):
        side(word(["aside", f"div{attribute(word(['sidebar', 'widget', 'related']))}"]))
    outer = word(["article", "article", "main", f"div{attribute(word(MAIN_WORDS))}", f"section{attribute(word(MAIN_WORDS))}", "div"])
    add(f"<{outer}>", [])
    if chance(0.85):
        add(f"<h1>{few(12)}</h1>", [1])
    for _ in range(int(rng.integers(1, 12))):
        kind = rng.random()
        if kind < 0.72:
            body = pick()
            add(word([f"<p>{body}</p>", f"<p>{body}</p>", f"<p><b>{body}<br>", f'<p>{body} <a href="#">{few(3)}</a></p>', f"<div>{body}</div>"]), [1])
        elif kind < 0.80:
            add(f"<h2>{few(8)}</h2>", [1])
        elif kind < 0.86:
            add(f"<blockquote>{few(40)}</blockquote>", [1])
        elif kind < 0.92:
            n = int(rng.integers(1, 5))
            add("<ul>" + "".join(f"<li>{few(20)}</li>" for _ in range(n)) + "</ul>", [1] * n)
        elif kind < 0.95:
            side(f"div{attribute(word(['ad', 'advert', 'promo', 'share', 'related', 'newsletter']))}", 1)
        elif kind < 0.97:
            side(word(["aside", f"div{attribute(word(['notice', 'sidebar', 'widget']))}"]), 1)
        else:
            add(f"<table><tr><td>{few(6)}</td><td>{few(6)}</td></tr></table>", [1, 1])
    if chance(0.2):
        comments()
    add(f"</{outer.split(' ')[0]}>", [])
    if chance(0.3):
        comments()
    if chance(0.3):
        add(f"<form{word(['', attribute('search'), attribute('subscribe'), attribute('login')])}><label>{few(4)}</label><p>{few(8)}</p></form>", [0, 0])
    if chance(0.35):
        side(word(["aside", f"div{attribute(word(['sidebar', 'related', 'widget', 'social']))}"]))
    if chance(0.85):
        side(word(["footer", "footer", f"div{attribute(word(['footer', 'copyright', 'legal']))}"]), int(rng.integers(1, 3)))
    body = "".join(parts)
    return (f"<html><body>{body}</body></html>" if chance(0.8) else f"<html><body><div{attribute(word(['page', 'wrapper', 'container', 'site']))}>{body}</div></body></html>"), y


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", max_train: int = MAX_TRAIN, composed: int = COMPOSED) -> Labeller:
    """Train on tagged pages of the table and on composed ones. About `max_train` pages, of up to MAX_TRAIN_CHARS characters and
    MAX_TRAIN_BLOCKS blocks, reach the driver; longer ones are no training pages."""
    usable = pages.filter(F.length(html) <= MAX_TRAIN_CHARS)
    rows = bounded_sample(usable, key, max_train).select(key, html).toPandas().sort_values([key, html])
    rng = np.random.default_rng(17)
    x, y, pool = [], [], []
    for page in rows[html]:
        found = blocks(page)
        said = [teacher(path) for path, _, _ in found]
        pool += [htmllib.escape(t, quote=False) for (_, t, _), s in zip(found, said) if s == 1.0 and " " in t][:40]
        if found and None not in said and len(found) <= MAX_TRAIN_BLOCKS:
            x.append(vectors(found))
            y.append(np.array(said, dtype=np.float32))
    pool = pool or [" ".join(w.capitalize() if i == 0 else w for i, w in enumerate("the house by the river was built when the old bridge fell".split())) + "."]
    for _ in range(composed):
        page, said = compose(rng, pool)
        found = blocks(page)
        if len(found) == len(said):
            x.append(vectors(found))
            y.append(np.array(said, dtype=np.float32))
    return train(x, y)


def extract(pages: DataFrame, model: Labeller, html: str = "html") -> DataFrame:
    """Replace the html column by text, n_chars, n_blocks and n_main."""
    pages, names = hide(pages, html)
    rest = [c for c in pages.columns if c != html]
    shared = pages.sparkSession.sparkContext.broadcast(model)  # some ten thousand floats

    def run(batches):
        m = shared.value
        for pdf in batches:
            for part in (pdf.iloc[c] for c in chunks([p or "" for p in pdf["_html"]], BATCH_CHARS)):
                found = [blocks(p or "") for p in part["_html"]]
                long = [len(b) > STRETCH for b in found]
                short = iter(m.label([vectors(b) for b, k in zip(found, long) if not k]))
                said = [m.label_long(b) if k else next(short) for b, k in zip(found, long)]
                main = [[t for (_, t, _), s in zip(b, p) if s >= 0.5] for b, p in zip(found, said)]
                text = ["\n\n".join(t) for t in main]
                yield part[rest].assign(text=text, n_chars=[len(t) for t in text], n_blocks=[len(b) for b in found], n_main=[len(t) for t in main])

    made = ["text", "n_chars", "n_blocks", "n_main"]
    done = pages.select(*rest, F.col(html).alias("_html")).mapInPandas(run, f"{fields_of(pages, rest)}, text string, n_chars long, n_blocks long, n_main long")
    return done.select(*show(names, html, *made), *made)


def op2_html_bilstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, fit(pages))
