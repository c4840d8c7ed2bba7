"""HTML extraction: a bidirectional LSTM labels every block of a page as main text or not, with the whole page as context.

A page is cut into blocks: the text between the starts and ends of block elements, with references decoded and white space folded. Each block
is a step of the sequence: a vector of the hashed names on its tag path (elements, words of classes and ids, role), one of its hashed words, and
a few measures (length, share of links, sentence ends). Two LSTMs, written in numpy, read the sequence in both directions; the
label comes from both states and the block itself. Comments, scripts, styles, templates and the head are no blocks.

Labels to learn from: pages whose markup says where the article is (article or main, less what is marked as boilerplate inside) label their
own blocks. At most SAMPLE such pages, those of the least hashes with at most SAMPLE_CHARS characters, are read; each is rewritten VARIANTS times with other
names for its container and with menus, headers, sidebars, notices, adverts, forms and reader comments around and inside, so that the labels
follow names and context rather than one layout. Pages made of random words only are always among them, so that a table without
any such page can be labelled too. The model's size is fixed; it is fitted on the driver and broadcast.

Null and empty html give an empty text. Pages are independent; repeated rows are alike, an empty table is empty, other columns are not read.
A long page costs time in proportion to its length; memory is some 500 bytes a block beside the text. Nothing is dropped or cut but by label.
"""

from __future__ import annotations

import html as markup
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, small_batches, table

SAMPLE, SAMPLE_CHARS, VARIANTS = 240, 1 << 16, 2
TAGS, WORDS, MEASURES, HIDDEN = 384, 32, 8, 16
EPOCHS, RATE, BATCH, SEED = 12, 0.012, 24, 11
#: Steps of padded sequences that are labelled together, and blocks whose vectors are held at once.
STEPS, HELD = 1 << 15, 1 << 12

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = ("script", "style", "template", "noscript", "title", "textarea", "iframe", "svg", "math", "object")
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody"}}
BOUNDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "tbody": {"table"}}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]{0,65536}\"|'[^']{0,65536}')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ENDS = re.compile(r"<(/(?:%s))(?=[\s/>])" % "|".join(HIDDEN_TAGS), re.I)


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int = 0


def names(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    for m in ATTRIBUTE.finditer(attributes):
        out += [f".{x.lower()}" for x in NAME.findall(m[2] or m[3] or m[4] or "")]
    return tuple(out)


def blocks(html: str) -> list[Block]:
    """The blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = at = links = 0

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(tuple(x for _, own in stack for x in own), text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def say(raw: str):
        nonlocal linked
        if raw:
            parts.append(markup.unescape(raw) if "&" in raw else raw)
            if links:
                linked += len(parts[-1])

    def cut(n: int):
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[n:])
        del stack[n:]

    while m := TOKEN.search(html, at):
        say(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            inline = tag in INLINE
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag or (inline and stack[i][0] not in INLINE)), -1)
            if not inline:
                flush()
            if depth >= 0 and stack[depth][0] == tag:
                cut(depth)
            continue
        if tag in HIDDEN_TAGS:
            if not (m[3] or m[6] or "").rstrip().endswith("/"):
                while end := ENDS.search(html, at):
                    at = end.end()
                    if end[1][1:].lower() == tag:
                        break
                else:
                    at = len(html)
                at = max(at, (html.find(">", at) + 1) or len(html))
            parts.append(" ")
            continue
        if tag in VOID:
            if tag in ("br", "hr", "wbr", "img", "input"):
                parts.append("" if tag == "wbr" else " ")
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            p = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), -1)
            if p >= 0 and stack[p][0] == "p":
                cut(p)
            ended = len(stack)
            for i in range(len(stack) - 1, -1, -1) if tag in CLOSES else ():
                if stack[i][0] in BOUNDS[tag]:
                    break
                if stack[i][0] in CLOSES[tag]:
                    ended = i
            cut(ended)
            if tag == "head":
                end = re.compile(r"</head\s*>|<body[\s>]", re.I).search(html, at)
                at = (end.start() if html[end.start() + 1] != "/" else end.end()) if end else at
                continue
        stack.append((tag, names(tag, m[3] or m[6] or "")))
        links += tag == "a"
    say(html[at:])
    flush()
    return out


def _place(name: str) -> int:
    return zlib.crc32(name.encode()) % TAGS


def vectors(own: list[Block]) -> np.ndarray:
    out = np.zeros((len(own), TAGS + WORDS + MEASURES), np.float32)
    for row, b in zip(out, own, strict=True):
        for k, x in enumerate(reversed(b.path)):
            row[_place(x)] += 1.0 if k < 8 else 0.5
        words = b.text.lower().split()
        for w, k in Counter(words).items():
            h = zlib.crc32(w.encode())
            row[TAGS + h % WORDS] += k if h >> 16 & 1 else -k
        row[TAGS : TAGS + WORDS] /= len(words) ** 0.5 * 2
        n = len(b.text)
        row[TAGS + WORDS :] = 1, np.log1p(n) / 6, np.log1p(len(words)) / 5, b.linked / n, sum(w[-1] in ".!?:;" for w in words) / len(words) * 3, b.text[-1] in ".!?…", sum(map(str.isdigit, b.text)) / n, min(1, len(words) / 12)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Direction:
    """One LSTM over (steps, sequences, inputs already multiplied by their weights); ``mask`` is 0 past a sequence's end."""

    @staticmethod
    def forward(z: np.ndarray, mask: np.ndarray, recurrent: np.ndarray, back: bool, keep: bool = False):
        steps, n = z.shape[:2]
        size = recurrent.shape[0]
        h = c = np.zeros((n, size), np.float32)
        out, saved = np.zeros((steps, n, size), np.float32), []
        for t in range(steps - 1, -1, -1) if back else range(steps):
            gates = z[t] + h @ recurrent
            i, f, o = (_sigmoid(gates[:, k * size : (k + 1) * size]) for k in range(3))
            g = np.tanh(gates[:, 3 * size :])
            m = mask[t][:, None]
            now = f * c + i * g
            tanh = np.tanh(now)
            if keep:
                saved.append((t, h, c, i, f, o, g, tanh, m))
            h, c = m * (o * tanh) + (1 - m) * h, m * now + (1 - m) * c
            out[t] = h
        return out, saved

    @staticmethod
    def backward(saved: list, dout: np.ndarray, recurrent: np.ndarray):
        """Gradients of z and of the recurrent weights."""
        steps, n, size = dout.shape
        dz, dw = np.zeros((steps, n, 4 * size), np.float32), np.zeros_like(recurrent)
        dh = dc = np.zeros((n, size), np.float32)
        for t, h, c, i, f, o, g, tanh, m in reversed(saved):
            dh = dh + dout[t]
            own = m * dh
            dnow = own * o * (1 - tanh**2) + m * dc
            gates = np.concatenate((dnow * g * i * (1 - i), dnow * c * f * (1 - f), own * tanh * o * (1 - o), dnow * i * (1 - g**2)), 1)
            dz[t] = gates
            dw += h.T @ gates
            dh, dc = gates @ recurrent.T + (1 - m) * dh, dnow * f + (1 - m) * dc
        return dz, dw


class Labeller:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d = TAGS + WORDS + MEASURES
        w = rng.normal(0, 0.1, (d, 8 * HIDDEN)).astype(np.float32)
        w[:TAGS] = 0  # names never seen say nothing
        bias = np.zeros(8 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = bias[5 * HIDDEN : 6 * HIDDEN] = 1  # gates that remember at first
        out = rng.normal(0, 0.1, (2 * HIDDEN, 1)).astype(np.float32)
        recurrent = rng.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.p = {"w": w, "bias": bias, "there": recurrent[0], "back": recurrent[1], "out": out, "skip": np.zeros((d, 1), np.float32), "off": np.zeros(1, np.float32)}

    def project(self, own: list[Block]) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of both LSTMs and the block's own share of the label."""
        z, s = np.empty((len(own), 8 * HIDDEN), np.float32), np.empty(len(own), np.float32)
        for a in range(0, len(own), HELD):
            x = vectors(own[a : a + HELD])
            z[a : a + HELD], s[a : a + HELD] = x @ self.p["w"] + self.p["bias"], (x @ self.p["skip"])[:, 0]
        return z, s

    def scores(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each block of each page how likely it is main text. Pages of like lengths are read together."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order, at = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i])), 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= STEPS:
                end += 1
            group, at = order[at:end], end
            steps = len(pages[group[-1]])
            z, mask, skip = np.zeros((steps, len(group), 8 * HIDDEN), np.float32), np.zeros((steps, len(group)), np.float32), np.zeros((steps, len(group)), np.float32)
            for k, i in enumerate(group):
                n = len(pages[i])
                z[:n, k], skip[:n, k] = self.project(pages[i])
                mask[:n, k] = 1
            there, _ = Direction.forward(z[..., : 4 * HIDDEN], mask, self.p["there"], False)
            back, _ = Direction.forward(z[..., 4 * HIDDEN :], mask, self.p["back"], True)
            told = _sigmoid(np.concatenate((there, back), 2) @ self.p["out"][:, 0] + skip + self.p["off"][0])
            for k, i in enumerate(group):
                out[i] = told[: len(pages[i]), k]
        return out

    def learn(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Labeller:
        """pages: (vectors, labels). Adam over batches of pages of like lengths, by the cross entropy of all blocks."""
        rng, step = np.random.default_rng(seed), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        groups = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for epoch in range(epochs):
            now = rate * (0.2 if epoch >= epochs * 3 // 4 else 1)
            for g in rng.permutation(len(groups)):
                step += 1
                for k, d in self._gradients([pages[i] for i in groups[g]]).items():
                    first[k] += 0.1 * (d - first[k])
                    second[k] += 0.01 * (d * d - second[k])
                    self.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        return self

    def _gradients(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
        steps, n, p = max(len(y) for _, y in pages), len(pages), self.p
        x, y, mask = np.zeros((steps, n, p["w"].shape[0]), np.float32), np.zeros((steps, n), np.float32), np.zeros((steps, n), np.float32)
        for k, (vector, label) in enumerate(pages):
            x[: len(label), k], y[: len(label), k], mask[: len(label), k] = vector, label, 1
        z = x @ p["w"] + p["bias"]
        there, kept = Direction.forward(z[..., : 4 * HIDDEN], mask, p["there"], False, True)
        back, kept_back = Direction.forward(z[..., 4 * HIDDEN :], mask, p["back"], True, True)
        both = np.concatenate((there, back), 2)
        d = (_sigmoid((both @ p["out"] + x @ p["skip"])[..., 0] + p["off"]) - y) * mask / mask.sum()
        dboth = d[..., None] * p["out"][:, 0]
        dz, dw = Direction.backward(kept, dboth[..., :HIDDEN], p["there"])
        dz_back, dw_back = Direction.backward(kept_back, dboth[..., HIDDEN:], p["back"])
        flat, dall = x.reshape(-1, x.shape[2]), np.concatenate((dz, dz_back), 2).reshape(-1, 8 * HIDDEN)
        weights = flat.T @ dall
        return {"w": weights + 1e-5 * p["w"], "bias": dall.sum(0), "there": dw, "back": dw_back, "out": both.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, 1), "skip": flat.T @ d.reshape(-1, 1) + 1e-5 * p["skip"], "off": d.sum(keepdims=True).reshape(1)}


# Names that containers and boilerplate go by on the web; each entry is the end of a tag path.
MAIN = ["article", "main", "main article", "div .content", "div .post .body", "div .article", "section .story", "div .main .content", "div .entry .content", "div .text", "td", "div .page .content article", "div", ""]
AROUND = {
    "menu": ["nav ul li a", "nav a", "div .menu ul li a", "ul .navigation li a", "div .navbar a", "div .nav ul li a", "div .breadcrumb a", "div .top .bar a", "nav .main .nav ul li a"],
    "header": ["header", "header div .logo", "div .header", "div .masthead h1", "header h1 a", "div .site .header p", "header p", "header h2"],
    "footer": ["footer", "footer p", "div .footer", "div .footer p", "footer ul li a", "div .bottom", "div .copyright", "footer div .legal"],
    "sidebar": ["aside", "aside p", "aside ul li a", "div .sidebar ul li a", "div .sidebar p", "aside h3", "div .widget p", "div .related ul li a", "section .related h3", "aside .related a", "div .teaser p"],
    "notice": ["div .cookie", "div .cookie .banner p", "div .notice", "div .consent p", "div .gdpr .notice", "p .notice", "div .alert", "div .privacy .notice p", "div .disclaimer", "div .popup p", "div .modal p", "section .notice p"],
    "advert": ["div .ad", "div .ads", "div .advert", "div .advertisement p", "aside .ad", "div .sponsored", "div .banner", "div .promo p", "section .sponsor p", "ins .adsbygoogle", "div .ad .slot p", "p .ad"],
    "form": ["form", "form p", "form label", "form button", "div .newsletter form", "form .search", "div .subscribe p", "form fieldset legend", "form select option", "div .login form p", "button"],
    "comments": ["section .comments p", "div .comments div .comment p", "ul .comments li p", "div .comment p", "ol .comment .list li div .comment .body p", "section .comments h2", "div .comment", "div .replies p", "div .disqus p", "section .comments article p", "div .reader .comments p", "section .comments div .comment"],
    "share": ["div .share a", "ul .social li a", "div .social a", "div .tags a", "div .share .buttons"],
}
INSIDE = ("advert", "form", "share", "sidebar", "notice", "comments", "menu", "footer", "header")
BOILERPLATE = frozenset(x for ways in AROUND.values() for w in ways for x in w.split() if x not in {"p", "div", "section", "ul", "li", "a", "h1", "h2", "h3", "article", "ol", "button", ".main", ".top", ".bar", ".site", ".bottom", ".body", ".list", ".banner", ".reader", ".ins", "ins", ".slot"})
PHRASES = {"menu": "home news about contact", "notice": "we use cookies to give you the best experience accept", "form": "name email subscribe send search", "footer": "© all rights reserved privacy imprint", "comments": "reply says", "advert": "advertisement sponsored", "share": "share tweet", "sidebar": "related popular read more", "header": "welcome"}


def labels_of(own: list[Block]) -> np.ndarray | None:
    """What a page's own markup says of its blocks, or null if it does not."""
    ends = [max((i for i, x in enumerate(b.path) if x in ("article", "main")), default=-1) for b in own]
    if max(ends, default=-1) < 0:
        return None
    return np.array([e >= 0 and not BOILERPLATE.intersection(b.path) for b, e in zip(own, ends, strict=True)], np.float32)


def rewritten(own: list[Block], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A page like this with other names, and with boilerplate around and inside its main text."""
    pool = " ".join(b.text for b in own).split() or ["x"]
    container = tuple(MAIN[rng.integers(len(MAIN))].split())
    outer = ("html", "body") + (("div", ".wrapper") if rng.random() < 0.3 else ())

    def boilerplate(kind: str, path: tuple[str, ...]) -> list[tuple[Block, float]]:
        out = []
        for _ in range(rng.integers(1, 4) if rng.random() < 0.6 else 1):
            way = tuple(AROUND[kind][rng.integers(len(AROUND[kind]))].split())
            for _ in range(rng.integers(2, 8) if "a" in way or kind == "comments" else rng.integers(1, 3)):
                n = int(rng.integers(1, 5)) if "a" in way or kind in ("form", "share", "header") else int(rng.integers(3, 60 if kind in ("comments", "sidebar", "notice", "advert") else 15))
                at = int(rng.integers(len(pool)))
                text = " ".join(pool[at : at + n])
                if rng.random() < 0.4:
                    text = f"{PHRASES[kind]} {text}" if rng.random() < 0.5 else PHRASES[kind]
                out.append((Block((*path, *(x for x in way if x != "a")), text, len(text) if way[-1] == "a" else 0), 0.0))  # a link within its block is a share, no part of the path
        return out

    out: list[tuple[Block, float]] = []
    for kind in ("notice", "header", "menu", "advert", "sidebar", "form"):
        if rng.random() < 0.35:
            out += boilerplate(kind, outer)
    every = [i for i, y in enumerate(labels) if y]
    inside = {int(rng.choice(every)): INSIDE[rng.integers(len(INSIDE))] for _ in range(rng.integers(0, 4))} if every else {}
    plain = rng.random() < 0.5
    for i, (b, y) in enumerate(zip(own, labels, strict=True)):
        if y:
            if i in inside:
                out += boilerplate(inside[i], (*outer, *container))
            at = max((k for k, x in enumerate(b.path) if x in ("article", "main")), default=-1)
            tail = b.path[at + 1 :]
            if rng.random() < 0.1:
                tail = [("blockquote", "p"), ("ul", "li"), ("h2",), ("h3",), ("pre",), ("figure", "figcaption"), ("table", "tr", "td"), ("div", "p"), ("ol", "li"), ("section", "p")][rng.integers(10)]
            text = b.text if rng.random() < 0.8 else " ".join(b.text.split()[: rng.integers(1, 30)])
            out.append((Block((*outer, *container, *tail), text, min(b.linked, len(text))), 1.0))
        elif plain:
            out.append((b, 0.0))
    if rng.random() < 0.3:
        out += boilerplate("comments", (*outer, *container) if rng.random() < 0.5 else outer)
    for kind in ("share", "advert", "form", "sidebar", "comments", "menu", "notice", "footer"):
        if rng.random() < 0.3:
            out += boilerplate(kind, outer)
    return [b for b, _ in out], np.array([y for _, y in out], np.float32)


def made(rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A page of random words."""
    words = ["".join(rng.choice(list("aeioulnrst"), rng.integers(1, 9))) for _ in range(200)]
    sentence = lambda n: " ".join(rng.choice(words, n)).capitalize() + "."
    body = ("html", "body", "article")
    own = [Block((*body, "h1"), sentence(6)[:-1])] + [Block((*body, "p"), " ".join(sentence(int(rng.integers(3, 20))) for _ in range(rng.integers(1, 6)))) for _ in range(rng.integers(1, 14))]
    return own, np.ones(len(own), np.float32)


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE, chars: int = SAMPLE_CHARS, **options) -> Labeller:
    """Learns from at most ``sample`` pages that mark their article, of at most ``chars`` characters."""

    @F.arrow_udf("array<struct<path:array<string>,text:string,linked:int,label:float>>")
    def marked(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            own = blocks(x.as_py() or "")
            y = labels_of(own)
            out.append(None if y is None else [{"path": list(b.path), "text": b.text, "linked": b.linked, "label": v} for b, v in zip(own, y.tolist(), strict=True)])
        return pa.array(out, pa.list_(pa.struct([("path", pa.list_(pa.string())), ("text", pa.string()), ("linked", pa.int32()), ("label", pa.float32())])))

    order = F.xxhash64(F.lit("sample"), F.col(f"`{key}`"), F.length(f"`{html}`"))
    short = pages.where((F.length(f"`{html}`") <= chars) & F.lower(F.col(f"`{html}`")).rlike("<(article|main)[\\s>]")).select(order.alias("o"), F.col(f"`{html}`").alias("html"))
    least = [r.o for r in short.select("o").orderBy("o").limit(sample).collect()]
    rows = short.where(F.col("o") <= least[-1]).limit(sample).select("o", marked("html").alias("b")).where("b is not null").collect() if least else []
    rng, learned = np.random.default_rng(SEED), []
    for r in sorted(rows, key=lambda r: r.o):
        own, y = [Block(tuple(b.path), b.text, b.linked) for b in r.b], np.array([b.label for b in r.b], np.float32)
        learned.append((own, y))
        learned += [rewritten(own, y, rng) for _ in range(VARIANTS)]
    for _ in range(max(40, 240 - len(learned))):
        learned.append(rewritten(*made(rng), rng))
    return Labeller().learn([(vectors(own), y) for own, y in learned if own], **options)


def main_text(own: list[Block], scores: np.ndarray) -> str:
    return "\n".join(b.text for b, s in zip(own, scores, strict=True) if s >= 0.5)


def extracted(spark: SparkSession, model: Labeller):
    """A UDF: html -> struct<text, blocks: array<struct<text, path, score>>>."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("text", pa.string()), ("blocks", pa.list_(pa.struct([("text", pa.string()), ("path", pa.string()), ("score", pa.float32())])))])

    @F.arrow_udf("struct<text:string,blocks:array<struct<text:string,path:string,score:float>>>")
    def run(column: pa.Array) -> pa.Array:
        pages = [blocks(x.as_py() or "") for x in column]
        told = shared.value.scores(pages)
        return pa.array([{"text": main_text(own, s), "blocks": [{"text": b.text, "path": " ".join(b.path), "score": v} for b, v in zip(own, s.tolist(), strict=True)]} for own, s in zip(pages, told, strict=True)], kind)

    return run


def texts(spark: SparkSession, model: Labeller):
    """A UDF: html -> main text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(column), 64):  # the blocks of so many pages at a time
            pages = [blocks(x.as_py() or "") for x in column.slice(at, 64)]
            out += [main_text(own, s) for own, s in zip(pages, shared.value.scores(pages), strict=True)]
        told = pa.array(out, pa.string())
        release()
        return told

    return run


def extract(pages: DataFrame, model: Labeller | None = None, key: str = "page_id", html: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """(key, *carry, text, n_chars)"""
    small_batches(pages.sparkSession)
    model = model or fit(pages, key, html)
    out = pages.select(F.col(key), *carry, texts(pages.sparkSession, model)(F.col(html)).alias("text"))
    return out.select(key, *carry, "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
