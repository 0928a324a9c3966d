"""Main text of web pages: a bidirectional LSTM labels the leaf blocks of a page in their order."""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Fitted on about so many different pages of up to so many characters, dealt out by a hash.
FIT_PAGES, FIT_CHARS = 600, 200_000
STEPS, PAGES_A_STEP, RATE, SEED = 240, 32, 0.01, 7
# Training ends early once no block of a round is off by more.
GOOD = 0.05
HIDDEN = 12
# A block is a vector: hashed tags and names of its path, hashed words, and four figures.
PATH_SLOTS, WORD_SLOTS = 96, 32
WIDTH = PATH_SLOTS + WORD_SLOTS + 4
# Blocks that are labelled at once, padding included.
CELLS = 20_000

# Elements whose content is no text of the page; those that don't end a block; those
# whose classes describe the whole page; those without content; those that a new block closes; and those
# that it closes them within.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr br img".split()
)
WHOLE_PAGE = ("html", "body")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY_BLOCK = frozenset({"p"})
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}

# Names (of elements, whole classes, ids, roles) that stand for what isn't the article,
# and for what holds it. They label the training blocks.
BESIDE = frozenset(
    "nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement banner sponsor cookie cookies "
    "consent notice notices alert popup modal form search login newsletter subscribe comment comments reply replies share "
    "social related breadcrumb breadcrumbs pagination promo widget button select option label textarea script style head".split()
)
ARTICLE = frozenset("article main content post entry story".split())

# A quote opens a value only right behind "="; elsewhere, as in data-x=don't, it is a character. A tag that
# another one follows before it ends is text, so that every character is looked at a few times at most.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^<>])*+)>|<[!?][^<>]*+>", re.S
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
# Elements nested deeper are taken for neighbours, as browsers do it.
DEPTH = 256


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # tags and names from the outermost element inwards, less those that say nothing here
    linked: int  # characters of the text inside links


def leaf_blocks(page: str | None) -> list[Block]:
    """The blocks of text of a page in order, whatever they are.

    A tag that is not inline ends a block; scripts and the like leave no trace. White space in a block is one blank; character
    references are decoded after the markup is gone. Markup that is left open or closed twice is
    taken as browsers take it in the main cases; nothing here fails on broken pages. Names in
    ``BESIDE`` are left out of the path where their element holds the article (``_holders``).
    """
    page = page or ""
    found_blocks: list[tuple[str, tuple[int, ...], int]] = []
    elements: list[tuple[str, ...]] = []
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    links, linked, at = 0, 0, 0
    within: tuple[int, ...] = ()

    def unstack(depth: int) -> None:
        nonlocal within
        opened.subtract(tag for tag, _ in stack[depth:])
        del stack[depth:]
        within = tuple(element for _, element in stack)

    def finish() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            found_blocks.append((text, within, min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(tag: str) -> None:
        if opened[tag]:
            unstack(max(depth for depth, (name, _) in enumerate(stack) if name == tag))

    while True:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else len(page)]
        if text:
            parts.append(text)
            linked += len(text) if links else 0
        if not token:
            break
        at = token.end()
        if not token[2]:
            continue
        closing, tag = token[1], token[2].lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br":
                parts.append(" ")
            continue
        if tag in RAW:
            end = None if closing else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = at if closing else end.end() if end else len(page)
            continue
        finish()
        if closing:
            close(tag)
        elif tag not in VOID and not token[3].endswith("/"):
            for open_tag in CLOSED_BY_BLOCK:
                if stack and stack[-1][0] == open_tag:
                    unstack(len(stack) - 1)
            if tag in SIBLINGS:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in SIBLINGS[tag]:
                        break
                    if stack[depth][0] == tag:
                        unstack(depth)
                        break
            if len(stack) >= DEPTH:
                continue
            names = [tag]
            if tag not in WHOLE_PAGE:
                for found in _NAMED.finditer(token[3]):
                    names += (found[1] or found[2] or found[3] or "").lower().split()
            stack.append((tag, len(elements)))
            opened[tag] += 1
            within = (*within, len(elements))
            elements.append(tuple(names))
    finish()
    for element in _holders(elements, found_blocks):
        elements[element] = tuple(name for name in elements[element] if name not in BESIDE)
    return [Block(text, tuple(name for e in within for name in elements[e]), n) for text, within, n in found_blocks]


def _holders(elements: list[tuple[str, ...]], blocks: list[tuple[str, tuple[int, ...], int]]) -> list[int]:
    """Elements with a name in ``BESIDE`` that hold the article all the same.

    That is, more than half of the page's text, or at least half of its text in ``ARTICLE`` elements,
    in such elements below them. An aside with a short article of its own holds less.
    """
    beside = {e for e, names in enumerate(elements) if not BESIDE.isdisjoint(names)}
    if not beside:
        return []
    article = {e for e, names in enumerate(elements) if not ARTICLE.isdisjoint(names)}
    held, below = dict.fromkeys(beside, 0), dict.fromkeys(beside, 0)
    total = in_article = 0
    for text, within, _ in blocks:
        total += len(text)
        innermost = max((place for place, e in enumerate(within) if e in article), default=-1)
        in_article += len(text) if innermost >= 0 else 0
        for place, element in enumerate(within):
            if element in beside:
                held[element] += len(text)
                below[element] += len(text) if place < innermost else 0
    return [e for e in beside if 2 * held[e] > total or 0 < in_article <= 2 * below[e]]


def weak_label(path: tuple[str, ...], page_has_article: bool) -> bool:
    """Whether the names on a path speak for the article: the training label."""
    if not BESIDE.isdisjoint(path):
        return False
    return not ARTICLE.isdisjoint(path) if page_has_article else True


@lru_cache(10_000)
def _path_slots(path: tuple[str, ...]) -> np.ndarray:
    return np.unique([crc32(name.encode()) % PATH_SLOTS for name in path]).astype(np.int64)


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: tag path, words and figures."""
    n = len(blocks)
    out = np.zeros((n, WIDTH), np.float32)
    paths = [_path_slots(block.path) for block in blocks]
    out[np.repeat(np.arange(n), list(map(len, paths))), np.concatenate(paths)] = 1.0
    words = [block.text.encode("utf-8", "replace").split(b" ") for block in blocks]
    sizes = np.array(list(map(len, words)))
    slots = np.fromiter((crc32(w) for block in words for w in block), np.int64, sizes.sum()) % WORD_SLOTS
    counts = np.bincount(np.repeat(np.arange(n), sizes) * WORD_SLOTS + slots, minlength=n * WORD_SLOTS)
    out[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = counts.reshape(n, WORD_SLOTS) / sizes[:, None]
    lengths = np.array([len(block.text) for block in blocks])
    out[:, -4] = np.log1p(lengths) / 8
    out[:, -3] = np.log1p(sizes) / 6
    out[:, -2] = np.array([block.linked for block in blocks]) / lengths
    out[:, -1] = np.array([len(block.path) for block in blocks]) / 10
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, mask: np.ndarray, p: dict[str, np.ndarray]):
    """States of one direction over (pages, blocks, width); padding passes the state on."""
    pages, steps, _ = x.shape
    kind = p["w"].dtype
    given = x @ p["w"] + p["b"]
    h, c = np.zeros((pages, HIDDEN), kind), np.zeros((pages, HIDDEN), kind)
    states, kept = np.zeros((pages, steps, HIDDEN), kind), []
    for t in range(steps):
        gates = given[:, t] + h @ p["u"]
        i, f, o = np.split(_sigmoid(gates[:, : 3 * HIDDEN]), 3, axis=1)
        g = np.tanh(gates[:, 3 * HIDDEN :])
        m = mask[:, t : t + 1]
        new_c = f * c + i * g
        new_h = o * np.tanh(new_c)
        kept.append((h, c, i, f, o, g, new_c))
        h, c = m * new_h + (1 - m) * h, m * new_c + (1 - m) * c
        states[:, t] = h
    return states, kept


def _lstm_back(x: np.ndarray, mask: np.ndarray, p: dict[str, np.ndarray], kept: list, d_states: np.ndarray):
    """Gradients of one direction, through time."""
    pages, steps, _ = x.shape
    d_gates = np.zeros((pages, steps, 4 * HIDDEN))
    d_u = np.zeros_like(p["u"])
    dh, dc = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, new_c = kept[t]
        m = mask[:, t : t + 1]
        dh = dh + d_states[:, t]
        in_h, in_c = m * dh, m * dc
        tc = np.tanh(new_c)
        in_c = in_c + in_h * o * (1 - tc * tc)
        gates = np.concatenate(
            [in_c * g * i * (1 - i), in_c * c * f * (1 - f), in_h * tc * o * (1 - o), in_c * i * (1 - g * g)], axis=1
        )
        d_gates[:, t] = gates
        d_u += h.T @ gates
        dh, dc = (1 - m) * dh + gates @ p["u"].T, (1 - m) * dc + in_c * f
    flat = d_gates.reshape(-1, 4 * HIDDEN)
    return {"w": x.reshape(-1, x.shape[2]).T @ flat, "u": d_u, "b": flat.sum(axis=0)}


class Labeller:
    """Bidirectional LSTM and a logistic output for every block."""

    def __init__(self, rng: np.random.Generator) -> None:
        def direction() -> dict[str, np.ndarray]:
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1.0
            return {
                "w": rng.normal(0, 0.15, (WIDTH, 4 * HIDDEN)),
                "u": rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)),
                "b": bias,
            }

        self.ahead, self.back = direction(), direction()
        self.out = {"v": rng.normal(0, 0.3, 2 * HIDDEN), "c": np.zeros(1)}

    def _run(self, x: np.ndarray, mask: np.ndarray):
        ahead, kept_a = _lstm(x, mask, self.ahead)
        back, kept_b = _lstm(x[:, ::-1], mask[:, ::-1], self.back)
        both = np.concatenate([ahead, back[:, ::-1]], axis=2)
        return both, _sigmoid(both @ self.out["v"] + self.out["c"]), kept_a, kept_b

    def gradients(self, x: np.ndarray, mask: np.ndarray, wanted: np.ndarray) -> tuple[list[dict[str, np.ndarray]], float]:
        """Gradients of the mean log loss, and how far the worst block is off."""
        both, p, kept_a, kept_b = self._run(x, mask)
        d = (p - wanted) * mask / max(1.0, mask.sum())
        d_both = d[:, :, None] * self.out["v"]
        out = {"v": (d[:, :, None] * both).sum(axis=(0, 1)), "c": np.array([d.sum()])}
        ahead = _lstm_back(x, mask, self.ahead, kept_a, d_both[:, :, :HIDDEN])
        back = _lstm_back(x[:, ::-1], mask[:, ::-1], self.back, kept_b, d_both[:, ::-1, HIDDEN:])
        return [ahead, back, out], float(np.abs((p - wanted) * mask).max())

    def parameters(self) -> list[dict[str, np.ndarray]]:
        return [self.ahead, self.back, self.out]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Whether each block of each page belongs to the article, by the whole page's blocks."""
        result: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
        at = 0
        while at < len(order):
            upto = at + 1
            while upto < len(order) and (upto - at + 1) * len(pages[order[upto]]) <= CELLS:
                upto += 1
            x, mask = padded([features(pages[i]) for i in order[at:upto]])
            p = self._run(x, mask)[1]
            for row, i in enumerate(order[at:upto]):
                result[i] = p[row, : len(pages[i])] > 0.5
            at = upto
        return result


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((len(rows), steps, WIDTH), np.float32), np.zeros((len(rows), steps), np.float32)
    for i, row in enumerate(rows):
        x[i, : len(row)] = row
        mask[i, : len(row)] = 1
    return x, mask


def train(pages: list[list[Block]]) -> Labeller:
    """Fit the labeller to weak labels, by Adam over small groups of pages of like length."""
    rng = np.random.default_rng(SEED)
    model = Labeller(rng)
    pages = sorted((p for p in pages if p), key=len)
    rows = [features(p) for p in pages]
    wanted = []
    for page in pages:
        has = any(not ARTICLE.isdisjoint(b.path) for b in page)
        wanted.append(np.array([weak_label(b.path, has) for b in page], float))
    groups = [range(a, min(a + PAGES_A_STEP, len(pages))) for a in range(0, len(pages), PAGES_A_STEP)]
    first = [{k: np.zeros_like(v) for k, v in part.items()} for part in model.parameters()]
    second = [{k: np.zeros_like(v) for k, v in part.items()} for part in model.parameters()]
    step, worst = 0, 1.0
    while groups and step < STEPS and worst > GOOD:
        worst = 0.0
        for g in rng.permutation(len(groups)):
            x, mask = padded([rows[i] for i in groups[g]])
            y = np.zeros(mask.shape)
            for r, i in enumerate(groups[g]):
                y[r, : len(wanted[i])] = wanted[i]
            step += 1
            grads, off = model.gradients(x, mask, y)
            worst = max(worst, off)
            for part, grad, m1, m2 in zip(model.parameters(), grads, first, second, strict=True):
                for k, d in grad.items():
                    m1[k] = 0.9 * m1[k] + 0.1 * d
                    m2[k] = 0.999 * m2[k] + 0.001 * d * d
                    part[k] -= RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    for part in model.parameters():  # single precision is enough, and faster, from here on
        part.update({k: v.astype(np.float32) for k, v in part.items()})
    return model


def fit(pages: DataFrame, html_column: str = "html") -> Labeller:
    """A labeller fitted on a bounded sample: about ``FIT_PAGES`` different pages, by a hash.

    Each page counts once however many copies it has, and only pages of up to ``FIT_CHARS`` characters are
    in the sample, so what comes to the driver is bounded. With no pages the labeller is what it began as;
    there is nothing to label then.
    """
    present = pages.select(F.col(html_column).alias("html")).where(F.length("html") <= FIT_CHARS)
    hashed = present.withColumn("hash", F.xxhash64("html"))
    share = min(1.0, FIT_PAGES / max(1, hashed.select("hash").distinct().count()))
    sample = hashed.where(F.pmod("hash", F.lit(1_000_000)) < int(share * 1_000_000))
    texts = sorted(row["html"] for row in sample.dropDuplicates(["hash"]).select("html").limit(2 * FIT_PAGES).collect())
    return train([leaf_blocks(text) for text in texts])


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    """The article of each page, its blocks joined by line ends; empty if there is none.

    Blocks the model takes for the article are checked: none inside an element that can't be one
    (a menu, a form, a footer and so on) stays, unless that element holds the article itself.
    """
    blocks = [leaf_blocks(page) for page in pages]
    labels = model.label(blocks)
    return [
        "\n".join(b.text for b, inside in zip(page, label, strict=True) if inside and BESIDE.isdisjoint(b.path))
        for page, label in zip(blocks, labels, strict=True)
    ]


def main_text(html_column: Column, model: Labeller) -> Column:
    """Main text of a column of pages; NULL and empty pages give an empty text.

    Row by row, nothing is shuffled; repeated rows give equal texts; nothing is cut or capped.
    """

    def extract(column: pd.Series) -> pd.Series:
        return pd.Series(main_texts(list(column), model), dtype=object)

    return F.pandas_udf(extract, "string").asNondeterministic()(html_column)
