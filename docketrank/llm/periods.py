"""Runs of words that repeat with a period, found on a harmonic grid by longest common extensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# A run is at least so many words and so many periods long.
LEAST_WORDS, LEAST_PERIODS = 6, 4
# A difference cover: for any two places, a shift below COVER takes both to places whose remainders
# by COVER are among these.
COVER, MARKS = 16, (0, 1, 2, 5, 8)
# Bounds of what one step holds: words of documents looked at together, grid places.
WORDS_AT_ONCE, PLACES_AT_ONCE = 400_000, 2_000_000

_marked = np.isin(np.arange(COVER), MARKS)
# The smallest shift that takes remainders (a, b) to marked ones.
_SHIFT = np.array([[next(d for d in range(COVER) if _marked[(a + d) % COVER] and _marked[(b + d) % COVER]) for b in range(COVER)] for a in range(COVER)])


def common_words(words: np.ndarray, a: np.ndarray, b: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """How many words from places a and b on are the same, looking at ``upto`` at most."""
    same = np.zeros(len(a), np.int64)
    live = np.flatnonzero(upto > 0)
    while len(live):
        live = live[words[a[live] + same[live]] == words[b[live] + same[live]]]
        same[live] += 1
        live = live[same[live] < upto[live]]
    return same


class Extensions:
    """Longest common extensions in a row of documents, each with a word of its own behind it.

    Only suffixes at marked places are sorted, document by document, over blocks of ``COVER`` words:
    ranks of one block, then by doubling of two, four and so on. The common length of neighbours
    in that order is a table of range minima; two places compare the few words up to where both are
    marked, and look up the rest.
    """

    def __init__(self, words: np.ndarray, owner: np.ndarray, wanted: np.ndarray) -> None:
        self.words = words
        inside = np.arange(len(words) - COVER)
        places = np.flatnonzero(_marked[inside % COVER] & wanted[owner[inside]])
        size = len(places)
        of = owner[places]
        at = np.full(len(words) + 1, -1, np.int64)
        at[places] = np.arange(size)
        # Two words fit one key; the last key sorts first.
        keys = [(words[places + k] << np.int64(31)) | words[places + k + 1] for k in range(COVER - 2, -1, -2)]
        order = np.lexsort((*keys, of))
        fresh = np.zeros(size, bool)
        fresh[1:] = of[order[1:]] != of[order[:-1]]
        for key in keys:
            fresh[1:] |= key[order[1:]] != key[order[:-1]]
        ranks = [self._named(order, fresh)]
        while size and ranks[-1].max() < size - 1:
            step = COVER << (len(ranks) - 1)
            behind = at[np.minimum(places + step, len(words))]
            rank = ranks[-1]
            key = rank * (size + 1) + np.where(behind >= 0, rank[behind], -1) + 1
            order = np.argsort(key, kind="stable")
            ranks.append(self._named(order, np.r_[False, key[order[1:]] != key[order[:-1]]]))
        self.at, self.rank = at, ranks[-1]
        first, second = places[order[:-1]], places[order[1:]]
        together = of[order[:-1]] == of[order[1:]] if size else np.zeros(0, bool)
        same = np.zeros(max(0, size - 1), np.int64)
        for level in range(len(ranks) - 2, -1, -1):
            a, b = at[np.minimum(first + same, len(words))], at[np.minimum(second + same, len(words))]
            more = together & (a >= 0) & (b >= 0)
            more[more] = ranks[level][a[more]] == ranks[level][b[more]]
            same[more] += COVER << level
        same += common_words(words, first + same, second + same, np.where(together, COVER, 0))
        self.minima = [same]
        while 2 << (len(self.minima) - 1) <= len(same):
            half = 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(self.minima[-1][:-half], self.minima[-1][half:]))

    @staticmethod
    def _named(order: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        rank = np.zeros(len(order), np.int64)
        rank[order] = np.cumsum(fresh)
        return rank

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words from different places a and b of the same wanted documents on."""
        shift = _SHIFT[a % COVER, b % COVER]
        same = common_words(self.words, a, b, shift)
        far = np.flatnonzero(same == shift)
        ra, rb = self.rank[self.at[a[far] + shift[far]]], self.rank[self.at[b[far] + shift[far]]]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        level = np.frexp(high - low)[1] - 1
        found = np.empty(len(far), np.int64)
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            found[here] = np.minimum(self.minima[k][low[here]], self.minima[k][high[here] - (1 << k)])
        same[far] += found
        return same


class _Direction:
    """Extensions of pairs of places in one direction; the index is built for documents that need it only."""

    def __init__(self, words: np.ndarray, owner: np.ndarray) -> None:
        self.words, self.owner = words, owner

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same = common_words(self.words, a, b, np.full(len(a), COVER))
        far = np.flatnonzero(same == COVER)
        if len(far):
            wanted = np.zeros(int(self.owner.max()) + 1, bool)
            wanted[self.owner[a[far]]] = True
            same[far] = Extensions(self.words, self.owner, wanted)(a[far], b[far])
        return same


def _grid(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document, place and period of every grid place: places 3 periods apart for each period.

    A run is 4 periods long at least, so for its period some grid place has its partner, one period
    on, in the run as well. Sums over periods of n / period: about n log n / 3 places a document.
    """
    most = np.where(sizes >= LEAST_WORDS, sizes // LEAST_PERIODS, 0)
    doc = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    gap = LEAST_PERIODS - 1
    count = (sizes[doc] - 1 - period) // (gap * period) + 1
    upto = np.cumsum(count)
    at = 0
    while at < len(doc):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PLACES_AT_ONCE, side="right")))
        times = count[at:end]
        d, q = np.repeat(doc[at:end], times), np.repeat(period[at:end], times)
        k = np.arange(len(d)) - np.repeat(np.cumsum(times) - times, times)
        yield d, starts[d] + k * gap * q, q
        at = end


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all documents: document, start (a word number in it), length and smallest period.

    ``words`` holds the documents' words one after the other as numbers from 0, ``sizes`` how many each
    has. A run is a stretch that keeps its smallest period (words a period apart are the same), is
    ``LEAST_WORDS`` and ``LEAST_PERIODS`` periods long at least, and that no word beside it extends.
    Ordered by document, start and period.
    """
    docs = np.arange(len(sizes))
    # A word of its own before, between and behind the documents, and some more at the end.
    own = int(words.max()) + 1 if len(words) else 0
    line = np.empty(len(words) + len(sizes) + 1 + COVER, np.int64)
    inner = np.repeat(docs, sizes) + 1 + np.arange(len(words))
    edge = np.ones(len(line), bool)
    edge[inner] = False
    line[inner] = words
    line[edge] = own + np.arange(int(edge.sum()))
    owner = np.r_[0, np.repeat(docs, sizes + 1), np.full(COVER, len(docs))]
    body = len(line) - COVER
    forward = _Direction(line, owner)
    backward = _Direction(
        np.r_[line[:body][::-1], line[body:]], np.r_[0, np.repeat(docs[::-1], sizes[::-1] + 1), np.full(COVER, len(docs))]
    )
    starts = np.cumsum(sizes + 1) - sizes
    found = []
    for doc, place, period in _grid(sizes, starts):
        hit = line[place] == line[place + period]
        doc, place, period = doc[hit], place[hit], period[hit]
        ahead = forward(place, place + period)
        behind = backward(body - place, body - place - period)
        length = ahead + behind + period
        run = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append(np.stack([doc[run], (place - behind)[run] - starts[doc[run]], length[run], period[run]]))
    doc, start, length, period = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    # A stretch found for a multiple of its smallest period is the same stretch, so the smallest stays.
    order = np.lexsort((period, length, start, doc))
    doc, start, length, period = doc[order], start[order], length[order], period[order]
    again = np.zeros(len(doc), bool)
    again[1:] = (doc[1:] == doc[:-1]) & (start[1:] == start[:-1]) & (length[1:] == length[:-1])
    doc, start, length, period = (x[~again] for x in (doc, start, length, period))
    order = np.lexsort((period, start, doc))
    return doc[order], start[order], length[order], period[order]


def dropped_words(size: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words of a document lie in a run behind its first period."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:-1]) > 0


def _group(texts: list[bytes]) -> Iterator[tuple[list[dict], str]]:
    numbers: dict[bytes, int] = {}
    split = [text.split() for text in texts]
    words = np.array([numbers.setdefault(word, len(numbers)) for one in split for word in one], np.int64)
    doc, *found = find_runs(words, np.array([len(one) for one in split], np.int64))
    bounds = np.searchsorted(doc, np.arange(len(split) + 1))
    for i, one in enumerate(split):
        start, length, period = (x[bounds[i] : bounds[i + 1]] for x in found)
        if len(start):
            gone = dropped_words(len(one), start, length, period)
            one = [word for word, out in zip(one, gone.tolist(), strict=True) if not out]
        rows = zip(start.tolist(), length.tolist(), period.tolist(), strict=True)
        yield [{"start": s, "length": n, "period": p} for s, n, p in rows], b" ".join(one).decode()


def _found(texts: pd.Series) -> tuple[list[list[dict]], list[str]]:
    runs: list[list[dict]] = []
    collapsed: list[str] = []
    waiting: list[bytes] = []
    held = 0

    def look() -> None:
        for found, text in _group(waiting):
            runs.append(found)
            collapsed.append(text)
        waiting.clear()

    for text in texts:
        waiting.append((text or "").encode("utf-8", "replace"))
        # A word takes two bytes at least, with what parts it from the next.
        held += len(waiting[-1]) // 2
        if held >= WORDS_AT_ONCE:
            look()
            held = 0
    look()
    return runs, collapsed


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``runs`` (start, length and period in words, by start and period) and ``collapsed`` of every row.

    Words lie between ASCII white space, numbered from 0. A run is a longest stretch of words with a
    smallest period (words a period apart are identical), of 6 words and 4 periods at least. In
    ``collapsed``, words joined by one blank, a run's words behind its first period are left out. NULL, empty
    and short texts have no runs. Documents don't touch each other; a text of any length is read whole.
    Ids, repeated or NULL, only come along; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs, collapsed = _found(batch["text"])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "runs": runs, "collapsed": collapsed})

    return rows.mapInPandas(each, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
