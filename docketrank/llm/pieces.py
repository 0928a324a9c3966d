"""SentencePiece encoding as relations: a lattice of substrings joined to the piece table, then a fold."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, ByteType, IntegerType, LongType, StringType, StructField, StructType

from docketrank.llm.common import let

# Fixed value: what stands for a blank in pieces.
BLANK = "▁"
# Where words are cut: before runs of blanks, around line ends. Java and Python read it alike.
WORD = f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n"
# Stands between words while a text is cut by plain replacements; texts that hold it are cut by the pattern.
MARK = "\x00"
# Replacements that put the mark where ``WORD`` cuts. Joining blanks twice joins runs of any length.
CUTS = ((BLANK, " "), (" ", MARK + BLANK), *[(BLANK + MARK + BLANK, BLANK + BLANK)] * 2, ("\n", MARK + "\n" + MARK))
# Documents are encoded in groups of about so many characters; a group knows each of its words once.
GROUP_CHARS = 4_000_000
# A task knows so many parts of words before it forgets them all; what it knows has its lattice made once.
KNOWN_PARTS = 600_000
# Edges are small: they travel in batches of so many rows, texts in batches of so many bytes.
EDGE_ROWS, BATCH_BYTES = 50_000, 1 << 20
# What a row is on the way from the cut texts to the ids: a word with its edges, parts of words in
# the order of their numbers, parts that are numbered from 0 again, a document as numbers of parts.
EDGES, PARTS, PARTS_ANEW, DOCUMENT = range(4)
# Longer words have their lattice made in overlapping windows of so many code points.
WINDOW = 64
# Words are merged together as long as their tables of edges have no more than so many cells.
TABLE_CELLS = 1_000_000
# Fixed value: the seed of Spark's xxhash64.
HASH_SEED = 42
# Score of a character without a piece, below the least score of the table.
UNKNOWN_BELOW = 10.0


class PieceModel(NamedTuple):
    """A SentencePiece model: pieces with ids and scores, and the id of the first byte piece."""

    kind: str  # "unigram" or "bpe"
    pieces: tuple[tuple[str, int, float], ...]
    first_byte: int
    longest: int


@cache
def load_model(path: str) -> PieceModel:
    """Read a model file; it has to use the identity normaliser, byte fallback and a blank in front."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    spec = proto.normalizer_spec
    if not (proto.trainer_spec.byte_fallback and spec.add_dummy_prefix) or spec.remove_extra_whitespaces or spec.precompiled_charsmap:
        raise ValueError("only models with byte fallback, a dummy prefix and no normalisation are supported")
    sp = SentencePieceProcessor(model_proto=proto.SerializeToString())
    normal = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    pieces = tuple((sp.id_to_piece(i), i, float(sp.get_score(i))) for i in normal)
    inner = [p for p, _, _ in pieces if len(p) > 1 and ("\n" in p or BLANK in p.lstrip(BLANK))]
    if inner:
        raise ValueError("pieces that hold line ends or blanks inside need another way of cutting words")
    if max(len(p) for p, _, _ in pieces) > WINDOW // 2 or sp.get_piece_size() >= 1 << 24:
        raise ValueError("only models of up to 2^24 pieces of up to half a window are supported")
    return PieceModel(
        "bpe" if proto.trainer_spec.model_type == 2 else "unigram",
        pieces,
        sp.piece_to_id("<0x00>"),
        max(len(p) for p, _, _ in pieces),
    )


def public_model() -> PieceModel:
    import public_tokenizers

    return load_model(public_tokenizers.path("piece_bpe_32k.model"))


def words_of(text: Column) -> Column:
    """A text cut where no piece can reach across, before runs of blanks and around line ends; some words are empty."""
    marked = F.concat(F.lit(BLANK), F.replace(text, F.lit(" "), F.lit(BLANK)))
    cut = F.concat(F.lit(" "), text)
    for old, new in CUTS:
        cut = F.replace(cut, F.lit(old), F.lit(new))
    words = F.when(F.contains(text, F.lit(MARK)), F.regexp_extract_all(marked, F.lit(WORD), F.lit(0))).otherwise(F.split(cut, MARK))
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(words)


@cache
def _breaks(model: PieceModel) -> tuple[str, str]:
    """Letters of the model's pieces, and its other characters that follow none of these in any piece.

    So no piece holds one of the first and then one of the second: every path breaks between them.
    Of the first 256 characters only: Java looks these up in a set of bits, others one after another.
    """
    letters = {c for piece, _, _ in model.pieces for c in piece if c.isalpha() and c < "\u0100"}
    others = {c for piece, _, _ in model.pieces for c in piece if not c.isalpha() and c < "\u0100"}
    others -= {b for piece, _, _ in model.pieces for a, b in zip(piece, piece[1:]) if a in letters}
    return "".join(sorted(letters)), "".join(sorted(others))


def parts_of(word: Column, model: PieceModel) -> Column:
    """A word cut where every path breaks (``_breaks``); what words have in common has one lattice."""
    before, after = ("".join(f"\\x{{{ord(c):x}}}" for c in chars) for chars in _breaks(model))
    return F.split(word, f"(?<=[{before}])(?=[{after}])") if before and after else F.array(word)


def windows_of(word: Column, longest: int) -> Column:
    """The windows of a word, each different one once: every piece in the word lies whole in one of them.

    A word of up to ``WINDOW`` code points is its own window.
    """
    stride = WINDOW - longest + 1
    strides = F.regexp_extract_all(word, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    windows = let(
        strides,
        lambda parts: F.transform(
            parts, lambda part, i: F.concat(part, F.coalesce(F.substring(F.get(parts, i + 1), 1, longest - 1), F.lit("")))
        ),
    )
    return F.when(F.length(word) <= WINDOW, F.array(word)).otherwise(F.array_distinct(windows))


def edges_of(words: DataFrame, model: PieceModel) -> DataFrame:
    """The columns of ``words`` with ``start``, ``size``, ``score`` and ``edge`` (see ``_codes``) of every edge.

    Substrings of bounded length of the column ``word`` are exploded and joined to the piece table, a
    table of the vocabulary's size: by their hash, which is quick to look up, and then their text.
    Substrings that are no piece, and words that are NULL or too short, have a row without an edge. Merging
    starts from single characters, so for BPE models only longer pieces are edges.
    """
    smallest = 2 if model.kind == "bpe" else 1
    ranks = _ranks(model)
    table = words.sparkSession.createDataFrame(
        [(piece, score, ranks[score] << 24 | i) for piece, i, score in model.pieces], "piece string, score double, code long"
    ).select("piece", "score", "code", F.xxhash64("piece").alias("key"))
    last = F.length("word") - smallest + 1
    starts = words.select("*", F.explode_outer(F.when(last >= 1, F.sequence(F.lit(1), last))).alias("start"))
    upto = F.least(F.lit(model.longest), F.length("word") - F.col("start") + 1)
    parts = starts.select("*", F.explode_outer(F.when(F.col("start").isNotNull() & (upto >= smallest), F.sequence(F.lit(smallest), upto))).alias("size"))
    named = parts.select("*", F.substring("word", F.col("start"), F.col("size")).alias("said_there"))
    named = named.withColumn("key", F.when(F.col("size").isNotNull(), F.xxhash64("said_there")))
    joined = named.join(F.broadcast(table), "key", "left")
    place = F.shiftleft(((F.col("start") - 1) * WINDOW + F.col("size")).cast("long"), 48)
    edge = F.when(F.col("said_there") == F.col("piece"), place.bitwiseOR(F.col("code")))
    return joined.select(*words.columns, "start", "size", "score", edge.alias("edge"))


@cache
def _ranks(model: PieceModel) -> dict[float, int]:
    """Scores by their order, the highest first; equal scores are one."""
    return {score: rank for rank, score in enumerate(sorted({score for _, _, score in model.pieces}, reverse=True))}


def _codes(codes: list[int], at: int = 0) -> dict[int, tuple[int, int]]:
    """Edges by place, ``(start - 1) * WINDOW + size``, with rank and id: what stands in the bits from 48, 24 and 0."""
    return {(at * WINDOW) + (code >> 48): (code >> 24 & 0xFFFFFF, code & 0xFFFFFF) for code in codes}


def _viterbi_starts(n: Column, edges: Column, worst: float) -> Column:
    """The path with the best sum of scores: a fold over the ends of edges, left to right.

    The state holds, for every position so far, the best score and the size of the last edge;
    of equal paths the one with the longer last piece wins. A character without a piece is an
    edge by itself with a score below all others. The result is where the path's parts begin,
    and an end mark.
    """
    unknown = worst - UNKNOWN_BELOW

    def step(state: Column, end: Column) -> Column:
        ending = F.filter(edges, lambda e: e["start"] + e["size"] == end + 1)
        reach = F.transform(
            ending,
            lambda e: F.struct(
                (F.get(state, e["start"] - 1)["score"] + e["score"]).alias("score"), e["size"].alias("size")
            ),
        )
        single = F.struct((F.get(state, end - 1)["score"] + F.lit(unknown)).alias("score"), F.lit(1).alias("size"))
        return F.concat(state, F.array(F.coalesce(F.array_max(reach), single)))

    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("size")))
    states = F.aggregate(F.sequence(F.lit(1), n), start, step)

    def back(states: Column) -> Column:
        def earlier(starts: Column, _: Column) -> Column:
            at = F.get(starts, F.lit(0))
            return F.when(at > 1, F.concat(F.array(at - F.get(states, at - 1)["size"]), starts)).otherwise(starts)

        return F.aggregate(F.sequence(F.lit(1), n), F.array(n + 1), earlier)

    return let(states, back)


def coded_words(words: DataFrame, model: PieceModel) -> DataFrame:
    """What the documents of a group (``home``) need of its words' lattices, for unigram models; longer words go as their windows.

    Edges are gathered by word, with ``starts`` by the fold. Words without an edge have no row.
    """
    window = (F.length("word") > WINDOW).alias("window")
    cut = words.select("home", F.explode(windows_of(F.col("word"), model.longest)).alias("part_of"), window)
    edges = edges_of(cut.withColumnRenamed("part_of", "word"), model).where("edge IS NOT NULL")
    scored = F.collect_list(F.struct("start", "size", "score")).alias("scored")
    found = edges.groupBy("home", "word").agg(F.collect_set("edge").alias("edges"), scored, F.min("window").alias("window"))
    worst = min(score for _, _, score in model.pieces)
    starts = F.when(~F.col("window"), _viterbi_starts(F.length("word"), F.col("scored"), worst))
    return found.select("home", F.xxhash64("word").alias("hash"), "edges", starts.alias("starts"))


def _merged(n: int, codes: np.ndarray, owner: np.ndarray, points: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """What byte-pair merging leaves of words of ``n`` characters: tokens one after another, and how many each word has.

    In each step, in every word, the pair of neighbours joins whose union is the piece of the best
    rank, of equal ones the leftmost. ``codes`` are edges of the words ``owner``; ``points`` has the
    code points, a row a word. A token is an id, or the complement of the code point of a single character.
    """
    count, none, width = len(points), 1 << 24, longest + 2
    table = np.full(count * n * width, none << 24, "int64")
    start, size = np.divmod(codes >> 48, WINDOW)
    table[(owner * n + start) * width + size] = codes & ((1 << 48) - 1)

    def ranks(row: np.ndarray, begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = table[(row * n + np.minimum(begin, n - 1)) * width + np.minimum(end - begin, longest + 1)] >> 24
        return np.where(middle < n, found, none)

    # Where parts begin, then ``n`` for the rest, and the ranks of neighbours; both of the words that still change.
    left, places = np.arange(count), np.arange(n + 2)
    now = np.minimum(np.tile(places, (count, 1)), n)
    rank = ranks(left[:, None], now[:, :-3], now[:, 1:-2], now[:, 2:-1])
    cuts = now[:, :-1].copy()
    while n > 1 and len(left):
        best = rank.argmin(axis=1)
        joins = rank[np.arange(len(left)), best] < none
        cuts[left[~joins]] = now[~joins, :-1]
        left, now, rank, best = left[joins], now[joins], rank[joins], best[joins]
        after = places <= best[:, None]
        now[:, :-1] = np.where(after[:, :-1], now[:, :-1], now[:, 1:])
        rank[:, :-1] = np.where(after[:, 1 : n - 1], rank[:, :-1], rank[:, 1:])
        rank[:, -1] = none
        row = np.arange(len(left))
        # Only the joined part's pairs with its neighbours are new.
        rank[row, best] = np.where(best < n - 1, ranks(left, *(now[row, np.minimum(best + k, n + 1)] for k in range(3))), none)
        row, inner = row[best > 0], best[best > 0] - 1
        rank[row, inner] = ranks(left[row], *(now[row, inner + k] for k in range(3)))
    word, at = np.nonzero(cuts[:, :-1] < n)
    begin, size = cuts[word, at], cuts[word, at + 1] - cuts[word, at]
    joined = table[(word * n + begin) * width + np.minimum(size, longest + 1)] & 0xFFFFFF
    return np.where(size == 1, ~points[word, begin].astype("int64"), joined), np.bincount(word, minlength=count)


def _long_merged(n: int, edges: dict[int, tuple[int, int]]) -> list[int]:
    """As ``_merged``, with a heap of pairs, for one long word; where its parts begin, places counted from 0."""
    before, after = list(range(-1, n)), list(range(1, n + 2))
    alive = [True] * n

    def pair(start: int) -> tuple[int, int, int] | None:
        if start < 0 or after[start] >= n:
            return None
        end = after[after[start]]
        hit = edges.get(start * WINDOW + min(end - start, WINDOW - 1))
        return hit and (hit[0], start, end)

    heap = [p for p in map(pair, range(n)) if p]
    heapq.heapify(heap)
    while heap:
        _, start, end = heapq.heappop(heap)
        middle = after[start]
        if not alive[start] or middle >= n or after[middle] != end:
            continue
        alive[middle] = False
        after[start] = end
        before[end] = start
        for p in (pair(before[start]), pair(start)):
            if p:
                heapq.heappush(heap, p)
    return [i for i in range(n) if alive[i]]


def _long_viterbi(n: int, edges: dict[int, tuple[int, int]], scores: list[float], longest: int) -> list[int]:
    """As ``_viterbi_starts`` for a long word; places count from 0."""
    best = [(0.0, 0)]
    for end in range(1, n + 1):
        reach = [
            (best[end - k][0] + scores[edges[(end - k) * WINDOW + k][0]], k)
            for k in range(1, min(longest, end) + 1)
            if (end - k) * WINDOW + k in edges
        ]
        best.append(max(reach) if reach else (best[end - 1][0] + scores[-1] - UNKNOWN_BELOW, 1))
    starts, at = [], n
    while at:
        at -= best[at][1]
        starts.append(at)
    return starts[::-1]


def _joined(flat: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``flat`` for a list of numbers, one after another, and how many each number has.

    Number ``i`` stands for the entries up to ``ends[i]`` from those of the number before.
    """
    counts = np.diff(ends, prepend=0)[numbers]
    jump = np.repeat(ends[numbers] - np.cumsum(counts), counts)
    return flat[jump + np.arange(len(jump))], counts


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, as ``words_of`` cuts them, and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    marked = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    for old, new in CUTS:
        marked = pc.replace_substring(marked, old, new)
    lists = pc.split_pattern(marked, MARK)
    odd = pc.match_substring(texts, MARK)
    if pc.any(odd).as_py():
        word = re.compile(WORD)
        by_pattern = [
            word.findall(BLANK + text.replace(" ", BLANK)) if by else cut.as_py()
            for text, by, cut in zip(texts.to_pylist(), odd.to_pylist(), lists, strict=True)
        ]
        lists = pa.array(by_pattern, lists.type)
    words, sizes = lists.flatten(), lists.value_lengths().to_numpy()
    some = pc.and_(pc.greater(pc.binary_length(words), 0), pa.array(np.repeat(pc.binary_length(texts).to_numpy() > 0, sizes)))
    row = np.repeat(np.arange(len(texts)), sizes)[some.to_numpy(zero_copy_only=False)]
    return words.filter(some), np.bincount(row, minlength=len(texts))


def _utf8(words: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of all words one after another, and where each begins, with an end mark; no word may be NULL."""
    _, offsets, data = words.cast(pa.large_string()).buffers()
    offsets = np.frombuffer(offsets, "int64")[words.offset : words.offset + len(words) + 1]
    return (data or pa.py_buffer(b""))[int(offsets[0]) : int(offsets[-1])], offsets - offsets[0]


def _split_up(words: pa.Array, breaks: tuple[str, str]) -> tuple[pa.Array, np.ndarray]:
    """The parts of all words one after another, cut as by ``parts_of``, and where each word's end."""
    data, _ = _utf8(words)
    points = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), "uint32")
    word_ends = np.cumsum(pc.utf8_length(words).to_numpy())
    before, after = (np.array(list(map(ord, chars)), "uint32") for chars in breaks)
    ends = np.isin(points, before, kind="table")
    ends[:-1] &= np.isin(points[1:], after, kind="table")
    ends[word_ends - 1] = True
    part_ends = np.flatnonzero(ends) + 1
    begins = np.append(np.flatnonzero((np.frombuffer(data, "uint8") & 0xC0) != 0x80), len(data))
    offsets = begins[np.concatenate([[0], part_ends])].astype("int64")
    parts = pa.LargeStringArray.from_buffers(len(part_ends), pa.py_buffer(offsets), pa.py_buffer(data))
    return parts, np.searchsorted(part_ends, word_ends, "right")


@cache
def _spelled(model: PieceModel) -> tuple[dict[int, str], np.ndarray]:
    """The pieces by id, as texts and as rows of code points."""
    piece = {i: piece for piece, i, _ in model.pieces}
    points = np.zeros((1 + max(piece), model.longest), "uint32")
    for i, text in piece.items():
        points[i, : len(text)] = list(map(ord, text))
    return piece, points


class _Parts:
    """The ids of a group's parts of words, by the edges that the joins found.

    Words are found by their hash (Spark's ``xxhash64``), and every edge is checked against the word's
    text, so words that share a hash get their own edges. A token is an id, or the complement
    of the code point of a character that no edge covers.
    """

    def __init__(self, coded: pa.Table, model: PieceModel):
        self.model, self.scores = model, sorted(_ranks(model), reverse=True)
        hashes = coded["hash"].to_numpy()
        self.starts: dict[int, list] = {}
        if model.kind == "bpe":
            codes = coded["edge"].to_numpy()
        else:
            edges = pa.concat_arrays([*coded["edges"].chunks, pa.array([], coded["edges"].type)])
            for number, starts in zip(hashes.tolist(), coded["starts"].to_pylist()):
                self.starts.setdefault(number, []).append(starts)
            hashes, codes = np.repeat(hashes, edges.value_lengths().to_numpy()), edges.flatten().to_numpy()
        order = np.argsort(hashes, kind="stable")
        self.codes = codes[order]
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.ends = np.append(first, len(codes))
        self.piece, self.spelled = _spelled(model)

    def _rows(self, words: pa.Array) -> np.ndarray:
        """Where the edges of words are; -1 for words without any."""
        data, offsets = _utf8(words)
        said, places = data.to_pybytes(), offsets.tolist()
        wanted = np.array([xxhash.xxh64_intdigest(said[a:b], HASH_SEED) for a, b in zip(places, places[1:])], "uint64").view("int64")
        if not len(self.hashes):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return np.where(self.hashes[at] == wanted, at, -1)

    def _edges(self, word: str, at: int = 0) -> dict[int, tuple[int, int]]:
        row = int(self._rows(pa.array([word], pa.large_string()))[0])
        codes = [] if row < 0 else self.codes[self.ends[row] : self.ends[row + 1]].tolist()
        own = []
        for code in codes:
            start, size = divmod(code >> 48, WINDOW)
            if self.piece[code & 0xFFFFFF] == word[start : start + size]:
                own.append(code)
        return _codes(own, at)

    def _tokens(self, word: str, row: int) -> list[int]:
        """One word: of a unigram model, or longer than a window."""
        n = len(word)
        if n <= WINDOW:
            if row < 0:
                return [~ord(c) for c in word]
            edges, folded = self._edges(word), self.starts[int(self.hashes[row])]
            if len(folded) == 1:
                starts = [s - 1 for s in folded[0][:-1]]
            else:
                starts = _long_viterbi(n, edges, self.scores, self.model.longest)
        else:
            edges = {}
            for at in range(0, n, WINDOW - self.model.longest + 1):
                edges.update(self._edges(word[at : at + WINDOW], at))
            bpe = self.model.kind == "bpe"
            starts = _long_merged(n, edges) if bpe else _long_viterbi(n, edges, self.scores, self.model.longest)
        parts = [edges.get(a * WINDOW + b - a) for a, b in zip(starts, [*starts[1:], n])]
        return [part[1] if part else ~ord(word[a]) for a, part in zip(starts, parts)]

    def ids(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some parts one after another, and where each part's end."""
        rows = self._rows(parts)
        sizes = pc.utf8_length(parts).to_numpy()
        together = (sizes <= WINDOW) & (self.model.kind == "bpe")
        done = []  # numbers of parts, their tokens, how many each has
        for n in np.unique(sizes[together]).tolist():
            same = np.flatnonzero(together & (sizes == n))
            step = max(1, TABLE_CELLS // (n * (self.model.longest + 2)))
            done += [self._together(n, parts, chosen, rows[chosen]) for chosen in np.split(same, range(step, len(same), step))]
        alone = np.flatnonzero(~together)
        for number, word in zip(alone.tolist(), parts.take(pa.array(alone)).to_pylist()):
            tokens = self._tokens(word, int(rows[number]))
            done.append((np.array([number]), np.array(tokens, "int64"), np.array([len(tokens)])))
        lengths = np.zeros(len(parts), "int64")
        for numbers, _, counts in done:
            lengths[numbers] = counts
        ends = np.cumsum(lengths)
        tokens = np.zeros(lengths.sum(), "int32")
        for numbers, found, counts in done:
            tokens[np.repeat(ends[numbers] - np.cumsum(counts), counts) + np.arange(len(found))] = found
        return self._as_bytes(tokens, lengths)

    def _together(self, n: int, parts: pa.Array, chosen: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        data, _ = _utf8(parts.take(pa.array(chosen)))
        points = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), "uint32").reshape(-1, n)
        with_edges = np.flatnonzero(rows >= 0)
        codes, counts = _joined(self.codes, self.ends[1:], rows[with_edges])
        owner = np.repeat(with_edges, counts)
        # Words with one hash have their edges together: only those that spell the word's own text are its.
        start, size = np.divmod(codes >> 48, WINDOW)
        own = start + size <= n
        some, text, spelled = np.flatnonzero(own), points.ravel(), self.spelled.ravel()
        at, letter = owner * n + start, (codes & 0xFFFFFF) * self.model.longest
        for k in range(self.model.longest):
            some = some[size[some] > k]
            some = some[text[at[some] + k] == spelled[letter[some] + k]]
            own &= size != k + 1
            own[some[size[some] == k + 1]] = True
        tokens, sizes = _merged(n, codes[own], owner[own], points, self.model.longest)
        return chosen, tokens, sizes

    def _as_bytes(self, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        alone = tokens < 0
        points, which = np.unique(~tokens[alone], return_inverse=True)
        single = {ord(piece): (i,) for piece, i, _ in self.model.pieces if len(piece) == 1}
        first = self.model.first_byte
        said = [single.get(p) or tuple(first + byte for byte in chr(p).encode()) for p in points.tolist()]
        counts = np.ones(len(tokens), "int64")
        counts[alone] = np.array([len(s) for s in said], "int64")[which]
        flat = np.repeat(tokens, counts)
        begin = np.cumsum(counts) - counts
        table = np.zeros((len(said), 4), "int32")
        for row, s in enumerate(said):
            table[row, : len(s)] = s
        for byte in range(4):
            holds = np.flatnonzero(alone)[counts[alone] > byte]
            flat[begin[holds] + byte] = table[which[counts[alone] > byte], byte]
        token_ends = np.concatenate([[0], np.cumsum(counts)])
        return flat, token_ends[np.cumsum(lengths)]


def _assembled(model: PieceModel):
    """Documents of a group from the ids of its words, those from the ids of their parts."""
    breaks = _breaks(model)

    def assemble(docs: pa.Table, coded: pa.Table) -> pa.Table:
        words, sizes = _cut(docs["text"].combine_chunks())
        named = words.dictionary_encode()
        parts, ends = _split_up(named.dictionary, breaks)
        each = parts.dictionary_encode()
        flat, part_ends = _Parts(coded, model).ids(each.dictionary)
        flat, counts = _joined(flat, part_ends, each.indices.to_numpy())
        word_ends = np.concatenate([[0], np.cumsum(counts)])[ends]
        flat, counts = _joined(flat, word_ends, named.indices.to_numpy())
        doc_ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
        ids = pa.ListArray.from_arrays(pa.array(doc_ends, "int32"), pa.array(flat, "int32"))
        return pa.table({"doc_id": docs["doc_id"], "ids": ids})

    return assemble


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of a batch, up to about so many bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype("int64")
    begins = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=-1)).tolist()
    for begin, end in zip(begins, [*begins[1:], len(batch)]):
        yield batch.slice(begin, end - begin)


def _packed(parts: pa.Array) -> bytes:
    batch = pa.record_batch([parts], ["part"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _lattices(parts: pa.Array, longest: int) -> pa.Array:
    """The words whose edges the ids of some parts need: the parts, and the windows of longer ones."""
    sizes = pc.utf8_length(parts).to_numpy()
    short = parts.filter(pa.array((sizes > 1) & (sizes <= WINDOW)))
    stride = WINDOW - longest + 1
    windows = {part[at : at + WINDOW] for part in parts.filter(pa.array(sizes > WINDOW)).to_pylist() for at in range(0, len(part), stride)}
    return pa.concat_arrays([short, pa.array(sorted(windows), short.type)])


def _numbered(model: PieceModel, most: int, most_known: int):
    """Texts cut into parts of words, numbered by task in the order they first come (see ``encode``)."""
    breaks = _breaks(model)

    def rows(kind: int, place: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
        columns = {"kind": pa.array(np.full(len(place), kind, "int8")), "place": pa.array(place, "int64")} | columns
        return pa.record_batch(columns)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = pa.array([], pa.large_string()), 0
        for docs in (part for batch in batches for part in _slices(batch, most)):
            words, sizes = _cut(docs["text"])
            named = words.dictionary_encode()
            parts, ends = _split_up(named.dictionary, breaks)
            each = parts.dictionary_encode()
            anew = not place or len(known) > most_known
            known = known[:0] if anew else known
            found = pc.index_in(each.dictionary, value_set=known)
            new = each.dictionary.filter(found.is_null())
            mine = found.fill_null(-1).to_numpy(zero_copy_only=False).astype("int32")
            mine[mine < 0] = len(known) + np.arange(len(new))
            known = pa.concat_arrays([known, new])

            lattices, id_type = _lattices(new, model.longest).cast(pa.string()), docs["doc_id"].type
            nothing = {"doc_id": pa.nulls(len(lattices), id_type), "word": lattices, "said": pa.nulls(len(lattices), pa.binary())}
            yield rows(EDGES, place + np.arange(len(lattices)), **nothing)
            place += len(lattices)
            packed = {"doc_id": pa.nulls(1, id_type), "word": pa.nulls(1, pa.string()), "said": pa.array([_packed(new)], pa.binary())}
            yield rows(PARTS_ANEW if anew else PARTS, np.array([place]), **packed)
            flat, counts = _joined(mine[each.indices.to_numpy()], ends, named.indices.to_numpy())
            doc_ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
            buffers = [None, pa.py_buffer((4 * doc_ends).astype("int32")), pa.py_buffer(flat.astype("<i4"))]
            numbers = pa.Array.from_buffers(pa.binary(), len(docs), buffers)
            yield rows(DOCUMENT, place + 1 + np.arange(len(docs)), doc_id=docs["doc_id"], word=pa.nulls(len(docs), pa.string()), said=numbers)
            place += 1 + len(docs)

    return number


def _numbers(said: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The whole numbers that some binaries hold, one after another, and how many each has."""
    _, offsets, data = said.buffers()
    offsets = np.frombuffer(offsets, "int32")[said.offset : said.offset + len(said) + 1]
    return np.frombuffer(data[int(offsets[0]) : int(offsets[-1])], "<i4") if data else np.zeros(0, "int32"), np.diff(offsets) // 4


def _spoken(model: PieceModel):
    """The way back from ``_numbered``: ids of new parts from their edges, then documents from the ids of their parts."""

    def speak(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, flat, ends, place = [], np.zeros(0, "int32"), np.zeros(0, "int64"), -1
        for batch in batches:
            places, kinds = batch["place"].to_numpy(), batch["kind"].to_numpy()
            if (np.diff(places, prepend=place) < (kinds != EDGES)).any():
                raise RuntimeError("rows of a task have to keep their order on the way through the join")
            place = places[-1] if len(batch) else place
            begins = np.flatnonzero(np.diff(kinds, prepend=-1)).tolist()
            for begin, end in zip(begins, [*begins[1:], len(batch)]):
                kind, run = kinds[begin], batch.slice(begin, end - begin)
                if kind == EDGES:
                    edges.append((run["hash"], run["edge"]))
                elif kind == DOCUMENT:
                    numbers, sizes = _numbers(run["said"])
                    ids, counts = _joined(flat, ends, numbers)
                    doc_ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
                    lists = pa.ListArray.from_arrays(pa.array(doc_ends, "int32"), pa.array(ids, "int32"))
                    yield pa.record_batch([run["doc_id"], lists], ["doc_id", "ids"])
                else:
                    for packed in run["said"]:
                        parts = pa.ipc.open_stream(packed.as_buffer()).read_all()["part"].combine_chunks()
                        if kind == PARTS_ANEW:
                            flat, ends = np.zeros(0, "int32"), np.zeros(0, "int64")
                        coded = pa.table({name: pa.chunked_array([run[i] for run in edges], "int64") for i, name in enumerate(("hash", "edge"))})
                        if len(parts):
                            new, new_ends = _Parts(coded, model).ids(parts)
                            flat, ends = np.concatenate([flat, new]), np.concatenate([ends, len(flat) + new_ends])
                        edges = []

    return speak


def encode(docs: DataFrame, model: PieceModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every row, as the SentencePiece library gives them.

    NULL and empty texts have no ids; characters without a piece become their bytes. Rows that
    repeat an id, or have none, are encoded by themselves. Other columns are ignored; an empty
    table gives an empty result. A run without blanks may have any length: its lattice is made in
    windows. For BPE models merges are replayed over the edges beside the documents; unigram models
    are folded by Viterbi (``_encode_unigram``).

    Nothing is shuffled, sorted or gathered for it: a task cuts its texts, in slices of about ``GROUP_CHARS``, into parts
    of words, and numbers each different part as it first comes. Rows then go in their order through the explosion into
    substrings and the join with the piece table, which is broadcast: a slice's new parts, then its documents as
    numbers. Behind the join the edges give the parts' ids, and these the documents'. What a task keeps are its
    parts and their ids, ``KNOWN_PARTS`` and those of a slice at most. The order is checked on the way.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if model.kind != "bpe":
        return _encode_unigram(rows, model)
    for key, most in (("maxRecordsPerBatch", EDGE_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        docs.sparkSession.conf.set(f"spark.sql.execution.arrow.{key}", str(most))
    id_field = StructField("doc_id", rows.schema["doc_id"].dataType)
    types = [StructField("word", StringType()), StructField("said", BinaryType())]
    numbered = StructType([StructField("kind", ByteType()), StructField("place", LongType()), id_field, *types])
    edges = edges_of(rows.mapInArrow(_numbered(model, GROUP_CHARS, KNOWN_PARTS), numbered), model)
    needed = edges.where("edge IS NOT NULL OR said IS NOT NULL")
    coded = needed.select("kind", "place", "doc_id", "said", F.xxhash64("word").alias("hash"), "edge")
    return coded.mapInArrow(_spoken(model), StructType([id_field, StructField("ids", ArrayType(IntegerType()))]))


def _encode_unigram(rows: DataFrame, model: PieceModel) -> DataFrame:
    """``encode`` for unigram models, whose fold is a Spark aggregate over the edges of a word.

    Rows are dealt once, evenly, into groups of about ``GROUP_CHARS`` characters. All that follows
    keeps to a group: its distinct words, their lattice, the way back to the documents. So the
    texts move once and words never do, and no group depends on how often a word or id occurs.
    """
    spark = rows.sparkSession
    # A group's words and edges are gathered in hash tables, which its size bounds; by default such
    # an aggregate begins to sort, and spill, all its rows after 128 keys.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "1000000")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_CHARS))
    # The group follows from the row's values and its task, so it is the same whenever a row is computed
    # again, and equal rows of different tasks part.
    code = F.xxhash64("doc_id", "text", F.spark_partition_id())
    dealt = rows.withColumn("part", F.pmod(code, F.lit(groups).cast("long")).cast("int"))
    # Twice as many partitions as groups, so that few groups meet in one, but no more than the session wants.
    split = dealt.repartition(min(2 * groups, int(spark.conf.get("spark.sql.shuffle.partitions"))), "part")
    # Both uses of the rows ask for the same columns, so that one shuffle of the texts serves both.
    each = split.select(F.col("part").alias("home"), "doc_id", F.explode(words_of(F.col("text"))).alias("word"))
    distinct = each.where("word <> ''").groupBy("home", "word").agg(F.count("doc_id").alias("n")).where("n >= 0").select("home", "word")
    parts = distinct.select("home", F.explode(parts_of(F.col("word"), model)).alias("part_of"))
    coded = coded_words(parts.where(F.length("part_of") > 1).select("home", F.col("part_of").alias("word")).distinct(), model)
    schema = StructType([rows.schema["doc_id"], StructField("ids", ArrayType(IntegerType()))])
    return split.groupBy("part").cogroup(coded.groupBy("home")).applyInArrow(_assembled(model), schema)


def decode(coded: DataFrame, model: PieceModel, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` of every row's ids: the way back from ``encode``.

    Byte pieces are read as UTF-8, malformed bytes as replacement characters; ids without a text
    (control pieces) and unknown ids say nothing; NULL and empty lists give an empty text.
    """
    spark = coded.sparkSession
    said = [(i, piece.replace(BLANK, " ").encode().hex()) for piece, i, _ in model.pieces]
    said += [(model.first_byte + byte, f"{byte:02x}") for byte in range(256)]
    table = spark.createDataFrame(said, "id int, hex string")
    rows = coded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    each = rows.select("doc_id", "row", F.posexplode_outer("ids").alias("place", "id"))
    joined = each.join(F.broadcast(table), "id", "left").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("place", "hex"))).alias("parts")
    )
    bytes_ = F.unhex(F.array_join(F.transform("parts", lambda p: p["hex"]), ""))
    return joined.select("doc_id", F.regexp_replace(F.make_valid_utf8(bytes_.cast("string")), "^ ", "").alias("text"))
