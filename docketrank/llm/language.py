"""Language identification: scripts narrow the candidates, Viterbi labels spans of mixed text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

UNKNOWN = "und"
# The model is fitted on about so many training rows of a language, dealt out by a hash.
FIT_ROWS = 2000
BUCKETS = 1 << 14
SMOOTHING = 0.5
# Log-odds that a change of language costs, and what a word of another script loses.
SWITCH_COST = 8.0
OTHER_SCRIPT = -1e4
# A language is a candidate for a script that has at least this share of its letters.
SCRIPT_SHARE = 0.01
# So many characters of texts are worked on at a time (one text, if it is longer).
CHARS_AT_ONCE = 3_000_000

# First code points of ranges and the script that begins there (0: other letters).
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "other"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for _, name in SCRIPTS))


class Model(NamedTuple):
    langs: tuple[str, ...]
    weights: np.ndarray  # BUCKETS x languages: log probability of a trigram
    scripts: np.ndarray  # scripts x languages: whether a word of the script may be of the language


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, its lower case, its script."""
    points = 0x110000
    letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(points)), bool, points)
    lower = np.fromiter((ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(points)), np.uint32, points)
    script = np.zeros(points, np.int8)
    starts = [start for start, _ in SCRIPTS] + [points]
    for (start, name), end in zip(SCRIPTS, starts[1:], strict=True):
        script[start:end] = SCRIPT_NAMES.index(name)
    return letter, lower, script


class Words(NamedTuple):
    """The words (runs of letters) of many texts: place of the first letter, length, text, script."""

    grams: np.ndarray  # bucket of the trigram around each letter, in order
    first: np.ndarray  # index into ``grams``
    start: np.ndarray  # code point in the text
    length: np.ndarray
    owner: np.ndarray
    script: np.ndarray


def _words(texts: list[str]) -> Words:
    letter, lower, script = _tables()
    # Texts are set apart by a blank, so every word has a neighbour on either side.
    points = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letter[points]
    low = np.where(is_letter, lower[points], 32).astype(np.uint64)
    at = np.flatnonzero(is_letter)
    mixed = low[at - 1] * np.uint64(0x9E3779B1) + low[at] * np.uint64(0x85EBCA6B) + low[at + 1] * np.uint64(0xC2B2AE35)
    grams = ((mixed ^ (mixed >> np.uint64(15))) * np.uint64(0x27D4EB2F) >> np.uint64(13)) % np.uint64(BUCKETS)
    begins = np.flatnonzero(~is_letter[at - 1]) if len(at) else np.zeros(0, np.int64)
    length = np.diff(np.r_[begins, len(at)])
    offsets = np.cumsum([1, *(len(text) + 1 for text in texts)])[:-1] if texts else np.zeros(0, np.int64)
    place = at[begins]
    owner = np.searchsorted(offsets, place, side="right") - 1
    return Words(grams.astype(np.int32), begins, place - offsets[owner], length, owner, script[points[place]])


def _count(langs: tuple[str, ...]):
    """Counts of trigrams and scripts per language, one row per pair and batch of rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {lang: i for i, lang in enumerate(langs)}
        for batch in batches:
            known = batch[batch["lang"].isin(place) & batch["text"].notna()]
            for lang, rows in known.groupby("lang"):
                words = _words(list(rows["text"]))
                grams = np.bincount(words.grams, minlength=BUCKETS)
                scripts = np.bincount(words.script, weights=words.length, minlength=len(SCRIPT_NAMES))
                counts = np.r_[grams, scripts.astype(np.int64)]
                used = np.flatnonzero(counts)
                yield pd.DataFrame({"lang": place[lang], "feature": used, "n": counts[used]})

    return count


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram and script frequencies of every language, from a bounded sample of rows.

    The sample takes about ``FIT_ROWS`` different texts of each language by a hash, so it is the
    same in every run and a text counts once, however many copies it has. Rows with NULL text or language are left out; with no rows left the model
    knows no language. Counting is done by Spark; what comes to the driver is one number for each
    language and bucket.
    """
    labelled = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    hashed = labelled.withColumn("hash", F.xxhash64("text"))
    each = hashed.groupBy("lang", "hash").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {row["lang"]: row["n"] for row in each.collect()}
    langs = tuple(sorted(sizes))
    if not langs:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPT_NAMES), 0), bool))
    share = F.create_map(*(F.lit(x) for name in langs for x in (name, min(1.0, FIT_ROWS / sizes[name]))))
    drawn = hashed.where(F.pmod("hash", F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    sample = drawn.dropDuplicates(["lang", "hash"]).select("lang", "text")
    counted = sample.mapInPandas(_count(langs), "lang int, feature int, n long").groupBy("lang", "feature").sum("n")
    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    for row in counted.collect():
        counts[row[1], row[0]] = row[2]
    grams, scripts = counts[:BUCKETS] + SMOOTHING, counts[BUCKETS:]
    allowed = scripts > SCRIPT_SHARE * scripts.sum(axis=0)
    return Model(langs, np.log(grams / grams.sum(axis=0)), allowed)


def _viterbi(scores: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The best language of every word, given that a change of language within a text has a cost.

    All texts are worked through side by side, word by word; texts that have ended drop out.
    """
    sizes = np.bincount(owner, minlength=texts)
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    running = np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
    best = np.zeros((texts, scores.shape[1]))
    stay = np.ones(scores.shape, bool)
    switch = np.zeros(len(scores), np.int16)
    for step, active in enumerate(running):
        at = first[order[:active]] + step
        if step:
            top = best[:active].argmax(axis=1)
            reach = best[np.arange(active), top] - SWITCH_COST
            stay[at] = best[:active] >= reach[:, None]
            switch[at] = top
            best[:active] = np.maximum(best[:active], reach[:, None])
        best[:active] += scores[at]
    label = np.zeros(len(scores), np.int16)
    current = best.argmax(axis=1)
    for step in range(len(running) - 1, -1, -1):
        active = running[step]
        at = first[order[:active]] + step
        label[at] = current[:active]
        current[:active] = np.where(stay[at, current[:active]], current[:active], switch[at])
    return label


def label_texts(texts: list[str], model: Model, with_spans: bool = True) -> list[tuple[str, float, list]]:
    """Main language, its share of the letters, and spans (start, end, language) of each text."""
    out: list[tuple[str, float, list]] = []
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= CHARS_AT_ONCE):
            size += len(texts[upto])
            upto += 1
        out += _label(texts[at:upto], model, with_spans)
        at = upto
    return out


def _label(texts: list[str], model: Model, with_spans: bool) -> list[tuple[str, float, list]]:
    words, n_langs = _words(texts), len(model.langs)
    result: list[tuple[str, float, list]] = [(UNKNOWN, 0.0, []) for _ in texts]
    if not n_langs or not len(words.first):
        return result
    scores = np.stack(
        [np.add.reduceat(model.weights[:, k].astype(np.float32)[words.grams], words.first) for k in range(n_langs)], axis=1
    )
    allowed = model.scripts[words.script]
    scores[~allowed & allowed.any(axis=1, keepdims=True)] += OTHER_SCRIPT
    label = _viterbi(scores, words.owner, len(texts))
    letters = np.bincount(words.owner * n_langs + label, weights=words.length, minlength=len(texts) * n_langs)
    letters = letters.reshape(len(texts), n_langs)
    total, main = letters.sum(axis=1), letters.argmax(axis=1)
    change = np.flatnonzero(np.r_[True, (label[1:] != label[:-1]) | (words.owner[1:] != words.owner[:-1])])
    ends = np.r_[change[1:], len(label)] - 1
    spans: list[list] = [[] for _ in texts]
    if with_spans:
        stop = words.start[ends] + words.length[ends]
        rows = zip(words.owner[change].tolist(), words.start[change].tolist(), stop.tolist(), label[change].tolist(), strict=True)
        for owner, start, end, lang in rows:
            spans[owner].append({"start": start, "end": end, "lang": model.langs[lang]})
    for i in np.flatnonzero(total).tolist():
        result[i] = (model.langs[main[i]], float(letters[i, main[i]] / total[i]), spans[i])
    return result


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` in struct ``row``, and ``found`` (lang_pred, score, spans).

    ``lang_pred`` is the language with most letters in the labelled spans and ``score`` its share
    of all letters; ties go to the first language by name. NULL texts, texts without a letter, and
    all texts if the model knows no language, are ``und`` with score zero and no spans. Only the
    text decides, so repeated rows get equal results. Row by row: nothing is shuffled.
    """

    @F.pandas_udf("struct<lang_pred:string,score:double,spans:array<struct<start:long,end:long,lang:string>>>")
    def found(texts: pd.Series) -> pd.DataFrame:
        labelled = label_texts([text or "" for text in texts], model)
        return pd.DataFrame(labelled, columns=["lang_pred", "score", "spans"])

    # Not "deterministic" to the optimizer, else a filter on the result runs it a second time.
    found = found.asNondeterministic()
    return docs.select(F.struct("*").alias("row"), found(F.col(text)).alias("found"))


def keep_known(docs: DataFrame, model: Model, least_share: float = 0.4) -> DataFrame:
    """The rows whose text has a main language, with at least 40 % of the letters in it.

    Column ``lang`` takes the language found; the other columns stay.
    """
    named = identify(docs, model).where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= least_share))
    kept = [F.col("found.lang_pred").alias(name) if name == "lang" else F.col(f"row.`{name}`") for name in docs.columns]
    return named.select(*kept)
