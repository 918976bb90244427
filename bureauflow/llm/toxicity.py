"""Toxicity by a weighted lexicon and Aho-Corasick matching (operator 4).

Texts are folded first: lower case, look-alike letters of other scripts to Latin ones, and digits or signs that stand for letters next to a
letter. The lexicon holds whole words and word beginnings, weighted by smoothed log odds over a bounded sample of labelled rows
(TRAIN_ROWS, by hash order); phrases of a lexicon word and a neighbour that the sample shows in clean rows only are exceptions and cancel
the hit. A document's weights are summed, normalised by its length, and turned into a probability by a logistic fit on the same sample.

Defined results: null and empty texts get the score of a text without hits; rows are independent, so repeated rows are scored each; without
labelled rows of both kinds every score is 0.5; an empty table gives an empty result; very long texts are folded whole, a row at a time. Of
labelled rows under one key, that of the least text is learned from. Columns named score or predicted give way, others pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 10_000
#: A pattern is in the lexicon if so many toxic rows of the sample have it (and this share of them), and its log odds are so high.
LEAST_ROWS = 6
LEAST_SHARE = 0.015
LEAST_WEIGHT = 3.0
#: Log odds from which a pattern is tried, before exceptions are taken out.
TRIED_WEIGHT = 1.0
PREFIXES = range(4, 8)
THRESHOLD = 0.7

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ӏ": "l", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ı": "i", "ⅼ": "l", "ⅰ": "i", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m",
}
#: Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
_wide = {ord(chr(0xFF41 + k)): chr(97 + k) for k in range(26)}
_fold = str.maketrans(LOOKALIKES) | _wide
_stand_in = re.compile(r"[013457 8@$!]+".replace(" ", ""))
_letters = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = text.translate(_fold)

    def letters(m: re.Match) -> str:
        a, b = m.span()
        before, after = a > 0 and text[a - 1].isalpha(), b < len(text) and text[b].isalpha()
        # a sign at the end of a word is punctuation
        return "".join(SUBSTITUTES[c] for c in m[0]) if after and (before or m[0][0] not in "!$@") or before and m[0].isdigit() else m[0]

    return _stand_in.sub(letters, text)


@dataclass
class Model:
    """Weights by pattern (`word$` is the whole word, else a beginning), phrases that cancel a hit, logistic coefficients."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    logistic: tuple[float, ...] = ()
    center: tuple[float, ...] = ()


@lru_cache(4)
def automaton(patterns: tuple[str, ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for p in patterns:
        stem = p.rstrip("$")
        a.add_word(stem, (*a.get(stem, ()), p))
    a.make_automaton()
    return a


def hits(text: str, patterns: tuple[str, ...]) -> Iterator[tuple[str, int, int]]:
    """(pattern, start, end) of the lexicon's matches that begin a word of the folded text; of one start, the longest alone."""
    found: dict[int, tuple[str, int]] = {}
    for last, names in automaton(patterns).iter(text) if patterns else ():
        for name in names:
            stem = name.rstrip("$")
            start, end = last - len(stem) + 1, last + 1
            if start and text[start - 1].isalpha() or stem != name and end < len(text) and text[end].isalpha():
                continue
            found[start] = (name, end)
    return ((name, start, end) for start, (name, end) in found.items())


def phrases(text: str, start: int) -> list[str]:
    """The word at start with the one before, and with the one after."""
    word = _letters.match(text, start)[0]
    before, after = _letters.findall(text, max(0, start - 40), start), _letters.search(text, start + len(word))
    out = [f"{before[-1]} {word}"] if before else []
    return [*out, f"{word} {after[0]}"] if after else out


def weighed(text: str, model: Model, patterns: tuple[str, ...]) -> tuple[float, float, float]:
    """Features of a text: its weight, its weight by length, and whether there is any."""
    folded = fold(text)
    total = 0.0
    for name, start, _ in hits(folded, patterns):
        if not (model.exceptions and model.exceptions.intersection(phrases(folded, start))):
            total += model.weights[name]
    return float(np.log1p(total)), float(np.log1p(1000 * total / (len(folded) + 200))), float(total > 0)


def _patterns_of(text: str) -> set[str]:
    words = {w for w in _letters.findall(fold(text)) if len(w) > 2}
    return {f"{w}$" for w in words} | {w[:n] for w in words for n in PREFIXES if len(w) > n}


def _counted(rows: DataFrame, of_text, least: int) -> DataFrame:
    """(name, toxic, clean): rows of each kind that have a name; a task counts its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kinds[toxic].update(of_text(text or ""))
        names = list(kinds[0].keys() | kinds[1].keys())
        for at in range(0, len(names), 50_000):
            some = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string()), pa.array([kinds[1][n] for n in some], pa.int64()), pa.array([kinds[0][n] for n in some], pa.int64())], ["name", "toxic", "clean"]
            )

    counts = rows.select("text", "toxic").mapInArrow(count, "name string, toxic bigint, clean bigint")
    return counts.groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.greatest("toxic", "clean") >= least)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """Learns from TRAIN_ROWS labelled rows, by order of a hash of the key. A key with both labels counts as toxic."""
    known = labels.where(F.col(toxic).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg((F.max(toxic) > 0).cast("int").alias("toxic"))
    sample = known.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(TRAIN_ROWS)
    # TRAIN_ROWS rows of two numbers; rows that share a key count once
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(sample), key).groupBy(key).agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    rows = rows.select("text", "toxic").persist()
    try:
        size = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
        if len(size) < 2:
            return Model()
        odds = F.log((F.col("toxic") + 0.5) / (size[1] + 1)) - F.log((F.col("clean") + 0.5) / (size[0] + 1))
        # no limit: a pattern has LEAST_SHARE of the sample's toxic rows
        found = (
            _counted(rows, _patterns_of, LEAST_ROWS).withColumn("weight", odds).where((F.col("weight") >= TRIED_WEIGHT) & (F.col("toxic") >= max(LEAST_ROWS, LEAST_SHARE * size[1])))
            .collect()
        )
        weights: dict[str, float] = {}
        # a pattern is left out if a beginning of it is about as telling
        for r in sorted(found, key=lambda r: (len(r["name"].rstrip("$")), r["name"])):
            stem = r["name"].rstrip("$")
            if not any((w := weights.get(stem[:n])) is not None and w >= r["weight"] - 1.0 for n in range(1, len(stem) + 1)):
                weights[r["name"]] = r["weight"]
        names = tuple(sorted(weights))

        def near(text: str) -> set[str]:
            folded = fold(text)
            return {p for _, start, _ in hits(folded, names) for p in phrases(folded, start)}

        # all phrases of the sample's clean rows; their number follows from TRAIN_ROWS
        clean_only = frozenset(r["name"] for r in _counted(rows, near, 3).where("toxic = 0").collect())

        def left(text: str) -> set[str]:
            folded = fold(text)
            return {name for name, start, _ in hits(folded, names) if not clean_only.intersection(phrases(folded, start))}

        # weights of the hits that no exception cancels
        again = _counted(rows, left, LEAST_ROWS).withColumn("weight", odds).where((F.col("weight") >= LEAST_WEIGHT) & (F.col("toxic") >= LEAST_ROWS)).collect()
        weights = {r["name"]: r["weight"] for r in again}
        names = tuple(sorted(weights))
        model = Model(weights, clean_only)

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = [weighed(t or "", model, names) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in x], pa.float64()) for k in range(3)), batch.column(1)], ["a", "b", "c", "toxic"])

        # TRAIN_ROWS rows of four numbers
        data = np.array(sorted(tuple(r) for r in rows.select("text", "toxic").mapInArrow(features, "a double, b double, c double, toxic int").collect()))
    finally:
        rows.unpersist()
    x, y = data[:, :3], data[:, 3]
    center = x.mean(0)
    x = np.column_stack([np.ones(len(x)), x - center])
    w, ridge = np.zeros(4), np.diag([1e-6, 1.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Model(weights, model.exceptions, tuple(w), tuple(center))


def score(docs: DataFrame, model: Model, kept: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns kept (all, if None), score, predicted. Clashing columns of docs give way to the new ones."""
    kept = [c for c in (docs.columns if kept is None else kept) if c not in ("score", "predicted")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema.fields)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = tuple(sorted(model.weights))
        w, center = np.array(model.logistic), np.array(model.center)
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            if len(w):
                x = np.array([weighed(t or "", model, names) for t in texts]).reshape(-1, 3)
                p = 1 / (1 + np.exp(-(w[0] + (x - center) @ w[1:])))
            else:
                p = np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], [*kept, "score", "predicted"])

    return docs.select(*kept, F.col(text).alias("__text")).mapInArrow(scored, f"{kinds}, score double, predicted int")
