"""Benchmark decontamination by greedy string tiling (operator 2).

Texts are sequences of words (letters, digits and underscores, in lower case). Seeds, the hashes of MIN_TILE words in a row, are joined
between documents and benchmark items; a bit set of the items' seeds, of bounded size, keeps most other seeds from being sent. For each pair
that shares a seed, the longest common run of unmarked words is found by running Karp-Rabin hashes and marked, again and again, until no run
of MIN_TILE words is left. A pair is reported if the marked runs cover COVERAGE of the item's words, in whatever order they stand.

Defined results: null and empty texts share nothing; items of fewer than MIN_TILE words are never found; an item listed twice under one id
is tiled by each of its texts and the best counts; long and repetitive texts take memory in proportion to their words; repeated rows of a document are judged once; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauflow.llm import ragged, storage
from bureauflow.llm.bits import bit_set, has_bit

MIN_TILE = 5
COVERAGE = 0.5
#: Bits of the set of seeds: 4,096 a seed, 2 ** 27 (16 MB) at most. A full set only sends more seeds to the join.
FILTER_BITS = 27
_BASE = np.uint64(0xD6E8FEB86659FD93)


def lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def words(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a slice of lower-case texts, and the documents' bounds among them."""
    if not len(buf):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    kind, _ = ragged.byte_classes(buf)
    inner = (kind == ragged.LETTER) | (kind == ragged.NUMBER) | (buf == 0x5F)
    begin, stop = inner.copy(), np.zeros(len(buf) + 1, bool)
    begin[1:] &= ~inner[:-1]
    stop[1:-1] = inner[:-1] & ~inner[1:]
    cuts = bounds[bounds < len(buf)]
    begin[cuts] = inner[cuts]
    ends = bounds[bounds > 0]
    stop[ends] = inner[ends - 1]
    starts = np.flatnonzero(begin)
    return ragged.span_hashes(buf, starts, np.flatnonzero(stop)), np.searchsorted(starts, bounds)


def seeds(hashes: np.ndarray, size: int = MIN_TILE) -> np.ndarray:
    """Hashes of `size` words in a row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + hashes[k : k + n]
    return ragged.mix(out)


def signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def tokens(rows: DataFrame, key: str, text: str, bits: np.ndarray | None, size: int = MIN_TILE) -> DataFrame:
    """key, print (hash of the words), words and seeds of the rows; with a bit set, of rows with a seed in it, and those seeds only."""
    kind = rows.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, bounds = ragged.text_bytes(lower(batch.column(1)))
            for row, stop, part, offs in ragged.slices(buf, bounds):
                hashes, at = words(part, offs)
                found = seeds(hashes, size)
                # seeds that lie in one document
                doc = np.repeat(np.arange(stop - row), np.diff(at))
                inside = doc[: len(found)] == doc[size - 1 :] if len(found) else np.empty(0, bool)
                if bits is not None:
                    inside &= has_bit(bits, found)
                where = np.flatnonzero(inside)
                own = np.searchsorted(where, at)
                some = np.flatnonzero(own[1:] > own[:-1]) if bits is not None else np.arange(stop - row)
                if not len(some):
                    continue
                held, held_at = ragged.ragged_take(hashes, at, some)
                hits, hits_at = ragged.ragged_take(found[where], own, some)
                print_ = [hash_of(hashes[at[d] : at[d + 1]]) for d in some.tolist()]
                lists = lambda v, o: pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), signed(v))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(some + row)), pa.array(print_, pa.int64()), lists(held, held_at), lists(hits, hits_at)], [key, "print", "words", "seeds"]
                )

    return rows.select(key, text).mapInArrow(cut, f"{key} {kind}, print bigint, words array<bigint>, seeds array<bigint>")


def hash_of(hashes: np.ndarray) -> int:
    """64-bit hash of a sequence of words."""
    up, _ = ragged.powers(len(hashes) + 1)
    with np.errstate(over="ignore"):
        return int(ragged.mix(np.array([(hashes * up[: len(hashes)]).sum(dtype=np.uint64) + np.uint64(len(hashes))]))[0].view(np.int64))


def tiles(pattern: np.ndarray, text: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """(place in pattern, place in text, length): the longest common run of unmarked words, marked, and so on down to `least` words."""
    free_p, free_t, found = np.ones(len(pattern), bool), np.ones(len(text), bool), []
    top = min(len(pattern), len(text))

    def rolled(a: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Running hashes of the windows without a marked word, and their places."""
        up, down = ragged.powers(len(a) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(a * up[: len(a)], dtype=np.uint64)])
        taken = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(taken[size:] == taken[:-size])
        return (total[at + size] - total[at]) * down[at], at

    def common(size: int) -> bool:
        return bool(np.isin(rolled(pattern, free_p, size)[0], rolled(text, free_t, size)[0]).any())

    def mark(size: int) -> None:
        """Marks common runs of the size, by ascending place in the pattern, each at the first place of the text that is still free."""
        hp, at_p = rolled(pattern, free_p, size)
        ht, at_t = rolled(text, free_t, size)
        order = np.argsort(ht, kind="stable")
        ranked, places = ht[order], at_t[order]
        lo, hi = np.searchsorted(ranked, hp, "left"), np.searchsorted(ranked, hp, "right")
        # places of a hash before this one are marked for good
        begun: dict[int, int] = {}
        for k in np.flatnonzero(hi > lo).tolist():
            p, first, end = int(at_p[k]), int(lo[k]), int(hi[k])
            # all runs marked in this round are of one size, so a window is free if its ends are
            if not (free_p[p] and free_p[p + size - 1]):
                continue
            at = begun.get(first, first)
            while at < end and not (free_t[places[at]] and free_t[places[at] + size - 1]):
                at += 1
            begun[first] = at
            while at < end:
                t = int(places[at])
                if free_t[t] and free_t[t + size - 1] and (pattern[p : p + size] == text[t : t + size]).all():
                    free_p[p : p + size], free_t[t : t + size] = False, False
                    found.append((p, t, size))
                    break
                at += 1

    while top >= least:
        low, high = least - 1, top
        while low < high:
            size = (low + high + 1) // 2
            low, high = (size, high) if common(size) else (low, size - 1)
        if low < least:
            break
        known = len(found)
        mark(low)
        # without a mark all agreements were of hashes alone
        top = low if len(found) > known else low - 1
    return found


def overlaps(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", share: float = COVERAGE) -> DataFrame:
    """Pairs whose tiles cover `share` of the item: key, item, n_words (of the item), n_covered, n_tiles, coverage."""
    kinds = f"{key} {docs.schema[key].dataType.simpleString()}, {item} {items.schema[item].dataType.simpleString()}"
    pool = storage.written(tokens(items, item, item_text, None).withColumnRenamed("print", "item_print").dropDuplicates([item, "item_print"]))
    # a seed that many items have is one row for each of them, of few numbers
    theirs = pool.select(item, "item_print", F.explode(F.array_distinct("seeds")).alias("seed"))
    found = storage.written(tokens(docs, key, text, bit_set(theirs, "seed", FILTER_BITS, 4096)))
    ours = found.select(key, "print", F.explode(F.array_distinct("seeds")).alias("seed"))
    pairs = ours.join(theirs, "seed").select(key, "print", item, "item_print").distinct()
    texts = found.select(F.col(key).alias("__key"), F.col("print").alias("__print"), "words").dropDuplicates(["__key", "__print"])
    asked = pool.select(F.col(item).alias("__item"), F.col("item_print").alias("__item_print"), F.col("words").alias("item_words"))
    full = pairs.join(asked, F.col(item).eqNullSafe(F.col("__item")) & (F.col("item_print") == F.col("__item_print"))).join(
        texts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("print") == F.col("__print"))
    )

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, covered, number = [], [], []
            for k in range(batch.num_rows):
                a, b = (batch.column(c)[k].values.to_numpy().view(np.uint64) for c in (2, 3))
                got = tiles(a, b)
                size.append(len(a))
                covered.append(sum(x[2] for x in got))
                number.append(len(got))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(x, pa.int64()) for x in (size, covered, number))], [key, item, "n_words", "n_covered", "n_tiles"]
            )

    out = full.select(key, item, "item_words", "words").mapInArrow(tiled, f"{kinds}, n_words bigint, n_covered bigint, n_tiles bigint")
    best = out.groupBy(key, item).agg(F.max(F.struct((F.col("n_covered") / F.col("n_words")).alias("coverage"), "n_words", "n_covered", "n_tiles")).alias("b"))
    return best.select(key, item, "b.n_words", "b.n_covered", "b.n_tiles", "b.coverage").where(F.col("coverage") >= share)
