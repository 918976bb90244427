"""Token counts by rank-synchronous merging of ragged symbol arrays (operator 9).

Pre-tokens of a slice of texts are reduced to the distinct ones and held as one flat symbol array with offsets. In each round every
pre-token finds the lowest rank among its adjacent pairs, and all of them merge that pair at the same time; what survives is counted.

Defined results: null text counts as empty (0 tokens, 0 bytes); special strings inside a text are one token each, as the library's
default has it; rows are independent, so repeated rows, ties and extra columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bureauflow.llm import ragged

#: Distinct pre-tokens that a Python worker remembers; it starts anew when there are more. Results don't depend on it.
CACHE_WORDS = 1_500_000
#: Pre-tokens merged together, so that their arrays stay in the processor's cache.
MERGED_WORDS = 16_384
NONE = np.int32(1 << 30)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pairs:
    """Rank of a pair of symbols: a few hash tables, each for the pairs that met a taken slot in the ones before."""

    BITS = 19

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        keys, rank = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64), rank.astype(np.int32)
        self.levels: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        rng = np.random.default_rng(7)
        while len(keys):
            factor = rng.integers(1, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            slot = keys * factor >> np.uint64(64 - self.BITS)
            held, taken = np.full(1 << self.BITS, np.uint64((1 << 64) - 1)), np.full(1 << self.BITS, NONE)
            _, one = np.unique(slot, return_index=True)
            held[slot[one]], taken[slot[one]] = keys[one], rank[one]
            self.levels.append((factor, held, taken))
            rest = np.ones(len(keys), bool)
            rest[one] = False
            keys, rank = keys[rest], rank[rest]

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(len(keys), NONE)
        for factor, held, taken in self.levels:
            slot = keys * factor >> np.uint64(64 - self.BITS)
            np.copyto(out, taken[slot], where=held[slot] == keys)
        return out


class Merges:
    """Pairs of symbols with their ranks; symbols are vocabulary ids."""

    def __init__(self, first: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray, made: np.ndarray, special: dict[bytes, int]):
        """first: the symbol of each byte; left, right, rank: the pairs; made: by rank, what a pair becomes."""
        self.first, self.made, self.special = first.astype(np.int32), made.astype(np.int32), special
        self.ranks = Pairs(left, right, rank)

    def merge(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that survive in each sequence, and their offsets. Sequences aren't empty."""
        n = len(bounds) - 1
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        names, size = np.arange(n), np.diff(bounds)
        last = np.zeros(len(symbols), bool)
        last[bounds[1:] - 1] = True
        rank = np.append(self.ranks(symbols[:-1], symbols[1:]), NONE)
        rank[last] = NONE
        while len(names):
            starts = np.cumsum(size) - size
            least = np.minimum.reduceat(rank, starts)
            live = least < NONE
            if not live.all():
                keep = np.repeat(live, size)
                done.append((names[~live], size[~live], symbols[~keep]))
                names, size, least = names[live], size[live], least[live]
                symbols, rank, last = symbols[keep], rank[keep], last[keep]
                if not len(names):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            # of pairs that overlap, as in a run of one symbol, every second one merges, from the left
            fresh = np.ones(len(hit), bool)
            fresh[1:] = hit[1:] != hit[:-1] + 1
            if not fresh.all():
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            last[hit] = last[hit + 1]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            size = size - np.add.reduceat(~keep, np.cumsum(size) - size, dtype=np.int64)
            at = hit - np.arange(len(hit))
            symbols, rank, last = symbols[keep], rank[keep], last[keep]
            near = np.zeros(len(symbols), bool)
            near[at] = near[np.maximum(at - 1, 0)] = True
            rank[near] = NONE
            touched = np.flatnonzero(near & ~last)
            rank[touched] = self.ranks(symbols[touched], symbols[touched + 1])
        if not done:
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        names, size = np.concatenate([x[0] for x in done]), np.concatenate([x[1] for x in done])
        flat = np.concatenate([x[2] for x in done])
        order = np.argsort(names, kind="stable")
        return ragged.ragged_take(flat, np.concatenate([[0], np.cumsum(size)]), order)

    def words(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the byte spans, and their offsets."""
        ids, sizes = [], [np.zeros(1, np.int64)]
        for at in range(0, len(starts), MERGED_WORDS):
            first, size = starts[at : at + MERGED_WORDS], ends[at : at + MERGED_WORDS] - starts[at : at + MERGED_WORDS]
            bounds = np.concatenate([[0], np.cumsum(size)])
            index = np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], size)
            got, offs = self.merge(self.first[buf[index]], bounds)
            ids.append(got)
            sizes.append(np.diff(offs))
        return np.concatenate(ids) if ids else np.empty(0, np.int32), np.cumsum(np.concatenate(sizes))


@lru_cache(4)
def load_json(path: str) -> Merges:
    """Merges of a byte-level vocabulary file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab, pairs = file["model"]["vocab"], file["model"]["merges"]
    first = np.empty(256, np.int64)
    for char, byte in byte_alphabet().items():
        first[byte] = vocab[char]
    pairs = [p.split(" ") if isinstance(p, str) else p for p in pairs]
    left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
    made = np.array([vocab[p[0] + p[1]] for p in pairs], np.int64)
    return Merges(first, left, right, np.arange(len(made)), made, {t["content"].encode(): t["id"] for t in file.get("added_tokens", [])})


def special_spans(buf: np.ndarray, bounds: np.ndarray, special: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and ids of special strings inside documents, from the left and without overlaps."""
    raw, found = buf.tobytes(), []
    if any(s in raw for s in special):
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            while hits := [(at, -len(s), i) for s, i in special.items() if (at := raw.find(s, a, b)) >= 0]:
                at, size, i = min(hits)
                found.append((at, at - size, i))
                a = at - size
    table = np.array(found, np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def spans(buf: np.ndarray, bounds: np.ndarray, special: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all pre-tokens, and for special strings their id, else -1."""
    first, end, ids = special_spans(buf, bounds, special)
    if not len(first):
        starts = ragged.pretoken_starts(buf, bounds)
        return starts, np.append(starts[1:], len(buf)), np.full(len(starts), -1)
    starts = ragged.pretoken_starts(buf, np.unique(np.concatenate([bounds, first, end])))
    within = np.searchsorted(first, starts, "right") - 1
    inside = (within >= 0) & (starts > first[within]) & (starts < end[within])
    starts = starts[~inside]
    kinds = np.full(len(starts), -1)
    kinds[np.searchsorted(starts, first)] = ids
    return starts, np.append(starts[1:], len(buf)), kinds


_counts: dict[int, int] = {}


def count_slice(buf: np.ndarray, bounds: np.ndarray, path: str) -> np.ndarray:
    """Tokens of each document of a slice."""
    merges = load_json(path)
    starts, ends, kinds = spans(buf, bounds, merges.special)
    if not len(starts):
        return np.zeros(len(bounds) - 1, np.int64)
    keys = ragged.span_hashes(buf, starts, ends)
    first, which = ragged.unique(keys)
    known = _counts
    if len(known) > CACHE_WORDS:
        known.clear()
    names = (keys[first] ^ np.uint64(zlib.crc32(path.encode()))).tolist()
    size = np.array([known.get(k, -1) for k in names], np.int64)
    new = np.flatnonzero(size < 0)
    if len(new):
        _, out = merges.words(buf, starts[first[new]], ends[first[new]])
        size[new] = np.diff(out)
        known.update((names[i], c) for i, c in zip(new.tolist(), size[new].tolist(), strict=True))
    each = np.where(kinds >= 0, 1, size[which])
    total = np.concatenate([[0], np.cumsum(each)])
    at = np.searchsorted(starts, bounds)
    return total[at[1:]] - total[at[:-1]]


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """Per row of docs: its key, n_bytes (UTF-8), n_tokens, over_limit. path: a byte-level file of the tokenizers library."""
    kind = docs.schema[key].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, bounds = ragged.text_bytes(batch.column(1))
            n = [count_slice(part, offs, path) for _, _, part, offs in ragged.slices(buf, bounds)]
            n = np.concatenate(n) if n else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)), pa.array(n), pa.array(n > limit)], [key, "n_bytes", "n_tokens", "over_limit"]
            )

    return docs.select(key, text).mapInArrow(counted, f"{key} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
