"""Texts as flat byte arrays: batches, pre-token bounds, word hashes and ragged gathers in numpy.

Everything here works on one slice of an Arrow batch inside a task; its memory is proportional to the slice.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Text bytes handled at a time; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: The code points of the White_Space property.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: The contractions that the byte-level pattern cuts off.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(binary)
    if column.null_count:
        column = column.fill_null(b"" if binary == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or bounds[-1] == bounds[0]:
        return np.empty(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0])), bounds - bounds[0]


def slices(buf: np.ndarray, bounds: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of whole rows of about `size` bytes."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = min(rows, max(row + 1, int(np.searchsorted(bounds, bounds[row] + size, "right")) - 1))
        yield row, end, buf[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of each code point by its general category."""
    table = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for start, end in ((0, 0x3400), (0xA000, 0x20000), (0xE0000, 0xE1000)):
        table[start:end] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(start, end)]
    for start, end in ((0x3400, 0xA000), (0x20000, 0x40000)):
        table[start:end] = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(start, end)), np.uint8, end - start)
    table[WHITE_SPACE] = SPACE
    return table


def byte_classes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Class of the character that each byte belongs to, and the lengths of characters at their lead bytes (None: all ASCII)."""
    table = classes()
    kind = table[:256][buf]
    lead = np.flatnonzero(buf >= 0xC0)
    if not len(lead):
        return kind, None
    first = buf[lead].astype(np.int64)
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    at = lambda k: buf[np.minimum(lead + k, len(buf) - 1)].astype(np.int64) & 0x3F
    code = np.where(
        size == 2,
        ((first & 0x1F) << 6) | at(1),
        np.where(size == 3, ((first & 0x0F) << 12) | (at(1) << 6) | at(2), ((first & 0x07) << 18) | (at(1) << 12) | (at(2) << 6) | at(3)),
    )
    found = table[np.minimum(code, 0x10FFFF)]
    length = np.ones(len(buf), np.uint8)
    length[lead] = size
    for k in range(4):
        long = size > k
        kind[np.minimum(lead[long] + k, len(buf) - 1)] = found[long]
    return kind, length


def pretoken_starts(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First bytes of the matches of the byte-level pattern in every document, in order.

    The alternatives of the pattern become rules on runs of one class: a run begins a match, one blank before it belongs to it, of a
    longer white-space run only the last character is set apart, and a contraction begins where an apostrophe begins a match.
    """
    n = len(buf)
    if not n:
        return np.empty(0, np.int64)
    kind, length = byte_classes(buf)
    doc = np.zeros(n + 1, bool)
    doc[bounds] = True
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change |= doc[:n]
    space = kind == SPACE
    blank = buf == 0x20
    start = change.copy()
    # a non-space run after a blank of the same document starts at that blank
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1] & ~doc[1:n]
    start &= ~(after_blank & ~space)
    # the last character of a white-space run stands alone when text follows
    where = np.flatnonzero(space & ((buf & 0xC0) != 0x80))
    follow = where + (1 if length is None else length[where].astype(np.int64))
    inside = follow < n
    ok = np.zeros(len(where), bool)
    ok[inside] = ~space[follow[inside]] & ~doc[follow[inside]]
    start[where[ok]] = True
    # contractions
    quote = np.flatnonzero((buf == 0x27) & start)
    if len(quote):
        padded = np.concatenate([buf, np.zeros(3, np.uint8)])
        closed = np.concatenate([doc, np.ones(3, bool)])
        for tail in CONTRACTIONS:
            fits = np.ones(len(quote), bool)
            for k, c in enumerate(tail, 1):
                fits &= (padded[quote + k] == ord(c)) & ~closed[quote + k]
            hit = quote[fits]
            start[hit + 1] = False
            past = hit + 1 + len(tail)
            past = past[past < n]
            # what is left of the letter run is a match of its own
            start[past[kind[past] == LETTER]] = True
    return np.flatnonzero(start)


@lru_cache(1)
def _multipliers() -> np.ndarray:
    return np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i < n at least."""
    if len(_powers[0]) < n:
        for at, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _powers[at] = np.multiply.accumulate(row)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans."""
    n = len(buf)
    up, down = powers(n + 1)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_multipliers()[buf] * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of each distinct key, and for each key the number of its distinct one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def ragged_take(values: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows one after another, and their offsets."""
    size = bounds[rows + 1] - bounds[rows]
    out = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(out[-1]) + np.repeat(bounds[rows] - out[:-1], size)
    return values[index], out
