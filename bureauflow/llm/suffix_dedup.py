"""Removal of repeated byte strings by blockwise suffix sorting (operator 5).

Every byte covered by a LENGTH-byte string that also starts anywhere else is removed, judged on the input; strings don't cross documents.

1. Buckets. A string of LENGTH bytes belongs to its least GRAM-byte hash (the rightmost of equal ones), which is the same wherever the
   string stands; neighbouring starts share it, so a run of starts is one row. A bucket is what shares a hash. Rows alone in their bucket
   repeat nothing; rows of a bucket whose bytes are all the same repeat wholly. Both are told by counts, summed before they are sent.
2. Sorting. What is left are buckets of different rows, mostly the edges of shared passages; of equal rows one stands for all. Bytes go to a task by bucket, and one
   block of buckets after another is sorted: suffixes by their first PERIOD bytes, and ties beyond by ranks of a difference-cover sample
   that are computed for the block in advance (names of 32, 64 and 128 bytes by doubling). Rows are laid out so that their least hash
   stands at a multiple of PERIOD, so tied suffixes have the same residue and meet the same sample places. A block holds BLOCK_BYTES; this
   bounds a task's memory.
3. A bucket of over HOT_ROWS rows would be an unbounded group: its strings are counted one by one instead, by a 128-bit hash.

Defined results: null text counts as empty; a text of under LENGTH bytes keeps everything; rows with the same id and text are two documents
that repeat each other; rows with an id but different texts stay apart; an empty table gives an empty result; other columns are kept by
`dedup_text` and ignored by `digests`.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.llm import ragged, storage
from bureauflow.llm.bits import bit_set, has_bit

LENGTH = 200
GRAM = 64
SLICE_BYTES = 1 << 20
PERIOD = 32
BLOCK_BYTES = 2 << 20
HOT_ROWS = 20_000
#: Bits of the set of repeated hashes, at most; a full set only sends more rows to the join.
FILTER_BITS = 27


def cover(period: int) -> list[int]:
    """A difference cover: every difference modulo the period is one of two members. Chosen greedily."""
    own, left = [0], set(range(1, period))
    while left:
        best = max(range(1, period), key=lambda d: (len({x for a in own for x in ((a - d) % period, (d - a) % period)} & left), -d))
        left -= {x for a in own for x in ((a - best) % period, (best - a) % period)}
        own.append(best)
    return sorted(own)


def gram_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the GRAM bytes from each place, and running sums that give the hash of any span."""
    n = len(buf)
    up, down = ragged.powers(n + 1)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(ragged._multipliers()[buf] * up[:n], out=total[1:])
    return ragged.mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1]), total


def runs(buf: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of starts with the same least hash: document, first start, number, place of the hash, the hash, hash of the run's bytes."""
    none = tuple(np.empty(0, k) for k in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    size = np.diff(bounds)
    if len(buf) < length or size.max(initial=0) < length:
        return none
    grams, total = gram_hashes(buf)
    # leading bits of the hash, then the place from the end: the least is the rightmost of equal ones
    least = grams & ~np.uint64(0xFFFFFFFF) | (np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64))
    width, done = length - GRAM + 1, 1
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    place = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    doc = np.repeat(np.arange(len(size)), size)[: len(place)]
    fits = bounds[doc + 1] - np.arange(len(place)) >= length
    at = np.flatnonzero(fits)
    new = np.ones(len(at), bool)
    new[1:] = (place[at[1:]] != place[at[:-1]]) | (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])
    first = at[new]
    number = np.diff(np.append(np.flatnonzero(new), len(at)))
    anchor = place[first]
    end = first + number - 1 + length
    _, down = ragged.powers(len(buf) + 1)
    whole = ragged.mix((total[end] - total[first]) * down[first] + ((anchor - first) * 4096 + number).astype(np.uint64))
    return doc[first], first - bounds[doc[first]], number, anchor - first, grams[anchor], whole


def doc_runs(buf: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """runs() of the documents, slice by slice; a very long one in pieces that overlap."""
    for row, stop, part, offs in ragged.slices(buf, bounds, SLICE_BYTES):
        for at in range(0, max(1, len(part)), SLICE_BYTES) if stop - row == 1 and len(part) > 2 * SLICE_BYTES else (None,):
            piece, cuts = (part, offs) if at is None else (p := part[at : at + SLICE_BYTES + length - 1], np.array([0, len(p)]))
            doc, first, *rest = runs(piece, cuts, length)
            if len(doc):
                yield doc + row, first + (at or 0), *rest


def bucket_rows(docs: DataFrame, length: int, bits: np.ndarray | None) -> DataFrame:
    """h and whole of all runs of documents (key, print, text); with a bit set of hashes only of those in it, with key, print, first, number,
    anchor, twin and lead. Rows with the same h and whole in a slice are twins, and repeat wholly whatever other slices hold; only the first
    of them keeps its h, so that copies don't meet in one task."""
    kind = docs.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, bounds = ragged.text_bytes(batch.column(2))
            for doc, first, number, anchor, h, whole in doc_runs(buf, bounds, length):
                if bits is None:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(whole.view(np.int64))], ["h", "whole"])
                    continue
                some = np.flatnonzero(has_bit(bits, h))
                rows = pa.array(doc[some])
                once, which = ragged.unique(ragged.mix(h[some] ^ ragged.mix(whole[some])))
                twin, lead = np.bincount(which)[which] > 1 if len(some) else np.empty(0, bool), np.zeros(len(some), bool)
                lead[once] = True
                dealt = np.where(lead, h[some], ragged.mix(h[some] ^ ragged.mix(np.arange(len(some), dtype=np.uint64))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(dealt.view(np.int64)), pa.array(whole[some].view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array(x[some].astype(np.int32)) for x in (first, number, anchor)), pa.array(twin), pa.array(lead)],
                    ["h", "whole", "key", "print", "first", "number", "anchor", "twin", "lead"],
                )

    schema = "h bigint, whole bigint" if bits is None else f"h bigint, whole bigint, key {kind}, print bigint, first int, number int, anchor int, twin boolean, lead boolean"
    return docs.select("key", "print", "text").mapInArrow(cut, schema)


def words_at(layout: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a big-endian number."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | layout[at + k].astype(np.uint64)
    return out


def named(columns: list[np.ndarray]) -> np.ndarray:
    """Ranks of tuples, from 1; equal tuples have one rank."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    out = np.empty(len(order), np.uint64)
    out[order] = np.cumsum(new).astype(np.uint64)
    return out


def repeated_starts(buf: np.ndarray, bounds: np.ndarray, number: np.ndarray, anchor: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each start of each row of a block, in order, whether its string starts anywhere else in the block.

    buf, bounds: the rows' bytes, number + length - 1 each; anchor: place of the row's least hash.
    """
    if length < 128 + PERIOD:
        raise ValueError(f"strings of {128 + PERIOD} bytes at least")
    size = np.diff(bounds)
    # each row begins so that its anchor is at a multiple of PERIOD, and nothing read beyond a row reaches the next one's strings
    room = -(-(size + 2 * PERIOD) // PERIOD) * PERIOD
    base = np.cumsum(room) - room + (-anchor) % PERIOD
    layout = np.zeros(int(room.sum()) + 256, np.uint8)
    index = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)
    layout[np.repeat(base, size) + index] = buf
    # ranks of the sample, of 32, 64 and 128 bytes
    own = np.zeros(PERIOD, bool)
    own[cover(PERIOD)] = True
    sample = np.flatnonzero(np.resize(own, len(layout) - 256))
    slot = np.full(len(layout) + 256, len(sample), np.int64)
    slot[sample] = np.arange(len(sample))
    rank = {32: named([words_at(layout, sample + k) for k in (0, 8, 16, 24)])}
    for half in (32, 64):
        ahead = np.append(rank[half], np.uint64(0))[slot[sample + half]]
        rank[2 * half] = named([rank[half] << np.uint64(32) | ahead])
    # nearest sample places up to an offset, by residue
    back = np.array([next(d for d in range(PERIOD) if own[(r - d) % PERIOD]) for r in range(PERIOD)])
    starts = np.repeat(base - (np.cumsum(number) - number), number) + np.arange(number.sum())

    def sampled(depth: int, offset: int) -> np.ndarray:
        at = starts[live] + offset
        return rank[depth][slot[at - back[at % PERIOD]]]

    # suffixes by prefix, then by sample ranks up to the string's end; who is alone leaves
    live, group = np.arange(len(starts)), np.zeros(len(starts), np.uint64)
    prefix = [lambda k=k: words_at(layout, starts[live] + k) for k in range(0, PERIOD, 8)]
    residue = [lambda: (starts[live] % PERIOD).astype(np.uint64)]
    deep = [lambda o=o: sampled(128, o) for o in [*range(PERIOD, length - 128, 96), length - 128]]
    tail = [lambda k=k: words_at(layout, starts[live] + k) for k in range(length - PERIOD, length, 8)]
    for column in [*prefix, *residue, *deep, *tail]:
        value = column()
        order = np.lexsort((value, group))
        v, g = value[order], group[order]
        new = np.ones(len(order), bool)
        new[1:] = (v[1:] != v[:-1]) | (g[1:] != g[:-1])
        name = np.cumsum(new) - 1
        many = np.bincount(name)[name] > 1 if len(name) else np.empty(0, bool)
        live, group = live[order[many]], name[many].astype(np.uint64)
    out = np.zeros(len(starts), bool)
    out[live] = True
    return out


def spans_of(hit: np.ndarray, number: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end of the byte spans that the marked starts of rows cover."""
    row = np.repeat(np.arange(len(number)), number)
    place = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(first, number)
    at = np.flatnonzero(hit)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(at)) - 1
    return row[at[new]], place[at[new]], place[at[last]] + length if len(at) else place[:0]


def removed_spans(docs: DataFrame, length: int = LENGTH, hot_rows: int = HOT_ROWS) -> DataFrame:
    """key, print, spans (sorted array of begin, end) of the documents (key, print, text) that lose bytes; spans may overlap."""
    kind = docs.schema["key"].dataType.simpleString()
    counts = bucket_rows(docs, length, None).groupBy("h").agg(F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b"))
    buckets = storage.written(counts.where("n > 1").select("h", (F.col("a") == F.col("b")).alias("same"), (F.col("n") > hot_rows).alias("hot")))
    rows = bucket_rows(docs, length, bit_set(buckets, "h", FILTER_BITS)).join(buckets, "h", "left").where("twin or same is not null")
    rows = rows.withColumns({"same": F.coalesce("same", F.lit(False)), "hot": F.coalesce("hot", F.lit(False))})
    # rows of the same bytes repeat wholly, and the first of them stands for all in the sorting
    alike = Window.partitionBy("h", "whole").orderBy("key", "print", "first")
    rows = rows.withColumns({"rank": F.row_number().over(alike), "more": F.lead("first").over(alike).isNotNull()})
    rows = rows.withColumns(
        {"sorted": F.col("lead") & ~F.col("same") & (F.col("rank") == 1), "same": F.col("same") | F.col("twin") | F.col("more") | (F.col("rank") > 1)}
    )
    found = rows.where("sorted or same").groupBy("key", "print").agg(F.collect_list(F.struct("h", "first", "number", "anchor", "same", "sorted", "hot")).alias("rows"))
    found = storage.written(found)
    mixed = found.select("key", "print", F.filter("rows", lambda r: r["sorted"]).alias("rows")).where("size(rows) > 0")

    def pull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for key, mark, text, own in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                raw = text.encode()
                for r in own:
                    part = raw[r["first"] : r["first"] + r["number"] + length - 1]
                    one = [(r["h"], r["first"], r["number"], r["anchor"], part)]
                    if r["hot"]:
                        one = [(None, r["first"] + k, 1, 0, sha256(part[k : k + length]).digest()[:16]) for k in range(r["number"])]
                    for h, first, number, anchor, data in one:
                        for c, v in zip(out, (h, key.as_py(), mark, first, number, anchor, data), strict=True):
                            c.append(v)
            kinds = [pa.int64(), batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["h", "key", "print", "first", "number", "anchor", "bytes"])

    joined = docs.alias("d").join(mixed.alias("m"), F.col("d.key").eqNullSafe(F.col("m.key")) & (F.col("d.print") == F.col("m.print")))
    parts = joined.select("d.key", "d.print", "d.text", "m.rows").mapInArrow(pull, f"h bigint, key {kind}, print bigint, first int, number int, anchor int, bytes binary")
    parts = storage.written(parts)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(rows: pa.Table) -> pa.RecordBatch:
            buf, bounds = ragged.text_bytes(rows["bytes"])
            number, anchor, first = (rows[c].to_numpy().astype(np.int64) for c in ("number", "anchor", "first"))
            row, begin, end = spans_of(repeated_starts(buf, bounds, number, anchor, length), number, first, length)
            keys = rows.select(["key", "print"]).take(pa.array(row)).combine_chunks()
            one = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
            return pa.RecordBatch.from_arrays([one(keys["key"]), one(keys["print"]), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], ["key", "print", "begin", "end"])

        def ready(last: bool) -> Iterator[pa.RecordBatch]:
            """Blocks of whole buckets; rows come sorted by bucket."""
            if not held:
                return
            rows = pa.Table.from_batches(held)
            held.clear()
            h = rows["h"].to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h))
            if not last:
                held.extend(rows.slice(int(edges[-2])).to_batches())
                edges = edges[:-1]
            size = np.concatenate([[0], np.cumsum(rows["number"].to_numpy().astype(np.int64) + length - 1)])[edges]
            k = 0
            while k < len(edges) - 1:
                stop = max(k + 1, int(np.searchsorted(size, size[k] + BLOCK_BYTES, "right")) - 1)
                yield block(rows.slice(int(edges[k]), int(edges[stop] - edges[k])))
                k = stop

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.nbytes for b in held) >= BLOCK_BYTES:
                yield from ready(False)
        yield from ready(True)

    spans = f"key {kind}, print bigint, begin int, end int"
    sorted_spans = parts.where("h is not null").repartition("h").sortWithinPartitions("h").mapInArrow(sort, spans)
    hot = parts.where("h is null")
    twice = hot.groupBy("bytes").count().where("count > 1").select("bytes")
    hot_spans = hot.join(twice, "bytes").select("key", "print", F.col("first").alias("begin"), (F.col("first") + length).alias("end"))
    same = found.select("key", "print", F.explode(F.filter("rows", lambda r: r["same"])).alias("r"))
    same_spans = same.select("key", "print", F.col("r.first").alias("begin"), (F.col("r.first") + F.col("r.number") + (length - 1)).alias("end"))
    every = sorted_spans.unionByName(hot_spans).unionByName(same_spans)
    return storage.written(every.groupBy("key", "print").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans")))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal spans of sorted ones."""
    out: list[tuple[int, int]] = []
    for s in spans:
        a, b = s["begin"], s["end"]
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    cuts = [0, *(x for s in spans for x in s), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    own = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("key"), F.xxhash64(own).alias("print"), own.alias("text"))


def with_spans(docs: DataFrame, key: str, text: str, length: int = LENGTH, hot_rows: int = HOT_ROWS) -> DataFrame:
    """docs with `__spans`."""
    own = keyed(docs, key, text)
    found = removed_spans(own, length, hot_rows).select(F.col("key").alias("__key"), F.col("print").alias("__print"), F.col("spans").alias("__spans"))
    marked = docs.withColumn("__mark", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return marked.join(found, marked[key].eqNullSafe(found["__key"]) & (F.col("__mark") == F.col("__print")), "left").drop("__key", "__print", "__mark")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256."""
    kind = docs.schema[key].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, spans = (t or "").encode(), merged(s or [])
                rows.append((len(raw), sum(b - a for a, b in spans), len(spans), sha256(kept_bytes(raw, spans)).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    rows = with_spans(docs.select(key, text), key, text, length, hot_rows).select(key, text, "__spans")
    return rows.mapInArrow(made, f"{key} {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def dedup_text(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes cut out of their text. A character that would be cut in two is kept whole."""
    columns = docs.columns
    at = columns.index(text)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, s in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist(), strict=True):
                if s:
                    raw, spans = t.encode(), []
                    for a, b in merged(s):
                        while a < b and raw[a] & 0xC0 == 0x80:
                            a += 1
                        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                            b -= 1
                        spans.append((a, b))
                    t = kept_bytes(raw, spans).decode()
                texts.append(t)
            arrays = [pa.array(texts, batch.schema.field(at).type) if k == at else c for k, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return with_spans(docs, key, text, length).select(*columns, "__spans").mapInArrow(made, docs.schema)
