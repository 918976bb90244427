"""Ranked lexical search (operator 13).

The index is a table of shards: some thousands of documents in ascending order of their ids, with a posting list (places and counts) for
each term. Whole documents stay in the task that read them, so building it exchanges nothing but counts of terms. A search reads the
shards once. In each, the impacts of a posting list have a range-maximum sparse table. For a query, an interval of documents is bounded by
the sum of its terms' range maxima; the intervals of the highest bounds are taken first, split at a document of the largest impact, whose
score is then computed, and the rest of the interval is bounded anew on both sides. What can't enter the best k any more is dropped. Some
intervals are taken at a time, so that their sums are array operations. A task keeps the best k of all its shards, which bounds the later
ones, and sends k rows a query at most.

Scores are whole numbers, so results don't depend on how documents are dealt. Terms meet as 64-bit hashes.

Defined results: null text has no terms; a query without terms, or whose terms no document holds, gives no rows; repeated rows are ranked
each, and so are repeated queries; documents without an id come last among equal scores (the id 2 ** 63 - 1 stands for none); very long texts are
read in pieces; an empty table gives an empty result; other columns aren't read. Queries are held in blocks of BLOCK_BYTES of text, for
each of which the shards are read again.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.llm import ragged, storage

TOP = 20
#: A shard ends after the batch that brings it to so many documents, or bytes of text.
SHARD_DOCS, SHARD_BYTES = 16_384, 64 << 20
#: Text bytes handled at a time.
PIECE = 1 << 20
#: Text bytes of the queries that are held at a time.
BLOCK_BYTES = 2 << 20
#: Intervals split at a time.
SPLITS = 32
#: Parts in which a query's rows meet before the last ranking.
PARTS = 32
#: The score's formula.
LENGTH_FREE, LENGTH_SHARE, TF_UNIT, TF_SCALE, LENGTH_SCALE = 75, 25, 1_000_000_000, 1000, 12
NO_ID = (1 << 63) - 1
SHARD_SCHEMA = "n_docs bigint, n_terms bigint, ids array<bigint>, lengths array<int>, terms array<bigint>, sizes array<int>, places array<int>, counts array<int>"


def _term_bytes() -> np.ndarray:
    """Each byte of a term in lower case, 0 for those that end one."""
    table = np.zeros(256, np.uint8)
    table[0x30:0x3A] = np.arange(0x30, 0x3A)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x80:] = np.arange(0x80, 0x100)
    return table


TERM_BYTES = _term_bytes()


def term_hashes(buf: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of every term of a batch of texts, in pieces that end between terms."""
    low = TERM_BYTES[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[bounds] = True
    at = 0
    while at < len(buf):
        stop = min(len(buf), at + PIECE)
        while stop < len(buf) and low[stop - 1] and low[stop] and not cut[stop]:
            gaps = np.flatnonzero((low[at:stop] == 0) | cut[at:stop])
            if len(gaps) and gaps[-1]:
                stop = at + int(gaps[-1])
                break
            stop = min(len(buf), stop + PIECE)
        part = low[at:stop]
        inside = part != 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | cut[at + 1 : stop]
        ends[:-1] &= ~inside[1:] | cut[at + 1 : stop]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        yield np.searchsorted(bounds, first + at, "right") - 1, ragged.span_hashes(part, first, last)
        at = stop


class Shard:
    """Documents being gathered."""

    def __init__(self) -> None:
        self.docs = self.size = self.terms = 0
        self.ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray, texts: pa.Array, wanted: np.ndarray | None) -> None:
        buf, bounds = ragged.text_bytes(texts)
        lengths = np.zeros(len(ids), np.int64)
        for row, term in term_hashes(buf, bounds):
            lengths += np.bincount(row, minlength=len(ids))
            if wanted is not None:
                at = np.minimum(np.searchsorted(wanted, term), max(0, len(wanted) - 1))
                keep = wanted[at] == term if len(wanted) else np.zeros(len(term), bool)
                row, term = row[keep], term[keep]
            order = np.lexsort((term, row))
            row, term = row[order], term[order]
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])])[: len(row)])
            self.found.append((row[new] + self.docs, term[new], np.diff(np.append(new, len(row)))))
        self.ids.append(ids)
        self.lengths.append(lengths)
        self.docs, self.size = self.docs + len(ids), self.size + len(buf)

    def full(self) -> bool:
        return self.docs >= SHARD_DOCS or self.size >= SHARD_BYTES

    def batch(self) -> pa.RecordBatch:
        """A row of SHARD_SCHEMA: documents with terms by ascending id, posting lists one after another by ascending hash."""
        ids, lengths = np.concatenate(self.ids), np.concatenate(self.lengths)
        kept = np.flatnonzero(lengths)
        kept = kept[np.argsort(ids[kept], kind="stable")]
        place = np.zeros(len(ids), np.int64)
        place[kept] = np.arange(len(kept))
        row, term, count = (np.concatenate(x) for x in zip(*self.found, strict=True)) if self.found else (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))
        row = place[row]
        order = np.lexsort((row, term))
        row, term, count = row[order], term[order], count[order]
        # a text that came in pieces has a term more than once
        new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])])[: len(row)])
        row, term, count = row[new], term[new], np.add.reduceat(count, new) if len(new) else count
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])[: len(term)])
        whole = [len(kept), int(lengths.sum())]
        lists = [(ids[kept], pa.int64()), (lengths[kept], pa.int32()), (term[first].view(np.int64), pa.int64()), (np.diff(np.append(first, len(term))), pa.int32()), (row, pa.int32()), (count, pa.int32())]
        arrays = [pa.array([v], pa.int64()) for v in whole] + [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v).cast(t)) for v, t in lists]
        return pa.RecordBatch.from_arrays(arrays, ["n_docs", "n_terms", "ids", "lengths", "terms", "sizes", "places", "counts"])


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", wanted: np.ndarray | None = None) -> DataFrame:
    """Shards of all documents. wanted: sorted hashes of the only terms whose postings are needed; counts and lengths are of all terms."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            shard.add(batch.column(0).fill_null(NO_ID).to_numpy(), batch.column(1), wanted)
            if shard.full():
                yield shard.batch()
                shard = Shard()
        if shard.docs:
            yield shard.batch()

    return docs.select(F.col(key).cast("bigint"), text).mapInArrow(built, SHARD_SCHEMA)


def lists_of(batch: pa.RecordBatch, names: list[str]) -> Iterator[list[np.ndarray]]:
    for k in range(batch.num_rows):
        yield [batch.column(batch.schema.get_field_index(n))[k].values.to_numpy(zero_copy_only=False) for n in names]


def document_counts(index: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """Number of documents that hold each wanted term; terms that none holds are left out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, sizes in lists_of(batch, ["terms", "sizes"]):
                at = np.searchsorted(wanted, terms.view(np.uint64))
                inside = at < len(wanted)
                inside[inside] = wanted[at[inside]] == terms.view(np.uint64)[inside]
                total[at[inside]] += sizes[inside]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["term", "docs"])

    rows = index.select("terms", "sizes").mapInArrow(counted, "term int, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs"))
    return {int(wanted[r["term"]]): r["docs"] for r in rows.toLocalIterator()}


def weight(n_docs: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * docs + 1)))


def impact(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score."""
    m = LENGTH_FREE + (LENGTH_SHARE * lengths * n_docs) // n_terms
    return weights * ((TF_UNIT * counts) // (TF_SCALE * counts + LENGTH_SCALE * m))


def range_maxima(values: np.ndarray, longest: int) -> np.ndarray:
    """Row j: place of the leftmost largest of the 2 ** j values from each place on, for ranges of up to `longest`."""
    table = [np.arange(len(values), dtype=np.int32)]
    for j in range(max(1, longest).bit_length() - 1):
        left = table[-1]
        right = np.concatenate([left[1 << j :], left[len(left) - min(len(left), 1 << j) :]])
        table.append(np.where(values[right] > values[left], right, left).astype(np.int32))
    return np.stack(table)


class Postings:
    """The posting lists of a shard with their impacts and range maxima."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, sizes: np.ndarray, places: np.ndarray, counts: np.ndarray, weights: dict[int, int], n_docs: int, n_terms: int) -> None:
        self.ids = ids
        all_weights = np.array([weights.get(t, -1) for t in terms.view(np.uint64).tolist()], np.int64)
        known = np.flatnonzero(all_weights >= 0)
        bounds = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        rows, self.bounds = ragged.ragged_take(np.arange(len(places)), bounds, known)
        self.place = places[rows].astype(np.int64)
        self.number = {t: k for k, t in enumerate(terms.view(np.uint64)[known].tolist())}
        owner = np.repeat(np.arange(len(known)), np.diff(self.bounds))
        self.keys = owner * max(1, len(ids)) + self.place
        self.impact = impact(all_weights[known][owner], counts[rows].astype(np.int64), lengths.astype(np.int64)[self.place], n_docs, n_terms)
        self.table = range_maxima(self.impact, int(np.diff(self.bounds).max(initial=0)))

    def maxima(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest impact of each range of postings and the leftmost place that has it; 0 of an empty range."""
        some = high > low
        level = np.frexp(np.maximum(high - low, 1).astype(np.float64))[1] - 1
        left = self.table[level, np.where(some, low, 0)]
        right = self.table[level, np.where(some, high - (1 << level), 0)]
        at = np.where(self.impact[right] > self.impact[left], right, left)
        return np.where(some, self.impact[at], 0), at


class Best:
    """The best k documents of a query so far: highest score, then least id."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> tuple[int, int]:
        """Score and id of the last; what isn't above them can't enter."""
        return (int(self.scores[-1]), int(self.ids[-1])) if len(self.scores) == self.k else (0, NO_ID)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_shard(shard: Postings, terms: list[int], times: list[int], best: Best) -> None:
    """Brings the best documents of a shard into best, by intervals of falling bounds."""
    own = [(shard.number[t], n) for t, n in zip(terms, times, strict=True) if t in shard.number]
    if not own:
        return
    number, repeat = np.array([n for n, _ in own]), np.array([n for _, n in own], np.int64)[None]
    docs = len(shard.ids)
    shift = (number * max(1, docs))[None]
    heap: list[tuple[int, int, int]] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []  # posting ranges of the intervals, by the block that made them

    def bounded(first: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Puts intervals that may hold one of the best on the heap. first: their first documents."""
        most, at = shard.maxima(low, high)
        most *= repeat
        bound = most.sum(1)
        top = most.argmax(1)
        split = shard.place[at[np.arange(len(at)), top]]
        score, last = best.least()
        keep = np.flatnonzero((bound > score) | (bound == score) & (bound > 0) & (shard.ids[np.minimum(first, docs - 1)] < last))
        if len(keep):
            held.append((low[keep], high[keep]))
            block = len(held) - 1
            for row, (b, f, d) in enumerate(zip((-bound[keep]).tolist(), first[keep].tolist(), split[keep].tolist(), strict=True)):
                heapq.heappush(heap, (b, f, d, block, row))

    bounded(np.zeros(1, np.int64), shard.bounds[number][None], shard.bounds[number + 1][None])
    while heap:
        score, last = best.least()
        taken = []
        while heap and len(taken) < SPLITS:
            bound, first, doc, block, row = heapq.heappop(heap)
            if -bound < score:
                heap.clear()
            elif -bound > score or shard.ids[first] < last:
                taken.append((first, doc, block, row))
        if not taken:
            break
        first, doc = (np.array([t[k] for t in taken], np.int64) for k in (0, 1))
        low = np.stack([held[b][0][r] for _, _, b, r in taken])
        high = np.stack([held[b][1][r] for _, _, b, r in taken])
        keys = shift + doc[:, None]
        at = np.searchsorted(shard.keys, keys)
        found = at < len(shard.keys)
        found[found] = shard.keys[at[found]] == keys[found]
        best.add((np.where(found, shard.impact[np.where(found, at, 0)], 0) * repeat).sum(1), shard.ids[doc])
        bounded(np.concatenate([first, doc + 1]), np.concatenate([low, at + found]), np.concatenate([at, high]))


def query_terms(texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
    """Distinct hashes of each query's terms and how often it has them."""
    buf, bounds = ragged.text_bytes(pa.array(texts, pa.string()))
    pieces = list(term_hashes(buf, bounds))
    row = np.concatenate([np.empty(0, np.int64), *(r for r, _ in pieces)])
    term = np.concatenate([np.empty(0, np.uint64), *(t for _, t in pieces)])
    ends = np.searchsorted(row, np.arange(len(texts) + 1))
    return [tuple(x.tolist() for x in np.unique(term[a:b], return_counts=True)) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def search(index: DataFrame, queries: list[tuple[object, str | None]], kind: str, k: int = TOP) -> DataFrame:
    """number (of the query in the list), item, doc_id, score of every query's k best documents and some that lost, from each task."""
    asked = query_terms([q[1] for q in queries])
    wanted = np.unique(np.array([t for terms, _ in asked for t in terms], np.uint64))
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = totals[0] or 0, totals[1] or 0
    weights = {t: weight(n_docs, d) for t, d in document_counts(index, wanted).items()}
    kept = [(number, terms, times) for number, (terms, times) in enumerate(asked) if terms]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: Best(k) for number, _, _ in kept}
        for batch in batches:
            for lists in lists_of(batch, ["ids", "lengths", "terms", "sizes", "places", "counts"]):
                shard = Postings(*lists, weights, n_docs, n_terms)
                for number, terms, times in kept:
                    search_shard(shard, terms, times, best[number])
        for number, found in best.items():
            if len(found.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found.ids), number, np.int32)), pa.array(found.ids, mask=found.ids == NO_ID), pa.array(found.scores)], ["number", "doc_id", "score"])

    rows = index.mapInArrow(searched, "number int, doc_id bigint, score bigint")
    items = rows.sparkSession.createDataFrame([(n, q[0]) for n, q in enumerate(queries)], f"number int, item {kind}")
    return rows.join(F.broadcast(items), "number")


def ranked(rows: DataFrame, k: int = TOP) -> DataFrame:
    """The k best rows of each number with their rank; a query's rows meet in parts first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    first = F.row_number().over(Window.partitionBy("number", part).orderBy(*order))
    last = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    return rows.withColumn("rank", first).where(F.col("rank") <= k).withColumn("rank", last).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text") -> DataFrame:
    """item, rank, doc_id, score of the k documents of the highest score above 0 of each query."""
    kind = queries.schema[item].dataType.simpleString()
    asked = queries.select(F.col(item).alias("item"), F.col(query).alias("query"))
    blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("query"))).first()[0] or 0) // BLOCK_BYTES))
    out = None
    for block in range(blocks):
        own = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item", "query"), F.lit(blocks)) == block)
        held = [(r["item"], r["query"]) for r in own.toLocalIterator()]
        wanted = np.unique(np.array([t for terms, _ in query_terms([q for _, q in held]) for t in terms], np.uint64))
        index = storage.written(build_index(docs, key, text, wanted))
        found = ranked(search(index, held, kind, k), k).select(F.col("item").alias(item), "rank", F.col("doc_id").alias(key), "score")
        out = found if out is None else out.unionByName(found)
    return out
