"""Token ids as Parquet list columns in document order (operator 10).

Documents are dealt into ranges of ids, one file a range, sorted inside it; ids are encoded after the exchange, so that only texts
travel. Files hold `ids array<int>` in delta encoding (dictionary off for it), fixed row groups and pages with page indexes, and
the columns doc_id and n_tokens beside it, so that metadata and single documents are read without the ids of the others.

Defined results: null text has only the end id; repeated rows are written each, next to each other; rows without an id come first; an
empty table gives an empty result; other columns are not written.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bureauflow.llm import ragged
from bureauflow.llm.token_counts import spans

#: Distinct pre-tokens whose ids a Python worker remembers; it starts anew when there are more. Results don't depend on it.
CACHE_WORDS = 1_200_000
#: Words given to the library at a time.
CALL_WORDS = 8_192
ROW_GROUP_BYTES = 8 << 20
PAGE_BYTES = 256 << 10
#: Text bytes encoded at a time.
SLICE_BYTES = 1 << 20
#: About so many documents share a file, more where there would be over MAX_FILES.
FILE_ROWS = 16_384
MAX_FILES = 50_000


@lru_cache(2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Known:
    """Ids of the words that a worker has met: sorted hashes, the number of each, and the ids by number."""

    def __init__(self) -> None:
        self.keys, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.ids, self.bounds = np.empty(1 << 16, np.int32), np.zeros(1, np.int64)

    def add(self, at: np.ndarray, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """New keys, ascending, with their places among the old ones."""
        used = int(self.bounds[-1])
        if used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:used], np.empty(max(used, len(ids)) + len(ids), np.int32)])
        self.ids[used : used + len(ids)] = ids
        self.numbers = np.insert(self.numbers, at, len(self.keys) + np.arange(len(keys), dtype=np.int32))
        self.keys = np.insert(self.keys, at, keys)
        self.bounds = np.concatenate([self.bounds, used + np.cumsum(size)])


_known: dict[str, Known] = {}


def encode_slice(buf: np.ndarray, bounds: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the documents of a slice by the tokenizers library, each distinct pre-token once, and their offsets."""
    own = tokenizer(path)
    special = {t.content.encode(): i for i, t in own.get_added_tokens_decoder().items()}
    starts, ends, _ = spans(buf, bounds, special)
    if not len(starts):
        return np.empty(0, np.int32), np.zeros(len(bounds), np.int64)
    keys = ragged.span_hashes(buf, starts, ends)
    first, which = ragged.unique(keys)
    keys = keys[first]
    known = _known.setdefault(path, Known())
    if len(known.keys) > CACHE_WORDS:
        known = _known[path] = Known()
    at = np.searchsorted(known.keys, keys)
    new = np.ones(len(keys), bool)
    inside = at < len(known.keys)
    new[inside] = known.keys[at[inside]] != keys[inside]
    if new.any():
        raw, made = buf.tobytes(), []
        cuts = list(zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True))
        for k in range(0, len(cuts), CALL_WORDS):
            made += [e.ids for e in own.encode_batch_fast([raw[a:b].decode("utf-8", "replace") for a, b in cuts[k : k + CALL_WORDS]], add_special_tokens=False)]
        known.add(at[new], keys[new], np.fromiter(chain.from_iterable(made), np.int32), np.fromiter(map(len, made), np.int64, len(made)))
    ids, cut = ragged.ragged_take(known.ids, known.bounds, known.numbers[np.searchsorted(known.keys, keys)][which])
    return ids, cut[np.searchsorted(starts, bounds)]


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int | None = 0) -> DataFrame:
    """Per row of docs, in its order and partition: key, n_tokens and ids; end_id is added to each document."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, bounds = ragged.text_bytes(batch.column(1))
            for row, stop, part, offs in ragged.slices(buf, bounds, SLICE_BYTES):
                ids, at = encode_slice(part, offs, path)
                if end_id is not None:
                    ids = np.insert(ids, at[1:], end_id)
                    at = at + np.arange(len(at))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, stop - row), pa.array(np.diff(at)), lists], [key, "n_tokens", "ids"])

    return docs.select(key, text).mapInArrow(encoded, f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens bigint, ids array<int>")


def write_token_files(docs: DataFrame, path: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int | None = 0) -> None:
    """Writes the ids of docs to folder, ascending by key inside each file and from file to file."""
    files = max(1, min(MAX_FILES, -(-docs.select(key).count() // FILE_ROWS)))
    rows = docs.select(key, text).repartitionByRange(files, F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first())
    (
        encode_documents(rows, path, key, text, end_id)
        .write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("compression", "zstd")
        .parquet(folder)
    )


def read_token_files(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """The files' rows with `file` and `place` (row in the file); only the columns named are read."""
    rows = spark.read.parquet(folder)
    return rows.select(*(columns or rows.columns), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))


def with_starts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows (file, place, n_tokens and more, no ids) with start, the ids of all documents before, in place of file and place.

    A sum inside each file, and the totals of the files before it, from a read of n_tokens alone. Files are named in their order.
    """
    totals = sizes.groupBy("file").agg(F.sum("n_tokens").alias("all"))
    before = totals.select("file", (F.sum("all").over(Window.orderBy("file")) - F.col("all")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("within", within - F.col("n_tokens")).join(before, "file").withColumn("start", F.col("within") + F.col("before")).drop("within", "before", "file", "place")


def checksums(rows: DataFrame, kept: list[str], ids: str = "ids") -> DataFrame:
    """Columns kept, and the crc32 of each row's ids as little-endian unsigned 32-bit integers."""
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            offs = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
            sums = [crc32(raw[a * 4 : b * 4]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(sums, pa.int64())], [*kept, "ids_crc32"])

    return rows.select(*kept, ids).mapInArrow(summed, f"{kinds}, ids_crc32 bigint")
