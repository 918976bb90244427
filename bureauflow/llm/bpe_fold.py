"""Byte-level BPE encoding and decoding by higher-order functions (operator 1).

Documents are cut into blocks, and pre-tokens are reduced to distinct words: a block's row carries the words that its task has not sent
before, as byte arrays. Spark folds the merges over each word's byte array: the accumulator holds the word's symbols and the ranks of its
adjacent pairs, a step merges the leftmost pair of lowest rank and looks up the two pairs that are new, in a rank map that is a literal of
the plan. Symbols are ranks of byte strings, so they are the ids. Decoding concatenates the binary pieces of a word's ids. The rows of a
task then meet their words' ids in the order in which they were sent. Nothing is exchanged, and a lost task is simply run again.

The rank map is an array with a row for each left symbol, as a map literal would be searched from its start at each access.

Words of over LONG_WORD bytes, for which a fold of one merge a step would be quadratic, take the array merging of `token_counts`; a caller
can give it shorter words too (fold_bytes), with the same ids.

Defined results: null text encodes to no ids; rows are independent, so repeated rows are encoded each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauflow.llm import ragged
from bureauflow.llm.hof import let
from bureauflow.llm.token_counts import Merges

#: Text bytes of a block; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20
#: Distinct words that a task remembers; it starts anew when there are more. Results don't depend on it.
TASK_WORDS = 1_500_000
#: So many input partitions at most are read by one task, so that more texts share their words.
MERGED_PARTITIONS = 8
LONG_WORD = 512


@lru_cache(2)
def load_ranks(path: str) -> list[bytes]:
    """Byte strings by rank, from a .tiktoken file."""
    with open(path, "rb") as f:
        pairs = [(int(b), base64.b64decode(a)) for a, b in map(bytes.split, f)]
    return [piece for _, piece in sorted(pairs)]


@lru_cache(2)
def rank_pairs(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of pieces whose concatenation is a piece: left, right, rank of the whole."""
    pieces = load_ranks(path)
    ranks = {p: r for r, p in enumerate(pieces)}
    found = [(a, b, r) for r, p in enumerate(pieces) for k in range(1, len(p)) if (a := ranks.get(p[:k])) is not None and (b := ranks.get(p[k:])) is not None]
    return tuple(np.array(x, np.int64) for x in zip(*found, strict=True))


@lru_cache(2)
def long_merges(path: str) -> Merges:
    left, right, rank = rank_pairs(path)
    pieces = load_ranks(path)
    ranks = {p: r for r, p in enumerate(pieces)}
    return Merges(np.array([ranks[bytes([b])] for b in range(256)]), left, right, rank, np.arange(len(pieces)), {})


def rank_map(path: str) -> tuple[list[int], list[int], list[int]]:
    """The pairs as rows of one array: row `left` begins at begins[left]; slot begins[left] + right holds its owner left, and the rank.

    Rows overlap where their slots don't; the fullest are placed first, each at the first of a fixed series of places that is free.
    """
    left, right, rank = rank_pairs(path)
    order = np.argsort(left, kind="stable")
    left, right, rank = left[order], right[order], rank[order]
    names, at, size = np.unique(left, return_index=True, return_counts=True)
    symbols = len(load_ranks(path))
    width = 4 * len(left) + symbols
    owner, held, begins = np.full(width + symbols, -1), np.zeros(width + symbols, np.int64), np.zeros(symbols, np.int64)
    rng = np.random.default_rng(11)
    for k in np.argsort(-size, kind="stable"):
        row = right[at[k] : at[k] + size[k]]
        while (owner[(place := int(rng.integers(width))) + row] >= 0).any():
            pass
        owner[place + row], held[place + row], begins[names[k]] = names[k], rank[at[k] : at[k] + size[k]], place
    return begins.tolist(), owner.tolist(), held.tolist()


def literal(value: object, kind: str) -> Column:
    """A foldable constant of any size: Spark evaluates it once, when it plans."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), kind)


def pair_rank(c: Column, left: Column, right: Column) -> Column:
    """Rank of a pair, or null; null if either is."""
    slot = F.get(c["begins"], left) + right
    return F.when(F.get(c["owner"], slot) == left, F.get(c["held"], slot))


def fold(word: Column, c: Column) -> Column:
    """Ids of a byte array."""
    ranked = lambda a, b: pair_rank(c, a, b)

    def step(acc: Column, _: Column) -> Column:
        ids, ranks = acc["ids"], acc["ranks"]

        def merged(at: Column) -> Column:
            new = F.get(ranks, at - 1)
            head = F.when(at > 1, F.concat(F.slice(ranks, F.lit(1), at - 2), F.array(ranked(F.get(ids, at - 2), new)))).otherwise(F.slice(ranks, 1, 0))
            after = F.struct(
                F.concat(F.slice(ids, F.lit(1), at - 1), F.array(new), F.slice(ids, at + 2, F.size(ids))).alias("ids"),
                F.concat(head, F.array(ranked(new, F.get(ids, at + 1))), F.slice(ranks, at + 2, F.size(ids))).alias("ranks"),
            )
            return F.when(at.isNull(), acc).otherwise(after)

        return let(F.array_position(ranks, F.array_min(ranks)).cast("int"), merged)

    symbols = F.transform(word, lambda b: F.get(c["first"], b.cast("int")))
    start = let(symbols, lambda x: F.struct(x.alias("ids"), F.zip_with(x, F.slice(x, F.lit(2), F.size(x)), ranked).alias("ranks")))
    return F.aggregate(word, start, step, lambda acc: acc["ids"])


def blocks(docs: DataFrame, path: str, key: str, text: str, fold_bytes: int = LONG_WORD) -> DataFrame:
    """A row a block: keys of its documents, words numbered from `base` on as byte arrays, then ids of long words; numbers of the words of
    its documents, bounds of documents in them. base 0 begins a new numbering."""
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = np.empty(0, np.uint64), np.empty(0, np.int32)
        for batch in batches:
            buf, bounds = ragged.text_bytes(batch.column(1))
            for row, stop, part, offs in ragged.slices(buf, bounds, BLOCK_BYTES):
                starts = ragged.pretoken_starts(part, offs)
                size = np.diff(np.append(starts, len(part)))
                keys = ragged.span_hashes(part, starts, starts + size) if len(starts) else np.empty(0, np.uint64)
                first, which = ragged.unique(keys)
                own = keys[first]
                if len(known) > TASK_WORDS:
                    known, numbers = known[:0], numbers[:0]
                at = np.searchsorted(known, own)
                new = np.ones(len(own), bool)
                inside = at < len(known)
                new[inside] = known[at[inside]] != own[inside]
                base = len(known)
                number = np.empty(len(own), np.int32)
                number[~new] = numbers[at[~new]]
                long = size[first] > fold_bytes
                short, far = np.flatnonzero(new & ~long), np.flatnonzero(new & long)
                number[short] = base + np.arange(len(short))
                number[far] = base + len(short) + np.arange(len(far))
                if new.any():
                    known, numbers = np.insert(known, at[new], own[new]), np.insert(numbers, at[new], number[new])
                whole = np.append(starts, len(part))
                held, held_at = ragged.ragged_take(part, whole, first[short]) if len(short) else (part[:0], np.zeros(1, np.int64))
                ids, ids_at = long_merges(path).words(part, starts[first[far]], whole[first[far] + 1]) if len(far) else (np.empty(0, np.int32), np.zeros(1, np.int64))
                one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                ragged_list = lambda v, o: one(pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(v)))
                yield pa.RecordBatch.from_arrays(
                    [
                        one(batch.column(0).slice(row, stop - row)),
                        pa.array([base], pa.int32()),
                        ragged_list(held.astype(np.int16), held_at),
                        ragged_list(ids.astype(np.int32), ids_at),
                        pa.array([number[which].astype("<i4").tobytes()]),
                        pa.array([np.searchsorted(starts, offs).astype("<i8").tobytes()]),
                    ],
                    ["keys", "base", "words", "far", "used", "bounds"],
                )

    parts = docs.rdd.getNumPartitions()
    fewer = max(docs.sparkSession.sparkContext.defaultParallelism, -(-parts // MERGED_PARTITIONS))
    docs = docs.select(key, text)
    docs = docs.coalesce(fewer) if fewer < parts else docs
    return docs.mapInArrow(cut, f"keys array<{kind}>, base int, words array<array<smallint>>, far array<array<int>>, used binary, bounds binary")


def encode_blocks(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", fold_bytes: int = LONG_WORD) -> DataFrame:
    """blocks() with `ids` and `decoded` (binary) of every word that is new in a block. Words of up to fold_bytes bytes are folded."""
    pieces = load_ranks(path)
    ranks = {p: r for r, p in enumerate(pieces)}
    begins, owner, held = rank_map(path) if fold_bytes else ([], [], [])
    constant = literal(
        {"first": [ranks[bytes([b])] for b in range(256)], "begins": begins, "owner": owner, "held": held, "pieces": [base64.b64encode(p).decode() for p in pieces]},
        "struct<first:array<int>,begins:array<int>,owner:array<int>,held:array<int>,pieces:array<binary>>",
    )

    def encoded(c: Column) -> Column:
        words = F.transform("words", lambda w: fold(w, c)) if fold_bytes else F.array().cast("array<array<int>>")
        piece = lambda ids: F.aggregate(ids, F.lit(b""), lambda acc, i: F.concat(acc, F.get(c["pieces"], i)))
        return let(F.concat(words, F.col("far")), lambda ids: F.struct(ids.alias("ids"), F.transform(ids, piece).alias("decoded")))

    rows = blocks(docs, path, key, text, fold_bytes).withColumn("made", let(constant, encoded))
    return rows.select("keys", "base", "used", "bounds", F.col("made.ids").alias("ids"), F.col("made.decoded").alias("decoded"))


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, memoryview, np.ndarray]]:
    """Per block: keys of its documents, their ids and offsets, their decoded bytes and offsets."""
    ids, ids_at = np.empty(0, np.int32), np.zeros(1, np.int64)
    decoded, decoded_at = np.empty(0, np.uint8), np.zeros(1, np.int64)
    for batch in batches:
        for k in range(batch.num_rows):
            keys, base = batch.column(0)[k].values, batch.column(1)[k].as_py()
            used, bounds = np.frombuffer(batch.column(2)[k].as_buffer(), "<i4"), np.frombuffer(batch.column(3)[k].as_buffer(), "<i8")
            new, pieces = batch.column(4)[k].values, batch.column(5)[k].values
            if not base:
                ids, ids_at, decoded, decoded_at = ids[:0], ids_at[:1], decoded[:0], decoded_at[:1]
            if len(new):
                offs = new.offsets.to_numpy().astype(np.int64)
                values, (raw, raw_at) = new.values.to_numpy(zero_copy_only=False), ragged.text_bytes(pieces)
                ids, ids_at = np.concatenate([ids, values[offs[0] : offs[-1]]]), np.concatenate([ids_at, ids_at[-1] + offs[1:] - offs[0]])
                decoded, decoded_at = np.concatenate([decoded, raw]), np.concatenate([decoded_at, decoded_at[-1] + raw_at[1:]])
            own, at = ragged.ragged_take(ids, ids_at, used)
            text, text_at = ragged.ragged_take(decoded, decoded_at, used)
            yield keys, own, at[bounds], memoryview(text), text_at[bounds]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", fold_bytes: int = LONG_WORD) -> DataFrame:
    """Per row of docs: key, ids array<int>, decoded binary."""
    kind = docs.schema[key].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, at, raw, raw_at in joined(batches):
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            cuts = raw_at.tolist()
            yield pa.RecordBatch.from_arrays([keys, lists, pa.array([bytes(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], [key, "ids", "decoded"])

    return encode_blocks(docs, path, key, text, fold_bytes).mapInArrow(made, f"{key} {kind}, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: key, n_tokens, and the sha256 of its decimal ids joined by one space and of its decoded bytes."""
    kind = docs.schema[key].dataType.simpleString()
    symbols = len(load_ranks(path))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = [b"%d" % i for i in range(symbols)]
        for keys, ids, at, raw, raw_at in joined(batches):
            flat, cuts, ends = ids.tolist(), at.tolist(), raw_at.tolist()
            of_ids = [sha256(b" ".join([shown[i] for i in flat[a:b]])).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            of_text = [sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(at)), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return encode_blocks(docs, path, key, text).mapInArrow(digested, f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
