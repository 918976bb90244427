"""N-gram Jaccard join by universe partition (operator 7).

A text's set is its distinct SHINGLE-word sequences, as 64-bit hashes. Sets are sorted into size bands; a pair that is similar enough lies in
one band or two neighbouring ones, and differs in H elements at most, H following from the band. Each band has a scheme that hashes the
universe of elements into parts. A part counts 1 if it is indexed as it is, or 2 if it is indexed with its one-deletion neighbourhood; when
the parts count over H, two similar sets agree in a part. How many parts of either kind a band has is chosen by the expected number of index
entries. Parts without elements (for deletions: with one at most) would be common to everybody: the parts count SLACK more than needed, and
only sets with more such parts than that index them too.

Equal sets are one set from the start. Each set has a center, the set of most index entries among those that its entries bring it together
with, and is first tried against it, then against one set of each of its entries. What an entry still brings together from different
components is compared in pairs, after exact bounds (sizes; bits of parity, of which a differing element flips one). Sets near the same
center, and not smaller, are not: of two in different components one isn't linked to the center, and if it shared elements of the center
only with the other, it would be no more similar to that than to the center. So they link only if they share an element outside the center,
and meet by those. Pairs are verified on the whole sets. No entry's pairs are expanded where its sets are linked already, and no link between
different components is lost.

Defined results: null and empty texts have empty sets and no links; rows with the same set are one component; component ids are least ids,
null for a row without an id that is linked to nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.llm import ragged, storage
from bureauflow.llm.bits import bit_set, has_bit
from bureauflow.llm.components import components

SHINGLE = 4
SHARE = (85, 100)
#: Longs of the parity bits of a small set.
LEAST_LONGS = 4
FILTER_BITS = 27
#: Times that the sets of an entry are tried against one of them, another one each time. Results don't depend on it.
STARS = 2
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def word_sets(buf: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their offsets. A-Z count as a-z; blanks are 0x20 and 0x09-0x0D."""
    n = len(bounds) - 1
    if not len(buf):
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    buf = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
    inner = ~((buf == 0x20) | ((buf >= 9) & (buf <= 13)))
    begin, stop = inner.copy(), np.zeros(len(buf) + 1, bool)
    begin[1:] &= ~inner[:-1]
    stop[1:-1] = inner[:-1] & ~inner[1:]
    begin[bounds[bounds < len(buf)]] = inner[bounds[bounds < len(buf)]]
    ends = bounds[bounds > 0]
    stop[ends] = inner[ends - 1]
    starts = np.flatnonzero(begin)
    words = ragged.span_hashes(buf, starts, np.flatnonzero(stop))
    at = np.searchsorted(starts, bounds)
    doc = np.repeat(np.arange(n), np.diff(at))
    grams = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        grams = grams * _BASE + words[k : k + len(grams)]
    inside = doc[: len(grams)] == doc[size - 1 :] if len(grams) else np.empty(0, bool)
    values, owner = grams[inside], doc[: len(grams)][inside]
    count = np.diff(at)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            more = count[short] > k
            whole[more] = whole[more] * _BASE + words[at[short[more]] + k]
        values, owner = np.concatenate([values, whole + count[short].astype(np.uint64)]), np.concatenate([owner, short])
    values = ragged.mix(values)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=n))])


def per_row(f: np.ufunc, values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """f.reduce of each row's values, 0 for an empty row."""
    out = np.zeros(len(offs) - 1, values.dtype)
    full = np.flatnonzero(np.diff(offs))
    if len(full):
        out[full] = f.reduceat(values, offs[full])
    return out


def set_ids(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """64-bit ids of sets; the same for the same set."""
    return ragged.mix(per_row(np.add, ragged.mix(values ^ np.uint64(0x5851F42D4C957F2D)), offs) + np.diff(offs).astype(np.uint64))


def parities(values: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bits of each row as longs, and their offsets: each element flips the bit that its last bits name.

    A set of n elements has a power of two of longs, 2 n bits about. Half as many are the exclusive or of both halves.
    """
    size = np.diff(offs)
    longs = np.maximum(LEAST_LONGS, 1 << np.ceil(np.log2(np.maximum(size, 1) / 32)).clip(0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(longs)])
    row = np.repeat(np.arange(len(size)), size)
    place = (values & (64 * longs[row] - 1).astype(np.uint64)).astype(np.int64) + 64 * at[row]
    out = np.zeros(64 * int(at[-1]), np.uint8)
    np.bitwise_xor.at(out, place, 1)
    return np.packbits(out, bitorder="little").view(np.int64), at


@lru_cache(4)
def band_edges(share: tuple[int, int]) -> tuple[int, ...]:
    """Least sizes of the bands: similar sets are in the same band or in neighbouring ones."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * share[1] // share[0] + 1)
    return tuple(out)


@lru_cache(None)
def scheme(band: int, share: tuple[int, int]) -> tuple[int, int, int]:
    """Parts indexed as they are, parts with deletions, and the slack, of the least expected number of entries; (0, 0, 0): no different sets
    are similar."""
    edges = band_edges(share)
    low, high = edges[band], edges[band + 1] - 1
    differ = high * (share[1] - share[0]) // share[0]
    if not differ:
        return 0, 0, 0
    best = None
    for deletions in sorted({*range(min(differ // 2 + 2, 12)), (differ + 2) // 2}):
        slack = 0
        for _ in range(40):
            plain = max(0, differ + 1 + slack - 2 * deletions)
            parts = plain + deletions
            if not parts:
                break
            mean = low / parts
            empty = plain * exp(-mean) + 2 * deletions * exp(-mean) * (1 + mean) if parts > 1 else 0.0
            need = int(empty + 5 * sqrt(empty) + 0.99)
            if need <= slack:
                cost = plain + deletions * (1 + mean)
                if best is None or cost < best[0]:
                    best = cost, (plain, deletions, slack)
                break
            slack = need
    return best[1] if best else (0, 1 + (differ + 1) // 2, 0)


def entries(values: np.ndarray, offs: np.ndarray, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every index entry of the sets: their own band's scheme and that of the band below."""
    size = np.diff(offs)
    own = np.searchsorted(band_edges(share), size, "right") - 1
    rows, hashes = [], []
    for shift in (0, 1):
        band = own - shift
        kinds = {int(b): scheme(int(b), share) for b in np.unique(band) if b >= 0}
        use = np.array([b >= 0 and sum(kinds[b][:2]) > 0 for b in band.tolist()], bool)
        pick = np.flatnonzero(use)
        if not len(pick):
            continue
        plain, deletions, slack = (np.array([kinds[b][k] for b in band[pick].tolist()], np.int64) for k in range(3))
        parts = plain + deletions
        flat, flat_at = ragged.ragged_take(values, offs, pick)
        row = np.repeat(np.arange(len(pick)), size[pick])
        salt = ragged.mix(band[pick].astype(np.uint64) + np.uint64(77))
        spread = ragged.mix(flat ^ salt[row])
        part = ((spread >> np.uint64(32)) * parts[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        base = np.cumsum(parts) - parts
        slot = base[row] + part
        total, count = np.zeros(int(parts.sum()), np.uint64), np.bincount(slot, minlength=int(parts.sum()))
        mixed = ragged.mix(flat + np.uint64(0x2545F4914F6CDD1D))
        np.add.at(total, slot, mixed)
        owner = np.repeat(np.arange(len(pick)), parts)
        number = np.arange(len(owner)) - base[owner]
        deleted = number >= plain[owner]
        # parts that everybody shares: only sets with more of them than the slack index them
        idle = np.where(deleted, count <= 1, count == 0)
        weight = np.bincount(owner, idle * (1 + deleted), minlength=len(pick))
        sparse = (weight > slack)[owner]
        mark = ragged.mix(number.astype(np.uint64) ^ salt[owner])
        whole = np.flatnonzero((count > 0) | sparse)
        rows.append(pick[owner[whole]])
        hashes.append(ragged.mix(total[whole] ^ mark[whole]))
        some = np.flatnonzero(deleted[slot] & ((count[slot] > 1) | sparse[slot]))
        rows.append(pick[row[some]])
        hashes.append(ragged.mix((total[slot[some]] - mixed[some]) ^ mark[slot[some]]))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


def signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def described(docs: DataFrame, shingle: int) -> DataFrame:
    """key, n, id and parity bits of each row's set."""
    kind = docs.schema["key"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, bounds = ragged.text_bytes(batch.column(1))
            for row, stop, part, offs in ragged.slices(buf, bounds):
                values, at = word_sets(part, offs, shingle)
                bits, bits_at = parities(values, at)
                lists = pa.ListArray.from_arrays(pa.array(bits_at.astype(np.int32)), pa.array(bits))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, stop - row), pa.array(np.diff(at)), signed(set_ids(values, at)), lists], ["key", "n", "id", "bits"])

    return docs.select("key", "text").mapInArrow(made, f"key {kind}, n bigint, id bigint, bits array<bigint>")


def indexed(docs: DataFrame, shingle: int, share: tuple[int, int], bits: np.ndarray | None) -> DataFrame:
    """entry of each different set of a task; with a bit set, only entries in it, with id and n."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            buf, bounds = ragged.text_bytes(batch.column(0))
            for _, _, part, offs in ragged.slices(buf, bounds):
                values, at = word_sets(part, offs, shingle)
                ids = set_ids(values, at)
                new = []
                for k, i in enumerate(ids.tolist()):
                    if i not in seen and at[k + 1] > at[k]:
                        seen.add(i)
                        new.append(k)
                if len(seen) > 1_000_000:
                    seen.clear()
                values, at = ragged.ragged_take(values, at, np.array(new, np.int64))
                row, entry = entries(values, at, share)
                if bits is None:
                    yield pa.RecordBatch.from_arrays([signed(entry)], ["entry"])
                    continue
                some = np.flatnonzero(has_bit(bits, entry))
                own = np.array(new, np.int64)[row[some]]
                yield pa.RecordBatch.from_arrays([signed(entry[some]), signed(ids[own]), pa.array(np.diff(at)[row[some]])], ["entry", "id", "n"])

    return docs.select("text").mapInArrow(made, "entry bigint" if bits is None else "entry bigint, id bigint, n bigint")


def sets_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """id and elements (ascending) of the sets that rows (key, id) of wanted have; other rows' texts are passed over."""
    bits = bit_set(wanted.select(F.xxhash64("key").alias("k")), "k", FILTER_BITS)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = np.flatnonzero(has_bit(bits, batch.column(0).to_numpy().view(np.uint64)))
            buf, bounds = ragged.text_bytes(batch.column(1).take(pa.array(some)))
            for _, _, part, offs in ragged.slices(buf, bounds):
                values, at = word_sets(part, offs, shingle)
                yield pa.RecordBatch.from_arrays([signed(set_ids(values, at)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), signed(values))], ["id", "elements"])

    rows = docs.select(F.xxhash64("key").alias("k"), "text").mapInArrow(made, "id bigint, elements array<bigint>")
    return rows.join(wanted.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])


def may_link(a: str, b: str, share: tuple[int, int]) -> Column:
    """Whether sizes and parity bits leave a link possible; exact bounds."""
    few, many = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    x, y = F.col(f"{a}.bits"), F.col(f"{b}.bits")

    def flips_of(p: Column, q: Column) -> Column:
        return F.aggregate(F.zip_with(p, q, lambda i, j: F.bit_count(i.bitwiseXOR(j))), F.lit(0), lambda s, i: s + i)

    def halved(p: Column) -> Column:
        half = F.floor(F.size(p) / 2).cast("int")
        return F.zip_with(F.slice(p, F.lit(1), half), F.slice(p, half + 1, half), lambda i, j: i.bitwiseXOR(j))

    # sizes that may link give as many bits, or twice as many
    flips = (
        F.when(F.size(x) == F.size(y), flips_of(x, y))
        .when(F.size(x) == 2 * F.size(y), flips_of(halved(x), y))
        .when(2 * F.size(x) == F.size(y), flips_of(x, halved(y)))
        .otherwise(F.lit(0))
    )
    # of n + m elements, d differ: (n + m - d) / (n + m + d) is the similarity
    total = few + many
    return (few * share[1] >= many * share[0]) & (share[1] * (total - flips) >= share[0] * (total + flips))


def verified(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose sets are similar."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                x, y = (batch.column(c)[k].values.to_numpy() for c in (2, 3))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(share[1] * both >= share[0] * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    full = pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(linked, "a bigint, b bigint")


def outside(centered: DataFrame, sets: DataFrame) -> DataFrame:
    """id, c and the elements that the set id has and its center c has not (out), where c has half of the set's elements or more."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, lists = [], []
            for k in range(batch.num_rows):
                x, y = (batch.column(c)[k].values.to_numpy() for c in (2, 3))
                out = np.setdiff1d(x, y, assume_unique=True)
                near.append(2 * len(out) <= len(x))
                if near[-1]:
                    lists.append(out)
            at = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            out = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.empty(0, np.int64), *lists])))
            yield pa.RecordBatch.from_arrays([*(c.filter(pa.array(near, pa.bool_())) for c in batch.columns[:2]), out], ["id", "c", "out"])

    full = centered.join(sets.select("id", F.col("elements").alias("x")), "id").join(sets.select(F.col("id").alias("c"), F.col("elements").alias("y")), "c")
    return full.select("id", "c", "x", "y").mapInArrow(made, "id bigint, c bigint, out array<bigint>")


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, share: tuple[int, int] = SHARE) -> DataFrame:
    """Per row: key, n_shingles, component_id (the least key that links reach)."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    own = storage.written(described(docs, shingle))
    heads = storage.written(own.where("n > 0").groupBy("id").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("bits").alias("bits")))
    # most entries are met once, so counts would fill a map of all of them before the exchange; a sort finds the second of each in less
    # memory, and a task sends two of an entry at most
    second = F.row_number().over(Window.partitionBy("entry").orderBy("entry"))
    shared = storage.written(indexed(docs, shingle, share, None).withColumn("place", second).where("place = 2").select("entry"))
    rows = storage.written(indexed(docs, shingle, share, bit_set(shared, "entry", FILTER_BITS)).dropDuplicates(["entry", "id"]))

    spark, passing = docs.sparkSession, []

    def passing_table(rows: DataFrame) -> DataFrame:
        """rows, written until what follows from them is."""
        passing.append(storage.shared_folder(spark))
        return storage.written(rows, passing[-1])

    def passed() -> None:
        storage.remove(spark, *passing)
        passing.clear()

    def checked(pairs: DataFrame) -> DataFrame:
        """pairs (a, b and more) that may link."""
        x, y = heads.select(F.col("id").alias("a"), F.struct("n", "bits").alias("x")), heads.select(F.col("id").alias("b"), F.struct("n", "bits").alias("y"))
        return pairs.join(x, "a").join(y, "b").where(may_link("x", "y", share)).drop("x", "y")

    def sets_in(pairs: DataFrame, a: str, b: str) -> DataFrame:
        asked = pairs.select(F.explode(F.array(a, b)).alias("id")).distinct().join(heads.select("id", "key"), "id")
        return passing_table(sets_of(docs, passing_table(asked), shingle))

    def links_of(pairs: DataFrame) -> DataFrame:
        return verified(pairs, sets_in(pairs, "a", "b"), share)

    # each set with its center: entries are indexed if others have them too, so copies that differ in little from many have most
    ranks = rows.groupBy("id").agg(F.struct(F.count("*").alias("shared"), (-F.first("n")).alias("less"), F.col("id").alias("c")).alias("rank"))
    best = rows.select("entry", "id").join(storage.written(ranks), "id").groupBy("entry").agg(F.max("rank").alias("rank"))
    centered = storage.written(rows.join(best, "entry").groupBy("id").agg(F.first("n").alias("n"), F.max("rank").alias("rank")).select("id", "n", "rank.c", "rank.less"))
    tried = centered.where("id <> c").select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()
    first = storage.written(checked(tried).select("a", "b"))
    links, done = storage.written(links_of(first)), first
    passed()
    labels = components(links)

    def placed_by(labels: DataFrame) -> DataFrame:
        """rows with the component of their set."""
        found = rows.join(labels.withColumnRenamed("node", "id"), "id", "left")
        return passing_table(found.select("entry", "id", "n", F.coalesce("component", "id").alias("component")))

    # then each set with one set of each of its entries that is in another component; a pair for a row at most
    for turn in range(STARS):
        placed = placed_by(labels)
        center = F.min_by(F.struct("id", "component"), F.xxhash64("id", F.lit(turn)))
        centers = placed.groupBy("entry").agg(center.alias("c"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        pairs = placed.join(centers.select("entry", "c"), "entry").where("component <> c.component")
        pairs = pairs.select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct()
        more = storage.written(checked(pairs).join(done, ["a", "b"], "left_anti").select("a", "b"))
        passed()
        if not more.isEmpty():
            done = storage.written(done.unionByName(more))
            links = storage.written(links.unionByName(links_of(more)))
            passed()
            labels = components(links)
    # sets of different components near one center that is no larger
    placed = placed_by(labels)
    open_ = placed.groupBy("entry").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("entry")
    open_rows = passing_table(placed.join(open_, "entry"))
    asked = storage.written(centered.where("n >= -less").join(open_rows.select("id").distinct(), "id", "left_semi").select("id", "c"))
    near = passing_table(outside(asked, sets_in(asked, "id", "c")))
    full = heads.select("id", F.struct("n", "bits").alias("s")).join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    outs = passing_table(near.select("id", "c", F.explode("out").alias("z")).join(full, "id"))

    def cross(x: DataFrame, y: DataFrame, same: Column) -> DataFrame:
        meet = same & (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component"))
        return x.join(y, meet & may_link("x.s", "y.s", share)).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))

    x, y = outs.alias("x"), outs.alias("y")
    by_center = cross(x, y, (F.col("x.c") == F.col("y.c")) & (F.col("x.z") == F.col("y.z")))
    # what an entry still brings together of others
    open_rows = open_rows.join(near.select("id", "c"), "id", "left")
    lone = F.count("c") < F.count("*")
    open_ = open_rows.groupBy("entry").agg(lone.alias("lone"), F.min("c").alias("low"), F.max("c").alias("high")).where("lone or low < high").select("entry")
    open_rows = passing_table(open_rows.join(open_, "entry").join(heads.select("id", "bits"), "id").select("entry", "id", "component", "c", F.struct("n", "bits").alias("s")))
    x, y = open_rows.alias("x"), open_rows.alias("y")
    by_entry = cross(x, y, (F.col("x.entry") == F.col("y.entry")) & F.coalesce(F.col("x.c") != F.col("y.c"), F.lit(True)))
    rest = by_entry.unionByName(by_center).distinct().join(done, ["a", "b"], "left_anti")
    rest = storage.written(rest)
    passed()
    if not rest.isEmpty():
        labels = components(links.unionByName(links_of(rest)))
        passed()
    placed = heads.select("id", "key").join(labels.withColumnRenamed("node", "id"), "id", "left").select("id", "key", F.coalesce("component", "id").alias("component"))
    ids = placed.groupBy("component").agg(F.min("key").alias("component_id"))
    of_set = placed.join(ids, "component").select("id", "component_id")
    full = own.join(of_set, "id", "left")
    # a row without elements is alone
    lone = F.when(F.col("n") == 0, F.col("key")).otherwise(F.coalesce("component_id", "key"))
    return full.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), lone.alias("component_id"))
