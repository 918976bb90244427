"""Document fingerprints by winnowing (operator 6), in DataFrame functions only.

A text's words are hashed, and the hashes of GRAM words in a row are combined by rotation and exclusive or (a cyclic polynomial, the rolling
hash of word sequences; built by doubling, so that each step is one pass over an array). Of every WINDOW grams in a row the least hash is
kept, the rightmost of equal ones, with its position: two texts that share GRAM + WINDOW - 1 words in a row share a fingerprint, and matches
of under GRAM words are never seen.

The next document is found without a global order: ids are cut into ranges, a range's first document also visits the range before (that of
the first range: the last), and a window inside each range looks one row ahead.

Defined results: null text counts as empty; a text without words has an empty fingerprint, one of fewer than GRAM words a single gram of all
its words; two empty fingerprints are alike (1), an empty and another one not (0). Rows with one id follow each other by their text's hash;
rows without an id come first; a single row is its own next. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureauflow.llm.hof import let
from bureauflow.llm.ranges import shard_bounds, shard_of

GRAM = 4
WINDOW = 8
#: Documents of a range, about, and ranges at most (more documents: larger ranges).
RANGE_ROWS = 1_500
MAX_RANGES = 20_000
_BITS, _PLACES = 33, 30
#: The white space that separates words.
BLANKS = " \t\n\x0b\x0c\r"


def _rotated(x: Column, n: int) -> Column:
    return F.shiftleft(x, n).bitwiseOR(F.shiftrightunsigned(x, 64 - n))


def _shifted(a: Column, n: int) -> Column:
    return F.slice(a, F.lit(n + 1), F.size(a))


def _pairwise(a: Column, n: int, f) -> Column:
    """f of each element and the one n places later; null where there is none."""
    return let(a, lambda x: F.zip_with(x, _shifted(x, n), f))


def _rolled(a: Column, n: int) -> Column:
    """Hashes of sequences twice as long."""
    return _pairwise(a, n, lambda x, y: _rotated(x, n).bitwiseXOR(y))


def grams(text: Column) -> Column:
    """Hashes of all sequences of GRAM words."""

    def combined(words: Column) -> Column:
        out = F.transform(words, lambda w: F.xxhash64(w))
        n = 1
        while n < GRAM:
            out = _rolled(out, n)
            n *= 2
        whole = F.array(F.xxhash64(F.array_join(words, " ")))
        return F.when(F.size(words) >= GRAM, F.slice(out, F.lit(1), F.size(words) - (GRAM - 1))).otherwise(whole)

    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed != "", let(F.split(trimmed, f"[{BLANKS}]+"), combined)).otherwise(F.array().cast("array<bigint>"))


def fingerprint(text: Column) -> Column:
    """array<struct<hash, place>>: the grams kept, in order of their places."""

    def winnowed(g: Column) -> Column:
        # the hash's leading bits, then the place from the end: the least is the rightmost of equal ones
        last = F.lit((1 << _PLACES) - 1)
        out = F.transform(g, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 64 - _BITS), _PLACES).bitwiseOR(last - i))
        n = 1
        while n < WINDOW:
            out = _pairwise(out, n, lambda a, b: F.least(a, b))
            n *= 2
        windows = F.slice(out, F.lit(1), F.greatest(F.size(g) - (WINDOW - 1), F.least(F.size(g), F.lit(1))))
        places = F.transform(F.array_distinct(windows), lambda p: (last - p.bitwiseAND(last)).cast("int"))
        return F.transform(places, lambda i: F.struct(F.get(g, i).alias("hash"), i.alias("place")))

    return let(grams(text), winnowed)


def digest(prints: Column) -> Column:
    """The fingerprint's hashes and places as one sha256, lowercase hex."""
    return F.sha2(F.array_join(F.transform(prints, lambda p: F.concat_ws(":", p["hash"].cast("string"), p["place"].cast("string"))), " ").cast("binary"), 256)


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared hashes by all hashes (Dice), of arrays of distinct hashes."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def hashes(prints: Column) -> Column:
    return F.array_distinct(F.transform(prints, lambda p: p["hash"]))


def with_next(docs: DataFrame, key: str, order: Column, carried: dict[str, Column]) -> DataFrame:
    """docs with next_<name> for each carried column: its value in the next row by key and order, after the last the first row's."""
    docs = docs.withColumn("__at", F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63))))
    bounds = shard_bounds(docs.select("__at"), "__at", RANGE_ROWS, MAX_RANGES)
    docs = docs.withColumn("__range", shard_of("__at", bounds))
    # MAX_RANGES rows at most
    firsts = sorted((r[0], r[1]) for r in docs.groupBy("__range").agg(F.min("__at")).collect())
    if not firsts:
        return docs.select("*", *(c.alias(f"next_{n}") for n, c in carried.items())).drop("__at", "__range")
    # ranges without rows are never asked for
    first, before = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for k, (number, at) in enumerate(firsts):
        first[number], before[number] = at, firsts[k - 1][0]
    seat = lambda number, guest: F.struct(number.cast("int").alias("number"), F.lit(guest).alias("guest"))
    own = F.col("__range")
    visits = F.when(
        F.col("__at") == F.get(F.lit(first), own),
        F.array(seat(own, False), seat(F.get(F.lit(before), own), True)),
    ).otherwise(F.array(seat(own, False)))
    columns = [c for c in docs.columns if not c.startswith("__")]
    rows = docs.select(*columns, "__at", order.alias("__order"), *(c.alias(f"__{n}") for n, c in carried.items()), F.explode(visits).alias("__seat"))
    w = Window.partitionBy(F.col("__seat.number")).orderBy(F.col("__seat.guest"), "__at", "__order")
    return rows.select(*columns, "__seat", *(F.lead(f"__{n}").over(w).alias(f"next_{n}") for n in carried)).where("not __seat.guest").drop("__seat")


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    own = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    prints = fingerprint(F.col("text"))
    own = own.select(key, "text", let(prints, lambda p: F.struct(digest(p).alias("digest"), hashes(p).alias("hashes"))).alias("own"))
    rows = with_next(own, key, F.xxhash64("text"), {"text": F.col("text"), "hashes": F.col("own.hashes")})
    n = F.char_length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - tail), F.substring("next_text", F.lit(1), tail))
    rows = rows.select(key, n.cast("bigint").alias("n_chars"), "own", "next_hashes", edited.alias("edited"))
    rows = rows.select("*", let(fingerprint(F.col("edited")), lambda p: F.struct(digest(p).alias("digest"), hashes(p).alias("hashes"))).alias("other"))
    return rows.select(
        key, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.col("own.digest").alias("fingerprint"),
        F.col("other.digest").alias("edited_fingerprint"), likeness(F.col("own.hashes"), F.col("other.hashes")).alias("near_edited"),
        likeness(F.col("own.hashes"), F.col("next_hashes")).alias("near_next"),
    )
