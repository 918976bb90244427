"""URL filter by a cascade of Bloom filters (operator 3), in DataFrame functions only.

A rule is a host and a path; it fits the host and its subdomains where the path starts with the rule's. The keys of a URL are the pairs of
a suffix of its host and a beginning of its path as long as some rule's path. The corpus's distinct keys are the universe. Level 1 holds
the listed keys of the universe, level 2 the keys not listed that pass level 1, level 3 the listed ones that pass level 2, and so on until
nothing passes wrongly. A key of the universe is listed if and only if the first level that it fails is an even one (or, if it fails none,
their number is odd). The levels are literal bit sets, so URLs are judged in one scan without a join.

Sizes: a level has BITS bits per key it holds. Level 1 grows with the list, level 2 with the list's false positives, about 0.04 % of the
universe at BITS = 16. Bit sets over MAX_BITS in all are refused; a larger universe needs more bits per listed key.

Defined results: host and path of a null URL or one without `://` are empty and no rule fits; then the verdict is `allow`. Of rules that
fit, the longest wins (host and path together, then the host). A rule listed as both is `block`. Empty rules or pages are fine, repeated rows
are judged each, other columns pass through (host, path, rule and verdict give way). A URL gives no more keys than the rules' longest host
has labels times their path lengths, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauflow.llm import storage

BITS = 16
HASHES = 8
MAX_BITS = 1 << 28
MAX_LEVELS = 24


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), r"(?s)^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(after, r"(?s)^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, lengths: list[int], depth: int) -> Column:
    """All pairs of a host suffix and a path beginning that a rule could be, as `host/...path` strings; depth: labels of the longest rule's
    host, as suffixes of more labels are nobody's."""
    labels = F.split(F.substring_index(host, ".", depth * -1), r"\.", -1)
    count = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(labels, k, count), "."))
    heads = F.transform(F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(heads, lambda p: key_of(h, p))))
    return F.when(host != "", pairs).otherwise(F.array().cast("array<string>"))


def key_of(host: Column, path: Column) -> Column:
    """A host has no slash, so the first one ends it; a rule without a path, or with one that doesn't start with a slash, has a mark."""
    return F.concat(host, F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/\u0000"), path)))


def bits_of(key: Column, level: int, size: int) -> Column:
    """Places of a key's bits at a level, by double hashing."""
    one, two = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))
    low = F.lit((1 << 40) - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda k: F.pmod(one.bitwiseAND(low) + k * two.bitwiseAND(low), F.lit(size)))


def passes(key: Column, level: int, words: list[int]) -> Column:
    """Whether all bits of a key are set."""
    held, size = F.lit(words), 64 * len(words)
    return F.forall(bits_of(key, level, size), lambda b: F.getbit(F.get(held, F.shiftright(b, 6).cast("int")), F.pmod(b, F.lit(64)).cast("int")) == 1)


def bit_set(keys: DataFrame, level: int) -> list[int]:
    """The bit set of a column `key`, in words of 64; its size follows the number of keys."""
    count = keys.count()
    words = max(1, -(-count * BITS // 64))
    if words * 64 > MAX_BITS:
        raise ValueError(f"level {level} needs {words * 64} bits, over {MAX_BITS}: raise BITS for fewer false positives, or the limit")
    rows = (
        keys.select(F.explode(bits_of(F.col("key"), level, 64 * words)).alias("b"))
        .groupBy(F.shiftright("b", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(b, 64) as int))")).alias("bits"))
        .collect()
    )
    out = [0] * words
    for r in rows:
        out[r["word"]] = r["bits"]
    return out


def cascade(universe: DataFrame) -> list[list[int]]:
    """Levels for distinct keys with a boolean `listed`."""
    inside, outside = universe.where("listed").select("key"), universe.where("not listed").select("key")
    levels: list[list[int]] = []
    held, others = inside, outside
    while not held.isEmpty():
        if len(levels) == MAX_LEVELS:
            raise ValueError("the cascade doesn't end")
        levels.append(bit_set(held, len(levels) + 1))
        wrong = others.where(passes(F.col("key"), len(levels), levels[-1]))
        held, others = storage.written(wrong), held
    return levels


def listed(key: Column, levels: list[list[int]]) -> Column:
    """Membership of a key of the universe."""
    out = F.lit(len(levels) % 2 == 1)
    for level in range(len(levels), 0, -1):
        out = F.when(~passes(key, level, levels[level - 1]), F.lit(level % 2 == 0)).otherwise(out)
    return out


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """pages with host, path, rule and verdict in place of any columns of these names. rules: host, path, verdict (allow or block)."""
    rules = rules.select(key_of(F.lower("host"), F.coalesce("path", F.lit(""))).alias("key"), F.length(F.coalesce("path", F.lit(""))).alias("n"), (F.col("verdict") == "block").alias("block"))
    rules = rules.where("key is not null").groupBy("key", "n").agg(F.max("block").alias("block"))
    # numbers up to the longest path
    lengths = sorted(r[0] for r in rules.select("n").distinct().collect())
    depth = rules.select(F.max(F.size(F.split(F.substring_index("key", "/", 1), r"\.", -1)))).first()[0] or 1
    urls = pages.select(F.col(url).alias("url")).distinct()
    keys = urls.select(F.explode(keys_of(host_of(F.col("url")), path_of(F.col("url")), lengths, depth)).alias("key")).distinct()
    universe = storage.written(keys.join(rules.select("key", "block"), "key", "left"))
    allow, block = (cascade(universe.select("key", F.coalesce(hit, F.lit(False)).alias("listed"))) for hit in (~F.col("block"), F.col("block")))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    def best(levels: list[list[int]]) -> Column:
        fits = F.filter(keys_of(F.col("host"), F.col("path"), lengths, depth), lambda k: listed(k, levels))
        return F.array_max(F.transform(fits, lambda k: F.struct(F.length(F.replace(k, F.lit("/\u0000"), F.lit(""))).alias("n"), F.length(F.substring_index(k, "/", 1)).alias("m"), k.alias("key"))))

    rows = rows.select("*", best(allow).alias("__allow"), best(block).alias("__block"))
    blocked = F.col("__block").isNotNull() & (F.col("__allow").isNull() | (F.col("__block") > F.col("__allow")))
    rule = F.replace(F.when(blocked, F.col("__block.key")).otherwise(F.col("__allow.key")), F.lit("/\u0000"), F.lit(""))
    return rows.select(*kept, "host", "path", rule.alias("rule"), F.when(blocked, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))
