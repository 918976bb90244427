"""Operators on texts against brute force and the public libraries."""

import base64
import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from bureauflow.llm import bpe_fold, decontaminate, jaccard_join, language_id, queries, ragged, storage, suffix_dedup, token_counts, token_files, toxicity, url_filter, winnowing

SMALL = "/root/testdata/sf0.001"
JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = ["a", "b", "s", "t", "'", "'re", "'ll", " ", " ", "\n", "\t", "\u3000", "é", "1", "²", "!", "—", "漢", "😀", "\r\n", "the", "ing", "aaaa", "<|endoftext|>", "-----"]
SCHEMA = "doc_id bigint, text string, path string"


def random_texts(n, size, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(size))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, a column with a clashing name."""
    queries.table(spark, SMALL, "documents")
    texts = [None, "", " \n\t ", "x" * 1000, "ab" * 2500 + " end", "z" * 700, *random_texts(40, 60, 3)]
    rows = [(k, t, "p") for k, t in enumerate(texts)] + [(7, texts[7], "p"), (7, texts[7], "q"), (None, "It's here", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_pretokens_are_the_pattern_s_matches():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for seed in range(300):
        texts = random_texts(6, 25, seed)
        buf, bounds = ragged.text_bytes(pa.array(texts))
        starts = ragged.pretoken_starts(buf, bounds)
        raw = buf.tobytes()
        assert [raw[a:b].decode() for a, b in zip(starts, np.append(starts[1:], len(raw)), strict=True)] == [w for t in texts for w in pattern.findall(t)]


def test_bpe_fold_against_tiktoken(spark, odd):
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in odd.collect():
        ids = own.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert Counter(tuple(r) for r in bpe_fold.digests(odd, RANKS).collect()) == Counter(want)
    assert all(r.decoded.decode() == r.text for r in bpe_fold.encode(odd.where("doc_id > 20"), RANKS).join(odd.select("doc_id", "text"), "doc_id").collect())
    assert bpe_fold.digests(empty(spark), RANKS).count() == 0


def test_token_counts_against_the_library(spark, odd):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(JSON)
    rows = odd.collect()
    want = Counter()
    for r in rows:
        n = len(own.encode(r.text or "", add_special_tokens=False).ids)
        want[(r.doc_id, len((r.text or "").encode()), n, n > 512)] += 1
    assert Counter(tuple(r) for r in token_counts.count_tokens(odd, JSON).collect()) == want
    assert token_counts.count_tokens(empty(spark), JSON).count() == 0
    buf, bounds = ragged.text_bytes(pa.array(["a" * 30_000, "ab" * 9_000]))
    assert token_counts.count_slice(buf, bounds, JSON).tolist() == [len(e.ids) for e in own.encode_batch(["a" * 30_000, "ab" * 9_000])]


def test_token_files_are_in_order(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(JSON)
    folder = str(tmp_path / "ids")
    token_files.write_token_files(odd, JSON, folder)
    back = token_files.read_token_files(spark, folder)
    sums = token_files.checksums(back, ["doc_id", "n_tokens", "file", "place"])
    got = sorted(token_files.with_starts(sums, token_files.read_token_files(spark, folder, ["n_tokens"])).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    at, texts = 0, {(r.doc_id, r.text) for r in odd.collect()}
    of = {i: own.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts}
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(of[r.doc_id]), zlib.crc32(np.array(of[r.doc_id], "<u4").tobytes()))
        at += r.n_tokens
    token_files.write_token_files(empty(spark), JSON, str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def tiled_by_hand(a, b, least):
    """Greedy string tiling without hashes."""
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return covered
        free_a[i : i + n], free_b[j : j + n], covered = [False] * n, [False] * n, covered + n


def test_tiles_against_plain_search():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        got = decontaminate.tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert sum(x[2] for x in got) == tiled_by_hand(a, b, 3)


def test_tiles_of_long_repetitive_texts():
    """Places are walked once each, so equal words cost time and memory in proportion to their number."""
    same = np.full(16_000, 7, np.uint64)
    began = time.perf_counter()
    assert decontaminate.tiles(same[:1000], same) == [(0, 0, 1000)]
    mixed = same.copy()
    mixed[::50] = 9
    got = decontaminate.tiles(same[:1000], mixed)
    assert time.perf_counter() - began < 5
    assert {x[2] for x in got[:-1]} == {49} and sum(x[2] for x in got) == 49 * 20 + 20


def test_overlaps_against_plain_tiling(spark):
    """All pairs of small texts, with repeated rows, ids of two texts, and items too short to be found."""
    rng = random.Random(12)
    base = [" ".join(rng.choices("abcd", k=rng.randrange(3, 14))) for _ in range(12)]
    items = [(k % 10, t) for k, t in enumerate(base)]
    docs = [(k % 25, " ".join(rng.choice([*base, "x y z"]) for _ in range(3)).upper()) for k in range(30)] + [(3, None), (None, base[0]), (None, base[0])]
    found = {}
    for key, text in docs:
        for item, asked in items:
            a, b = (regex.findall(r"\w+", (t or "").lower()) for t in (asked, text))
            covered = tiled_by_hand(a, b, 5) / len(a)
            if covered >= 0.5:
                found[key, item] = max(found.get((key, item), 0), covered)
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id): r.coverage for r in got} == found and len(found) > 20


def test_decontamination_finds_reordered_passages(spark, odd):
    bench = queries.table(spark, SMALL, "benchmark")
    item = max(bench.collect(), key=lambda r: len(r.text))
    words = regex.findall(r"\w+", item.text)
    half = len(words) // 2
    docs = spark.createDataFrame(
        [(1, "before it " + item.text.upper() + " after", None), (2, " ".join(words[half:] + ["and"] + words[:half]), None), (3, " ".join(words[: half // 2]), None), (4, None, None), (2, "", None)], SCHEMA
    )
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, bench).collect()} >= {(1, item.item_id), (2, item.item_id)}
    assert {r.doc_id for r in decontaminate.overlaps(docs, bench).collect()} == {1, 2}
    assert decontaminate.overlaps(odd, bench).count() == 0
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0
    assert decontaminate.overlaps(empty(spark), bench).count() == 0


def judged_by_hand(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = regex.match(r"(?s)([^/?#]*)(/[^?#]*)?", rest).groups(default="")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_url_cascade_against_plain_rules(spark):
    rng = random.Random(2)
    hosts = ["com", "a.com", "www.a.com", "b.net", "net", "x.b.net", "acom", "A.Com", ""]
    paths = ["", "/", "/en/", "/en/x", "/en", "/fr/1?q=/en/", "/é/", "?a=/en/"]
    rules = [("com", "/", "allow"), ("a.com", "/en/", "block"), ("www.a.com", "/en/x", "allow"), ("net", "/é/", "block"), ("b.net", "", "block")]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(150)] + [None, "", "no scheme/en/", "x://", "http://a.com/en/\n#z", "http://a.com/en/"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id bigint, url string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, table).collect()}
    assert got == {k: judged_by_hand(u, rules) for k, u in enumerate(urls)}
    assert {r.verdict for r in url_filter.judge(pages, table.limit(0)).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), table).count() == 0


def test_url_of_very_many_labels(spark):
    """Only suffixes that a rule's host could be become keys; a very long path and a repeated row are judged like others."""
    urls = ["http://" + "a." * 50_000 + "b.net/x", "http://b.net/" + "x" * 100_000, "http://b.net/x", "http://b.net/x", "http://" + "." * 1000, "http://c.b.net/x"]
    rules = [("b.net", "/x", "block"), ("net", "", "allow"), ("c.b.net", "/", "allow")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {k: judged_by_hand(u, rules) for k, u in enumerate(urls)}


def test_cascade_is_exact_with_few_bits(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS", 7)
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    levels = url_filter.cascade(keys)
    assert len(levels) > 2
    assert keys.where(url_filter.listed(F.col("key"), levels) != F.col("listed")).count() == 0


def test_fold_undoes_disguises():
    assert toxicity.fold("1D10t, fооl 5cum! 4 dogs") == "idiot, fool scum! 4 dogs"
    assert toxicity.fold("tel 555-2186") == "tel 555-2186"


def test_toxicity_on_held_out_rows(spark, odd):
    """Trained on every other row of a small corpus, the rest is told apart; an exception phrase cancels its hit."""
    rng = random.Random(6)
    bad, plain = ["villain", "rotten"], [f"word{k}" for k in "abcdefghijklmnopqrstuvwxyz"]
    rows, labels = [], []
    for k in range(240):
        words = rng.choices(plain, k=30)
        if k % 3 == 0:
            words[5] = rng.choice(bad)
        elif k % 12 == 1:
            words[5:7] = ["rotten", "apple"]
        rows.append((k, " ".join(words), None))
        labels.append((k, int(k % 3 == 0)))
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, known.where("doc_id < 160"))
    got = toxicity.score(docs, model, ["doc_id"]).join(known, "doc_id").where("doc_id >= 160")
    assert got.where("predicted <> toxic").count() <= 1
    assert "rotten apple" in model.exceptions
    assert {r.predicted for r in toxicity.score(odd, model).collect()} == {0}
    assert toxicity.score(odd, toxicity.Model()).where("score = 0.5").count() == odd.count()
    assert toxicity.fit(docs, known.limit(0)).weights == {} and toxicity.score(empty(spark), model).count() == 0


def test_toxic_hits_against_plain_search():
    """The automaton finds what a search at every word's beginning finds: of patterns that fit, the longest."""
    rng = random.Random(4)
    for _ in range(200):
        patterns = tuple(sorted({"".join(rng.choices("abc", k=rng.randrange(1, 5))) + rng.choice(["", "$"]) for _ in range(6)}))
        text = "".join(rng.choices("abc .", k=rng.randrange(40)))
        expected = {}
        for at in range(len(text)):
            if text[at].isalpha() and (at == 0 or not text[at - 1].isalpha()):
                word = regex.match(r"\p{L}+", text[at:])[0]
                fits = [p for p in patterns if (word == p[:-1] if p.endswith("$") else word.startswith(p))]
                if fits:
                    expected[at] = max(len(p.rstrip("$")) for p in fits)
        assert {start: end - start for _, start, end in toxicity.hits(text, patterns)} == expected


def test_toxicity_learns_once_from_a_repeated_key(spark):
    rows = [(k, "rotten one" if k % 2 else "plain word", None) for k in range(40)]
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, toxic int")
    copies = docs.unionByName(docs.where("doc_id = 1").crossJoin(spark.range(300)).drop("id")).unionByName(docs.where("doc_id = 2").withColumn("text", F.lit("zzz rotten")))
    one, many = toxicity.fit(docs, known), toxicity.fit(copies, known)
    assert one.weights == many.weights and one.weights and one.logistic == many.logistic


def repeated_by_hand(docs, length):
    raws = [(k, (t or "").encode()) for k, t in docs]
    seen = Counter(r[i : i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = Counter()
    for k, r in raws:
        gone = np.zeros(len(r) + 2, int)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i + 1 : i + length + 1] = 1
        out[(k, len(r), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(bytes(b for b, g in zip(r, gone[1:], strict=False) if not g)).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot_rows", [suffix_dedup.HOT_ROWS, 3])
def test_suffix_dedup_against_all_strings(spark, odd, hot_rows):
    rng = random.Random(4)
    passages = ["".join(rng.choices("abcdeé ", k=rng.randrange(150, 600))) for _ in range(5)]
    rows = [(k, "".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("abcdeé ", k=rng.randrange(1, 300))) for _ in range(rng.randrange(6))), "p") for k in range(60)]
    docs = odd.unionByName(spark.createDataFrame([*rows, rows[3], (5, rows[4][1], None)], SCHEMA))
    got = Counter(tuple(r) for r in suffix_dedup.digests(docs, hot_rows=hot_rows).collect())
    assert got == repeated_by_hand([(r.doc_id, r.text) for r in docs.collect()], suffix_dedup.LENGTH)
    assert suffix_dedup.digests(empty(spark)).count() == 0


def test_long_documents_are_cut_with_overlap(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 500)
    buf = np.frombuffer("".join(random.Random(8).choices("abc", k=4000)).encode(), np.uint8)
    places = [f + k for doc, first, number, *_ in suffix_dedup.doc_runs(buf, np.array([0, len(buf)]), 200) for f, n in zip(first, number, strict=True) for k in range(n)]
    assert sorted(places) == list(range(len(buf) - 199))


def winnowed_by_hand(hashes):
    kept = []
    for i in range(max(1, len(hashes) - winnowing.WINDOW + 1) if hashes else 0):
        window = [(h % 2**64 >> 31, -j) for j, h in enumerate(hashes[i : i + winnowing.WINDOW], i)]
        place = -min(window)[1]
        if not kept or kept[-1] != place:
            kept.append(place)
    return kept


def test_winnowing_against_plain_windows(spark, odd):
    rows = odd.select("text", winnowing.grams(F.col("text")).alias("g"), winnowing.fingerprint(F.col("text")).alias("f")).collect()
    for r in rows:
        assert [x.place for x in r.f] == winnowed_by_hand(r.g)
        assert [x.hash for x in r.f] == [r.g[x.place] for x in r.f]
        words = (r.text or "").translate(dict.fromkeys(map(ord, winnowing.BLANKS), " ")).split(" ")
        n = len([w for w in words if w])
        assert len(r.g) == (max(1, n - winnowing.GRAM + 1) if n else 0)


def test_edited_texts_and_next_documents(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "RANGE_ROWS", 7)
    docs = queries.table(spark, SMALL, "documents").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in winnowing.compare_edited(docs).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        following, tail = rows[(k + 1) % len(rows)], len(t) // 4
        edited = t[: len(t) - tail] + following[1][:tail]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
    assert sum(r.near_edited > 0.5 for r in got.values()) > 0.9 * len(got)
    one = spark.createDataFrame([(4, "only one here", None)], SCHEMA)
    assert winnowing.compare_edited(one).first().near_next == 1.0
    assert winnowing.compare_edited(empty(spark)).count() == 0


def sets_of(docs):
    out = []
    for k, t in docs:
        words = regex.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append((k, {tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} - {()}))
    return out


def components_by_hand(docs):
    sets = sets_of(docs)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for k in range(len(sets)):
        least[find(k)] = min(least.get(find(k), sets[k][0]), sets[k][0])
    return Counter((k, len(s), least[find(n)]) for n, (k, s) in enumerate(sets))


def test_jaccard_components_against_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(2000)]
    rows = [(900, None, None), (901, "", None), (902, " \n ", None)]
    for _ in range(40):
        base = rng.choices(vocabulary, k=rng.choice([1, 3, 4, 6, 8, 10, 12, 15, 20, 30, 60, 120, 400]))
        for c in range(rng.choice([1, 2, 3, 7])):
            words = list(base)
            for _ in range(int(len(words) * rng.choice([0, 0.01, 0.02, 0.03, 0.04])) + rng.choice([0, 0, 1])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words).replace("w1", "W1") if c == 1 else " ".join(words), "p"))
    rows += [rows[10], (rows[11][0], rows[11][1], "q")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter(tuple(r) for r in jaccard_join.similar_components(docs).collect())
    assert got == components_by_hand([(r[0], r[1]) for r in rows])
    assert jaccard_join.similar_components(empty(spark)).count() == 0


def test_jaccard_pairs_of_near_copies_below_the_threshold(spark, monkeypatch):
    """Copies that each differ from all others in one place, a little too much to link, are not compared in pairs: they share nothing but their center's elements."""
    rng, asked = random.Random(6), []
    base = [f"w{k}" for k in range(150)]
    texts = [" ".join([*base[:60], *(f"v{c}x{k}" for k in range(9 * (c > 0))), *base[60 + 9 * (c > 0) :]]) for c in range(101)]
    rng.shuffle(texts)
    found = jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *rest: asked.append(pairs.count()) or found(pairs, *rest))
    docs = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], SCHEMA)
    got = {tuple(r) for r in jaccard_join.similar_components(docs).collect()}
    assert got == {(k, 147, k) for k in range(101)} and sum(asked) <= 4 * len(texts)


@pytest.mark.parametrize("band", range(5, 30))
def test_schemes_bring_similar_sets_together(band):
    """Sets that differ as much as the band allows share an entry."""
    rng = np.random.default_rng(band)
    edges = jaccard_join.band_edges(jaccard_join.SHARE)
    n = int(edges[band + 1]) - 1
    differ = n * 15 // 85
    assert differ
    for _ in range(20):
        x = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        gone = differ // 2
        y = np.concatenate([x[gone:], rng.integers(1, 1 << 63, differ - gone, dtype=np.uint64)])
        if 100 * (n - gone) < 85 * (n + differ - gone):
            continue
        row, entry = jaccard_join.entries(np.concatenate([x, y]), np.array([0, n, n + len(y)]), jaccard_join.SHARE)
        assert set(entry[row == 0].tolist()) & set(entry[row == 1].tolist())


def test_language_on_held_out_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(language_id, "STEPS", 150)
    docs = queries.table(spark, SMALL, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    got = language_id.predict(docs.where(language_id.held_out()), model).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert got > 0.95
    answers = {(r.doc_id, r.text): r for r in language_id.predict(odd, model).collect()}
    for (_, text), r in answers.items():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= r.score <= 1
    assert {r.lang_pred for r in language_id.predict(odd, language_id.fit(docs.limit(0))).collect()} == {"und"}
    assert language_id.predict(empty(spark), model).count() == 0


def test_language_windows_against_a_plain_pass(monkeypatch):
    """Every position's label by one byte after another, of short texts and of texts over several windows."""
    monkeypatch.setattr(language_id, "WINDOW", 40)
    monkeypatch.setattr(language_id, "CONTEXT", 16)
    rng = np.random.default_rng(8)
    h, langs = language_id.HIDDEN, ["a", "b", "c"]
    w = {"V": rng.normal(size=(2 * h, 3)).astype(np.float32), "c": rng.normal(size=3).astype(np.float32)}
    for side in "fb":
        w |= {f"W{side}": rng.normal(size=(256, 3 * h)).astype(np.float32), f"U{side}": rng.normal(size=(h, 2 * h)).astype(np.float32), f"C{side}": rng.normal(size=(h, h)).astype(np.float32)}
    texts = [None, "", "a", "zwei wörter", "x" * 40, "y z " * 10 + "!", "no blank" * 60, *random_texts(30, 40, 9)]
    buf, bounds = ragged.text_bytes(pa.array(texts, pa.string()))

    def passed(side, data):
        out, state = [], np.zeros(h)
        for byte in data:
            given = w[f"W{side}"][byte]
            gate = 1 / (1 + np.exp(-(given[: 2 * h] + state @ w[f"U{side}"])))
            fresh = np.tanh(given[2 * h :] + (gate[:h] * state) @ w[f"C{side}"])
            state = gate[h:] * state + (1 - gate[h:]) * fresh
            out.append(state)
        return out

    def plain(data):
        total, pieces = np.zeros(3), -(-len(data) // 40)
        for k in range(pieces):
            start, end = k * len(data) // pieces, (k + 1) * len(data) // pieces
            low, high = max(0, start - 16), min(len(data), end + 16)
            ahead, behind = passed("f", data[low:end])[start - low :], passed("b", data[start:high][::-1])[::-1]
            for a, b in zip(ahead, behind[: end - start], strict=True):
                p = np.exp(np.concatenate([a, b]) @ w["V"] + w["c"])
                total += p / p.sum()
        return total

    expected = np.array([plain((t or "").encode()) for t in texts])
    for lanes in (1024, 7):
        monkeypatch.setattr(language_id, "LANES", lanes)
        assert np.allclose(language_id.label_sums(language_id.Model(langs, w), buf, bounds), expected, atol=1e-3)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    h, langs = 3, 2
    w = {"V": rng.normal(size=(2 * h, langs)), "c": np.zeros(langs)}
    for side in "fb":
        w |= {f"W{side}": rng.normal(size=(256, 3 * h)), f"U{side}": rng.normal(size=(h, 2 * h)), f"C{side}": rng.normal(size=(h, h))}
    x, size, label = np.array([[1, 2], [3, 4], [5, 0]]), np.array([3, 2]), np.array([0, 1])

    def loss():
        p, _, mask = language_id.positions(w, x, size)
        return -(np.log(p[:, np.arange(2), label]) * mask).sum()

    kept = ([], [])
    p, both, mask = language_id.positions(w, x, size, kept)
    d = p.copy()
    d[:, np.arange(2), label] -= 1
    d *= mask[:, :, None]
    grad = {k: np.zeros_like(a) for k, a in w.items()}
    up, t = d @ w["V"].T, np.arange(3)[:, None]
    language_id.back(w, "f", x, mask, kept[0], up[:, :, :h], grad)
    language_id.back(w, "b", language_id.turned(x, size), mask, kept[1], np.take_along_axis(up[:, :, h:], np.where(mask, size - 1 - t, t)[:, :, None], 0), grad)
    for k in ("Wf", "Uf", "Cf", "Wb", "Ub", "Cb"):
        for at in [(1, 0), (2, 1)] if k[0] == "W" else [(0, 0), (2, 1)]:
            w[k][at] += 1e-6
            up_loss = loss()
            w[k][at] -= 2e-6
            down_loss = loss()
            w[k][at] += 1e-6
            assert abs((up_loss - down_loss) / 2e-6 - grad[k][at]) < 1e-5


def test_shared_folder_is_the_session_s(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_folder(spark).startswith(root)
    folder = storage.shared_folder(spark)
    assert storage.written(spark.range(3), folder).count() == 3
    storage.remove(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


def test_registered_queries_run(spark):
    """Each query over the smallest tables: a row a document, or a page."""
    docs, pages = queries.table(spark, SMALL, "documents").count(), queries.table(spark, SMALL, "pages").count()
    size = defaultdict(lambda: docs, op3_url_filter=pages)
    for name, query in queries.QUERIES.items():
        found = query(spark, SMALL).count()
        assert found == size[name] or name == "op2_decontamination" and found > 0, name
