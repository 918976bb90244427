"""Whitening, WARC archives and ranked search against plain versions of them."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bureauflow.llm import lexical_search, queries, storage, warc, whitening

SMALL = "/root/testdata/sf0.001"


# --- whitening


def whole(vectors):
    return np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000


def plain_whitening(rows):
    """{id: ([whitened], deviation)}, eigenvalues' shares by numpy's own eigenvalues."""
    x = whole([v for _, v in rows])
    n, s = len(x), x.sum(0)
    z = x - s / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1], u[:, ::-1]
    deviation = [sum(int(n * a - b) ** 2 for a, b in zip(r.tolist(), s.tolist(), strict=True)) for r in x]
    return {k: (z[i] @ u[:, :8] / np.sqrt(e[:8]), deviation[i]) for i, (k, _) in enumerate(rows)}, e / e.sum()


def test_whitening_against_numpy(spark):
    vectors = queries.table(spark, SMALL, "embeddings")
    kept = [(r.vec_id, r.embedding) for r in vectors.collect() if r.embedding is not None and all(e is not None and math.isfinite(e) for e in r.embedding)]
    odd = spark.createDataFrame([(-1, None), (-2, [None] * 64), (-3, [1.0] * 63 + [float("nan")]), (-4, [float("inf")] * 64), (-5, [1.0] * 3), (-6, [])], "vec_id bigint, embedding array<float>")
    got = defaultdict(dict)
    rows = whitening.whiten(vectors.select("vec_id", "embedding").unionByName(odd).withColumn("whitened", F.lit("x"))).collect()
    want, shares = plain_whitening(kept)
    for r in rows:
        got[r.vec_id][r.component] = r
    assert set(got) == set(want)
    signs = {k: np.sign(got[kept[0][0]][k].whitened * want[kept[0][0]][0][k - 1]) for k in range(1, 9)}
    for key, (values, deviation) in want.items():
        assert {r.deviation for r in got[key].values()} == {deviation}
        assert {r.n for r in got[key].values()} == {len(kept)}
        assert np.allclose([got[key][k].whitened * signs[k] for k in range(1, 9)], values, atol=1e-8)
        assert np.allclose([got[key][k].explained for k in range(1, 9)], shares[:8], rtol=1e-9)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_whitening_of_few_equal_or_no_vectors(spark):
    make = lambda rows: whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert make([]) == [] and make([(1, None)]) == [] and make([(1, [0.5, 1.5])] * 3) == []
    rows = make([(1, [0.0, 0.0, 7.0]), (2, [1.0, 2.0, 7.0]), (2, [1.0, 2.0, 7.0]), (None, [3.0, 6.0, 7.0])])
    assert sorted((r.vec_id or 0, r.component, r.n) for r in rows) == [(0, 1, 4), (1, 1, 4), (2, 1, 4), (2, 1, 4)]
    assert all(abs(r.explained - 1) < 1e-12 for r in rows) and rows[0].identity_error < 1e-9
    huge = make([(k, [3e30 * (-1) ** k, float(k)]) for k in range(4)])
    assert {r.deviation for r in huge} == {None} and len(huge) >= 4


def test_exact_gram_and_factor():
    rng = np.random.default_rng(1)
    for most in (1 << 10, 1 << 25, 1 << 52):
        z = rng.integers(-most, most, (300, 5))
        assert (whitening.exact_gram(z) == z.astype(object).T @ z.astype(object)).all()
    assert whitening.exact_sums(np.full((5, 1), (1 << 60) + 3)) == [5 * ((1 << 60) + 3)]
    a = rng.normal(size=(40, 9)) * 10.0 ** -(np.arange(9) / 3)
    v = a.T @ a
    factor, order = whitening.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v[np.ix_(order, order)]) and np.allclose(factor, np.tril(factor))
    values, vectors = whitening.components(v)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1], rtol=1e-8) and np.allclose(vectors.T @ vectors, np.eye(9), atol=1e-12)
    for n in (1, 2, 5, 8):
        pairs = [tuple(sorted(p)) for a, b in whitening.pairings(n) for p in zip(a.tolist(), b.tolist(), strict=True)]
        assert sorted(pairs) == [(i, j) for i in range(n) for j in range(i + 1, n)]


# --- WARC


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain_records(rows, least=0):
    largest = {}
    for k, _, html in rows:
        if len((html or "").encode()) >= least and k is not None:
            largest[html or ""] = max(largest.get(html or "", k), k)
    out = Counter()
    for k, _, html in rows:
        kept = largest.get(html or "")
        same = kept is None or k == kept
        out[(k, len((html or "").encode()), b32(html), "response" if same else "revisit", None if same else kept)] += 1
    return out


PAGES = [
    (1, "http://a/", "one"), (2, None, "one"), (3, "http://c/ d\r\n", "<p>\r\n\r\nWARC/1.1\r\n\r\n</p>"), (4, "", None), (5, "x", ""), (5, "x", ""), (None, "y", "one"), (None, "z", "alone"), (None, "z", "alone"),
    (6, "http://é/", "é" * 300_000), (7, "q", "\r\n\r\n"), (8, "q", "\r\n"), (9, "q", "two"), (9, "r", "three"), (10, "q", "two"),
]


@pytest.fixture(scope="module")
def pages(spark):
    queries.table(spark, SMALL, "pages")
    return spark.createDataFrame([(*p, "p") for p in PAGES], "page_id bigint, url string, html string, record_type string").repartition(3)


def test_warc_round_trip(spark, pages):
    assert Counter(tuple(r) for r in warc.archive_pages(pages).collect()) == plain_records(PAGES)
    assert Counter(tuple(r) for r in warc.archive_pages(pages, least=4).collect()) == plain_records(PAGES, 4)
    assert warc.archive_pages(pages.limit(0)).collect() == []


def test_members_stand_at_their_offsets(spark, pages, tmp_path):
    raw, folder = str(tmp_path / "raw"), str(tmp_path / "new")
    records = warc.write_archives(pages, raw)
    for file in (tmp_path / "raw").iterdir():
        data, stream = file.read_bytes(), zlib.decompressobj(31)
        stream.decompress(data)
        assert stream.eof and not stream.unused_data  # monolithic
    index = warc.normalise(records, raw, folder, warc.repeated(records))
    for name, rows in index.toPandas().groupby("archive"):
        data = (tmp_path / "new" / name).read_bytes()
        assert sum(rows["length"]) == len(data)
        for r in rows.itertuples():
            member = gzip.decompress(data[r.offset : r.offset + r.length])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n") and f"<{r.record_id}>".encode() in member
            assert f"WARC-Type: {r.record_type}\r\n".encode() in member
    # selective reads, with payloads
    some = warc.read_records(index.where("record_id = 'urn:page:3'"), folder, with_payload=True).collect()
    assert [(r.id, bytes(r.payload).decode()) for r in some] == [("3", PAGES[2][2])]
    # archives of one member for each record pass as well, unchanged
    again = warc.normalise(index, folder, str(tmp_path / "again"))
    read = lambda i, f: Counter(tuple(r) for r in warc.read_records(i, f).collect())
    assert read(again, str(tmp_path / "again")) == read(index, folder)


def test_records_from_pieces_of_any_size():
    bodies = [b"", b"x", b"\r\n\r\n", b"a" * 3000 + b"\r\n\r\nWARC/1.1\r\n", random.Random(3).randbytes(5000)]
    raw = b"".join(warc.head([("WARC-Type", "resource"), ("WARC-Record-ID", f"<{k}>"), ("Content-Length", str(len(b)))]) + b + warc.END for k, b in enumerate(bodies))
    for packed in (gzip.compress(raw), gzip.compress(raw[:100]) + gzip.compress(raw[100:]) + b"\0" * 9):
        for size in (1, 7, 1 << 20):
            file, out = io.BytesIO(packed), io.BytesIO()
            pieces = (p[k : k + size] for p in warc.inflated(file) for k in range(0, len(p), size))
            found = list(warc.rewritten(pieces, out, {}))
            members = [gzip.decompress(out.getvalue()[o : o + n]) for _, o, n, _, _ in found]
            assert [m.partition(b"\r\n\r\n")[2] for m in members] == [b + warc.END for b in bodies] and [f[3] for f in found] == list("01234")
    for cut in (gzip.compress(raw)[:-9], gzip.compress(raw[:-20])):
        with pytest.raises(ValueError):
            list(warc.rewritten(warc.inflated(io.BytesIO(cut)), io.BytesIO(), {}))


def test_pages_of_the_table(spark):
    rows = [(r.page_id, r.url, r.html) for r in queries.table(spark, SMALL, "pages").collect()]
    assert Counter(tuple(r) for r in queries.op12_warc(spark, SMALL).collect()) == plain_records(rows)


# --- ranked search


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOW))


def plain_search(docs, asked, k=20):
    """{query number: [(doc_id, score)]} by every document's own score."""
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    for number, (_, text) in enumerate(asked):
        scores = []
        for d, c in counts:
            m = 75 + (25 * c.total() * n) // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in Counter(terms_of(text)).items() if c[t])
            if score > 0:
                scores.append((d, score))
        out[number] = sorted(scores, key=lambda x: (-x[1], x[0] is None, x[0]))[:k]
    return out


def by_item(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.item_id, r.rank)):
        out[r.item_id].append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return dict(out)


def test_search_against_all_scores(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SMALL, "documents").collect()]
    asked = [(r.item_id, r.text) for r in queries.table(spark, SMALL, "benchmark").collect()]
    want = plain_search(docs, asked)
    assert by_item(queries.op13_lexical_search(spark, SMALL).collect()) == {asked[k][0]: v for k, v in want.items() if v}


def test_search_of_odd_rows_ties_and_blocks(spark, monkeypatch):
    rng = random.Random(5)
    words = ["a", "B", "b7", "é", "É", "c_d", "the", "the", "the", "漢字", "x" * 50]
    docs = [(k, " ".join(rng.choices(words, k=rng.randrange(40)))) for k in range(300)]
    docs += [(900 + k, "same words here the") for k in range(60)] + [(7, "same words here the"), (None, "same words here the"), (None, None), (950, ""), (951, "... !"), (952, "the " * 9000), (952, "the " * 9000)]
    asked = [(1, "the same same words"), (2, "A b7, É!"), (3, None), (4, "none such"), (5, "x" * 50 + " C the D 漢字"), (6, "é")]
    rows = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, score int").repartition(4)
    queries_of = spark.createDataFrame([(i, t, 0) for i, t in asked], "item_id bigint, text string, rank int")
    want = {asked[k][0]: v for k, v in plain_search(docs, asked).items() if v}
    assert by_item(lexical_search.rank_documents(rows, queries_of).collect()) == want
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 20)
    monkeypatch.setattr(lexical_search, "SPLITS", 2)
    assert by_item(lexical_search.rank_documents(rows, queries_of).collect()) == want
    assert lexical_search.rank_documents(rows.limit(0), queries_of).collect() == [] == lexical_search.rank_documents(rows, queries_of.limit(0)).collect()
    # an index of all terms serves any queries
    index = storage.written(lexical_search.build_index(rows))
    found = lexical_search.ranked(lexical_search.search(index, asked, "bigint")).withColumnRenamed("item", "item_id")
    assert by_item(found.collect()) == want
    assert index.agg(F.sum("n_docs")).first()[0] == sum(bool(terms_of(t)) for _, t in docs)


def test_terms_of_pieces(monkeypatch):
    rng = random.Random(2)
    texts = [None, "", *("".join(rng.choices(["ab", "Z", " ", ".", "é", "漢", "0"], k=rng.randrange(60))) for _ in range(80)), "y" * 200]
    buf, bounds = lexical_search.ragged.text_bytes(pa.array(texts))
    for size in (16, 37, 1 << 20):
        monkeypatch.setattr(lexical_search, "PIECE", size)
        found = [(int(r), int(h)) for rows, hashes in lexical_search.term_hashes(buf, bounds) for r, h in zip(rows, hashes, strict=True)]
        own = {t: lexical_search.query_terms([t])[0][0][0] for text in texts for t in terms_of(text)}
        assert found == [(k, own[t]) for k, text in enumerate(texts) for t in terms_of(text)]


def test_range_maxima():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 33):
        values = rng.integers(0, 5, n)
        table = lexical_search.range_maxima(values, n)
        for a in range(n):
            for b in range(a + 1, n + 1):
                level = (b - a).bit_length() - 1
                left, right = table[level, a], table[level, b - (1 << level)]
                assert (right if values[right] > values[left] else left) == a + values[a:b].argmax()
