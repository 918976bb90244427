"""The pipeline's decisions on a small fixture."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from bureauflow.llm import queries, storage

SMALL = "/root/testdata/sf0.001"


def test_stages_on_planted_documents(spark):
    import corpus_pipeline

    docs = queries.table(spark, SMALL, "documents")
    bench = [r.text for r in queries.table(spark, SMALL, "benchmark").collect()]
    words = [w for r in docs.orderBy("doc_id").limit(60).collect() for w in (r.text or "").split()]
    rng = random.Random(2)
    fresh = lambda n: " ".join(rng.choices(words, k=n))
    passage, base = fresh(80), fresh(200)
    rows = [
        (900001, "12 34 ... !!", "en", "s", 12),
        (900002, base, "en", "s", len(base)),
        (900003, base + " end", "en", "s", len(base) + 4),
        (900004, base, "en", "s", len(base)),
        (900005, fresh(100) + " " + passage + " " + fresh(90), "en", "s", 1),
        (900006, fresh(120) + " " + passage + " " + fresh(70), "en", "s", 1),
        (900007, fresh(100) + " " + bench[0] + " " + fresh(100), "en", "s", 1),
        (900008, fresh(150), None, None, None),
        (900009, None, "en", "s", 0),
    ]
    planted = spark.createDataFrame(rows, docs.schema)
    now = docs.where("doc_id < 900000").unionByName(planted)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        now = storage.written(stage(spark, now, SMALL))
        seen.append((name, {r.doc_id for r in now.where("doc_id >= 900000").collect()}))
        if name != "bpe_encoding":
            assert now.columns == docs.columns
        if name == "repeated_passages":
            texts = {r.doc_id: r.text for r in now.where("doc_id >= 900000").collect()}
            assert passage[40:-40] not in texts[900005] and passage[40:-40] not in texts[900006]
            assert texts[900008] == rows[7][1]
    stages = dict(seen)
    assert stages["language_id"] == {k for k, *_ in rows} - {900001, 900009}
    assert stages["near_duplicates"] == stages["language_id"] - {900003, 900004}
    assert stages["repeated_passages"] == stages["near_duplicates"]
    assert stages["decontamination"] == stages["repeated_passages"] - {900007}
    assert stages["bpe_encoding"] == stages["decontamination"]
    assert now.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_empty_tables_pass(spark):
    import corpus_pipeline

    now = queries.table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = storage.written(stage(spark, now, SMALL))
    assert now.count() == 0


def shingles(text, size=5):
    own = text.lower().split()
    return {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}


def likeness(a, b, size=5):
    a, b = shingles(a, size), shingles(b, size)
    return len(a & b) / len(a | b)


def test_near_duplicates_of_five_words_and_four_fifths(spark):
    import corpus_pipeline

    def pair(n, tag):
        base = [f"{tag}{k}" for k in range(n)]
        other = [f"new{w}" if k in (20, 60, 100, 140) else w for k, w in enumerate(base)]
        return " ".join(base), " ".join(other)

    (a, b), (c, d) = pair(194, "a"), pair(174, "c")
    assert 0.80 < likeness(a, b) < 0.82 and likeness(a, b, 4) < 0.85 and likeness(c, d) < 0.80
    docs = queries.table(spark, SMALL, "documents")
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate((a, b, c, d), 900001)]
    now = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, docs.schema), SMALL)
    assert {r.doc_id for r in now.collect()} == {900001, 900003, 900004}


def test_stages_decide_by_id_and_text(spark):
    import corpus_pipeline

    docs = queries.table(spark, SMALL, "documents")
    item = max((r.text for r in queries.table(spark, SMALL, "benchmark").collect()), key=lambda t: len(t.split()))
    rng = random.Random(5)
    fresh = lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(120))
    clean, shared, copied, far = fresh(), fresh(), fresh(), fresh()
    leak, other_leak = fresh() + " " + item, fresh() + " " + item
    rows = [
        # without an id: one clean, one contaminated, copies of one text, and a copy of a row with an id
        (None, clean), (None, leak), (None, copied), (None, copied), (None, far),
        # under one id: unlike texts, one of them contaminated, and a row alike in id and text
        (900001, shared), (900001, other_leak), (900001, shared),
        (900002, far), (900002, far + " end"),
        # the text that one row of a shared id has, under an id of its own
        (900003, shared),
    ]
    planted = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], docs.schema)
    one = lambda d: sorted((str(r.doc_id), r.text) for r in d.collect())
    after = lambda *own: sorted((str(k), t) for k, t in own)

    now = corpus_pipeline.near_duplicates(spark, planted, SMALL)
    found = one(now)
    ends = [t for k, t in found if k == "900002"]
    assert len(ends) == 1 and ends[0] in (far, far + " end")
    assert found == after((None, clean), (None, leak), (None, copied), (900001, shared), (900001, other_leak), (900002, ends[0]))
    now = corpus_pipeline.decontamination(spark, planted, SMALL)
    assert one(now) == after(*(r for r in rows if item not in r[1]))


def test_near_duplicates_send_a_row_once_and_leave_no_sets(spark):
    """Of rows alike in id and text the least stays; a row isn't sent beside itself; tables of whole sets go once they are used."""
    import corpus_pipeline

    rng = random.Random(6)
    fresh = lambda n: " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))
    base, other = fresh(150), fresh(150)
    rows = [(1, base, "en", "s", 2), (1, base, "de", "z", 9), (1, base, "de", "t", None), (2, base + " end", "aa", "a", 0), (3, other, None, "s", 1), (3, other, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    found = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    got = sorted((tuple(r) for r in found.collect()), key=lambda r: r[0])
    made = [p for p in set(shared.iterdir()) - before if any(x.suffix == ".parquet" for x in p.iterdir())]
    left = [spark.read.parquet(str(p)).columns for p in made]
    assert got == [rows[2], rows[4]]
    assert "min_by" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert left and not any("elements" in x for x in left)


def test_encoding_folds_no_words(spark, monkeypatch):
    """The last stage merges all words as arrays, with the ids that folding them gives."""
    import corpus_pipeline
    import public_tokenizers
    from bureauflow.llm import bpe_fold

    docs = queries.table(spark, SMALL, "documents").limit(40)
    odd = spark.createDataFrame([(1, "a" * 700 + " naïve été \n\n x", "en", "s", 1), (2, "", "en", "s", 0), (3, None, "en", "s", 0)], docs.schema)
    docs = docs.unionByName(odd).persist()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = lambda df: sorted((r.doc_id, tuple(r.ids)) for r in df.select("doc_id", "ids").collect())
    want = rows(bpe_fold.encode(texts, public_tokenizers.path("byte_bpe_50k.tiktoken")))
    monkeypatch.delattr(bpe_fold, "fold")
    found = corpus_pipeline.encoding(spark, docs, SMALL)
    assert rows(found) == want and found.where("not decodes").count() == 0
    docs.unpersist()
