"""The pipeline against brute force, stage by stage on the smallest tables."""

from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest_llm import sha
from modrisk.llm import mixing, quality
from test_exact_dedup import low
from test_simhash import groups, slow_print


def test_like_brute_force(spark, sf, documents):
    rules = quality.default_rules()
    good = {}
    for r in documents.collect():
        doc = quality.looked_at(r["text"])
        if not quality.base_failed(doc) and not any(rule.rejects(doc) for rule in rules):
            good[r["doc_id"]] = r
    equal = defaultdict(list)
    for i, r in good.items():
        equal[low(r["text"])].append(i)
    single = {max(ids): good[max(ids)] for ids in equal.values()}
    prints = {i: slow_print(r["text"]) for i, r in single.items()}
    near = [(a, b) for a, b in combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    first = groups(prints, near)
    left = {i: r for i, r in single.items() if first[i] == i}
    assert len(left) < len(single) < len(good) < documents.count()
    frame = spark.createDataFrame(list(left.values()), documents.schema)
    counts = {r["doc_id"]: r["n_copies"] for r in mixing.copies(frame, target=corpus_pipeline.MIX).collect()}
    assert min(counts.values()) >= 1
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    want = Counter()
    for i, n in counts.items():
        ids = t.encode(left[i]["text"], add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        want[(i, left[i]["source"], len(ids), sha(" ".join(map(str, ids))), sha(decoded))] += n
    got = corpus_pipeline.run(spark, sf)
    rows = Counter((r["doc_id"], r["source"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect())
    assert rows == want


def clashing(docs):
    """Extra columns whose names the stages use inside."""
    extra = ["kept", "n_words", "ids", "decoded", "_gone", "_passes", "_radix_key", "fp", "row", "c0", "_text"]
    names = {c.lower() for c in docs.columns}
    return docs.withColumns({c: F.lit(i) for i, c in enumerate(extra) if c.lower() not in names})


def test_odd_rows_and_clashing_names_go_through_all_stages(spark, odd, sf):
    docs = clashing(odd.withColumnRenamed("text_sha256", "source"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns, name
        assert after.count() <= docs.count() * 2
    prose = " ".join(f"word{i} and" for i in range(40))
    good = [(i, f"{prose} tail{i % 2}", "x") for i in range(3)] + [(None, prose, None), (4, None, "x"), (4, "", "y")]
    docs = clashing(spark.createDataFrame(good, "doc_id long, text string, source string"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    # 0 and 2 are equal (2 stays); 1 differs in a word and is linked to 2 or not; the row without an id stays.
    assert {r["doc_id"] for r in docs.collect()} - {1} == {2, None} or {r["doc_id"] for r in docs.collect()} == {1, None}


def test_no_rows_go_through_all_stages(spark, nothing, sf):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0 and "ids_sha256" in docs.columns


def test_what_a_worker_keeps_of_encoded_texts_is_bounded(spark, monkeypatch):
    given = {}
    encoded = corpus_pipeline.bpe.encoded
    monkeypatch.setattr(corpus_pipeline.bpe, "encoded", lambda *a, **options: given.update(options) or encoded(*a, **options))
    docs = spark.createDataFrame([(1, "some words", "x")], "doc_id long, text string, source string")
    assert corpus_pipeline.encode(spark, docs, "").count() == 1
    options = {k: given[k] for k in ("apart", "chunks", "words") if k in given}
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoder = corpus_pipeline.bpe.Encoder(t, **options)
    for at in range(0, 260_000, 2000):
        text = " ".join(f"w{i:x}" for i in range(at, at + 2000))
        ids = encoder.encode(text)
        if at % 50_000 == 0:
            assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
    caches = [encoder.words, encoder.chunks, encoder.joins]
    assert [len(c.new) + len(c.old) <= n for c, n in zip(caches, (200_000, 10_000, 10_000), strict=True)] == [True] * 3
