import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from modrisk.llm import token_shards as t
from modrisk.llm.queries import op6_token_shards, tokenizer
from modrisk.llm.shared import work_folder

PATH, PATTERN = tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.mark.parametrize("total", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation(total):
    one, other = (t.permuted(np.arange(total), total, key) for key in (1, 2))
    assert sorted(one) == list(range(total))
    assert total < 64 or (one != other).any()
    assert total < 64 or (one != np.arange(total)).any()


def test_runs_of_blanks_are_cut_out():
    encoder = t.Encoder(PATH, PATTERN, blanks=3)
    draw = random.Random(2)
    bits = ["it's", " ", "  ", "   ", "\n\n\n", "\t", "école", "日本語", "\xa0", "　", "12 34", "...", "a", "The", "\x1c", "\x1c \x1c ", "<|endoftext|>"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(30))) for _ in range(2000)]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u2").tolist() == encoder.encoding.encode_ordinary(text)


def test_millions_of_blanks():
    encoder = t.Encoder(PATH, PATTERN)
    ids = np.frombuffer(encoder.ids("a" + " " * 3_000_000 + "b" + "\n" * 2_000_000), "<u2").tolist()
    assert encoder.encoding.decode(ids) == "a" + " " * 3_000_000 + "b" + "\n" * 2_000_000


@pytest.mark.parametrize(("length", "per_shard"), [(64, 60), (256, 1000)])
def test_round_trip(spark, documents, length, per_shard):
    some = documents.filter("doc_id < 20").repartition(3)
    tokens = t.token_table(some, PATH, PATTERN, length=length)
    folder = work_folder(spark, "shards")
    index = sorted(t.write_shards(tokens, folder, per_shard=per_shard, length=length).collect())
    with pytest.raises(FileExistsError):
        t.write_shards(tokens, folder, per_shard=per_shard, length=length)
    # Slots by brute force: sequences numbered stream by stream, then permuted.
    numbered = sorted((r["stream"], r["seq"], bytes(r["record"])) for r in tokens.collect())
    slots = t.permuted(np.arange(len(numbered)), len(numbered)).tolist()
    want = {slot: sha256(n[2]).hexdigest() for slot, n in zip(slots, numbered, strict=True)}
    assert {r["slot"]: r["record_sha256"] for r in index} == want
    files = spark.read.format("binaryFile").load(folder).select("shard").collect()
    assert sorted(r["shard"] for r in files) == list(range(-(-len(index) // per_shard)))
    assert [r["slot"] for r in index] == list(range(len(index)))
    read = list(t.read_from(spark, folder, 0, per_shard, length))
    assert len(read) == len(index)
    resumed = list(t.read_from(spark, folder, 9, per_shard, length))
    assert [x.tolist() for x in resumed] == [x.tolist() for x in read[9:]]
    stored = {r["record"]: (r["stream"], r["seq"]) for r in tokens.collect()}
    streams = {}
    encoder = t.Encoder(PATH, PATTERN)
    for r, ids in zip(index, read, strict=True):
        streams[stored[bytes(t._record(ids))]] = ids[: r["n_tokens"]].tolist()
    whole = [i for _, ids in sorted(streams.items()) for i in ids]
    docs, now = [], []
    for i in whole:
        if i == encoder.end:
            docs.append(now)
            now = []
        else:
            now.append(i)
    assert now == []
    assert sorted(docs) == sorted(encoder.encoding.encode_ordinary(r["text"]) for r in some.collect())
    assert {d for r in index for d in r["doc_ids"]} == {r["doc_id"] for r in some.collect()}


def test_odd_rows(spark, odd, nothing):
    tokens = t.token_table(odd.withColumn("slot", F.lit(3)), PATH, PATTERN, length=32)
    index = t.write_shards(tokens, work_folder(spark, "shards"), length=32).collect()
    assert {d for r in index for d in r["doc_ids"]} == {r["doc_id"] for r in odd.collect()}
    end = t.Encoder(PATH, PATTERN).end
    ends = sum((t.ids_of(r["record"], 32)[: r["n_tokens"]] == end).sum() for r in tokens.collect())
    assert ends == odd.count()
    none = t.write_shards(t.token_table(nothing, PATH, PATTERN), work_folder(spark, "shards"))
    assert none.count() == 0


def test_query(spark, sf, documents):
    rows = op6_token_shards(spark, sf).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    assert {d for r in rows for d in r["doc_ids"]} == {r["doc_id"] for r in documents.collect()}
