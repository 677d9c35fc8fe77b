import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modrisk.llm import mixing


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w)


@pytest.mark.parametrize(
    "target", [mixing.Target(), mixing.Target(repetition=1.5), mixing.Target(entropy=0.8, budget=300_000), mixing.Target(budget=20_000, repetition=2.0)]
)
def test_weights_and_quotas(documents, target):
    uneven = documents.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "big").otherwise(F.col("source")))
    rows = mixing.copies(uneven, target=target, block_rows=16).collect()
    assert len(rows) == uneven.count()
    tokens, read, weight, longest = Counter(), Counter(), {}, Counter()
    for r in rows:
        s = r["source"]
        tokens[s] += r["n_tokens"]
        read[s] += r["n_tokens"] * r["n_copies"]
        weight[s] = r["weight"]
        longest[s] = max(longest[s], r["n_tokens"])
    total = sum(tokens.values())
    assert sum(weight.values()) == pytest.approx(1)
    # One exponent fits all sources.
    low, high = min(tokens, key=tokens.get), max(tokens, key=tokens.get)
    a = math.log(weight[high] / weight[low]) / math.log(tokens[high] / tokens[low])
    assert 0 <= a <= 1
    for s in tokens:
        assert weight[s] == pytest.approx((tokens[s] / total) ** a / sum((t / total) ** a for t in tokens.values()))
    budget = target.budget or max(tokens[s] / weight[s] for s in tokens)
    most = target.entropy * math.log(len(tokens))
    if entropy(t / total for t in tokens.values()) <= most and (target.budget or 0) <= total:
        assert entropy(weight.values()) <= most + 1e-9
        assert max(weight[s] * budget / tokens[s] for s in tokens) <= target.repetition * (1 + 1e-9)
        # One of the limits is met, unless the sources are all equal already.
        assert a < 1e-9 or entropy(weight.values()) > most - 1e-3 or max(weight[s] * budget / tokens[s] for s in tokens) > target.repetition - 1e-3
    for s in tokens:
        assert weight[s] * budget - 1 <= read[s] <= weight[s] * budget + longest[s] + 1
        counts = {r["n_copies"] for r in rows if r["source"] == s}
        assert max(counts) - min(counts) <= 1
    if target.budget is None:
        assert min(r["n_copies"] for r in rows) >= 1


def test_mixed_repeats_rows(documents):
    counts = {r["doc_id"]: r["n_copies"] for r in mixing.copies(documents).collect()}
    rows = mixing.mixed(documents)
    assert rows.columns == documents.columns
    assert dict(Counter(r["doc_id"] for r in rows.collect())) == {i: n for i, n in counts.items() if n}


def test_odd_rows(spark, odd, nothing):
    clash = odd.withColumnRenamed("text_sha256", "source").withColumn("n_copies", F.lit(7))
    rows = mixing.copies(clash).collect()
    assert len(rows) == clash.count()
    assert {r["source"] for r in rows} == {"x", "y", "z", None}
    assert mixing.copies(nothing).count() == 0
    assert mixing.mixed(nothing).count() == 0
    empty = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted(r["n_copies"] for r in mixing.copies(empty).collect()) == [1, 1]
    assert mixing.mixed(empty).count() == 2
