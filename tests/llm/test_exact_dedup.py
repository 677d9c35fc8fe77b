from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest_llm import sha
from modrisk.llm import exact_dedup


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def check(rows, data):
    groups = defaultdict(list)
    for i, text in data:
        groups[low(text)].append(i)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(str(i), str(keep), len(ids), sha(text)) for i in ids]
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in rows) == sorted(want)
    assert sum(r["kept"] for r in rows) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


@pytest.mark.parametrize(("width", "growth"), [(32, 8), (1, 2), (7, 1)])
def test_like_brute_force(spark, width, growth):
    stems = ["", "a", "A", "ab", "aB", "é", "É", "a" * 40, "a" * 41, "a" * 31 + "é", "b" * 32, "B" * 32, "日本語", "a\0b", "a\0"]
    data = list(enumerate([*stems, *stems, None, "z" * 60, "Z" * 60]))
    frame = spark.createDataFrame(data, "doc_id long, text string")
    check(exact_dedup.exact_groups(frame, width=width, growth=growth).collect(), data)


def test_odd_rows(spark, odd, nothing):
    data = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(exact_dedup.exact_groups(odd).collect(), data)
    assert exact_dedup.exact_groups(nothing).count() == 0
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(low(r["text"]) for r in kept.collect()) == sorted({low(t) for _, t in data})
    assert exact_dedup.keep_one(nothing).count() == 0


def test_documents(spark, documents):
    rows = exact_dedup.exact_groups(documents).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in documents.collect()])
    left = {r["doc_id"] for r in exact_dedup.keep_one(documents).collect()}
    assert left == {r["doc_id"] for r in rows if r["kept"]}
    assert exact_dedup.keep_one(documents.filter(F.lit(False))).count() == 0
