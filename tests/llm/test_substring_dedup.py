import random
import re

import pytest

from conftest_llm import sha
from modrisk.llm import substring_dedup
from modrisk.llm.queries import op3_substring_dedup


def slow(docs, window=20):
    """By definition: windows in order, a window is removed if its words were seen before."""
    seen, out = set(), []
    for i, text in sorted(docs, key=lambda d: -(2**63) if d[0] is None else d[0]):  # rows of one id as they stand
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                gone |= set(range(s, s + window))
            seen.add(w)
        out.append((str(i), len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out)


def got(frame):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_text"]) for r in frame.collect())


def test_query_like_brute_force(spark, sf, documents):
    want = slow([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert sum(w[2] for w in want) > 0
    rows = op3_substring_dedup(spark, sf).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows) == [
        (i, n, gone, sha(text)) for i, n, gone, text in want
    ]


@pytest.mark.parametrize("bucket_chars", [300, 10**6])
def test_planted_passages(spark, bucket_chars):
    """Passages of 19 to 60 words at any offset, shared by many documents, overlapping and inside one document."""
    draw = random.Random(bucket_chars)
    word = lambda: draw.choice("abcdefgh") + str(draw.randrange(400))
    passages = [[word() for _ in range(n)] for n in (19, 20, 21, 25, 33, 60)]
    docs = []
    for i in range(120):
        words = []
        for _ in range(draw.randrange(4)):
            words += [word() for _ in range(draw.randrange(25))]
            p = draw.choice(passages)
            a = draw.randrange(3)
            words += p[a : len(p) - draw.randrange(3)]
        docs.append((i * 7 % 120, draw.choice([" ", "\n", "  "]).join(words)))
    docs.append((500, "same " * 300))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(substring_dedup.without_repeats(frame, bucket_chars=bucket_chars)) == slow(docs)


def test_odd_rows(spark, odd, nothing):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(substring_dedup.without_repeats(odd)) == slow(docs)
    assert substring_dedup.without_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.without_repeats(odd, block=11)


def test_words_that_fool_polynomials(spark):
    """Words of 512 letters a and b in Thue-Morse order, and the same exchanged, are different words."""
    odd = "".join("ab"[bin(i).count("1") % 2] for i in range(512))
    even = odd.translate(str.maketrans("ab", "ba"))
    same = " ".join(f"w{i}" for i in range(19))
    docs = [(1, f"{same} {odd}"), (2, f"{same} {even}"), (3, f"{even} {same}"), (4, f"{odd} {same}"), (5, f"{same} {odd}")]
    rows = got(substring_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert rows == slow(docs)
    assert [r[2] for r in rows] == [0, 0, 0, 0, 20]


def test_rows_of_one_id_are_dealt_to_many_buckets(spark):
    draw = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(None if i % 3 else 7, f"{passage} {' '.join(str(draw.random()) for _ in range(30))}") for i in range(90)]
    docs += docs[:5]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert got(substring_dedup.without_repeats(frame, bucket_chars=2000)) == slow(docs)
