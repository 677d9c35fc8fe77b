import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from modrisk.llm import simhash
from modrisk.llm.components import components


def slow_print(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_like_brute_force(spark, documents):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(documents).collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    prints = {i: slow_print(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    near = [(a, b) for a, b in combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert near
    assert {i: r["component_id"] for i, r in got.items()} == groups(prints, near)


@pytest.mark.parametrize(("node", "cap"), [(1 << 14, 1 << 20), (8, 1 << 20), (64, 12)])
def test_tries_lose_no_link(spark, node, cap):
    """Chains, dense balls and far pairs; also with many nodes and with crowded nodes that are split again."""
    draw = random.Random(node)
    prints = set()
    for _ in range(40):
        x = draw.getrandbits(64)
        prints.add(x)
        for _ in range(draw.choice([0, 1, 8])):
            x ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 4, 5])))
            prints.add(x)
    center = draw.getrandbits(64)
    prints |= {center ^ sum(1 << b for b in draw.sample(range(64), 3)) for _ in range(150)}
    prints = sorted(prints)
    signed = [(int(np.array(p, np.uint64).view(np.int64)),) for p in prints]
    frame = spark.createDataFrame(signed, "fp long")
    links = simhash.fingerprint_links(frame, node=node, cap=cap)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    near = [(a, b) for (a, p), (b, q) in combinations(list(zip([s[0] for s in signed], prints)), 2) if (p ^ q).bit_count() <= 4]
    want = groups([s[0] for s in signed], near)
    assert {s: got.get(s, s) for (s,) in signed} == want


def test_odd_rows(spark, odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in empty} == {1, 2, 12}
    assert {r["component_id"] for r in empty} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (3, 4, None)} == {3}
    assert simhash.near_duplicates(nothing).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    frame = spark.createDataFrame([*chain, *hub, (5, 5), (None, 3), (7, 6), (6, 7)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert components(frame.filter(F.lit(False))).count() == 0
