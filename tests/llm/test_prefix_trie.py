"""The conversation trie against a plain dictionary of prefixes."""

import zlib
from collections import defaultdict
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import sha
from modrisk.llm import prefix_trie
from modrisk.llm.queries import op11_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def slow_trie(rows, grow=True):
    own = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            role, text = r["role"] or "", r["text"] or ""
            tie = md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[r["conv_id"]].append(((r["turn"] is not None, r["turn"] or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if grow else 0
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
        ends[turns].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[b] for b in below)
    return sorted(
        (
            min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children[n]), leaves[n], saved[n],
            sha(",".join(map(str, sorted(ends[n])))),
        )
        for n, m in members.items()
    )


def rows_of(frame):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in frame.collect())


def test_close_of_each_open():
    draw = np.random.default_rng(3)
    for n in (1, 5, 64, 700, 3000):
        depth = [0]
        for _ in range(n - 1):
            depth.append(draw.integers(1, depth[-1] + 2))
        steps = []
        for i, d in enumerate(depth):
            steps += [1] + [-1] * (d - (depth[i + 1] if i + 1 < n else 0) + 1 if i + 1 < n else d + 1)
        opens, stack, want = np.flatnonzero(np.array(steps) == 1), [], {}
        for at, s in enumerate(steps):
            if s == 1:
                stack.append(at)
            else:
                want[stack.pop()] = at
        got = prefix_trie.find_close(np.cumsum(steps), opens)
        assert dict(zip(opens.tolist(), got.tolist(), strict=True)) == want


@pytest.mark.parametrize("shard", [1, 40, 100_000])
def test_shards_and_levels_change_nothing(spark, shard):
    """Shared first turns, one very frequent conversation, chains that end inside others, copies over many shards."""
    rows = []
    for c in range(400):
        kind = c % 4
        turns = {
            0: ["hello", "hi", "bye"], 1: ["hello", "hi"], 2: ["hello", f"q{c % 37}", "a", f"é{c % 11}"], 3: [f"t{c}"] * (c % 9),
        }[kind]
        rows += [(c, i, "user" if i % 2 == 0 else None, t) for i, t in enumerate(turns)]
        if not turns:
            rows.append((c, None, "user", ""))
    rows += [(1000, i, "user", "deep") for i in range(60)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    found = prefix_trie.paths(frame)
    assert rows_of(prefix_trie.trie(found, shard)) == slow_trie(frame.collect(), grow=False)


def test_query_like_a_dictionary(spark, sf):
    talks = spark.read.parquet(f"{sf}/conversations.parquet")
    got = rows_of(op11_prefix_trie(spark, sf))
    assert got == slow_trie(talks.collect())
    assert any(r[3] > 1 and r[1] > 1 for r in got)


def test_odd_rows(spark):
    rows = [
        (5, None, None, None), (5, 1, "user", "a"), (5, 1, "user", "b"), (5, 1, "user", "b"), (6, 0, "user", "x" * 200_000),
        (None, 0, "user", "lost"), (7, 0, None, ""), (7, 1, "", None), (-3, 0, "user", "a"), (-5, 0, "user", "z"), (10, 0, "u", "ser"), (11, 0, "us", "er"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"path": F.lit(1), "kind": F.lit("x"), "turns": F.lit(2), "digest": F.lit(3)}
    )
    assert rows_of(prefix_trie.trie(prefix_trie.regrown(prefix_trie.paths(frame)))) == slow_trie(frame.collect())
    assert prefix_trie.trie(prefix_trie.regrown(prefix_trie.paths(frame.limit(0)))).count() == 0
