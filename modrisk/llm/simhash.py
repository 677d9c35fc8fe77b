"""SimHash near-duplicates by a self-join over binary tries.

A document's fingerprint has 64 bits by majority vote over the hashes of its word shingles. Equal fingerprints collapse
first, so copies cost one row. The trie self-join walks pairs of nodes downwards together, adds up the bits in which
they differ, and drops a pair as soon as it has spent its error budget.

Three tries share the work: each has another third of the bits on top. Of ``bits`` errors, some third holds at most a
third, so in that trie a pair may spend ``bits // 3`` errors on the top third; this keeps the number of node pairs
small where the trie is dense. The top ``depth`` levels are walked by Spark: a fingerprint goes to the node pairs that
its own node forms with each node in budget. Depth grows with the number of fingerprints, so one pair's fingerprints stay few;
a pair above ``cap`` fingerprints (a hot prefix) is taken further down by four levels, again and again. Below that, one
task walks one node pair, on sorted arrays.

A task gives a spanning forest of the links it finds, not all pairs: node pairs whose fingerprints are linked already
are dropped whole. Components come from distributed stars over those links.

Defined results: a null or empty text has no shingles and the fingerprint zero, which is linked like any other. A null id is
never the smallest of a component with another id; it stands alone only if all ids there are null. Rows that repeat
are returned each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from modrisk.llm.components import components
from modrisk.llm.shared import numbered, renamed, work_folder, written

SEED = 42
SHINGLE = 4
BITS = 4
NODE = 1 << 14  # fingerprints under one node at the depth where tasks take over, about
CAP = 1 << 20  # most fingerprints of a node pair in one task
_THIRDS = ((0, 21), (21, 21), (42, 22))  # rotation to the left, bits of the third that is then on top
_LEAF = 256  # comparisons below which a node pair is compared directly
_BLOCK = 1 << 17  # node pairs walked at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: bit i is 1 if it is set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    begin, end = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(begin), 1 << 15):
        some = zip(begin[at : at + (1 << 15)], end[at : at + (1 << 15)], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in some], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["id", "fp"])

    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return frame.mapInArrow(run, f"id {dict(frame.dtypes)['id']}, fp long")


def _turned(x: np.ndarray, r: int) -> np.ndarray:
    r %= 64
    return x if r == 0 else (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _masks(width: int, errors: int) -> list[int]:
    return [sum(1 << b for b in bits) for n in range(errors + 1) for bits in combinations(range(width), n)]


def _allowed(depth: int, third: int, bits: int) -> int:
    return bits // 3 if depth <= third else bits


def _dealt(depth: int, bits: int):
    """Each fingerprint with every node pair at ``depth`` that it takes part in, for the three tries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for trie, (turn, third) in enumerate(_THIRDS):
                key = _turned(prints, turn)
                own = (key >> np.uint64(64 - depth)) if depth else np.zeros_like(key)
                for mask in _masks(depth, min(_allowed(depth, third, bits), depth)):
                    other = own ^ np.uint64(mask)
                    yield _rows(trie, depth, np.minimum(own, other), np.maximum(own, other), key)

    return run


def _rows(trie: int, depth: int, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    n = len(key)
    return pa.RecordBatch.from_pydict({
        "trie": np.full(n, trie, np.int32), "depth": np.full(n, depth, np.int32),
        "a": a.astype(np.uint64).view(np.int64), "b": b.astype(np.uint64).view(np.int64),
        "key": np.ascontiguousarray(key).view(np.int64),
    })


_DEALT = "trie int, depth int, a long, b long, key long"


def _deeper(bits: int, step: int = 4):
    """Rows of crowded node pairs, dealt again to the pairs of their children that keep the budget."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trie = batch.column(0).to_numpy(zero_copy_only=False)
            depth = batch.column(1).to_numpy(zero_copy_only=False)
            a, b, key = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (2, 3, 4))
            for t, d in {*zip(trie.tolist(), depth.tolist(), strict=True)}:
                here = (trie == t) & (depth == d)
                width = min(step, 64 - d)
                a1, b1, k1 = a[here], b[here], key[here]
                child = k1 >> np.uint64(64 - d - width)
                above = child >> np.uint64(width)
                low = child & np.uint64((1 << width) - 1)
                for mask in range(1 << width):
                    # The partner is under the other node of the pair; under the same one if the pair is one node.
                    partner = np.where(above == a1, b1, a1) << np.uint64(width) | (low ^ np.uint64(mask))
                    spent = np.bitwise_count(child ^ partner)
                    ok = spent <= _allowed(d + width, _THIRDS[t][1], bits)
                    c, p = child[ok], partner[ok]
                    yield _rows(t, d + width, np.minimum(c, p), np.maximum(c, p), k1[ok])

    return run


class _Forest:
    """Links among n sorted keys, kept as a forest; tells fast whether a range is linked already."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []
        self.settle()

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        new = self.label[i] != self.label[j]
        i, j = i[new], j[new]
        if len(i) == 0:
            return
        # One link is enough for each pair of groups.
        pair = np.stack([self.label[i], self.label[j]], axis=1)
        _, first = np.unique(np.sort(pair, axis=1), axis=0, return_index=True)
        for x, y in zip(i[first].tolist(), j[first].tolist(), strict=True):
            p, q = self.find(x), self.find(y)
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                self.links.append((x, y))
        self.settle()

    def settle(self) -> None:
        label = self.parent
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        self.label = self.parent = label.copy()
        self.changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])]) if len(label) else label

    def linked(self, lo1, hi1, lo2, hi2) -> np.ndarray:
        c, label = self.changes, self.label
        return (c[lo1] == c[hi1 - 1]) & (c[lo2] == c[hi2 - 1]) & (label[lo1] == label[lo2])


def _walk(keys: np.ndarray, a: int, b: int, depth: int, third: int, bits: int) -> list[tuple[int, int]]:
    """Links, as index pairs, between sorted keys under the nodes a and b at ``depth``."""
    n = len(keys)
    forest = _Forest(n)
    if n < 2:
        return []
    if n > 2 and a == b:
        near = np.flatnonzero(np.bitwise_count(keys[1:] ^ keys[:-1]) <= bits)
        forest.join(near, near + 1)
    if a == b:
        start = [0, n, 0, n, 0]
    else:
        cut = int((keys >> np.uint64(64 - depth) == np.uint64(a)).sum())
        if cut in (0, n):
            return []
        start = [0, cut, cut, n, int(a ^ b).bit_count()]
    stack = [(depth, *(np.array([x]) for x in start))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        d, lo1, hi1, lo2, hi2, spent = stack.pop()
        if len(lo1) > _BLOCK:
            half = len(lo1) // 2
            stack.append((d, *(x[half:] for x in (lo1, hi1, lo2, hi2, spent))))
            lo1, hi1, lo2, hi2, spent = (x[:half] for x in (lo1, hi1, lo2, hi2, spent))
            stack.append((d, lo1, hi1, lo2, hi2, spent))
            continue
        open_ = ~forest.linked(lo1, hi1, lo2, hi2)
        lo1, hi1, lo2, hi2, spent = (x[open_] for x in (lo1, hi1, lo2, hi2, spent))
        if len(lo1) == 0:
            continue
        small = ((hi1 - lo1) * (hi2 - lo2) <= _LEAF) | (d == 64)
        if small.any():
            s1, n1, s2, n2 = lo1[small], (hi1 - lo1)[small], lo2[small], (hi2 - lo2)[small]
            for at in range(0, len(s1), 8192):
                w1, w2 = n1[at : at + 8192], n2[at : at + 8192]
                area = w1 * w2
                which = np.repeat(np.arange(len(area)), area)
                inner = np.arange(len(which)) - np.repeat(np.cumsum(area) - area, area)
                i = s1[at : at + 8192][which] + inner // w2[which]
                j = s2[at : at + 8192][which] + inner % w2[which]
                hit = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= bits)
                forest.join(i[hit], j[hit])
        big = ~small
        if not big.any():
            continue
        lo1, hi1, lo2, hi2, spent = (x[big] for x in (lo1, hi1, lo2, hi2, spent))
        if d not in ones:
            bit = (keys >> np.uint64(63 - d)) & np.uint64(1)
            ones[d] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        count = ones[d]
        mid1, mid2 = hi1 - (count[hi1] - count[lo1]), hi2 - (count[hi2] - count[lo2])
        self_pair = lo1 == lo2
        children = [
            (lo1, mid1, lo2, mid2, spent, None), (mid1, hi1, mid2, hi2, spent, None),
            (lo1, mid1, mid2, hi2, spent + 1, None), (mid1, hi1, lo2, mid2, spent + 1, ~self_pair),
        ]
        most = _allowed(d + 1, third, bits)
        parts = []
        for l1, h1, l2, h2, e, also in children:
            ok = (l1 < h1) & (l2 < h2) & (e <= most)
            if also is not None:
                ok &= also
            parts.append([x[ok] for x in (l1, h1, l2, h2, e)])
        merged = [np.concatenate(x) for x in zip(*parts, strict=True)]
        if len(merged[0]):
            stack.append((d + 1, *merged))
    return forest.links


def _linked(bits: int):
    def run(key, group):  # no type hints: Spark reads hints here, and not those of this module
        trie, depth, a, b = (x.as_py() for x in key)
        turn, third = _THIRDS[trie]
        keys = np.unique(group.column("key").to_numpy().view(np.uint64))
        mask = (1 << 64) - 1
        links = np.array(_walk(keys, a & mask, b & mask, depth, third, bits), np.int64).reshape(-1, 2)
        back = _turned(keys, 64 - turn)
        return pa.table({"u": back[links[:, 0]].view(np.int64), "v": back[links[:, 1]].view(np.int64)})

    return run


def fingerprint_links(prints: DataFrame, bits: int = BITS, node: int = NODE, cap: int = CAP) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that connect all within ``bits`` of each other."""
    folder = work_folder(prints.sparkSession, "trie")
    n = prints.count()
    depth = min(20, max(0, (max(n, 1) // node).bit_length()))
    dealt = written(prints.select("fp").mapInArrow(_dealt(depth, bits), _DEALT), f"{folder}/{depth}")
    pair, ready = ["trie", "depth", "a", "b"], None
    while True:
        crowded = dealt.groupBy(*pair).count().filter((F.col("count") > cap) & (F.col("depth") < 64)).drop("count")
        if crowded.isEmpty():
            ready = dealt if ready is None else ready.unionByName(dealt)
            break
        depth += 4
        calm = dealt.join(crowded, pair, "left_anti")
        ready = calm if ready is None else ready.unionByName(calm)
        dealt = written(dealt.join(crowded, pair).mapInArrow(_deeper(bits), _DEALT), f"{folder}/{depth}")
    return ready.groupBy(*pair).applyInArrow(_linked(bits), "u long, v long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS,
    node: int = NODE, cap: int = CAP,
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the smallest id reachable)."""
    folder = work_folder(docs.sparkSession, "simhash")
    prints = written(fingerprints(docs, id_col, text_col, shingle), f"{folder}/prints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("least")), f"{folder}/distinct")
    group = components(fingerprint_links(distinct, bits, node, cap))
    # Tables between joins: a join of plain exchanges is one that Spark splits where a component or a fingerprint is hot.
    labelled = distinct.join(group, distinct["fp"] == group["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    labelled = written(labelled, f"{folder}/labelled")
    least = written(labelled.groupBy("component").agg(F.min("least").alias("component_id")), f"{folder}/least")
    by_print = written(labelled.join(least, "component").select("fp", "component_id"), f"{folder}/by_print")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows that stay, with all their columns: of each component those with its smallest id.

    Ids are expected to be unique; rows that repeat an id go or stay together, and rows without an id all stay.
    """
    rows, at = numbered(docs)
    ident = at[id_col]
    found = near_duplicates(rows, ident, at[text_col], **options)
    gone = found.filter(F.col(ident) != F.col("component_id")).select(F.col(ident).alias("_gone")).distinct()
    return renamed(rows.join(gone, rows[ident] == gone["_gone"], "left_anti"), docs)
