"""Prefix trie of conversations: balanced parentheses in sorted shards, with merged spines.

A node is a distinct sequence of first turns; a conversation is a member of every node on its way.

1. A turn becomes a 128-bit digest and the bytes of its text, so texts are never shuffled. A conversation is one row: its
   digests in order, its *path*. Paths are range partitioned by (path, id) and sorted; copies of one conversation, however
   many, are spread by their ids, and conversations that share first turns by what comes after.
2. Shards. A task reads its sorted paths and closes a shard every ``shard`` turns. The shard's trie is encoded as balanced
   parentheses; blocks of ``BLOCK`` excess values with a tree of block minima answer findclose for all nodes at once. An
   open and its close delimit a subtree; a rank over leaf pairs counts its leaves, cumulative arrays give its members and
   savings.
3. Spines. Nodes on the way to a shard's first or last path may go on in the neighbouring shards. They leave the shard as
   two chains, with what hangs off them already summed up. Chains are paths again: they are sorted and put into shards
   in the same way, level by level, until one shard holds all that is left; a level leaves a quarter or fewer of the nodes.
4. Ids that end at a spine node leave as pieces in order, and are hashed one after the other without being held together.

Bounds: a task holds a shard or eight of the longest conversations, whichever is more; a conversation counts 20 bytes a
turn and must fit in a task. The digest of the ids that end at a node reads them in order, as the contract's SHA-256
does: one task streams them. Levels are written tables; a lost executor costs its tasks.

Defined results: null roles and texts are empty. Turns are ordered with null first; turns with equal numbers by their
digest, so repeated rows and ties have one order on every run. Rows without a conversation id belong to none. No
conversations give no nodes, not even a root. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from modrisk.llm.shared import work_folder, written

SHARD = 500_000  # turns of a shard, about
BLOCK = 64  # excess values of a block
PIECE = 50_000  # ids of a piece
ROWS_AT_ONCE = 512
_EMPTY = sha256(b"").hexdigest()


def paths(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order as (digest, bytes of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # The length of the role keeps role and text apart.
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = turns.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("at"), digest.alias("digest"), F.octet_length(text).alias("size")).alias("turn"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def regrown(found: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Conversations with the first turns of their family's first: of h turns, h by a checksum of the id."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(heads)
    lead = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(family))
    rows = found.select("conv_id", "turns", h.cast("int").alias("h"), lead.alias("lead"))
    leads = found.filter(F.pmod(F.col("conv_id"), F.lit(family)) == 0).select(
        F.col("conv_id").alias("lead_id"), F.slice("turns", 1, heads - 1).alias("first")
    )
    joined = rows.join(leads, F.col("lead") == F.col("lead_id"), "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.when(F.col("first").isNotNull(), F.slice("first", F.lit(1), F.col("h")))
    return joined.select("conv_id", F.when(head.isNull(), own).otherwise(F.concat(head, own)).alias("turns"))


def find_close(excess: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Where the parentheses opened at ``opens`` close: the first later place with a smaller excess.

    First in the own block, then up the tree of block minima to a sibling that goes low enough, and down again.
    """
    blocks = -(-len(excess) // BLOCK)
    width = 1 << max(0, (blocks - 1).bit_length())
    padded = np.full(width * BLOCK, np.iinfo(np.int64).max)
    padded[: len(excess)] = excess
    rows = padded.reshape(width, BLOCK)
    tree = np.empty(2 * width, np.int64)
    tree[width:] = rows.min(axis=1)
    level = width
    while level > 1:
        tree[level // 2 : level] = np.minimum(tree[level : 2 * level : 2], tree[level + 1 : 2 * level : 2])
        level //= 2
    out = np.full(len(opens), -1, np.int64)
    places = np.arange(BLOCK)
    for start in range(0, len(opens), 65536):
        at = opens[start : start + 65536]
        below = excess[at]  # an open raises the excess, so its close brings it under this
        hit = (rows[at // BLOCK] < below[:, None]) & (places[None, :] > (at % BLOCK)[:, None])
        here = hit.any(axis=1)
        close = np.where(here, at // BLOCK * BLOCK + hit.argmax(axis=1), -1)
        todo = np.flatnonzero(~here)
        node = at[todo] // BLOCK + width
        target = below[todo]
        climbing = np.ones(len(todo), bool)
        while climbing.any():
            right = (node & 1 == 0) & (tree[np.minimum(node + 1, 2 * width - 1)] < target)
            stop = climbing & right
            node = np.where(stop, node + 1, np.where(climbing, node >> 1, node))
            climbing &= ~stop
        while (node < width).any():
            inner = node < width
            left = np.where(inner, 2 * node, node)
            node = np.where(inner & ~(tree[left] < target), left + 1, left)
        low = rows[node - width] < target[:, None]
        close[todo] = (node - width) * BLOCK + low.argmax(axis=1)
        out[start : start + len(at)] = close
    return out


class Shard:
    """The trie of sorted paths. Nodes are numbered in preorder; node 0 is the root."""

    def __init__(self, lengths: np.ndarray, digests: np.ndarray, sizes: np.ndarray):
        """Lengths of the paths; digests (two integers a turn) and text bytes of all their turns, one path after the other."""
        n, self.lengths = len(lengths), lengths
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        row = np.repeat(np.arange(n), lengths)
        place = np.arange(len(row)) - self.offsets[row]
        # Turns that a path shares with the one before it.
        before = np.concatenate([[0], lengths[:-1]])
        both = np.flatnonzero((place < before[row]) & (row > 0))
        other = self.offsets[row[both] - 1] + place[both]
        differ = both[(digests[both] != digests[other]).any(axis=1)]
        self.shared = np.minimum(lengths, before)
        first_row, first_at = np.unique(row[differ], return_index=True)
        self.shared[first_row] = place[differ][first_at]
        new = np.flatnonzero(place >= self.shared[row])
        self.depth = np.concatenate([[0], place[new] + 1])
        self.size = np.concatenate([[0], sizes[new]])
        self.end = np.cumsum(lengths - self.shared)  # node of each whole path
        self.digests = digests
        index = np.arange(len(self.depth))
        self._keys = np.sort(self.depth * len(index) + index)  # by depth, then preorder
        self.parent = np.full(len(index), -1)
        self.parent[1:] = self._last((self.depth - 1)[1:], index[1:])
        opens = 2 * index - self.depth
        steps = np.full(2 * len(index), -1, np.int64)
        steps[opens] = 1
        self.stop = index + (find_close(np.cumsum(steps), opens) - opens + 1) // 2  # first node after the subtree
        self.pair = steps[opens + 1] == -1  # childless here

    def _last(self, depth: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The last node of a depth among those numbered under ``before``."""
        n = len(self.depth)
        return self._keys[np.searchsorted(self._keys, depth * n + before) - 1] % n

    def spines(self) -> tuple[np.ndarray, np.ndarray]:
        """Nodes on the way to the first and to the last path, from the root."""
        deep = np.arange(self.lengths[-1] + 1)
        return np.arange(self.lengths[0] + 1), self._last(deep, np.full(len(deep), len(self.depth)))

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.stop] - total[: len(values)]

    def least_below(self, values: np.ndarray) -> np.ndarray:
        out = values.copy()
        for depth in range(int(self.depth.max()), 0, -1):
            n = len(out)
            a, b = np.searchsorted(self._keys, [depth * n, (depth + 1) * n])
            some = self._keys[a:b] % n
            np.minimum.at(out, self.parent[some], out[some])
        return out

    def keys_of(self, row: int) -> list[bytes]:
        """Names of the nodes on the way to a path."""
        so_far, out = md5(), [md5().digest()]
        for turn in self.digests[self.offsets[row] : self.offsets[row + 1]]:
            so_far.update(turn.tobytes())
            out.append(so_far.digest())
        return out


_SUMS = ["members", "kids", "leaves", "saved"]
_NODE = {"conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
         "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends_sha256": pa.string(), "name": pa.binary(), "parent_name": pa.binary()}
_CHAIN = {"path": pa.list_(pa.binary()), "sizes": pa.list_(pa.int32()), "low": pa.list_(pa.int64()), **{c: pa.list_(pa.int64()) for c in _SUMS}}
_PIECE = {"ends_name": pa.binary(), "first_id": pa.int64(), "ids": pa.string()}
_SCHEMA = pa.schema([("kind", pa.string()), *[(n, t) for part in (_NODE, _CHAIN, _PIECE) for n, t in part.items()]])
_SPARK = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, name binary, parent_name binary, path array<binary>, sizes array<int>, low array<long>, "
    "members array<long>, kids array<long>, leaves array<long>, saved array<long>, ends_name binary, first_id long, ids string"
)
_NONE = np.iinfo(np.int64).max


def _batch(kind: str, rows: dict) -> pa.RecordBatch:
    n = len(next(iter(rows.values())))
    columns = [pa.array(rows[f.name], f.type) if f.name in rows else pa.array([kind] * n) if f.name == "kind" else pa.nulls(n, f.type) for f in _SCHEMA]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _solved(lengths, digests, sizes, ids, chains, last: bool) -> Iterator[pa.RecordBatch]:
    """The nodes that a shard settles, the chains of its spines and the pieces of ids that end there."""
    shard = Shard(lengths, digests, sizes)
    n = len(shard.depth)
    own = {c: np.zeros(n, np.int64) for c in _SUMS}
    low = np.full(n, _NONE)
    if ids is not None:  # conversations, each a member of its last node
        np.add.at(own["members"], shard.end, 1)
        np.minimum.at(low, shard.end, ids)
    else:  # chains, with a value for each node on the way
        way = np.zeros(int(lengths.max()) + 1, np.int64)
        new = 1
        for r, (length, shared) in enumerate(zip(lengths.tolist(), shard.shared.tolist(), strict=True)):
            way[shared + 1 : length + 1] = np.arange(new, new + length - shared)
            new += length - shared
            for c in _SUMS:
                own[c][way[: length + 1]] += chains[c][r]
            low[way[: length + 1]] = np.minimum(low[way[: length + 1]], chains["low"][r])
    left, right = shard.spines()
    open_ = np.zeros(n, bool)
    if not last:
        open_[left] = open_[right] = True
    settled = np.flatnonzero(~open_)
    members = shard.below(own["members"])
    kids = own["kids"] + np.bincount(shard.parent[1:], minlength=n)
    leaves = shard.below(own["leaves"] + (shard.pair & (own["kids"] == 0)))
    saved = shard.below(own["saved"] + (members - 1) * shard.size)
    least = shard.least_below(low)
    names = {}
    for row, spine in ((0, left), (len(lengths) - 1, right)):
        names.update(zip(spine.tolist(), shard.keys_of(row), strict=True))
    ends: dict[int, str] = {}
    if ids is not None:
        pieces = {c: [] for c in _PIECE}
        start = np.flatnonzero(np.diff(shard.end, prepend=-1))
        for a, b in zip(start.tolist(), [*start[1:].tolist(), len(ids)], strict=True):
            node = int(shard.end[a])
            if open_[node]:
                for at in range(a, b, PIECE):
                    some = ids[at : min(b, at + PIECE)].tolist()
                    pieces["ends_name"].append(names[node])
                    pieces["first_id"].append(some[0])
                    pieces["ids"].append(",".join(map(str, some)))
            else:
                ends[node] = sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest()
        if pieces["ids"]:
            yield _batch("piece", pieces)
    all_names = None
    if ids is None and len(settled):  # settled spines of lower levels: their children ask for them by name
        all_names = [b""] * n
        new = 1
        all_names[0] = md5().digest()
        for r, (length, shared) in enumerate(zip(lengths.tolist(), shard.shared.tolist(), strict=True)):
            if length > shared:
                all_names[new : new + length - shared] = shard.keys_of(r)[shared + 1 :]
                new += length - shared
    for at in range(0, len(settled), 100_000):
        some = settled[at : at + 100_000]
        parent = shard.parent[some]
        outside = (parent >= 0) & open_[np.maximum(parent, 0)]
        inside = (parent >= 0) & ~outside
        yield _batch("node", {
            "conv_id": least[some], "depth": shard.depth[some], "n_convs": members[some], "n_children": kids[some],
            "parent_conv_id": pa.array(np.where(inside, least[np.maximum(parent, 0)], 0), mask=~inside),
            "n_leaves": leaves[some], "saved_tokens": saved[some],
            "ends_sha256": [ends.get(i, _EMPTY) if ids is not None else None for i in some.tolist()],
            "name": [None if all_names is None else all_names[i] for i in some.tolist()],
            "parent_name": [names[p] if o else None for p, o in zip(parent.tolist(), outside.tolist(), strict=True)],
        })
    if last:
        return
    # What hangs off a spine is settled; its sums go to the spine node.
    hung = settled[open_[shard.parent[settled]]]
    for c, totals in (("members", members), ("leaves", leaves), ("saved", saved)):
        np.add.at(own[c], shard.parent[hung], totals[hung])
    np.add.at(own["kids"], shard.parent[hung], 1)
    np.minimum.at(low, shard.parent[hung], least[hung])
    rows = {c: [] for c in _CHAIN}
    told = np.zeros(n, bool)
    for row, spine in ((0, left), (len(lengths) - 1, right)):
        if told[spine].all():
            continue
        turns = slice(shard.offsets[row], shard.offsets[row + 1])
        rows["path"].append([t.tobytes() for t in digests[turns]])
        rows["sizes"].append(sizes[turns].tolist())
        rows["low"].append(np.where(told[spine], _NONE, low[spine]).tolist())
        for c in _SUMS:
            rows[c].append(np.where(told[spine], 0, own[c][spine]).tolist())
        told[spine] = True
    yield _batch("chain", rows)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    return lengths, lists.flatten()


def _digests(flat: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(flat.to_pylist()), np.uint64).reshape(-1, 2)


def _shards(level: int, shard: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        turns = longest = 0

        def solved():
            parts = list(zip(*held, strict=True))
            lengths, digests, sizes = (np.concatenate(p) for p in parts[:3])
            if level == 0:
                return _solved(lengths, digests, sizes, np.concatenate(parts[3]), None, last)
            chains = {c: [x for part in parts[3] for x in part[c]] for c in ["low", *_SUMS]}
            return _solved(lengths, digests, sizes, None, chains, last)

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                lengths, flat = _flat(batch.column("path"))
                sizes = _flat(batch.column("sizes"))[1].to_numpy().astype(np.int64)
                if level == 0:
                    more = batch.column("conv_id").to_numpy()
                else:
                    more = {c: [np.array(x, np.int64) for x in batch.column(c).to_pylist()] for c in ["low", *_SUMS]}
                held.append((lengths, _digests(flat), sizes, more))
                turns, longest = turns + int(lengths.sum()) + len(lengths), max(longest, int(lengths.max()) + 1)
                if not last and turns >= max(shard, 8 * longest):
                    yield from solved()
                    held, turns = [], 0
        if held:
            yield from solved()

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each name, which come one after the other."""
    name, state = None, None
    names, found = [], []
    for batch in batches:
        for this, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if this != name:
                if name is not None:
                    names.append(name)
                    found.append(state.hexdigest())
                name, state = this, sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if name is not None:
        names.append(name)
        found.append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], names=["ends_of", "ends"])


def trie(found: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie over (conv_id, turns): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = found.sparkSession
    folder = work_folder(spark, "trie")
    rows = written(found.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.size").alias("sizes")), f"{folder}/paths")
    level, last, nodes, pieces = 0, False, [], None
    while True:
        if level == 0:
            dealt = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
        else:
            total, longest = rows.agg(F.coalesce(F.sum(F.size("path") + 1), F.lit(0)), F.coalesce(F.max(F.size("path") + 1), F.lit(0))).first()
            size = max(shard, 8 * longest)
            last = total <= size  # one shard holds all that is left
            parts = -(-total // size)
            dealt = (rows.coalesce(1) if last else rows.repartitionByRange(parts, "path")).sortWithinPartitions("path")
        out = written(dealt.mapInArrow(_shards(level, shard, last), _SPARK), f"{folder}/{level}", ["kind"])
        nodes.append(out.filter("kind = 'node'").select(*_NODE))
        if level == 0:
            pieces = out.filter("kind = 'piece'").select(*_PIECE)
        if last:
            break
        rows = out.filter("kind = 'chain'").select(*_CHAIN)
        level += 1
    upper = nodes[1]
    for more in nodes[2:]:
        upper = upper.unionByName(more)
    digests = pieces.repartition("ends_name").sortWithinPartitions("ends_name", "first_id").select("ends_name", "ids")
    ends = digests.mapInArrow(_hashed, "ends_of binary, ends string")
    upper = written(
        upper.join(ends, F.col("name") == F.col("ends_of"), "left").drop("ends_sha256", "ends_of").withColumn(
            "ends_sha256", F.coalesce("ends", F.lit(_EMPTY))
        ).select(*_NODE),
        f"{folder}/upper",
    )
    everything = nodes[0].unionByName(upper)
    # Nodes below a spine learn its smallest member by its name; a spine with very many children is a skewed join key.
    hung = everything.filter("parent_name is not null").drop("parent_conv_id")
    spine = upper.select(F.col("name").alias("spine_name"), F.col("conv_id").alias("parent_conv_id"))
    told = hung.join(spine, F.col("parent_name") == F.col("spine_name"))
    return everything.filter("parent_name is null").unionByName(told.drop("spine_name")).select(*list(_NODE)[:8])
