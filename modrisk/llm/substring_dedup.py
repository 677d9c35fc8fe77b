"""Substring dedup by fixed-block anchors.

Every document's words are cut into non-overlapping blocks of ``block`` words; these are indexed. Every rolling window of
as many words, at every place of every document, probes the index. A window of ``window`` words always holds a whole block
(2 * block <= window + 1), so two equal windows meet at least once. Hits are extended over the words around them: every
window of ``window`` words that holds a hit is looked up whole, windows that stand somewhere earlier are marked, and
overlapping marks grow together to maximal repeats.

Words are told apart by 128 bits of XXH3, windows by 96 bits of two polynomials in their words' halves: of 1e13 windows two
different ones are taken for equal with a chance of one in a thousand.

How it runs: documents go to buckets by id and place of the row, so an id that many rows have is no hot key, and one shuffle of the texts serves all three passes.
1. A bucket hashes all its rolling windows at once, keeps one record per distinct hash, and sends the records, packed, to
   partitions by hash. There, hashes of two or more places, one of them a block, are hits, and go back to their buckets.
2. A bucket extends its hits to whole windows, keeps the earliest of each, and sends these to partitions by hash; all but the
   earliest overall are marked.
3. A bucket removes the words under marked windows.
Because a bucket sends each hash once, a passage that a third of all documents share arrives once a bucket, not once a
document; no pairs are formed. A partition's records are bounded by the number of partitions, which follows the words; a
bucket sends at most a record for each of its hashes, so records grow with the words however many partitions there are.

Order is by id, then, for rows that repeat an id, by their place in the table as read, then by place in the text. Defined results: a null text has no words; a
null id ranks before all others; a repeated row is a later copy of the first. Texts of under ``window`` words stay as they
are. An empty table gives an empty result. Other columns are ignored. Ids must be integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from modrisk.llm.shared import is_integral, whole_text

WINDOW = 20
BLOCK = 10
BUCKET_CHARS = 3_000_000  # characters of a bucket, about; one task holds one at a time
PART_WORDS = 2_000_000  # probe records of a partition, at most about

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASES = [int(x) | 1 for x in np.random.default_rng(7).integers(2**62, 2**63, size=2)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 20)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        have = _POWERS[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _sums(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the slices [start, end): polynomials in ``base``, from running sums."""
    up, down = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return _mixed((total[ends] - total[starts]) * down[starts])


class Bucket:
    """The documents of a bucket in order, as one row of words."""

    def __init__(self, table: pa.Table):
        ids, ties, texts = table.column("i").to_numpy(), table.column("t").to_numpy(), table.column("text").to_pylist()
        self.order = np.lexsort((ties, ids)).tolist()
        data = [texts[r].encode("utf-8", "replace") for r in self.order]
        self.ids, self.ties = ids[self.order], ties[self.order]
        self.data = b"\n".join(data) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        blank = _BLANK[raw]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(raw) and not blank[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        doc_bytes = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])]).astype(np.int64)
        self.first = np.searchsorted(self.starts, doc_bytes)  # first word of each document, and the end
        # A word is known by 128 bits of a good hash, made once for each distinct word.
        known: dict[bytes, int] = {}
        number = np.array([known.setdefault(w, len(known)) for w in self.data.split()], np.int64)
        digests = np.frombuffer(b"".join([bytes(16), *map(xxhash.xxh3_128_digest, known)]), np.uint64).reshape(-1, 2)
        self.hashes = np.ascontiguousarray(digests[number + 1].T)
        self.doc = np.repeat(np.arange(len(data)), np.diff(self.first))  # of each word

    def places(self, n: int, least: int) -> np.ndarray:
        """Where windows of n words start, in documents of ``least`` words or more."""
        at = np.arange(len(self.starts))
        stop = self.first[1:][self.doc]
        return at[(at + n <= stop) & ((stop - self.first[:-1][self.doc]) >= least)]

    def windows(self, at: np.ndarray, n: int, which: int) -> np.ndarray:
        return _sums(self.hashes[which], _BASES[which], at, at + n)


def _planes(values: np.ndarray) -> bytes:
    """Little-endian integers byte plane by byte plane: the high planes of small numbers compress to nothing."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _numbers(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _steps(at: np.ndarray) -> bytes:
    return _planes(np.diff(at, prepend=0).astype(np.uint32))


def _back(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data, np.uint32).astype(np.int64))


def _dealt(part: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(partition, its records in order) of records by partition."""
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.diff(part[order])) + 1
    return [(int(part[some[0]]), some) for some in np.split(order, cut)] if len(part) else []


def _runs(ranked: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)


_PROBES = "part int, b long, h binary, p binary, f binary"
_MARKS = "b long, p binary"
_EXTENDED = "part int, b long, lo binary, hi binary, p binary, i binary, t binary, n binary"


def _probes(parts: int, window: int, block: int):
    def run(key, docs):
        bucket, b = Bucket(docs), key[0].as_py()
        at = bucket.places(block, window)
        rows = {name: [] for name in ("part", "b", "h", "p", "f")}
        if len(at):
            h = bucket.windows(at, block, 0)
            anchor = (at - bucket.first[:-1][bucket.doc[at]]) % block == 0
            order = np.argsort(h, kind="stable")
            run_at = _runs(h[order])
            one, anchored = order[run_at], np.logical_or.reduceat(anchor[order], run_at)
            several = np.diff(np.append(run_at, len(order))) > 1
            by_place = np.argsort(one)
            one, anchored, several = one[by_place], anchored[by_place], several[by_place]
            h, at = h[one], at[one]
            for part, some in _dealt(((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)):
                rows["part"].append(part)
                rows["b"].append(b)
                rows["h"].append(h[some].astype(np.uint32).tobytes())
                rows["p"].append(_steps(at[some]))
                rows["f"].append(np.packbits(np.concatenate([anchored[some], several[some]])).tobytes())
        return pa.table(rows, schema=pa.schema([("part", pa.int32()), ("b", pa.int64()), ("h", pa.binary()), ("p", pa.binary()), ("f", pa.binary())]))

    return run


def _marks(b: list[int], sizes: list[int], places: np.ndarray, marked: np.ndarray) -> pa.Table:
    out_b, out_p, start = [], [], 0
    for bucket, n in zip(b, sizes, strict=True):
        hit = places[start : start + n][marked[start : start + n]]
        start += n
        if len(hit):
            out_b.append(bucket)
            out_p.append(_steps(hit))
    return pa.table({"b": pa.array(out_b, pa.int64()), "p": pa.array(out_p, pa.binary())})


def _hits(key, probes):
    """Hashes at two or more places, one of them an indexed block."""
    b = probes.column("b").to_pylist()
    h = [np.frombuffer(x, np.uint32) for x in probes.column("h").to_pylist()]
    p = [_back(x) for x in probes.column("p").to_pylist()]
    f = [np.unpackbits(np.frombuffer(x, np.uint8), count=2 * len(y)).astype(bool) for x, y in zip(probes.column("f").to_pylist(), h, strict=True)]
    sizes = [len(x) for x in h]
    h = np.concatenate(h)
    anchored = np.concatenate([x[:n] for x, n in zip(f, sizes, strict=True)])
    several = np.concatenate([x[n:] for x, n in zip(f, sizes, strict=True)])
    order = np.argsort(h, kind="stable")
    run_at = _runs(h[order])
    lengths = np.diff(np.append(run_at, len(order)))
    good = np.logical_or.reduceat(anchored[order], run_at) & ((lengths > 1) | np.logical_or.reduceat(several[order], run_at))
    hit = np.zeros(len(h), bool)
    hit[order] = np.repeat(good, lengths)
    return _marks(b, sizes, np.concatenate(p), hit)


def _extended(parts: int, window: int, block: int):
    def run(key, docs, hits):
        rows = {name: [] for name in ("part", "b", "lo", "hi", "p", "i", "t", "n")}
        if docs.num_rows and hits.num_rows:
            bucket, b = Bucket(docs), key[0].as_py()
            at = bucket.places(block, window)
            h = bucket.windows(at, block, 0)
            known = np.concatenate([_back(x) for x in hits.column("p").to_pylist()])
            # A hash was sent once; all its places in the bucket are hits.
            hit = np.isin(h, np.unique(h[np.searchsorted(at, known)]))
            near = np.zeros(len(bucket.starts) + 1, np.int64)
            near[at[hit]] = 1
            near = np.concatenate([[0], np.cumsum(near)])
            starts = bucket.places(window, window)
            starts = starts[near[starts + window - block + 1] > near[starts]]
            lo, hi = bucket.windows(starts, window, 0), bucket.windows(starts, window, 1)
            order = np.lexsort((hi, lo))  # stable: the first of equal windows is the earliest
            l2, h2 = lo[order], hi[order]
            new = np.concatenate([[True], (l2[1:] != l2[:-1]) | (h2[1:] != h2[:-1])]) if len(order) else np.zeros(0, bool)
            one = np.sort(order[new])
            lo, hi, starts = lo[one], hi[one], starts[one]
            docs_of = bucket.doc[starts]
            for part, some in _dealt(((lo >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)):
                own, counts = np.unique(docs_of[some], return_counts=True)
                rows["part"].append(part)
                rows["b"].append(b)
                rows["lo"].append(lo[some].tobytes())
                rows["hi"].append(hi[some].astype(np.uint32).tobytes())
                rows["p"].append(_steps(starts[some]))
                rows["i"].append(_planes(bucket.ids[own].astype(np.int64)))
                rows["t"].append(_planes(bucket.ties[own].astype(np.int64)))
                rows["n"].append(_planes(counts.astype(np.uint32)))
        return pa.table(rows, schema=pa.schema([("part", pa.int32()), ("b", pa.int64()), *[(c, pa.binary()) for c in ("lo", "hi", "p", "i", "t", "n")]]))

    return run


def _later(key, extended):
    """Windows that are not the earliest of their words."""
    col = {n: extended.column(n).to_pylist() for n in extended.column_names}
    lo = np.concatenate([np.frombuffer(x, np.uint64) for x in col["lo"]])
    hi = np.concatenate([np.frombuffer(x, np.uint32) for x in col["hi"]])
    places = [_back(x) for x in col["p"]]
    ids, ties = (
        np.concatenate([np.repeat(_numbers(i, np.int64), _numbers(n, np.uint32)) for i, n in zip(col[c], col["n"], strict=True)]) for c in "it"
    )
    order = np.lexsort((ties, ids, hi, lo))
    same = (lo[order][1:] == lo[order][:-1]) & (hi[order][1:] == hi[order][:-1])
    later = np.zeros(len(lo), bool)
    later[order[1:][same]] = True
    return _marks(col["b"], [len(x) for x in places], np.concatenate(places), later)


def _kept(window: int):
    def run(key, docs, marks):
        bucket = Bucket(docs)
        n = len(bucket.starts)
        starts = bucket.places(window, window)
        lo, hi = bucket.windows(starts, window, 0), bucket.windows(starts, window, 1)
        order = np.lexsort((hi, lo))
        again = (lo[order][1:] == lo[order][:-1]) & (hi[order][1:] == hi[order][:-1])
        cover = np.zeros(n + 1, np.int64)
        for at in [starts[order[1:][again]], *[_back(x) for x in marks.column("p").to_pylist()]]:
            np.add.at(cover, at, 1)
            np.add.at(cover, at + window, -1)
        gone = np.cumsum(cover)[:-1] > 0
        begin, end = bucket.starts.tolist(), bucket.ends.tolist()
        texts, n_words, n_removed = [], [], []
        for d in range(len(bucket.order)):
            a, z = int(bucket.first[d]), int(bucket.first[d + 1])
            texts.append(b" ".join([bucket.data[begin[a + k] : end[a + k]] for k in np.flatnonzero(~gone[a:z]).tolist()]))
            n_words.append(z - a)
            n_removed.append(int(gone[a:z].sum()))
        return pa.table({
            "id": docs.column("id").take(pa.array(bucket.order, pa.int64())),
            "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept_text": pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()),
        })

    return run


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = BLOCK,
    bucket_chars: int = BUCKET_CHARS, part_words: int = PART_WORDS,
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_text (the words that stay, joined by one space)."""
    if 2 * block > window + 1:
        raise ValueError("a window must hold a whole block wherever it starts")
    if not is_integral(docs, id_col):
        raise TypeError(f"{id_col} must be an integer")
    spark = docs.sparkSession
    chars = docs.agg(F.coalesce(F.sum(F.length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
    buckets = max(1, -(-chars // bucket_chars))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(wanted, -(-chars // (4 * part_words)))  # a word and its blank have four characters or more, mostly
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)).cast("long"))
    base = docs.select(
        F.col(id_col).alias("id"), rank.alias("i"), F.monotonically_increasing_id().alias("t"), whole_text(text_col).alias("text")
    ).withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(buckets)))
    # The same exchange in all three passes: Spark runs it once.
    texts = base.repartition(max(wanted, -(-buckets // 16)), "b")
    probes = texts.groupBy("b").applyInArrow(_probes(parts, window, block), _PROBES)
    hits = probes.groupBy("part").applyInArrow(_hits, _MARKS)
    extended = texts.groupBy("b").cogroup(hits.groupBy("b")).applyInArrow(_extended(parts, window, block), _EXTENDED)
    later = extended.groupBy("part").applyInArrow(_later, _MARKS)
    kind = dict(base.dtypes)["id"]
    result = texts.groupBy("b").cogroup(later.groupBy("b")).applyInArrow(
        _kept(window), f"id {kind}, n_words long, n_removed long, kept_text string"
    )
    return result.withColumnRenamed("id", id_col)
