"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut into chunks where a rolling hash of the last bytes says so. Such cuts depend on content only, so a passage
that documents share is cut alike wherever it stands, and a chunk seen before is not encoded again: each Python worker
keeps a bounded cache of chunks. Nothing is shuffled, and a lost executor costs its running tasks.

A new chunk is encoded as one piece. Where the caller says that a tokenizer's words stand apart (no token and no rule
reaches over a blank, as with those that drop blanks first), a new chunk is put together from its words, which are cached
too; every ``TRIED``-th such chunk is also encoded as one, and a difference is an error.

Chunk ids are then joined. The words on both sides of a join are encoded together and apart: if both agree with each other and
with what the chunks gave, the join stands; if not, the window grows, until its first and last words agree with
the chunks and what lies between replaces theirs, at the most until both chunks are encoded as one. Joins seen before are
cached like chunks.

Defined results: a null text counts as empty and has no ids and an empty text. Very long texts are held as a whole in one
task, as they are in Spark. Rows that repeat are returned each; an empty table gives an empty result. Other columns
pass through with ``carry``.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 16  # bytes the rolling hash sees
MASK = 127  # one word end in so many is a cut, about
LONGEST = 16_384  # bytes of a chunk without a cut, as in a text that repeats itself; it goes on to the next blank
CHUNKS = 20_000  # chunks in a cache generation
WORDS = 400_000  # words in a cache generation
TRIED = 64
AT_ONCE = 512  # strings of a call of the tokenizer
ROWS_OUT = 256  # rows in a batch that goes back to Spark

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class Cache:
    """At most 2 * size entries: when one generation is full, the one before it goes."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def with_room(self, n: int) -> dict:
        """The newer generation, after making room for n entries that stay together in it."""
        if len(self.new) + n > self.size:
            self.old, self.new = self.new, {}
        return self.new

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


def cuts(data: bytes, mask: int = MASK, window: int = WINDOW) -> list[int]:
    """Places where a word ends and a chunk with it: those whose ``window`` bytes before have the wanted hash."""
    raw = np.frombuffer(data.rstrip(b" \t\n\r\x0b\x0c"), np.uint8)
    blank = _BLANK[raw]
    at = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    at = at[at >= window]
    if len(at) == 0:
        return []
    found = []
    for some in np.array_split(at, len(at) // 65536 + 1):
        seen = np.ascontiguousarray(raw[some[:, None] + np.arange(-window, 0)]).view(np.uint64)
        key = seen[:, 0] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(1, seen.shape[1]):
            key = (key ^ (key >> np.uint64(29)) ^ seen[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
        found.append(some[key & np.uint64(mask) == 0])
    return np.concatenate(found).tolist()


def pieces(data: bytes, mask: int = MASK, longest: int = LONGEST) -> list[bytes]:
    """The chunks of a text; put together they are the text. A chunk starts with the blanks before its first word."""
    out, start = [], 0
    for end in [*cuts(data, mask), len(data)]:
        while end - start > longest:
            word = data[start + longest : end].split(None, 1)[:1]
            after = data.find(word[0], start + longest) + len(word[0]) if word else end
            if after >= end or not data[after:end].strip():
                break
            out.append(data[start:after])
            start = after
        if end > start:
            out.append(data[start:end])
            start = end
    return out


def _tail(chunk: bytes, n: int) -> bytes:
    """The last n words with the blanks before them; all of it if there are no more."""
    parts = chunk.rsplit(None, n)
    return chunk[len(parts[0]) :] if len(parts) > n else chunk


def _head(chunk: bytes, n: int) -> bytes:
    """The first n words with the blanks before them; all of it if there are no more."""
    parts = chunk.split(None, n)
    return chunk[: len(chunk) - len(parts[n])].rstrip(b" \t\n\r\x0b\x0c") if len(parts) > n else chunk


class Encoder:
    """Encodes whole texts by chunks."""

    def __init__(
        self, tokenizer, mask: int = MASK, longest: int = LONGEST, chunks: int = CHUNKS, apart: bool = False, words: int = WORDS
    ):
        self.tokenizer, self.mask, self.longest, self.apart = tokenizer, mask, longest, apart
        self.chunks, self.joins, self.words = Cache(chunks), Cache(chunks), Cache(words)
        self.made = 0

    def plain(self, texts: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = []
        for at in range(0, len(texts), AT_ONCE):
            some = [t.decode("utf-8", "replace") for t in texts[at : at + AT_ONCE]]
            out += [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return out

    def new_chunks(self, chunks: list[bytes]) -> Iterator[np.ndarray]:
        if not self.apart:
            yield from (np.array(ids, np.int32) for ids in self.plain(chunks))
            return
        for at in range(0, len(chunks), AT_ONCE):
            some = [c.split() for c in chunks[at : at + AT_ONCE]]
            wanted = set(chain.from_iterable(some))
            known = self.words.with_room(len(wanted))
            missing = []
            for w in wanted - known.keys():
                old = self.words.old.get(w)
                if old is None:
                    missing.append(w)
                else:
                    known[w] = old
            known.update((w, array("i", ids).tobytes()) for w, ids in zip(missing, self.plain(missing), strict=True))
            for chunk, words in zip(chunks[at : at + AT_ONCE], some, strict=True):
                ids = np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32)
                self.made += 1
                if self.made % TRIED == 1 and ids.tolist() != self.plain([chunk])[0]:
                    raise ValueError("this tokenizer's words do not stand apart")
                yield ids

    def join(self, left: bytes, right: bytes, left_ids: list[int], right_ids: list[int]) -> tuple[int, int, list[int]] | None:
        """(ids of the left chunk that go, ids of the right chunk that go, what stands in their place); None where the window
        takes all of the left chunk, so that what stands before it may matter."""
        n = 2
        while len(a := _tail(left, n)) < len(left):
            b = _head(right, n)
            whole, apart_a, apart_b, first, last = self.plain([a + b, a, b, _head(a, 1), _tail(b, 1)])
            if left_ids[len(left_ids) - len(apart_a) :] == apart_a and right_ids[: len(apart_b)] == apart_b:
                ends = whole[: len(first)] == first == apart_a[: len(first)]
                ends = ends and whole[len(whole) - len(last) :] == last == apart_b[len(apart_b) - len(last) :]
                if whole == apart_a + apart_b or ends:
                    return len(apart_a), len(apart_b), whole
            n *= 2
        return None

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. New chunks of all texts go to the tokenizer together, then new joins."""
        cut = [pieces((t or "").encode("utf-8", "replace"), self.mask, self.longest) for t in texts]
        found: dict[bytes, tuple] = {}
        for chunk in (c for chunks in cut for c in chunks):
            if chunk not in found:
                found[chunk] = self.chunks.get(chunk)
        new = [c for c, known in found.items() if known is None]
        for chunk, ids in zip(new, self.new_chunks(new), strict=True):
            found[chunk] = (ids, _tail(chunk, 1), _head(chunk, 1))
            self.chunks.put(chunk, found[chunk])
        stands: dict[tuple[bytes, bytes], tuple | None] = {}
        for chunks in cut:
            for left, right in zip(chunks, chunks[1:], strict=False):
                key = (found[left][1], found[right][2])
                if key not in stands:
                    stands[key] = self.joins.get(key)
        new = [k for k, known in stands.items() if known is None]
        tried = self.plain([x for a, b in new for x in (a + b, a, b)])
        for i, key in enumerate(new):
            whole, a, b = tried[3 * i : 3 * i + 3]
            stands[key] = (whole == a + b, np.array(a, np.int32), np.array(b, np.int32))
            self.joins.put(key, stands[key])
        return [self._joined(chunks, found, stands) for chunks in cut]

    def _joined(self, chunks: list[bytes], found: dict, stands: dict) -> np.ndarray:
        out: list[np.ndarray] = []
        done: list[bytes] = []  # what the items of ``out`` encode
        for chunk in chunks:
            ids = found[chunk][0]
            if out:
                tail = found[done[-1]][1] if done[-1] in found else _tail(done[-1], 1)
                fits, a, b = stands.get((tail, found[chunk][2])) or (False, None, None)
                before = out[-1]
                if not fits or not np.array_equal(before[len(before) - len(a) :], a) or not np.array_equal(ids[: len(b)], b):
                    self._repaired(out, done, chunk, ids)
                    continue
            out.append(ids)
            done.append(chunk)
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def _repaired(self, out: list[np.ndarray], done: list[bytes], chunk: bytes, ids: np.ndarray) -> None:
        """Joins a chunk to what stands before it, as far back as it takes; what was looked at is one item from here on."""
        while True:
            left, before = done.pop(), out.pop()
            new = self.join(left, chunk, before.tolist(), ids.tolist())
            if new is None and done:
                done[-1] += left
                out[-1] = np.concatenate([out[-1], before])
                continue
            n, m, whole = new or (len(before), len(ids), self.plain([left + chunk])[0])
            out.append(np.concatenate([before[: len(before) - n], np.array(whole, np.int32), ids[m:]]))
            done.append(left + chunk)
            return

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]


@lru_cache(maxsize=2)
def _encoder(path: str, mask: int, longest: int, chunks: int, apart: bool, words: int) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return Encoder(tokenizer, mask, longest, chunks, apart, words)


def encoded(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
    mask: int = MASK, longest: int = LONGEST, chunks: int = CHUNKS, apart: bool = False, words: int = WORDS,
) -> DataFrame:
    """One row per input row: id, carried columns, ids (array of int), decoded (the ids as text again).

    ``path`` is the tokenizer file; every executor must find it there. ``apart`` says that its words stand apart.
    """
    extra = [c for c in carry or [] if c != id_col]
    frame = docs.select(F.col(id_col), *[F.col(c) for c in extra], F.col(text_col).cast("string").alias("_text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in frame.drop("_text").dtypes) + ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, mask, longest, chunks, apart, words)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(at, ROWS_OUT)
                ids = encoder.encode_all(batch.column(batch.num_columns - 1).to_pylist())
                decoded = [encoder.tokenizer.decode(i.tolist(), skip_special_tokens=False) for i in ids]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                columns = [batch.column(i) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists, pa.array(decoded, pa.string())], names=[*batch.schema.names[:-1], "ids", "decoded"]
                )

    return frame.mapInArrow(run, schema)


def digests(coded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 in place of ids and decoded; carried columns must have other names."""
    return coded.select(
        *[c for c in coded.columns if c not in ("ids", "decoded")],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
