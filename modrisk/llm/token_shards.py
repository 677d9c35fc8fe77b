"""Token ids as binary shards in training order.

1. Every task turns its documents into one stream of ids, each document closed by an end mark, cut into sequences of
   ``length`` ids; only a stream's last sequence is filled up. The streams are written as a table; what follows reads it.
2. The sequences of all streams are numbered through, and a keyed Feistel network permutes the numbers: each sequence has a slot
   of its own. Numbers that fall outside are walked along their cycle until they fall inside, so slots are dense.
3. Shard s holds the slots from s * per_shard on. Sequences go to the task of their shard, are sorted by slot, and written
   as records of fixed length: slot n is in shard n // per_shard at byte (n % per_shard) * stride. A reader goes through
   the files in order and can resume at any slot without an index.

A record is 2 * length + 1 bytes: the low bytes of all ids, their high bytes, and a line feed. Ids are below 65536. The files
are written by Spark's own text writer with bytes as they are, so they go through any file system, and tasks that are
lost or repeated leave no partial shard.

Defined results: a null text counts as empty; an empty text gives its end mark only. Rows that repeat are written each. An
empty table gives no sequence and no shard. Other columns are ignored. The order of sequences before the permutation is
that of the token table; with the same table and key, shards come out the same to the byte. A folder that has shards is
refused.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from modrisk.llm.shared import freed_shuffles, work_folder, written

LENGTH = 1024
PER_SHARD = 8192
KEY = 20240607
ROUNDS = 6  # of the Feistel network
PASSES = 3  # ranges of shards, written one after the other
BLANKS = 100_000  # blanks in a run that is cut out


class Encoder:
    """Ids of whole texts as little-endian 16-bit numbers, by a byte-level BPE.

    ``pattern`` cuts a text into pieces. The library cannot follow a lookahead over some million blanks, so a long run of
    blanks is cut out first: but for the last one, which belongs to what follows, it is one piece, as with any pattern
    that ends in ``\\s+(?!\\S)|\\s+`` and has no other rule for two blanks.
    """

    def __init__(self, path: str, pattern: str, blanks: int = BLANKS):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("shards", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.piece = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.blanks, self.run = blanks, re.compile(rf"[^\S\x1c-\x1f]{{{blanks},}}")

    def ids(self, text: str) -> bytes:
        out, at = array("H"), 0
        if len(text) >= self.blanks:
            for run in self.run.finditer(text):
                end = run.end() if run.end() == len(text) else run.end() - 1
                out.extend(self.encoding.encode_ordinary(text[at : run.start()]))
                out.extend(self.piece.encode_ordinary(text[run.start() : end]))
                at = end
        out.extend(self.encoding.encode_ordinary(text[at:]))
        return out.tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


_STREAM = "stream int, seq long, n_tokens int, doc_ids array<{id}>, record binary"


def _record(ids: np.ndarray) -> bytes:
    return ids.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()


def ids_of(record: bytes, length: int) -> np.ndarray:
    """The ids of a record, filling included."""
    planes = np.frombuffer(record[: 2 * length], np.uint8).reshape(2, length)
    return planes[0].astype(np.uint16) | (planes[1].astype(np.uint16) << 8)


def _streams(path: str, pattern: str, length: int, id_type: pa.DataType):
    schema = pa.schema([
        ("stream", pa.int32()), ("seq", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(id_type)), ("record", pa.binary())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stream, seq = _encoder(path, pattern), TaskContext.get().partitionId(), 0
        end = array("H", [encoder.end]).tobytes()
        open_ids: list[np.ndarray] = []  # of the sequence that is being filled
        open_docs: list = []
        held = 0

        def packed(rows: list[tuple[np.ndarray, list]]) -> pa.RecordBatch:
            nonlocal seq
            columns = {
                "stream": [stream] * len(rows), "seq": list(range(seq, seq + len(rows))), "n_tokens": [len(x) for x, _ in rows],
                "doc_ids": [d for _, d in rows],
                "record": [_record(np.pad(x, (0, length - len(x)), constant_values=encoder.end)) for x, _ in rows],
            }
            seq += len(rows)
            return pa.RecordBatch.from_pydict(columns, schema=schema)

        for batch in batches:
            rows: list[tuple[np.ndarray, list]] = []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(encoder.ids(text or "") + end, "<u2")
                while len(ids):
                    some, ids = ids[: length - held], ids[length - held :]
                    open_ids.append(some)
                    open_docs.append(ident)
                    held += len(some)
                    if held == length:
                        rows.append((np.concatenate(open_ids), open_docs))
                        open_ids, open_docs, held = [], [], 0
                        if len(rows) >= 512:
                            yield packed(rows)
                            rows = []
            if rows:
                yield packed(rows)
        if held:
            yield packed([(np.concatenate(open_ids), open_docs)])

    return run


def token_table(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, folder: str | None = None
) -> DataFrame:
    """(stream, seq, n_tokens, doc_ids, record) of all sequences, written below the work folder."""
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = frame.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    coded = frame.mapInArrow(_streams(path, pattern, length, to_arrow_type(kind)), _STREAM.format(id=kind.simpleString()))
    return written(coded, f"{folder or work_folder(docs.sparkSession, 'tokens')}/tokens", codec="zstd")


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key % (1 << 64))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def permuted(index: np.ndarray, total: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0 .. total - 1: Feistel over the next even number of bits, walked into range."""
    half = max(1, -(-max(1, (total - 1).bit_length()) // 2))
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & low
        for r in range(rounds):
            left, right = right, left ^ (_mixed(right, key * 1_000_003 + r) & low)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= total]
    return out.astype(np.int64)


def placed(
    tokens: DataFrame, key: int = KEY, per_shard: int = PER_SHARD, length: int = LENGTH, shards: tuple[int, int] | None = None
) -> DataFrame:
    """The token table with slot, shard and byte offset of each sequence; of all shards, or of those from .. below."""
    # One count for each task that wrote the token table; what the rows need of them goes along with the function.
    counts = {r["stream"]: r["count"] for r in tokens.groupBy("stream").count().collect()}
    sizes = np.array([counts.get(s, 0) for s in range(max(counts, default=-1) + 1)], np.int64)
    starts, total = np.cumsum(sizes) - sizes, int(sizes.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stream, seq = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            slot = permuted(starts[stream] + seq, total, key)
            shard = slot // per_shard
            mine = pa.array((shard >= shards[0]) & (shard < shards[1])) if shards else None
            out = pa.RecordBatch.from_arrays([pa.array(slot), *batch.columns[2:]], names=["slot", *batch.schema.names[2:]])
            yield out if mine is None else out.filter(mine)

    kind = dict(tokens.dtypes)["doc_ids"]
    slots = tokens.select("stream", "seq", "n_tokens", "doc_ids", "record").mapInArrow(
        run, f"slot long, n_tokens int, doc_ids {kind}, record binary"
    )
    return slots.select(
        "slot", F.floor(F.col("slot") / per_shard).cast("long").alias("shard"),
        ((F.col("slot") % per_shard) * (2 * length + 1)).cast("long").alias("byte_offset"), "n_tokens", "doc_ids", "record",
    )


def _holds_shards(spark: SparkSession, folder: str) -> bool:
    try:
        return not spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def write_shards(
    tokens: DataFrame, folder: str, key: int = KEY, per_shard: int = PER_SHARD, length: int = LENGTH, rounds: int = PASSES
) -> DataFrame:
    """Write ``folder``/shard=N/part-*.txt and give the index: slot, shard, byte_offset, n_tokens, doc_ids, record_sha256.

    Shards are written in ``rounds`` ranges one after the other, so that only one range's sequences lie in shuffle files at a time.
    """
    if _holds_shards(tokens.sparkSession, folder):
        raise FileExistsError(f"{folder} has shards already")
    shards = -(-tokens.count() // per_shard)
    for r in range(rounds):
        low, high = shards * r // rounds, shards * (r + 1) // rounds
        if low == high:
            continue
        sequences = placed(tokens, key, per_shard, length, (low, high))
        records = sequences.select("shard", "slot", F.col("record").cast("string").alias("value"))
        # Each shard is a range of slots and a partition of its own: nothing is sampled, no two shards share a task.
        dealt = records.repartitionById(high - low, (F.col("shard") - low).cast("int")).sortWithinPartitions("shard", "slot").drop("slot")
        with freed_shuffles(tokens.sparkSession):
            dealt.write.mode("append").partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(folder)
    return placed(tokens, key, per_shard, length).withColumn("record_sha256", F.sha2("record", 256)).drop("record")


def read_from(spark: SparkSession, folder: str, slot: int, per_shard: int = PER_SHARD, length: int = LENGTH) -> Iterator[np.ndarray]:
    """Sequences in training order from ``slot`` on, one shard in memory at a time; for checks and small readers."""
    stride = 2 * length + 1
    while True:
        shard, at = divmod(slot, per_shard)
        files = spark.read.format("binaryFile").load(folder).filter(F.col("shard") == shard).select("content").collect()
        if not files:
            return
        data = bytes(files[0]["content"])
        for k in range(at, len(data) // stride):
            yield ids_of(data[k * stride : (k + 1) * stride], length)
        slot = (shard + 1) * per_shard
