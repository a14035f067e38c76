"""Documents packed into blocks of numbered words, and exact lookups of
hashed keys over all blocks.

A block holds some whole documents as word numbers plus its vocabulary. To
learn something about a key (an n-gram, a window) over the whole corpus, every
block sends each *distinct* key it holds once, with a value already combined
inside the block, to the bucket of the key; the bucket combines the values of
all blocks and answers each block. However often a key occurs, a bucket gets
it at most once per block, so there are no hot keys, and nothing is sent per
occurrence. Spark deals the messages out, sorts and retries them.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import Numbering, materialise, partitions, prepare, texts_of

#: Text bytes after which a block is closed.
BLOCK_BYTES = 8 << 20
#: Rows per Arrow batch where a row holds a block.
BLOCK_ROWS = 4
BLOCK_SCHEMA = "block long, part int, doc_ids array<long>, lengths array<int>, vocabulary binary, tokens binary"
MESSAGE_SCHEMA = "bucket int, block long, n int, keys binary, payload binary"
ANSWER_SCHEMA = "block long, bucket int, payload binary"


def squeeze(data: bytes | np.ndarray) -> bytes:
    """Compressed bytes; an array's values are stored byte plane by byte
    plane, because the high bytes of small numbers compress to nothing."""
    if isinstance(data, np.ndarray):
        flat = np.ascontiguousarray(data).reshape(-1)
        data = np.ascontiguousarray(flat.view(np.uint8).reshape(len(flat), -1).T).tobytes() if len(flat) else b""
    return zstandard.ZstdCompressor(level=3).compress(data)


def expand(data: bytes, dtype=None):
    """The bytes, or the flat array, that ``squeeze`` was given."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    if dtype is None:
        return raw
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit keys as differences, byte plane by byte plane."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return squeeze(steps)


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, "<u8"), dtype=np.uint64)


def part_of_id(doc_id: int | None) -> int:
    """crc32 of the id as text, modulo 10 (NULL: of the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode("ascii")) % 10


def pack(docs: DataFrame, lower: bool, label: str, part: Callable[[int | None], int] | None = None,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text), written to the shared folder.
    Documents with different ``part(doc_id)`` go to different blocks. NULL and
    empty texts are documents without words."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, open_blocks = TaskContext.get().partitionId(), 0, {}

        def close(which: int) -> pa.RecordBatch:
            nonlocal made
            _, ids, lengths, words, tokens = open_blocks.pop(which)
            row = [pa.array([task << 24 | made], pa.int64()), pa.array([which], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                   pa.array([lengths], pa.list_(pa.int32())), pa.array([squeeze(b" ".join(words))], pa.binary()),
                   pa.array([squeeze(np.concatenate(tokens))], pa.binary())]
            made += 1
            return pa.RecordBatch.from_arrays(row, ["block", "part", "doc_ids", "lengths", "vocabulary", "tokens"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                which = part(doc_id) if part else 0
                state = open_blocks.setdefault(which, [0, [], [], Numbering(), []])
                found = (text.lower() if lower else text).split()
                state[0] += len(text) + 1
                state[1].append(doc_id)
                state[2].append(len(found))
                state[4].append(np.fromiter(map(state[3].__getitem__, found), np.int32, len(found)))
                if state[0] >= block_bytes:
                    yield close(which)
        for which in list(open_blocks):
            yield close(which)

    packed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCK_SCHEMA)
    done = materialise(packed, label)
    prepare(docs.sparkSession, BLOCK_ROWS)
    return done


def words_of(row: dict) -> list[bytes]:
    return expand(row["vocabulary"]).split(b" ") if row["vocabulary"] else []


def bucket_count(df: DataFrame) -> int:
    """Buckets of a lookup: a power of two, over twice the shuffle partitions."""
    return 1 << (2 * partitions(df.sparkSession)).bit_length()


def messages(keys: np.ndarray, payload: np.ndarray, block: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """One message per bucket for sorted distinct ``keys`` and their values."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    edges = np.searchsorted(keys >> shift, np.arange(buckets + 1, dtype=np.uint64))
    used = [b for b in range(buckets) if edges[b] < edges[b + 1]]
    if used:
        slices = [slice(edges[b], edges[b + 1]) for b in used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()), pa.array([s.stop - s.start for s in slices], pa.int32()),
             pa.array([squeeze_sorted(keys[s]) for s in slices], pa.binary()), pa.array([squeeze(payload[s]) for s in slices], pa.binary())],
            ["bucket", "block", "n", "keys", "payload"])


def gather(table: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of one bucket's messages in message order, their values, their
    distinct number and the messages' ends."""
    keys = np.concatenate([expand_sorted(k) for k in table.column("keys").to_pylist()])
    values = np.concatenate([expand(v, dtype) for v in table.column("payload").to_pylist()])
    distinct, number = np.unique(keys, return_inverse=True)
    return distinct, number, values, np.cumsum(table.column("n").to_numpy())


def answers(table: pa.Table, ends: np.ndarray, reply: np.ndarray) -> pa.Table:
    """The reply per key, cut back into one answer per message."""
    cut = np.split(reply, ends[:-1])
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "payload": pa.array([squeeze(c) for c in cut], pa.binary())})


def joined_answers(table: pa.Table, dtype) -> np.ndarray:
    """A block's answers in the order of its sorted keys."""
    if not table.num_rows:
        return np.zeros(0, dtype)
    order = np.argsort(table.column("bucket").to_numpy(), kind="stable")
    payloads = table.column("payload").to_pylist()
    return np.concatenate([expand(payloads[i], dtype) for i in order])
