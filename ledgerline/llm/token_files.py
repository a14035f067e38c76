"""Token ids in frequency-ranked, byte-aligned variable-length files.

Ids are replaced by their rank by corpus frequency (most frequent = 0) and
each rank is written in 1 to 4 bytes. Lengths stand apart, in control bytes
of four 2-bit fields, so decoding is table lookup: one lookup turns a control
byte into four lengths, and the values are gathered with array operations.

File format: a folder with ``ranks`` (rank, id) and ``frames``, both Parquet.
A frame row holds whole documents in ascending doc_id order: shard, frame,
first_token (ids of the shard before it), n_tokens, doc_ids (nullable long
array), lengths (ids per document), control and data bytes. Shards are
ascending ranges of doc_id, frames ascend within a shard.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import materialise, partitions, prepare, texts_of

END_ID = 2
#: Ids after which a frame is closed.
FRAME_IDS = 1 << 18


# ------------------------------------------------------------------ codec
#: Lengths (1..4) of the four values of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of an array of unsigned 32-bit ranks. Unused fields of
    the last control byte are zero."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    fields = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    fields[:len(ranks)] = size - 1
    fields = fields.reshape(-1, 4)
    control = fields[:, 0] | fields[:, 1] << 2 | fields[:, 2] << 4 | fields[:, 3] << 6
    kept = np.arange(4)[None, :] < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` ranks of (control, data)."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    start = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    out = raw[start] if count else np.zeros(0, np.uint32)
    for byte in range(1, 4):
        more = np.flatnonzero(size > byte)
        out[more] |= raw[start[more] + byte] << np.uint32(8 * byte)
    return out


# -------------------------------------------------------------- tokenizer
#: The split of these files, and the same split of lower-cased text of the
#: characters in ``LATIN_TEXT`` for the faster ``re``.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_SPLIT = r"[^\W\d_²³¹¼½¾]+|[0-9²³¹¼½¾]|'(?:s|t|re|ve|m|ll|d)|(?:[^\s\w]|_)+"
LATIN_TEXT = "[\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*"


class WordTokenizer:
    """A ``tokenizers`` file applied to whole texts, word by word.

    The pipeline of these files (NFC, lower case, split into letters, digits
    and other characters, byte-level BPE with word ends) never joins anything
    across ASCII white space, so a text's ids are those of its words in turn.
    Texts of Latin characters are lower-cased first, so spellings of a word
    that differ in case or in a mark at the end share one entry, and
    their pieces go straight to the file's BPE model. In other texts words of
    Latin characters are split by the file's own pattern; every other word, and
    any with a special token's text, goes through the whole library pipeline.
    ``limit`` bounds memory only."""

    def __init__(self, path: str, limit: int = 500_000):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["normalizer"]["normalizers"]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        # the shortcut holds for exactly this pipeline
        self.direct = ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
                       and [s["type"] for s in splits] == ["Split", "ByteLevel"]
                       and splits[0]["invert"] and splits[0]["behavior"] == "Removed"
                       and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"])
        self.worded = steps[1].get("pattern") == {"Regex": r"\s+"} if self.direct else False
        self.split = regex.compile(splits[0]["pattern"]["Regex"]).findall if self.direct else None
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.latin_split = re.compile(LATIN_SPLIT).findall if self.worded and splits[0]["pattern"]["Regex"] == SPLIT else None
        self.latin_text = re.compile(LATIN_TEXT).fullmatch
        self.latin = regex.compile("[\x21-\u012f\u0131-\u024f]+").fullmatch
        self.byte_char = _byte_characters()
        self.words = _Memory(self._word, limit)
        self.pieces = _Memory(self._piece, limit)
        self.latin_words = _Memory(self._latin_word, 2 * limit)

    def _piece(self, piece: str) -> bytes:
        if not (piece.isascii() and piece.isprintable()):
            chars = self.byte_char
            piece = "".join([chars[b] for b in piece.encode("utf-8")])
        return _packed([t.id for t in self.tokenizer.model.tokenize(piece)])

    def _latin_word(self, low: str) -> bytes:
        if low.isalpha():  # letters alone are one piece
            return self._piece(low)
        if low[-1] in ".,;:!?" and low[:-1].isalpha():
            return self.latin_words[low[:-1]] + self.pieces[low[-1]]
        return b"".join([self.pieces[piece] for piece in self.latin_split(low)])

    def _word(self, raw: bytes) -> bytes:
        word = raw.decode("utf-8")
        if not self.direct or not (raw.isascii() and word.isprintable() or self.latin(word)) or (
                "<" in word and any(s in word for s in self.special)):
            return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        low, known = word.lower(), self.pieces
        if low.isalpha():  # letters alone are one piece
            return known[low]
        if low[-1] in ".,;:!?" and low[:-1].isalpha():
            return known[low[:-1]] + known[low[-1]]
        return b"".join([known[piece] for piece in self.split(low)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without special tokens added."""
        if not self.worded:
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if self.latin_split and (text.isascii() and text.isprintable() or self.latin_text(text)) and not (
                "<" in text and any(s in text for s in self.special)):
            return np.frombuffer(b"".join(map(self.latin_words.__getitem__, text.lower().split())), "<u4")
        # bytes.split() parts at ASCII white space only
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.encode("utf-8").split())), "<u4")


class _Memory(dict):
    """Results by key in two generations of at most ``limit`` keys: when the
    young one is full it becomes the old one, and keys used again move up."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE
    files: itself where it is visible in Latin-1, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for b in range(256):
        if b in visible:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


# ------------------------------------------------------------------- jobs
def _width(path: str, end_id: int) -> str:
    """Two bytes per id between the steps where the vocabulary fits, else four."""
    largest = max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1, end_id)
    return "<u2" if largest < 1 << 16 else "<u4"


def _tokenise(docs: DataFrame, path: str, end_id: int, width: str) -> DataFrame:
    """(doc_id, ids) per document and, once per task, (counts): how often
    each id came, as (id, count) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, counts = tokenizer(path), np.zeros(1 << 16, np.int64)
        end = np.asarray([end_id], "<u4")
        names = ["doc_id", "ids", "n", "counts"]
        for batch in batches:
            packed, n = [], []
            for raw in texts_of(batch):
                ids = np.concatenate([tok.encode(raw.decode("utf-8")), end])
                packed.append(ids.astype(width).tobytes())
                n.append(len(ids))
            if packed:
                seen = np.bincount(np.frombuffer(b"".join(packed), width))
                if len(seen) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(seen) - len(counts), np.int64)])
                counts[:len(seen)] += seen
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(packed, pa.binary()),
                                              pa.array(n, pa.int64()), pa.nulls(len(n), pa.binary())], names)
        used = np.flatnonzero(counts)
        if len(used):
            pairs = np.stack([used, counts[used]], 1).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
                                              pa.array([pairs], pa.binary())], names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, n long, counts binary")


def _frequencies(tokens: DataFrame) -> list[tuple[int, int]]:
    """(id, count) of every id used: at most one row per vocabulary entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                pairs = np.frombuffer(raw, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "n"])

    rows = tokens.where(F.col("counts").isNotNull()).select("counts").mapInArrow(run, "id long, n long")
    return [(r["id"], r["n"]) for r in rows.groupBy("id").agg(F.sum("n").alias("n")).collect()]


FRAMES = ("shard int, frame int, first_token long, n_tokens long, doc_ids array<long>, lengths array<long>, "
          "control binary, data binary")


def write(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, frame_ids: int = FRAME_IDS) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizer file ``path`` and
    write the files to ``folder``.

    NULL text is the empty text: just the end id. NULL doc_ids come first and
    repeated rows stay, next to each other. An empty table writes no frames.
    Other columns are ignored."""
    spark = docs.sparkSession
    prepare(spark)
    width = _width(path, end_id)
    tokens = materialise(_tokenise(docs, path, end_id, width), "token-ids")
    ranked = [i for i, _ in sorted(_frequencies(tokens), key=lambda r: (-r[1], r[0]))]
    spark.createDataFrame(list(enumerate(ranked)), "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)  # bounded by the vocabulary
    rank_of[ranked] = np.arange(len(ranked))
    shared = spark.sparkContext.broadcast(rank_of)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, state = TaskContext.get().partitionId(), {"frame": 0, "before": 0}

        def frame(ids: list, lengths: list, ranks: list) -> pa.RecordBatch:
            control, data = encode_ranks(np.concatenate(ranks))
            n = sum(lengths)
            row = [pa.array([shard], pa.int32()), pa.array([state["frame"]], pa.int32()), pa.array([state["before"]], pa.int64()),
                   pa.array([n], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                   pa.array([control], pa.binary()), pa.array([data], pa.binary())]
            state["frame"] += 1
            state["before"] += n
            return pa.RecordBatch.from_arrays(row, ["shard", "frame", "first_token", "n_tokens", "doc_ids", "lengths", "control", "data"])

        ids, lengths, ranks, held = [], [], [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                own = shared.value[np.frombuffer(raw.as_py(), width)]
                ids.append(doc_id)
                lengths.append(len(own))
                ranks.append(own)
                held += len(own)
                if held >= frame_ids:
                    yield frame(ids, lengths, ranks)
                    ids, lengths, ranks, held = [], [], [], 0
        if ids:
            yield frame(ids, lengths, ranks)

    rows = tokens.where(F.col("counts").isNull()).select("doc_id", "ids")
    # rows of one doc_id are told apart by their ids, so a retried task writes the same file
    ordered = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(pack, FRAMES).write.option("compression", "zstd").parquet(f"{folder}/frames")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before
    it), n_tokens, ids (little-endian unsigned 32-bit), ids_crc32."""
    prepare(spark)
    frames = spark.read.schema(FRAMES).parquet(f"{folder}/frames")
    ranked = spark.read.schema("rank long, id long").parquet(f"{folder}/ranks").collect()
    id_of = np.zeros(max(1, len(ranked)), "<u4")  # bounded by the vocabulary
    for r in ranked:
        id_of[r["rank"]] = r["id"]
    # one total per shard: as many rows as the files have shards
    totals = sorted((r["shard"], r["n"]) for r in frames.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    before, sofar = {}, 0
    for shard, n in totals:
        before[shard] = sofar
        sofar += n
    shared = spark.sparkContext.broadcast((id_of, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_by_rank, base = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = ids_by_rank[decode_ranks(row["control"], row["data"], row["n_tokens"])]
                length = np.asarray(row["lengths"], np.int64)
                start = np.cumsum(length) - length
                raw = [ids[a:a + n].tobytes() for a, n in zip(start.tolist(), row["lengths"], strict=True)]
                first = base[row["shard"]] + row["first_token"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(first + start), pa.array(length), pa.array(raw, pa.binary()),
                     pa.array([zlib.crc32(r) for r in raw], pa.int64())], ["doc_id", "start", "n_tokens", "ids", "ids_crc32"])

    return frames.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")
