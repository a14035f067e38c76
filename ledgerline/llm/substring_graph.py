"""Long repeated substrings by de Bruijn compaction.

Edges of the graph are word k-mers; an edge follows another when they are
neighbours in some document. To keep the graph small, only the k-mers that are
the minimum (by hash) of some window of ``WINDOW`` words are edges: every
window contains one, chosen by its words alone, so equal windows contain the
same edge.

1. Edges found in at least two documents are repeated. A window without a
   repeated edge cannot occur in another document.
2. Where a repeated edge has a single successor and that one a single
   predecessor, the path does not branch; such paths are compacted by pointer
   doubling with Spark joins.
3. Each document's runs along a compacted path are spans with source
   coordinates. The hash of a span's words verifies it as a whole: if a
   smaller doc_id has the same span, all its windows repeat there.
4. The windows left (span ends, short passages, spans without a smaller
   holder) are verified one by one by the hash of their words.

Facts about edges, spans and windows come from ``blocks`` lookups: one
message per distinct key and block, however often a passage is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import blocks as B
from .common import materialise, mix64, pair_hash, prepare

WINDOW = 50
EDGE_WORDS = 16
SEED = 5
BASE = np.uint64(0x9FB21C651E98DF25)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

#: Rows a block is sent in the steps: its documents, or facts about it.
FACTS = "block long, bucket int, n int, keys binary, payload binary"


class Block:
    """Words of a block's documents as one stream, and hashes of its ranges."""

    def __init__(self, row: dict):
        self.words = B.words_of(row)
        self.ids = row["doc_ids"]
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.tokens = B.expand(row["tokens"], np.int32)
        self.starts = np.cumsum(self.lengths) - self.lengths
        n = len(self.tokens)
        h = np.fromiter((xxh64_intdigest(w, SEED) for w in self.words), np.uint64, len(self.words))
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, INVERSE)]), dtype=np.uint64)
        forward = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), BASE)]), dtype=np.uint64)[:n]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(h[self.tokens] * forward, dtype=np.uint64)])
        self.doc = np.repeat(np.arange(len(self.ids)), self.lengths)
        end = np.repeat(self.starts + self.lengths, self.lengths)
        named = np.array([i is not None for i in self.ids], bool)
        # a document without an id is neither smaller nor larger than another
        self.valid = (np.arange(n) + WINDOW <= end) & named[self.doc] if n else np.zeros(0, bool)
        self.id_of = np.array([0 if i is None else i for i in self.ids], np.int64)

    def hash(self, start: np.ndarray, length) -> np.ndarray:
        """Hash of the words [start, start + length)."""
        return mix64((self.sums[start + length] - self.sums[start]) * self.power[start])

    def edge_of_windows(self, step: int = 1 << 17) -> np.ndarray:
        """Per window start, the place of its edge (-1: no window starts here)."""
        n = len(self.tokens)
        out = np.full(n, -1, np.int64)
        if n < WINDOW:
            return out
        edges = self.hash(np.arange(n - EDGE_WORDS + 1), EDGE_WORDS)
        view = np.lib.stride_tricks.sliding_window_view(edges, WINDOW - EDGE_WORDS + 1)
        for lo in range(0, len(view), step):
            out[lo:lo + len(view[lo:lo + step])] = lo + np.arange(len(view[lo:lo + step])) + view[lo:lo + step].argmin(axis=1)
        out[~self.valid] = -1
        return out

    def text_digest(self, d: int, removed: np.ndarray | None = None) -> str:
        tokens = self.tokens[self.starts[d]:self.starts[d] + self.lengths[d]]
        if removed is not None:
            tokens = tokens[~removed]
        return hashlib.sha256(b" ".join(map(self.words.__getitem__, tokens.tolist()))).hexdigest()


def _least(keys: np.ndarray, ids: np.ndarray, block: int, buckets: int, most: bool = False) -> Iterator[pa.RecordBatch]:
    """Messages: each distinct key with the smallest id (and the largest)."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    value = np.minimum.reduceat(ids, first)
    if most:
        value = np.stack([value, np.maximum.reduceat(ids, first)], 1)
    yield from B.messages(keys[first], value, block, buckets)


# ------------------------------------------------------- 1. repeated edges
def _ask_edges(packed: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                places = np.unique(b.edge_of_windows())
                places = places[places >= 0]
                yield from _least(b.hash(places, EDGE_WORDS), b.id_of[b.doc[places]], row["block"], buckets, most=True)

    return packed.mapInArrow(run, B.MESSAGE_SCHEMA)


def _answer_edges(table: pa.Table) -> pa.Table:
    """Is the edge in two documents?"""
    distinct, number, values, ends = B.gather(table, np.int64)
    low, high = np.full(len(distinct), np.iinfo(np.int64).max), np.full(len(distinct), np.iinfo(np.int64).min)
    values = values.reshape(-1, 2)
    np.minimum.at(low, number, values[:, 0])
    np.maximum.at(high, number, values[:, 1])
    return B.answers(table, ends, (low < high)[number])


def _answer_least(table: pa.Table) -> pa.Table:
    """Smallest doc_id that has the key."""
    distinct, number, values, ends = B.gather(table, np.int64)
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(low, number, values)
    return B.answers(table, ends, low[number])


SIFTED = (B.BLOCK_SCHEMA + ", edges binary, joined binary, windows binary, "
          "done array<struct<doc_id: long, n_words: long, n_removed: long, kept_sha256: string>>")
DONE = pa.list_(pa.struct([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))


def _sift(packed: pa.Table, answered: pa.Table) -> pa.Table:
    """A block cut down to the documents with a repeated edge; the others are
    done. Adds the places of repeated edges, whether each is followed directly
    by the next, and which windows have a repeated edge."""
    rows = []
    for row in packed.to_pylist():
        b = Block(row)
        edge = b.edge_of_windows()
        places = np.unique(edge)
        places = places[places >= 0]
        keys = b.hash(places, EDGE_WORDS)
        distinct = np.unique(keys)
        repeated = B.joined_answers(answered, np.bool_)[np.searchsorted(distinct, keys)] if len(keys) else np.zeros(0, bool)
        hit = np.zeros(len(b.tokens), bool)
        hit[places[repeated]] = True
        window = (edge >= 0) & hit[np.maximum(edge, 0)]
        live = np.zeros(len(b.ids), bool)
        live[b.doc[places[repeated]]] = True
        done = [(b.ids[d], int(b.lengths[d]), 0, b.text_digest(d)) for d in np.flatnonzero(~live)]
        keep = live[b.doc] if len(b.doc) else np.zeros(0, bool)
        new_place = np.cumsum(keep) - 1
        used, tokens = np.unique(b.tokens[keep], return_inverse=True)
        mine = np.flatnonzero(repeated)
        joined = np.zeros(len(mine), bool)
        joined[:-1] = (np.diff(mine) == 1) & (b.doc[places[mine[1:]]] == b.doc[places[mine[:-1]]])
        rows.append((row["block"], row["part"], [b.ids[d] for d in np.flatnonzero(live)], b.lengths[live].tolist(),
                     B.squeeze(b" ".join(b.words[w] for w in used)), B.squeeze(tokens.astype(np.int32)),
                     B.squeeze(new_place[places[mine]].astype(np.int32)), B.squeeze(joined), B.squeeze(window[keep]),
                     [dict(zip(("doc_id", "n_words", "n_removed", "kept_sha256"), x, strict=True)) for x in done]))
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 5, DONE]
    names = ["block", "part", "doc_ids", "lengths", "vocabulary", "tokens", "edges", "joined", "windows", "done"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 10, kinds, strict=True)], names)


# ----------------------------------------------------- 2. compacted paths
def _links(sifted: DataFrame) -> DataFrame:
    """(a, b): repeated edge b directly after a in some document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                edges = b.hash(B.expand(row["edges"], np.int32).astype(np.int64), EDGE_WORDS).view(np.int64)
                at = np.flatnonzero(B.expand(row["joined"], np.bool_))
                if len(at):
                    pairs = np.unique(np.stack([edges[at], edges[at + 1]], 1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return sifted.mapInArrow(run, "a long, b long")


def compact(links: DataFrame) -> DataFrame:
    """(edge, path, place): edges of nonbranching paths, the path's first edge
    and the edge's number from there. Edges on no such path are left out, and
    so are cycles, which have no first edge."""
    links = materialise(links.where("a <> b").distinct(), "graph-links")
    one_after = links.groupBy("a").agg(F.count("*").alias("n"), F.first("b").alias("b")).where("n = 1").select("a", "b")
    one_before = links.groupBy("b").agg(F.count("*").alias("n"), F.first("a").alias("a")).where("n = 1").select("a", "b")
    chain = one_after.join(one_before, ["a", "b"])
    # every edge of a chain points back ``place`` steps to ``path``; a first edge points to itself
    heads = chain.select("a").join(chain.select(F.col("b").alias("a")), "a", "left_anti")
    state = materialise(chain.select(F.col("b").alias("edge"), F.col("a").alias("path"), F.lit(1).cast("long").alias("place"))
                        .union(heads.select("a", "a", F.lit(0).cast("long"))).withColumn("moved", F.lit(True)), "graph-paths")
    n = state.count()
    for _ in range(n.bit_length() + 1):  # doubling reaches any head within log2(n) rounds
        # only first edges have place 0, so a pointer to place 0 has arrived
        back = state.select(F.col("edge").alias("path"), F.col("path").alias("path2"), F.col("place").alias("place2"))
        state = materialise(state.join(back, "path").select("edge", F.col("path2").alias("path"), (F.col("place") + F.col("place2")).alias("place"),
                                                            (F.col("place2") > 0).alias("moved")), "graph-paths")
        if not state.where("moved").limit(1).count():
            break
    return state.where("not moved").select("edge", "path", "place")  # cycles never arrive


def _edges_of_blocks(sifted: DataFrame) -> DataFrame:
    """(block, edge): the distinct repeated edges of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = B.expand(row["edges"], np.int32).astype(np.int64)
                if len(places):
                    edges = np.unique(Block(row).hash(places, EDGE_WORDS).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(edges), row["block"])), pa.array(edges)], ["block", "edge"])

    return sifted.mapInArrow(run, "block long, edge long")


# ------------------------------------------------------- 3. verified spans
def _spans(b: Block, row: dict, known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs along one path that can hold a window."""
    places = B.expand(row["edges"], np.int32).astype(np.int64)
    joined = B.expand(row["joined"], np.bool_)
    edges = b.hash(places, EDGE_WORDS).view(np.int64)
    path, place = edges.copy(), np.zeros(len(edges), np.int64)
    if known.num_rows and len(edges):
        order = np.argsort(known.column("edge").to_numpy())
        sorted_edges = known.column("edge").to_numpy()[order]
        at = np.minimum(np.searchsorted(sorted_edges, edges), len(sorted_edges) - 1)
        found = sorted_edges[at] == edges
        path[found] = known.column("path").to_numpy()[order][at[found]]
        place[found] = known.column("place").to_numpy()[order][at[found]]
    if not len(edges):
        return places, places
    on = joined[:-1] & (path[1:] == path[:-1]) & (place[1:] == place[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], ~on]))
    last = np.append(first[1:] - 1, len(edges) - 1)
    start, length = places[first], places[last] + EDGE_WORDS - places[first]
    long = length >= WINDOW
    return start[long], length[long]


def _span_keys(b: Block, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return pair_hash(b.hash(start, length), length.astype(np.uint64))


def _fact(block: int, bucket: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([0], pa.int32()),
                                       pa.array([None], pa.binary()), pa.array([payload], pa.binary())],
                                      ["block", "bucket", "n", "keys", "payload"])


def _as_facts(batches: list[pa.RecordBatch]) -> pa.Table:
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("payload", pa.binary())])
    return pa.Table.from_batches([x.select(schema.names).cast(schema) for x in batches], schema)


#: Bucket of the fact a block sends itself.
OWN = -1


def _ask_spans(sifted: pa.Table, known: pa.Table, buckets: int) -> pa.Table:
    out = []
    for row in sifted.to_pylist():
        b = Block(row)
        start, length = _spans(b, row, known)
        out.append(_fact(row["block"], OWN, B.squeeze(np.stack([start, length]))))
        if len(start):
            out += _least(_span_keys(b, start, length), b.id_of[b.doc[start]], row["block"], buckets)
    return _as_facts(out)


def _own(facts: pa.Table, dtype) -> np.ndarray:
    mine = facts.filter(pa.array([x == OWN for x in facts.column("bucket").to_pylist()], pa.bool_()))
    return B.expand(mine.column("payload")[0].as_py(), dtype)


def _replies(facts: pa.Table) -> pa.Table:
    return facts.filter(pa.array([x != OWN for x in facts.column("bucket").to_pylist()], pa.bool_()))


# ----------------------------------------------------- 4. single windows
def _ask_windows(sifted: pa.Table, facts: pa.Table, buckets: int) -> pa.Table:
    """Windows inside a span that a smaller document holds are settled; the
    other windows with a repeated edge are asked one by one."""
    out = []
    for row in sifted.to_pylist():
        b = Block(row)
        start, length = _own(facts, np.int64).reshape(2, -1)
        settled = np.zeros(len(b.tokens) + 1, np.int64)
        if len(start):
            keys = _span_keys(b, start, length)
            least = B.joined_answers(_replies(facts), np.int64)[np.searchsorted(np.unique(keys), keys)]
            gone = least < b.id_of[b.doc[start]]
            np.add.at(settled, start[gone], 1)
            np.add.at(settled, start[gone] + length[gone] - WINDOW + 1, -1)
        repeats = np.cumsum(settled[:-1]) > 0
        out.append(_fact(row["block"], OWN, B.squeeze(repeats)))
        ask = np.flatnonzero(B.expand(row["windows"], np.bool_) & ~repeats)
        out += _least(b.hash(ask, WINDOW), b.id_of[b.doc[ask]], row["block"], buckets)
    return _as_facts(out)


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _remove(sifted: pa.Table, facts: pa.Table) -> pa.Table:
    rows = []
    for row in sifted.to_pylist():
        b = Block(row)
        repeats = _own(facts, np.bool_).copy()
        ask = np.flatnonzero(B.expand(row["windows"], np.bool_) & ~repeats)
        if len(ask):
            keys = b.hash(ask, WINDOW)
            least = B.joined_answers(_replies(facts), np.int64)[np.searchsorted(np.unique(keys), keys)]
            repeats[ask[least < b.id_of[b.doc[ask]]]] = True
        cover = np.zeros(len(b.tokens) + WINDOW + 1, np.int64)
        at = np.flatnonzero(repeats)
        cover[at] += 1
        cover[at + WINDOW] -= 1
        removed = np.cumsum(cover)[:len(b.tokens)] > 0
        for d in range(len(b.ids)):
            own = removed[b.starts[d]:b.starts[d] + b.lengths[d]]
            rows.append((b.ids[d], int(b.lengths[d]), int(own.sum()), b.text_digest(d, own)))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (kept
    words joined by a space). A word goes when it lies in a window of WINDOW
    words that also starts in a document with a smaller doc_id; windows are
    those of the input.

    NULL and empty texts have no words. A document without doc_id is neither
    smaller nor larger than others: it loses nothing and removes nothing. Rows
    that repeat a doc_id are documents of equal id. Other columns are ignored."""
    spark = docs.sparkSession
    packed = B.pack(docs, lower=False, label="substring-blocks")
    buckets = B.bucket_count(packed)
    edges = _ask_edges(packed, buckets).groupBy("bucket").applyInArrow(_answer_edges, B.ANSWER_SCHEMA)
    sifted = materialise(packed.groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(_sift, SIFTED), "substring-sifted")
    slim = sifted.drop("done").where("size(doc_ids) > 0")

    paths = compact(_links(slim))
    known = _edges_of_blocks(slim).join(paths, "edge").select("block", "edge", "path", "place")
    spans = materialise(slim.groupBy("block").cogroup(known.groupBy("block"))
                        .applyInArrow(lambda a, b: _ask_spans(a, b, buckets), FACTS), "substring-spans")

    def told(asked: DataFrame) -> DataFrame:
        """What each block was answered, with the fact it sent itself."""
        answered = asked.where(F.col("bucket") != OWN).groupBy("bucket").applyInArrow(_answer_least, B.ANSWER_SCHEMA)
        return answered.select("block", "bucket", "payload").union(asked.where(F.col("bucket") == OWN).select("block", "bucket", "payload"))

    windows = materialise(slim.groupBy("block").cogroup(told(spans).groupBy("block"))
                          .applyInArrow(lambda a, b: _ask_windows(a, b, buckets), FACTS), "substring-windows")
    rest = slim.groupBy("block").cogroup(told(windows).groupBy("block")).applyInArrow(_remove, RESULT)
    prepare(spark, B.BLOCK_ROWS)
    return sifted.select(F.explode("done").alias("d")).select("d.*").union(rest)
