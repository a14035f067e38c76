"""Benchmark decontamination: BM25 inverted index of the test items, queried
by every training passage with block-max WAND.

Items are indexed by length class: words between two powers of two. For each
class a document is cut into passages of twice the class's upper bound, half
overlapping, so a passage holds any item of the class whole and an item is
looked for in spans that depend on its own length alone, never on the other
items. Every passage is a query; all items whose BM25 score reaches the
threshold are retrieved (a fixed share of the score the item gives itself, so
long and short items are treated alike). A retrieved item counts as a leak
when the passage also covers its question and its answer.

An index of a fixed number of text bytes is broadcast. A larger benchmark is
indexed by Spark in blocks of that size, with document frequencies and lengths
of the whole benchmark, and written to the shared folder; the documents are
still scanned once, and every task reads the blocks one after the other for
some megabytes of documents at a time.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialise, prepare, texts_of

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach.
THRESHOLD = 0.6
#: Five-word shingles of the question, and words of the answer, that the
#: passage must contain.
SHINGLE_WORDS = 5
MIN_QUESTION, MIN_ANSWER = 0.6, 0.6
#: Shorter items cannot be told from chance by shares: their full word
#: sequence must be there.
MIN_ITEM_WORDS = 8
#: Item text in one block of the index; up to one block is broadcast.
BLOCK_BYTES = 1 << 20
#: Document text held while the blocks of a larger index pass by.
STEP_BYTES = 8 << 20
#: Items per block of the posting lists (blocks are aligned across lists).
ITEM_BLOCK = 4
#: Passages bounded together in one step, and words and sums of item blocks
#: in all of them.
STEP_PASSAGES = 2048
STEP_CELLS, STEP_SUMS = 1 << 18, 1 << 22

_TO_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """Lower-cased words: runs of characters other than ASCII punctuation,
    controls and white space."""
    return raw.decode("utf-8").lower().encode("utf-8").translate(_TO_SPACE).split()


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """(question, answer) words: the answer is the last sentence or line, or
    the last quarter where that would be more than half of the item."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if terms_of(p.encode("utf-8"))]
    words = terms_of(text.encode("utf-8"))
    tail = len(terms_of(parts[-1].encode("utf-8"))) if parts else 0
    if not 0 < tail <= len(words) // 2:
        tail = max(1, len(words) // 4)
    return words[:len(words) - tail], words[len(words) - tail:]


def shingles(words: list[bytes], width: int = SHINGLE_WORDS) -> set[bytes]:
    if len(words) <= width:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)}


class ItemIndex:
    """Inverted index over one block of items with block-max posting lists."""

    def __init__(self, items: list[tuple[int, str]], n_items: int, mean_words: float, frequency: dict[bytes, int],
                 threshold: float = THRESHOLD):
        self.threshold = threshold
        self.ids: list[int] = []
        self.question: list[list[bytes]] = []
        self.answer: list[set[bytes]] = []
        entries: dict[bytes, list[tuple[int, float]]] = {}
        longest = MIN_ITEM_WORDS
        short: list[tuple[int, list[bytes]]] = []
        for item_id, text in items:
            words = terms_of(text.encode("utf-8"))
            if len(words) < MIN_ITEM_WORDS:
                if words:
                    short.append((item_id, words))
                continue
            longest = max(longest, len(words))
            slot = len(self.ids)
            self.ids.append(item_id)
            question, answer = split_item(text)
            self.question.append(question)
            self.answer.append(set(answer))
            weights = {}
            for w in set(words):
                df, tf = frequency[w], words.count(w)
                idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
                weights[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            own = sum(weights.values())
            for w, x in weights.items():
                entries.setdefault(w, []).append((slot, x / own))
        # items too short to be told from chance by shares: found by their full word sequence, after the others
        self.short: dict[bytes, list[tuple[int, list[bytes]]]] = {}
        for item_id, words in short:
            self.short.setdefault(words[0], []).append((len(self.ids), words))
            self.ids.append(item_id)
        #: twice the upper bound of the longest item's length class
        self.window = 2 << longest.bit_length()
        self.term = {w: i for i, w in enumerate(entries)}
        self.docs = [np.array([d for d, _ in e]) for e in entries.values()]
        self.weights = [[x for _, x in e] for e in entries.values()]
        self.lists = [[d for d, _ in e] for e in entries.values()]
        self.list_max = np.array([max(x for _, x in e) for e in entries.values()])
        # block maxima per list, and all of them flat: term -> blocks and maxima
        self.block_max: list[dict[int, float]] = []
        for e in entries.values():
            best: dict[int, float] = {}
            for d, x in e:
                best[d // ITEM_BLOCK] = max(best.get(d // ITEM_BLOCK, 0.0), x)
            self.block_max.append(best)
        self.n_blocks = -(-len(self.ids) // ITEM_BLOCK)
        sizes = np.array([len(m) for m in self.block_max], np.int64)
        self.flat_from = np.cumsum(sizes) - sizes
        self.flat_size = sizes
        self.flat_block = np.array([b for m in self.block_max for b in m], np.int64)
        self.flat_max = np.array([x for m in self.block_max for x in m.values()])

    def hopeful(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which passages ids[start:end] have a block of items whose maxima
        over the passage's distinct terms add up to the threshold."""
        column = np.arange(self.window)
        out = np.zeros(len(starts), bool)
        if not len(self.list_max):
            return out
        # with repeats and the lists' maxima: an upper bound that needs no sorting
        sums = np.concatenate([[0.0], np.cumsum(np.where(ids >= 0, self.list_max[ids], 0.0))])
        open_ = np.flatnonzero(sums[ends] - sums[starts] >= self.threshold - 1e-6)
        padded = np.concatenate([ids, np.full(self.window, -1, ids.dtype)])
        step = max(1, min(STEP_PASSAGES, STEP_CELLS // self.window, STEP_SUMS // self.n_blocks))
        for lo in range(0, len(open_), step):
            here = open_[lo:lo + step]
            s, e = starts[here, None], ends[here, None]
            terms = padded[s + column]
            terms[s + column >= e] = -1
            terms.sort(axis=1)
            use = terms >= 0
            use[:, 1:] &= terms[:, 1:] != terms[:, :-1]
            passage, at = np.nonzero(use)
            term = terms[passage, at]
            size = self.flat_size[term]
            total = int(size.sum())
            if not total:
                continue
            entry = np.arange(total) - np.repeat(np.cumsum(size) - size - self.flat_from[term], size)
            slot = np.repeat(passage * self.n_blocks, size) + self.flat_block[entry]
            bound = np.bincount(slot, weights=self.flat_max[entry], minlength=len(s) * self.n_blocks)
            out[here] = bound.reshape(len(s), -1).max(axis=1) >= self.threshold - 1e-9
        return out

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: every item whose score over these distinct terms
        reaches the threshold."""
        bound = self.threshold - 1e-9
        # cursors: [current item, term, position]; items are visited in order
        cursors = sorted([self.lists[t][0], t, 0] for t in terms)
        found = []
        while cursors:
            # pivot: first item that the lists' maxima can lift to the threshold
            total, p = 0.0, -1
            for p, cursor in enumerate(cursors):
                total += self.list_max[cursor[1]]
                if total >= bound:
                    break
            if total < bound:
                break
            pivot = cursors[p][0]
            while p + 1 < len(cursors) and cursors[p + 1][0] == pivot:
                p += 1
            block = pivot // ITEM_BLOCK
            if sum(self.block_max[c[1]].get(block, 0.0) for c in cursors[:p + 1]) < bound:
                # none of these lists can lift an item of this block; other lists join at the next cursor
                target = (block + 1) * ITEM_BLOCK
                if p + 1 < len(cursors):
                    target = min(target, cursors[p + 1][0])
                target = max(target, pivot + 1)
            elif cursors[0][0] == pivot:
                score = sum(self.weights[c[1]][c[2]] for c in cursors[:p + 1])
                if score >= bound:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for cursor in cursors[:p + 1]:
                if cursor[0] < target:
                    t = cursor[1]
                    at = cursor[2] + int(np.searchsorted(self.docs[t][cursor[2]:], target))
                    cursor[2] = at
                    cursor[0] = self.lists[t][at] if at < len(self.lists[t]) else -1
            cursors = sorted(c for c in cursors if c[0] >= 0)
        return found

    def leaks(self, texts: list[bytes]) -> list[dict[int, tuple[int, float, float, float]]]:
        return self.leaks_in([terms_of(raw) for raw in texts])

    def leaks_in(self, words: list[list[bytes]]) -> list[dict[int, tuple[int, float, float, float]]]:
        """Per text (its words): item slot -> (passages, best score, question share, answer share)."""
        found: list[dict] = [{} for _ in words]
        if not self.ids:
            return found
        spans, owner, at = [], [], 0
        stride = self.window // 2
        for i, own in enumerate(words):
            starts = np.arange(0, max(1, len(own) - self.window + stride), stride) if own else np.zeros(0, np.int64)
            spans.append(np.stack([at + starts, at + np.minimum(starts + self.window, len(own))], 1))
            owner += [(i, at)] * len(starts)
            at += len(own)
            if self.short:
                for k, first in enumerate(own):
                    for slot, sequence in self.short.get(first, ()):
                        if own[k:k + len(sequence)] == sequence:
                            found[i][slot] = (found[i].get(slot, (0,))[0] + 1, 1.0, 1.0, 1.0)
        ids = np.fromiter(map(self.term.get, chain.from_iterable(words), repeat(-1)), np.int64, at)
        bounds = np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)
        for w in np.flatnonzero(self.hopeful(ids, bounds[:, 0], bounds[:, 1])):
            i, base = owner[w]
            a, b = (int(x) for x in bounds[w])
            terms = np.unique(ids[a:b])
            passage, out = words[i][a - base:b - base], found[i]
            grams: dict[int, set[bytes]] = {}
            for slot, score in self.retrieve(terms[terms >= 0].tolist()):
                question, answer = self.question[slot], self.answer[slot]
                width = min(SHINGLE_WORDS, len(question))
                wanted = shingles(question, width)
                if width not in grams:
                    grams[width] = shingles(passage, width)
                q_share = len(wanted & grams[width]) / len(wanted)
                a_share = len(answer.intersection(passage)) / len(answer)
                if q_share >= MIN_QUESTION and a_share >= MIN_ANSWER:
                    n, s, q0, a0 = out.get(slot, (0, 0.0, 0.0, 0.0))
                    out[slot] = (n + 1, max(s, float(score)), max(q0, q_share), max(a0, a_share))
        return found


def length_class(text: str) -> int:
    """Binary digits of an item's number of words; 0 for the shortest items."""
    n = len(terms_of(text.encode("utf-8")))
    return n.bit_length() if n >= MIN_ITEM_WORDS else 0


class Held:
    """Index of one block, broadcast."""

    step_bytes = 0  # every batch by itself

    def __init__(self, shared):
        self.shared = shared

    def __iter__(self) -> Iterator[ItemIndex]:
        return iter(self.shared.value)


class Stored:
    """Index in files of the shared folder, one block in memory at a time."""

    step_bytes = STEP_BYTES

    def __init__(self, uris: list[str]):
        self.uris = sorted(uris)

    def __iter__(self) -> Iterator[ItemIndex]:
        for uri in self.uris:
            system, path = pyarrow.fs.FileSystem.from_uri(uri)
            with system.open_input_file(path) as file:
                for batch in pyarrow.parquet.ParquetFile(file).iter_batches(batch_size=1, columns=["indexes"]):
                    for value in batch.column("indexes"):
                        yield from pickle.loads(value.as_py())


def _by_class(rows: Iterable[tuple], n_items: int, mean_words: float, frequency: dict[bytes, int], threshold: float) -> list[ItemIndex]:
    classes: dict[int, list] = {}
    for r in rows:
        classes.setdefault(length_class(r[1]), []).append(r)
    return [ItemIndex(found, n_items, mean_words, frequency, threshold) for _, found in sorted(classes.items())]


def item_indexes(items: DataFrame, block_bytes: int = BLOCK_BYTES, threshold: float = THRESHOLD) -> Held | Stored:
    """The index, block by block, one per length class in it. NULL and empty
    items are left out. Items are assigned to blocks by a hash, so a block's
    size follows ``block_bytes``; an item repeated is indexed once, its ids
    are (item_id, rows of it)."""
    spark = items.sparkSession
    prepare(spark)
    source = items.where(F.col("text").isNotNull()).groupBy("item_id", "text").agg(F.count("*").alias("times"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, lengths, sizes = [], [], []
            for raw in texts_of(batch):
                split = terms_of(raw)
                found.append([w.decode("utf-8") for w in set(split)])
                lengths.append(len(split))
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), pa.array(lengths, pa.int64()), pa.array(sizes, pa.int64()),
                                              batch.column("times"), batch.column("__hash")], ["words", "n", "bytes", "times", "__hash"])

    cut = (source.withColumn("__hash", F.xxhash64("item_id", "text")).select("text", "times", "__hash")
           .mapInArrow(words, "words array<string>, n long, bytes long, times long, __hash long"))
    total, summed, size = cut.where("n > 0").agg(F.sum("times"), F.sum(F.col("n") * F.col("times")), F.sum("bytes")).first()
    if not total:
        return Held(spark.sparkContext.broadcast([]))
    mean, n_blocks = summed / total, -(-size // block_bytes)
    each = cut.select(F.pmod("__hash", F.lit(n_blocks)).alias("block"), "times", F.explode("words").alias("word"))
    frequency = each.groupBy("word").agg(F.sum("times").alias("df"))
    if n_blocks == 1:
        rows = sorted((((r["item_id"], r["times"]), r["text"]) for r in source.collect()), key=lambda r: (r[0][0] is None, r[0][0], r[1]))
        known = {r["word"].encode("utf-8"): r["df"] for r in frequency.collect()}
        return Held(spark.sparkContext.broadcast(_by_class(rows, total, mean, known, threshold)))

    def build(part: pa.Table, known: pa.Table) -> pa.Table:
        rows = [((r["item_id"], r["times"]), r["text"]) for r in part.to_pylist()]
        df = {w.encode("utf-8"): n for w, n in zip(known["word"].to_pylist(), known["df"].to_pylist(), strict=True)}
        rows.sort(key=lambda r: (r[0][0] is None, r[0][0], r[1]))
        indexes = _by_class(rows, total, mean, df, threshold)
        return pa.table({"indexes": pa.array([pickle.dumps(indexes)], pa.binary())})

    blocks = source.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    by_block = each.select("block", "word").distinct().join(frequency, "word")
    built = blocks.groupBy("block").cogroup(by_block.groupBy("block")).applyInArrow(build, "indexes binary")
    return Stored(materialise(built, "item-index").inputFiles())


def _steps(batches: Iterable[pa.RecordBatch], step_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Batches put together up to some bytes, with the words of their texts."""

    def together() -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
        at = 0
        for batch in pa.Table.from_batches(held).combine_chunks().to_batches() if len(held) > 1 else held:
            yield batch, words[at:at + batch.num_rows]
            at += batch.num_rows

    held, words, size = [], [], 0
    for batch in batches:
        held.append(batch)
        words += [terms_of(raw) for raw in texts_of(batch)]
        size += batch.nbytes
        if size >= step_bytes:
            yield from together()
            held, words, size = [], [], 0
    yield from together()


def leaks(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, n_passages,
    bm25_score (share of the item's own score), question_overlap,
    answer_overlap. NULL and empty documents have no passages; repeated
    documents or items give repeated rows; empty tables give no rows."""
    spark = docs.sparkSession
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("item_id", items.schema["item_id"].dataType),
                           T.StructField("n_passages", T.LongType()), T.StructField("bm25_score", T.DoubleType()),
                           T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())])
    id_type = to_arrow_type(items.schema["item_id"].dataType)
    indexes = item_indexes(items, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _steps(batches, indexes.step_bytes):
            for index in indexes:
                rows = []
                for i, hits in enumerate(index.leaks_in(words)):
                    for slot, hit in sorted(hits.items()):
                        item_id, times = index.ids[slot]
                        rows += [(i, item_id, *hit)] * times
                if rows:
                    at, ids, n, score, q, a = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(at)), pa.array(ids, id_type), pa.array(n, pa.int64()),
                         pa.array(score, pa.float64()), pa.array(q, pa.float64()), pa.array(a, pa.float64())],
                        schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_clean(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns and
    repeated rows stay, NULL texts are clean."""
    spark = docs.sparkSession
    prepare(spark)
    indexes = item_indexes(items, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _steps(batches, indexes.step_bytes):
            clean = np.ones(len(words), bool)
            for index in indexes:
                clean &= [not found for found in index.leaks_in(words)]
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
