"""Language-model scoring by deleted interpolation.

Maximum-likelihood estimates of the bigram, the unigram and the uniform
distribution are mixed with weights that depend on how often the context was
seen (one set per power of two of its count). The training documents are
split: weights are learned by expectation-maximisation on the counts of a
tenth held out from the others' estimates ("deleted"); the final model then
counts all training documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import blocks as B
from .common import materialise, pair_hash, prepare

#: Remainder of crc32(doc_id) modulo 10: not learned from; learned from, and
#: held out for the weights. The others give the estimates for the weights.
TEST, TUNE = 0, 1
END_HASH = np.uint64(0x5BD1E995A53C9E17)
SEED = 11
#: Context counts fall into buckets 0, 1, 2-3, 4-7, …; the last is open.
CONTEXT_BUCKETS = 24
MAX_ROUNDS, SETTLED = 25, 1e-3
ADD = 0.1


def _part(doc_id: int | None) -> int:
    return min(B.part_of_id(doc_id), 2)


def _keys(row: dict) -> tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: the token stream (end token first and after each
    document), hash per token number, pairs as numbers, distinct keys sorted,
    where each word and pair is among them, and occurrences per key."""
    words = B.words_of(row)
    v = len(words)
    hashes = np.empty(v + 1, np.uint64)
    hashes[:v] = np.fromiter((xxh64_intdigest(w, SEED) for w in words), np.uint64, v)
    hashes[v] = END_HASH
    tokens = B.expand(row["tokens"], np.int32)
    lengths = np.asarray(row["lengths"], np.int64)
    stream = np.empty(len(tokens) + len(lengths) + 1, np.int64)
    stream[0] = v
    body = stream[1:]
    ends = np.cumsum(lengths + 1) - 1
    is_word = np.ones(len(body), bool)
    is_word[ends] = False
    body[is_word] = tokens
    body[ends] = v
    pair, of_pair, n_pair = np.unique(stream[:-1] * (v + 1) + stream[1:], return_inverse=True, return_counts=True)
    n_word = np.bincount(body, minlength=v + 1)
    one = np.uint64(1)
    key = np.concatenate([hashes & ~one, pair_hash(hashes[pair // (v + 1)], hashes[pair % (v + 1)]) | one])
    order = np.argsort(key, kind="stable")
    place = np.empty(len(key), np.int64)
    place[order] = np.arange(len(key))
    return stream, of_pair, v, key[order], place, np.concatenate([n_word, n_pair])[order]


def _ask(packed: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, _, keys, _, n = _keys(row)
                counts = np.zeros((len(keys), 2), "<u4")  # (other training documents, tuning documents)
                if row["part"] != TEST:
                    counts[:, 1 if row["part"] == TUNE else 0] = n
                yield from B.messages(keys, counts, row["block"], buckets)

    return packed.mapInArrow(run, B.MESSAGE_SCHEMA)


def _count(table: pa.Table) -> pa.Table:
    """One bucket: counts of every key over all blocks, answered to each, and
    (block -1) the number of distinct training words among them."""
    distinct, number, counts, ends = B.gather(table, "<u4")
    counts = counts.reshape(-1, 2)
    total = np.stack([np.bincount(number, counts[:, i], minlength=len(distinct)) for i in (0, 1)], 1).astype("<u8")
    reply = B.answers(table, ends, total[number])
    known = int(((total.sum(1) > 0) & (distinct & np.uint64(1) == 0)).sum())
    more = pa.table({"block": pa.array([-1], pa.int64()), "bucket": table.column("bucket").slice(0, 1).combine_chunks(),
                     "payload": pa.array([known.to_bytes(8, "little")], pa.binary())})
    return pa.concat_tables([reply, more])


RESOLVED = "part int, doc_ids array<long>, lengths array<int>, word_counts binary, pair_counts binary"


def _resolve(packed: pa.Table, answered: pa.Table) -> pa.Table:
    """A block's tokens replaced by their counts: per token (from the end
    token in front on) its own count and its pair's count, each for other
    and tuning documents."""
    names = ["part", "doc_ids", "lengths", "word_counts", "pair_counts"]
    out = []
    for row in packed.to_pylist():
        stream, of_pair, v, _, place, _ = _keys(row)
        counts = B.joined_answers(answered, "<u8").reshape(-1, 2)
        out.append((row["part"], row["doc_ids"], row["lengths"], B.squeeze(counts[place[stream]].T),
                    B.squeeze(counts[place[v + 1 + of_pair]].T)))
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count)), the last open."""
    safe = np.maximum(count, 1).astype(np.float64)
    return np.where(count > 0, np.minimum(1 + np.floor(np.log2(safe)).astype(np.int64), CONTEXT_BUCKETS - 1), 0)


def components(word: np.ndarray, pair: np.ndarray, n: int, v: int) -> tuple[np.ndarray, np.ndarray]:
    """(context bucket, probabilities of the three models) of every token
    after the first. ``word``, ``pair``: counts along the stream."""
    context, own = word[:-1].astype(np.float64), word[1:].astype(np.float64)
    # pairs of an end token and the first word of the next document are real
    # pairs; the context of a pair is counted as often as the pair's first token
    p = np.empty((len(own), 3))
    p[:, 0] = np.divide(pair, context, out=np.zeros(len(own)), where=context > 0)
    p[:, 1] = own / n if n else 0.0
    p[:, 2] = 1.0 / (v + 1)
    return context_bucket(word[:-1]), p


def _tuning_table(resolved: DataFrame, n_other: int, v: int) -> DataFrame:
    """(bucket, p2, p1, p0, weight): the held-out tokens' model probabilities,
    equal ones of a block merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                word = B.expand(row["word_counts"], "<u8").reshape(2, -1)[0]
                pair = B.expand(row["pair_counts"], "<u8").reshape(2, -1)[0]
                facts, weight = np.unique(np.stack([word[:-1], word[1:], pair], 1), axis=0, return_counts=True)
                bucket, p = components(np.concatenate([facts[:, 0], facts[-1:, 0]]), facts[:, 2], n_other, v)
                p[:, 1] = facts[:, 1] / n_other if n_other else 0.0
                yield pa.RecordBatch.from_arrays([pa.array(bucket), *(pa.array(p[:, i]) for i in range(3)), pa.array(weight)],
                                                 ["bucket", "p2", "p1", "p0", "weight"])

    return resolved.where(F.col("part") == TUNE).mapInArrow(run, "bucket long, p2 double, p1 double, p0 double, weight long")


def learn_weights(tuning: DataFrame, rounds: int = MAX_ROUNDS) -> np.ndarray:
    """Mixture weights per context bucket by expectation-maximisation. Each
    round is one aggregation; a row per bucket reaches the driver. A bucket
    without held-out tokens takes the weights of the nearest one below (or
    above) that has some; with none at all the three models weigh the same."""
    weights = np.full((CONTEXT_BUCKETS, 3), 1 / 3)
    seen: set[int] = set()
    for _ in range(rounds):
        table = F.array(*(F.array(*(F.lit(float(x)) for x in row)) for row in weights))
        lam = F.element_at(table, (F.col("bucket") + 1).cast("int"))
        parts = [lam[i] * F.col(c) for i, c in enumerate(("p2", "p1", "p0"))]
        mix = parts[0] + parts[1] + parts[2]
        sums = tuning.groupBy("bucket").agg(*(F.sum(F.col("weight") * p / mix).alias(f"s{i}") for i, p in enumerate(parts))).collect()
        moved = 0.0
        for r in sums:
            s = np.array([r["s0"], r["s1"], r["s2"]])
            new = s / s.sum()
            moved = max(moved, float(np.abs(new - weights[r["bucket"]]).max()))
            weights[r["bucket"]] = new
            seen.add(r["bucket"])
        if moved < SETTLED:
            break
    for b in range(CONTEXT_BUCKETS):
        if seen and b not in seen:
            weights[b] = weights[min(seen, key=lambda x: (abs(x - b), x > b))]
    return weights


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    NULL and empty texts are one end token. A NULL doc_id counts as the empty
    id. Repeated rows are counted and scored as often as they come. Without
    training documents every token is unknown. Other columns are ignored."""
    spark = docs.sparkSession
    packed = B.pack(docs, lower=True, label="lm-blocks", part=_part)
    buckets = B.bucket_count(packed)
    replies = materialise(_ask(packed, buckets).groupBy("bucket").applyInArrow(_count, B.ANSWER_SCHEMA), "lm-answers")
    n_types = replies.where("block = -1").select("payload").collect()  # one row per bucket
    v = sum(int.from_bytes(r["payload"], "little") for r in n_types)
    sizes = {r["part"]: r["n"] for r in packed.select("part", F.explode("lengths").alias("n")).groupBy("part")
             .agg(F.sum(F.col("n").cast("long") + 1).alias("n")).collect()}
    n = sum(x for part, x in sizes.items() if part != TEST)
    resolved = materialise(packed.groupBy("block").cogroup(replies.where("block >= 0").groupBy("block"))
                           .applyInArrow(_resolve, RESOLVED), "lm-counts")
    tuning = materialise(_tuning_table(resolved, n - sizes.get(TUNE, 0), v), "lm-tuning")
    weights = learn_weights(tuning)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                word = B.expand(row["word_counts"], "<u8").reshape(2, -1).sum(0)
                pair = B.expand(row["pair_counts"], "<u8").reshape(2, -1).sum(0)
                bucket, p = components(word, pair, n, v)
                base = np.log10((word[1:] + ADD) / (n + ADD * (v + 1)))
                model = np.log10((p * weights[bucket]).sum(1))
                length = np.asarray(row["lengths"], np.int64) + 1
                start = np.cumsum(length) - length
                count = len(length)
                sums = [np.add.reduceat(x, start) if count else np.zeros(0) for x in (base, model, (word[1:] > 0).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"] == TEST] * count, pa.bool_()), pa.array(length),
                     pa.array(sums[2]), pa.array([n] * count, pa.int64()), pa.array(sums[0]), pa.array(sums[1])],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    prepare(spark, B.BLOCK_ROWS)
    return resolved.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                    "base_score double, score double")
