"""SimHash near-duplicates by pigeonring filtering.

Fingerprint: 64 bits, bit b set when b is set in more than half of the XXH64
hashes of the text's 3-word shingles. Two documents link when their
fingerprints differ in at most ``MAX_BITS`` bits.

Pigeonring: the 64 bits form a ring of m = MAX_BITS + 1 segments. If two
fingerprints differ in at most MAX_BITS bits, some segment starts a chain
whose cumulative differences after 1, 2, … m segments never exceed
floor(l * MAX_BITS / m). With two bits and three segments that is 0, 1, 2: a
segment agrees exactly and the next differs in at most one bit. So every
distinct fingerprint is indexed, for each start segment, under (segment,
value of that segment, value of the next segment) and probes the values one
bit away from the latter; only fingerprints that meet under such a key are
compared. A key fixes two segments, so a group is bounded by the values of
the remaining bits; a dense group is linked through shared words one bit
away, which is linear in its size and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from .common import materialise, partitions, prepare, texts_of

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Start bit and width of the ring's segments, from the lowest bit.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Place of the start segment in a key, above two segments.
START_BIT = 44
#: Comparisons of one group done pair by pair; larger groups go through words
#: one bit away.
PAIRWISE = 1 << 14


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: lower-cased A-Z, words between ASCII white space,
    shingles of ``width`` words with repeats (fewer words: the whole
    sequence; none: zero)."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[:len(words) - width + 1].tolist()
        shingles = [joined[a:b] for a, b in zip(starts, (ends[width - 1:] - 1).tolist(), strict=True)]
    hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): one row per document; fp is the 64 bits as a signed long.
    NULL text has no words."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t) for t in texts_of(batch)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_signed(fps))], ["doc_id", "fp"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def chain_holds(x: np.ndarray, y: np.ndarray, start: int) -> np.ndarray:
    """Do the cumulative differences of the chain from segment ``start`` stay
    within their share of the budget, over the whole ring?"""
    diff = x ^ y
    total = np.zeros(len(diff), np.int64)
    ok = np.ones(len(diff), bool)
    m = len(SEGMENTS)
    for length in range(1, m + 1):
        bit, width = SEGMENTS[(start + length - 1) % m]
        total += _popcount((diff >> np.uint64(bit)) & np.uint64((1 << width) - 1))
        ok &= total * m <= length * MAX_BITS
    return ok


def ring_keys(fps: DataFrame) -> DataFrame:
    """(key, exact, fp): the index entry and the one-bit probes of every
    distinct fingerprint for every start segment. The key holds the start
    segment's value and (probed) next segment's value, mixed with the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(SEGMENTS)
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(m):
                (b0, w0), (b1, w1) = SEGMENTS[start], SEGMENTS[(start + 1) % m]
                own = (fp >> np.uint64(b0)) & np.uint64((1 << w0) - 1)
                nxt = (fp >> np.uint64(b1)) & np.uint64((1 << w1) - 1)
                base = np.uint64(start) << np.uint64(START_BIT) | own << np.uint64(w1)
                flips = [np.uint64(0), *(np.uint64(1 << i) for i in range(w1))]
                keys = np.concatenate([base | (nxt ^ f) for f in flips])
                exact = np.zeros(len(keys), bool)
                exact[:len(fp)] = True
                yield pa.RecordBatch.from_arrays([pa.array(_signed(keys)), pa.array(exact), pa.array(_signed(np.tile(fp, len(flips))))],
                                                 ["key", "exact", "fp"])

    return fps.mapInArrow(run, "key long, exact boolean, fp long")


def _link_dense(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest in reach of a shared word) of one dense
    group: two fingerprints differ in at most two bits exactly if some word
    differs in at most one bit from both."""
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    words = (fp[:, None] ^ flips[None, :]).ravel()
    owner = np.repeat(fp, len(flips))
    order = np.lexsort((owner, words))
    words, owner = words[order], owner[order]
    first = np.concatenate([[True], words[1:] != words[:-1]])
    lead = owner[first][np.cumsum(first) - 1]
    differs = lead != owner
    pairs = np.unique(np.stack([lead[differs], owner[differs]], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of one task reduced to (smallest member, member) of its
    local components: same connectivity, at most one row per member."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[:len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        nxt = label.copy()
        np.minimum.at(nxt, u, low)
        np.minimum.at(nxt, v, low)
        np.minimum.at(nxt, label[u], low)
        np.minimum.at(nxt, label[v], low)
        nxt = nxt[nxt]
        if np.array_equal(nxt, label):
            break
        label = nxt
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def _match(key: np.ndarray, exact: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the entries of one partition."""
    order = np.lexsort((fp, ~exact, key))
    key, exact, fp = key[order], exact[order], fp[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    n_exact = np.add.reduceat(exact.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    useful = (n_exact > 0) & (size > 1)
    out_a, out_b = [], []
    dense = useful & (n_exact * size > PAIRWISE)
    for at, n in zip(first[dense], size[dense], strict=True):
        a, b = _link_dense(np.unique(fp[at:at + n]))
        out_a.append(a)
        out_b.append(b)
    # pair by pair: each exact entry against the entries after it in its group
    small = useful & ~dense
    starts, sizes, exacts = first[small], size[small], n_exact[small]
    left = np.repeat(starts, exacts) + _ramp(exacts)
    ends = np.repeat(starts + sizes, exacts)
    todo = ends - left - 1
    for lo in range(0, len(left), 1 << 16):
        count = todo[lo:lo + (1 << 16)]
        i = np.repeat(left[lo:lo + (1 << 16)], count)
        j = i + 1 + _ramp(count)
        x, y = fp[i], fp[j]
        keep = np.zeros(len(x), bool)
        for s in range(len(SEGMENTS)):
            here = (key[i] >> np.uint64(START_BIT)) == np.uint64(s)
            if here.any():
                keep[here] = chain_holds(x[here], y[here], s)
        keep &= (x != y) & (_popcount(x ^ y) <= MAX_BITS)
        out_a.append(np.minimum(x[keep], y[keep]))
        out_b.append(np.maximum(x[keep], y[keep]))
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, one after the other."""
    total = int(counts.sum())
    offsets = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(total) - offsets


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints that the pairs at
    most MAX_BITS apart connect."""
    spark = fps.sparkSession
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, flags, fps_ = [], [], []
        for batch in batches:
            keys.append(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64))
            flags.append(batch.column("exact").to_numpy(zero_copy_only=False))
            fps_.append(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
        if not keys:
            return
        a, b = _match(np.concatenate(keys), np.concatenate(flags), np.concatenate(fps_))
        if len(a):
            a, b = _spanning(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(a)), pa.array(_signed(b))], ["a", "b"])

    return ring_keys(fps).repartition(partitions(spark), "key").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, label: str = "ring") -> DataFrame:
    """(node, root): connected components of the links, root the smallest
    node. Alternating star steps: every node's larger neighbours, then its
    smaller ones, are tied to its smallest neighbour, until nothing changes.
    Each round is written to the shared folder, so the plan stays short."""
    step = materialise(edges.select("a", "b").distinct(), f"{label}-edges")
    while True:
        # large star: every larger neighbour of u gets u's smallest neighbour (u itself included)
        both = step.select("a", "b").union(step.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").where("b <> m").select(F.col("m").alias("a"), "b").distinct())
        # small star: u and its smaller neighbours get the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(least, "b").select(F.explode(F.array("a", "b")).alias("b"), "m")
                 .where("b <> m").select(F.col("m").alias("a"), "b").distinct())
        nxt = materialise(small, f"{label}-round")
        # stable once every node has one link and no root is itself linked
        moved = nxt.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        chained = nxt.select("a").distinct().join(nxt.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        step = nxt
        if not moved and not chained:
            return step.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits),
    component_id (smallest doc_id in its component).

    Documents without words (NULL, empty) share fingerprint zero and link like
    any others. Rows with a NULL doc_id take part and may get their
    component's smallest id; it is NULL only if all ids in it are. Repeated
    rows are returned as often as they come. An empty table gives no rows."""
    return (_named(materialise(fingerprints(docs), "ring-fingerprints"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _named(fps: DataFrame) -> DataFrame:
    """The fingerprints with the smallest ``doc_id`` of their component."""
    # exact copies meet here: one row per distinct fingerprint from now on
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(classes.select("fp")))
    placed = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps.join(placed.join(smallest, "root").select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every component: the one with the smallest id (NULL after
    all ids), and of rows that share it the first one as stored. Rows keep all
    their columns; an empty table gives no rows.

    The rows get a fixed position by being written to the shared folder; the
    positions that go are what is joined to them."""
    columns = docs.columns
    names = [f"__k{i}" for i in range(len(columns))]
    placed = materialise(docs.toDF(*names).withColumn("__at", F.monotonically_increasing_id()), "ring-rows")
    doc_id, text = (names[columns.index(c)] for c in ("doc_id", "text"))
    fps = materialise(fingerprints(placed.select(F.struct(F.col(doc_id).isNull().alias("gone"), F.col(doc_id).alias("id"), F.col("__at").alias("at"))
                                                 .alias("doc_id"), F.col(text).alias("text"))), "ring-fingerprints")
    named = _named(fps).where("doc_id.at <> component_id.at")
    return placed.join(named.select(F.col("doc_id.at").alias("__at")), "__at", "left_anti").select(*(F.col(n).alias(c) for n, c in zip(names, columns, strict=True)))
