"""Sharding by histogram sort, with Spark's own operators only.

Rows get a hashed sort key, and shards are consecutive key ranges of nearly
equal bytes. The splitters are found by counting, not sampling: every round
aggregates the exact bytes between candidate keys inside the still open
interval of each splitter, and keeps the one sub-interval that holds its
target, until the bytes below the splitter are within the tolerance. Only
then is the data exchanged, once, to its place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import work_path

SHARDS = 16
#: A splitter is done when the bytes below it are this close to its target,
#: as a share of one shard's bytes (or when its interval is a single key).
TOLERANCE = 0.0005
#: Sub-intervals counted per open splitter and round.
PROBES = 64
#: Bytes of one sorted piece of a shard.
PIECE_BYTES = 24 << 20

KEY_MIN, KEY_END = -(1 << 63), 1 << 63


@dataclass
class Open:
    """Interval [low, high) of keys that holds a splitter's target."""
    target: float
    low: int = KEY_MIN
    high: int = KEY_END
    below: int = 0  # bytes of keys under low


def _bin(low: int, high: int, key: Column) -> Column:
    """Sub-interval of a key in [low, high), by integer steps of equal width.
    Keys span 64 bits, so the distance is taken as a decimal."""
    width = -(-(high - low) // PROBES)
    offset = key.cast("decimal(20,0)") - F.lit(str(low)).cast("decimal(20,0)")
    return F.floor(offset / F.lit(str(width)).cast("decimal(20,0)")).cast("int")


def splitters(sized: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """Keys that cut the rows (key, size) into ``shards`` ranges of nearly
    equal bytes; shard i takes keys from splitter i-1 up to below splitter i.
    At most PROBES sums per splitter reach the driver in a round."""
    total = sized.agg(F.sum("size")).first()[0] or 0
    done: dict[int, int] = {}
    todo = {i: Open(total * i / shards) for i in range(1, shards)}
    near = tolerance * total / shards
    while todo:
        intervals = sorted({(o.low, o.high) for o in todo.values()})
        tag, sub = F.lit(None).cast("int"), F.lit(None).cast("int")
        for n, (low, high) in enumerate(intervals):
            inside = (F.col("key") >= F.lit(low)) & (F.col("key") <= F.lit(high - 1))
            tag = F.when(inside, F.lit(n)).otherwise(tag)
            sub = F.when(inside, _bin(low, high, F.col("key"))).otherwise(sub)
        sums: dict[int, dict[int, int]] = {}
        counted = (sized.select(tag.alias("interval"), sub.alias("bin"), "size").where("interval is not null")
                   .groupBy("interval", "bin").agg(F.sum("size").alias("bytes")))
        for r in counted.collect():
            sums.setdefault(r["interval"], {})[r["bin"]] = r["bytes"]
        for i, o in list(todo.items()):
            low, high = o.low, o.high
            width = -(-(high - low) // PROBES)
            mine, below = sums.get(intervals.index((low, high)), {}), o.below
            candidates = [(low, below)]
            for b in range(PROBES):
                edge = min(low + (b + 1) * width, high)
                below += mine.get(b, 0)
                candidates.append((edge, below))
                if edge == high:
                    break
            key, bytes_below = min(candidates, key=lambda c: (abs(c[1] - o.target), c[0]))
            if abs(bytes_below - o.target) <= near or width == 1:
                done[i] = key
                del todo[i]
                continue
            for (a, a_bytes), (z, z_bytes) in zip(candidates, candidates[1:], strict=False):
                if a_bytes <= o.target <= z_bytes:
                    o.low, o.high, o.below = a, z, a_bytes
                    break
    cuts = [done[i] for i in range(1, shards)]
    return [max(cuts[:i + 1]) for i in range(len(cuts))]


def shard_of(key: Column, cuts: list[int]) -> Column:
    out = F.lit(0)
    for i, cut in enumerate(cuts):
        # KEY_END cannot be written as a long: no key reaches it
        out = F.when(key >= F.lit(cut), F.lit(i + 1)).otherwise(out) if cut < KEY_END else out
    return out


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``docs`` with columns ``size`` (UTF-8 bytes of the text, NULL as none,
    plus 1), ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each
    shard). Columns of ``docs`` with these names are replaced.

    Every row is placed, whatever is NULL in it; repeated rows get places of
    their own, because the sort key hashes the row's position in the working
    copy besides its id. Shards differ by at most the tolerance and one row.
    An empty table gives no rows."""
    spark = docs.sparkSession
    plain = docs.drop("size", "shard", "slot")
    path = work_path(spark, "shard-rows")
    numbered = plain.withColumn("__position", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(path)  # positions are fixed from here on
    rows = spark.read.schema(numbered.schema).parquet(path)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    keyed = rows.withColumn("size", size).withColumn("__key", F.xxhash64("doc_id", "__position"))
    sizes = work_path(spark, "shard-sizes")
    keyed.select(F.col("__key").alias("key"), "size").write.option("compression", "zstd").parquet(sizes)
    sized = spark.read.schema("key long, size long").parquet(sizes)
    cuts = splitters(sized, shards, tolerance)
    # each shard's key range in equal steps, so that one task sorts a bounded piece
    total = sized.agg(F.sum("size")).first()[0] or 0
    pieces = max(1, -(-total // (shards * piece_bytes)))
    edges = [KEY_MIN, *cuts, KEY_END]

    def piece_of(key: Column) -> Column:
        out = F.lit(0)
        if pieces > 1:
            for low, high in zip(edges, edges[1:], strict=False):
                if low < high:
                    width = -(-(high - low) // pieces)
                    step = F.floor((key.cast("decimal(20,0)") - F.lit(str(low)).cast("decimal(20,0)"))
                                   / F.lit(str(width)).cast("decimal(20,0)")).cast("int")
                    out = F.when((key >= F.lit(low)) & (key <= F.lit(high - 1)), step).otherwise(out)
        return out

    counts = (sized.groupBy(shard_of(F.col("key"), cuts).alias("shard"), piece_of(F.col("key")).alias("__piece"))
              .agg(F.count("*").alias("n")))
    # rows of the shard's earlier pieces: a running sum over one row per piece
    earlier = Window.partitionBy("shard").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    placed = keyed.withColumn("shard", shard_of(F.col("__key"), cuts)).withColumn("__piece", piece_of(F.col("__key")))
    in_piece = Window.partitionBy("shard", "__piece").orderBy("__key", "__position")
    ranked = placed.withColumn("__rank", F.row_number().over(in_piece)).join(offsets, ["shard", "__piece"])
    slot = (F.col("__before") + F.col("__rank") - 1).cast("long")
    return ranked.withColumn("slot", slot).select(*plain.columns, "size", "shard", "slot")
