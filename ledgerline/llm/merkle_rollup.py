"""Merkle manifest by nested-struct rollup, with Spark's own operators only.

Rows get their rank inside their tree. The rank's last digits (base: the
arity) become columns, its rest is a block of at most ``arity ** DIGITS``
nodes. Inside a block the digit columns are grouped away one after the other,
each time nesting the children's structs in their parent's, so a block ends as
one row: a struct that holds its whole subtree. The blocks' tops are the nodes
of the next round, until every tree is one block; then the trees' tops form
the tree of trees by the same steps.

On the way down a block's row meets the proof above it, one row per block;
inside the block a transform over the nested struct extends that proof to
every leaf, and an explode emits the leaves. All groupings of a round share
one exchange on (tree, block), and no group holds more than one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

ARITY = 2
#: Rank digits a round groups away: a block has at most ARITY ** DIGITS nodes.
DIGITS = 9

PATH = "array<struct<before:string,after:string>>"


def field(column: Column) -> Column:
    """``-`` if NULL, else UTF-8 byte count, colon, value."""
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8."""
    return F.sha2(text, 256)


def ranked(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` (tree, order, leaf, …) with ``rank``, gapless from 0 inside
    each tree by ``order`` (NULL first), then leaf, and ``size``, the tree's
    number of rows.

    One range exchange sorts all trees together, so a tree of any share of
    the rows spreads over tasks; a position, fixed in the working copy, lets
    it split even equal rows. Each range counts its rows per tree, and a
    running sum over ranges (one row per range and tree) makes the ranks."""
    fixed = materialise(rows.withColumn("__at", F.monotonically_increasing_id()), label)
    keys = [F.col("tree"), F.col("order"), F.col("leaf"), F.col("__at")]
    lined = fixed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__at")
    # the id's upper part is the range, its lower 33 bits count the range's rows
    placed = lined.withColumn("__id", F.monotonically_increasing_id())
    placed = placed.withColumn("__range", F.shiftright("__id", 33)).withColumn("__row", F.col("__id") - F.shiftleft("__range", 33)).drop("__id")
    placed = materialise(placed, label)
    counts = placed.groupBy("tree", "__range").agg(F.count("*").alias("n"), F.min("__row").alias("__first"))
    in_tree = Window.partitionBy("tree")
    earlier = in_tree.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("tree", "__range", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
                            F.sum("n").over(in_tree).alias("size"))
    out = placed.join(offsets, ["tree", "__range"])
    return out.withColumn("rank", F.col("__row") + F.col("__shift")).drop("__range", "__row", "__shift", "order")


def roll(nodes: DataFrame, payload: list[str], arity: int, digits: int) -> DataFrame:
    """``nodes`` (tree, size, rank, hash, payload …) grouped into one row per
    block: tree, size, block and ``node``, the nested struct (hash, kids)."""
    inner = [F.expr(f"cast(rank div {arity ** i} % {arity} as int)").alias(f"d{i}") for i in range(digits)]
    rows = nodes.select("tree", "size", F.expr(f"rank div {arity ** digits}").alias("block"), *inner,
                        F.struct(F.col("hash"), *payload).alias("node"))
    rows = rows.repartition("tree", "block")  # every grouping below keeps to this exchange
    for i in range(digits):
        rest = [f"d{j}" for j in range(i + 1, digits)]
        rows = rows.groupBy("tree", "size", "block", *rest).agg(
            F.transform(F.sort_array(F.collect_list(F.struct(F.col(f"d{i}"), F.col("node")))), lambda kid: kid["node"]).alias("kids"))
        joined = digest(F.array_join(F.transform("kids", lambda kid: kid["hash"]), ""))
        alone = F.col("size") <= F.lit(arity ** i)  # the tree is down to this node: it is not hashed again
        rows = rows.select("tree", "size", "block", *rest,
                           F.struct(F.when(alone, F.col("kids")[0]["hash"]).otherwise(joined).alias("hash"), F.col("kids")).alias("node"))
    return rows


def _leaves(node: Column, path: Column, place: Column, size: Column, level: int, payload: list[str], arity: int) -> Column:
    """Leaves under ``node`` with their siblings, level by level upwards."""
    if level == 0:
        return F.array(F.struct(node["hash"].alias("hash"), place.alias("rank"), *(node[p].alias(p) for p in payload), path.alias("path")))

    def siblings(first: Column, count: Column) -> Column:
        return F.array_join(F.transform(F.slice(node["kids"], first, count), lambda k: k["hash"]), "")

    def below(kid: Column, i: Column) -> Column:
        step = F.array(F.struct(siblings(F.lit(1), i).alias("before"), siblings(i + 2, F.lit(arity)).alias("after")))
        above = F.concat(F.when(size <= F.lit(arity ** (level - 1)), F.array().cast(PATH)).otherwise(step), path)
        return F.struct(kid.alias("node"), above.alias("path"), (place * F.lit(arity) + i).alias("place"))

    return F.flatten(F.transform(F.transform(node["kids"], below),
                                 lambda k: _leaves(k["node"], k["path"], k["place"], size, level - 1, payload, arity)))


def unroll(blocks: DataFrame, above: DataFrame, payload: list[str], arity: int, digits: int) -> DataFrame:
    """Leaves of ``blocks`` (tree, size, block, node): tree, rank, hash, the
    payload and ``path``. ``above`` (tree, block, path, …) has one row per
    block; its other columns go to every leaf."""
    rest = [c for c in above.columns if c not in ("tree", "block", "path")]
    met = blocks.join(above, ["tree", "block"])
    leaves = _leaves(F.col("node"), F.col("path"), F.col("block"), F.col("size"), digits, payload, arity)
    return met.select("tree", *rest, F.explode(leaves).alias("leaf")).select("tree", *rest, "leaf.*")


def climb(nodes: DataFrame, payload: list[str], label: str, arity: int, digits: int) -> list[DataFrame]:
    """Blocks of every round, the last with one block per tree."""
    rounds = []
    while True:
        blocks = materialise(roll(nodes, payload if not rounds else [], arity, digits), label)
        rounds.append(blocks)
        if not blocks.where(F.col("block") > 0).take(1):  # every tree is one block
            return rounds
        width = arity ** digits
        nodes = blocks.select("tree", F.expr(f"(size + {width - 1}) div {width}").alias("size"), F.col("block").alias("rank"), F.col("node.hash").alias("hash"))


def descend(rounds: list[DataFrame], above: DataFrame, payload: list[str], arity: int, digits: int) -> DataFrame:
    """Leaves of the first round's blocks, with the proof up to ``above``
    (tree, path, …) and its other columns."""
    rest = [c for c in above.columns if c not in ("tree", "path")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in rounds[:0:-1]:
        above = unroll(blocks, above, [], arity, digits).select("tree", F.col("rank").alias("block"), "path", *rest)
    return unroll(rounds[0], above, payload, arity, digits)


def fold(start: Column, path: Column) -> Column:
    """Root recomputed from a leaf and the siblings on its path."""
    return F.aggregate(path, start, lambda own, level: digest(F.concat(level["before"], own, level["after"])))


def manifest(docs: DataFrame, arity: int = ARITY, digits: int = DIGITS) -> DataFrame:
    """One row per document: doc_id, ``leaf``, ``subroot`` of its language,
    ``root``, ``proof_sha256`` of the siblings from leaf to root,
    ``folded_root`` recomputed from the (for some documents tampered) leaf and
    those siblings, and ``verified``, whether that is the root.

    Leaves cover doc_id, source, lang, n_chars and text, each ``-`` where
    NULL. Rows of a NULL lang are the first tree. Inside a tree NULL ids come
    first, and rows of equal id stand by their leaf; repeated rows are leaves
    of their own. Tampering adds 1 to ``n_chars`` where 7 divides the crc32 of
    the id (NULL: of the empty text). A tree of one leaf is that leaf. An
    empty table gives no rows. Other columns of ``docs`` are ignored."""
    chosen = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 0
    before, after = [field(F.col(c)) for c in ("doc_id", "source", "lang")], field(F.col("text"))
    tampered = F.when(chosen & F.col("n_chars").isNotNull(), digest(F.concat(*before, field(F.col("n_chars") + 1), after)))
    leaves = docs.select(
        F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang"))).alias("tree"),
        F.col("doc_id").alias("order"), F.col("doc_id"), digest(F.concat(*before, field(F.col("n_chars")), after)).alias("leaf"),
        tampered.alias("tampered"))
    payload = ["doc_id", "tampered"]
    rounds = climb(ranked(leaves, "merkle-leaves").withColumnRenamed("leaf", "hash"), payload, "merkle-blocks", arity, digits)

    tops = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("order"), F.col("tree").alias("name"), F.col("node.hash").alias("leaf"))
    upper = climb(ranked(tops, "merkle-tops").withColumnRenamed("leaf", "hash"), ["name"], "merkle-upper", arity, digits)
    root = upper[-1].select("tree", F.col("node.hash").alias("root"), F.array().cast(PATH).alias("path"))
    trees = descend(upper, root, ["name"], arity, digits).select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), "root", "path")

    proven = descend(rounds, trees, payload, arity, digits)
    siblings = F.array_join(F.transform("path", lambda level: F.concat(level["before"], level["after"])), "")
    folded = fold(F.coalesce("tampered", "hash"), F.col("path"))
    out = proven.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", digest(siblings).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
