"""Sharding [native]: k-d tree partitioning by distributed weighted medians.

Every row is a point in the space of some metadata columns, weighted by its bytes. A node of the tree is cut across
its widest dimension (relative to that dimension's width over all rows) at the weighted median, and so on until a
leaf holds the target bytes, a shard's share. The medians of all nodes of a level are found together: histograms of
bytes over a node's range, each round within the bucket that the last one found, first over the coordinate and then,
among rows of one coordinate, over a hash of the row number. Only histograms, a few thousand numbers, reach the
driver, whatever the rows; the tree stays a Column of nested comparisons and no row moves until the slots are given.

The law is `bytes`: sizes are near equal, each cut being off by about one row or one group of copies. Rows of equal
texts are one point, at the least coordinates of the group, and so lie in one shard; a group of more than ``WHOLE`` of a
share, in bytes or rows, is dealt row by row, since sizes could not be near equal otherwise. Coordinates of texts are their ranks among
the distinct values of the column, numbered in a written table.

Edge cases: null texts count one byte and equal empty ones; a null coordinate is the lowest; repeated rows are copies of
a text; an empty table gives an empty result; a row larger than a share makes its shard larger; text values may
share any prefix; columns may have any names.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import safe_names, stored

BUCKETS = 1024
#: Part of a shard's share up to which the rows of one text stay together.
WHOLE = 0.05
#: Range of the hash that orders rows of one coordinate.
TIE_RANGE = float(1 << 52)
#: Rounds of a search; each divides the range by the number of buckets, so no search of doubles needs more.
ROUNDS = 12


@dataclass
class Node:
    """A part of the rows that holds ``shards`` shards from ``first`` on; ``cut`` is (dimension, value, tie)."""

    first: int
    shards: int
    cut: tuple[str, float, float] | None = None
    left: Node | None = None
    right: Node | None = None


def coordinate(df: DataFrame, column: str) -> Column | None:
    """A number or time as a double in its own order; None for a column of texts, which has ``ranks``."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        value = F.col(column).cast("double")
    elif isinstance(kind, (T.DateType, T.TimestampType)):
        value = F.col(column).cast("timestamp").cast("double")
    else:
        return None
    return F.when(value.isNull() | F.isnan(value), F.lit(None)).otherwise(value)


def ranks(values: Column, df: DataFrame) -> DataFrame:
    """(value, rank from 0) of the distinct values, in byte order.

    Sorted over range partitions and written; the rows' numbers in their partitions and the partitions' counts, a
    number per partition, make the ranks.
    """
    ordered = stored(df.select(values.alias("value")).where("value is not null").distinct().orderBy("value")
                     .withColumn("at", F.monotonically_increasing_id()), "shard-ranks")
    blocks = ordered.groupBy(F.shiftright("at", 33).alias("block")).agg(F.count("*").alias("n"))
    before = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return (ordered.withColumn("block", F.shiftright("at", 33)).join(offsets, "block")
            .select("value", (F.col("offset") + inside).cast("double").alias("rank")))


def _leaves(node: Node) -> list[Node]:
    return [node] if node.left is None else _leaves(node.left) + _leaves(node.right)


def _where(node: Node, of) -> Column:
    """``of(leaf)`` of the leaf that a row lies in."""
    if node.left is None:
        return F.lit(of(node))
    dim, value, tie = node.cut
    x = F.col(dim)
    left = (x < value) | ((x == value) & (F.col("tie") < tie))
    return F.when(left, _where(node.left, of)).otherwise(_where(node.right, of))


class _Search:
    """The place in one node where the bytes of the left shards end."""

    def __init__(self, dim: str, low: float, high: float, target: float, tie_range: tuple[float, float]):
        self.dim, self.low, self.high, self.target, self.tie_range = dim, low, high, target, tie_range
        self.value: float | None = None  # set once the coordinate is found; then the tie is searched
        self.below = 0
        self.cut: tuple[str, float, float] | None = None
        if low == high:
            self._found(low)

    def _found(self, value: float) -> None:
        self.value = value
        self.low, self.high = self.tie_range

    def narrow(self, buckets: list[tuple[int, int, float, float]]) -> None:
        """(bucket, bytes, least, greatest) in order, of the rows of the range."""
        for i, (_, size, least, most) in enumerate(buckets):
            if self.below + size >= self.target or i == len(buckets) - 1:
                if least < most:
                    self.low, self.high = least, most
                elif self.value is None:
                    self._found(least)
                else:
                    # the row, or rows of one hash, that the target lies in go to the nearer side
                    left = self.below + size - self.target <= self.target - self.below
                    self.cut = (self.dim, self.value, least + 1.0 if left else least)
                return
            self.below += size


def _split(meta: DataFrame, root: Node, dims: Sequence[str], world: dict) -> None:
    """Cut every leaf that holds more than one shard."""
    todo = [n for n in _leaves(root) if n.shards > 1]
    number = {id(n): i for i, n in enumerate(todo)}
    at = meta.withColumn("node", _where(root, lambda n: number.get(id(n), -1))).where("node >= 0")
    spans = [f(c).alias(f"{a}_{c}") for c in dims for f, a in ((F.min, "lo"), (F.max, "hi"))]
    stats = {r.node: r for r in at.groupBy("node").agg(F.sum("size").alias("bytes"), F.min("tie").alias("lo_tie"),
                                                       F.max("tie").alias("hi_tie"), *spans).collect()}
    searches: dict[int, _Search] = {}
    for i, node in enumerate(todo):
        half = node.shards // 2
        node.left, node.right = Node(node.first, half), Node(node.first + half, node.shards - half)
        node.cut = (dims[0], 0.0, 0.0)  # stays if the node has no rows
        if s := stats.get(i):
            dim = max(dims, key=lambda c: (s[f"hi_{c}"] - s[f"lo_{c}"]) / (world[c] or 1.0))
            searches[i] = _Search(dim, s[f"lo_{dim}"], s[f"hi_{dim}"], s.bytes * half / node.shards, (s.lo_tie, s.hi_tie))
    for _ in range(2 * ROUNDS):
        open_ = {i: s for i, s in searches.items() if s.cut is None}
        if not open_:
            break
        # one histogram of all nodes: x is the searched coordinate of a row, null outside the range
        x, low, width = F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0)
        for i, s in open_.items():
            here = F.col("node") == i
            own = F.col(s.dim) if s.value is None else F.when(F.col(s.dim) == s.value, F.col("tie"))
            x = F.when(here, F.when(own.between(s.low, s.high), own)).otherwise(x)
            low = F.when(here, F.lit(s.low)).otherwise(low)
            width = F.when(here, F.lit(max((s.high - s.low) / BUCKETS, 5e-324))).otherwise(width)
        counted = (at.withColumn("x", x).where("x is not null")
                   .withColumn("b", F.least(F.floor((F.col("x") - low) / width), F.lit(BUCKETS - 1)))
                   .groupBy("node", "b").agg(F.sum("size").alias("bytes"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        buckets = defaultdict(list)
        for r in counted:
            buckets[r.node].append((r.b, r.bytes, r.lo, r.hi))
        for i, s in open_.items():
            s.narrow(sorted(buckets[i]))
    for i, s in searches.items():
        todo[i].cut = s.cut or (s.dim, s.low if s.value is None else s.value, 0.0 if s.value is None else s.low)


def kd_tree(meta: DataFrame, shards: int, dims: Sequence[str]) -> Node:
    """The tree over a table with the columns ``dims``, ``tie`` and ``size``."""
    root = Node(0, shards)
    spans = meta.agg(*(f(c).alias(f"{a}_{c}") for c in dims for f, a in ((F.min, "lo"), (F.max, "hi")))).first()
    world = {c: (spans[f"hi_{c}"] or 0.0) - (spans[f"lo_{c}"] or 0.0) for c in dims}
    while any(n.shards > 1 for n in _leaves(root)):
        _split(meta, root, dims, world)
    return root


def slots(df: DataFrame) -> DataFrame:
    """``slot``, the place of a row in its shard, gapless from 0, in the order of the row numbers ``row``.

    Rows are numbered inside the blocks of a shard that the row numbers' high bits make, each no larger than
    one task's share of the input; the blocks' counts are added up.
    """
    blocks = df.withColumn("block", F.shiftright("row", 33))
    counts = blocks.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(W.partitionBy("shard", "block").orderBy("row"))
    return (blocks.withColumn("place", place).join(offsets, ["shard", "block"])
            .withColumn("slot", F.col("offset") + F.col("place") - 1).drop("block", "place", "offset"))


def _grouped(meta: DataFrame, shards: int, axes: Sequence[str]) -> DataFrame:
    """Adds ``tie``, and gives the rows of one text one place: their least coordinates and a common tie."""
    text = ["hash", "crc", "size"]
    share = meta.agg((F.sum("size") * WHOLE / shards).alias("bytes"), (F.count("*") * WHOLE / shards).alias("rows")).first()
    large = (F.col("n") * F.col("size") > (share["bytes"] or 0)) | (F.col("n") > share["rows"])
    # at most 2 * shards / WHOLE large groups; their rows are spread by row number and meet no group in the join
    hot = meta.groupBy(*text).agg(F.count("*").alias("n")).where((F.col("n") > 1) & large).select(*text, F.lit(True).alias("hot"))
    rows = meta.join(F.broadcast(hot), text, "left").withColumn("apart", F.when(F.col("hot"), F.col("row")).otherwise(F.lit(-1).cast("long")))
    groups = (rows.groupBy(*text, "apart").agg(F.count("*").alias("n"), *(F.min(a).alias(f"least_{a}") for a in axes))
              .where("n > 1"))
    rows = rows.join(groups, [*text, "apart"], "left")
    tie = F.when(F.col("n").isNull(), F.xxhash64("row")).otherwise(F.xxhash64(*text))
    return rows.select(
        *(c for c in meta.columns if c not in axes), *(F.coalesce(f"least_{a}", a).alias(a) for a in axes),
        F.pmod(tie, F.lit(int(TIE_RANGE))).cast("double").alias("tie"))


def kd_shards(docs: DataFrame, shards: int | None = 8, dims: Sequence[str] = ("lang", "source", "n_chars", "doc_id"),
              text_col: str = "text", keep: Sequence[str] = ("doc_id",), target_bytes: int | None = None) -> DataFrame:
    """``keep``, size, text_crc32, law, shard, slot and grown_shard (null under this law) per row.

    Give the number of shards, or None and the bytes that a leaf should hold.
    """
    plain, names = safe_names(docs)
    text = F.coalesce(F.col(names[text_col]), F.lit(""))
    axes = [f"dim_{i}" for i in range(len(dims))]
    row = F.monotonically_increasing_id()
    numbers = {a: coordinate(plain, names[c]) for a, c in zip(axes, dims)}
    # Written once, so that the row numbers stay as they are; the texts are not needed again.
    meta = stored(plain.select(
        *(F.col(names[c]).alias(f"keep_{i}") for i, c in enumerate(keep)),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("hash"),
        *(F.col(names[c]).cast("string").alias(a) if numbers[a] is None else numbers[a].alias(a) for a, c in zip(axes, dims)),
        row.alias("row")), "shard-meta")
    if shards is None:
        shards = max(1, math.ceil((meta.agg(F.sum("size")).first()[0] or 0) / target_bytes))
    for a in axes:
        if numbers[a] is None:
            ranked = ranks(F.col(a), meta).withColumnRenamed("value", a)
            meta = meta.join(ranked, a, "left").drop(a).withColumnRenamed("rank", a)
    meta = stored(_grouped(meta.fillna(-1.0, axes), shards, axes), "shard-points")
    tree = kd_tree(meta, shards, axes)
    placed = slots(meta.withColumn("shard", _where(tree, lambda n: n.first)))
    return placed.select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)), "size",
                         F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
