"""Hard-negative mining over STR-packed R-trees.

The rows' integer vectors are packed by sort-tile-recursive: slabs along the widest coordinate, ranges along the next
within them (Spark's range partitions, ties split by a hash of the id), and in each partition recursively along the
other coordinates down to leaves. A partition is one tree of bounded size; leaves are grouped into nodes of bounded
fan-out. A node's minimum bounding box gives an interval of each coordinate's product with the anchor's, and their
sums an interval of the inner product.

A query asks for the k best rows of one label kind (the anchor's or the others) within a window of scores. It first
searches the tree its anchor lies in, which gives a first k-th score. Roots' boxes, in blocks, tell which other trees
can hold better rows; only those are met, the best first, in a few rounds of growing size. Within a tree a best-first queue opens nodes by their upper bound and prunes
those outside the score windows of all of the anchor's queries, or strictly below their k-th score (at the k-th score,
those of larger ids only). Positives are one query per anchor, negatives one per positive.

Anchors are the stated query set: they meet all rows, in blocks; a block holds the anchors of one tree. No broadcast
grows with the data, and a tree returns at most k rows per query.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component take no part; components are
64-bit integers, and 256 times a component beyond that range is the nearest of them, as is a score; a shorter vector
counts as padded with zeros, an empty one as all zeros; rows that repeat are one row, and rows of the anchor's own id
are neither its positives nor its negatives; ties go to smaller ids; an anchor without positives, or a positive
without negatives, gives no row; an empty table gives an empty result. Extra columns of any name are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import stored

SCALE = 256
N_POSITIVES, N_NEGATIVES = 5, 3
#: A negative's score is within these hundredths of the positive's.
LOW, HIGH, HUNDRED = 50, 95, 100
#: Rows of a tree, rows of a leaf, children of a node, boxes of a block of roots.
TREE_ROWS, LEAF_ROWS, FAN_OUT, BOX_BLOCK = 4096, 128, 8, 1024
#: Trees of the first round after the own one, and the factor from round to round.
ROUND_TREES = 8

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_TREE = "tree long, width int, ids binary, labels binary, anchors binary, vectors binary, leaves binary, low binary, high binary"
_QUERIES = "array<struct<slot:int,key:long,key_score:long,lo:long,hi:long>>"
_FOUND = "array<struct<query:int,score:long,id:long>>"


def integer_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 scale: int = SCALE) -> DataFrame:
    """(id, label, x) of the rows that take part: x is floor(scale * component)."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    plain = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.transform(vector_col, lambda v: v.cast("double")).alias("v"))
    edge = float(1 << 63)
    whole = lambda v: F.when(v * scale >= edge, F.lit(_MOST)).when(v * scale < -edge, F.lit(_LEAST)).otherwise(
        F.floor(v * scale))
    return (plain.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
            .where(~F.exists("v", bad)).select("id", "label", F.transform("v", whole).alias("x")))


# --- packing

def str_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row order and leaf offsets of a sort-tile-recursive packing: slabs along one coordinate after the other."""
    dims = np.argsort(-x.var(0, dtype=float), kind="stable") if x.shape[1] else np.empty(0, int)
    order, ends = [], []

    def tile(rows: np.ndarray, depth: int) -> None:
        leaves = -(-len(rows) // LEAF_ROWS)
        left = len(dims) - depth
        if leaves <= 1 or left <= 0:
            for at in range(0, len(rows), LEAF_ROWS):
                order.append(rows[at:at + LEAF_ROWS])
                ends.append(len(order[-1]))
            return
        slabs = max(2, math.ceil(leaves ** (1 / left)))
        size = -(-leaves // slabs) * LEAF_ROWS
        rows = rows[np.argsort(x[rows, dims[depth]], kind="stable")]
        for at in range(0, len(rows), size):
            tile(rows[at:at + size], depth + 1)

    tile(np.arange(len(x)), 0)
    return np.concatenate(order), np.concatenate([[0], np.cumsum(ends)]).astype(np.int64)


def _vectors(cell: pa.ListArray, width: int) -> np.ndarray:
    sizes = np.diff(cell.offsets.to_numpy())
    flat = cell.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(cell), width), np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = flat
    return out


def _tree_row(number: int, table: pa.Table) -> dict:
    cells = [pa.concat_arrays(c.chunks) for c in table.columns]
    width = int(np.diff(cells[3].offsets.to_numpy()).max(initial=0))
    x = _vectors(cells[3], width)
    order, leaves = str_order(x)
    ids, labels, anchors = (c.to_numpy(zero_copy_only=False)[order] for c in cells[:3])
    return {"tree": number, "width": width, "ids": ids.tobytes(), "labels": labels.tobytes(),
            "anchors": anchors.astype(bool).tobytes(), "vectors": x[order].tobytes(), "leaves": leaves.tobytes(),
            "low": x.min(0).tobytes(), "high": x.max(0).tobytes()}


def pack_trees(rows: DataFrame) -> DataFrame:
    """One row per tree of the rows (id, label, x, anchor)."""
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    spread = (rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.var_pop(F.col("v").cast("double")).alias("s"))
              .orderBy(F.desc("s"), "at").limit(2).collect())
    dims = [r["at"] for r in spread]
    n_trees = max(1, -(-facts["n"] // TREE_ROWS))
    at = lambda k: F.coalesce(F.get("x", F.lit(dims[k])), F.lit(0)) if len(dims) > k else F.lit(0)
    slabs = math.ceil(math.sqrt(n_trees))
    placed = rows.withColumn("first", at(0)).withColumn("second", at(1)).withColumn("tie", F.xxhash64("id"))
    cuts = placed.agg(F.percentile_approx("first", [i / slabs for i in range(1, slabs)] or [0.5]).alias("cuts")).first()["cuts"]
    cuts = F.array(*(F.lit(int(c)) for c in sorted(set(cuts or [])))) if slabs > 1 else F.array().cast("array<long>")
    placed = placed.withColumn("slab", F.size(F.filter(cuts, lambda c: c <= F.col("first"))))
    dealt = (placed.repartitionByRange(n_trees, "slab", "second", "tie").sortWithinPartitions("slab", "second", "tie")
             .select("id", "label", "anchor", "x", F.spark_partition_id().alias("p")))

    def run(batches):
        held, size, made, p = [], 0, 0, 0
        schema = pa.schema([("tree", pa.int64()), ("width", pa.int32()), *((c, pa.binary()) for c in (
            "ids", "labels", "anchors", "vectors", "leaves", "low", "high"))])

        def emit(rows):
            return pa.RecordBatch.from_pylist([_tree_row((p << 24) + made, pa.Table.from_batches(rows))], schema)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                p = batch.column(4)[0].as_py()
                part = batch.slice(at, TREE_ROWS - size)
                held.append(part)
                at, size = at + part.num_rows, size + part.num_rows
                if size == TREE_ROWS:
                    yield emit(held)
                    held, size, made = [], 0, made + 1
        if held:
            yield emit(held)

    return stored(dealt.mapInArrow(run, _TREE), "trees")


# --- search

def _numbers(raw: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(raw, kind)


def _matrix(raw: bytes, width: int, rows: int) -> np.ndarray:
    return _numbers(raw).reshape(rows, width)


def _exact(a: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """All cut to the common width, in a type in which inner products with ``a`` are exact.

    That is floats if no sum can leave 53 bits, else Python integers.
    """
    width = min(m.shape[1] for m in (a, *others))
    size = lambda m: np.abs(m[:, :width].astype(float)).max(initial=0)
    kind = float if size(a) * max(map(size, others)) * max(1, width) < 1 << 53 else object
    return [m[:, :width].astype(kind) for m in (a, *others)]


def _intervals(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most inner products of each row of a with the vectors in each box."""
    up, down = np.where(a > 0, a, a * 0), np.where(a < 0, a, a * 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


class Tree:
    def __init__(self, row: dict):
        self.ids, self.labels = _numbers(row["ids"]), _numbers(row["labels"])
        self.x = _matrix(row["vectors"], row["width"], len(self.ids))
        leaves = _numbers(row["leaves"])
        # nodes level by level, leaves first: [from, to) are rows of a leaf, else nodes
        self.start, self.end = leaves[:-1].tolist(), leaves[1:].tolist()
        low, high = (f.reduceat(self.x, leaves[:-1], axis=0) if self.x.shape[1] else self.x[leaves[:-1]]
                     for f in (np.minimum, np.maximum))
        least = np.minimum.reduceat(self.ids, leaves[:-1])
        lows, highs, leasts, base = [low], [high], [least], 0
        self.n_leaves = len(low)
        while len(low) > 1:
            cuts = np.arange(0, len(low), FAN_OUT)
            self.start += (base + cuts).tolist()
            self.end += (base + np.minimum(cuts + FAN_OUT, len(low))).tolist()
            base += len(low)
            low, high = (f.reduceat(s, cuts, axis=0) if s.shape[1] else s[cuts] for f, s in ((np.minimum, low), (np.maximum, high)))
            least = np.minimum.reduceat(least, cuts)
            lows.append(low), highs.append(high), leasts.append(least)
        self.low, self.high, self.least = np.concatenate(lows), np.concatenate(highs), np.concatenate(leasts).tolist()


class _Best:
    """The k best (score, -id) of a query in a window. ``bound``: the k-th one so far, found here or elsewhere."""

    def __init__(self, lo: int, hi: int, k: int, bound: tuple | None):
        self.lo, self.hi, self.k, self.rows, self.bound = lo, hi, k, [], bound
        self.floor = lo if bound is None else max(lo, bound[0])

    def add(self, score, row_id) -> None:
        key = (score, -row_id)
        if self.lo <= score <= self.hi and (self.bound is None or key > self.bound):
            self.rows = sorted([*self.rows, key], reverse=True)[:self.k]
            if len(self.rows) == self.k and (self.bound is None or self.rows[-1] > self.bound):
                self.bound = self.rows[-1]
                self.floor = max(self.lo, self.bound[0])

    def wants(self, least, most, least_id) -> bool:
        """Whether a box can hold a better row: within the window, and at the k-th score one of a smaller id."""
        return self.floor <= most and least <= self.hi and not (
            self.bound is not None and most == self.bound[0] and least_id > -self.bound[1])


def search(tree: Tree, anchor, anchor_id: int, label: int, same: bool, wanted: list[_Best], x, least: list, most: list) -> None:
    """Best-first search of one tree for all queries of an anchor. least, most: the nodes' intervals."""
    root = len(least) - 1
    queue = [(-most[root], root)]
    floor, ceiling = min(w.floor for w in wanted), max(w.hi for w in wanted)
    start, end, leaves, least_ids = tree.start, tree.end, tree.n_leaves, tree.least
    while queue:
        top, node = heapq.heappop(queue)
        top = -top
        if top < floor:
            break
        if not any(w.wants(least[node], top, least_ids[node]) for w in wanted):
            continue
        a, b = start[node], end[node]
        if node >= leaves:
            for child in range(a, b):
                if most[child] >= floor and least[child] <= ceiling:
                    heapq.heappush(queue, (-most[child], child))
            continue
        scores = x[a:b] @ anchor
        at = np.flatnonzero(scores >= floor)
        if not len(at):
            continue
        at = at[(scores[at] <= ceiling) & ((tree.labels[a:b][at] == label) == same) & (tree.ids[a:b][at] != anchor_id)]
        if not len(at):
            continue
        for w in wanted:
            own = at
            if len(at) > w.k:
                own = at[(scores[at] >= w.floor) & (scores[at] <= w.hi)]
                own = sorted(own.tolist(), key=lambda i: (-scores[i], tree.ids[a + i]))[:w.k]
            for i in own:
                w.add(int(scores[i]), int(tree.ids[a + i]))
        floor = min(w.floor for w in wanted)


def search_block(row: dict, same: bool, k: int) -> list[_Best]:
    """All queries of a block of anchors against one tree, given what was found so far."""
    tree = Tree(row)
    ids, labels = row["anchor_ids"], row["anchor_labels"]
    anchors, x, low, high = _exact(_matrix(row["anchor_vectors"], row["anchor_width"], len(ids)), tree.x, tree.low, tree.high)
    least, most = (side.tolist() for side in _intervals(anchors, low, high))
    best = [_Best(q["lo"], q["hi"], k, b) for q, b in zip(row["queries"], _bounds(row, k))]
    own: dict[int, list[_Best]] = {}
    for q, b in zip(row["queries"], best):
        own.setdefault(q["slot"], []).append(b)
    for slot, wanted in own.items():
        search(tree, anchors[slot], ids[slot], labels[slot], same, wanted, x, least[slot], most[slot])
    return best


def _bounds(row: dict, k: int) -> list[tuple | None]:
    """Of each query the k-th (score, -id) found so far."""
    found: list[list] = [[] for _ in row["queries"]]
    for f in row["best"] or []:
        found[f["query"]].append((f["score"], -f["id"]))
    return [min(f) if len(f) == k else None for f in found]


def _clip(v: int) -> int:
    return max(_LEAST, min(_MOST, v))


def _found(best: list[_Best]) -> list[dict]:
    return [{"query": i, "score": _clip(s), "id": -n} for i, b in enumerate(best) for s, n in b.rows]


_BLOCK = "block long, anchor_width int, anchor_ids array<long>, anchor_labels array<long>, anchor_vectors binary"
_PA_FOUND = pa.list_(pa.struct([("query", pa.int32()), ("score", pa.int64()), ("id", pa.int64())]))


def anchor_blocks(trees: DataFrame) -> DataFrame:
    """The anchors of each tree that has any."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = _numbers(row["anchors"], bool)
                if at.any():
                    x = _matrix(row["vectors"], row["width"], len(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["tree"]], pa.int64()), pa.array([row["width"]], pa.int32()),
                         pa.array([_numbers(row["ids"])[at]], pa.list_(pa.int64())),
                         pa.array([_numbers(row["labels"])[at]], pa.list_(pa.int64())), pa.array([x[at].tobytes()], pa.binary())],
                        ["block", "anchor_width", "anchor_ids", "anchor_labels", "anchor_vectors"])

    return stored(trees.select("tree", "width", "ids", "labels", "anchors", "vectors").mapInArrow(run, _BLOCK), "anchors")


def _asked(blocks: DataFrame, best: DataFrame | None) -> DataFrame:
    """The blocks with what their queries have found so far, at most k rows for each."""
    if best is None:
        return blocks.withColumn("best", F.lit(None).cast(_FOUND))
    own = best.groupBy("block").agg(F.collect_list(F.struct("query", "score", "id")).alias("best"))
    return blocks.join(own, "block", "left")


def _visits(asked: DataFrame, trees: DataFrame, n_trees: int, k: int) -> DataFrame:
    """(block, tree, turn): the other trees whose root box can hold a row that a query still wants, the best first."""
    chunks = max(1, -(-n_trees // BOX_BLOCK))
    boxes = trees.groupBy(F.pmod(F.xxhash64("tree"), F.lit(chunks)).alias("chunk")).agg(
        F.collect_list(F.struct("tree", "width", "low", "high")).alias("boxes"))
    spread = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                anchors = _matrix(row["anchor_vectors"], row["anchor_width"], len(row["anchor_ids"]))
                slots = np.array([q["slot"] for q in row["queries"]], int)
                floors = [max(q["lo"], b[0]) if b else q["lo"] for q, b in zip(row["queries"], _bounds(row, k))]
                kinds: dict[int, list] = {}
                for box in row["boxes"]:
                    kinds.setdefault(box["width"], []).append(box)
                hit = []
                for width, own in kinds.items():
                    low, high = (np.concatenate([_matrix(b[c], width, 1) for b in own]) for c in ("low", "high"))
                    least, most = _intervals(*_exact(anchors, low, high))
                    wants = ((most[slots] >= np.array(floors, object)[:, None])
                             & (least[slots] <= np.array([q["hi"] for q in row["queries"]], object)[:, None]))
                    hit += [(b["tree"], float(m)) for b, w, m in zip(own, wants.any(0), most.max(0)) if w and b["tree"] != row["block"]]
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]] * len(hit), pa.int64()), pa.array([t for t, _ in hit], pa.int64()),
                                                  pa.array([m for _, m in hit], pa.float64())], ["block", "tree", "most"])

    found = spread.drop("anchor_labels").join(boxes, "chunk").mapInArrow(run, "block long, tree long, most double")
    turn = F.row_number().over(W.partitionBy("block").orderBy(F.desc("most"), "tree"))
    return stored(found.select("block", "tree", turn.alias("turn")), "visits")


def _searched(asked: DataFrame, pairs: DataFrame, trees: DataFrame, best: DataFrame | None, same: bool, k: int) -> DataFrame:
    """(block, query, score, id, rank): the k best of every query after the given pairs of blocks and trees."""
    held = asked.join(pairs, "block").join(trees.drop("anchors", "low", "high"), "tree")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = [{"query": n, "score": _clip(s), "id": -r} for n, b in enumerate(search_block(row, same, k)) for s, r in b.rows]
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), pa.array([found], _PA_FOUND)], ["block", "found"])

    every = held.mapInArrow(run, f"block long, found {_FOUND}").select("block", F.explode("found").alias("f")).select("block", "f.*")
    if best is not None:
        every = every.unionAll(best.drop("rank"))
    order = W.partitionBy("block", "query").orderBy(F.desc("score"), "id")
    return stored(every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")


def answer(blocks: DataFrame, trees: DataFrame, n_trees: int, same: bool, k: int) -> DataFrame:
    """(block, query, score, id, rank): the k best of every query.

    First in the anchors' own tree, then in the other trees by the upper bounds of their boxes, in rounds of growing
    size: a round returns about as many rows as the one before, since its k-th scores come from so many more rows.
    """
    best = _searched(_asked(blocks, None), blocks.select("block", F.col("block").alias("tree")), trees, None, same, k)
    visits = _visits(_asked(blocks, best), trees, n_trees, k)
    done, width = 0, ROUND_TREES
    while done < n_trees - 1:
        turn = visits.where(F.col("turn").between(done + 1, done + width)).select("block", "tree")
        best = _searched(_asked(blocks, best), turn, trees, best, same, k)
        done, width = done + width, width * ROUND_TREES
    return best


def mine_negatives(rows: DataFrame, anchor: Column, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score over the rows (id, label, x).

    ``anchor`` tells which rows are anchors; ``low`` and ``high`` are hundredths of the positive's score.
    """
    trees = pack_trees(stored(rows.withColumn("anchor", F.coalesce(anchor, F.lit(False))).distinct(), "rows"))
    n_trees = trees.count()
    blocks = anchor_blocks(trees)
    every = F.transform("anchor_ids", lambda _, i: F.struct(
        i.cast("int").alias("slot"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("key_score"),
        F.lit(_LEAST).alias("lo"), F.lit(_MOST).alias("hi")))
    positives = answer(blocks.withColumn("queries", every.cast(_QUERIES)), trees, n_trees, True, n_positives)
    share = lambda part, f: f(F.col("score").cast("decimal(20,0)") * part / HUNDRED).cast("decimal(20,0)").cast("long")
    windows = positives.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(
        F.col("query").alias("slot"), F.col("id").alias("key"), F.col("score").alias("key_score"),
        share(low, F.ceil).alias("lo"), share(high, F.floor).alias("hi")))).alias("queries"))
    asked = stored(blocks.join(windows, "block"), "windows")
    found = answer(asked, trees, n_trees, False, n_negatives)
    own = asked.select("block", "anchor_ids", F.posexplode("queries").alias("query", "q"))
    return found.join(own, ["block", "query"]).select(
        F.get("anchor_ids", F.col("q.slot")).alias("anchor_id"), F.col("q.key").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("q.key_score").alias("positive_score"), F.col("score").alias("negative_score"))
