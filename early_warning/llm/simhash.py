"""SimHash near-dedup: tiled exact comparison of all fingerprints.

A document's fingerprint has a bit set if more than half of the XXH64 hashes of its word shingles have it set.
Equal fingerprints are one point from then on, so groups of copies cost nothing. Two points link at a bit
distance of at most ``radius``. The points are laid out in tiles by their population counts: the set bits of each
of four 16-bit sections. Such counts of two linked points differ by at most the radius in all, so a tile meets
only the tiles whose counts lie that near; every other pair of tiles is skipped. A pair of tiles is compared
whole by numpy exclusive-or and bit counts and returns a spanning forest of its links, never the links themselves.
Alternating large and small stars join the forests to components.

A tile holds about ``TILE_POINTS`` points whatever the size of a cell, a pair of tiles is one row, and all tables
between the steps are written to the shared folder. The work on n points that are not copies grows as n squared,
with a small factor (a cell meets about one in twenty of the others); the method is exact, not sub-quadratic.

Edge cases: null and empty texts have no words and fingerprint zero, which links like any other; fewer words than
a shingle are one shingle; repeated rows share a fingerprint and a component; a component whose ids are all null
has a null id; null ids are skipped otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import each, safe_names, scan_texts, stored

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
SECTIONS, SECTION_BITS = 4, 16
TILE_POINTS = 512
#: Shingles whose bits are counted at a time.
COUNT_ROWS = 1 << 14

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingle_hashes(text: bytes | None, size: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every shingle of a text's words, repeats included."""
    words = text.translate(_LOWER).split() if text else []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-size])]
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1:])]


def fingerprint(text: bytes | None, size: int = SHINGLE_WORDS) -> int:
    """The majority bits of the shingle hashes, as a signed 64-bit integer."""
    hashes = np.array(shingle_hashes(text, size), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), COUNT_ROWS):
        part = hashes[at:at + COUNT_ROWS]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                 size: int = SHINGLE_WORDS) -> DataFrame:
    """``keep`` and ``fp``."""
    kept = [f"k{i}" for i in range(len(keep))]
    plain = docs.select(*(F.col(c).alias(k) for k, c in zip(kept, keep)), F.col(text_col).alias("t__"))
    found = scan_texts(plain, kept, ["t__"], lambda: each(lambda text: (fingerprint(text, size),)), [("fp", "long")])
    return found.select(*(F.col(k).alias(c) for k, c in zip(kept, keep)), "fp")


def _counts(fp: Column) -> list[Column]:
    """Set bits of each section."""
    mask = (1 << SECTION_BITS) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, i * SECTION_BITS).bitwiseAND(F.lit(mask))) for i in range(SECTIONS)]


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of section counts that linked points can have, one of each opposite two, the zero step too."""
    near = product(range(-radius, radius + 1), repeat=SECTIONS)
    return [d for d in near if sum(map(abs, d)) <= radius and d >= (0,) * SECTIONS]


def tiles(points: DataFrame) -> DataFrame:
    """(counts, cell, part, fps): the points of each cell of equal section counts in parts of bounded size."""
    base = SECTION_BITS + 1
    celled = points.select("fp", F.array(*_counts(F.col("fp"))).alias("counts")).withColumn(
        "cell", F.aggregate("counts", F.lit(0), lambda x, c: x * base + c))
    # At most base ** SECTIONS = 83521 rows, whatever the input.
    parts = celled.groupBy("cell").agg(F.ceil(F.count("*") / TILE_POINTS).alias("n_parts"))
    return (celled.join(F.broadcast(parts), "cell")
            .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("n_parts")))
            .groupBy("cell", "part").agg(F.first("counts").alias("counts"), F.collect_list("fp").alias("fps")))


def tile_pairs(made: DataFrame, radius: int) -> DataFrame:
    """Every two tiles whose population counts differ by no more than the radius, once: (same, left, right)."""
    base = SECTION_BITS + 1
    steps = F.array(*(F.array(*map(F.lit, d)) for d in _steps(radius)))
    left = made.select("part", "fps", "cell", F.explode(F.transform(
        steps, lambda d: F.zip_with(F.col("counts"), d, lambda c, x: c + x))).alias("to"))
    left = left.where(F.forall("to", lambda c: c.between(0, SECTION_BITS))).select(
        F.aggregate("to", F.lit(0), lambda x, c: x * base + c).alias("cell"), F.col("cell").alias("from"),
        F.col("part").alias("left_part"), F.col("fps").alias("left"))
    pairs = left.join(made.select("cell", "part", F.col("fps").alias("right")), "cell")
    own = F.col("from") == F.col("cell")
    return pairs.where(~own | (F.col("left_part") <= F.col("part"))).select(
        (own & (F.col("left_part") == F.col("part"))).alias("same"), "left", "right")


def forest(left: np.ndarray, right: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles, or within one: (larger, smaller) point."""
    near = np.bitwise_count(left.view(np.uint64)[:, None] ^ right.view(np.uint64)[None, :]) <= radius
    if same:
        near = np.triu(near, 1)
    rows, cols = np.nonzero(near)
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out = []
    for a, b in zip(left[rows].tolist(), right[cols].tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            out.append((max(a, b), min(a, b)))
    return out


def links(pairs: DataFrame, radius: int) -> DataFrame:
    """(u, v), u > v: the forests of all pairs of tiles."""
    def run(batches):
        for batch in batches:
            same, left, right = batch.columns
            for i in range(batch.num_rows):
                found = forest(left[i].values.to_numpy(), right[i].values.to_numpy(), same[i].as_py(), radius)
                if found:
                    u, v = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def _star(edges: DataFrame, key: str, other: str) -> DataFrame:
    """Edges with the least neighbour, or the point itself if less, of their ``key``."""
    least = edges.groupBy(key).agg(F.min(other).alias("m"))
    return edges.join(least, key).withColumn("m", F.least("m", key))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the ends of the edges (u, v), u > v; the root is the least point of a component."""
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = digest(edges)
    while seen[0]:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large, "u", "v")
        small = small.select("v", "m").unionAll(small.select("u", "m")).toDF("u", "v").where("u > v").distinct()
        edges = stored(small, "stars")
        now = digest(edges)
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def groups(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root) for every distinct fingerprint ``fp`` of the points."""
    points = points.select("fp").distinct()
    made = stored(tiles(points), "tiles")
    edges = stored(links(tile_pairs(made, radius), radius).distinct(), "links")
    roots = components(edges)
    return points.join(roots, points.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """id, ``fp`` and ``component_id``, the least id of the component, per row."""
    marked = stored(fingerprints(docs, text_col, [id_col], size), "fingerprints")
    points = stored(marked.groupBy("fp").agg(F.min(id_col).alias("first_id")), "points")
    rooted = points.join(groups(points, radius), "fp")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Written, so that both sides of the join are plain exchanges and the rows of a hot fingerprint can be split.
    by_fp = stored(rooted.join(ids, "root").select("fp", "component_id"), "components")
    return marked.join(by_fp, "fp").select(id_col, "fp", "component_id")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One whole row of each component: that of the least id, nulls last, the earliest among equal ids."""
    plain, names = safe_names(docs)
    kept = list(names.values())
    # Written once, so that the row numbers stay as they are.
    marked = stored(fingerprints(plain, names[text_col], kept, size)
                    .withColumn("row__", F.monotonically_increasing_id()), "marked")
    order = F.struct(F.col(names[id_col]).isNull().alias("null"), F.col(names[id_col]).alias("id"), F.col("row__").alias("row"))
    points = stored(marked.groupBy("fp").agg(F.min(order).alias("first")), "points")
    rooted = points.join(groups(points, radius), "fp")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row__"))
    return marked.join(firsts, "row__", "left_semi").select(*kept).toDF(*docs.columns)
