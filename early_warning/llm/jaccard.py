"""N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct word shingles as 64-bit hashes. All sets are put in one order of tokens, rare
ones first, by a count sketch of fixed size over all documents; two sets that are similar enough share a token among
the first ``n - ceil(t n) + 1`` of either. These prefixes, with their positions, are the index lists.

Skips between the sets of a list:

* by blocks: a list is cut into blocks by set size and position. Two blocks meet only if sizes and positions in them
  leave room for the overlap that is asked for; the others are skipped as a whole, and so are single pairs inside.
* by answers: the least set of a list and size block is its leader, and the leaders' answers are computed first.
  Most members of a group of near copies are answered by them: what the leader links is one component, and a list of
  one component needs nothing more. The rest of a set's answers is derived from its leader's: by the triangle
  inequality of the Jaccard distance two sets can link only if their distances to the leader differ by no more than
  the threshold's distance. Parity bitmaps, of a bit per token, give a lower bound of the difference of two sets.

What is left is verified against the whole sets. Equal texts are one set from the start. Links are joined to
components by alternating stars. No list is held by one task and no component is expanded into pairs.

Edge cases: null texts and texts without words have an empty set, which links with nothing, not even with its like;
fewer words than a shingle are one shingle; repeated rows are copies; a component whose ids are all null has a null
id, null ids are skipped otherwise; an empty table gives an empty result. Very long texts are read whole. Extra
columns of any name are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import STEP_ROWS, each, scan_texts, stored
from .simhash import components

SHINGLE_WORDS = 5
#: The least similarity as a fraction.
TIMES, OF = 80, 100
#: Counters of the sketch that orders the tokens, and rows it is passed around in.
SKETCH_BITS, SKETCH_ROWS = 20, 64
#: 64-bit words of the smallest parity bitmap; a set's has a power of two times as many, and a bit per token at least.
SIGNATURE_WORDS = 8
#: Pairs of list entries looked at together.
STEP_PAIRS = 1 << 20
#: Sets of a block of a list.
BLOCK_SETS = 512
#: Size blocks: the sizes in one are at most this factor apart; the positions' share of the size in a position block.
SIZE_STEP, POSITION_STEPS = 1.25, 20
#: Bits of the filter of texts to read again, 2 to this power.
NEEDED_BITS = 23

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hash of a word, kept for the next time; emptied when it holds many."""

    MOST = 1 << 19

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= self.MOST:
            self.clear()
        self[word] = x = xxhash.xxh64_intdigest(word)
        return x


def shingle_set(text: bytes | None, words_of: dict, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words_of.__getitem__, words), np.uint64, len(words))
    n, width = max(1, len(h) - size + 1), min(size, len(h))
    x = np.full(n, width, np.uint64)
    for i in range(width):
        x = (x ^ h[i:i + n]) * _ODD
        x ^= x >> np.uint64(29)
    return np.unique(x)


def _buckets(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def prefix_size(n: int, times: int, of: int) -> int:
    return n - -(-times * n // of) + 1


def in_order(x: np.ndarray, counts: np.ndarray, times: int, of: int) -> np.ndarray:
    """The prefix of a set in the order of all tokens: count in the sketch, then hash."""
    size, c = prefix_size(len(x), times, of), counts[_buckets(x)]
    if size < len(x):
        near = np.flatnonzero(c <= np.partition(c, size - 1)[size - 1])
        return x[near[np.argsort(c[near], kind="stable")]][:size]
    return x[np.argsort(c, kind="stable")]


def signature(x: np.ndarray) -> np.ndarray:
    """Parities of the tokens per bit: two sets differ in at least as many tokens as their signatures in bits."""
    bits = SIGNATURE_WORDS * 64
    while bits < len(x):
        bits *= 2
    odd = np.bincount((x & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def folded(bits: np.ndarray) -> np.ndarray:
    """A signature of the smallest size."""
    return np.bitwise_xor.reduce(bits.reshape(-1, SIGNATURE_WORDS), axis=0)


def differing_bits(left: tuple, right: tuple, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Bits in which the signatures of entries u and v differ; the larger of two is folded to the size of the other.

    ``left`` and ``right`` are (words of all signatures, offsets).
    """
    out = np.zeros(len(u), np.int64)
    sizes = [np.diff(off)[at] for (_, off), at in ((left, u), (right, v))]
    for a, b in {*zip(sizes[0].tolist(), sizes[1].tolist())}:
        own, w = np.flatnonzero((sizes[0] == a) & (sizes[1] == b)), min(a, b)
        step = max(1, STEP_PAIRS // max(a, b))
        for at in range(0, len(own), step):
            part = own[at:at + step]
            x, y = (np.bitwise_xor.reduce(words[off[k[part]][:, None] + np.arange(n)].reshape(-1, n // w, w), axis=1)
                    for (words, off), k, n in ((left, u, a), (right, v, b)))
            out[part] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def _flat(bits) -> tuple[np.ndarray, np.ndarray]:
    """A column of lists as one array and offsets."""
    return bits.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(np.diff(bits.offsets.to_numpy()))])


def sketch(docs: DataFrame, size: int) -> np.ndarray:
    """Counts of all documents' tokens by the first bits of their hashes: 2 ** SKETCH_BITS counters, whatever the input."""
    cells, width = 1 << SKETCH_BITS, (1 << SKETCH_BITS) // SKETCH_ROWS

    def run(batches):
        words_of, counts, found, many = _Words(), np.zeros(cells, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                found.append(shingle_set(text.as_py(), words_of, size))
                many += len(found[-1])
                if many >= cells:
                    counts += np.bincount(_buckets(np.concatenate(found)), minlength=cells)
                    found, many = [], 0
        if found:
            counts += np.bincount(_buckets(np.concatenate(found)), minlength=cells)
        if counts.any():
            rows = counts.reshape(SKETCH_ROWS, width)
            yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_ROWS), pa.int32()),
                                              pa.array([r.tobytes() for r in rows], pa.binary())], ["part", "counts"])

    def add(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in parts:
            for cell in batch.column("counts"):
                total += np.frombuffer(cell.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["part", "counts"])

    # One row of parts per task of the scan; the second step has as many tasks as the sketch has rows.
    parts = docs.select("t").mapInArrow(run, "part int, counts binary").groupBy("part").applyInArrow(
        add, "part int, counts binary")
    counts = np.zeros((SKETCH_ROWS, width), np.int64)
    for row in parts.collect():
        counts[row.part] = np.frombuffer(row.counts, np.int64)
    return counts.reshape(-1)


def indexed_sets(docs: DataFrame, size: int, times: int, of: int) -> DataFrame:
    """(id, k1, k2, n, tokens, bits, fold, row) per document.

    Key of the text, set size, prefix, signature, the same at the smallest size, row number.

    Of the copies of a text in one task only the first has a prefix and a signature.
    """
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(sketch(docs, size))

    def make():
        words_of, order, seen = _Words(), counts.value, {}

        def row(k1, k2, text):
            n = seen.get((k1, k2))
            if n is not None:
                return n, [], [], []
            x = shingle_set(text, words_of, size)
            seen[k1, k2] = len(x)
            if not len(x):
                return 0, [], [], []
            bits = signature(x)
            return len(x), in_order(x, order, times, of).view(np.int64).tolist(), bits.tolist(), folded(bits).tolist()

        return each(row)

    found = scan_texts(docs, ["id", "k1", "k2"], ["k1", "k2", "t"], make,
                       [("n", "long"), ("tokens", "array<long>"), ("bits", "array<long>"), ("fold", "array<long>")])
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "sets")


def _room(i: Column, n: Column, j: Column, m: Column, need_n: Column, need_m: Column, times: int, of: int) -> Column:
    """Whether sets that share a token at these positions can overlap enough."""
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return (times + of) * most >= times * (need_n + need_m)


def index_lists(marked: DataFrame, copies: DataFrame) -> DataFrame:
    """(token, row, n, pos, block) of the tokens that two sets or more have in their prefixes."""
    entries = marked.where("n > 0").select("row", "n", F.posexplode("tokens").alias("pos", "token")).select(
        "token", "row", (F.shiftleft("n", 32) + F.col("pos")).alias("at"))
    shared = entries.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1").select("token")
    # At first only what is needed moves; then the few entries that are left are unpacked, and copies' entries go.
    left = entries.join(shared, "token", "left_semi").join(copies.select("row"), "row", "left_semi")
    n = F.shiftright("at", 32)
    return stored(left.select("token", "row", n.alias("n"), (F.col("at") - F.shiftleft(n, 32)).cast("int").alias("pos"),
                              F.floor(F.log(n) / F.log(F.lit(SIZE_STEP))).cast("int").alias("block")), "lists")


def blobs(docs: DataFrame, marked: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """(row, tokens) of the given rows: their whole sets, from the texts read again."""
    spark = docs.sparkSession
    needed = stored(marked.join(rows.distinct(), "row", "left_semi").select("row", "k1", "k2"), "needed")
    place = F.pmod("k1", F.lit(1 << NEEDED_BITS)) + 1
    filled = needed.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    bitmap = np.zeros((1 << NEEDED_BITS) // 8, np.uint8)
    for r in filled.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bitmap[(r.bucket - 1) * len(r.bits):r.bucket * len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    wanted = spark.sparkContext.broadcast(bitmap)

    def run(batches):
        words_of, done, bits = _Words(), set(), np.unpackbits(wanted.value, bitorder="little").astype(bool)
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            hit = np.flatnonzero(bits[k1 % (1 << NEEDED_BITS)])
            hit = [i for i in hit.tolist() if (k1[i], k2[i]) not in done]
            for at in range(0, len(hit), STEP_ROWS):
                part = [i for i in hit[at:at + STEP_ROWS] if (k1[i], k2[i]) not in done]
                done.update((k1[i], k2[i]) for i in part)
                texts = batch.column(2).take(pa.array(part, pa.int64())).cast(pa.binary()).to_pylist()
                made = [shingle_set(t, words_of, size).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[part], pa.int64()), pa.array(k2[part], pa.int64()), pa.array(made, pa.binary())],
                    ["k1", "k2", "tokens"])

    read = docs.select("k1", "k2", "t").mapInArrow(run, "k1 long, k2 long, tokens binary")
    found = read.join(needed, ["k1", "k2"]).groupBy("row").agg(F.first("tokens").alias("tokens"))
    return stored(found, "blobs")


def overlaps(docs: DataFrame, marked: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """(a, b, both) per pair (a, b): the number of shingles that both have, counted on the whole sets."""
    own = blobs(docs, marked, pairs.select(F.col("a").alias("row")).unionAll(pairs.select("b")), size)
    held = (pairs.join(own.select(F.col("row").alias("a"), F.col("tokens").alias("left")), "a")
            .join(own.select(F.col("row").alias("b"), F.col("tokens").alias("right")), "b").select("a", "b", "left", "right"))

    def run(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            both = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64),
                                       assume_unique=True)) for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64())], ["a", "b", "both"])

    return held.mapInArrow(run, "a long, b long, both long")


def _linked(both: Column, n: Column, m: Column, times: int, of: int) -> Column:
    return of * both >= times * (n + m - both)


def with_bits(pairs: DataFrame, marked: DataFrame) -> DataFrame:
    """Pairs (a, b, n, m) with the bits in which their signatures differ as ``differ``."""
    bits = marked.where(F.size("bits") > 0).select("row", "bits")
    held = (pairs.join(bits.toDF("a", "left"), "a").join(bits.toDF("b", "right"), "b").select("a", "b", "n", "m", "left", "right"))

    def run(batches):
        for batch in batches:
            at = np.arange(batch.num_rows)
            differ = differing_bits(_flat(batch.column(4)), _flat(batch.column(5)), at, at)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(differ, pa.int64())], ["a", "b", "n", "m", "differ"])

    return held.mapInArrow(run, "a long, b long, n long, m long, differ long")


def _may_link(times: int, of: int) -> Column:
    """of * both >= times * (n + m - both), with both = (n + m - difference) / 2 and the least difference there can be."""
    return (times + of) * F.col("differ") <= (of - times) * (F.col("n") + F.col("m"))


def leader_answers(docs: DataFrame, marked: DataFrame, lists: DataFrame, size: int, times: int, of: int) -> tuple[DataFrame, DataFrame]:
    """The leader of each list and size block; of each set that may overlap its leader enough its answer.

    Answers are (leader, row, n, m, both, near, far): the shingles that both have, null if the signatures rule the link
    out, and bounds of the distance.
    """
    leaders = lists.groupBy("token", "block").agg(F.min("row").alias("leader"), F.count("*").alias("sets")).where("sets > 1")
    heads = lists.select("token", "block", F.col("row").alias("leader"), F.col("n").alias("m"), F.col("pos").alias("j"))
    heads = stored(heads.join(leaders.drop("sets"), ["token", "block", "leader"]), "leaders")
    pairs = lists.join(heads, ["token", "block"]).where(F.col("row") != F.col("leader")).where(
        _room(F.col("pos"), F.col("n"), F.col("j"), F.col("m"), F.col("n"), F.col("m"), times, of))
    pairs = pairs.select(F.col("leader").alias("a"), F.col("row").alias("b"), "n", "m").distinct()
    pairs = stored(with_bits(pairs, marked), "led")
    found = overlaps(docs, marked, pairs.where(_may_link(times, of)).select("a", "b"), size)
    sizes, exact = F.col("n") + F.col("m"), 1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both"))
    answers = pairs.join(found, ["a", "b"], "left").select(
        F.col("a").alias("leader"), F.col("b").alias("row"), "n", "m", "both",
        F.coalesce(exact, 1 - (sizes - F.col("differ")) / (sizes + F.col("differ"))).alias("near"),
        F.coalesce(exact, F.lit(1.0)).alias("far"))
    return heads, stored(answers, "answers")


def blocks(lists: DataFrame, heads: DataFrame, answers: DataFrame, marked: DataFrame, roots: DataFrame) -> DataFrame:
    """Blocks of the lists that hold more than one component, with what is known of each set."""
    named = lists.join(roots.select(F.col("node").alias("row"), "root"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    mixed = named.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    left = stored(named.join(mixed, "token", "left_semi"), "mixed")
    own = F.col("row") == F.col("leader")
    known = (left.join(heads.select("token", "block", "leader"), ["token", "block"], "left")
             .join(answers.select("leader", "row", "near", "far"), ["leader", "row"], "left")
             .select("token", "block", "row", "n", "pos", "root", F.when(own, 0.0).otherwise(F.coalesce("near", F.lit(0.0))).alias("near"),
                     F.when(own, 0.0).otherwise(F.coalesce("far", F.lit(1.0))).alias("far"),
                     F.floor(F.col("pos") * POSITION_STEPS / F.col("n")).cast("int").alias("at")))
    known = stored(known, "known")
    # A list with more sets than a block can hold is cut by sizes and positions, and its cells dealt to several blocks;
    # a task holds blocks, never a whole list.
    long_ = known.groupBy("token").agg(F.count("*").alias("sets")).where(F.col("sets") > BLOCK_SETS).select("token", F.lit(True).alias("long"))
    placed = known.join(long_, "token", "left").withColumn("cell", F.when(F.col("long"), F.struct("block", "at")))
    parts = placed.where("long").groupBy("token", "cell").agg(F.ceil(F.count("*") / BLOCK_SETS).alias("parts")).where("parts > 1")
    dealt = placed.join(parts, ["token", "cell"], "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)))
    # The smallest size only: an entry of a list must not grow with its set, which has as many entries as tokens.
    bits = marked.where(F.size("fold") > 0).select("row", F.col("fold").alias("bits"))
    sets = F.struct("row", "n", "pos", "root", "block", "near", "far", "bits")
    return stored(dealt.join(bits, "row").groupBy("token", "cell", "part").agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("pos").alias("p0"), F.max("pos").alias("p1"),
        F.min("root").alias("r0"), F.max("root").alias("r1"), F.collect_list(sets).alias("sets")), "blocks")


def _entries(cells) -> tuple[dict[str, np.ndarray], tuple, np.ndarray]:
    """The entries of a column of blocks: their fields, their signatures and the offsets of the blocks."""
    held = cells.flatten()
    fields = {c: held.field(c).to_numpy(zero_copy_only=False) for c in ("row", "n", "pos", "root", "block", "near", "far")}
    return fields, _flat(held.field("bits")), np.concatenate([[0], np.cumsum(np.diff(cells.offsets.to_numpy()))])


def meet(left: tuple, right: tuple, times: int, of: int):
    """The pairs of entries, of the blocks that stand side by side, that no skip rules out."""
    (x, x_bits, x_off), (y, y_bits, y_off) = left, right
    wide, many = np.diff(y_off), np.diff(x_off) * np.diff(y_off)
    ends = np.cumsum(many)
    at = 0
    while at < len(many):
        # blocks side by side until there are enough pairs, one at least
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP_PAIRS, "right")))
        k = np.repeat(np.arange(at, to), many[at:to])
        inside = np.arange(len(k)) - np.repeat(ends[at:to] - many[at:to], many[at:to]) + (ends[at - 1] if at else 0)
        u, v = x_off[k] + inside // wide[k], y_off[k] + inside % wide[k]
        at = to
        keep = x["root"][u] != y["root"][v]
        u, v = u[keep], v[keep]
        n, m, i, j = x["n"][u], y["n"][v], x["pos"][u], y["pos"][v]
        most = np.minimum(i, j) + 1 + np.minimum(n - i - 1, m - j - 1)
        apart = np.maximum(x["near"][u] - y["far"][v], y["near"][v] - x["far"][u])
        keep = ((times + of) * most >= times * (n + m)) & ~((x["block"][u] == y["block"][v]) & (apart > 1 - times / of + 1e-9))
        u, v = u[keep], v[keep]
        keep = (times + of) * differing_bits(x_bits, y_bits, u, v) <= (of - times) * (x["n"][u] + y["n"][v])
        a, b, n, m = x["row"][u[keep]], y["row"][v[keep]], x["n"][u[keep]], y["n"][v[keep]]
        swap = a > b
        yield np.where(swap, b, a), np.where(swap, a, b), np.where(swap, m, n), np.where(swap, n, m)


def open_pairs(made: DataFrame, times: int, of: int) -> DataFrame:
    """(a, b, n, m), a < b: pairs of sets of different components that are still to be verified, and their sizes."""
    place = F.struct("cell", "part")
    right = made.select("token", *(F.col(c).alias(f"{c}_") for c in made.columns if c != "token"))
    order = F.col("cell").isNull() | (place <= F.struct("cell_", "part_"))
    near = F.col("cell").isNull() | (F.col("cell_.block") - F.col("cell.block") <= math.ceil(math.log(of / times) / math.log(SIZE_STEP) - 1e-9))
    room = ((times + of) * (F.least("p1", "p1_") + 1 + F.least(F.col("n1") - F.col("p0") - 1, F.col("n1_") - F.col("p0_") - 1))
            >= times * (F.col("n0") + F.col("n0_")))
    several = ~((F.col("r0") == F.col("r1")) & (F.col("r0_") == F.col("r1_")) & (F.col("r0") == F.col("r0_")))
    pairs = made.join(right, "token").where(order & near & room & several).select("sets", "sets_")

    def run(batches):
        for batch in batches:
            for a, b, n, m in meet(_entries(batch.column(0)), _entries(batch.column(1)), times, of):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, n, m)], ["a", "b", "n", "m"])

    return pairs.mapInArrow(run, "a long, b long, n long, m long").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS,
                       times: int = TIMES, of: int = OF) -> DataFrame:
    """id, ``n_shingles`` and ``component_id``, the least id that links lead to, per row.

    Two documents link if ``of * shared >= times * all`` of their shingles.
    """
    text = F.col(text_col)
    plain = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2"),
                        text.alias("t"))
    marked = indexed_sets(plain, size, times, of)
    copies = stored(marked.where("n > 0").groupBy("k1", "k2").agg(F.min("row").alias("row"), F.min("id").alias("first_id")),
                    "copies")
    lists = index_lists(marked, copies)
    heads, answers = leader_answers(plain, marked, lists, size, times, of)
    led = answers.where(_linked(F.col("both"), F.col("n"), F.col("m"), times, of)).select(
        F.greatest("leader", "row").alias("u"), F.least("leader", "row").alias("v"))
    roots = stored(components(led), "first-roots")
    pairs = with_bits(open_pairs(blocks(lists, heads, answers, marked, roots), times, of), marked)
    pairs = stored(pairs.where(_may_link(times, of)), "pairs")
    more = (overlaps(plain, marked, pairs.select("a", "b"), size).join(pairs, ["a", "b"])
            .where(_linked(F.col("both"), F.col("n"), F.col("m"), times, of))
            .select(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = stored(more.unionAll(roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))), "links")
    # Written, so that both sides of the last join are plain exchanges and the rows of a hot text can be split.
    by_row = copies.join(components(edges).toDF("row", "root"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    firsts = by_row.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_key = stored(by_row.join(firsts, "root").select("k1", "k2", "component_id"), "component-ids")
    return marked.select("id", "k1", "k2", "n").join(by_key, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
