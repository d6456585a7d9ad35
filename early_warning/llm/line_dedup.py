"""Line dedup [native]: winnowing over line hashes.

Lines with words are hashed. A window is the shortest run of consecutive lines with at least ``min_words`` words
that starts at a line, or that ends at one. The least line hash of a window, the rightmost if tied, is its
fingerprint, so two equal windows have equal fingerprints at the same line of the window and every repeated run of
that many words shares one. Only the selected lines are kept as positions, and the positions of equal fingerprints
are joined. Positions of fingerprints that stand at one place only are dropped; the others are extended both ways
over the neighbouring line hashes: to the windows they were selected for, and these to whole runs, as the windows
that start in a run reach from its first line on and those that end in it reach back from its last line. Every
extended match is compared with the first place where the same lines stand. Repeated runs are deleted; the first
stays.

The result is exact: a line goes if and only if a run of lines around it with at least ``min_words`` words stands
at an earlier place. Documents are in the order of (id, hash of the text), nulls first; a run of a document may
overlap its own earlier place. No pairs are made: a match meets its first place only, so a group of copies
costs as many rows as it has windows. Texts move only if they may hold a repeated run: a bitmap of fixed size
tells the others, which are passed on where they are.

Edge cases: null and empty texts have no lines and stay as they are; lines without words are no part of the
comparison and go only if they lie inside a repeated window; rows with equal id and text are one document and get
the same result; a text may become empty; texts of fewer words than the least run stay as they are; an empty table
gives an empty result; very long texts are compared whole, line by line; extra columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import safe_names, stored

MIN_WORDS = 50
#: Bits of the bitmap of documents with runs, 2 to this power (1 MB).
HIT_BITS = 23
WORD = r"[^\x20\x09-\x0D]+"


def _lines(docs: DataFrame) -> DataFrame:
    """(d, th, pos, h, g, nw) per line with words: document, place, two hashes of the line, words."""
    split = docs.select("d", "th", F.posexplode(F.split("t", "\n")).alias("pos", "line"))
    return (split.select("d", "th", "pos", F.xxhash64("line").alias("h"),
                         F.xxhash64(F.lit("second"), "line").alias("g"),
                         F.regexp_count("line", F.lit(WORD)).cast("long").alias("nw"))
            .where("nw > 0")
            .repartition("d", "th").dropDuplicates(["d", "th", "pos"]))


def _counted(lines: DataFrame) -> DataFrame:
    """Words up to and before each line of a document."""
    before = W.partitionBy("d", "th").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return lines.withColumn("c", F.sum("nw").over(before)).withColumn("b4", F.col("c") - F.col("nw"))


def _over_windows(lines: DataFrame, min_words: int, of: Callable) -> DataFrame:
    """(d, th, w): ``of`` each window of a document's lines, those that start and those that end at a line."""
    doc = W.partitionBy("d", "th")
    ahead, back = doc.orderBy("b4").rangeBetween(0, min_words - 1), doc.orderBy("c").rangeBetween(-(min_words - 1), 0)
    return (_counted(lines)
            .withColumn("ahead", F.when(F.max("c").over(ahead) - F.col("b4") >= min_words, of(ahead)))
            .withColumn("back", F.when(F.col("c") - F.min("b4").over(back) >= min_words, of(back)))
            .select("d", "th", F.explode(F.array_distinct(F.array("ahead", "back"))).alias("w")).where("w is not null"))


def _least(frame) -> Column:
    """The fingerprint of a window and, negative, its place."""
    return F.min(F.struct(F.col("h").alias("fp"), (-F.col("pos")).alias("p"))).over(frame)


def positions(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, th, p, fp): the lines that some window selects as its fingerprint."""
    return (_over_windows(lines, min_words, _least).select("d", "th", (-F.col("w.p")).alias("p"), "w.fp")
            .dropDuplicates(["d", "th", "p"]))


def matches(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, th, s, e, fp, a, b): every window's lines, fingerprint and content as two hashes."""
    extended = lambda frame: F.struct(
        F.min("pos").over(frame).alias("s"), F.max("pos").over(frame).alias("e"), _least(frame).fp.alias("fp"),
        F.xxhash64(F.collect_list("h").over(frame)).alias("a"), F.xxhash64(F.collect_list("g").over(frame)).alias("b"))
    return _over_windows(lines, min_words, extended).select("d", "th", "w.*")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, th, runs): the disjoint runs of lines, first and last, to delete, per document that has any."""
    # Written, so that both sides of the joins are plain exchanges and a hot key's rows can be split among tasks. All
    # sides grow with the input, so no join is left to a broadcast that holds at small sizes only.
    lines = stored(_lines(docs), "lines")
    found = stored(positions(lines, min_words), "positions")
    place = F.struct("d", "th", "p")
    shared = stored(found.groupBy("fp").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
                    .where(F.col("lo") != F.col("hi")).select("fp"), "shared")
    hit = stored(found.join(shared.hint("merge"), "fp", "left_semi").select("d", "th").distinct().toDF("hd", "hth"), "hit")
    near = lines.join(hit.hint("merge"), F.col("d").eqNullSafe(F.col("hd")) & (F.col("th") == F.col("hth")), "left_semi")
    met = stored(matches(near, min_words).join(shared.hint("merge"), "fp", "left_semi").select("d", "th", "s", "e", "a", "b"), "matches")
    first = stored(met.groupBy("a", "b").agg(F.min(F.struct("d", "th", "s")).alias("first"), F.count("*").alias("n"))
                   .where("n > 1").drop("n"), "first")
    later = met.join(first.hint("merge"), ["a", "b"]).where(F.struct("d", "th", "s") > F.col("first")).select("d", "th", "s", "e")
    doc = W.partitionBy("d", "th").orderBy("s", "e")
    reach = F.max("e").over(doc.rowsBetween(W.unboundedPreceding, -1))
    runs = (later.withColumn("new", F.coalesce((F.col("s") > reach + 1).cast("int"), F.lit(1)))
            .withColumn("run", F.sum("new").over(doc.rowsBetween(W.unboundedPreceding, 0)))
            .groupBy("d", "th", "run").agg(F.min("s").alias("s"), F.max("e").alias("e")))
    return runs.groupBy("d", "th").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("runs"))


def _may_have(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The documents with ``hit``: false only for those without runs, by a bitmap of 2 ** HIT_BITS bits."""
    bit = lambda key: F.pmod(key, F.lit(1 << HIT_BITS)) + 1
    # 1 << HIT_BITS bits in rows of 4 KB: a fixed size, whatever the input.
    filled = runs.select(F.bitmap_bucket_number(bit(F.col("rth"))).alias("bucket"), F.bitmap_bit_position(bit(F.col("rth"))).alias("at"))
    bitmap = filled.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    at = F.bitmap_bit_position(bit(F.col("th")))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (docs.withColumn("bucket", F.bitmap_bucket_number(bit(F.col("th")))).join(F.broadcast(bitmap), "bucket", "left")
            .withColumn("hit", F.coalesce(F.bit_get(byte, (at % 8).cast("int")) > 0, F.lit(False)))
            .drop("bucket", "bits"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, the ``text`` that is left, n_lines, n_removed and the deleted ``runs``."""
    plain, names = safe_names(docs)
    marked = plain.select("*", F.col(names[id_col]).alias("d"), F.xxhash64(names[text_col]).alias("th"),
                          F.col(names[text_col]).alias("t"))
    runs = stored(repeated_runs(marked.select("d", "th", "t"), min_words).toDF("rd", "rth", "runs"), "runs")
    told = _may_have(marked, runs)
    moved = told.where("hit").join(runs.hint("merge"), F.col("d").eqNullSafe(F.col("rd")) & (F.col("th") == F.col("rth")), "left").drop("rd", "rth")
    joined = moved.unionByName(told.where("not hit").withColumn("runs", F.lit(None).cast(runs.schema["runs"].dataType)))
    # the stretches between the runs: from the line after one to the line before the next
    froms = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r.e + 1))
    tos = F.concat(F.transform("runs", lambda r: r.s), F.array(F.size("ls")))
    left = F.flatten(F.zip_with(froms, tos, lambda a, b: F.slice(F.col("ls"), a + 1, b - a)))
    return (joined.withColumn("ls", F.split("t", "\n"))
            .select(*(F.col(names[c]).alias(c) for c in keep),
                    F.when(F.col("runs").isNull(), F.col("t")).otherwise(F.array_join(left, "\n")).alias("_text"),
                    F.coalesce(F.size("ls"), F.lit(0)).cast("long").alias("_n_lines"),
                    F.coalesce(F.aggregate("runs", F.lit(0), lambda n, r: n + r.e - r.s + 1), F.lit(0))
                    .cast("long").alias("_n_removed"),
                    F.col("runs").alias("_runs"))
            .toDF(*keep, "text", "n_lines", "n_removed", "runs"))
