"""Spelling variant grouping by dense prefix-suffix tiling.

Words are the runs of letters of all texts with their counts. Two words are near if they differ by exactly one
inserted, deleted or replaced code point. For a longer length of m that is so if and only if their common prefix and
common suffix together reach m - 1 (and they are not equal). Then the prefix has at least m // 2 code points, or the
suffix at least m - m // 2. Each word stands in the cells of its first m // 2 and of its last m - m // 2 code points,
for its own length and the next, so that near words meet in a cell. The words of a cell are the rows of matrices of
code points, padded to m, and blocks of rows are compared densely: first differing column from the left and from
the right. A pair that meets in both cells counts in the prefix cell.

A pair of blocks returns one row per word (how many are near, which of them is the most frequent), so no pairs leave
a task, and a cell of any size is cut into blocks of bounded size. The most frequent near word is a word's form if it
is frequent enough; forms are followed to the root by doubling, six times at most, as counts at least double with
every form.

Edge cases: null texts have no words; a null id counts as an empty string in the hash that places the test edits;
words of fewer code points than the least length or fewer occurrences than the least count are no words; the smaller
of two equally frequent forms in code-point order is taken; repeated rows count as often as they stand; an empty table
gives an empty result. Very long runs of letters are words like others, in blocks of fewer rows. Extra columns of any
name are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

RUN = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent as its variant.
FORM_TIMES = 2
#: One code point is deleted where this number divides the hash of id and run; 0: none.
EDIT_MODULUS = 97
#: Code points in a block's matrix, and rows at most.
BLOCK_CELLS, BLOCK_WORDS = 1 << 14, 512
#: Code points compared at a time.
STEP_CELLS = 1 << 21
#: 2 to this power exceeds the longest chain of forms, as counts are 64-bit numbers that double along it.
DOUBLINGS = 6


def _edited(run: Column, doc_id: Column, modulus: int) -> Column:
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(modulus)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(
        run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, edit_modulus: int = EDIT_MODULUS) -> DataFrame:
    """(word, n) of the runs of letters, A-Z lower-cased."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(
        F.translate(text_col, UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    word = _edited(F.col("run"), F.col("id"), edit_modulus) if edit_modulus else F.col("run")
    return (runs.select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


def cell_blocks(words: DataFrame) -> DataFrame:
    """(m, suffix, part_of, part, words, counts): the words of each cell in blocks of bounded size."""
    size = F.length("word")
    placed = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m"))
    half = F.floor(F.col("m") / 2).cast("int")
    placed = placed.select("word", "n", "m", F.explode(F.array(
        F.struct(F.lit(False).alias("suffix"), F.substring("word", F.lit(1), half).alias("part_of")),
        F.struct(F.lit(True).alias("suffix"), F.substring("word", half - F.col("m"), F.col("m") - half).alias("part_of"))))
        .alias("cell")).select("word", "n", "m", "cell.*")
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_CELLS) / F.first("m"))))
    cell = ["m", "suffix", "part_of"]
    parts = stored(placed.groupBy(*cell).agg(F.count("*").alias("words"), F.ceil(F.count("*") / rows).alias("parts"))
                   .where("words > 1").drop("words"), "cells")
    return stored(placed.join(parts, cell).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")))
                  .groupBy(*cell, "part").agg(F.collect_list(F.struct("word", "n")).alias("words")), "word-blocks")


def _matrix(words: list[bytes], m: int, right: bool) -> np.ndarray:
    """Code points, aligned left or right and padded with zeros; all are below 256."""
    pad = bytes.rjust if right else bytes.ljust
    return np.frombuffer(b"".join(pad(w, m, b"\0") for w in words), np.uint8).reshape(-1, m)


def near_words(left: list[bytes], right: list[bytes], m: int, suffix: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the near pairs of two blocks of words of m or m - 1 code points, at least one of m."""
    size_l, size_r = (np.array([len(w) for w in side]) for side in (left, right))
    ends_l, ends_r = _matrix(left, m, True), _matrix(right, m, True)
    starts_l, starts_r = _matrix(left, m, False), _matrix(right, m, False)
    shorter, half, out = m - 1, m // 2, []
    step = max(1, STEP_CELLS // max(1, m * len(right)))
    for at in range(0, len(left), step):
        rows = slice(at, at + step)
        longer = (size_l[rows, None] == m) | (size_r[None] == m)
        differ = starts_l[rows, None] != starts_r[None]
        head = np.where(differ.any(2), differ.argmax(2), m)
        a, b = np.nonzero(longer & (head < m) & ((head < half) if suffix else (head >= half)))
        head = head[a, b]
        tail = (ends_l[rows][a, ::-1] != ends_r[b, ::-1]).argmax(1)
        keep = head + tail >= shorter
        out.append((a[keep] + at, b[keep]))
    return tuple(np.concatenate(side) for side in zip(*out)) if out else (np.empty(0, int), np.empty(0, int))


class _Tally:
    """Per word the number of near words and the most frequent one, the smallest if tied."""

    def __init__(self):
        self.found: dict[bytes, list] = {}

    def add(self, word: bytes, near: bytes, n: int) -> None:
        best = self.found.get(word)
        if best is None:
            self.found[word] = [1, n, near]
        else:
            best[0] += 1
            if n > best[1] or n == best[1] and near < best[2]:
                best[1:] = n, near


def variants(blocks: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) per word with near words."""
    cell = ["m", "suffix", "part_of"]
    other = blocks.select(*cell, F.col("part").alias("part_"), F.col("words").alias("words_"))
    pairs = blocks.join(other, cell).where("part <= part_").select("m", "suffix", (F.col("part") == F.col("part_")).alias("same"),
                                                                   "words", "words_")

    def run(batches):
        for batch in batches:
            tally = _Tally()
            for i in range(batch.num_rows):
                m, suffix, same, left, right = (c[i] for c in batch.columns)
                # every letter is below U+0100, so Latin-1 keeps lengths and order
                a, b = ([(w["word"].encode("latin-1"), w["n"]) for w in side.as_py()] for side in (left, right))
                for x, y in zip(*near_words([w for w, _ in a], [w for w, _ in b], m.as_py(), suffix.as_py())):
                    tally.add(a[x][0], b[y][0], b[y][1])
                    if not same.as_py():
                        tally.add(b[y][0], a[x][0], a[x][1])
            if tally.found:
                n, near_n, near = zip(*tally.found.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode("latin-1") for w in tally.found]), pa.array(n, pa.int64()), pa.array(near_n, pa.int64()),
                     pa.array([w.decode("latin-1") for w in near])], ["word", "n_near", "near_n", "near"])

    found = pairs.mapInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.order")).alias("near_n"), F.col("best.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, followed to the last."""
    ways = forms.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        ways = stored(ways, "forms")
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not ways.join(on, "root", "left_semi").head(1):
            break
        ways = ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return ways


def spelling_groups(words: DataFrame, form_times: int = FORM_TIMES) -> DataFrame:
    """word, n, ``form``, ``form_n``, ``n_near`` and ``root`` of every word of (word, n)."""
    words = stored(words.select("word", "n"), "words")
    near = variants(cell_blocks(words))
    fit = F.col("near_n") >= form_times * F.col("n")
    forms = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fit, F.col("near")).alias("form"),
        F.when(fit, F.col("near_n")).alias("form_n")), "variants")
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
