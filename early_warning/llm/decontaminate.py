"""Benchmark decontamination: Wu-Manber search of test-item windows in whole documents.

Texts are lower-cased word sequences. A window is ten consecutive words of an item (an item of fewer
words, but not none, is one window). The search works on words: per window length, a shift table over
blocks of two words says how far the search may jump, buckets by the last block (and the first word)
select windows, and direct comparison confirms. A clean document of n words is touched at about n/9 places.

The item table is the query set. A table of one block of bounded bytes is broadcast and searched in one scan;
documents are not shuffled. A larger one is searched block by block: each block is broadcast by itself, the texts
that it hits are written (a digest of the text, spans, items; one row per text, however many copies it has) and its
broadcast is destroyed before the next. The blocks' rows are merged by digest and joined to the documents once.

Edge cases: null and empty texts have no words and no windows; an item with a null id is searched and its
words are hit, but it is not listed among the items; repeated items and documents count like any other; an
empty item table leaves every document clean; an empty document table gives no rows. Texts are searched whole, of
any length; an item longer than a block is a block. ``keep`` names must differ from the operator's own columns.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, each, safe_names, scan_texts, stored

WINDOW_WORDS = 10
#: Text bytes of test items in one block; what a block's tables need in a worker is a small multiple.
BLOCK_BYTES = 4 << 20
#: Words before lower-casing, for counts on the JVM side.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOUND = [("n_words", "long"), ("span_begins", "array<long>"), ("span_ends", "array<long>"), ("items", "array<string>")]


class WuManber:
    """Search for many word sequences of one length."""

    def __init__(self, patterns: dict[tuple, set]):
        self.m = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.far = m - b + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict] = defaultdict(lambda: defaultdict(list))
        for p, items in patterns.items():
            for end in range(b, m + 1):
                key, jump = p[end - b:end], m - end
                self.shift[key] = min(jump, self.shift.get(key, self.far))
            self.buckets[p[m - b:]][p[0]].append((list(p), items))

    def search(self, words: list):
        """(first word, items) of every occurrence."""
        m, b, far, shift, n = self.m, self.block, self.far, self.shift, len(words)
        jump, i = shift.get, m - 1
        while i < n:
            key = (words[i - 1], words[i]) if b == 2 else (words[i],)
            s = jump(key, far)
            if s:
                i += s
                continue
            first = i - m + 1
            for p, items in self.buckets[key].get(words[first], ()):
                if words[first:i + 1] == p:
                    yield first, items
            i += 1


def windows(words: list, size: int = WINDOW_WORDS):
    """The windows of an item's words."""
    if 0 < len(words) < size:
        yield tuple(words)
    for i in range(len(words) - size + 1):
        yield tuple(words[i:i + size])


def build(items: Sequence[tuple], size: int = WINDOW_WORDS) -> list[WuManber]:
    """One search per window length from (item id, UTF-8 text) pairs."""
    by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        for w in windows(alnum_words(text), size):
            ids = by_length[len(w)][w]
            if item is not None:
                ids.add(str(item))
    return [WuManber(p) for _, p in sorted(by_length.items())]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans, ends exclusive, that cover the same words."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scanner(shared, size: int):
    def make():
        searches = build(shared.value, size)

        def row(text):
            words = alnum_words(text)
            spans, found = [], set()
            for s in searches:
                for at, ids in s.search(words):
                    spans.append((at, at + s.m))
                    found |= ids
            spans = _merged(spans)
            return len(words), [a for a, _ in spans], [b for _, b in spans], sorted(found)

        return each(row)

    return make


def _merger():
    def row(begins, ends, items):
        spans = _merged([s for a, b in zip(begins, ends) for s in zip(a, b)])
        return [a for a, _ in spans], [b for _, b in spans], sorted({i for part in items for i in part})

    return each(row)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The distinct items (id, text, block) and the number of blocks, each of about ``block_bytes``."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"),
                             F.col(text_col).cast("binary").alias("text")).dropna(subset=["text"]).distinct()
    n = max(1, -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
    return (items if n == 1 else stored(items, "benchmark-blocks")), n


def _hits_of_blocks(docs: DataFrame, text_col: str, items: DataFrame, n: int, window: int) -> DataFrame:
    """One row per text that any block hits: its digest, merged spans and items; one broadcast lives at a time."""
    sc, parts = docs.sparkSession.sparkContext, []
    texts = docs.select(F.sha2(F.col(text_col), 256).alias("digest"), F.col(text_col).alias("text"))
    for b in range(n):
        shared = sc.broadcast([(r.id, bytes(r.text)) for r in items.where(F.col("block") == b).toLocalIterator()])
        hit = scan_texts(texts, ["digest"], ["text"], _scanner(shared, window), FOUND).where(F.size("span_begins") > 0)
        one = F.first(F.struct("span_begins", "span_ends", "items")).alias("found")
        parts.append(stored(hit.groupBy("digest").agg(one).select("digest", "found.*"), "benchmark-hits"))
        shared.destroy()
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    lists = [n for n, _ in FOUND[1:]]
    hits = hits.groupBy("digest").agg(*(F.collect_list(c).alias(c) for c in lists))
    return scan_texts(hits, ["digest"], lists, _merger, FOUND[1:])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` plus n_words, the hit word spans (``span_begins``, ``span_ends`` exclusive) and the ``items``."""
    items, n = item_blocks(benchmark, item_id_col, item_text_col, block_bytes)
    if n == 1:
        shared = docs.sparkSession.sparkContext.broadcast([(r.id, bytes(r.text)) for r in items.toLocalIterator()])
        return scan_texts(docs, list(keep), [text_col], _scanner(shared, window), FOUND)
    hits = _hits_of_blocks(docs, text_col, items, n, window)
    kept = [f"k{i}" for i in range(len(keep))]
    counted = docs.select(*(F.col(c).alias(k) for k, c in zip(kept, keep)), F.sha2(F.col(text_col), 256).alias("digest"),
                          F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    found = counted.join(hits, "digest", "left")
    return found.select(*(F.col(k).alias(c) for k, c in zip(kept, keep)), "n_words",
                        *(F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in FOUND[1:]))


def leak_digest(found: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Counts and the digest of the item list."""
    n_hit = F.aggregate(F.zip_with("span_ends", "span_begins", lambda b, a: b - a), F.lit(0).cast("long"),
                        lambda x, y: x + y)
    return found.select(
        *keep, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("span_begins") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window of the item table occurs, all their columns unchanged."""
    plain, names = safe_names(docs)
    found = decontaminate(plain, benchmark, names["text"], list(names.values()))
    return found.where(F.size("span_begins") == 0).select(*names.values()).toDF(*docs.columns)
