"""Token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character; dynamic programming
carries the best score and the number of pieces on its path, and no path is kept. The rules are those of
the tokenizers library's unigram model: a start further left comes first and a later one must be better, a
character that no one-character piece covers may be unknown at the least score less ten, and an unknown
character counts as its UTF-8 bytes. Pieces cannot cross a space marker, so each distinct chunk of a task is
counted once and the counts of a text's chunks are added up.

The vocabulary is any list of (piece, score); the query uses the pieces and scores of a public file.

Edge cases: null and empty texts have no tokens; very long chunks are counted but not stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan_texts
from .pieces import MARK, ChunkTable, chunks, stays_in_chunk, vocabulary

#: The library's penalty of an unknown character below the least score.
UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")


class Counter:
    """Counts the pieces of the best segmentation."""

    def __init__(self, vocab: Sequence[tuple[str, float]]):
        if not stays_in_chunk(p for p, _ in vocab):
            raise ValueError("the vocabulary has pieces across a space marker")
        self.unknown = min(s for _, s in vocab) - UNKNOWN_PENALTY
        self.single = {p for p, _ in vocab if len(p) == 1}
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocab:
            if piece:
                self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        # small counts cost no memory of their own, so the table may be large
        self.table = ChunkTable(lambda new: [self.best(MARK + c.replace(" ", MARK))[0] for c in new], most=1_500_000)

    def best(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation of a marked text."""
        n = len(text)
        score = [NEVER] * (n + 1)
        count = [0] * (n + 1)
        score[0] = 0.0
        # Matches come by their end, the longest, which starts first, before the shorter ones.
        if self.single.issuperset(text):
            for last, (size, own) in self.pieces.iter(text):
                start = last + 1 - size
                s = score[start] + own
                if s > score[last + 1]:
                    score[last + 1] = s
                    count[last + 1] = count[start] + 1
            return count[n], score[n]
        done = 0
        for last, (size, own) in self.pieces.iter(text):
            if done < last:
                done = self.unknowns(text, score, count, done, last)
            start = last + 1 - size
            s = score[start] + own
            if s > score[last + 1]:
                score[last + 1] = s
                count[last + 1] = count[start] + 1
        self.unknowns(text, score, count, done, n)
        return count[n], score[n]

    def unknowns(self, text: str, score: list, count: list, at: int, upto: int) -> int:
        """Offer the unknown character at the places from ``at`` on, at whose ends no more pieces end."""
        for i in range(at, upto):
            if text[i] not in self.single:
                s = score[i] + self.unknown
                if s > score[i + 1]:
                    score[i + 1] = s
                    count[i + 1] = count[i] + len(text[i].encode("utf-8"))
        return upto

    def count(self, texts: list[str]) -> list[tuple[int]]:
        return [(sum(t),) for t in self.table.of([chunks(t) for t in texts])]


@lru_cache(maxsize=2)
def counter(model_path: str) -> Counter:
    return Counter(vocabulary(model_path))


def _rows(model_path: str):
    def make():
        own = counter(model_path)
        return lambda rows: own.count([t or "" for t, in rows])

    return make


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text",
                 keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and n_tokens, the pieces of the best segmentation."""
    kept = [f"k{i}" for i in range(len(keep))]
    plain = docs.select(*(F.col(c).alias(k) for k, c in zip(kept, keep)), F.col(text_col).alias("t__"))
    found = scan_texts(plain, kept, ["t__"], _rows(model_path), [("n_tokens", "long")], binary=False)
    return found.select(*(F.col(k).alias(c) for k, c in zip(kept, keep)), "n_tokens")
