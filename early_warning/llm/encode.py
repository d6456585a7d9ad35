"""SentencePiece encoding and decoding with a table of distinct chunks.

If the vocabulary has no piece across a space marker, each distinct marked word is segmented once by the
library and the ids are joined back by position; the result is the library's own for the whole text. A
vocabulary with such pieces is encoded text by text. Decoding is the library's decode(ids).

The table lives in a Python worker: it fills as texts come, is bounded in size and holds nothing that another
worker needs, so a lost executor costs its tasks only. (A table of the whole corpus would shuffle every word of it.)

Edge cases: a null text counts as empty; an empty text has the begin and end ids only; very long chunks are
segmented but not stored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan_texts
from .pieces import MARK, ChunkTable, chunks, processor, stays_in_chunk, vocabulary

#: Output columns: token count, ids, decoded text and digests of both.
OUTPUTS = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string",
           "decoded_sha256": "string"}


class Encoder:
    """Encodes texts as the library does, with begin and end ids."""

    def __init__(self, model_path: str):
        self.library = processor(model_path)
        pieces = [p for p, _ in vocabulary(model_path)]
        self.by_chunk = stays_in_chunk(pieces) and MARK in pieces
        # a lone marker, the chunk that a single space at the end makes, is a piece that no text of its own encodes to
        self.lone = array("I", [self.library.piece_to_id(MARK)]).tobytes()
        self.begin = array("I", [self.library.bos_id()]).tobytes()
        self.end = array("I", [self.library.eos_id()]).tobytes()
        self.table = ChunkTable(self.segment)

    def segment(self, new: list[str]) -> list[bytes]:
        """The ids of chunks, by the library."""
        found = self.library.encode(new, num_threads=1)
        return [array("I", ids).tobytes() if c else self.lone for c, ids in zip(new, found)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids as unsigned 32-bit integers."""
        if self.by_chunk:
            return [b"".join([self.begin, *ids, self.end]) for ids in self.table.of([chunks(t) for t in texts])]
        found = self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
        return [array("I", ids).tobytes() for ids in found]


@lru_cache(maxsize=2)
def encoder(model_path: str) -> Encoder:
    return Encoder(model_path)


def _little_endian(ids: bytes) -> bytes:
    a = array("I", ids)
    if array("H", [1]).tobytes() == b"\x00\x01":
        a.byteswap()
    return a.tobytes()


def _rows(model_path: str, columns: tuple[str, ...]):
    decodes = any(c.startswith("decoded") for c in columns)

    def make():
        own = encoder(model_path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        made = {
            "n_tokens": lambda ids, back: len(ids) // 4,
            "ids": lambda ids, back: array("I", ids).tolist(),
            "decoded": lambda ids, back: back,
            "ids_sha256": lambda ids, back: sha(_little_endian(ids)),
            "decoded_sha256": lambda ids, back: sha(back.encode("utf-8")),
        }
        values = [made[c] for c in columns]

        def rows(texts):
            for ids in own.encode([t or "" for t, in texts]):
                back = own.library.decode(array("I", ids).tolist()) if decodes else None
                yield tuple(v(ids, back) for v in values)

        return rows

    return make


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                 columns: Sequence[str] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """``keep`` plus the wanted ``columns`` of OUTPUTS."""
    kept = [f"k{i}" for i in range(len(keep))]
    plain = docs.select(*(F.col(c).alias(k) for k, c in zip(kept, keep)), F.col(text_col).alias("t__"))
    found = scan_texts(plain, kept, ["t__"], _rows(model_path, tuple(columns)),
                       [(c, OUTPUTS[c]) for c in columns], binary=False)
    return found.select(*(F.col(k).alias(c) for k, c in zip(kept, keep)), *columns)
