"""Chunks of a marked text for sentence-piece vocabularies.

Such a vocabulary marks a space by U+2581. If no piece has a marker after another character, no piece can lie
across the place before a run of markers, and a text falls into chunks (a run of markers and what follows it)
that can be segmented one by one.
"""

from __future__ import annotations

import re
from functools import lru_cache

import sentencepiece

MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")


@lru_cache(maxsize=2)
def processor(model_path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model_path)


@lru_cache(maxsize=2)
def vocabulary(model_path: str) -> tuple[tuple[str, float], ...]:
    """(piece, score) of every piece, by id."""
    p = processor(model_path)
    return tuple((p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size()))


def stays_in_chunk(pieces) -> bool:
    """True if no piece has a marker after another character."""
    return not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first marker, further markers as spaces; none of an empty text.

    The marker that an encoder puts before a text is the first chunk's.
    """
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [c[1:] for c in _CHUNK.findall(" " + text)]
    return text.split(" ")


class ChunkTable(dict):
    """What ``make`` gives for each distinct chunk, made once. Holds at most ``most`` chunks, then starts anew."""

    def __init__(self, make, most: int = 400_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def of(self, texts: list[list[str]]) -> list[list]:
        """The values of the chunks by position, for some texts' chunks."""
        found = [list(map(self.get, t)) for t in texts]
        new = {c for t, values in zip(texts, found) if None in values for c, v in zip(t, values) if v is None}
        if not new:
            return found
        made = dict(zip(new, self.make(list(new))))
        for t, values in zip(texts, found):
            if None in values:
                values[:] = [made[c] if v is None else v for c, v in zip(t, values)]
        if len(self) + len(new) > self.most:
            self.clear()
        self.update((c, v) for c, v in made.items() if len(c) <= self.longest)
        return found
