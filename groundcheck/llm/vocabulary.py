"""Piece vocabularies of public tokenizers, and how texts fall into independent units.

A unit is a run of blanks with what follows up to the next blank or line feed. No piece of a
separable vocabulary reaches over a unit's border, so that a best segmentation of a text is the
best segmentations of its units laid end to end, and each distinct unit is segmented once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

BLANK = "▁"


@dataclass
class Vocabulary:
    """Pieces that text can match, by id; ids of the 256 bytes; the id of unknown characters."""

    pieces: dict[str, int]
    scores: dict[str, float]
    bytes: list[int] | None
    unknown: int
    size: int
    #: Which of the pieces stand for a surface, by id; bytes and markers are apart.
    surface: list[bytes | None]

    @property
    def pattern(self) -> re.Pattern[str] | None:
        """Matches the units of a text whose blanks are marked; none if pieces cross borders."""
        if any(BLANK in p.lstrip(BLANK) for p in self.pieces):
            return None
        if any("\n" in p for p in self.pieces):
            return re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        return re.compile(f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")


def load(path: str) -> Vocabulary:
    """Vocabulary of a SentencePiece model file, read on the driver; its size is the model's."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, of_byte, surface = {}, {}, {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            of_byte[int(piece[3:5], 16)] = i
            surface.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            surface.append(None)
        else:
            pieces[piece] = i
            scores[piece] = model.get_score(i)
            surface.append(piece.replace(BLANK, " ").encode())
    return Vocabulary(pieces, scores, [of_byte[b] for b in range(256)] if len(of_byte) == 256 else None, model.unk_id(), model.get_piece_size(), surface)


def marked(text: str) -> str:
    """The text with a blank before it and all blanks marked; an empty text stays empty."""
    return BLANK + text.replace(" ", BLANK) if text else ""


def units(text: str, pattern: re.Pattern[str] | None) -> list[str]:
    shown = marked(text)
    if pattern is None:
        return [shown] if shown else []
    return pattern.findall(shown)
