"""SentencePiece vocabularies as unigram models: marked words and the best split of each.

A model file is read on the driver (its path is a parameter) and its pieces, some tens of
thousands, go to the tasks. Text is prepared as the library does it for an identity
normalizer: a space goes before a text that isn't empty, spaces become U+2581, and a marked
word is a run of marks with the characters up to the next mark. No piece goes on past the
start of a marked word (checked on loading), so words can be split one by one.

The best split has the highest sum of piece scores; of equal ones, at every end the piece
that starts first wins, because candidates come by start and only a higher sum replaces.
A character that is no piece costs the lowest score less ten and is written as its bytes.
Sums are doubles: scores are whole numbers or float32, so sums over a word are exact for the
former. U+2581 in a text is written as bytes, so that decoding gives back the same text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import sentencepiece

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Stands for a U+2581 of the text; a lone surrogate cannot be part of a valid text.
LITERAL_MARK = "\udc01"
UNKNOWN_PENALTY = 10.0
#: Words up to this many characters are remembered, up to so many words per task.
MEMO_CHARS = 48
MEMO_WORDS = 400_000

_MARKED = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass(frozen=True)
class Vocabulary:
    """``scores``: piece -> (score, id); ``byte_ids``: id of each byte; ``raw``: id -> bytes."""

    scores: dict[str, tuple[float, int]]
    byte_ids: tuple[int, ...]
    raw: tuple[bytes, ...]
    unknown: float
    longest: int


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, byte_ids, raw = {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            raw.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            if re.search(f"[^{MARK}]{MARK}", piece):
                raise ValueError(f"piece {piece!r} runs over a word's start")
            scores[piece] = (model.get_score(i), i)
            raw.append(piece.replace(MARK, " ").encode())
    if not all(byte_ids):
        raise ValueError("the model has no byte pieces for characters it lacks")
    lowest = min(score for score, _ in scores.values())
    return Vocabulary(scores, tuple(byte_ids), tuple(raw), lowest - UNKNOWN_PENALTY, max(map(len, scores)))


def marked_words(text: str | None) -> list[str]:
    if not text:
        return []
    return _MARKED.findall(MARK + text.replace(MARK, LITERAL_MARK).replace(" ", MARK))


def character_bytes(character: str) -> bytes:
    return (MARK if character == LITERAL_MARK else character).encode()
