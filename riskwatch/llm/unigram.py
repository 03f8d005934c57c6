"""A unigram vocabulary from a sentencepiece model file, and marked words.

The box holds no file of the unigram kind and no tokenizer is trained here, so
the pieces and scores of the given model are read as a unigram vocabulary. The
rules are those of the unigram tokenizers: a place is reached by the best total
score; of equal ones the piece that starts first wins; a character that is no
piece itself may also be passed as unknown, at ten below the lowest score, and
falls back to its bytes.

Pieces carry the space mark only at their start, so no piece crosses from one
marked word (marks and what follows them) into the next. The best path of a text
is the best paths of its words, one after another. Scores are whole numbers and
sums of doubles exact, so this holds to the last tie.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import sentencepiece

MARK = "▁"
PENALTY = 10.0
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass(frozen=True)
class Vocabulary:
    """``pieces``: text to (id, score); ``bytes_from``: id of byte 0."""

    pieces: dict[str, tuple[int, float]]
    unknown_score: float
    bytes_from: int
    texts: tuple[str, ...]

    @property
    def characters(self) -> frozenset[str]:
        return frozenset(p for p in self.pieces if len(p) == 1)


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, first_byte, texts = {}, -1, []
    for k in range(model.get_piece_size()):
        text = model.id_to_piece(k)
        texts.append(text)
        if model.is_byte(k):
            first_byte = k if first_byte < 0 else first_byte
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            pieces[text] = (k, model.get_score(k))
    if any(not re.fullmatch(f"{MARK}*[^{MARK}]*", p) for p in pieces):
        raise ValueError("a piece has a space mark behind another character")
    return Vocabulary(pieces, min(s for _, s in pieces.values()) - PENALTY, first_byte, tuple(texts))


def marked_words(text: str) -> list[str]:
    """The text's words as keys: a word's mark is left out if it is the usual one.

    ``marked`` gives the word back. An empty text has no words.
    """
    if not text:
        return []
    if MARK not in text and text[0] != " " and text[-1] != " " and "  " not in text:
        return text.split(" ")
    words = _WORD.findall(MARK + text.replace(" ", MARK))
    return [w[1:] if len(w) > 1 and w[1] != MARK else w for w in words]


def marked(key: str) -> str:
    return key if key.startswith(MARK) else MARK + key
