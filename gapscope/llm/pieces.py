"""A SentencePiece vocabulary: pieces and scores, where texts can be cut, and decoding.

The model file's path is a parameter. It is read on the driver; tasks get
the pieces, a table bounded by the vocabulary's size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

SPACE = "▁"
#: What an unknown character costs beyond the lowest score.
UNKNOWN_PENALTY = 10.0
#: Characters tried as cutting points beside the space.
_TRIED = "\n\t.,;:!?|#$%*&<>()[]{}\"'-_=+/\\~^`@0123456789"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """``pieces``: text to (id, score). ``byte_ids``: ids of the 256 byte pieces, for characters without a piece."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    spelled: list[bytes]
    unknown_score: float = 0.0
    longest: int = 1
    cuts: re.Pattern = field(default=None)

    @classmethod
    def load(cls, path: str | None = None) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or default_model())
        pieces, byte_ids, spelled = {}, [0] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                byte_ids[value] = i
                spelled.append(bytes([value]))
            elif model.is_control(i) or model.is_unused(i):
                spelled.append(b"")
            elif model.is_unknown(i):
                spelled.append(" ⁇ ".encode())
            else:
                pieces[piece] = (i, model.get_score(i))
                spelled.append(piece.replace(SPACE, " ").encode())
        return cls.of(pieces, byte_ids, spelled)

    @classmethod
    def of(cls, pieces, byte_ids, spelled) -> Vocabulary:
        least = min((s for _, s in pieces.values()), default=0.0)
        made = cls(pieces, byte_ids, spelled, least - UNKNOWN_PENALTY, max(map(len, pieces), default=1))
        made.cuts = made.cutting_pattern()
        return made

    def cutting_pattern(self) -> re.Pattern:
        """Segments that no piece reaches across, so each has a best path of its own.

        A space belongs to what follows it, if no piece has one after another
        character. A character no piece joins to letters makes segments with
        its like. With a vocabulary without such cuts a text is one segment.
        """
        several = [p for p in self.pieces if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in several):
            return re.compile("(?s).+")
        apart = {c for c in _TRIED}
        for p in several:
            inside = p.lstrip(SPACE)
            if any(c not in _TRIED for c in inside):
                apart -= set(inside)
        # a run of set-apart characters must not join one that is not
        while joined := {c for p in several for c in set(p.lstrip(SPACE)) & apart if set(p.lstrip(SPACE)) - apart}:
            apart -= joined
        some = "".join(re.escape(c) for c in sorted(apart))
        return re.compile(f"(?s) *[^ {some}]+| *[{some}]+| +" if some else "(?s) *[^ ]+| +")

    def segments(self, text: str) -> list[str]:
        """The text, behind the model's leading space, cut into independent segments; a space marks a word's start."""
        return self.cuts.findall(" " + text.replace(SPACE, " ")) if text else []

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


def decoded(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of consecutive id lists: list i is ``ids[offsets[i]:offsets[i + 1]]``."""
    table = np.frombuffer(b"".join(vocabulary.spelled), np.uint8)
    sizes = np.array([len(s) for s in vocabulary.spelled], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    width = sizes[ids]
    at = np.concatenate([[0], np.cumsum(width)])
    source = np.repeat(starts[ids] - at[:-1], width) + np.arange(at[-1])
    data, bounds = table[source].tobytes(), at[offsets]
    # the leading space is the model's own
    texts = [data[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return pa.array([(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in texts], pa.string())
