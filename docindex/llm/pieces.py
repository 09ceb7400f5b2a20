"""A SentencePiece vocabulary as weighted pieces over plain text.

Pieces are kept with spaces in place of the vocabulary's space mark, so a space
mark that a text itself holds is no piece and falls back to bytes: decoding gives
back every text. A text is read with one space before it. No piece reaches across
the end of a word (a space after anything else) or a line feed, or from a letter or
digit to a mark that no piece has beside one, so a text falls into *units* whose
segmentations are independent.
"""

from __future__ import annotations

import math
import re

import numpy as np
import public_tokenizers
import sentencepiece

VOCABULARY_FILE = "piece_bpe_32k.model"
SPACE_MARK = "▁"
UNIT = re.compile(r" *[^ \n]+| +|\n")
_MARKS = "!\"#$%&()*+,./:;<=>?@[]^`{|}~"


class Trie:
    """Pieces as arrays: sorted keys ``node << 21 | character``, the node that each
    leads to, and per node the id (-1: none) and log-weight of the piece it ends."""

    def __init__(self, ids: dict[str, tuple[int, float]]) -> None:
        nodes: dict[tuple[int, str], int] = {}
        ends: dict[int, tuple[int, float]] = {}
        for piece, end in ids.items():
            node = 0
            for char in piece:
                node = nodes.setdefault((node, char), len(nodes) + 1)
            ends[node] = end
        edges = sorted(((node << 21) | ord(char), child) for (node, char), child in nodes.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.next = np.array([n for _, n in edges], np.int64)
        self.piece = np.full(len(nodes) + 1, -1, np.int64)
        self.weight = np.zeros(len(nodes) + 1)
        for node, (i, weight) in ends.items():
            self.piece[node], self.weight[node] = i, weight


class Pieces:
    """Pieces with their ids and log-weights, and the bytes of every id.

    The vocabulary orders pieces by rank; weights follow Zipf's law on it, and a
    byte of a character without a piece weighs as much as the last piece.
    """

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids: dict[str, tuple[int, float]] = {}
        self.byte_ids = [0] * 256
        self.bytes_of: list[bytes] = [b""] * size
        rank = 0
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i)):
                plain = piece.replace(SPACE_MARK, " ")
                if len(UNIT.findall(plain)) > 1:
                    raise ValueError(f"{path}: the piece {piece!r} reaches across a word")
                rank += 1
                self.ids[plain] = (i, -math.log(rank + 1))
                self.bytes_of[i] = plain.encode()
        self.longest = max(map(len, self.ids))
        self.byte_weight = -math.log(rank + 1)
        # Marks that no piece has beside a letter or digit: words end there.
        beside = {c for p in self.ids for a, b in zip(p, p[1:]) for c, d in ((a, b), (b, a)) if d.isalnum()}
        apart = re.escape("".join(m for m in _MARKS if m not in beside))
        self.cut = re.compile(rf"(?<=[^\W_])(?=[{apart}])|(?<=[{apart}])(?=[^\W_])") if apart else None
        self.trie = Trie(self.ids)

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        parts = self.cut.split(" " + text) if self.cut else [" " + text]
        return [unit for part in parts for unit in UNIT.findall(part)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:]


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY_FILE)
