"""A subword vocabulary with log scores and its double-array trie."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

MARK = "▁"  # stands for a space
MARK_BYTES = MARK.encode()


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value of every slot. The child of slot s by byte c is t = base[s] + c if check[t] is s; the
    value of a slot is that of the key ending there, or -1. Slot 0 is the root."""
    children: dict[bytes, set[int]] = {b"": set()}
    for key in keys:
        for end in range(len(key)):
            children.setdefault(key[:end], set()).add(key[end])
    size = 4096
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    free, top = 1, 1  # first free slot; first slot above all that are taken
    todo = [(b"", 0)]
    while todo:
        prefix, slot = todo.pop()
        value[slot] = keys.get(prefix, -1)
        codes = sorted(children.get(prefix, ()))
        if not codes:
            continue
        while check[free] >= 0:
            free += 1
        # an only child fills a gap; brothers try a few places at the upper end, then go above it
        at = max(1, (free if len(codes) == 1 else max(free, top - 256)) - codes[0])
        for _ in range(64):
            if all(check[at + c] < 0 for c in codes):
                break
            at += 1
        else:
            at = max(1, top - codes[0])
        base[slot] = at
        for c in codes:
            check[at + c] = slot
            todo.append((prefix + bytes([c]), at + c))
        top = max(top, at + codes[-1] + 1)
        if top + 1024 > len(check):
            for column, blank in ((base, 0), (check, -1), (value, -1)):
                column.extend([blank] * len(column))
    last = max(i for i, owner in enumerate(check) if owner >= 0) + 257
    return tuple(np.array((c + [-1] * last)[:last], np.int32) for c in (base, check, value))


@dataclass(frozen=True)
class Vocabulary:
    """``text``: bytes that a piece stands for; ``score``: its natural log score; ``bytes_``: ids of the 256 byte pieces."""

    text: list[bytes]
    score: np.ndarray
    bytes_: list[int]
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    splits: bool  # no piece has a mark after another character
    byte_ids: frozenset[int] = field(default_factory=frozenset)


def vocabulary(pieces: list[tuple[str, float]], byte_ids: list[int], skipped: set[int] = frozenset()) -> Vocabulary:
    """From (piece, log score) by id. ``byte_ids``: ids of the byte pieces, by byte; ``skipped``: ids that never stand for text."""
    place = {one: byte for byte, one in enumerate(byte_ids)}
    text = [bytes([place[i]]) if i in place else (b"" if i in skipped else p.encode()) for i, (p, _) in enumerate(pieces)]
    keys = {t: i for i, t in enumerate(text) if i not in place and i not in skipped and t}
    splits = all(MARK not in p.lstrip(MARK) for i, (p, _) in enumerate(pieces) if i not in place and i not in skipped)
    score = np.array([s for _, s in pieces], np.float64)
    return Vocabulary(text, score, list(byte_ids), *double_array(keys), splits, frozenset(byte_ids))


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> Vocabulary:
    """Pieces of a SentencePiece model file.

    The scores of a file that was made by merging are ranks (0, -1, -2, ...), not probabilities. Piece
    frequencies fall about as one over the rank, so the log score of a piece is minus the log of its rank,
    normalised over the vocabulary.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    skipped = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    skipped -= set(byte_ids)
    rank = np.array([-model.get_score(i) for i in ids]) + 2
    plain = np.array([i not in skipped and not model.is_byte(i) for i in ids])
    score = -np.log(np.maximum(rank, 1))
    score -= np.log(np.exp(score[plain]).sum())
    # a byte costs as much as the rarest piece and a factor of ten more
    score[byte_ids] = score[plain].min() - np.log(10)
    return vocabulary([(model.id_to_piece(i), float(score[i])) for i in ids], byte_ids, skipped)


class Edges:
    """All pieces that start at a place of a byte string; plain lists, as they are read one slot at a time."""

    def __init__(self, vocab: Vocabulary):
        self.base, self.check, self.value = vocab.base.tolist(), vocab.check.tolist(), vocab.value.tolist()
        self.score, self.byte_score = vocab.score.tolist(), float(vocab.score[vocab.bytes_[0]])

    def at(self, data: bytes, start: int) -> list[tuple[int, int, float]]:
        """(end, id, score) of every edge from ``start``; where no piece is the character itself, an edge with id -1
        takes it byte by byte."""
        base, check, value, score = self.base, self.check, self.value, self.score
        first = data[start]
        width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        found, slot, end, single = [], 0, start, False
        for byte in data[start : start + 256]:
            nxt = base[slot] + byte
            if not base[slot] or check[nxt] != slot:
                break
            slot, end = nxt, end + 1
            one = value[slot]
            if one >= 0:
                single = single or end - start == width
                found.append((end, one, score[one]))
        if not single:
            end = min(start + width, len(data))
            found.append((end, -1, self.byte_score * (end - start)))
        return found
