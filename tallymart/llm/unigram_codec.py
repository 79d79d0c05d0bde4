"""SentencePiece-style encoding and decoding with a unigram vocabulary.

A text gets a mark in front and marks for its spaces; Viterbi search over the pieces of a double-array
trie finds the segmentation with the highest sum of log scores. A character that no piece spells
is written as its UTF-8 bytes. As pieces have marks at their start only, a text is searched word
by word, with the same result as over the whole; words seen before come from a cache, new words are
searched in step with each other. Without that property of the pieces a text is searched whole.

Defined results: null and empty texts have no ids and decode to the empty text. Decoding gives back
the text, but for literal marks, which become spaces, as they do in the format itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.llm.pieces import MARK, MARK_BYTES, Edges, Vocabulary, read_vocabulary

WAITING = 30_000  # unknown words that are searched together
HELD = 250_000  # words, known or not, of the texts that wait
BLOCK_BYTES = 1 << 17  # bytes of words in one search
LONG_WORD = 512  # longer words are searched alone: the steps of a joint search are as many as its longest word has bytes

CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Codec:
    """Encoder and decoder; the cache keeps its short words when it holds ``most`` words. Whole texts, which a vocabulary
    with inner marks needs, count as words."""

    def __init__(self, vocab: Vocabulary, most: int = 300_000):
        self.vocab, self.edges, self.most, self.known = vocab, Edges(vocab), most, {}

    def best(self, data: bytes) -> list[int]:
        """Ids of the best segmentation; of equal ones the piece that starts first stays the longest."""
        size = len(data)
        score, back = [-np.inf] * (size + 1), [None] * (size + 1)
        score[0] = 0.0
        for start in range(size):
            if score[start] == -np.inf:
                continue
            for end, one, cost in self.edges.at(data, start):
                if score[start] + cost > score[end]:
                    score[end], back[end] = score[start] + cost, (start, one)
        ids, end = [], size
        while end:
            start, one = back[end]
            ids.extend([one] if one >= 0 else [self.vocab.bytes_[b] for b in reversed(data[start:end])])
            end = start
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of every text, in order. The texts wait until they hold ``WAITING`` unknown words, which are then searched
        together, or ``HELD`` words in all."""
        held, new, words = [], set(), 0
        for text in texts:
            parts = self._parts(text)
            held.append(parts)
            new.update(set(parts).difference(self.known))
            words += len(parts)
            if len(new) >= WAITING or words >= HELD:
                yield from self._placed(held, new)
                held, new, words = [], set(), 0
        yield from self._placed(held, new)

    def _parts(self, text: str) -> list[bytes | str]:
        """What a text falls into, left to right: plain words (for the cache), or bytes with their marks in place."""
        if not text:
            return []
        if not self.vocab.splits:
            return [(MARK + text.replace(" ", MARK)).encode()]
        parts = text.split(" ")
        if "" in parts or MARK in text:
            return [chunk.encode() for chunk in CHUNK.findall(MARK + text.replace(" ", MARK))]
        return parts

    def _placed(self, held: list[list[bytes | str]], new: set[bytes | str]) -> Iterator[bytes]:
        known = self.known
        if len(known) > self.most:
            self.known = known = {w: i for w, i in known.items() if len(w) <= 6}
            new = {part for parts in held for part in parts if part not in known}
        self._learn(list(new))
        for parts in held:
            yield b"".join(map(known.__getitem__, parts))

    def _learn(self, parts: list[bytes | str]) -> None:
        """Put the ids of new parts into the cache, short ones in blocks of ``BLOCK_BYTES``."""
        coded = [part if isinstance(part, bytes) else (MARK + part).encode() for part in parts]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        for at in np.flatnonzero(sizes > LONG_WORD).tolist():
            self.known[parts[at]] = np.array(self.best(coded[at]), "<i4").tobytes()
        short = np.flatnonzero(sizes <= LONG_WORD)
        block = np.cumsum(sizes[short]) // BLOCK_BYTES
        for places in np.split(short, np.flatnonzero(np.diff(block)) + 1):
            if len(places):
                at = places.tolist()
                blob, cuts = self.lockstep([coded[i] for i in at])
                ends = (cuts * 4).tolist()
                self.known.update((parts[i], blob[low:high]) for i, low, high in zip(at, ends, ends[1:]))

    def lockstep(self, words: list[bytes]) -> tuple[bytes, np.ndarray]:
        """Ids of all words one after another, and where each word's ids start and end: the search of ``best`` for many
        words at once, with the same sums in the same order.

        All places of all words go down the trie together, a byte a step. Then the words take their first place
        together, their second, and so on: the edges of one place end at different places, so no two of a step meet.
        """
        vocab = self.vocab
        size = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(size)
        data = np.frombuffer(b"".join(words), np.uint8)
        total = len(data)
        limit = np.repeat(stop, size)  # where the word of a place ends
        place = np.arange(total) - np.repeat(stop - size, size)  # place in the word
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[heads]
        width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        single = np.zeros(total, bool)
        wide = np.zeros(total, np.int64)
        wide[heads] = width
        starts, ends, pieces = [], [], []
        at, slot, here = heads, np.zeros(len(heads), np.int64), heads
        while len(at):
            base = vocab.base[slot].astype(np.int64)
            nxt = base + data[here]
            on = (base > 0) & (vocab.check[nxt] == slot)
            at, slot, here = at[on], nxt[on], here[on] + 1
            piece = vocab.value[slot]
            hit = piece >= 0
            starts.append(at[hit])
            ends.append(here[hit])
            pieces.append(piece[hit])
            single[at[hit & (here - at == wide[at])]] = True
            on = here < limit[at]
            at, slot, here = at[on], slot[on], here[on]
        bare = heads[~single[heads]]  # no piece spells the character
        starts.append(bare)
        ends.append(np.minimum(bare + wide[bare], limit[bare]))
        pieces.append(np.full(len(bare), -1, vocab.value.dtype))
        start, end, piece = (np.concatenate(c) for c in (starts, ends, pieces))
        cost = np.where(piece >= 0, vocab.score[piece], self.edges.byte_score * (end - start))
        order = np.argsort(place[start].astype(np.min_scalar_type(int(size.max()))), kind="stable")
        start, end, piece, cost = start[order], end[order], piece[order], cost[order]
        steps = np.searchsorted(place[start], np.arange(int(size.max()) + 1))
        # the state after byte e of a word stands at e; a word's first places take 0 from no state
        score = np.full(total, -np.inf)
        back = np.zeros(total, np.int64)
        taken = np.full(total, -1, np.int64)
        for step, (low, high) in enumerate(zip(steps, steps[1:])):
            if low == high:
                continue
            s, e = start[low:high], end[low:high] - 1
            value = cost[low:high] + (score[s - 1] if step else 0.0)
            more = value > score[e]
            e = e[more]
            score[e], back[e], taken[e] = value[more], s[more], piece[low:high][more]
        ids = np.full(total, -1, np.int64)
        by_byte = np.array(vocab.bytes_, np.int64)
        last = stop - 1
        while len(last):
            first, one = back[last], taken[last]
            plain = one >= 0
            ids[first[plain]] = one[plain]
            spelled, upto = first[~plain], last[~plain]
            for k in range(4):
                at = spelled + k
                at = at[at <= upto]
                ids[at] = by_byte[data[at]]
            last = (first - 1)[place[first] > 0]
        some = ids >= 0
        cuts = np.concatenate(([0], np.cumsum(some)[stop - 1]))
        return ids[some].astype("<i4").tobytes(), cuts

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.vocab.text.__getitem__, ids)).replace(MARK_BYTES, b" ")
        return data.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One for each worker process."""
    return Codec(read_vocabulary(path))


def encode(text: str | Column, model: str) -> Column:
    """The ids of every text; ``model``: a SentencePiece model file that every executor can read."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coded = codec(model)
        for batch in batches:
            yield _encoded(coded, batch)
            pa.default_memory_pool().release_unused()

    return run.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def decode(ids: str | Column, model: str) -> Column:
    """The text of every list of ids; null counts as empty."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coded = codec(model)
        for batch in batches:
            yield _decoded(coded, batch)
            pa.default_memory_pool().release_unused()

    return run.asNondeterministic()(F.col(ids) if isinstance(ids, str) else ids)


def recode(text: str | Column, model: str) -> Column:
    """``encode`` and ``decode`` of its ids, as a struct of ``ids`` and ``text``, in one worker: two functions in a row
    would keep two workers, each with its own vocabulary, beside every task."""

    @F.arrow_udf("ids array<int>, text string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coded = codec(model)
        for batch in batches:
            ids = _encoded(coded, batch)
            yield pa.StructArray.from_arrays([ids, _decoded(coded, ids)], ["ids", "text"])
            pa.default_memory_pool().release_unused()

    return run.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def _encoded(coded: Codec, texts: pa.Array) -> pa.ListArray:
    rows = list(coded.encode_all(value.as_py() or "" for value in texts))
    offsets = np.cumsum([0, *(len(row) // 4 for row in rows)]).astype(np.int32)
    ids = np.frombuffer(b"".join(rows), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def _decoded(coded: Codec, lists: pa.ListArray) -> pa.Array:
    cuts, ids, gone = np.asarray(lists.offsets), np.asarray(lists.values), lists.is_null().to_pylist()
    rows = zip(cuts, cuts[1:], gone)
    return pa.array([coded.decode([] if null else ids[low:high].tolist()) for low, high, null in rows], pa.string())


def byte_pieces(ids: str | Column, model: str) -> Column:
    """How many of the ids are byte pieces."""
    low, high = min(read_vocabulary(model).bytes_), max(read_vocabulary(model).bytes_)
    return F.size(F.filter(ids, lambda one: one.between(low, high))).cast("long")
