"""Words and segments of many texts at a time against those of one."""

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tallymart.llm import fm_substring
from tallymart.llm.rows import slices, word_codes

TEXTS = [b"", b" ", b"one", b"one two", b" Two\tone\n\ntwo ", b"\x1c \xc2\xa0x", b"y" * 300, b"y" * 301 + b" " + b"y" * 300, b""]


@pytest.mark.parametrize("lower", [False, True])
def test_words_of_many_texts(lower):
    found, counts, begin, end, data = word_codes(pa.array([b"skipped", *TEXTS], pa.binary()).slice(1), lower)
    words = [word for text in TEXTS for word in (text.lower() if lower else text).split()]
    assert counts.tolist() == [len(text.split()) for text in TEXTS]
    assert [data[a:b].tobytes() for a, b in zip(begin, end)] == words
    assert len(set(zip(words, found.tolist()))) == len(set(words)) == len(set(found.tolist()))
    assert [len(one) for one in word_codes(pa.array([], pa.binary()))[:2]] == [0, 0]


def test_transposed_letters_differ():
    words = [bytes(word) for word in combinations(b"abcdefgh", 4)] + [bytes(word)[::-1] for word in combinations(b"abcdefgh", 4)]
    assert len(set(word_codes(pa.array([b" ".join(words)]))[0].tolist())) == len(words)


def test_slices_hold_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS)], names=["text"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), 0, 300))
    assert [row for part in parts for row in part.column(0).to_pylist()] == TEXTS
    assert len(parts) > 1


def test_owners_of_windows_are_those_of_segments():
    draw = np.random.default_rng(1)
    segments = [draw.integers(0, 3, count).astype(np.uint64) for count in (5, 9, 6, 30)]
    owners, lengths = np.array([7, 3, 5, 1]), np.array([len(one) for one in segments])
    flat = fm_substring.owners_of_windows(np.concatenate(segments), lengths, owners, 4)
    assert flat.tolist() == np.concatenate(fm_substring.smallest_owners(segments, owners, 4)).tolist()
    every = [(tuple(one[at : at + 4]), owner) for one, owner in zip(segments, owners) for at in range(len(one) - 3)]
    assert flat.tolist() == [min(owner for other, owner in every if other == window) for window, _ in every]
