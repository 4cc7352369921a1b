"""Words of different lengths advance together in the piece encoder."""

import os

import pytest

from orbitfit.llm import pieces


@pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no piece model here")
def test_words_of_all_lengths_advance_together():
    encoder = pieces.Encoder(pieces.load())
    words = sorted({pieces.MARK + w for w in "a be the cat thing zzz xyzzy Überfall réunion 漢字 interesting quickly".split()},
                   key=len, reverse=True)
    got = encoder.viterbi(words)
    plain = [encoder.greedy(w) for w in words]
    assert sum(g is not None for g in got) > len(words) / 2
    assert all(g is None or g == p for g, p in zip(got, plain))
