import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recado.llm import words as wd

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.text(alphabet=st.sampled_from(list("abAB é\t\n\x0b\x1f\xa0漢")), max_size=40)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6), st.integers(3, 12))
def test_words_are_those_of_the_pattern_whatever_the_piece(texts, piece):
    was, wd.PIECE = wd.PIECE, piece
    try:
        found = wd.words_of(pa.array(texts, pa.string()), None, wd.lower_ascii())
    finally:
        wd.PIECE = was
    expected = [WORD.findall(t or "") for t in texts]
    assert [b - a for a, b in found.bounds()] == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    names = dict(zip(flat, found.hashes[0].tolist(), strict=True))
    assert [names[w] for w in flat] == found.hashes[0].tolist()
    assert len(set(names.values())) == len(names)
    lower = {}
    for w, h in zip(flat, found.hashes[1].tolist(), strict=True):
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
        assert lower.setdefault(key, h) == h
    assert found.sizes.tolist() == [len(w.encode()) for w in flat]


def test_a_word_hash_does_not_depend_on_its_place():
    a = wd.words_of(pa.array(["x " * 5000 + "needle"]), None).hashes[0][-1]
    assert a == wd.words_of(pa.array(["needle"]), None).hashes[0][0]


@pytest.mark.parametrize("size", [1, 10, 10_000])
def test_small_batches_hold_all_rows_in_order(size):
    batch = pa.record_batch({"t": ["a" * n for n in (0, 5, 900, 1, 0, 30)]})
    parts = list(wd.small_batches(batch, "t", size))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


def test_sliced_arrays():
    whole = pa.array(["a b", "c", None, "d e f"])
    assert np.array_equal(wd.words_of(whole.slice(1), None).ends, [1, 1, 4])
