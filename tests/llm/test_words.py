import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ashgrid.llm import words as W
from tests.llm.helpers import LONG, words

TEXT = st.text(alphabet="abcXYZÄéñ 09.,!?-\n\t“—", max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_equal_a_pattern(texts):
    got = []
    for w in W.chunks(pa.array(texts, pa.string()), size=40):
        for i in range(w.hi - w.lo):
            got.append([bytes(w.data[w.start[k]:w.end[k]]).decode()
                        for k in range(w.first[i], w.first[i + 1])])
    assert got == [words(t) for t in texts]


def test_hashes_do_not_depend_on_place_or_chunk():
    texts = ["alpha beta gamma delta epsilon zeta", "", "x " * 50 + "alpha beta gamma delta epsilon zeta"]
    whole = [w for w in W.chunks(pa.array(texts))]
    single = [w for t in texts for w in W.chunks(pa.array([t]))]
    joined = np.concatenate([w.hash for w in single])
    assert (np.concatenate([w.hash for w in whole]) == joined).all()
    first, _ = single[0].grams(5)
    last, offsets = single[2].grams(5)
    assert len(first) == 2 and (last[-2:] == first).all() and offsets.tolist() == [0, 52]


def test_short_texts_have_one_run_and_empty_ones_none():
    w = next(W.chunks(pa.array(["one two", "", None, "one two", "two one"])))
    h, offsets = w.grams(5)
    assert np.diff(offsets).tolist() == [1, 0, 0, 1, 1]
    assert h[0] == h[1] != h[2]


def test_long_text_is_a_chunk_of_its_own():
    sizes = [(w.lo, w.hi) for w in W.chunks(pa.array(["a b", LONG, "c"]), size=1000)]
    assert sizes == [(0, 1), (1, 2), (2, 3)]


def test_slices_of_larger_arrays_are_read_right():
    column = pa.array(["zero", "one two", None, "three"])[1:]
    w = next(W.chunks(column))
    assert np.diff(w.first).tolist() == [2, 0, 1]
