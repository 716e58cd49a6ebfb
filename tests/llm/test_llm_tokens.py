import numpy as np
import plain
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from murmur.llm.tokens import NOT_ALNUM, SPACE, pieces, words

TEXTS = st.lists(st.none() | st.text(st.sampled_from("aAbé \t\n.9-z\x0b漢\x7f"), max_size=30),
                 max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([1, 20, 1 << 20]))
def test_words_and_windows_equal_the_plain_ones(texts, size):
    for stops, plain_words in ((SPACE, plain.space_words), (NOT_ALNUM, plain.alnum_words)):
        found, windows = [], []
        for _, _, data, bounds in pieces(pa.array(texts, pa.string()), size):
            w = words(data, bounds, stops)
            at, hashes = w.windows(2)
            for d in range(len(bounds) - 1):
                lo, hi = w.offsets[d], w.offsets[d + 1]
                found.append([w.text(i, i + 1).decode() for i in range(lo, hi)])
                windows.append(hashes[(at >= lo) & (at < hi)].tolist())
        expected = [plain_words(t) for t in texts]
        assert found == expected
        pairs = [list(zip(w, w[1:])) for w in expected]
        assert [len(x) for x in windows] == [len(p) for p in pairs]
        known = dict(zip((p for own in pairs for p in own), (h for own in windows for h in own)))
        assert all(known[p] == h for own, hs in zip(pairs, windows) for p, h in zip(own, hs))
        assert len(set(known.values())) == len(known)


def test_a_slice_of_a_column_keeps_its_own_rows():
    column = pa.array(["a b", "c", None, "d e"]).slice(1, 3)
    (_, _, data, bounds), = pieces(column)
    w = words(data, bounds, SPACE)
    assert np.diff(w.offsets).tolist() == [1, 0, 2]
