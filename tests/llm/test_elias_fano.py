import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillpair.llm.elias_fano import EliasFano, map_arrays, pack_arrays


def _mapped(values, bound):
    raw = pack_arrays(EliasFano.of(values, bound).arrays())
    return EliasFano.from_arrays(*map_arrays(np.frombuffer(raw, np.uint8)))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=200), st.lists(st.integers(0, 2 ** 64 - 1), max_size=50))
def test_full_range(values, others):
    v = np.array(sorted(values), np.uint64)
    ef = _mapped(v, 1 << 64)
    if len(v):
        assert (ef.get(np.arange(len(v))) == v).all()
    q = np.array(values + others, np.uint64)
    want = [int(np.searchsorted(v, x)) if x in set(values) else -1 for x in q.tolist()]
    assert ef.find(q).tolist() == want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=300))
def test_dense_and_repeated(values):
    v = np.array(sorted(values), np.uint64)
    ef = _mapped(v, int(v[-1]) + 1)
    assert (ef.get(np.arange(len(v))) == v).all()
    q = np.arange(int(v[-1]) + 1, dtype=np.uint64)
    assert ef.find(q).tolist() == [int(np.searchsorted(v, x)) if x in set(values) else -1 for x in q.tolist()]


def test_size_of_a_sparse_sequence():
    v = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 100_000).astype(np.uint64))
    bits = 8 * len(pack_arrays(EliasFano.of(v, 1 << 40).arrays())) / len(v)
    assert bits < 2 + 40 - np.log2(len(v)) + 3
