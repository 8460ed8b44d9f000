import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillpair.llm.coding import rice_decode, rice_encode


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**63), max_size=300))
def test_round_trip(values):
    v = np.array(sorted(values), np.uint64)
    assert (rice_decode(rice_encode(v)) == v).all()


def test_size_near_entropy():
    v = np.unique(np.random.default_rng(0).integers(0, 1 << 48, 10_000).astype(np.uint64))
    assert len(rice_encode(v)) * 8 / len(v) < 48 - np.log2(len(v)) + 2.5
