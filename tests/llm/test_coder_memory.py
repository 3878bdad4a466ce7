"""What coding a block of ids takes."""

import tracemalloc

import numpy as np

from tradewind.llm import codec


def test_a_block_is_coded_in_little_memory():
    ids = np.random.default_rng(2).geometric(0.001, 1 << 20).clip(max=40_000).astype(np.uint32)
    tracemalloc.start()
    block = codec.encode(np.array([1]), np.array([len(ids)]), ids)
    coding = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.reset_peak()
    assert (codec.decode(block)[2] == ids).all()
    decoding = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    assert coding < 40 and decoding < 40, (coding, decoding)
