"""The store of chunks: ids over stores cut down and words encoded together, and the memory of a worker."""

import random
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest

from tradewind.llm.tokens import Encoder, public_path
from tradewind.llm.words import shingle_sets, small

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
LETTERS = "abcdefghijklmnopqrstuvwxyzABCÉéèñöüß"


def _texts(seed, n):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices(LETTERS, k=draw.randint(1, 9)))
    tail = lambda: draw.choice(["", "", "", ",", ".", "###", "$$$", "|", "'s", "!?", "'", "...\n", "7", "-x", ",'", "\n<|", "|>", "<|endoftext|>"])
    plain = lambda: draw.choice(["", "", "", "", ",", ".", "###", "%%%", "\n"])
    some = [word() for _ in range(50)]
    return [" ".join((draw.choice(some) if draw.random() < 0.5 else word()) + (tail if k % 3 == 0 else plain)() for _ in range(draw.randint(0, 60)))
            .replace("\n ", "\n") for k in range(n)]


@pytest.mark.parametrize("kept", [8, 20_000, 1 << 25])
@pytest.mark.parametrize("name", NAMES)
def test_ids_over_a_store_cut_down(name, kept):
    coder = Encoder(public_path(name))
    coder.KEPT, coder.SLICE, coder.JOINED = kept, 1500, 7
    texts = _texts(kept, 300)
    for text, ids in zip(texts, coder.encode_many(texts), strict=True):
        assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, text
        assert coder.held <= kept + 2 * 1500 * coder.OWN


def test_marks_after_words_and_line_ends():
    for name in NAMES:
        coder = Encoder(public_path(name))
        for text in ["one## two,' three's! x|>\nfour.<|endoftext|> y$$", "one<|endoftext|>", "a[b] c]] d'll. e_ f`\n&g h", "é,, ÿ!! ×. ÷x."]:
            assert coder.encode(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_used_most_stay():
    coder = Encoder(public_path(NAMES[0]))
    coder.KEPT, coder.SLICE = 40_000, 500
    for text in _texts(5, 200):
        coder.encode("the of and " * 5 + text)
    assert {"the", "of"} <= set(coder.known) and len(coder.known) < 400


def test_worker_memory_is_bounded():
    """Millions of different words in one process, as in a worker that is used over and over."""
    code = """if True:
        import random, resource, sys
        from tradewind.llm.tokens import Encoder, public_path
        coder, draw = Encoder(public_path("byte_bpe_50k.json")), random.Random(1)
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        for _ in range(60):
            texts = [" ".join("%x" % draw.getrandbits(48) for _ in range(250)).translate({48 + i: 103 + i for i in range(10)}) for _ in range(60)]
            for ids in coder.encode_many(texts):
                pass
        print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
    """
    grown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(grown.stdout) < 70  # MB; 96 with a store of 96 MB begun anew when full


def test_few_rows_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1200))], names=["x"])
    parts = list(small([batch, batch.slice(0, 0)]))
    assert [len(p) for p in parts] == [512, 512, 176] and sum((p.column("x").to_pylist() for p in parts), []) == list(range(1200))


def test_shingles_of_a_large_batch_take_little_memory():
    code = """if True:
        import resource
        import numpy as np, pyarrow as pa
        from tradewind.llm import neardup
        draw = np.random.default_rng(1)
        text = lambda: " ".join("%x" % x for x in draw.integers(0, 1 << 40, 300).tolist())
        batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array([text() for _ in range(4000)])], names=["doc_id", "text"])
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        rows = sum(b.num_rows for b in neardup._census(iter([batch])))
        assert rows >= 4000
        print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
    """
    grown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(grown.stdout) < 60  # MB; 73 with slices of 2 MB and whole batches


def test_shingles_of_slices_are_those_of_the_batch():
    texts = pa.array([None if k % 11 == 0 else " ".join(_texts(k, 3)) for k in range(1100)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    whole = [s.tolist() for s in shingle_sets(batch.column("text"))]
    assert [s.tolist() for b in small([batch]) for s in shingle_sets(b.column("text"))] == whole


def test_a_worker_gives_memory_back():
    code = """if True:
        import re
        import numpy as np, pyarrow as pa
        from tradewind.llm.words import small
        held = lambda: int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10
        many = [np.ones(2500) for _ in range(10000)]
        many = many[-1:]
        before = held()
        list(small(iter([pa.RecordBatch.from_arrays([pa.array([1])], names=["x"])])))
        print(before - held())
    """
    back = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(back.stdout) > 100
