"""What tokenizing holds in a worker, and which chunks are encoded at all."""

import random
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest

from tradewind.llm.tokens import Encoder, public_path

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


def test_words_at_line_starts_are_no_other_words():
    coder = Encoder(public_path(WORD))
    text = "One two.\ntwo three\nOne, four"
    assert coder.encode(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert set(coder.known) <= {"one", "two", "three", "four", "\0.", "\0,"}


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_columns_with_nulls_slices_and_control_characters(name):
    coder = Encoder(public_path(name))
    draw = random.Random(3)
    texts = [None, "", "\2a \2b", "a \2a\2b b", " x", "\0", "\0a b", "a b", "x\n", "日本 語 \n 字", "a  b", "\2", " ", "Ünder den\nÄsten, oft. Ja"]
    texts += ["".join(draw.choice(["\2", "a", "b", " ", "\0", "\n", "é", "語", ",", "."]) for _ in range(draw.randint(1, 12))) for _ in range(3000)]
    want = [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for column in (texts, pa.array(texts), pa.array(["before", *texts], pa.large_string())[1:]):
        assert [ids.tolist() for ids in coder.encode_many(column)] == want


def test_store_of_words_is_small():
    """Half a million different words leave a store of at most 30 MB behind, not strings and numbers of Python."""
    code = """if True:
        import random, re
        import pyarrow as pa
        from tradewind.llm.tokens import Encoder, public_path
        from tradewind.llm.words import release
        held = lambda: int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10
        coder, draw = Encoder(public_path("byte_bpe_50k.json")), random.Random(1)
        release()
        before = held()
        for _ in range(40):
            texts = pa.array([" ".join("%x" % draw.getrandbits(48) for _ in range(250)).translate({48 + i: 103 + i for i in range(10)}) for _ in range(50)])
            for ids in coder.encode_many(texts.to_pylist()):
                pass
        del texts, ids
        release()
        print(held() - before)
    """
    grown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(grown.stdout) < 30
