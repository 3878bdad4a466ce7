"""Repeated passages against a table of all windows, the run-length index against all pairs of suffixes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tradewind.llm import passages, rindex

SCHEMA = "doc_id bigint, text string, row string, s int, marks int"  # extra columns with clashing names


def brute(docs, length):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[k:k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\x01" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, docs, length):
    table = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], SCHEMA).repartition(5)
    rows = passages.find(table, length).collect()
    for r in rows:
        assert r.n_removed == sum(e - s for s, e in zip(r.starts, r.ends)) and len(r.starts) == r.n_spans
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows], key=repr)


def corpus(seed):
    """Passages in changing surroundings, copies, near copies, runs of one letter, two-byte letters, short and empty texts."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [word(n) for n in (15, 25, 60, 200)]
    docs = []
    for k in range(60):
        parts = [word(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared)[rng.randint(0, 9):], word(rng.randint(0, 40))]
        docs.append((k, "".join(parts)))
    near = list(docs[5][1] * 2)
    near[len(near) // 2:len(near) // 2 + 1] = "X"
    return docs + [(100, "a" * 70), (101, "ab" * 40), (102, "a" * 21), (103, None), (104, ""), (105, "short"), (106, docs[3][1]),
                   (107, "".join(near)), (None, docs[4][1]), (None, None), (1, docs[7][1]), (2, docs[2][1]), (2, docs[2][1])]


@pytest.mark.parametrize("seed,hot,slice_,bucket", [(1, 1024, 1 << 20, 1 << 20), (2, 2, 1 << 20, 500), (3, 1024, 64, 2000), (4, 1, 50, 300)])
def test_equals_brute_force(spark, monkeypatch, seed, hot, slice_, bucket):
    for name, value in (("HOT", hot), ("SLICE", slice_), ("BUCKET", bucket), ("SALTED_ROWS", 3), ("STEP", 100)):
        monkeypatch.setattr(passages, name, value)
    docs = corpus(seed)
    assert found(spark, docs, 20) == brute(docs, 20)


def test_production_length(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = text(500)
    docs = [(k, text(300) + passage[k:200 + k + 7 * k] + text(100)) for k in range(12)] + [(50, text(199)), (51, "z" * 200), (52, "y" * 201)]
    docs.append((53, docs[50 - 38][1]))
    assert found(spark, docs, 200) == brute(docs, 200)


def test_empty_tables_and_no_repeats(spark):
    assert found(spark, [], 20) == []
    docs = [(1, "abcdefghijklmnopqrstuvwxyz"), (2, None)]
    assert found(spark, docs, 20) == brute(docs, 20)


def test_slices_choose_the_anchors_of_the_whole():
    rng = np.random.default_rng(2)
    text = bytes(rng.integers(97, 100, 3000, dtype=np.uint8))
    hasher = passages.Hasher()

    def anchors(step, monkey=passages):
        old, monkey.SLICE = monkey.SLICE, step
        try:
            got = [passages.anchors_of(s, 50, hasher) for s in passages._slices([b"", text, text[:49]], 50)]
        finally:
            monkey.SLICE = old
        return sorted(zip(*[np.concatenate(c).tolist() for c in zip(*got)]))

    assert anchors(1 << 20) == anchors(170) == anchors(33)
    assert len(set(p for _, p, _, _ in anchors(100))) == len(anchors(100))


def agree(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_index_and_statistics_equal_all_pairs():
    rng = random.Random(5)
    for _ in range(60):
        base = bytes(rng.choice(b"ab") for _ in range(25))
        strings = []
        for _ in range(rng.randint(0, 5)):
            s = bytearray(base[rng.randint(0, 10):rng.randint(10, 25)])
            if s and rng.random() < 0.7:
                s[rng.randrange(len(s))] = rng.choice(b"abc\x00\xff")
            strings.append(bytes(s))
        index = rindex.build(strings)
        tails = [(k, s[i:]) for k, s in enumerate(strings) for i in range(len(s))]
        want = [max([agree(t, u) for j, (_, u) in enumerate(tails) if j != i], default=0) for i, (_, t) in enumerate(tails)]
        assert rindex.matching_statistics(index).tolist() == want
        # the runs spell the transform of the sorted suffixes, shorter first where one begins the other
        order = sorted(range(len(tails)), key=lambda i: (tails[i][1], i))
        before = [tails[i - 1][1][0] if i and tails[i - 1][0] == tails[i][0] else -1 for i in order]
        assert np.repeat(index.byte, index.length).tolist() == before
        assert index.first.tolist()[:1] == order[:1] and index.last.tolist()[-1:] == order[-1:]


def test_repetitive_text_has_few_runs():
    base = bytes(np.random.default_rng(1).integers(97, 123, 400, dtype=np.uint8))
    one, many = (len(rindex.build([base] * n).byte) for n in (1, 50))
    assert many < 3 * one


def test_long_run_of_one_letter():
    who, start, end = passages.long_matches([b"a" * 100_000, b"b" * 10], 200)
    assert (who.tolist(), start.tolist(), end.tolist()) == ([0], [0], [100_000])
