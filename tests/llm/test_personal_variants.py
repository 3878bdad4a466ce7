"""What the tagger adds to the patterns: recall on other ways of writing, and nothing on ordinary numbers."""

import numpy as np
import pytest

from tradewind.llm import pii

WORDS = "the river walks under a green light and stone at noon with dots of dew for days".split()


def _digits(rng, n):
    return "".join(str(d) for d in rng.integers(0, 10, n))


def _card(rng):
    head = "4" + _digits(rng, 14)
    last = next(d for d in "0123456789" if pii.luhn(head + d))
    d = head + last
    return rng.choice(["", " ", "-"]).join(d[i:i + 4] for i in range(0, 16, 4))


def _item(rng, kind):
    if kind == 0:
        return f"{rng.choice(WORDS)}.{rng.choice(WORDS)}{rng.integers(99)}@{rng.choice(WORDS)}{rng.integers(9)}.example.{rng.choice(['org', 'com'])}"
    if kind == 1:
        return ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        return _card(rng)
    return f"+{rng.integers(1, 99)} {rng.integers(200, 999)} {rng.integers(200, 999)} {_digits(rng, 4)}"


def _around(rng, part):
    words = lambda: " ".join(rng.choice(WORDS, int(rng.integers(3, 40))))
    return f"{words()} {part} {words()}"


@pytest.fixture(scope="module")
def tagger(spark):
    rng = np.random.default_rng(11)
    rows = [(i, _around(rng, _item(rng, i % 4) if i % 3 else f"in {rng.integers(1900, 2030)} some {rng.integers(9)}.{rng.integers(99)} km"))
            for i in range(900)]
    return pii.train(spark.createDataFrame([*rows, (None, None)], "doc_id bigint, text string"))


def test_recall_of_other_ways_of_writing(spark, tagger):
    rng = np.random.default_rng(12)
    docs, want = [], {}
    for i in range(400):
        part = pii.varied(i % 4, _item(rng, i % 4), int(rng.integers(1000)))
        text = _around(rng, part)
        at = text.index(part)
        if not any(s < at + len(part) and e > at for _, s, e in pii.base_spans(text)):
            docs.append((i, text))
            want[i] = f"{pii.KINDS[i % 4]}:{at}:{at + len(part)}"
    got = {r["doc_id"]: r["spans"].split(",") for r in pii.find(spark.createDataFrame(docs, "doc_id bigint, text string"), tagger).collect()}
    for kind in range(4):
        ids = [i for i in want if i % 4 == kind]
        assert len(ids) > 50 and sum(want[i] in got[i] for i in ids) >= 0.9 * len(ids), pii.KINDS[kind]


def test_ordinary_numbers_and_words_stay(spark, tagger):
    rng = np.random.default_rng(13)
    parts = ["2024-01-15", "15.01.2024", "version 4.0", "meet me at noon. Then go", "a dot on the map", "1,234,567", "3 of 10 (at most 5)",
             "12:30-14:45", "pages 100-200", "", None]
    docs = [(i, None if p is None else _around(rng, p)) for i, p in enumerate(parts * 4)]
    got = pii.find(spark.createDataFrame(docs, "doc_id bigint, text string"), tagger).collect()
    assert len(got) == len(docs) and all(r["spans"] == "" for r in got)


def test_decoding_is_the_best_path():
    """Against all paths of a small model."""
    from itertools import product

    from tradewind.llm.tagger import Tagger

    rng = np.random.default_rng(6)
    model = Tagger(3, hidden=4)
    model.p["move"] = rng.normal(0, 1, (3, 3))
    x = rng.integers(0, 129, (4, 6))
    scores = model.emissions(x)[0]
    for row, path in zip(scores, model.decode(x), strict=True):
        value = lambda y: sum(row[t, k] for t, k in enumerate(y)) + sum(model.p["move"][a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
        assert tuple(path) == max(product(range(3), repeat=6), key=value)


def test_spans_over_window_borders_come_out_whole():
    class Marks:
        """Tags every digit run as a card, window by window, as a tagger would that sees only its window."""

        @staticmethod
        def decode(x):
            digit = (x >= 48) & (x <= 57)
            first = digit & ~np.pad(digit, ((0, 0), (1, 0)))[:, :-1]
            return np.where(first, 5, np.where(digit, 6, 0))

    number = "4000000000000002"
    assert pii.luhn(number)
    for lead in range(0, 150, 7):
        text = "1 " + "x " * lead + number + " y" * 40
        assert (2, text.index(number), text.index(number) + 16) in pii.added_spans([text], Marks(), [[]])[0]


def test_variants_keep_their_digits():
    rng = np.random.default_rng(14)
    for kind in range(4):
        for pick in range(30):
            got = _item(rng, kind)
            assert pii._digits(got).endswith(pii._digits(pii.varied(kind, got, pick)).lstrip("0"))  # a land's code may go
            assert pii.varied(kind, got, pick) != got
