"""Token ids as blocks of an adaptive context-mixing range coder, in numpy.

A block holds whole documents. Its ids are cut into lanes, equal runs that are coded side by side, one id of each lane
at a step, so every operation is on a vector. All lanes of a block share one model, which starts empty and is updated
after each step by all of them:

* order 2 and order 1 each predict one id from the two ids, or the one id, before, with a confidence that grows with
  every hit and falls with every miss;
* the confidences (and whether both predict the same) choose counters that mix them: how often the order-2 prediction
  was right there, the order-1 prediction, or neither;
* an id that neither predicts is coded by order-0 counts of all ids.

Counters are whole numbers, so encoder and decoder agree on any machine. Each lane drives a range coder of 48 bits with
digits of 16 bits. A block can be read without any other, and ends with the CRC-32 of all its bytes.

Layout, little-endian: magic ``TWI1``; u32 documents, ids, vocabulary, lanes, steps; per document i64 doc_id and i64
ids, with i64 ids before it in the block implied; per lane u32 digits; all digits u16, lane by lane; u32 checksum.
A null doc_id is written as -2^63.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TWI1"
NO_ID = -(2**63)
LANES, LEAST = 4096, 256
_HASHED = 18
_SURE = 7
_TOP, _LOW, _DIGIT = 48, 32, 16
_FAST, _CAP = 24, 1 << 15
_GAIN, _FRESH = 8, 8


class _Model:
    """A table entry is an id, shifted by three bits, and its confidence."""

    def __init__(self, vocabulary: int, lanes: int):
        self.second, self.first = np.zeros(1 << _HASHED, np.int32), np.zeros(vocabulary, np.int32)
        self.mixed = np.full((3, (_SURE + 1) * (_SURE + 1) * 2), 4, np.int64)
        self.count = np.ones(vocabulary, np.int64)
        self.below = np.zeros(vocabulary + 1, np.int64)
        self.step = 0
        self.two, self.one = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self._refresh()

    def _refresh(self) -> None:
        np.cumsum(self.count, out=self.below[1:])

    def look(self):
        """Guesses of order 2 and of order 1 for each lane, and the counters of being right: order 2, order 1, neither."""
        self.at = (self.two * 40503 + self.one * 2654435761 >> 7) & ((1 << _HASHED) - 1)
        self.seen2, self.seen1 = self.second.take(self.at), self.first.take(self.one)
        self.guess2, self.guess1 = self.seen2 >> 3, self.seen1 >> 3
        self.row = (((self.seen2 & 7) << 4) + ((self.seen1 & 7) << 1) + (self.guess2 == self.guess1)).astype(np.int64)
        three = (self.mixed[0] | self.mixed[1] << 20 | self.mixed[2] << 40).take(self.row)  # one look for three
        return self.guess2, self.guess1, three & 0xFFFFF, three >> 20 & 0xFFFFF, three >> 40

    def learn(self, ids: np.ndarray, kind: np.ndarray) -> None:
        rows = self.mixed.shape[1]
        self.mixed += _FAST * np.bincount(kind * rows + self.row, minlength=3 * rows).reshape(3, rows)
        full = np.flatnonzero(self.mixed.sum(0) > _CAP)
        if len(full):
            self.mixed[:, full] = (self.mixed[:, full] + 1) >> 1
        new = ids.astype(np.int32)
        fresh = (new << 3) | 1
        for table, at, seen, guess in ((self.second, self.at, self.seen2, self.guess2), (self.first, self.one, self.seen1, self.guess1)):
            trust = seen & 7
            worse = np.where(trust == 0, fresh, seen - 1 - (trust > 3))
            table[at] = np.where(guess == new, seen + (trust < _SURE), worse)
        np.add.at(self.count, ids, _GAIN)
        self.step += 1
        if self.step % _FRESH == 0 or self.step < _FRESH:
            self._refresh()
        self.two, self.one = self.one, ids


def _over(x: np.ndarray, by) -> np.ndarray:
    """x // by of whole numbers up to 2^48: what a fraction lacks to the next whole number is more than a double rounds by."""
    return (x / by).astype(np.int64)


def _find(below: np.ndarray, goals: np.ndarray) -> np.ndarray:
    """The last place in ``below`` not above each goal; looked up in ascending order, which a cache likes."""
    bits = LANES.bit_length()
    goals = np.sort(goals << bits | np.arange(len(goals)))
    found = np.empty(len(goals), np.int64)
    found[goals & ((1 << bits) - 1)] = np.searchsorted(below, goals >> bits, "right") - 1
    return found


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // LEAST))
    return lanes, -(-n // lanes)


def encode(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    n = len(ids)
    lanes, steps = _shape(n)
    vocabulary = int(ids.max()) + 1 if n else 1
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Model(vocabulary, lanes)
    digits, filled = np.zeros((3 * steps + 4, lanes), np.int32), np.zeros(lanes, np.int64)  # lanes fill alike: few rows at a time
    low, wide = np.zeros(lanes, np.int64), np.full(lanes, 1 << _TOP, np.int64)

    def put(start, share, total, who) -> None:
        """Narrow the ranges of the lanes ``who``; None stands for all."""
        nonlocal low, wide
        mine, width = (low, wide) if who is None else (low[who], wide[who])
        r = _over(width, total)
        mine = mine + r * start
        width = r * share
        carry = np.flatnonzero(mine >> _TOP)
        if len(carry):
            lanes_ = carry if who is None else who[carry]
            digits[filled[lanes_] - 1, lanes_] += 1
            mine &= (1 << _TOP) - 1
        small = np.flatnonzero(width < 1 << _LOW)
        while len(small):
            lanes_ = small if who is None else who[small]
            top = mine[small]
            digits[filled[lanes_], lanes_] = top >> _LOW
            filled[lanes_] += 1
            mine[small] = (top & ((1 << _LOW) - 1)) << _DIGIT
            width[small] <<= _DIGIT
            small = small[width[small] < 1 << _LOW]
        if who is None:
            low, wide = mine, width
        else:
            low[who], wide[who] = mine, width

    everyone = np.arange(lanes)
    for now in grid:
        now = now.astype(np.int64)
        g2, g1, f0, f1, f2 = model.look()
        hit2, hit1 = now == g2, now == g1
        kind = np.where(hit2, 0, np.where(hit1, 1, 2))
        share = np.where(hit2, f0, np.where(hit1, f1, f2))
        start = np.where(hit2, 0, np.where(hit1, f0, f0 + f1))
        put(start, share, f0 + f1 + f2, None)
        rest = np.flatnonzero(kind == 2)
        if len(rest):
            these, below = now[rest], model.below
            first = below[these]
            put(first, below[these + 1] - first, below[-1], rest)
        model.learn(now, kind)
    for k in range(2, -1, -1):
        digits[filled, everyone] = low >> (_DIGIT * k) & 0xFFFF
        filled += 1
    digits = digits[:int(filled.max())]
    while True:  # carries
        over = digits >> _DIGIT
        if not over.any():
            break
        digits &= 0xFFFF
        digits[:-1] += over[1:]
    body = digits.T.astype("<u2")[np.arange(len(digits))[None, :] < filled[:, None]]
    out = b"".join([MAGIC, struct.pack("<5I", len(doc_ids), n, vocabulary, lanes, steps),
                    np.asarray(doc_ids, "<i8").tobytes(), np.asarray(lengths, "<i8").tobytes(),
                    filled.astype("<u4").tobytes(), body.tobytes()])
    return out + struct.pack("<I", zlib.crc32(out))


def decode(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids) of a block. Raises ValueError on anything that isn't one, or is damaged."""
    if len(block) < 28 or block[:4] != MAGIC or struct.unpack("<I", block[-4:])[0] != zlib.crc32(block[:-4]):
        raise ValueError("not a whole block of token ids")
    documents, n, vocabulary, lanes, steps = struct.unpack("<5I", block[4:24])
    at = 24
    doc_ids = np.frombuffer(block, "<i8", documents, at)
    lengths = np.frombuffer(block, "<i8", documents, at + 8 * documents)
    at += 16 * documents
    filled = np.frombuffer(block, "<u4", lanes, at).astype(np.int64)
    # zeros behind the last digit, for reading ahead
    body = np.concatenate([np.frombuffer(block, "<u2", int(filled.sum()), at + 4 * lanes), np.zeros(8, np.uint16)]).astype(np.int64)
    next_ = np.cumsum(filled) - filled
    code = (body[next_] << 32) | (body[next_ + 1] << 16) | body[next_ + 2]
    next_ = next_ + 3
    wide = np.full(lanes, 1 << _TOP, np.int64)
    model = _Model(vocabulary, lanes)
    grid = np.empty((steps, lanes), np.int32)

    def more(mine, width, who) -> None:
        small = np.flatnonzero(width < 1 << _LOW)
        while len(small):
            lanes_ = small if who is None else who[small]
            mine[small] = (mine[small] << _DIGIT) | body[next_[lanes_]]
            next_[lanes_] += 1
            width[small] <<= _DIGIT
            small = small[width[small] < 1 << _LOW]

    for t in range(steps):
        g2, g1, f0, f1, f2 = model.look()
        two = f0 + f1
        total = two + f2
        r = _over(wide, total)
        goal = _over(code, r)
        miss2, miss1 = goal >= f0, goal >= two
        kind = miss2.astype(np.int64) + miss1
        code -= r * np.where(miss1, two, np.where(miss2, f0, 0))
        wide = r * np.where(miss1, f2, np.where(miss2, f1, f0))
        more(code, wide, None)
        now = np.where(miss2, g1, g2).astype(np.int64)
        rest = np.flatnonzero(miss1)
        if len(rest):
            below, mine, width = model.below, code[rest], wide[rest]
            r = _over(width, below[-1])
            these = _find(below, np.minimum(_over(mine, r), below[-1] - 1))
            first = below[these]
            mine -= r * first
            width = r * (below[these + 1] - first)
            more(mine, width, rest)
            code[rest], wide[rest] = mine, width
            now[rest] = these
        grid[t] = now
        model.learn(now, kind)
    return doc_ids, lengths, np.ascontiguousarray(grid.T).reshape(-1)[:n].astype(np.uint32)
