"""A run-length index of byte strings: the Burrows-Wheeler transform as runs, with the suffixes at both ends of every run.

``build`` sorts the suffixes of all strings, each ending at its own end mark (marks are smaller than bytes and ordered by
place), and keeps of the transform only its runs: byte, length, and the suffixes at the first and last place of each run.

``matching_statistics`` streams over the text with these samples alone. Let up(i) be how far the suffix at i agrees with
the one sorted before it. If both are preceded by the same byte, the suffixes at i - 1 are neighbours too and agree on one
byte more; so up(i) = up(i - 1) - 1 except where i begins a run, and there it is measured: between the last suffix of the
run before and this one. The same holds for down(i) at the ends of runs. The longest match of the suffix at i anywhere else
is the larger of the two. A repetitive text has few runs, so few places are ever compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FIRST = 7  # bytes that the first sort looks at


@dataclass
class RunIndex:
    """Runs of the transform over ``text``; ``stop[i]`` is the end of the string that holds byte i. End marks, one behind
    each string, are -1 in ``byte`` and runs of their own."""

    text: np.ndarray
    stop: np.ndarray
    byte: np.ndarray
    length: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _ranked(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which places of ``order`` begin a new key."""
    new = np.ones(len(order), bool)
    if len(order):
        sorted_keys = keys[order]
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return new


def suffix_array(text: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, by prefix doubling: only suffixes that still tie are sorted again."""
    n = len(text)
    left = stop - np.arange(n)
    padded = np.concatenate([text, np.zeros(FIRST, np.uint8)]).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(FIRST):
        keys = (keys << np.uint64(8)) | np.where(left > k, padded[k:k + n], np.uint64(0))
    keys = (keys << np.uint64(8)) | np.minimum(left, FIRST).astype(np.uint64)
    order = np.argsort(keys)
    new = _ranked(keys, order)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # rank: the first place of the group
    rank = np.empty(n, np.int64)
    rank[order] = head
    depth = FIRST
    # places of the order whose groups are not single
    open_places = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(open_places):
        at = order[open_places]
        group = head[open_places]
        follow = np.where(left[at] > depth, rank[np.minimum(at + depth, n - 1)] + 1, 0)
        ended = follow == 0
        if ended.any():  # equal up to their end marks, which are ordered by place
            follow = np.where(ended, at - n, follow)
        keys = (group.astype(np.uint64) << np.uint64(32)) | (follow + n).astype(np.uint64)
        again = np.argsort(keys)
        at, keys = at[again], keys[again]
        order[open_places] = at
        begins = np.ones(len(at), bool)
        begins[1:] = keys[1:] != keys[:-1]
        place = open_places  # groups keep their places, and these are ascending
        heads = np.maximum.accumulate(np.where(begins, place, 0))
        head[place] = heads
        rank[at] = heads
        single = begins & np.append(begins[1:], True)
        open_places = place[~single]
        depth *= 2
    return order


def build(strings: list[bytes]) -> RunIndex:
    """The index of all strings together; at most 2^30 bytes."""
    lengths = np.array([len(s) for s in strings], np.int64)
    text = np.frombuffer(b"".join(strings), np.uint8)
    stops = np.cumsum(lengths)
    stop = np.repeat(stops, lengths)
    order = suffix_array(text, stop)
    begins = np.zeros(len(text), bool)
    begins[(stops - lengths)[lengths > 0]] = True
    byte = np.where(begins[order], -1, text[order - 1].astype(np.int16))
    new = np.ones(len(order), bool)
    new[1:] = (byte[1:] != byte[:-1]) | (byte[1:] < 0)
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(order)) - 1
    ends = ends[:len(heads)]
    return RunIndex(text, stop, byte[heads], ends - heads + 1, order[heads], order[ends])


def agreements(text: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes the suffixes at ``a`` and ``b`` have in common, within their strings."""
    room = np.minimum(stop[a] - a, stop[b] - b)
    common = np.zeros(len(a), np.int64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    going = np.arange(len(a))
    while len(going):
        at = common[going]
        x = words[a[going] + at].view(np.uint64).ravel()
        y = words[b[going] + at].view(np.uint64).ravel()
        diff = x ^ y
        low = diff & (~diff + np.uint64(1))          # little-endian: the lowest set bit is in the first differing byte
        same = np.where(diff == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(float)).astype(np.int64) >> 3)
        now = np.minimum(at + same, room[going])
        common[going] = now
        going = going[(same == 8) & (now < room[going])]
    return common


def samples(index: RunIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(upper, lower, common) at every border of two runs: the last suffix of the one, the first of the next."""
    upper, lower = index.last[:-1], index.first[1:]
    return upper, lower, agreements(index.text, index.stop, upper, lower)


def _streamed(n: int, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Values at samples, one less with every byte behind them."""
    from_sample = np.full(n, -1, np.int64)
    from_sample[at] = at
    from_sample = np.maximum.accumulate(from_sample)
    known = np.zeros(n, np.int64)
    known[at] = value
    places = np.arange(n)
    return np.where(from_sample >= 0, np.maximum(known[np.maximum(from_sample, 0)] - (places - from_sample), 0), 0)


def matching_statistics(index: RunIndex) -> np.ndarray:
    """For each byte the length of the longest match of what begins there with any other place."""
    upper, lower, common = samples(index)
    n = len(index.text)
    if not n:
        return np.zeros(0, np.int64)
    # the very first suffix has none before it, the very last none behind it
    up = _streamed(n, np.append(lower, index.first[0]), np.append(common, 0))
    down = _streamed(n, np.append(upper, index.last[-1]), np.append(common, 0))
    return np.maximum(up, down)
