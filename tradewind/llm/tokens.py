"""Token ids of many texts by the tokenizers library, each distinct chunk encoded once.

A text is cut only where no token and no normalisation can reach across: before a space or line feed that follows a
visible ASCII character or a Latin letter. The ids of the chunks, joined, are the ids of the text (tests compare them).
Texts of such characters with single spaces only, the usual case, are cut by plain splitting; the ASCII marks, but for an
apostrophe, at the end of a word of letters are a chunk of their own, as no token joins them to letters, unless the text
holds an added token of the vocabulary. A vocabulary that lower-cases gets
them in lower case. All this makes fewer chunks differ. Chunks are Arrow strings, of which a slice of texts looks up the
different ones in a store; words that are new are encoded many in one string.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores already

_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+(?:[ \n][!-~À-ÖØ-öø-ÿ]+)*")
_WORD = r"\A[A-Za-zÀ-ÖØ-öø-ÿ]+\z"
_WORDS = r"\A[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?(?:[ \n][A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?)*\z"
_TAIL = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[!-&(-/:-@[-`{-~]+(?:[ \n]|$))")
_CUT = re.compile(r"(?<=[!-~À-ÖØ-öø-ſ])(?=[ \n])")


def _as_it_stands(chunk: str) -> str:
    """A chunk without spaces, told from all others: a space is STX and a, an STX is STX and b."""
    return chunk.replace("\2", "\2b").replace(" ", "\2a")


class Encoder:
    #: Bytes that the store of chunks may take, at about OWN bytes a chunk besides its characters and ids; beyond them the
    #: chunks used most stay, half as many bytes. A worker keeps a store for each vocabulary.
    KEPT, OWN = 40 << 20, 100
    #: Bytes of text cut at a time.
    SLICE = 1 << 23
    #: New words encoded in one string.
    JOINED = 128

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.lower = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("AÉ") == "aé"
        self.marks = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        #: the tokens that end a word, or else begin one after a space
        self.ends, self.edge = bool(suffix), np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.edge[[i for token, i in vocabulary.items() if (token.endswith(suffix) if suffix else token.startswith("Ġ"))]] = True
        #: what encodes words of letters; how a text and a line begin, and here a space where that makes no difference
        self.words, self.opens, self.line = self.tokenizer, "\0", " \n"
        probe = ["ab éñ ß", " ab éñ ß", "\nab\néñ\nß"]
        want, *others = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in probe)
        if self.ends and others == [want, want]:
            self.opens, self.line = "", " "
            words = Tokenizer(self.tokenizer.model)
            words.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            if all(words.encode(t, add_special_tokens=False).ids == want for t in probe):
                self.words = words  # letters in lower case are as the normaliser leaves them
        self._reset()

    def _reset(self) -> None:
        self.keys, self.held = pa.array([], pa.string()), 0
        self.flat, self.filled = np.zeros(1 << 12, np.uint32), 0
        self.start, self.length, self.used = (np.zeros(0, np.int32) for _ in range(3))

    @property
    def known(self) -> list[str]:
        """The chunks in the store."""
        return self.keys.to_pylist()

    def _weight(self, keys: pa.Array) -> np.ndarray:
        return self.OWN + 5 * pc.binary_length(keys).to_numpy().astype(np.int64)

    def _add(self, at: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """The chunks numbered ``at`` have so many of ``ids`` each."""
        while self.filled + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.filled:self.filled + len(ids)] = ids
        self.start[at], self.length[at] = self.filled + np.cumsum(n) - n, n
        self.filled += len(ids)

    def _singly(self, at: np.ndarray, chunks: list[str]) -> None:
        for k in range(0, len(chunks), 4096):
            ids = [got.ids for got in self.tokenizer.encode_batch_fast(chunks[k:k + 4096], add_special_tokens=False)]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            self._add(at[k:k + 4096], np.fromiter(chain.from_iterable(ids), np.uint32, int(n.sum())), n)

    def _words(self, at: np.ndarray, words: pa.Array) -> None:
        """Words of letters alone: no token joins two of them, and each has one token that ends, or begins, a word."""
        cuts = np.append(np.arange(0, len(words), self.JOINED, dtype=np.int32), np.int32(len(words)))
        rows = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), " ")
        for a, b, text in zip(cuts[:-1].tolist(), cuts[1:].tolist(), rows.to_pylist(), strict=True):
            ids = np.array(self.words.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.uint32)
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) == b - a and (edges[-1] == len(ids) - 1 if self.ends else edges[0] == 0):
                n = np.diff(edges, prepend=-1) if self.ends else np.diff(edges, append=len(ids))
                self._add(at[a:b], ids, n)
            else:
                self._singly(at[a:b], [" " + w for w in text.split(" ")])

    def _learn(self, keys: pa.Array) -> None:
        """Put ``keys`` into the store, with their ids. A key is a chunk after a space; after a line feed, which it begins
        with; or, behind a NUL, as it stands, with spaces as in ``_as_it_stands``."""
        at = np.arange(len(self.keys), len(self.keys) + len(keys))
        self.keys = pa.concat_arrays([self.keys, keys])
        self.held += int(self._weight(keys).sum())
        self.start, self.length, self.used = (np.concatenate([x, np.zeros(len(keys), np.int32)]) for x in (self.start, self.length, self.used))
        word = pc.match_substring_regex(keys, _WORD)
        self._words(at[word.to_numpy(zero_copy_only=False)], keys.filter(word))
        others = keys.filter(pc.invert(word)).to_pylist()
        self._singly(at[~word.to_numpy(zero_copy_only=False)], [
            k[1:].replace("\2a", " ").replace("\2b", "\2") if k[:1] == "\0" else k if k[:1] == "\n" else " " + k for k in others])

    def _forget(self) -> None:
        """Keep the chunks used most, as far as half the bytes go."""
        order = np.argsort(-self.used, kind="stable")
        stay = order[:np.searchsorted(np.cumsum(self._weight(self.keys)[order]), self.KEPT // 2, "right")]
        keys, start, n, used, flat = self.keys.take(pa.array(stay)), self.start[stay], self.length[stay], self.used[stay], self.flat
        self._reset()
        self.keys, self.held = keys, int(self._weight(keys).sum())
        self.start, self.length, self.used = np.zeros_like(start), np.zeros_like(n), used >> 1
        ends = np.cumsum(n)
        self._add(np.arange(len(stay)), flat[np.repeat(start - ends + n, n) + np.arange(int(n.sum()))], n)

    def _cut(self, text: str | None) -> str | None:
        """The keys of a text with spaces between them."""
        if not text:
            return None
        if _PLAIN.fullmatch(text):
            if not any(mark in text for mark in self.marks):
                text = _TAIL.sub(" \0", text)
            return self.opens + (text.lower() if self.lower else text).replace("\n", self.line)
        return " ".join("\0" + _as_it_stands(c) for c in _CUT.split(text))

    def _cut_all(self, texts: pa.Array) -> pa.Array:
        usual = pc.fill_null(pc.match_substring_regex(texts, _WORDS), False)
        cut = pc.utf8_lower(texts) if self.lower else texts
        for mark, apart in ((",", " \0,"), (".", " \0."), ("\n", self.line)):
            cut = pc.replace_substring(cut, mark, apart)
        cut = pc.binary_join_element_wise(pa.scalar(self.opens, cut.type), cut, pa.scalar("", cut.type))
        others = pc.invert(usual)
        return pc.replace_with_mask(cut, others, pa.array([self._cut(t) for t in texts.filter(others).to_pylist()], cut.type))

    def encode_many(self, texts: list[str | None] | pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, some SLICE bytes of texts at a time."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            past = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, past + self.SLICE, "right")))
            yield from self._encode(texts[first:last])
            first = last

    def _encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        rows = pc.split_pattern(self._cut_all(texts).cast(pa.string()), " ")
        counts = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        # behind the store's chunks, which all differ, a chunk's code is its number in the store, and new ones follow
        known = len(self.keys)
        chunks = pa.concat_arrays([self.keys, rows.flatten()]).dictionary_encode()
        del rows
        codes = chunks.indices.to_numpy()[known:]
        if len(chunks.dictionary) > known:
            self._learn(chunks.dictionary[known:])
        del chunks
        self.used += np.bincount(codes, minlength=len(self.keys)).astype(np.int32)
        start, length, flat = self.start, self.length, self.flat
        if self.held > self.KEPT:
            self._forget()
        ends = np.cumsum(counts)
        row = 0
        while row < len(counts):  # as many rows at a time as have some chunks
            begin = int(ends[row] - counts[row])
            last = max(row + 1, int(np.searchsorted(ends, begin + (self.SLICE >> 6), "right")))
            own = codes[begin:int(ends[last - 1])]
            n = length[own]
            stops = np.append(0, np.cumsum(n, dtype=np.int64))
            ids = flat[np.repeat(start[own] - stops[:-1], n) + np.arange(int(stops[-1]))]
            cuts = stops[np.append(0, ends[row:last] - begin)].tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield ids[a:b]
            row = last

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_many([text]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process: a Python worker keeps what it has learnt from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def public_path(name: str) -> str:
    """Where a vocabulary file of the installed public tokenizers is."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
