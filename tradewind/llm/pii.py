r"""Personal data: fixed patterns, and a BiLSTM-CRF tagger that adds what they miss.

The patterns (e-mail, ip, card, phone) give the base spans, which always stay. The tagger is trained on windows of the
corpus labelled by the base spans, from a bounded sample of rows chosen by hash, and on the same windows with the spans
written in other ways (``varied``: " (at) ", "[dot]", spaced or bracketed points, other marks between digits, no plus sign),
which the patterns miss. It reads every stretch of text that holds a digit, an @, a written-out "dot" or an "at" in
brackets, without which none of the four kinds can be, in windows of SIZE characters that overlap by half; each character
takes its tag from the window in which it lies most inwards, so spans across window borders come out whole, and spans are
then read off the joined tags of the whole text. An added span is widened to whole words and numbers, must not touch a base
span and must hold what its kind is made of (see ``_plausible``), so ordinary numbers stay alone.

Defined results: null and empty texts have no spans. Repeated rows are searched one by one. Without any base span in
the sample the tagger is not trained and adds nothing. Columns other than doc_id and text are not read. All offsets are
code points of the whole text, however long.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.tagger import Tagger, symbols

KINDS = ("email", "ip", "card", "phone")
SIZE, MARGIN = 64, 24
#: Bounds of the training sample: rows looked at (about, by a hash of the id), windows of a row, windows in all (those with
#: spans are four times as likely to be among them).
SAMPLE_ROWS, ROW_WINDOWS, WINDOWS = 60_000, 4, 2400
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9@]")
_WRITTEN_OUT = re.compile(r"[\[({<] ?[aA][tT] ?[\])}>]|[dD][oO][tT](?![A-Za-z])")
#: What may stand for the @ and the points of an added span.
_AT = r"(?: ?@ ?| ?[\[({<] ?at ?[\])}>] ?| at )"
_POINT = r"(?:\.| ?[\[({<] ?(?:dot|\.) ?[\])}>] ?| dot )"
_MAIL = re.compile(rf"[a-z0-9._%+-]+{_AT}[a-z0-9-]+(?:{_POINT}[a-z0-9-]+)+", re.I)
_QUAD = re.compile(rf"[0-9]{{1,3}}(?:(?:{_POINT}| ?\. ?)[0-9]{{1,3}}){{3}}", re.I)
_NUMBER_MARKS = frozenset("0123456789 +()./-\u2013")  # no colons, commas or letters: times and amounts have those
_DATE = re.compile(r"(?:19|20)[0-9]{2}([-./ ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./ ])[0-9]{1,2}\2(?:19|20)[0-9]{2}")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    found = []
    last = 0
    at = text.find("@")
    while at >= 0:  # what a leftmost match takes before the @ is all that may stand there
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            found.append((0, start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    if _SEED.search(text):
        for m in _IP.finditer(text):
            if all(len(p) < 4 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                found.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def stretches(text: str) -> list[tuple[int, int]]:
    """Where digits, @ or their written-out forms are, with MARGIN characters on both sides; neighbours joined."""
    at = np.fromiter((m.start() for m in _SEED.finditer(text)), np.int64)
    written = [m.start() for m in _WRITTEN_OUT.finditer(text)]
    if written:  # a name of usual length may stand before them
        at = np.unique(np.concatenate([at, np.maximum(np.array(written) - MARGIN, 0), np.array(written)]))
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 2 * MARGIN)
    firsts, lasts = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
    return list(zip(np.maximum(firsts - MARGIN, 0).tolist(), np.minimum(lasts + 1 + MARGIN, len(text)).tolist(), strict=True))


def windows(start: int, end: int) -> list[int]:
    """Starts of overlapping windows that cover start..end."""
    return [start] if end - start <= SIZE else list(range(start, end - SIZE // 2, SIZE // 2))


def _tags(start: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    y = np.zeros(SIZE, np.int64)
    for kind, a, b in spans:
        if a < start + SIZE and b > start:
            y[max(a - start, 0):max(b - start, 0)] = 2 * kind + 2
            if a >= start:
                y[a - start] = 2 * kind + 1
    return y


def varied(kind: int, got: str, pick: int) -> str:
    """The base span ``got`` in another way of writing, which no pattern finds whole."""
    if kind == 0:
        local, _, domain = got.rpartition("@")
        at, point = ((" at ", " dot "), (" (at) ", "."), ("[at]", "[dot]"), (" @ ", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"))[pick % 6]
        return local + at + domain.replace(".", point)
    if kind == 1:
        return (" . ", "[.]", " dot ", "(.)", "[dot]", ". ")[pick % 6].join(got.split("."))
    d = _digits(got)
    if kind == 2:
        return (".", "/", " - ", "  ", " / ")[pick % 5].join(d[i:i + 4] for i in range(0, len(d), 4))
    tail = [d[:-10], d[-10:-7], d[-7:-4], d[-4:]] if len(d) > 10 else [d[:-7], d[-7:-4], d[-4:]]
    form = pick % 5
    if form == 0:
        return f"({tail[-3]}) {tail[-2]}-{tail[-1]}"
    if form == 1:
        return "00" + " ".join(t for t in tail if t)
    return (" ", "/", "\u2013", "-", ".")[form if form < 4 else 0 if len(tail) > 3 else 4].join(t for t in tail if t)


def _varied_window(text: str, start: int, spans: list[tuple[int, int, int]], pick: int) -> tuple[str, np.ndarray] | None:
    """A window that begins at ``start`` with every whole span in it written in another way, and its tags."""
    whole = sorted((a, b, k) for k, a, b in spans if start <= a and b <= start + SIZE)
    whole = [x for i, x in enumerate(whole) if not i or x[0] >= whole[i - 1][1]]
    if not whole:
        return None
    out, marked, at = "", [], start
    for a, b, kind in whole:
        out += text[at:a]
        new = varied(kind, text[a:b], pick)
        marked.append((kind, len(out), len(out) + len(new)))
        out, at = out + new, b
        pick //= 7
    out += text[at:at + SIZE]
    return out[:SIZE], _tags(0, marked)


def _widened(kind: int, text: str, start: int, end: int) -> tuple[int, int]:
    """start..end without marks at its ends, widened to the borders of the words or numbers it begins and ends in; an
    address that is tagged in part is taken as it is written."""
    if kind < 2:
        first = max(start - SIZE, 0)
        for m in (_MAIL, _QUAD)[kind].finditer(text[first:end + SIZE]):
            if m.start() + first < end and m.end() + first > start:
                return m.start() + first, m.end() + first
    while start < end and not (text[start].isalnum() or text[start] in "(+"):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    while start and end - start and text[start].isalnum() and text[start - 1].isalnum() and end - start < 4 * SIZE:
        start -= 1
    while end < len(text) and end > start and text[end].isalnum() and text[end - 1].isalnum() and end - start < 4 * SIZE:
        end += 1
    if text[start:start + 1].isdigit() and text[start - 1:start] in ("(", "+") and start:
        start -= 1
    return start, end


def _plausible(kind: int, text: str, start: int, end: int) -> bool:
    """What an added span must be: a whole run, not part of a longer word or number, with the digits its kind has."""
    got = text[start:end]
    beside = text[max(start - 1, 0):start] + text[end:end + 1]
    if not got or any(c.isalnum() or c in "@_=\"'" for c in beside):
        return False
    d = _digits(got)
    if kind == 0:
        bare = " at " in got.lower() and "@" not in got
        return bool(_MAIL.fullmatch(got)) and (not bare or " dot " in got.lower())
    if kind == 1:
        return bool(_QUAD.fullmatch(got)) and all(int(p) <= 255 for p in re.findall(r"[0-9]+", got))
    if not set(got) <= _NUMBER_MARKS:
        return False
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d)
    groups = re.findall(r"[0-9]+", got)
    led = got[0] in "+(" or got[0] == "0" and len(groups) > 1
    return 8 <= len(d) <= 15 and (led or len(groups) > 2) and not _DATE.search(got)


def added_spans(texts: list[str], tagger: Tagger, base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans the tagger adds to each text. Windows of all texts are decoded together, BATCH at a time."""
    jobs = [(i, a, b, w) for i, t in enumerate(texts) for a, b in stretches(t) for w in windows(a, b)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    joined: dict[tuple[int, int], np.ndarray] = {}
    for k in range(0, len(jobs), 1024):
        part = jobs[k:k + 1024]
        paths = tagger.decode(symbols([texts[i][w:min(w + SIZE, b)] for i, a, b, w in part], SIZE))
        for (i, a, b, w), path in zip(part, paths, strict=True):
            tags = joined.setdefault((i, a), np.zeros(b - a, np.int8))
            lead = 0 if w == a else SIZE // 4  # the first quarter belongs to the window before
            n = min(SIZE, b - w)
            tags[w - a + lead:w - a + n] = path[lead:n]
    for (i, a), tags in joined.items():
        for at in np.flatnonzero(tags & 1).tolist():
            inner, end = tags[at] + 1, at + 1
            while end < len(tags) and tags[end] == inner:
                end += 1
            span = (int(tags[at] - 1) // 2, *_widened(int(tags[at] - 1) // 2, texts[i], a + at, a + end))
            free = all(span[2] <= s or span[1] >= e for _, s, e in chain(base[i], out[i]))
            if free and _plausible(span[0], texts[i], span[1], span[2]):
                out[i].append(span)
    return out


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _sample(batches):
    """Windows for training: of each row at most ROW_WINDOWS, those with spans first."""
    for rows in batches:
        out = []
        for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
            text = text or ""
            spans = base_spans(text)
            starts = [w for a, b in stretches(text) for w in windows(a, b)]
            starts.sort(key=lambda w: (not any(s < w + SIZE and e > w for _, s, e in spans), w * 2654435761 % 1000003))
            for w in starts[:ROW_WINDOWS]:
                key = int.from_bytes(hashlib.blake2b(f"{doc_id}:{w}".encode(), digest_size=7).digest(), "big")
                tags = _tags(w, spans)
                out.append((key >> 2 * bool(tags.any()), text[w:w + SIZE], tags.astype(np.int8).tobytes()))
                other = _varied_window(text, w, spans, key % 1000003)
                if other:
                    out.append((key >> 2, other[0], other[1].astype(np.int8).tobytes()))
        yield pd.DataFrame(out, columns=["at", "window", "tags"])


def train(docs: DataFrame, steps: int = 300) -> Tagger | None:
    """A tagger trained on at most WINDOWS windows of ``docs``; None if no base span is among them. What reaches one
    task follows the bounds, not the table."""
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = docs.select("doc_id", "text").where(chosen & F.col("text").rlike("[0-9@]"))
    sample = rows.mapInPandas(_sample, "at bigint, window string, tags binary").orderBy("at", "window").limit(WINDOWS).collect()
    x = symbols([r["window"] for r in sample], SIZE)
    y = np.array([np.frombuffer(bytes(r["tags"]), np.int8) for r in sample], np.int64).reshape(-1, SIZE)
    if not y.any():
        return None
    tagger = Tagger(2 * len(KINDS) + 1)
    tagger.fit(x, y, steps)
    return tagger.light()


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of ``docs``; counts are of all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # some ten thousand numbers

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, shared.value, base) if shared.value else [[] for _ in texts]
            every = [b + m for b, m in zip(base, more, strict=True)]
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in every], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts,
                 pa.array([hashlib.sha256(_written(b).encode()).hexdigest() for b in base]),
                 pa.array([_written(s) for s in every], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                           "base_sha256 string, spans string")
