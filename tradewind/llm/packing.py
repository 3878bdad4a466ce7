"""Best-fit packing of documents into token sequences after a Martello-Toth dominance reduction.

A packing depends on the lengths alone, and there are at most LIMIT of them. So the table is tokenized in one scan, the
pieces of each length are counted (at most LIMIT numbers, whatever the input), and the packing of the counts is a list
of segments: so many pieces of one length, by rank, go to these sequences at this place. A piece finds its segment by
its rank among the pieces of its length; the ranks come from counts per scan task, so a length that a third of all
pieces share is not gathered anywhere.

The plan first fixes what provably loses nothing, over and over, until nothing more is found:
  * a length that nothing left fits beside stands alone;
  * two lengths that fill a sequence exactly stand together (whatever else would stand beside the one fits in the place
    of the other);
  * where at most one more piece fits beside a length, the largest that fits stands there.
The rest is packed best-fit, by decreasing length.

Defined results: null and empty texts are the end id alone. Repeated rows are packed each for itself. A null doc_id is
packed like any other. An empty table gives no pieces. Columns of the input other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.storage import stored
from tradewind.llm.tokens import encoder, public_path
from tradewind.llm.words import small

LIMIT = 2048
END = 0
VOCABULARY = "byte_bpe_50k.json"
#: Rows whose texts are cut into chunks together.
ROWS = 4096

_PIECE = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint")


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: whole ones, but the first may be shorter."""
    first = n % limit or min(n, limit)
    return [(0, first), *((at, limit) for at in range(first, n, limit))]


def _pieces(vocabulary: str, end: int, limit: int, with_ids: bool):
    def run(batches):
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in small(batches, ROWS):
            coder, out = encoder(vocabulary), []
            texts = coder.encode_many(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for k, (at, n) in enumerate(cut(len(ids), limit)):
                    own = ids[at:at + n]
                    row = (doc_id, k, at, n, zlib.crc32(own.tobytes()), part, seen[n])
                    out.append((*row, own.tolist()) if with_ids else row)
                    seen[n] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            columns = list(zip(*out, strict=True)) or [()] * (7 + with_ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=False)],
                                             names=names[:len(columns)])
    return run


class Plan:
    """Segments (length, first rank, pieces, first sequence, pieces per sequence, offset) of a packing of counts."""

    def __init__(self, counts: dict[int, int], limit: int = LIMIT):
        self.limit, self.left, self.used = limit, np.zeros(limit + 1, np.int64), np.zeros(limit + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.segments: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self._reduce()
        self.fixed = self.sequences
        self._best_fit()

    def _put(self, length: int, n: int, sequence: int, per: int = 1, offset: int = 0) -> None:
        self.segments.append((length, int(self.used[length]), n, sequence, per, offset))
        self.used[length] += n
        self.left[length] -= n

    def _fix(self, n: int, *lengths: int) -> None:
        """``n`` new sequences of these lengths each."""
        offset = 0
        for length in lengths:
            self._put(length, n, self.sequences, 1, offset)
            offset += length
        self.sequences += n

    def _smallest(self, without: int) -> tuple[int, int]:
        """The two smallest lengths left beside one piece of ``without``; limit + 1 where there is none."""
        found = []
        for s in np.flatnonzero(self.left)[:3].tolist():
            found += [s] * min(2, int(self.left[s]) - (s == without))
        return tuple((found + [self.limit + 1] * 2)[:2])

    def _reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for big in range(self.limit, 0, -1):
                while self.left[big]:
                    room = self.limit - big
                    one, two = self._smallest(big)
                    if one > room:  # nothing fits beside it
                        same = self.left[big] if 2 * big > self.limit or self.left[big] == 1 else 0
                        self._fix(int(same) or 1, big)
                    elif room and room != big and self.left[room]:
                        self._fix(int(min(self.left[big], self.left[room])), big, room)
                    elif room == big and self.left[big] > 1:
                        n = int(self.left[big]) // 2
                        self._put(big, 2 * n, self.sequences, 2)
                        self.sequences += n
                    elif one + two > room:  # one more piece at most
                        fitting = np.flatnonzero(self.left[:room + 1])
                        fitting = fitting[(fitting != big) | (self.left[fitting] > 1)]
                        other = int(fitting[-1])
                        self._fix(1 if other == big or self.left[other] < 3 else int(min(self.left[big], self.left[other] - 2)),
                                  big, other)
                    else:
                        break
                    changed = True

    def _best_fit(self) -> None:
        open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, how many)
        rooms = np.zeros(self.limit + 1, bool)

        def reopen(first: int, n: int, room: int) -> None:
            if n and room:
                open_[room].append((first, n))
                rooms[room] = True

        for length in range(self.limit, 0, -1):
            while self.left[length]:
                fitting = np.flatnonzero(rooms[length:])
                n = int(self.left[length])
                if len(fitting):
                    room = int(fitting[0]) + length
                    first, many = open_[room].pop()
                    rooms[room] = bool(open_[room])
                else:
                    room, first, many = self.limit, self.sequences, -(-n // (self.limit // length))
                    self.sequences += many
                per = room // length
                full = min(many, n // per)
                offset = self.limit - room
                if full:
                    self._put(length, full * per, first, per, offset)
                    reopen(first, full, room - per * length)
                rest = n - full * per
                if rest and full < many:
                    self._put(length, min(rest, per), first + full, per, offset)
                    reopen(first + full, 1, room - min(rest, per) * length)
                    full += 1
                reopen(first + full, many - full, room)

    def table(self) -> np.ndarray:
        return np.array(sorted(self.segments), np.int64).reshape(-1, 6)


def place(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces by length and rank."""
    at = np.searchsorted(table[:, 0] * (1 << 44) + table[:, 1], length * (1 << 44) + rank, "right") - 1
    _, first, _, sequence, per, offset = table[at].T
    return sequence + (rank - first) // per, offset + (rank - first) % per * length


def pack(docs: DataFrame, vocabulary: str | None = None, end: int = END, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) per piece of the rows of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = _PIECE + (", ids array<int>" if with_ids else "")
    pieces = stored(docs.mapInArrow(_pieces(vocabulary or public_path(VOCABULARY), end, limit, with_ids), schema), "pieces")
    per_part = stored(pieces.groupBy("length", "part").count(), "lengths")
    counts = {r[0]: r[1] for r in per_part.groupBy("length").agg(F.sum("count")).collect()}  # at most ``limit`` rows
    table = pieces.sparkSession.sparkContext.broadcast(Plan(counts, limit).table())  # grows with ``limit`` alone
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_part.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(ranks, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    shown = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = ranked.select(*shown, "rank", *["ids"] * with_ids)

    def run(batches):
        for batch in batches:
            sequence, offset = place(table.value, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in shown), pa.array(sequence), pa.array(offset),
                 *(batch.column(c) for c in ["ids"] * with_ids)],
                names=[*shown, "sequence_id", "offset", *["ids"] * with_ids])

    return ranked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                             "sequence_id bigint, offset bigint" + (", ids array<int>" if with_ids else ""))


def sequences(docs: DataFrame, **how) -> DataFrame:
    """(sequence_id, ids, pieces): the packed sequences themselves, each at most ``limit`` ids."""
    packed = pack(docs, with_ids=True, **how)
    one = F.struct("offset", "doc_id", "piece", "ids")
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(one)).alias("in")).select(
        "sequence_id", F.flatten(F.col("in.ids")).alias("ids"),
        F.transform("in", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["offset"].alias("offset"))).alias("pieces"))
