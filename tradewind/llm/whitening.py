r"""Whitening of embeddings by a covariance in which every distinct vector counts as often as it occurs.

An entry c becomes the whole number floor(64 c) + 1000000; the vectors of these are what is fitted and whitened.

1. Equal vectors become one row with their count, combined before the shuffle, so copies cost nothing further on.
2. Sums per dimension are exact: tasks add whole numbers, Spark adds their totals as decimals.
3. The covariance is a weighted product of centred blocks, Z' W Z, one partial matrix per task, added up by Spark. The mean is
   taken off as its whole part, exactly, and the rest of the division.
4. Eigenvectors of the matrix (its side is the length of a vector) are taken on the driver, once.
5. Every distinct vector is whitened once, and the covariance of what came out is measured against the identity.
6. Rows take the result of their vector by a join. A vector that more than one row in HOT_SHARE holds is spread over as many
   keys as it needs; there are fewer than HOT_SHARE of them, so their list can be sent to all tasks.

``weights="count"`` fits on all rows, ``"one"`` on every distinct vector once.

Defined results: rows whose vector is null, or holds an entry that is null, not finite or not a long after scaling, are left
out. A table's length of vectors is the one that most rows have (of equal numbers the longest); rows of another length are
left out too, and an empty vector has no components. A direction without variance (an eigenvalue not above rounding error)
has whitened 0, and the identity error then shows 1. ``deviation`` is null where it is no long. Rows that share a vec_id, or
have none, are rows of their own. An empty table gives an empty result. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.storage import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
HOT_SHARE = 1000            # a vector is hot when more than one row in so many holds it
SALTED_ROWS = 4096          # about as many rows of a hot vector under one key
BLOCK = 4096                # vectors multiplied at a time
LONG = 2**63 - 1


def _coded(batches):
    """Rows (vec_id, x): the scaled vector as little-endian longs, one binary value; unusable rows are left out."""
    for batch in batches:
        column = batch.column("embedding")
        lengths = np.diff(column.offsets.to_numpy())
        flat = column.values.slice(column.offsets[0].as_py(), int(lengths.sum()))
        with np.errstate(over="ignore", invalid="ignore"):
            c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)   # null entries become nan
            scaled = np.floor(SCALE * c)
            good = np.abs(scaled) < 2.0**62
            x = np.where(good, scaled, 0).astype("<i8") + SHIFT
        owner = np.repeat(np.arange(len(lengths)), lengths)
        usable = ~column.is_null().to_numpy(zero_copy_only=False)
        usable[owner[~good]] = False
        ends = np.concatenate([[0], np.cumsum(lengths)])
        keep = np.flatnonzero(usable)
        raw = x.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(pa.array(keep)), pa.array([raw[8 * ends[i]:8 * ends[i + 1]] for i in keep], pa.binary())],
            names=["vec_id", "x"])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), width)


def _blocks(batches, width: int, weights: str):
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.slice(at, BLOCK)
            times = part.column("times").to_numpy() if weights == "count" else np.ones(len(part), np.int64)
            yield part, _matrix(part.column("x"), width), times


def _exact_dot(times: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Column sums of ``times * x`` as Python integers."""
    if float(np.abs(x).max(initial=0)) * float(times.sum()) < 2.0**62:
        return (times @ x).astype(object)
    return times.astype(object) @ x.astype(object)


def _sums(width: int, weights: str):
    """One row per dimension and task with its exact sum; dimension -1 carries the weight."""
    def run(batches):
        total, n = np.zeros(width, object), 0
        for _, x, times in _blocks(batches, width, weights):
            total, n = total + _exact_dot(times, x), n + int(times.sum())
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, width), pa.int32()), pa.array([str(v) for v in [n, *total]])], names=["i", "total"])
    return run


class Model:
    """Mean and axes of a fit. ``axes`` has a column per component."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums, self.width = n, sums, len(sums)
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n / n for s in sums])
        self.axes, self.explained = np.zeros((self.width, 0)), np.zeros(0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def set_covariance(self, v: np.ndarray, components: int) -> None:
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        trace = float(np.trace(v))
        real = values > trace * self.width * np.finfo(float).eps
        self.axes = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), 0.0)
        self.explained = np.maximum(values, 0.0) / trace if trace > 0 else np.zeros(len(values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, in whole numbers."""
        far = float(np.abs(x - self.whole).max(initial=0)) + 1
        if (far * self.n) ** 2 * self.width < 2.0**62:
            part = self.n * (x - self.whole) - np.array([s % self.n for s in self.sums], np.int64)
            return (part * part).sum(1).tolist()
        part = self.n * x.astype(object) - np.array(self.sums, object)
        return [d if d <= LONG else None for d in (part * part).sum(1)]


def _partials(names: list[str], rows: np.ndarray):
    """A matrix as rows (i, j, v) of its entries."""
    i, j = np.indices(rows.shape)
    return pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(rows.ravel())], names=names)


def _added(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of partial matrices; their side is bounded by the length of a vector."""
    out = np.zeros(shape)
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def _products(model: Model, weights: str):
    """Z' W Z of a task, with the weighted sum of Z (nearly zero) as one row more."""
    def run(batches):
        total, some = np.zeros((model.width + 1, model.width)), False
        for _, x, times in _blocks(batches, model.width, weights):
            z = model.centred(x)
            total[:-1] += (z * times[:, None]).T @ z
            total[-1] += times @ z
            some = True
        if some:
            yield _partials(["i", "j", "v"], total)
    return run


def _whitened(model: Model):
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part.column("x"), model.width)
                y = model.centred(x) @ model.axes
                width = y.shape[1]
                ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays(
                    [part.column("x"), part.column("times"), pa.array(model.deviations(x), pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(y.ravel()))], names=["x", "times", "deviation", "y"])
    return run


def _checks(k: int, mean: np.ndarray, weights: str):
    """Y' W Y of a task, centred."""
    def run(batches):
        total, some = np.zeros((k, k)), False
        for batch in batches:
            flat = batch.column("y").flatten().to_numpy(zero_copy_only=False)
            y = flat.reshape(len(batch), k) - mean
            times = batch.column("times").to_numpy() if weights == "count" else np.ones(len(batch), np.int64)
            total += (y * times[:, None]).T @ y
            some = some or len(batch) > 0
        if some:
            yield _partials(["i", "j", "v"], total)
    return run


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS, weights: str = "count") -> tuple[Model, np.ndarray]:
    """The model of distinct ``vectors`` (x, times), and the mean that rounding leaves in what it whitens."""
    rows = vectors.select("x", "times").mapInArrow(_sums(width, weights), "i int, total string")
    totals = {r["i"]: int(r["total"]) for r in rows.groupBy("i").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect()}  # one row per dimension
    model = Model(totals[-1], [totals[i] for i in range(width)])
    parts = vectors.select("x", "times").mapInArrow(_products(model, weights), "i int, j int, v double")
    v = _added(parts, (width + 1, width)) / model.n
    left = v[-1]
    model.set_covariance(v[:-1] - np.outer(left, left), components)
    return model, left @ model.axes


_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, components: int = COMPONENTS, weights: str = "count") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) for every usable row of ``table``."""
    if weights not in ("count", "one"):
        raise ValueError(f"weights are 'count' or 'one', got {weights!r}")
    spark = table.sparkSession
    rows = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    coded = stored(rows.mapInArrow(_coded, "vec_id bigint, x binary"), "coded-vectors")
    lengths = coded.groupBy(F.length("x").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).limit(1).collect()
    width = lengths[0]["bytes"] // 8 if lengths else 0
    if not width:
        return spark.createDataFrame([], _OUT)
    vectors = stored(coded.where(F.length("x") == 8 * width).groupBy("x").agg(F.count("*").alias("times")), "distinct-vectors")
    model, mean = fit(vectors, width, components, weights)
    k = model.axes.shape[1]
    white = stored(vectors.select("x", "times").mapInArrow(_whitened(model), "x binary, times bigint, deviation bigint, y array<double>"), "whitened")
    seen = _added(white.select("times", "y").mapInArrow(_checks(k, mean, weights), "i int, j int, v double"), (k, k)) / model.n
    error = float(np.abs(seen - np.eye(k)).max(initial=0.0))

    # rows of a hot vector are dealt over several keys, each of which has the vector's result
    least = max(SALTED_ROWS, math.ceil(lengths[0]["count"] / HOT_SHARE))
    salts = F.ceil(F.col("times") / F.lit(SALTED_ROWS)).cast("int")
    hot = white.where(F.col("times") > least).select(F.col("x").alias("_hot"), salts.alias("_salts"))  # below HOT_SHARE rows
    dealt = coded.join(F.broadcast(hot), F.col("x") == F.col("_hot"), "left").select(
        "vec_id", "x", F.coalesce(F.pmod(F.xxhash64("vec_id"), F.col("_salts")), F.lit(0)).cast("int").alias("_salt"))
    every = F.explode(F.sequence(F.lit(0), F.when(F.col("times") > least, salts - 1).otherwise(0)))
    spread = white.select(F.col("x").alias("_x"), every.alias("_of"), "deviation", "y")
    found = dealt.join(spread, (F.col("x") == F.col("_x")) & (F.col("_salt") == F.col("_of")))
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return found.select("vec_id", "deviation", F.posexplode("y").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.element_at(explained, F.col("_at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
