"""Whitening of embeddings from exact, bit-sliced cross-products.

Components become whole numbers, ``floor(scale * c)``. Each distinct vector counts once; copies are
collapsed within the tasks that read them, before the shuffle that makes vectors distinct. Of
these, a task takes blocks of rows, moves each dimension so that its smallest number is 0 and packs the bits
of a dimension plane by plane, a bit a row, into 64-bit words. The cross-product of two dimensions is
the sum over pairs of their planes of 2**(a + b) times the number of rows with both bits, an AND and a
popcount; undoing the move is exact as well. Sums leave a task as 32-bit limbs, which Spark
adds up as longs, so the totals are exact for any number of rows.

The driver gets the sums of a matrix of dimension x dimension, centres it in whole numbers
(``n * sum(x y) - sum(x) * sum(y)``) and only then divides and decomposes it. How far the
whitened vectors' covariance is from the identity is measured on all distinct vectors.

Defined cases: rows with a null or empty vector, or with a null or non-finite component, are left out;
a null id is kept; repeated rows are returned as often as they occur; vectors of several lengths raise
an error that names the lengths; a component number beyond 2**62 is held there, a deviation beyond a
long at its limit; components with less than 1e-12 of the first one's variance are none, so rows that
are all equal, and an empty table, give no rows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import map_batches, store
from prefdata.llm.vectors import finite, matrix, one_length

SCALE = 64
COMPONENTS = 16
BLOCK = 4096  # rows that are sliced at once
LEAST = 1e-12  # variance of a component, as a share of the first one's

_LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with ``sums`` per dimension; directions are columns."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def whole(vectors: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * c) as longs, held at +-2**62."""
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * vectors)
    return np.clip(scaled, -float(1 << 62), float(1 << 62) - 512).astype(np.int64)


def planes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed planes, dimension of each, bit of each) of numbers from 0 on (rows x dimensions)."""
    packed, dimension, bit = [], [], []
    words = -(-len(numbers) // 64)
    for d in range(numbers.shape[1]):
        column = numbers[:, d]
        for b in range(max(1, int(column.max()).bit_length())):
            bits = np.packbits(((column >> np.uint64(b)) & np.uint64(1)).astype(bool))
            packed.append(np.pad(bits, (0, 8 * words - len(bits))).view(np.uint64))
            dimension.append(d)
            bit.append(b)
    return np.array(packed), np.array(dimension), np.array(bit)


def scatter(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cross-products) of whole numbers (rows x dimensions), exact.

    The upper triangle of the cross-products is filled. Numbers that can outgrow a long are
    Python's own.
    """
    n, dimensions = rows.shape
    low = rows.min(axis=0)
    sliced, dimension, bit = planes((rows - low).astype(np.uint64))
    most = int(np.abs(rows).max(initial=1))
    kind = np.int64 if 4 * n * most * most < 1 << 62 else object
    weight = np.array([1 << int(b) for b in bit], kind)
    firsts = np.flatnonzero(np.diff(dimension, prepend=-1))
    moved = np.add.reduceat(np.bitwise_count(sliced).sum(axis=1, dtype=np.int64).astype(kind) * weight, firsts)
    cross = np.zeros((dimensions, dimensions), kind)
    for plane, d, w in zip(sliced, dimension, weight):
        both = np.bitwise_count(sliced[firsts[d] :] & plane).sum(axis=1, dtype=np.int64).astype(kind)
        cross[d, d:] += w * np.add.reduceat(both * weight[firsts[d] :], firsts[d:] - firsts[d])
    low = low.astype(kind)
    cross += np.triu(np.outer(moved, low) + np.outer(low, moved) + n * np.outer(low, low))
    return moved + n * low, cross


def limbs(numbers: np.ndarray) -> list[np.ndarray]:
    """Numbers as sums of limbs times 2**(32 * place); all but the last lie in 0 .. 2**32 - 1."""
    out = []
    while numbers.dtype == object and max(abs(x) for x in numbers) >> 62:
        out.append(np.array([x & 0xFFFFFFFF for x in numbers], np.int64))
        numbers = np.array([x >> 32 for x in numbers], object)
    numbers = numbers.astype(np.int64)
    return [*out, numbers & 0xFFFFFFFF, numbers >> 32]


def _sums(batches):
    """Sums of a task: i, j >= 0 is a cross-product, j = -1 a sum, i = -1 the number of rows."""
    total, n, most = None, 0, 1

    def out():
        sums, cross = total
        up = np.triu_indices(len(sums))
        numbers = np.concatenate([cross[up], sums, np.array([n], sums.dtype)])
        minus = np.full(len(sums), -1)
        i = np.concatenate([up[0], np.arange(len(sums)), [-1]])
        j = np.concatenate([up[1], minus, [-1]])
        for place, part in enumerate(limbs(numbers)):
            some = part != 0
            yield {"i": i[some], "j": j[some], "place": np.full(int(some.sum()), place), "part": part[some]}

    for batch in batches:
        rows = unpacked(batch.column("x"))
        for at in range(0, len(rows), BLOCK):
            block = rows[at : at + BLOCK]
            grown = max(most, int(np.abs(block).max(initial=1)))
            if total is not None and 4 * (n + len(block)) * grown * grown >= 1 << 62:
                yield from out()  # the next block could outgrow a long
                total, n, grown = None, 0, int(np.abs(block).max(initial=1))
            own, most = scatter(block), grown
            total = own if total is None else (total[0] + own[0], total[1] + own[1])
            n += len(block)
    if total is not None:
        yield from out()


def packed(rows: np.ndarray) -> pa.Array:
    """Each vector in the narrowest type that holds it; equal vectors have equal bytes."""
    most = np.where(rows < 0, ~rows, rows).max(axis=1, initial=0)
    out = np.empty(len(rows), object)
    for kind, bits in (("<i1", 7), ("<i2", 15), ("<i4", 31), ("<i8", 63)):
        own = np.flatnonzero((most >> bits == 0) & (out == None))  # noqa: E711
        for i, row in zip(own, rows[own].astype(kind)):
            out[i] = bytes([bits]) + row.tobytes()
    return pa.array(out.tolist(), pa.binary())


def unpacked(column: pa.Array) -> np.ndarray:
    kinds = {7: "<i1", 15: "<i2", 31: "<i4", 63: "<i8"}
    rows = [np.frombuffer(x, kinds[x[0]], offset=1).astype(np.int64) for x in column.to_pylist()]
    return np.stack(rows) if rows else np.zeros((0, 1), np.int64)


def _whole_vectors(rows: DataFrame, scale: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            if len(batch):
                yield {"x": packed(whole(matrix(batch.column("v")), scale))}

    return map_batches(rows.select("v"), run, "x binary")


def _decompose(parts: pa.Table, dimensions: int, components: int) -> Whitening | None:
    """From the summed limbs, centred in whole numbers."""
    numbers: dict[tuple[int, int], int] = {}
    for i, j, place, part in zip(*(parts.column(c).to_pylist() for c in ("i", "j", "place", "part"))):
        numbers[i, j] = numbers.get((i, j), 0) + (part << (32 * place))
    n = numbers.get((-1, -1), 0)
    if not n:
        return None
    sums = [numbers.get((d, -1), 0) for d in range(dimensions)]
    covariance = np.zeros((dimensions, dimensions))
    trace = 0
    for i in range(dimensions):
        trace += n * numbers.get((i, i), 0) - sums[i] * sums[i]
        for j in range(i, dimensions):
            centred = n * numbers.get((i, j), 0) - sums[i] * sums[j]
            covariance[i, j] = covariance[j, i] = centred / (n * n)
    if not trace:
        return None
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > LEAST * values.max()]
    return Whitening(n, sums, vectors[:, order], values[order], values[order] / (trace / (n * n)))


def centred(rows: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact."""
    most = int(np.abs(rows).max(initial=0))
    fits = model.n * most < 1 << 62 and max(map(abs, model.sums), default=0) < 1 << 62
    kind = np.int64 if fits else object
    return rows.astype(kind) * model.n - np.array(model.sums, kind)


def projected(offsets: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened coordinates of centred rows."""
    return (offsets / model.n).astype(np.float64) @ model.directions / np.sqrt(model.variances)


def deviations(offsets: np.ndarray) -> np.ndarray:
    """Sums of squares, exact; held at a long's limit."""
    most = max(abs(int(offsets.min(initial=0))), abs(int(offsets.max(initial=0))))
    if offsets.shape[1] * most * most < 1 << 63:
        offsets = offsets.astype(np.int64)
        return (offsets * offsets).sum(axis=1)
    return np.array([min(_LONG.max, sum(int(x) ** 2 for x in row)) for row in offsets], np.int64)


def _identity_error(fitted: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, over all of them."""
    k = len(model.variances)

    def run(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            rows = unpacked(batch.column("x"))
            for at in range(0, len(rows), BLOCK):
                y = projected(centred(rows[at : at + BLOCK], model), model)
                total += np.vstack([y.T @ y, y.sum(axis=0)])
        yield {"place": np.arange(total.size), "part": total.ravel()}

    sums = map_batches(fitted, run, "place int, part double").groupBy("place").agg(F.sum("part").alias("part"))
    total = np.zeros((k + 1) * k)
    for row in sums.collect():  # (components + 1) * components rows
        total[row["place"]] = row["part"]
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def fit(rows: DataFrame, scale: float = SCALE, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of rows (v array<double>); None where they do not differ."""
    dimensions = one_length(rows)
    fitted = store(_whole_vectors(rows, scale).distinct())
    parts = map_batches(fitted, _sums, "i int, j int, place int, part long")
    summed = parts.groupBy("i", "j", "place").agg(F.sum("part").alias("part"))
    # As many rows as the covariance has entries, a few limbs each.
    model = _decompose(summed.toArrow(), dimensions, components)
    if model is None:
        return None
    return Whitening(
        model.n, model.sums, model.directions, model.variances, model.explained,
        _identity_error(fitted, model),
    )


def whitened(rows: DataFrame, model: Whitening | None, key: str = "vec_id", scale: float = SCALE) -> DataFrame:
    """(key, deviation, whitened array) of every row (key, v)."""

    def run(batches):
        for batch in batches:
            if len(batch) and model is not None:
                offsets = centred(whole(matrix(batch.column("v")), scale), model)
                values = projected(offsets, model)
                k = values.shape[1]
                yield {
                    key: batch.column(key),
                    "deviation": deviations(offsets),
                    "whitened": pa.ListArray.from_arrays(
                        pa.array(np.arange(0, len(values) * k + 1, k), pa.int32()), pa.array(values.ravel())
                    ),
                }

    kind = rows.schema[key].dataType.simpleString()
    return map_batches(rows.select(key, "v"), run, f"{key} {kind}, deviation long, whitened array<double>")


def op12_whitening(embeddings: DataFrame) -> DataFrame:
    """One row per vector and component. An offset of all numbers, as the contract has it, drops out."""
    rows = finite(embeddings)
    model = fit(rows)
    out = whitened(rows, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("_place", "whitened")
    )
    explained = [] if model is None else model.explained.tolist()
    shares = F.array(*[F.lit(e) for e in explained]) if explained else F.array().cast("array<double>")
    return out.select(
        "vec_id",
        (F.col("_place") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_place")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
