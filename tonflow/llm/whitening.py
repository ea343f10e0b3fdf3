"""Embedding whitening from exact integer scatter, counted bit by bit.

Entries become integers ``floor(scale * c) + shift``.  Each distinct vector counts once.  Per
dimension the integers are shifted by their minimum and cut into bit planes; a plane's bits are
packed across rows into 64-bit words.  The cross-product of two dimensions is the sum of
``2**(p+q) * popcount(plane p AND plane q)``: exact, whatever the order of rows and tasks.  It is
centred as an integer (``n * sum(xy) - sum(x) * sum(y)``) before a float appears, and ``eigh``
sees the quotient only.

What reaches the driver are sums: d minima and totals, d * (d + 1) / 2 cross-products.

Defined results
  * Null vectors and vectors with null, NaN or infinite entries take no part, nor do empty ones.
  * Vectors of other than the commonest length (the longer one of equally common lengths) take
    no part.
  * Entries whose scaled size exceeds 2**60 count as 2**60 (with their sign).
  * Repeated vectors count once in the fit; every row gets its own result, repeated rows and rows
    without an id included.
  * Components without variance (one distinct vector, dependent dimensions) have null ``whitened``;
    ``explained`` is null where there is no variance at all.
  * No rows left: no rows returned, and no model (``fit`` returns None).
  * Only the id and the vector are read; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import code_on_workers, stored

#: Scaled entries beyond this count as this.
LARGEST = 2.0**60
#: Rows whose planes are counted together, and bytes of one block of AND words.
CHUNK_ROWS, BLOCK_BYTES = 1 << 16, 4 << 20
#: Cross-products travel as five numbers of 32 bits, so that their sums stay exact.
LIMB_BITS, LIMBS = 32, 5


@dataclass
class Whitening:
    """Exact sums of the fit list and what follows from them."""

    n: int
    lowest: list[int]
    #: Per dimension, the sum of entries less ``lowest``.
    sums: list[int]
    highest: int
    scatter: list[list[int]]
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: list[float | None]
    scale: float
    shift: int

    @property
    def useful(self) -> list[bool]:
        floor = max(self.eigenvalues[0], 0.0) * len(self.lowest) * np.finfo(float).eps
        return [bool(e > floor) for e in self.eigenvalues]


def whole_vectors(df: DataFrame, key: str, vector: str, scale: float, shift: int) -> DataFrame:
    """``id`` and integer vector ``x`` of the rows that take part."""
    finite = F.forall(F.col("__v"), lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    entry = lambda c: F.floor(F.greatest(F.least(c * F.lit(scale), F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(shift)
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("__v")).where(finite & (F.size("__v") > 0))
    common = rows.groupBy(F.size("__v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    length = 0 if common is None else common["d"]
    return rows.where(F.size("__v") == length).select("id", F.transform("__v", entry).alias("x"))


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each integer vector ``x`` once, stored."""
    return stored(vectors.select("x").distinct())


def fit(distinct: DataFrame, scale: float, shift: int, most_components: int = 16) -> Whitening | None:
    """Components of the vectors of a :func:`fit_list`."""
    code_on_workers(distinct.sparkSession)
    entries = distinct.select(F.posexplode("x").alias("i", "c"))
    per_dimension = (
        entries.groupBy("i")
        .agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"), F.sum(F.col("c").cast("decimal(20,0)")).alias("total"))
        .orderBy("i")
        .collect()
    )
    if not per_dimension:
        return None
    n, d = per_dimension[0]["n"], len(per_dimension)
    lowest = [r["low"] for r in per_dimension]
    sums = [int(r["total"]) - n * r["low"] for r in per_dimension]
    highest = max(r["high"] - r["low"] for r in per_dimension)
    limbs = [f"l{k}" for k in range(LIMBS)]
    fields = ", ".join(f"{c} long" for c in limbs)
    parts = distinct.mapInArrow(lambda batches: _scatter(batches, lowest), f"i int, j int, {fields}")
    scatter = [[0] * d for _ in range(d)]
    for r in parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in limbs]).collect():
        total = sum(r[c] << (LIMB_BITS * k) for k, c in enumerate(limbs))
        scatter[r["i"]][r["j"]] = scatter[r["j"]][r["i"]] = total
    covariance = np.array([[(n * scatter[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)])
    values, components = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most_components]
    values, components = values[order], components[:, order]
    at = np.argmax(np.abs(components), axis=0)
    components = components * np.where(components[at, np.arange(components.shape[1])] < 0, -1.0, 1.0)
    trace = sum(n * scatter[i][i] - sums[i] * sums[i] for i in range(d)) / (n * n)
    explained = [float(max(e, 0.0) / trace) if trace > 0 else None for e in values]
    return Whitening(n, lowest, sums, highest, scatter, values, components, explained, scale, shift)


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``id``, ``component``, ``whitened`` and the exact ``deviation`` (sum of (n*x - S)**2) of every row."""
    schema = f"id {vectors.schema['id'].dataType.simpleString()}, component int, deviation decimal(38,0), whitened double"
    return vectors.mapInArrow(lambda batches: _project(batches, model), schema)


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest entry of (covariance of whitened distinct vectors - identity), to 12 decimals."""
    useful = [c for c, ok in enumerate(model.useful) if ok]
    if not useful:
        return None
    parts = distinct.mapInArrow(lambda batches: _moments(batches, model, useful), "i int, j int, s double")
    sums = {(r["i"], r["j"]): r["s"] for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    k = len(useful)
    mean = np.array([sums[(i, -1)] for i in range(k)]) / model.n
    product = np.array([[sums[(min(i, j), max(i, j))] for j in range(k)] for i in range(k)]) / model.n
    return round(float(np.abs(product - np.outer(mean, mean) - np.eye(k)).max()), 12)


# ------------------------------------------------------------------------ in the tasks
def _matrix(column: pa.Array, lowest: list[int]) -> np.ndarray:
    """Entries less the minimum of their dimension."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return x.reshape(-1, len(lowest)) - np.array(lowest, np.int64)


def _planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bit planes that hold any bit, and the dimension and bit of each."""
    rows, d = y.shape
    words = (rows + 63) // 64
    found, dimensions, bits = [], [], []
    for bit in range(int(y.max()).bit_length()):
        packed = np.zeros((d, words * 8), np.uint8)
        held = np.packbits(((y >> bit) & 1).astype(bool).T, axis=1)
        packed[:, : held.shape[1]] = held
        some = np.flatnonzero(held.any(axis=1))
        found.append(packed[some].view(np.uint64))
        dimensions.append(some)
        bits.append(np.full(len(some), bit))
    if not found:
        return np.zeros((0, words), np.uint64), np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(found), np.concatenate(dimensions), np.concatenate(bits)


def _common_bits(planes: np.ndarray) -> np.ndarray:
    """How many rows have both bits, for every pair of planes."""
    r, words = planes.shape
    both = np.zeros((r, r), np.int64)
    step = max(1, BLOCK_BYTES // (8 * max(r, 1)))
    for start in range(0, words, step):
        block = np.ascontiguousarray(planes[:, start : start + step])
        for p in range(r):
            both[p, p:] += np.bitwise_count(block[p] & block[p:]).sum(axis=1, dtype=np.int64)
    return np.triu(both) + np.triu(both, 1).T


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of ``y`` (none negative), as Python integers."""
    rows, d = y.shape
    planes, dimensions, bits = _planes(y)
    both = _common_bits(planes)
    small = 2 * int(bits.max(initial=0)) + rows.bit_length() + 2 * d.bit_length() < 61
    weights = np.zeros((len(bits), d), np.int64 if small else object)
    weights[np.arange(len(bits)), dimensions] = [1 << int(b) for b in bits]
    if not small:
        both = both.astype(object)
    if not len(bits):
        return np.zeros((d, d), object)
    return weights.T.dot(both.dot(weights)).astype(object)


def _scatter(batches: Iterator[pa.RecordBatch], lowest: list[int]) -> Iterator[pa.RecordBatch]:
    d, total, held, rows = len(lowest), None, [], 0
    for batch in batches:
        y = _matrix(batch.column(0), lowest)
        while len(y):
            part, y = y[: CHUNK_ROWS - rows], y[CHUNK_ROWS - rows :]
            held.append(part)
            rows += len(part)
            if rows == CHUNK_ROWS:
                more = cross_products(np.concatenate(held))
                total, held, rows = more if total is None else total + more, [], 0
    if rows:
        more = cross_products(np.concatenate(held))
        total = more if total is None else total + more
    if total is None:
        return
    mask = (1 << LIMB_BITS) - 1
    for i in range(d):
        values = [int(v) for v in total[i, i:]]
        limbs = [pa.array([(v >> (LIMB_BITS * k)) & mask for v in values], pa.int64()) for k in range(LIMBS)]
        j = pa.array(range(i, d), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([i] * len(values), pa.int32()), j, *limbs], ["i", "j", *[f"l{k}" for k in range(LIMBS)]])


def _centred(y: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact."""
    if model.n * (model.highest + 1) < 2**62:
        return model.n * y - np.array(model.sums, np.int64)
    return model.n * y.astype(object) - np.array(model.sums, object)


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    spread = np.sqrt(np.where(model.useful, model.eigenvalues, 1.0))
    return (centred.astype(np.float64) / model.n) @ model.components / spread


def _slices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """About a million entries at a time."""
    step = max(1, (1 << 20) // d)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _project(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    k, useful = len(model.eigenvalues), np.array(model.useful)
    for batch in _slices(batches, len(model.lowest)):
        y = _matrix(batch.column(batch.schema.get_field_index("x")), model.lowest)
        centred = _centred(y, model)
        narrow = centred.dtype != object and len(model.lowest) * (model.n * (model.highest + 1)) ** 2 < 2**63
        squares = ((centred if narrow else centred.astype(object)) ** 2).sum(axis=1)
        deviation = pa.array([Decimal(int(s)) if s < 10**38 else None for s in squares.tolist()], pa.decimal128(38, 0))
        whitened = _whitened(centred, model).ravel()
        each = pa.array(np.repeat(np.arange(batch.num_rows), k))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("id")).take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                deviation.take(each),
                pa.array(whitened, mask=np.tile(~useful, batch.num_rows)),
            ],
            ["id", "component", "deviation", "whitened"],
        )


def _moments(batches: Iterator[pa.RecordBatch], model: Whitening, useful: list[int]) -> Iterator[pa.RecordBatch]:
    k = len(useful)
    total, product = np.zeros(k), np.zeros((k, k))
    for batch in _slices(batches, len(model.lowest)):
        w = _whitened(_centred(_matrix(batch.column(0), model.lowest), model), model)[:, useful]
        total += w.sum(axis=0)
        product += w.T @ w
    i, j = np.triu_indices(k)
    first, second = np.concatenate([np.arange(k), i]), np.concatenate([np.full(k, -1), j])
    values = np.concatenate([total, product[i, j]])
    yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(values)], ["i", "j", "s"])
