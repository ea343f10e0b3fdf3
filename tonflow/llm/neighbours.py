"""Approximate nearest neighbours by inner product, over randomly rotated one-bit codes.

Each vector, less the mean of all, is rotated at random and kept as one sign bit per dimension
and two numbers: its length, and how well the signs represent it.  The inner product of a
query with the bits, divided by the latter, estimates the true one without bias; its error
has a known bound that shrinks with the dimension.  A block of vectors is searched through its
bits: the k-th largest lower bound is a threshold, and only vectors whose upper bound
reaches it are compared as they are.  Every vector is in the index and every block is
searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonflow.llm.common import code_on_workers, stored

ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 4096, 8192
#: Queries whose estimates are held at once.
_TILE = 256


def rotation(dimension: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same dimension."""
    q, r = np.linalg.qr(np.random.default_rng(dimension).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def build_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(id, vector, code, norm, fit) of every usable vector, and the mean of all.

    Vectors that are not :func:`usable`, have no id or are not of the most frequent length
    (the shorter of two that tie) are left out.  Rows alike in id and vector count once.
    """
    code_on_workers(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).dropDuplicates(["id", "vector"])
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimension = lengths["d"] if lengths else 1
    rows = rows.where(F.size("vector") == dimension)
    each = rows.select(F.posexplode("vector").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("x"))
    mean = np.zeros(dimension)
    for r in each.collect():
        mean[r["i"]] = r["x"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dimension)
        for batch in batches:
            if not batch.num_rows:
                continue
            off = (_matrix(batch.column(1), dimension) - mean) @ turn.T
            norm = np.linalg.norm(off, axis=1)
            fit = np.abs(off).sum(axis=1) / np.sqrt(dimension) / np.where(norm > 0, norm, 1)
            code = np.packbits(off > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in code], pa.binary()),
                 pa.array(norm), pa.array(np.where(norm > 0, fit, 1.0))],
                ["id", "vector", "code", "norm", "fit"],
            )

    schema = "id bigint, vector array<double>, code binary, norm double, fit double"
    return stored(rows.mapInArrow(encode, schema)), mean


def search(
    index: DataFrame, mean: np.ndarray, queries: DataFrame, k: int = 20, sure: float = 3.0
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each query, nearest first.

    ``queries`` has rows (id, vector) like the index; a query's own id is no answer.  The
    score is the inner product of the vectors themselves, summed in double precision; ties
    go to the smaller id.  ``sure`` is the number of standard errors that bounds take.

    Rows and queries are dealt to blocks of a fixed size, and a task searches one block of rows
    for one block of queries; each gives ``k`` answers per query.
    """
    n, asked = index.count(), queries.count()
    row_blocks, query_blocks = -(-n // ROWS_PER_BLOCK) or 1, -(-asked // QUERIES_PER_BLOCK) or 1

    def dealt(rows: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        return rows.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        )

    right = dealt(index, "row_block", row_blocks, "query_block", query_blocks)
    left = dealt(queries.select("id", "vector"), "query_block", query_blocks, "row_block", row_blocks)

    def find(asking: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if asking.num_rows and rows.num_rows:
            dimension = len(mean)
            ids, own = rows["id"].to_numpy(), asking["id"].to_numpy()
            x, q = _matrix(rows["vector"], dimension), _matrix(asking["vector"], dimension)
            packed = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
            signs = np.unpackbits(packed, axis=1, count=dimension).astype(np.float32) * 2 - 1
            norm, fit = rows["norm"].to_numpy(), rows["fit"].to_numpy()
            scale = (norm / fit / np.sqrt(dimension)).astype(np.float32)
            spread = norm * np.sqrt(np.maximum(1 - fit**2, 0)) / fit * sure / np.sqrt(max(dimension - 1, 1))
            turn = rotation(dimension)
            for lo in range(0, len(own), _TILE):
                part = q[lo : lo + _TILE]
                estimate = (part @ turn.T).astype(np.float32) @ signs.T * scale + (part @ mean)[:, None].astype(np.float32)
                bound = np.linalg.norm(part, axis=1)[:, None].astype(np.float32) * spread.astype(np.float32) * 1.0001 + 1e-6
                self_ = own[lo : lo + _TILE, None] == ids[None, :]
                low = np.where(self_, -np.inf, estimate - bound)
                if len(ids) > k:
                    least = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
                else:
                    least = np.full(len(part), -np.inf)
                chosen = (estimate + bound >= least[:, None]) & ~self_
                who, which = _compare(part, x, chosen, k)
                _rerank(part, x, ids, own[lo : lo + _TILE], who, which, k, out)
        names = ["query_id", "vec_id", "score"]
        types = [pa.int64(), pa.int64(), pa.float64()]
        columns = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, types, strict=True)]
        return pa.table(columns, names)

    keys = ["row_block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        find, "query_id bigint, vec_id bigint, score double"
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _compare(q: np.ndarray, x: np.ndarray, chosen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The chosen pairs whose inner product may be among a query's ``k`` best, to rounding."""
    some = np.flatnonzero(chosen.any(axis=0))
    true = np.where(chosen[:, some], q @ x[some].T, -np.inf)
    slack = 1e-9 * np.linalg.norm(q, axis=1) * (np.linalg.norm(x[some], axis=1).max() if len(some) else 0)
    least = np.partition(true, len(some) - k, axis=1)[:, len(some) - k] if len(some) > k else np.full(len(q), -np.inf)
    who, which = np.nonzero((true >= (least - slack)[:, None]) & chosen[:, some])
    return who, some[which]


def _rerank(q, x, ids, own, who, which, k, out) -> None:
    """True scores of the chosen pairs, and each query's ``k`` best of them."""
    scores = np.empty(len(who))
    for lo in range(0, len(who), 1 << 16):
        a, b = q[who[lo : lo + (1 << 16)]], x[which[lo : lo + (1 << 16)]]
        total = np.zeros(len(a))
        for i in range(a.shape[1]):  # in order, so that equal vectors score the same
            total += a[:, i] * b[:, i]
        scores[lo : lo + (1 << 16)] = total
    order = np.lexsort((ids[which], -scores, who))
    who, which, scores = who[order], which[order], scores[order]
    place = np.arange(len(who)) - np.searchsorted(who, who, side="left")
    best = place < k
    out[0].append(own[who[best]])
    out[1].append(ids[which[best]])
    out[2].append(scores[best])
