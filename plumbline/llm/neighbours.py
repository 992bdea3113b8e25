"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector is scaled to length 1 and turned by a fixed random rotation; its code holds the
signs, packed to bits, and one correction scalar, the inner product of the code's unit vector with the
turned vector. A query's turned vector is rounded to four bits a component, kept as four bit planes, so that its
inner product with a code is a sum of bit counts. From it and the scalar an unbiased estimate of any inner product
follows, with an error of at most ``epsilon * sqrt((1 - f^2) / f^2) / sqrt(d - 1)`` (times both
lengths) but with small probability. For each query only vectors whose upper bound reaches the k-th best lower bound
are reranked, exactly and in double precision.

Stated queries meet all vectors in pairs of blocks; a pair of blocks returns its k best per query. A first
block of vectors gives each query k exact products; in all others only vectors whose upper bound reaches the least of them count.

Defined results: vectors that are null, zero or empty, or that hold a null or non-finite component, take no part, as query
or candidate; a query meets vectors of its own number of components; lengths may be anything that a double
holds, and products that overflow are infinite (below all others where undefined); ties go to the smaller id; rows
of the query's own id are no candidates; fewer than k candidates are all returned; repeated
rows are candidates each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import column, written

#: Components that a block of candidates and a block of queries hold, about.
CANDIDATES, QUERIES = 1 << 20, 1 << 20
#: Bits of a component of a query.
PLANES = 4


@functools.lru_cache(maxsize=8)
def rotation(size: int, seed: int = 20240) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def lengths(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows scaled to length 1, and their lengths, without an overflow or underflow on the way."""
    largest = np.abs(vectors).max(1)
    even = vectors / largest[:, None]
    norm = np.sqrt(np.einsum("ij,ij->i", even, even))
    return even / norm[:, None], largest * norm


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    raw = np.packbits(bits, axis=1)
    return np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8))).view(np.uint64)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, correction scalars and lengths of the rows."""
    unit, length = lengths(vectors)
    turned = unit @ turn
    bits = turned > 0
    factor = np.where(bits, turned, -turned).sum(1) / np.sqrt(vectors.shape[1])
    return packed(bits), factor, length


class Asked:
    """Unit queries rounded to bit planes; ``cosines`` estimates their products with the unit vectors of codes."""

    def __init__(self, unit: np.ndarray, turn: np.ndarray) -> None:
        turned = unit @ turn
        self.size = unit.shape[1]
        self.low = turned.min(1)
        self.step = np.maximum(turned.max(1) - self.low, 1e-12) / ((1 << PLANES) - 1)
        levels = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.planes = [packed(levels >> j & 1) for j in range(PLANES)]
        self.total = levels.sum(1, dtype=np.int64)

    def cosines(self, a: int, b: int, code: np.ndarray, ones: np.ndarray, factor: np.ndarray) -> np.ndarray:
        """Estimates for queries ``a`` to ``b``."""
        met = np.zeros((b - a, len(code)), np.int32)
        for j, plane in enumerate(self.planes):
            for w in range(code.shape[1]):
                met += np.left_shift(np.bitwise_count(plane[a:b, w, None] & code[None, :, w]), j, dtype=np.int32)
        low, step = self.low[a:b, None], self.step[a:b, None]
        return (2 * step * met + 2 * low * ones - step * self.total[a:b, None] - self.size * low) / np.sqrt(self.size) / factor


def _matrix(values: pa.Array) -> np.ndarray:
    """Rows of one number of components."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _indexing(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = column(batch, "d").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                v = _matrix(column(part, "vector"))
                fine = np.isfinite(v).all(1) & (np.abs(v) > 0).any(1)
                if fine.any():
                    part = part.filter(pa.array(fine))
                    code, factor, length = encode(v[fine], rotation(int(size), seed))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor), pa.array(length)], names=[*part.schema.names, "code", "factor", "length"])

    return run


def _searching(k: int, epsilon: float, seed: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("reranked", pa.int64())])

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        with np.errstate(over="ignore", invalid="ignore", under="ignore"):
            return search(queries, rows)

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        q, v = _matrix(queries.column("vector")), _matrix(rows.column("vector"))
        size = v.shape[1]
        q_id, v_id, least = queries.column("vec_id").to_numpy(), rows.column("vec_id").to_numpy(), queries.column("least").to_numpy()
        code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(len(v), -1)
        ones = np.bitwise_count(code).sum(1, dtype=np.int64)
        factor, length = rows.column("factor").to_numpy(), rows.column("length").to_numpy()
        unit, q_length = lengths(q)
        asked = Asked(unit, rotation(size, seed))
        slack = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / np.sqrt(max(size - 1, 1))
        out: list[tuple[np.ndarray, ...]] = []
        tile = max(1, (1 << 20) // len(v))
        for a in range(0, len(q), tile):
            b = min(a + tile, len(q))
            cosine = asked.cosines(a, b, code, ones, factor)
            error = epsilon * (slack + asked.step[a:b, None] / np.sqrt(12) / factor)
            # the query's own length is common to all its products; what overflows is reranked
            low, high = (cosine - error) * length, (cosine + error) * length
            own = q_id[a:b, None] == v_id[None, :]
            low = np.where(own | np.isnan(low), -np.inf, low)
            floor = np.partition(low, -k, axis=1)[:, -k] if len(v) > k else np.full(b - a, -np.inf)
            for i in range(b - a):
                near = np.flatnonzero(~(high[i] < floor[i]) & ~(high[i] * q_length[a + i] < least[a + i]) & ~own[i])
                exact = np.concatenate([np.einsum("ij,j->i", v[near[c : c + 4096]], q[a + i]) for c in range(0, len(near), 4096)] or [np.zeros(0)])
                best = np.lexsort((v_id[near], -np.where(np.isnan(exact), -np.inf, exact)))[:k]
                out.append((np.full(len(best), q_id[a + i]), v_id[near[best]], exact[best], np.full(len(best), len(near))))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, epsilon: float = 1.5, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 20240, block: int = CANDIDATES) -> DataFrame:
    """The k nearest rows of ``vectors`` to each row of ``queries`` (both with id and vector).

    ``block``: components that a block of candidates holds. Returns ``query_id, rank, vec_id, score`` and
    ``reranked``, the vectors of the winner's block whose exact product was taken.
    """
    kept = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.size(vector_col).alias("d")).where(F.col("vec_id").isNotNull() & (F.col("d") > 0) & ~F.exists("vector", lambda x: x.isNull()))
    schema = f"vec_id long, vector {dict(vectors.dtypes)[vector_col]}, d int, code binary, factor double, length double"
    codes = lambda df: kept(df).mapInArrow(_indexing(seed), schema)
    index = written(codes(vectors), "codes")
    asked = written(codes(queries).select("vec_id", "vector", "d"), "queries")
    total = lambda df: df.agg(F.coalesce(F.sum(F.col("d").cast("long")), F.lit(0))).first()[0]
    n_c, n_q = max(1, -(-total(index) // block)), max(1, -(-total(asked) // QUERIES))
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    asked, index = asked.withColumn("qb", part(n_q)), index.withColumn("cb", part(n_c))

    def searched(asked: DataFrame, index: DataFrame, first: int, last: int) -> DataFrame:
        left = asked.withColumn("cb", F.explode(F.sequence(F.lit(first), F.lit(last))))
        right = index.where(F.col("cb").between(first, last)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
        keys = ["d", "qb", "cb"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_searching(k, epsilon, seed), "query_id long, vec_id long, score double, reranked long")

    none = F.lit(float("-inf"))
    found = searched(asked.withColumn("least", none), index, 0, 0)
    if n_c > 1:
        found = written(found, "first-block")
        floors = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min(F.nanvl("score", none))).alias("least"))
        rest = asked.join(floors, asked["vec_id"] == floors["query_id"], "left").withColumn("least", F.coalesce("least", none)).drop("query_id")
        found = found.union(searched(rest, index, 1, n_c - 1))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.nanvl("score", none)), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "reranked")
