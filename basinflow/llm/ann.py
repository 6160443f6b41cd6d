"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector of length |o| is rotated and each coordinate kept as its sign: ``dim`` packed bits and two
scalars, the length and the inner product c of the rotated unit vector with its sign vector.  For a
query the inner product is estimated as |o| <signs, q> / c, and the estimate's error is bounded by
|o| |q| sqrt(1 - c^2) / c * EPSILON / sqrt(dim - 1) but with tiny probability.  The rotated query is
rounded to a few bits a coordinate, so <signs, q> is a sum of counts of common bits of packed words; what
rounding can change is part of the bound.  Candidates whose upper bound falls below the k-th best lower
bound are out; the others are reranked by exact inner products in double precision.  That happens where
the block is: at 64 dimensions some fifth of all candidates stays within the bounds, too many to send.

Queries meet candidates in blocks.  A first round over an eighth of the candidates gives each query a
score that its k-th neighbour reaches at least, so in the second round blocks return few rows however
many there are.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, prepare, release, tidy

EPSILON = 3.0
SEED = 5
#: Rows of a block of candidates, and of a block of queries, at most about; blocks for parallelism at least.
CANDIDATES, QUERIES, LEAST_BLOCKS = 65_536, 32_768, 12
#: Bytes of the vectors of a block of candidates, at most about, and half as many of queries.
BLOCK_BYTES = 64 << 20
PILOT = 8
#: Bits of a rounded query's coordinate, and pairs of a query and a candidate in memory at once.
PLANES, PAIRS = 6, 1 << 21
CODE = "vec_id {id}, dim int, norm float, fit float, code binary, embedding array<float>"


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: not null, not empty, all components finite, not all zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def build_index(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, norm, fit (c above), code (packed signs) and the vector itself, for every usable row."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            column = b.column(1)
            sizes = np.diff(column.offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                rows = b.filter(pa.array(sizes == dim))
                v = matrix(rows.column(1))
                norm = np.sqrt((v * v).sum(1))
                turned = (v / norm[:, None]) @ rotation(dim).T
                fit = np.abs(turned).sum(1) / np.sqrt(dim)
                code = np.packbits(turned >= 0, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(v), dim, np.int32)), pa.array(norm.astype(np.float32)), pa.array(fit.astype(np.float32)), pa.array([c.tobytes() for c in code], pa.binary()), rows.column(1)],
                    ["vec_id", "dim", "norm", "fit", "code", "embedding"],
                )

    prepare(vectors.sparkSession)
    return usable(vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))).mapInArrow(tidy(run), CODE.format(id=kind))


def words(packed: np.ndarray) -> np.ndarray:
    """Rows of packed bits as 64-bit words."""
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def rounded(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(low, step, summed error, bit planes as words) of rotated queries: low + step * (number in the planes)."""
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / (2**PLANES - 1), 1e-30)
    number = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    error = np.abs(low[:, None] + step[:, None] * number - turned).sum(1)
    return low, step, error, [words(np.packbits((number >> b) & 1, axis=1)) for b in range(PLANES)]


def signs_times(codes: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the sign vectors that ``codes`` pack with each rotated query, and how far each query's may be off."""
    low, step, error, planes = rounded(turned)
    common = np.zeros((len(codes), len(turned)), np.float32)
    for b, plane in enumerate(planes):
        count = np.zeros(common.shape, np.uint16)
        for w in range(codes.shape[1]):
            count += np.bitwise_count(codes[:, w, None] & plane[None, :, w])
        common += count * np.float32(2**b)
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64).astype(np.float32)
    own = sum(np.bitwise_count(p).sum(1, dtype=np.int64) * 2.0**b for b, p in enumerate(planes))
    inside = ones[:, None] * low.astype(np.float32) + common * step.astype(np.float32)
    return 2 * inside - (low * turned.shape[1] + step * own).astype(np.float32), error.astype(np.float32)


def scan(k: int):
    """The function for one block: queries (role 1, ``least`` a score to reach) against candidates (role 0)."""

    def run(block: pa.Table) -> pa.Table:
        role = block.column("role").to_numpy()
        own, other = block.filter(pa.array(role == 1)), block.filter(pa.array(role == 0))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(own) and len(other):
            ids = other.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            vectors = other.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)  # as given
            norm, fit = (other.column(c).to_numpy()[order] for c in ("norm", "fit"))
            dim = vectors.shape[1]
            codes = words(np.frombuffer(b"".join(other.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)[order])
            scale = (norm / np.maximum(fit, 1e-6) / np.sqrt(dim)).astype(np.float32)
            slack = (norm * np.sqrt(np.maximum(1 - fit**2, 0)) / np.maximum(fit, 1e-6) * EPSILON / np.sqrt(max(dim - 1, 1))).astype(np.float32) + norm * np.float32(1e-5)
            q_ids, queries, least = own.column("vec_id").to_numpy(), matrix(own.column("embedding")), own.column("least").to_numpy()
            chunk = max(1, PAIRS // len(ids))
            for at in range(0, len(q_ids), chunk):
                q = queries[at : at + chunk]
                lengths = np.sqrt((q * q).sum(1)).astype(np.float32)
                estimate, error = signs_times(codes, q @ rotation(dim).T)
                estimate *= scale[:, None]
                bound = slack[:, None] * lengths + scale[:, None] * error
                own_row = ids[:, None] == q_ids[at : at + chunk]
                low = np.where(own_row, -np.inf, estimate - bound)
                nth = np.partition(low, len(ids) - k, axis=0)[len(ids) - k] if len(ids) > k else np.full(len(q), -np.inf)
                reach = np.maximum(nth, least[at : at + chunk].astype(np.float32) - np.float32(1e-5) * np.abs(least[at : at + chunk]).astype(np.float32))
                hopeful = (estimate + bound >= reach) & ~own_row
                for j in range(len(q)):
                    rows = np.flatnonzero(hopeful[:, j])
                    score = np.cumsum(vectors[order[rows]].astype(np.float64) * q[j], axis=1)[:, -1]  # one order of summation for all
                    best = np.lexsort((ids[rows], -score))[:k]
                    best = best[score[best] >= least[at + j]]
                    out.append((np.full(len(best), q_ids[at + j]), ids[rows][best], score[best]))
        parts = [np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(zip(*out) if out else ((), (), ()), (np.int64, np.int64, np.float64))]
        release()
        return pa.table({"query_id": pa.array(parts[0], pa.int64()), "vec_id": pa.array(parts[1], pa.int64()), "score": pa.array(parts[2], pa.float64())})

    return run


def meet(index: DataFrame, queries: DataFrame, rows: int, asked: int, dim: int, k: int) -> DataFrame:
    """The k best candidates of each query in each block: query_id, vec_id, score.  ``dim``: the longest vectors'."""
    fit = max(1, BLOCK_BYTES // (4 * max(dim, 1)))  # vectors of a block, in bytes
    c = max(-(-rows // min(CANDIDATES, fit)), min(LEAST_BLOCKS, max(1, rows // 256)))
    q = max(1, -(-asked // min(QUERIES, max(1, fit // 2))))
    left = index.select(
        F.lit(0).alias("role"), "dim", F.pmod(F.xxhash64("vec_id", "code"), F.lit(c)).cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(q - 1))).alias("q"),
        "vec_id", "norm", "fit", "code", "embedding", F.lit(float("-inf")).alias("least"),
    )
    right = queries.select(
        F.lit(1).alias("role"), "dim", F.explode(F.sequence(F.lit(0), F.lit(c - 1))).alias("c"), F.pmod(F.xxhash64("vec_id", "code"), F.lit(q)).cast("int").alias("q"),
        "vec_id", "norm", "fit", F.lit(None).cast("binary").alias("code"), "embedding", "least",
    )
    return left.unionByName(right).groupBy("dim", "c", "q").applyInArrow(scan(k), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """The ``k`` nearest rows of each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision; ties go to the smaller vec_id.  Rows with
    the query's own id are no candidates.  A null or zero vector, one with null or non-finite
    components, or a null id takes no part; vectors of different lengths do not meet.  Of queries
    with the same id one is asked.  With fewer candidates all are returned.
    """
    ready = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    index = cut(build_index(ready), "index")
    rows, dim = index.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(0))).first()
    asked = index.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0)
    asked = asked.groupBy("vec_id").agg(F.min_by(F.struct("dim", "norm", "fit", "code", "embedding"), "embedding").alias("v")).select("vec_id", "v.*")
    asked = cut(asked.withColumn("least", F.lit(float("-inf"))), "queries")
    n = asked.count()
    if rows > PILOT * 64 * k:
        pilot = index.where(F.pmod(F.xxhash64("vec_id"), F.lit(PILOT)) == 0)
        found = meet(pilot, asked, rows // PILOT, n, dim, k).groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
        least = found.where(F.size("s") >= k).select(F.col("query_id").alias("vec_id"), F.element_at("s", k).alias("reached"))
        asked = cut(asked.join(least, "vec_id", "left").withColumn("least", F.coalesce("reached", "least")).drop("reached"), "bounded")
    met = meet(index, asked, rows, n, dim, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
