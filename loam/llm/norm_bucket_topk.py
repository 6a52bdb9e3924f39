"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are sorted by length and cut into buckets of similar length.  For a query
with a known lower bound ``theta`` on its k-th best score, a bucket whose longest
vector is ``l`` can only help if ``theta / (|q| l) <= 1``: that is the bucket's
*local cosine threshold*.  A bucket with a low threshold is pruned by length (only
its vectors of length ``theta / |q|`` or more are tried); one with a high threshold is
pruned by coordinates: on the query's largest coordinates a candidate's normalised
value must lie in the interval that the cosine leaves open.  Survivors are verified
with integer products.

The lower bound comes from the longest vectors, the same ones for every query.
Queries travel in blocks and meet the buckets that their threshold leaves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.session import materialize

BUCKET = 2048            # candidates in a bucket at most
BLOCK = 512              # queries that travel together
COORD_FROM = 0.6         # local cosine threshold from which coordinates prune
FOCUS = 3                # coordinates looked at
SLACK = 1e-9             # for rounding in the pruning bounds; products are exact

_VECTOR = "vec_id long, dim int, norm double, vec binary"
_FOUND = "query_id long, vec_id long, score long"


def integer_vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """Rows (vec_id, dim, norm, vec): floor(scale * x) as little-endian longs.

    Null vectors, vectors with null or non-finite components and rows without an
    id take no part.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, out = rows.column(0).to_pylist(), []
            for i, v in zip(ids, rows.column(1), strict=True):
                if i is None or not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                z = np.floor(scale * x).astype("<i8")
                out.append((i, z.size, float(np.sqrt((z.astype(np.float64) ** 2).sum())), z.tobytes()))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.float64()),
                 pa.array(cols[3], pa.binary())], names=["vec_id", "dim", "norm", "vec"])

    return table.select("vec_id", "embedding").mapInArrow(run, _VECTOR)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products: through float64 where all sums stay below 2**53."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[-1], 1)
    if top < 2.0 ** 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x @ q


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then smaller id."""
    if scores.size > 4 * k:
        edge = -np.partition(-scores, k - 1)[k - 1]
        place = np.flatnonzero(scores >= edge)
    else:
        place = np.arange(scores.size)
    return place[np.lexsort((ids[place], -scores[place]))][:k]


class Bucket:
    """Candidates in order of falling length."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, vecs: np.ndarray):
        order = np.lexsort((ids, -norms))
        self.ids, self.norms, self.vecs = ids[order], norms[order], vecs[order]
        self.unit = self.vecs / np.maximum(self.norms, 1e-300)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _list(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of coordinate ``c``, sorted, and whose they are."""
        if c not in self._lists:
            order = np.argsort(self.unit[:, c], kind="stable")
            self._lists[c] = (self.unit[order, c], order)
        return self._lists[c]

    def candidates(self, q: np.ndarray, norm: float, theta: float) -> np.ndarray:
        """Places that may reach ``theta``."""
        if theta <= 0 or norm == 0 or not self.ids.size:
            return np.arange(self.ids.size)
        n = int(np.searchsorted(-self.norms, -theta / norm * (1 - SLACK), side="right"))
        if not n:
            return np.arange(0)
        cos = min(1.0, theta / (norm * self.norms[0]) * (1 - SLACK))
        if cos < COORD_FROM:
            return np.arange(n)
        unit = q / norm
        keep: np.ndarray | None = None
        for c in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            # cos(p, q) >= cos forces |p_c - q_c cos(p, q)| <= sqrt((1 - q_c^2)(1 - cos(p, q)^2))
            reach = np.sqrt(max(0.0, 1 - unit[c] ** 2) * (1 - cos * cos))
            lo, hi = unit[c] * cos - reach, unit[c] * cos + reach
            if unit[c] >= cos:          # the extreme lies inside the allowed cone
                hi = 1.0
            if unit[c] <= -cos:
                lo = -1.0
            vals, owner = self._list(int(c))
            part = owner[np.searchsorted(vals, lo - 1e-7):np.searchsorted(vals, hi + 1e-7, side="right")]
            keep = part if keep is None else np.intersect1d(keep, part, assume_unique=True)
        return keep[keep < n]


_BLOCK = "block long, dim int, longest double, ids binary, norms binary, vecs binary"


def _pack(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one dimension and of neighbouring lengths, longest first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(dim: int, rows: list) -> pa.RecordBatch:
            ids, norms, vecs = zip(*rows, strict=True)
            cols = [[ids[0]], [dim], [norms[0]], [np.array(ids, "<i8").tobytes()], [np.array(norms, "<f8").tobytes()],
                    [b"".join(vecs)]]
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                              names=["block", "dim", "longest", "ids", "norms", "vecs"])

        held: list = []
        now = None
        for rows in batches:
            for i, d, norm, v in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if held and (d != now or len(held) == size):
                    yield emit(now, held)
                    held = []
                now = d
                held.append((i, norm, v))
        if held:
            yield emit(now, held)

    ordered = vectors.select("vec_id", "dim", "norm", "vec").repartitionByRange("dim", F.desc("norm"), "vec_id")
    return ordered.sortWithinPartitions("dim", F.desc("norm"), "vec_id").mapInArrow(run, _BLOCK)


def _unpack(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[side + "ids"], "<i8")
    return ids, np.frombuffer(row[side + "norms"], "<f8"), np.frombuffer(row[side + "vecs"], "<i8").reshape(ids.size, -1)


def top_products(table: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each vector whose id ``every`` divides.

    Ties go to the smaller vec_id; a vector is no candidate of its own id; vectors
    of another dimension have no product with the query.  Repeated rows count once;
    an empty table gives an empty result; other columns are not read.
    """
    vectors = materialize(integer_vectors(table).dropDuplicates(["vec_id", "vec"]))
    buckets = materialize(_pack(vectors, BUCKET))
    blocks = _pack(vectors.filter(F.col("vec_id") % every == 0), BLOCK)

    # a first bound: each block against the one longest bucket of its dimension
    lead = buckets.groupBy("dim").agg(F.max(F.struct("longest", "block")).alias("lead"))
    lead = buckets.join(lead, "dim").filter((F.col("longest") == F.col("lead.longest")) & (F.col("block") == F.col("lead.block")))
    lead = lead.select("dim", F.col("ids").alias("c_ids"), F.col("norms").alias("c_norms"), F.col("vecs").alias("c_vecs"))

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                (qi, qn, qv), (ci, _, cv) = _unpack(row, ""), _unpack(row, "c_")
                theta = np.full(qi.size, -np.inf)
                for j in range(qi.size):
                    scores = _products(qv[j], cv)[ci != qi[j]]
                    if scores.size >= k:
                        theta[j] = np.partition(scores, scores.size - k)[scores.size - k]
                # shortest candidate that may matter to any query of the block
                useful = np.where(theta > 0, theta / np.maximum(qn, 1e-300) * (1 - SLACK), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]], t) for c, t in (("block", pa.int64()), ("dim", pa.int32()), ("longest", pa.float64()),
                                                        ("ids", pa.binary()), ("norms", pa.binary()), ("vecs", pa.binary()))]
                    + [pa.array([theta.tobytes()], pa.binary()), pa.array([float(useful.min())])],
                    names=["block", "dim", "longest", "ids", "norms", "vecs", "theta", "reach"])

    blocks = materialize(blocks.join(lead, "dim").mapInArrow(bound, _BLOCK + ", theta binary, reach double"))

    # directory rows only: which bucket may matter to which block; dealt over salts so that one dimension is no hot key
    salts = 64
    near = buckets.select("dim", F.col("block").alias("bucket"), F.col("longest").alias("b_longest"),
                          F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"))
    far = blocks.select("dim", "block", "reach", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    pairs = far.join(near, ["dim", "salt"]).filter(F.col("b_longest") >= F.col("reach")).select("dim", "block", "bucket")
    met = pairs.join(blocks.select("dim", "block", "ids", "norms", "vecs", "theta"), ["dim", "block"]).join(
        buckets.select("dim", F.col("block").alias("bucket"), F.col("ids").alias("c_ids"),
                       F.col("norms").alias("c_norms"), F.col("vecs").alias("c_vecs")), ["dim", "bucket"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                (qi, qn, qv), bucket = _unpack(row, ""), Bucket(*_unpack(row, "c_"))
                theta, found = np.frombuffer(row["theta"]), []
                for j in range(qi.size):
                    at = bucket.candidates(qv[j], qn[j], theta[j])
                    at = at[bucket.ids[at] != qi[j]]
                    if not at.size:
                        continue
                    scores = _products(qv[j], bucket.vecs[at])
                    good = scores >= theta[j]
                    at, scores = at[good], scores[good]
                    top = _best(bucket.ids[at], scores, k)
                    found += [(int(qi[j]), int(bucket.ids[at[t]]), int(scores[t])) for t in top]
                cols = list(zip(*found, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["query_id", "vec_id", "score"])

    found = met.select("ids", "norms", "vecs", "theta", "c_ids", "c_norms", "c_vecs").mapInArrow(search, _FOUND)
    # at most k rows of a query from each bucket; repeated ids of one vector's versions count each
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
