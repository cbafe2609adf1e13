"""Exact top-k search by inner product: columnar branch and bound.

Candidates are packed into blocks whose components lie column by column (vertical layout). For a block of queries and
a block of candidates, scores grow one slice of dimensions at a time. After each slice, what the rest can still add
is bounded by the product of the remaining norms (Cauchy-Schwarz); candidates that no longer reach any query's k-th
lower bound leave the block, which is compacted before the next slice. Spark pairs every query block with every
candidate block (the stated query set against all rows, in blocks) and merges the k best of each pair.

Defined results: vectors that are null, or hold a null or non-finite component, take no part; of several rows with one
query id the smallest vector asks (one answer per id), while each of them is a candidate for others; rows with the
query's id are never its candidates; ties go to the smaller id; fewer than k candidates give fewer ranks; a null id
neither asks nor is found; vectors of other lengths are padded with zeros; scores are exact while every partial sum
fits a 64-bit integer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 4
_OUT = "query_id long, vec_id long, score long"


def integer_components(vector: Column | str, scale: int = 64) -> Column:
    """``floor(scale * x)`` of every component as long; null where the vector can't take part."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(doubles, lambda x: F.floor(F.lit(float(scale)) * x).cast("long")))


def _packed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One block in vertical layout: ids and a (dimension, row) matrix as bytes."""
    vectors = rows.column("v").combine_chunks()
    lengths = vectors.value_lengths().to_numpy()
    dims = int(lengths.max())
    matrix = np.zeros((dims, len(lengths)), np.int64)
    if (lengths == dims).all():
        matrix[:] = vectors.flatten().to_numpy().reshape(-1, dims).T
    else:
        for i, row in enumerate(vectors.to_pylist()):
            matrix[:len(row), i] = row
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                     "ids": pa.array([rows.column("id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                     "v": pa.array([matrix.tobytes()], pa.binary()), "dims": pa.array([dims], pa.int32())})


def _blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Pack rows (``id``, ``v``) into blocks of about ``size`` rows, dealt by row number so that repeats spread."""
    count = max(1, -(-rows.count() // size))
    dealt = rows.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).alias("block"), "id", "v")
    return dealt.groupBy("block").applyInArrow(_packed, "block long, ids binary, v binary, dims int"), count


def best(queries: tuple[np.ndarray, np.ndarray], candidates: tuple[np.ndarray, np.ndarray], k: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Branch and bound over one pair of blocks: (query row, candidate row, score) of each query's k best."""
    (qid, q), (cid, c) = queries, candidates
    dims = max(len(q), len(c))
    q, c = (np.pad(x, ((0, dims - len(x)), (0, 0))) for x in (q, c))
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(dims, 1)
    kind = np.float64 if top < 2.0 ** 52 else np.int64  # both exact; doubles use the fast matrix product
    qf, cf = q.astype(kind), c.astype(kind)
    cuts = np.linspace(0, dims, min(SLICES, max(dims, 1)) + 1).astype(int)
    squares = lambda x, a: np.sqrt(np.square(x[a:].astype(np.float64)).sum(0)) * (1 + 1e-9)
    score = np.zeros((q.shape[1], c.shape[1]), kind)
    alive = np.arange(c.shape[1])
    own = qid[:, None] == cid[None, :]
    for a, b in zip(cuts, cuts[1:], strict=False):
        score += qf[a:b].T @ cf[a:b][:, alive]
        if b == dims or len(alive) <= k + 1:
            continue
        rest = squares(q, b)[:, None] * squares(c[:, alive], b)[None, :] * (1 + 1e-9) + 1
        low = np.where(own[:, alive], -np.inf, score - rest)
        kth = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] >= k else np.full(len(low), -np.inf)
        keep = ((score + rest >= kth[:, None]) & ~own[:, alive]).any(0)
        if not keep.all():
            alive, score = alive[keep], score[:, keep]
    out = []
    for i in range(len(qid)):
        at = np.flatnonzero(cid[alive] != qid[i])
        s = score[i, at]
        if len(at) > k:
            at = at[s >= np.partition(s, -k)[-k]]
            s = score[i, at]
        first = np.lexsort((cid[alive[at]], -s))[:k]
        out.append((np.full(len(first), i), alive[at[first]], s[first]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def top_k(queries: DataFrame, candidates: DataFrame, id_col: str = "vec_id", vector: str = "v", k: int = 20,
          query_block: int = 512, candidate_block: int = 8192) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer inner products over all candidates.

    ``vector`` is an array of longs (see ``integer_components``); other columns are ignored.
    """
    rows = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v")).where(
        "id is not null and v is not null")
    asked = rows(queries).groupBy("id").agg(F.min("v").alias("v"))
    q, _ = _blocks(asked, query_block)
    c, n = _blocks(rows(candidates), candidate_block)
    q = q.select("ids", "v", "dims", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("block"))
    pairs = q.join(c.select("block", F.col("ids").alias("c_ids"), F.col("v").alias("c_v"),
                            F.col("dims").alias("c_dims")), "block")

    def search(batches):
        load = lambda ids, v, dims: (np.frombuffer(ids, np.int64), np.frombuffer(v, np.int64).reshape(dims, -1)
                                     if dims else np.zeros((0, len(ids) // 8), np.int64))
        for batch in batches:
            for r in batch.to_pylist():
                asks, found = load(r["ids"], r["v"], r["dims"]), load(r["c_ids"], r["c_v"], r["c_dims"])
                i, j, s = best(asks, found, k)
                yield pa.RecordBatch.from_arrays([pa.array(asks[0][i]), pa.array(found[0][j]),
                                                  pa.array(s.astype(np.int64))], names=["query_id", "vec_id", "score"])

    found = pairs.select("ids", "v", "dims", "c_ids", "c_v", "c_dims").mapInArrow(search, _OUT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
