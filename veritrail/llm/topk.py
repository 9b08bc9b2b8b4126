"""Exact top-k search by distributed histogram selection.

Queries go in blocks of bounded size against all rows. For a block, every row is scored; each
query's histogram of scores is summed over the tasks and refined around the bin that holds the
kth value, until few rows lie at or above that bin's edge or the bin is one value wide. Then rows
from the edge up are kept (each task at most its own k best of them) and ranked, ties to the
smaller id. The driver holds one block's queries and their bin edges.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Queries of a block.
BLOCK = 2048
BINS = 128


#: Scores are 64-bit integers; what is beyond counts as the last of them.
MOST = 2**63 - 1
#: Bins of scores that lie within this many of 0 are told by 64-bit arithmetic, others by Python's integers.
NARROW = 2**61
#: Rows of components below this are multiplied as floats or 64-bit integers; others as Python's integers.
PLAIN = 2**25


def _vectors(column, dims=None):
    """Rows of usable vectors as floor(1024 x), and which rows they are."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, heads = column.flatten(), None
    size = np.nan_to_num(np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=float)).astype(np.int64)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    heads = np.concatenate([[0], np.cumsum(size)])
    bad = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(~np.isfinite(values), out=bad[1:])
    fine = (bad[heads[1:]] == bad[heads[:-1]]) & np.asarray(column.is_valid())
    rows = np.flatnonzero(fine)
    dims = dims if dims is not None else int(size.max(initial=0))
    out = np.zeros((len(rows), dims), dtype=np.float64)
    for n in np.unique(size[rows]):
        same = size[rows] == n
        if n:
            m = min(int(n), dims)
            out[same, :m] = values[heads[rows[same]][:, None] + np.arange(m)]
    if np.abs(out).max(initial=0.0) < PLAIN:
        return rows, np.floor(1024 * out)
    whole = np.empty(out.shape, dtype=object)
    whole[...] = [[math.floor(1024 * x) if abs(x) < 1e300 else 1024 * int(x) for x in row] for row in out.tolist()]
    return rows, whole


def _lengths(vectors) -> np.ndarray:
    """Euclidean lengths, of long integers roughly and at most 1e150 a component."""
    if vectors.dtype == object:
        vectors = np.array([[float(min(abs(x), 10**150)) for x in row] for row in vectors.tolist()]).reshape(vectors.shape)
    return np.sqrt((vectors**2).sum(axis=1))


def _tops(x) -> np.ndarray:
    """Each row's largest component as a float, of long integers at most 1e300."""
    if x.dtype == object:
        return np.array([float(min(max(map(abs, row), default=0), 10**300)) for row in x.tolist()], dtype=float)
    return np.abs(x).max(axis=1, initial=0)


def _scores(block, vectors):
    """Integer inner products, exact within MOST: floats while sums stay below 2**53, 64-bit integers below 2**62, then Python's."""
    tops, dims = [_tops(x) for x in (block, vectors)], max(block.shape[1], 1)
    if max(tops[0], default=0) * max(tops[1], default=0) * dims < 2**53:
        return (block.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    a, b = (np.where((t < 2.0**62)[:, None], x, 0).astype(np.int64) for x, t in zip((block, vectors), tops, strict=True))
    out = a @ b.T
    with np.errstate(over="ignore"):
        far = tops[0][:, None] * tops[1][None, :] * dims >= 2.0**62
    if far.any():
        long = [[[int(v) for v in row] for row in x.tolist()] for x in (block, vectors)]
        for k, j in zip(*np.nonzero(far), strict=True):
            out[k, j] = max(-MOST, min(MOST, sum(u * v for u, v in zip(long[0][k], long[1][j], strict=True))))
    return out


def _batches(batches, state):
    """(ids, row marks, scores, own) of the candidates; own: the query's own row."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            ids, marks = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            rows, vectors = _vectors(part.column(1), state["vectors"].shape[1])
            if len(rows):
                ids, marks = ids[rows], marks[rows]
                yield ids, _scores(state["vectors"], vectors), state["marks"][:, None] == marks[None, :]


def _histogram(shared):
    def run(batches):
        import pyarrow as pa

        state = shared.value
        low, width, n = state["low"], state["width"], len(state["marks"])
        total = np.zeros((n, BINS + 1), dtype=np.int64)
        for _, scores, own in _batches(batches, state):
            at = np.clip((scores.astype(low.dtype) - low[:, None]) // width[:, None], -1, BINS).astype(np.int64)
            at[own] = -1
            q, c = np.nonzero(at >= 0)
            total += np.bincount(q * (BINS + 1) + at[q, c], minlength=n * (BINS + 1)).reshape(n, BINS + 1)
        q, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[q, b])], names=["q", "bin", "n"]
        )

    return run


def _above(shared, k):
    def run(batches):
        import pyarrow as pa

        state = shared.value
        n, low = len(state["marks"]), state["low"]
        keep = {}
        for ids, scores, own in _batches(batches, state):
            at = (scores >= low[:, None]).astype(bool) & ~own
            for q in np.flatnonzero(at.any(axis=1)):
                c = np.flatnonzero(at[q])
                v, s = ids[c], scores[q, c]
                if q in keep:
                    v, s = np.concatenate([keep[q][0], v]), np.concatenate([keep[q][1], s])
                best = np.lexsort((v, -s))[:k]
                keep[q] = v[best], s[best]
        for q in range(n):
            if q in keep:
                v, s = keep[q]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), state["no"][q])), pa.array(v.astype(np.int64)), pa.array(s)],
                    names=["no", "vec_id", "score"],
                )

    return run


def _block_answers(rows: DataFrame, no, marks, vectors, k: int) -> DataFrame:
    """(no, vec_id, score) with the k best of every query, named by its number."""
    spark = rows.sparkSession
    reach = rows.mapInArrow(_norms(vectors.shape[1]), "norm double").agg(F.max("norm")).first()[0] or 0.0
    # a float's last digits may be lost, so one in a million more
    wide = [min(int(x * 1.000001) + 2, 2**63) for x in _lengths(vectors) * reach]
    bound = np.array(wide, dtype=np.int64 if max(wide, default=0) < NARROW else object)
    low, high = -bound, bound + 1
    done = np.zeros(len(no), dtype=bool)
    while not done.all():
        width = np.maximum(1, high // BINS - low // BINS + 1)
        state = {"marks": marks, "vectors": vectors, "low": np.where(done, 2**62 if low.dtype != object else 2**70, low), "width": width}
        shared = spark.sparkContext.broadcast(state)
        kind = "q int, bin int, n long"
        counts = rows.mapInArrow(_histogram(shared), kind).groupBy("q", "bin").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin")))
        # the bin where the running count from the top reaches k, or the lowest bin of all
        cut = (
            counts.withColumn("upto", upto)
            .groupBy("q")
            .agg(
                F.max(F.when(F.col("upto") >= k, F.struct("bin", "upto", "n"))).alias("at"),
                F.max("upto").alias("all"),
            )
        )
        found = {r["q"]: r for r in cut.collect()}  # a row a query of the block
        for q in np.flatnonzero(~done):
            r = found.get(int(q))
            if r is None or r["at"] is None:
                done[q] = True  # fewer than k rows: all from ``low`` up
            elif r["at"]["upto"] <= 4 * k or width[q] == 1:
                low[q] += r["at"]["bin"] * width[q]
                done[q] = True
            else:
                low[q], high[q] = low[q] + r["at"]["bin"] * width[q], low[q] + (r["at"]["bin"] + 1) * width[q]
        shared.unpersist()
    shared = spark.sparkContext.broadcast({"no": no, "marks": marks, "vectors": vectors, "low": low})
    return rows.mapInArrow(_above(shared, k), "no long, vec_id long, score long")


def _norms(dims):
    def run(batches):
        import pyarrow as pa

        most = 0.0
        for batch in batches:
            _, vectors = _vectors(batch.column(1), dims)
            most = max(most, float(_lengths(vectors).max(initial=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array([most])], names=["norm"])

    return run


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
    row_col: str | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of every query row.

    Vectors are floor(1024 x). Null vectors and such with a null or non-finite component take no
    part; a shorter vector is filled up with zeros, components beyond the longest query are left
    out. Rows with a null id take no part. Scores beyond 64 bits count as the last number of them. ``row_col``
    names a column that tells the rows of both tables apart: then only the query's own row is no
    candidate, and of rows that share an id each is asked and found for itself. Without it no row
    of the query's id is a candidate. Equal rows of one id give equal answers, each its own.
    """
    spark = rows.sparkSession
    usable = lambda df: df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.col(row_col or id_col).cast("long").alias("mark"),
    ).where("id is not null and vector is not null")
    rows = usable(rows)
    asked = written(usable(queries).withColumn("no", F.monotonically_increasing_id()), "queries")
    n = asked.count()
    parts = 1 if n <= block else -(-n // (block // 2))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("no"), F.lit(parts)))
    if parts > 1:
        asked = written(asked.repartition("part"), "queries")
    every = None
    for p in range(parts):
        held = asked.where(F.col("part") == p).toArrow()  # one block: about ``block`` vectors
        pos, vectors = _vectors(held.column("vector"))
        if len(pos):
            no, marks = (held.column(c).to_numpy()[pos] for c in ("no", "mark"))
            got = written(_block_answers(rows, no, marks, vectors, k), "answers")
            every = got if every is None else every.union(got)
    if every is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "vec_id"))
    best = every.withColumn("rank", rank).where(F.col("rank") <= k)
    names = asked.select("no", F.col("id").alias("query_id"))
    return best.join(names, "no").select("query_id", "rank", "vec_id", "score")


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 10
"""
