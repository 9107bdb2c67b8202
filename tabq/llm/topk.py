"""Exact top-k by inner product with pivot-table elimination.

Components become whole numbers, so scores are exact. With one more coordinate, sqrt(M - |v|^2) for
a candidate and 0 for a query (M: the largest squared length), a larger inner product is a smaller
distance. The table of distances to the pivots gives, by the triangle inequality, a lower bound for
each query and candidate: the largest |d(q, p) - d(v, p)|. In a block candidates are evaluated in the
order of their bounds until the k-th best score beats every bound that is left: what is not evaluated
cannot be among the best. Pivots are far-apart vectors of a bounded sample; they set the speed only.

Queries and candidates are dealt into blocks by row number, so equal vectors or ids make no block
larger, and every pair of blocks is one task's work in bounded memory.

Defined results: a vector that is NULL or holds NULL or non-finite components takes no part. Vectors
of different lengths are never compared. A repeated row is another candidate; a repeated query row is
another query. Equal scores go by vec_id (NULL first), then row. Queries without any candidate and
empty tables give no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabq.llm.common import checkpoint

SCALE = 256
PIVOTS = 32
SAMPLE = 2000  # vectors that pivots are chosen from, of each length
CANDIDATES, QUERIES = 4096, 2048  # rows in a block
STEP = 128  # candidates evaluated at once
EXACT = 1 << 52


def _prepare(batches):
    for batch in batches:
        keep, dims, data, squares = [], [], [], []
        for i, row in enumerate(batch.column("vector")):
            if not row.is_valid:
                continue
            x = row.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
            if not np.isfinite(x).all():  # NULL is NaN here
                continue
            whole = np.floor(SCALE * x).astype(np.int64)
            keep.append(i)
            dims.append(len(whole))
            data.append(whole.tobytes())
            squares.append(float((whole.astype(float) ** 2).sum()))
        own = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [own.column("row"), own.column("vec_id"), own.column("is_query"),
             pa.array(dims, pa.int32()), pa.array(data, pa.binary()), pa.array(squares, pa.float64())],
            names=["row", "vec_id", "is_query", "dim", "data", "square"])


def pick_pivots(sample: np.ndarray, most: float, count: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Up to `count` vectors that are far from each other, and their extra coordinates."""
    extra = np.sqrt(np.maximum(most - (sample ** 2).sum(1), 0))
    points = np.column_stack([sample, extra])
    chosen, far = [0], np.full(len(points), np.inf)
    while len(chosen) < min(count, len(points)):
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return sample[chosen], extra[chosen]


def distances(vectors: np.ndarray, extra: np.ndarray, pivots: np.ndarray,
              pivot_extra: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, in the space with one more coordinate."""
    square = ((vectors ** 2).sum(1) + extra ** 2)[:, None] + (
        (pivots ** 2).sum(1) + pivot_extra ** 2)[None]
    inner = vectors @ pivots.T + extra[:, None] * pivot_extra[None]
    return np.sqrt(np.maximum(square - 2 * inner, 0))


def search(queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
           rows: np.ndarray, most: float, pivots: np.ndarray, pivot_extra: np.ndarray, k: int):
    """(query, candidate, score) positions of each query's k best, its own row left out."""
    real, real_queries = vectors.astype(float), queries.astype(float)
    extra = np.sqrt(np.maximum(most - (real ** 2).sum(1), 0))
    table = distances(real, extra, pivots, pivot_extra)
    of_query = distances(real_queries, np.zeros(len(queries)), pivots, pivot_extra)
    exact = vectors if len(vectors) == 0 or most >= EXACT else real
    slack = 1e-9 * (most + 1) + 1
    found = []
    for q in range(len(queries)):
        low = np.abs(table - of_query[q]).max(1)
        square = (real_queries[q] ** 2).sum()
        bound = (square + most - low ** 2) / 2 + slack * (1 + square / (most + 1))
        order = np.argsort(-bound, kind="stable")
        best = np.zeros(0, np.int64)
        scores = np.zeros(0, np.int64)
        for at in range(0, len(order), STEP):
            if len(best) == k and scores[-1] > bound[order[at]]:
                break
            some = order[at:at + STEP]
            some = some[rows[some] != query_rows[q]]
            one = queries[q] if exact is vectors else real_queries[q]
            best = np.concatenate((best, some))
            scores = np.concatenate((scores, (exact[some] @ one).astype(np.int64)))
            top = np.lexsort((rows[best], ids[best], -scores))[:k]
            best, scores = best[top], scores[top]
        found += [(q, int(b), int(s)) for b, s in zip(best, scores)]
    return found


def _blocks(shared, k):
    names = ["query_row", "query_id", "row", "vec_id", "score"]

    def run(key, left, right):
        dim = key[0].as_py()
        most, pivots, extra = shared.value[dim]
        sides = []
        for table in (left, right):
            data = table.column("data").to_pylist()
            vectors = np.frombuffer(b"".join(data), np.int64).reshape(len(data), dim)
            sides.append((table, vectors, table.column("row").to_numpy(),
                          table.column("vec_id").fill_null(np.iinfo(np.int64).min).to_numpy()))
        (a, queries, query_rows, _), (b, vectors, rows, ids) = sides
        found = search(queries, query_rows, vectors, ids, rows, most, pivots, extra, k)
        q = pa.array([x for x, _, _ in found], pa.int64())
        v = pa.array([x for _, x, _ in found], pa.int64())
        return pa.Table.from_arrays(
            [a.column("row").take(q), a.column("vec_id").take(q), b.column("row").take(v),
             b.column("vec_id").take(v), pa.array([s for _, _, s in found], pa.int64())], names)

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every row for which is_query
    (a column) holds."""
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.col(vector).cast("array<double>").alias("vector"))
    rows = checkpoint(rows.mapInArrow(_prepare, "row long, vec_id long, is_query boolean, dim int, "
                                      "data binary, square double"))
    spark, shared, blocks = vectors.sparkSession, {}, []
    for d in rows.groupBy("dim").agg(F.max("square").alias("most"), F.count("*").alias("n"),
                                     F.count_if("is_query").alias("queries")).collect():
        sample = rows.where(F.col("dim") == d.dim).orderBy(F.xxhash64("row")).limit(SAMPLE).select(
            "data").collect()
        sample = np.frombuffer(b"".join(bytes(r.data) for r in sample), np.int64)
        shared[d.dim] = d.most, *pick_pivots(sample.reshape(-1, d.dim).astype(float), d.most)
        blocks.append((d.dim, -(-d.n // CANDIDATES), max(1, -(-d.queries // QUERIES))))
    sizes = spark.createDataFrame(blocks, "dim int, c int, q int")  # a row for each length
    rows = rows.join(F.broadcast(sizes), "dim").withColumn("hash", F.xxhash64("row"))
    c, q = F.pmod("hash", F.col("c")).cast("int"), F.pmod("hash", F.col("q")).cast("int")
    deal = ("dim", "c_block", "q_block")
    queries = rows.where("is_query").withColumn("q_block", q).withColumn(
        "c_block", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    candidates = rows.withColumn("c_block", c).withColumn(
        "q_block", F.explode(F.sequence(F.lit(0), F.col("q") - 1)))
    of = [F.col(c).alias(c) for c in (*deal, "row", "vec_id", "data")]  # new names for each side
    found = queries.select(of).groupBy(*deal).cogroup(candidates.select(of).groupBy(*deal)).applyInArrow(
        _blocks(spark.sparkContext.broadcast(shared), k),
        "query_row long, query_id long, row long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
