"""Hard negatives, mined exactly over shared lists of anchor clusters.

Anchors are clustered by direction. For a cluster with centre c and radius r (the largest angle of a
member to c), |v| cos(max(0, angle(v, c) - r)) times a member's length is an upper bound of its inner
product with v. Candidates of a block are sorted by that bound once for each cluster; every member
walks the shared list until the next bound is below what its result still needs, which certifies that
nothing further on can enter. A walk answers goals: the k best rows of the anchor's label (or of
others) with a score between `low` and `high`.

Spark deals the work. Candidates lie in blocks by their nearest centre, small cells together and large
ones split by row number; anchors in deals likewise. A first pass walks one block of the anchor's own
cell, which raises `low` to the k-th best score there. Then the largest bound of each block and cluster
is held against what the cluster's goals need, and only block and cluster pairs that can still matter
move vectors. Blocks and deals have bounded sizes, so memory is bounded however rows are spread. The
centres are fitted to a bounded sample of anchors and set the speed only.

Defined results: rows with a NULL label or vector, or with a NULL or non-finite component, take no
part. Vectors of different lengths are never compared. A repeated row is another row (of its own id);
a repeated anchor is another anchor. Equal scores go by vec_id (NULL first), then row. An anchor
without positives, a positive without negatives and empty tables give no rows. Scores are exact while
they fit in 64 bits. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabq.llm.common import small_batches, stored

SCALE = 256
CLUSTERS, SAMPLE, ITERATIONS = 128, 4096, 6
BLOCK, DEAL = 16384, 4096  # candidates in a block, anchors in a deal
STEP = 512  # places of a list that are walked at once
NONE = -(1 << 62)
EXACT = 1 << 52


def _prepare(batches):
    for batch in batches:
        keep, data = [], []
        for i, row in enumerate(batch.column("vector")):
            if row.is_valid and len(row):
                x = row.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
                if np.isfinite(x).all():  # NULL is NaN here
                    keep.append(i)
                    data.append(np.floor(SCALE * x).astype(np.int64))
        own = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*(own.column(c) for c in ("row", "vec_id", "label", "is_anchor")),
             pa.array([len(x) for x in data], pa.int32()), pa.array([x.tobytes() for x in data])],
            ["row", "vec_id", "label", "is_anchor", "dim", "data"])


def _vectors(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zeros for a zero vector) and lengths."""
    real = vectors.astype(float)
    length = np.sqrt((real ** 2).sum(1))
    return real / np.maximum(length, 1e-300)[:, None], length


def fit(sample: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """Unit centres by spherical k-means, neighbours in order of a walk from centre to nearest centre."""
    units, _ = directions(sample)
    units = np.unique(units, axis=0)
    at = np.linspace(0, len(units) - 1, min(clusters, len(units))).astype(int)
    centres = units[at]
    for _ in range(ITERATIONS):
        own = (units @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        length = np.sqrt((sums ** 2).sum(1))
        centres = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-300)[:, None], centres)
    order, left = [0], set(range(1, len(centres)))
    while left:
        order.append(max(left, key=lambda j: float(centres[order[-1]] @ centres[j])))
        left.remove(order[-1])
    return centres[order]


def deals(counts: list[tuple[int, int, int]], most: int) -> list[tuple[int, int, int]]:
    """(cluster, first deal, parts) for (dim, cluster, rows): neighbours of one dim share a deal while
    they fit, a cluster of more rows than `most` is split."""
    made, deal, held, last = [], -1, 0, None
    for dim, cluster, n in sorted(counts):
        parts = max(1, -(-n // most))
        if dim != last or parts > 1 or held + n > most:
            deal, held = deal + 1, 0
        made.append((cluster, deal, parts))
        held += n
        deal += parts - 1
        if parts > 1:
            held = most
        last = dim
    return made


def bounds(units: np.ndarray, length: np.ndarray, centre: np.ndarray, radius) -> np.ndarray:
    """Upper bounds of the inner products with unit vectors within `radius` of `centre`."""
    angle = np.arccos(np.clip(units @ centre.T, -1, 1))
    return length.reshape(-1, *[1] * (angle.ndim - 1)) * np.cos(np.maximum(angle - radius, 0))


def walk(anchors: np.ndarray, of: np.ndarray, rows: np.ndarray, labels: np.ndarray, low: np.ndarray,
         high: np.ndarray, block: tuple, centre: np.ndarray, radius: float, k: int, same: bool):
    """Goals of one cluster against one block: (goal, candidate, score) of each goal's k best, and the
    number of scores computed. `of` names each goal's anchor; rows and labels are the anchors'."""
    vectors, ids, block_rows, block_labels = block
    units, length = directions(vectors)
    bound = bounds(units, length, centre, radius)
    order = np.argsort(-bound, kind="stable")
    own_length = directions(anchors)[1]
    most = float(length.max(initial=0))
    exact = float((own_length.max(initial=0) or 0) * most) >= EXACT
    left, right = (anchors, vectors) if exact else (anchors.astype(float), vectors.astype(float))
    slack = 1 + 1e-7 * own_length * most
    need = low.copy()  # a score below it cannot enter
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in of]
    live, scored = np.arange(len(of)), 0
    for at in range(0, len(order), STEP):
        some = order[at:at + STEP]
        who = of[live]
        live = live[bound[some[0]] * own_length[who] + slack[who] >= need[live]]
        if not len(live):
            break
        met, back = np.unique(of[live], return_inverse=True)
        scores = (left[met] @ right[some].T).astype(np.int64)
        scored += scores.size
        allowed = ((block_labels[some][None] == labels[met][:, None]) == same) & (
            block_rows[some][None] != rows[met][:, None])
        scores = np.where(allowed, scores, NONE - 1)[back]
        fits = (scores >= need[live][:, None]) & (scores <= high[live][:, None])
        for g in np.flatnonzero(fits.any(1)):
            goal = live[g]
            new = np.flatnonzero(fits[g])
            found = np.concatenate((best[goal][0], some[new]))
            value = np.concatenate((best[goal][1], scores[g][new]))
            top = np.lexsort((block_rows[found], ids[found], -value))[:k]
            best[goal] = found[top], value[top]
            if len(top) == k:
                need[goal] = max(need[goal], value[top[-1]])
    return [(g, int(c), int(s)) for g, (cs, ss) in enumerate(best) for c, s in zip(cs, ss)], scored


class _Search:
    """Rows with cells, blocks and deals, and passes over pairs of deals and blocks."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        centres, first = {}, 0  # at most CLUSTERS for each length of vectors
        for r in rows.where("is_anchor").select("dim").distinct().orderBy("dim").collect():
            sample = rows.where((F.col("dim") == r.dim) & F.col("is_anchor")).orderBy(
                F.xxhash64("row"), "row").limit(SAMPLE).select("data").collect()
            own = fit(np.frombuffer(b"".join(bytes(s.data) for s in sample), np.int64).reshape(-1, r.dim))
            centres[r.dim] = first, own
            first += len(own)
        self.centres = spark.sparkContext.broadcast(centres)
        self.rows = stored(self._placed(rows.where(F.col("dim").isin(list(centres)))))
        cells = self.rows.groupBy("dim", "cluster").agg(
            F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors"),
            F.max(F.when(F.col("is_anchor"), F.col("angle"))).alias("radius")).collect()
        self.radius = spark.sparkContext.broadcast({c.cluster: c.radius for c in cells if c.anchors})
        places = {c: (b, p) for c, b, p in deals([(c.dim, c.cluster, c.n) for c in cells], BLOCK)}
        dealt = deals([(c.dim, c.cluster, c.anchors) for c in cells if c.anchors], DEAL)
        dealt = {c: (d, p) for c, d, p in dealt}
        table = [(c, *places[c], *dealt.get(c, (None, None))) for c in places]
        known = F.broadcast(spark.createDataFrame(  # a row for each cluster
            table, "cluster int, first_block int, blocks int, first_deal int, deals int"))
        hash_ = F.xxhash64("row")
        self.rows = self.rows.join(known, "cluster").withColumns({
            "block": (F.col("first_block") + F.pmod(hash_, F.col("blocks"))).cast("int"),
            "deal": (F.col("first_deal") + F.pmod(hash_, F.col("deals"))).cast("int")})
        self.anchors = self.rows.where("is_anchor").select(
            "dim", "deal", "cluster", F.col("block").alias("home"), F.col("row").alias("anchor_row"),
            F.col("vec_id").alias("anchor_id"), "label", "data", "length")
        self.bounds = stored(self._block_bounds())

    def _placed(self, rows):
        centres = self.centres

        def run(batches):
            for batch in batches:
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                    first, points = centres.value[int(dim)]
                    units, length = directions(_vectors(own.column("data"), dim))
                    near = units @ points.T
                    cluster = near.argmax(1)
                    angle = np.arccos(np.clip(near[np.arange(len(near)), cluster], -1, 1))
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array((first + cluster).astype(np.int32)), pa.array(angle),
                         pa.array(length)], [*own.schema.names, "cluster", "angle", "length"])

        return rows.mapInArrow(run, "row long, vec_id long, label long, is_anchor boolean, dim int, "
                                    "data binary, cluster int, angle double, length double")

    def _block_bounds(self):
        """The largest bound of each block for each cluster of anchors."""
        centres, radius = self.centres, self.radius

        def run(key, table):
            dim = table.column("dim")[0].as_py()
            first, points = centres.value[dim]
            units, length = directions(_vectors(table.column("data"), dim))
            known = [(first + j, radius.value[first + j]) for j in range(len(points))
                     if first + j in radius.value]
            most = [float(bounds(units, length, points[c - first], r).max()) for c, r in known]
            return pa.table({"block": pa.array([key[0].as_py()] * len(known), pa.int32()),
                             "cluster": pa.array([c for c, _ in known], pa.int32()),
                             "bound": pa.array(most, pa.float64()),
                             "longest": pa.array([float(length.max())] * len(known), pa.float64())})

        return self.rows.select("block", "dim", "data").groupBy("block").applyInArrow(
            run, "block int, cluster int, bound double, longest double")

    def _pass(self, goals, k, same):
        """goals (with the block each visits) against those blocks."""
        centres, radius = self.centres, self.radius

        def run(key, left, right):
            dim = left.column("dim")[0].as_py() if left.num_rows else 0
            found, score = [], []
            if left.num_rows and right.num_rows:
                block = (_vectors(right.column("data"), dim),
                         right.column("vec_id").fill_null(NONE).to_numpy(),
                         right.column("row").to_numpy(), right.column("label").to_numpy())
                clusters = left.column("cluster").to_numpy()
                first, points = centres.value[dim]
                low, high = (left.column(c).to_numpy() for c in ("low", "high"))
                anchor = left.column("anchor_row").to_numpy()
                label = left.column("label").to_numpy()
                for c in np.unique(clusters):
                    at = np.flatnonzero(clusters == c)
                    rows, one, of = np.unique(anchor[at], return_index=True, return_inverse=True)
                    data = _vectors(left.column("data").take(pa.array(at[one])), dim)
                    best, _ = walk(data, of, rows, label[at[one]], low[at], high[at], block,
                                   points[c - first], radius.value[int(c)], k, same)
                    found += [(at[g], v) for g, v, _ in best]
                    score += [s for *_, s in best]
            goal = pa.array([g for g, _ in found], pa.int64())
            other = pa.array([v for _, v in found], pa.int64())
            return pa.table([left.column("anchor_row").take(goal), left.column("goal").take(goal),
                             right.column("row").take(other), right.column("vec_id").take(other),
                             pa.array(score, pa.int64())],
                            ["anchor_row", "goal", "row", "vec_id", "score"])

        visits = goals.select("deal", "block").distinct()
        block = self.rows.select(F.col("block").alias("of_block"), "row", "vec_id", "label", "data")
        sent = visits.join(block, F.col("block") == F.col("of_block")).drop("of_block")
        sides = [df.select([F.col(c).alias(c) for c in df.columns]) for df in (goals, sent)]
        return sides[0].groupBy("deal", "block").cogroup(sides[1].groupBy("deal", "block")).applyInArrow(
            run, "anchor_row long, goal int, row long, vec_id long, score long")

    def best(self, goals: DataFrame, k: int, same: bool) -> DataFrame:
        """anchor_row, goal, rank, row, vec_id, score: the k best rows of each goal. goals: anchors with
        goal, low and high."""
        near = stored(self._pass(goals.withColumn("block", F.col("home")), k, same))
        kth = near.groupBy("anchor_row", "goal").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        kth = kth.where(F.col("n") == k).drop("n")
        raised = goals.join(kth, ["anchor_row", "goal"], "left").withColumn(
            "low", F.greatest("low", "kth")).drop("kth")
        need = raised.groupBy("deal", "cluster").agg(F.min(
            F.when((F.col("low") > NONE) & (F.col("length") > 0), F.col("low") / F.col("length"))
            .otherwise(F.lit(float("-inf")))).alias("need"),
            F.min(F.when(F.col("length") > 0, F.col("length"))).alias("shortest"))
        reach = F.col("bound") + 1e-7 * F.col("longest") + F.coalesce(1 / F.col("shortest"), F.lit(0.0))
        pairs = need.join(self.bounds, "cluster").where(reach >= F.col("need")).select(
            "deal", "cluster", "block")
        rest = raised.join(pairs, ["deal", "cluster"]).where(F.col("block") != F.col("home"))
        found = near.unionByName(self._pass(rest, k, same))
        order = Window.partitionBy("anchor_row", "goal").orderBy(F.desc("score"), "vec_id", "row")
        return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor, label="label", positives: int = 5, negatives: int = 3,
         least: int = 50, most: int = 95, vec_id: str = "vec_id",
         vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for every row for
    which is_anchor (a column) holds and each of its best `positives` other rows of the same label, the
    best `negatives` rows of other labels that score `least` to `most` per cent of the positive."""
    small_batches(vectors.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        F.col(vector).cast("array<double>").alias("vector")).where("label IS NOT NULL")
    search = _Search(stored(rows.mapInArrow(_prepare, "row long, vec_id long, label long, "
                                                      "is_anchor boolean, dim int, data binary")))
    found = stored(search.best(
        search.anchors.withColumns({"goal": F.lit(0), "low": F.lit(NONE), "high": F.lit(-NONE)}),
        positives, same=True))
    part = "(positive_score * {0} - pmod(positive_score * {0}, 100)) div 100"  # rounded down
    chosen = found.select("anchor_row", F.col("rank").alias("goal"), F.col("vec_id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
    goals = search.anchors.join(chosen, "anchor_row").withColumns({
        "low": -F.expr(part.format(-least)), "high": F.expr(part.format(most))})
    goals = goals.where("low <= high")
    best = search.best(goals.drop("positive_id", "positive_score"), negatives, same=False)
    names = goals.select("anchor_row", "goal", "anchor_id", "positive_id", "positive_score")
    return best.join(names, ["anchor_row", "goal"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
