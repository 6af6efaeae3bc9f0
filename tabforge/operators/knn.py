"""Exact k-nearest neighbours.

Brute-force kNN must compare each query with each reference row, but it need
not *materialise* those pairs, and no vector has to pass through the driver.
The plan is a block nested-loop join expressed with shuffles:

* queries are cut into ``QB`` batches (each at most ``max_query_bytes`` of
  vectors) and references into ``R`` blocks (each at most ``block_bytes``);
* every query row is replicated to the ``R`` reference blocks of its batch and
  every reference row to the ``QB`` batches (``explode`` of a small sequence);
* ``cogroup`` on (batch, block) hands one task one query batch and one
  reference block; a NumPy kernel (``applyInPandas``, Arrow batches) bounds
  all squared distances from below by matrix products in bounded chunks,
  computes exactly those that a query's k best so far do not rule out, and
  emits only the local top-k per query;
* a window over at most ``k x R`` candidates per query keeps the global top-k.

Ties are broken by reference id, so the result is deterministic; the sizes
come from two scalar aggregates.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NO_LABEL = np.iinfo(np.int32).min  # stands for NULL inside the kernel
CANDIDATE_SCHEMA = "query_id long, nbr_id long, nbr_label int, dist double"


#: Queries of one product, and references of the first, which gives the bound for the others.
QUERY_ROWS = 1024
FIRST_ROWS = 512


def _merge(bd, bi, bl, rows, cols, q_mat, t_mat, q_ids, t_ids, t_lab, exclude_self: bool) -> None:
    """Takes the pairs (query row, reference row) into the best of each query, by their exact distance, then id."""
    with np.errstate(over="ignore", invalid="ignore"):
        diff = q_mat[rows] - t_mat[cols]
        d2 = np.einsum("nd,nd->n", diff, diff)
    ok = np.isfinite(d2)
    if exclude_self:
        ok &= q_ids[rows] != t_ids[cols]
    rows, cols, d2 = rows[ok], cols[ok], d2[ok]
    if not len(rows):
        return
    k, met = bd.shape[1], np.unique(rows)
    of = np.concatenate([np.repeat(met, k), rows])
    d, i, lab = (np.concatenate([b[met].ravel(), new]) for b, new in ((bd, d2), (bi, t_ids[cols]), (bl, t_lab[cols])))
    order = np.lexsort((i, d, of))
    first = order[np.searchsorted(of[order], met)[:, None] + np.arange(k)[None, :]]
    bd[met], bi[met], bl[met] = d[first], i[first], lab[first]


def _block_topk(k: int, exclude_self: bool, chunk_bytes: int):
    def run(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"query_id": pd.Series([], dtype="int64"),
                                 "nbr_id": pd.Series([], dtype="int64"),
                                 "nbr_label": pd.Series([], dtype="int32"),
                                 "dist": pd.Series([], dtype="float64")})
        q_ids = q["id"].to_numpy(np.int64)
        q_mat = np.vstack(q["vec"].to_numpy()).astype(np.float64)
        t_ids = r["id"].to_numpy(np.int64)
        t_lab = r["label"].fillna(NO_LABEL).to_numpy(np.int64)
        t_mat = np.vstack(r["vec"].to_numpy()).astype(np.float64)
        nq, dim = q_mat.shape
        best_d = np.full((nq, k), np.inf)
        best_i = np.full((nq, k), np.iinfo(np.int64).max, dtype=np.int64)
        best_l = np.full((nq, k), NO_LABEL, dtype=np.int64)
        # one product gives a lower bound of every squared distance: qn + tn - 2 q.t less what its rounding can be
        slack = 16 * (dim + 8) * np.finfo(float).eps
        with np.errstate(over="ignore", invalid="ignore"):
            qn, tn = (np.einsum("nd,nd->n", m, m) for m in (q_mat, t_mat))
            q_aug = np.column_stack([-2.0 * q_mat, np.ones(nq), qn * (1.0 - slack)])
            t_aug = np.column_stack([t_mat, tn * (1.0 - slack), np.ones(len(t_ids))])
        width = max(1, min(QUERY_ROWS, chunk_bytes // 8))
        step = max(1, chunk_bytes // (8 * width))
        pairs = max(1, chunk_bytes // (8 * max(1, dim)))
        for a in range(0, nq, width):
            here = slice(a, a + width)
            bd, bi, bl = best_d[here], best_i[here], best_l[here]
            s, size = 0, min(step, FIRST_ROWS)
            while s < len(t_ids):
                part = slice(s, s + size)
                ti = t_ids[part]
                with np.errstate(over="ignore", invalid="ignore"):
                    low = q_aug[here] @ t_aug[part].T
                    limit = bd[:, -1]
                    if s == 0 and len(ti) > k:
                        # no distance passes its lower bound by more than twice the slack: the k-th of these bounds the k-th
                        high = low + 4 * slack * (qn[here][:, None] + tn[part][None, :])
                        if exclude_self:
                            high[q_ids[here][:, None] == ti[None, :]] = np.inf
                        limit = np.partition(high, k - 1, axis=1)[:, k - 1]
                    # what is not a number is taken too, as is what lies where rounding is not relative
                    rows, cols = np.nonzero(~(low > limit[:, None] + np.finfo(float).tiny))
                for c in range(0, len(rows), pairs):
                    _merge(bd, bi, bl, rows[c:c + pairs], cols[c:c + pairs], q_mat[here], t_mat[part], q_ids[here], ti, t_lab[part], exclude_self)
                s, size = s + size, step
        found = np.isfinite(best_d)
        keep = found.copy()
        keep[:, 0] = True  # a query without any neighbour here keeps one empty row
        qi = np.repeat(q_ids, k).reshape(nq, k)
        empty = ~found[keep]
        label = best_l[keep]
        return pd.DataFrame({
            "query_id": qi[keep],
            "nbr_id": pd.array(np.where(empty, 0, best_i[keep]), dtype="Int64").copy(),
            "nbr_label": pd.array(label, dtype="Int32"),
            "dist": np.sqrt(best_d[keep])}).assign(
                nbr_id=lambda d: d["nbr_id"].mask(empty),
                nbr_label=lambda d: d["nbr_label"].mask(empty | (label == NO_LABEL)),
                dist=lambda d: d["dist"].mask(empty))
    return run


def knn_neighbours(reference: DataFrame, queries: DataFrame, k: int, id_col: str,
                   vec_col: str, label_col: str | None = None, exclude_self: bool = False,
                   max_query_bytes: int = 64 << 20, block_bytes: int = 128 << 20,
                   chunk_bytes: int = 32 << 20) -> DataFrame:
    """``(query_id, nbr_id, nbr_label, dist, rank)`` for the k nearest
    reference rows of every query row (Euclidean, Minkowski p=2).

    A vector that holds NaN or infinity is near nothing: as a reference it is
    never a neighbour, as a query it keeps one row with NULL neighbour, label and
    distance. A reference without a label is a neighbour with a NULL label."""
    spark = reference.sparkSession
    ref = reference.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vec_col).cast("array<double>").alias("vec"),
                           (F.col(label_col) if label_col else F.lit(None)).cast("int").alias("label"))
    qs = queries.select(F.col(id_col).cast("long").alias("id"),
                        F.col(vec_col).cast("array<double>").alias("vec"))
    qstat = qs.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    n_ref = ref.count()
    if not qstat["n"] or not n_ref:
        return spark.createDataFrame([], CANDIDATE_SCHEMA + ", rank int")
    row_bytes = 8 * max(1, qstat["d"]) + 16
    n_qb = max(1, math.ceil(qstat["n"] * row_bytes / max_query_bytes))
    n_rb = max(spark.sparkContext.defaultParallelism, math.ceil(n_ref * row_bytes / block_bytes))
    # both sides must use identical key types, or their hash partitions differ
    q_rep = qs.select(
        F.pmod(F.xxhash64("id"), F.lit(n_qb)).cast("int").alias("_qb"),
        F.explode(F.sequence(F.lit(0), F.lit(n_rb - 1))).alias("_rb"), "id", "vec")
    r_rep = ref.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))).alias("_qb"),
        F.pmod(F.xxhash64("id"), F.lit(n_rb)).cast("int").alias("_rb"), "id", "vec", "label")
    cands = (q_rep.groupBy("_qb", "_rb")
             .cogroup(r_rep.groupBy("_qb", "_rb"))
             .applyInPandas(_block_topk(k, exclude_self, chunk_bytes), CANDIDATE_SCHEMA))
    w = Window.partitionBy("query_id").orderBy(F.col("dist").asc_nulls_last(), "nbr_id")
    ranked = cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.where((F.col("rank") == 1) | F.col("nbr_id").isNotNull())


def knn_votes(neighbours: DataFrame, outs: dict[str, str]) -> DataFrame:
    """Class votes over the neighbours, several weightings in one pass.

    ``outs`` maps output column -> 'uniform' or 'distance'. Distance weights
    are 1/d, and a zero distance takes all the weight; ties go to the lowest
    class. The neighbours frame is already partitioned by query (top-k
    window), so the zero-distance flag adds no shuffle. Neighbours without a
    label do not vote; a query without any voter gets a NULL prediction.
    """
    w = Window.partitionBy("query_id")
    nb = neighbours
    has_zero = F.max(((F.col("dist") == 0) & F.col("nbr_label").isNotNull()).cast("int")).over(w) == 1
    dist_w = F.when(has_zero, (F.col("dist") == 0).cast("double")).otherwise(
        F.try_divide(F.lit(1.0), F.col("dist")))
    weight = {"uniform": F.lit(1.0), "distance": dist_w}
    nb = nb.withColumns({f"_w_{o}": weight[s] for o, s in outs.items()})
    votes = nb.groupBy("query_id", "nbr_label").agg(
        *[F.sum(f"_w_{o}").alias(f"_s_{o}") for o in outs])
    return votes.groupBy("query_id").agg(*[
        F.max_by(F.col("nbr_label"), F.when(F.col("nbr_label").isNotNull(),
                                            F.struct(F.col(f"_s_{o}"), -F.col("nbr_label")))).alias(o)
        for o in outs])


def knn_vote(neighbours: DataFrame, weights: str = "uniform", out: str = "prediction"
             ) -> DataFrame:
    """L17 with one weighting (see ``knn_votes``)."""
    return knn_votes(neighbours, {out: weights})
