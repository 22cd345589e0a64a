"""Exact top-k by inner product with Fagin's threshold algorithm.

Queries and candidates are dealt over tasks in blocks. A task sorts each block of candidates
once per dimension and walks all lists in step for many queries at once (from the end that
a query's sign favours), scores what is met for the first time in full, and drops a query
from the walk when no unseen vector can reach its kth score. The kth score carries over from
block to block. Each task gives its k best for each query; a ranking of those is exact.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, pick
from tickforge.llm.fagin import (
    BLOCK_ROWS, WALKERS, Best, Lists, deal, highest, matrices, products, score_columns, usable,
)

#: Components count as floor(SCALE * x).
SCALE = 64


def search(lists: Lists, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, slots, best: Best):
    """Walk one block for the queries of ``slots``; the number of rows met."""

    def score(rows, walkers):
        found = products(lists.vectors[rows], queries[walkers])
        for line in np.flatnonzero(np.isin(own[walkers], ids[rows])):
            found[line, ids[rows] == own[walkers[line]]] = -np.inf
        least = best.kth[slots[walkers]]
        if (least == -np.inf).any():
            least = np.maximum(least, highest(found, best.k))
        fits = found >= least[:, None]
        if (least == -np.inf).any():
            fits &= found > -np.inf
        line, row = np.nonzero(fits)
        best.add(slots[walkers[line]], found[line, row], ids[rows[row]])
        return best.kth[slots[walkers]]

    return lists.walk(queries, score)


def _best_of_part(k: int, names):
    def run(asked: pa.Table, met: pa.Table) -> pa.Table:
        own, ids = (t.column("id").to_numpy() for t in (asked, met))
        best = Best(len(own), k)
        if len(own) and len(ids):
            queries = list(matrices(asked.column("vector"), SCALE))
            for rows, vectors in matrices(met.column("vector"), SCALE):
                for first in range(0, len(rows), BLOCK_ROWS):
                    block = slice(first, first + BLOCK_ROWS)
                    lists, block_ids = Lists(vectors[block]), ids[rows[block]]
                    for slots, wanted in queries:
                        if wanted.shape[1] != vectors.shape[1]:
                            continue
                        for start in range(0, len(slots), WALKERS):
                            part = slots[start : start + WALKERS]
                            walkers = wanted[start : start + WALKERS]
                            search(lists, block_ids, walkers, own[part], part, best)
        slot, scores, found = best.rows()
        columns = [pa.array(own[slot], pa.int64()), pa.array(found, pa.int64())]
        return pa.table([*columns, *score_columns(scores)], names=names)

    return run


def top_k(queries: DataFrame, df: DataFrame, k=20, id_column="vec_id", vector="embedding"):
    """Per query the k highest scores: query_id, rank (from 1), vec_id, score.

    Components count as floor(64 * x), scores are integer inner products, ties go to the
    smaller vec_id, and a query's own id is no candidate. Vectors that are null, empty, hold
    null or non-finite components, or have no id take no part; vectors of another length
    than the query are no candidates for it. Of query rows that repeat an id the one with
    the smallest vector is asked; candidates that repeat an id are ranked once each. Scores
    are compared exactly; one outside the range of a long is returned as the nearer end.
    """
    doubles = F.transform("vector", lambda x: x.cast("double")).alias("vector")

    def vectors(rows):
        rows = pick(rows, id=id_column, vector=vector)
        return rows.where(usable(rows)).select(F.col("id").cast("long").alias("id"), doubles)

    with Scratch(df.sparkSession, "topk") as scratch:
        asked = vectors(queries).groupBy("id").agg(F.min("vector").alias("vector"))
        names = {"query_id": "bigint", "vec_id": "bigint", "score": "bigint", "beyond": "binary"}
        left, right = deal(scratch.keep(asked), vectors(df), df.count())
        found = left.cogroup(right).applyInArrow(
            _best_of_part(k, list(names)), ", ".join(f"{n} {t}" for n, t in names.items())
        )
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return scratch.keep(ranked.select("query_id", "rank", "vec_id", "score"), last=True)
