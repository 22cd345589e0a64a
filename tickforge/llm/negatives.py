"""Hard negatives of anchors by Fagin's threshold algorithm.

First the positives: each anchor's highest-scoring other rows of its own label, found over
lists of that label alone. Each positive opens a window of scores, from a share of its own
score up to that score. Then the negatives: one walk over lists of all rows serves the
windows of an anchor together; rows of another label whose score lies in a window compete
for its places, and the walk ends once the threshold is strictly below the score that every
window still needs: its kth, or its lower end while it is not full.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, pick
from tickforge.llm.fagin import (
    BLOCK_ROWS, WALKERS, Best, Lists, deal, matrices, products, score_columns, usable,
)
from tickforge.llm.topk import search

#: Components count as floor(SCALE * x).
SCALE = 256


def labelled(df: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, label, vector) of the rows that have all three."""
    rows = pick(df, id=id_column, label=label, vector=vector)
    return rows.where(usable(rows) & F.col("label").isNotNull()).select(
        F.col("id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.transform("vector", lambda x: x.cast("double")).alias("vector"),
    )


def _positives(k: int, names):
    def run(asked: pa.Table, met: pa.Table) -> pa.Table:
        own, ids = (t.column("id").to_numpy() for t in (asked, met))
        theirs, labels = (t.column("label").to_numpy() for t in (asked, met))
        best = Best(len(own), k)
        if len(own) and len(ids):
            queries = list(matrices(asked.column("vector"), SCALE))
            for rows, vectors in matrices(met.column("vector"), SCALE):
                order = np.argsort(labels[rows], kind="stable")
                rows, vectors = rows[order], vectors[order]
                for label in np.unique(labels[rows]):
                    of_label = np.flatnonzero(labels[rows] == label)
                    for first in range(0, len(of_label), BLOCK_ROWS):
                        block = of_label[first : first + BLOCK_ROWS]
                        lists = Lists(vectors[block])
                        for slots, wanted in queries:
                            same = np.flatnonzero(theirs[slots] == label)
                            if wanted.shape[1] != vectors.shape[1]:
                                continue
                            for start in range(0, len(same), WALKERS):
                                part = same[start : start + WALKERS]
                                search(
                                    lists, ids[rows[block]], wanted[part],
                                    own[slots[part]], slots[part], best,
                                )
        slot, scores, found = best.rows()
        columns = [pa.array(own[slot], pa.int64()), pa.array(found, pa.int64())]
        exact = pa.array([str(int(s)) for s in scores], pa.string())
        return pa.table([*columns, *score_columns(scores), exact], names=names)

    return run


def _numbers(values: list[int]) -> np.ndarray:
    """Doubles, or Python integers where those are not exact."""
    return np.array(values, float if all(abs(v) < 2**53 for v in values) else object)


def mine(lists, ids, labels, queries, own_labels, slots, caps, lows, best):
    """Walk one block for the windows (lows[i, w] to caps[i, w]) of the anchors ``slots``."""
    windows = caps.shape[1]
    closed = lows > caps

    def score(rows, walkers):
        found = products(lists.vectors[rows], queries[walkers])
        other = own_labels[walkers][:, None] != labels[rows][None]
        least = np.full(len(walkers), np.inf)
        for w in range(windows):
            places = slots[walkers] * windows + w
            needed = np.maximum(lows[walkers, w], best.kth[places])
            fits = (found <= caps[walkers, w][:, None]) & (found >= needed[:, None])
            line, row = np.nonzero(fits & other & ~closed[walkers, w][:, None])
            best.add(places[line], found[line, row], ids[rows[row]])
            needed = np.maximum(lows[walkers, w], best.kth[places])
            least = np.minimum(least, np.where(closed[walkers, w], np.inf, needed))
        return least

    return lists.walk(queries, score)


def _negatives(k: int, windows: int, share: int, names):
    def run(asked: pa.Table, met: pa.Table) -> pa.Table:
        own, ids = (t.column("id").to_numpy() for t in (asked, met))
        theirs, labels = (t.column("label").to_numpy() for t in (asked, met))
        scores = [[int(s) for s in line] for line in asked.column("scores").to_pylist()]
        # A missing positive is a window that nothing fits.
        caps = _numbers([s for line in scores for s in [*line, *[-1] * (windows - len(line))]])
        ends = [[-(-share * s // 100) for s in line] for line in scores]
        lows = _numbers([s for line in ends for s in [*line, *[0] * (windows - len(line))]])
        caps, lows = caps.reshape(-1, windows), lows.reshape(-1, windows)
        best = Best(len(own) * windows, k)
        if len(own) and len(ids):
            queries = list(matrices(asked.column("vector"), SCALE))
            for rows, vectors in matrices(met.column("vector"), SCALE):
                for first in range(0, len(rows), BLOCK_ROWS):
                    block = slice(first, first + BLOCK_ROWS)
                    lists = Lists(vectors[block])
                    for slots, wanted in queries:
                        if wanted.shape[1] != vectors.shape[1]:
                            continue
                        for start in range(0, len(slots), WALKERS):
                            part = slots[start : start + WALKERS]
                            mine(
                                lists, ids[rows[block]], labels[rows[block]],
                                wanted[start : start + WALKERS], theirs[part], part,
                                caps[part], lows[part], best,
                            )
        slot, scores, found = best.rows()
        columns = [pa.array(x, pa.int64()) for x in (own[slot // windows], slot % windows, found)]
        return pa.table([*columns, *score_columns(scores)], names=names)

    return run


def _schema(names: dict) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in names.items())


def hard_negatives(
    anchors: DataFrame, df: DataFrame, positives=5, k=5, share=80,
    id_column="vec_id", vector="embedding", label="label",
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Components count as floor(256 * x); a row's score is its integer inner product with the
    anchor, higher ones first, ties by smaller id. An anchor's positives are its first five
    rows of the same label with another id. Negatives of a positive are the first five rows
    of another label that score from ``share`` per cent of the positive's score up to it.

    Rows without id, label or vector, with an empty vector, or with a null or non-finite
    component take no part; rows whose vector has another length than the anchor's are none
    of its rows. Of anchor rows that repeat an id the smallest (label, vector) counts; other
    rows that repeat an id count once each. A positive without negatives gives no row.
    Scores are compared exactly; one beyond a long is returned as the nearer end of its range.
    """
    with Scratch(df.sparkSession, "negatives") as scratch:
        first = F.min(F.struct("label", "vector")).alias("row")
        asked = labelled(anchors, id_column, vector, label).groupBy("id").agg(first)
        asked = scratch.keep(asked.select("id", "row.*"))
        rows, most = labelled(df, id_column, vector, label), df.count()

        score = {"score": "bigint", "beyond": "binary"}
        names = {"id": "bigint", "positive_id": "bigint", **score, "exact": "string"}
        left, right = deal(asked, rows, most)
        found = left.cogroup(right).applyInArrow(_positives(positives, list(names)), _schema(names))
        best = Window.partitionBy("id").orderBy(F.desc("score"), F.desc("beyond"), "positive_id")
        chosen = scratch.keep(
            found.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < positives)
        )

        listed = F.sort_array(F.collect_list(F.struct("place", "exact")))
        windows = chosen.groupBy("id").agg(listed.alias("listed"))
        windows = windows.select("id", F.col("listed.exact").alias("scores"))
        names = {"id": "bigint", "place": "bigint", "negative_id": "bigint", **score}
        left, right = deal(scratch.keep(asked.join(windows, "id")), rows, most)
        found = left.cogroup(right).applyInArrow(
            _negatives(k, positives, share, list(names)), _schema(names)
        )
        order = [F.desc("score"), F.desc("beyond"), "negative_id"]
        best = Window.partitionBy("id", "place").orderBy(*order)
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        of = chosen.select("id", "place", "positive_id", F.col("score").alias("positive_score"))
        return scratch.keep(
            ranked.join(of, ["id", "place"]).select(
                F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id",
                "positive_score", F.col("score").alias("negative_score"),
            ),
            last=True,
        )
