"""Fagin's threshold algorithm for blocks of queries against blocks of vectors.

Vectors become whole numbers, ``floor(scale * x)``, and scores are exact inner products:
in double precision where a checked bound keeps every sum below 2**53, in Python's integers
beyond. ``Lists`` sorts a block of vectors by every dimension and walks all lists in step,
for many queries at once, from the end that a query's sign favours; rows met for the first
time are scored in full, and a query leaves the walk as soon as no unseen vector can reach
the least score that is still of use to it. ``deal`` lays queries and vectors out over tasks
so that each block of queries meets each part of the vectors once.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Queries and vectors that one task holds at most, about.
QUERY_ROWS = 65_536
PART_ROWS = 65_536
#: Vectors sorted together, queries that walk together, and entries of the first step.
BLOCK_ROWS = 8192
WALKERS = 512
STEP = 32
#: Components beyond this are walked apart from the rest, as their sums may need integers.
LARGE = 2**20

_EXACT = 2**53
_LONG = 2**63 - 1


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles; Python integers where the product overflows."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if np.isfinite(scaled).all():
        return scaled
    # Doubles as large as those are whole.
    exact = [int(s) if np.isfinite(s) else int(x) * scale for s, x in zip(scaled.flat, values.flat)]
    return np.array(exact, object).reshape(values.shape)


def _integers(values: np.ndarray) -> np.ndarray:
    if values.dtype == object:
        return values
    return np.array([int(x) for x in values.flat], object).reshape(values.shape)


def products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products, a line for each query: doubles, or Python integers if too large."""
    if not rows.size or not queries.size:
        return np.zeros((len(queries), len(rows)))
    most = [max(int(x.max()), -int(x.min())) for x in (rows, queries)]
    largest = most[0] * most[1] * rows.shape[1]
    if max(largest, *most) <= _EXACT:
        return queries.astype(float, copy=False) @ rows.astype(float, copy=False).T
    return _integers(queries) @ _integers(rows).T


class Lists:
    """One block of vectors, sorted by every dimension."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)

    def walk(self, queries: np.ndarray, score) -> int:
        """Walk the lists for all ``queries``; the number of rows met.

        ``score(rows, walkers)`` takes the rows met for the first time and gives, for each of
        the walkers (indices of queries), the least score that is still of use. A query stops
        when no unseen row can reach that; an unseen one that only equals it may still win
        by its id.
        """
        n, dimensions = self.vectors.shape
        up, down = queries > 0, queries < 0
        above, below = np.where(up, queries, 0), np.where(down, queries, 0)
        walkers, seen, low, depth = np.arange(len(queries)), np.zeros(n, bool), 0, STEP
        while len(walkers) and not seen.all():
            depth = min(depth, n)
            fresh = np.zeros(n, bool)
            fresh[self.order[up[walkers].any(axis=0), n - depth : n - low]] = True
            fresh[self.order[down[walkers].any(axis=0), low:depth]] = True
            if depth == n or not (up[walkers] | down[walkers]).any():
                fresh[:] = True  # queries of zeros have no lists: all rows tie
            fresh &= ~seen
            seen |= fresh
            least = score(np.flatnonzero(fresh), walkers)
            every = np.arange(dimensions)
            top = self.vectors[self.order[:, n - depth], every][None]
            bottom = self.vectors[self.order[:, depth - 1], every][None]
            bound = products(top, above[walkers])[:, 0] + products(bottom, below[walkers])[:, 0]
            walkers = walkers[~(bound < least)]
            low, depth = depth, 2 * depth
        return int(seen.sum())


class Best:
    """The ``k`` best (score, id) of many slots: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.scores = np.full((slots, k), -np.inf)
        self.ids = np.zeros((slots, k), np.int64)

    @property
    def kth(self) -> np.ndarray:
        """The kth best score of every slot, minus infinity for slots that are not full."""
        return self.scores[:, -1]

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(slots):
            return
        if scores.dtype == object and self.scores.dtype != object:
            self.scores = self.scores.astype(object)
        some = np.unique(slots)
        line, place = np.nonzero(self.scores[some] > -np.inf)
        slot = np.concatenate([np.searchsorted(some, slots), line])
        score = np.concatenate([scores, self.scores[some[line], place]])
        ident = np.concatenate([ids, self.ids[some[line], place]])
        if score.dtype == object:
            order = sorted(range(len(slot)), key=lambda i: (slot[i], -score[i], ident[i]))
        else:
            order = np.lexsort((ident, -score, slot))
        slot, score, ident = slot[order], score[order], ident[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = place < self.k
        at = some[slot[keep]], place[keep]
        self.scores[at], self.ids[at] = score[keep], ident[keep]

    def rows(self):
        """(slot, score, id) of all that was found."""
        slot, place = np.nonzero(self.scores > -np.inf)
        return slot, self.scores[slot, place], self.ids[slot, place]


def highest(scores: np.ndarray, k: int) -> np.ndarray:
    """The kth highest score of each line, minus infinity where a line has fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    if scores.dtype == object:
        return np.sort(scores, axis=1)[:, -k]
    return np.partition(scores, -k, axis=1)[:, -k]


def matrices(column, scale: int):
    """(rows, whole numbers) of an Arrow column of vectors: by length, large ones apart."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        vectors = whole_numbers(flat.astype(float).reshape(len(rows), length), scale)
        large = (np.abs(vectors) > LARGE).any(axis=1)
        for which in (~large, large):
            if which.any():
                yield rows[which], vectors[which]


def score_columns(scores) -> list[pa.Array]:
    """``score`` as a long, held at the ends of its range, and ``beyond``: what orders those."""
    whole = [int(s) for s in scores]
    held = [max(-_LONG - 1, min(_LONG, s)) for s in whole]
    return [
        pa.array(held, pa.int64()),
        pa.array([_sortable(s) if s >= _LONG or s < -_LONG else None for s in whole], pa.binary()),
    ]


def _sortable(number: int) -> bytes:
    size = (number.bit_length() + 7) // 8
    data = size.to_bytes(2, "big") + abs(number).to_bytes(size, "big")
    return data if number > 0 else bytes(255 - b for b in data)


def usable(rows: DataFrame) -> F.Column:
    """Whether ``vector`` holds numbers, all of them finite."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("id").isNotNull() & (F.size("vector") > 0) & finite


def deal(queries: DataFrame, rows: DataFrame, most_rows: int):
    """Both tables grouped by (block, part): every block of queries meets every part once.

    ``queries`` is a written table with an id; ``most_rows`` is no less than the rows of
    ``rows``. A group holds about ``QUERY_ROWS`` and ``PART_ROWS`` at most; rows are dealt by
    their place in the scan, so that no key gathers them.
    """
    spark = rows.sparkSession
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    spread = min(-(-most_rows // BLOCK_ROWS), 2 * spark.sparkContext.defaultParallelism)
    parts = max(1, -(-most_rows // PART_ROWS), spread)
    tasks = min(blocks * parts, 10_000)
    asked = queries.withColumn("block", F.expr(f"pmod(xxhash64(id), {blocks}L)")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    )
    place = rows.withColumn("_place", F.monotonically_increasing_id())
    met = place.withColumn("part", F.expr(f"pmod(xxhash64(_place), {parts}L)")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )
    return [
        df.repartition(tasks, "block", "part").groupBy("block", "part")
        for df in (asked, met.drop("_place"))
    ]
