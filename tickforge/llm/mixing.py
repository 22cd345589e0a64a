"""Mix sources to target weights: subset-sum budget fitting over exact document lengths.

Every source gets a target of words. Whole passes over it come first; what is left of the
target is a budget, and the documents whose lengths add up to it are chosen by length:
documents are counted by exact length, an even share of every length fills all but a few
thousand words, and a bounded-knapsack dynamic programme over what remains fits the rest.
The choice is a count for each (source, length); the documents that fill it are those that
come first in a seeded order.

What a task holds is one source's counts by length: no more rows than distinct lengths, so
no more than the square root of twice the source's words.
"""

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, pick, spread
from tickforge.operators.slices import number_rows

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Words that the dynamic programme fits, after even shares of all lengths and single documents.
FIT_WORDS = 8192
#: A budget up to this is fitted whole if even shares of a source's few, long documents miss it.
WHOLE_FIT_WORDS = 1_000_000


def word_count(text: str) -> F.Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def fill_budget(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length (ascending, above 0) add up to ``budget`` best.

    ``budget`` is no larger than all documents together. Integers throughout: the same
    answer wherever it is computed.
    """
    words = sum(n * length for n, length in zip(counts, lengths))
    if not words:
        return [0] * len(lengths)
    even = [n * max(0, budget - FIT_WORDS) // words for n in counts]
    left = budget - sum(t * length for t, length in zip(even, lengths))
    before = None
    while left > FIT_WORDS and left != before:  # one more of each length that still fits
        before = left
        for i in reversed(range(len(lengths))):
            if even[i] < counts[i] and lengths[i] <= left - FIT_WORDS:
                even[i] += 1
                left -= lengths[i]
    taken, miss = _fitted(lengths, counts, even, left)
    if miss and any(even) and budget <= WHOLE_FIT_WORDS:
        other, less = _fitted(lengths, counts, [0] * len(lengths), budget)
        taken = other if less < miss else taken
    return taken


def _fitted(lengths, counts, taken, left):
    """Counts that the programme adds to, and by how much they miss."""
    taken, spare = list(taken), [n - t for n, t in zip(counts, taken)]
    for i, more in _knapsack(lengths, spare, left):
        taken[i] += more
        left -= more * lengths[i]
    return taken, abs(left)


def _knapsack(lengths, spare, budget):
    """(place, copies) pairs whose sum is nearest to ``budget``; the smaller of equally near."""
    largest = max((length for length, n in zip(lengths, spare) if n), default=0)
    if budget <= 0 or not largest:
        return
    # A sum that is more than a document above the budget, or more than twice it, is not nearest.
    size = budget + min(budget, largest) + 1
    reached, by, items = np.zeros(size, bool), np.full(size, -1, np.int64), []
    reached[0] = True
    for i, (length, n) in enumerate(zip(lengths, spare)):
        copies = 1
        n = min(n, (size - 1) // length)
        while n > 0:  # copies in powers of two make any number up to n
            now = min(copies, n)
            step = now * length
            n, copies = n - now, 2 * copies
            fresh = reached[:-step] & ~reached[step:]
            by[step:][fresh] = len(items)
            reached[step:] |= fresh
            items.append((i, now))
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    total = int(sums[np.argmin(np.abs(sums - budget))])
    while total:
        place, copies = items[by[total]]
        yield place, copies
        total -= copies * lengths[place]


def _fit(counts: pd.DataFrame) -> pd.DataFrame:
    """Passes and extra documents for every length of one source."""
    counts = counts.sort_values("size").reset_index(drop=True)
    words = int(counts["source_size"].iloc[0])
    target = round(float(counts["target"].iloc[0]))
    passes, budget = divmod(target, words) if words else (0, 0)
    counts["passes"], counts["extra"] = passes, 0
    some = counts["size"] > 0
    lengths, numbers = (counts.loc[some, c].astype(int).tolist() for c in ("size", "n"))
    counts.loc[some, "extra"] = fill_budget(lengths, numbers, budget)
    return counts[["place", "size", "passes", "extra"]]


def targets(sources: DataFrame, scratch, weights=WEIGHTS, percent=150, most=2) -> DataFrame:
    """Add ``place`` (from 0, by code point, null last) and ``target`` to (source, source_size).

    ``percent`` of all words are shared by weight. A target stops at ``most`` times its
    source; what that leaves over is shared again among the others, until none is above.
    A round is one aggregate over the table of sources.
    """
    # Fourteen bytes of the name as two numbers lead the order, so that many sources can be cut.
    head = F.rpad(F.hex(F.encode(F.substring("source", 1, 14), "UTF-8")), 28, "0")
    numbers = [F.conv(F.substring(head, at, 14), 16, 10).cast("long") for at in (1, 15)]
    last = F.lit(2**60).cast("long")
    ordered = sources.select(
        "source", "source_size", F.lit(0).alias("all"),
        F.coalesce(numbers[0], last).alias("head"), F.coalesce(numbers[1], last).alias("next"),
    )
    numbered = number_rows(scratch.keep(ordered), ["all"], ["head", "next", "source"], "place")
    turn = F.expr(f"cast((place - 1) % {len(weights)} as int) + 1")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn)
    placed = scratch.keep(
        numbered.select("source", "source_size", F.col("place") - 1, weight.cast("long"))
        .toDF("source", "source_size", "place", "weight")
    )
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    full, free, capped = F.lit(False), None, -1
    while True:
        # The level is what one unit of weight gets: parts / (100 * free).
        fixed, free, now = placed.agg(
            F.coalesce(F.sum(F.when(full, most * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count(F.when(full, 1)),
        ).first()
        parts = percent * total - 100 * fixed
        if now == capped or not free:
            break
        capped = now
        big = "cast({} as decimal(19, 0))".format
        full = full | F.expr(
            f"{big(f'{100 * most} * source_size')} * {big(free)} < {big('weight')} * {big(parts)}"
        )
    share = F.col("weight").cast("double") * F.lit(float(parts)) / F.lit(float(100 * max(free, 1)))
    target = F.when(full, (most * F.col("source_size")).cast("double")).otherwise(share)
    return placed.withColumn("target", target)


def mix(
    df: DataFrame, seed=11, weights=WEIGHTS, percent=150, most=2,
    id_column="doc_id", text="text", source="source",
) -> DataFrame:
    """doc_id, size, source_size, target, taken, and source: one row for each row of ``df``.

    ``size`` counts the words of the text, ``source_size`` those of its source, ``target``
    is what the source should give, and ``taken`` is 0 or a multiple of ``size`` up to
    ``most``. The words taken of a source differ from its target by less than the smallest
    documents can make up for, often by less than one. Null sources are one source, which
    comes last. A null or empty text has no words and nothing is taken of it. Rows without
    an id count as any other; of rows that repeat an id each counts. The same ids, sizes and
    sources give the same result in any order.
    """
    with Scratch(df.sparkSession, "mixing") as scratch:
        rows = pick(df, doc_id=id_column, text=text, source=source)
        sizes = scratch.keep(
            rows.select(
                "doc_id", "source", word_count("text").alias("size"),
                spread("doc_id", seed).alias("drawn"),
                # Tells repeated ids apart; which of those is taken makes no difference.
                F.monotonically_increasing_id().alias("row"),
            )
        )
        counts = scratch.keep(sizes.groupBy("source", "size").agg(F.count("*").alias("n")))
        by_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
        wanted = scratch.keep(targets(by_source, scratch, weights, percent, most))
        same = counts["source"].eqNullSafe(wanted["source"])
        plan = scratch.keep(
            counts.join(wanted, same)
            .select("place", "source_size", "target", counts["size"], "n")
            .groupBy("place")
            .applyInPandas(_fit, "place long, size long, passes long, extra long")
        )
        plan = plan.join(wanted.select("place", "source", "source_size", "target"), "place")
        plan = scratch.keep(plan.drop("place").withColumnsRenamed({"source": "of", "size": "length"}))
        ranked = number_rows(sizes, ["source", "size"], ["drawn", "row"], "rank")
        on = [F.col("source").eqNullSafe(F.col("of")), F.col("size") == F.col("length")]
        times = F.col("passes") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)
        return scratch.keep(
            ranked.join(plan, reduce(lambda a, b: a & b, on)).select(
                "doc_id", "size", "source_size", "target",
                (times * F.col("size")).cast("long").alias("taken"), "source",
            ),
            last=True,
        )
