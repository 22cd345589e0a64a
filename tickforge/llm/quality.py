"""Document quality by boosted trees over document statistics.

Features are computed where a document is read. The trees are fitted on the driver from a
bounded sample of labelled rows and sent back as arrays; scoring is one pass without shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm import gbt
from tickforge.llm.common import held_out, in_slices, pick, spread
from tickforge.llm.shingles import word_hashes

#: Labelled rows the trees are fitted on, at most: those first in a fixed random order.
SAMPLE_ROWS = 12_000
#: Bytes and words of the stretches whose extremes are features too.
STRETCH_BYTES = 512
STRETCH_WORDS = 64

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\r\n\v\f",
    "line": b"\n",
    "stop": b".,;:?",
    "loud": b"!",
    "bar": b"|",
    "mark": b"#$%&*@^~=+_<>",
    "frame": b"()[]{}\"'`/\\-",
    "high": bytes(range(128, 256)),
}
_TABLE = np.stack([np.isin(np.arange(256), list(c)) for c in _CLASSES.values()])


def features(text: str | None) -> np.ndarray:
    """Statistics of a whole text. Null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(len(data), 1)
    shares = _TABLE @ counts / size
    ends = np.arange(0, len(data), STRETCH_BYTES)
    if len(ends) > 1:
        rows = len(data) // STRETCH_BYTES
        block = np.frombuffer(data, np.uint8, rows * STRETCH_BYTES).reshape(rows, -1)
        by_block = np.stack([row[block].mean(axis=1) for row in _TABLE[[0, 2, 6, 7, 8, 9]]])
        extremes = by_block.max(axis=1)
    else:
        extremes = shares[[0, 2, 6, 7, 8, 9]]
    p = counts[counts > 0] / size
    words = word_hashes(text)
    n = len(words)
    if n > 1:
        distinct, often = np.unique(words, return_counts=True)
        same = words[1:] == words[:-1]
        whole = n // STRETCH_WORDS * STRETCH_WORDS
        runs = np.sort(words[:whole].reshape(-1, STRETCH_WORDS), axis=1) if whole else words[None]
        fresh = 1 + (np.diff(np.sort(runs, axis=1), axis=1) != 0).sum(axis=1)
        repeat = [
            len(distinct) / n, often.max() / n, same.mean(), fresh.min() / runs.shape[1],
            fresh.mean() / runs.shape[1],
        ]
    else:
        repeat = [1.0, 1.0 if n else 0.0, 0.0, 1.0, 1.0]
    lines = data.split(b"\n")
    line = [
        len(lines) / (n + 1), len(set(lines)) / len(lines),
        sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines),
    ]
    return np.array(
        [np.log1p(len(data)), np.log1p(n), len(data) / (n + 1), -(p * np.log(p)).sum()]
        + [*shares, *extremes, *repeat, *line]
    )


WIDTH = len(features(""))


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        found = [features(t).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "features"]
        )


def fit(df: DataFrame, labels: DataFrame, sample_rows=SAMPLE_ROWS) -> gbt.Trees:
    """Trees from at most ``sample_rows`` labelled rows (doc_id, label 0 or 1)."""
    chosen = (
        labels.where("label in (0, 1) and doc_id is not null")
        .select("doc_id", "label")
        .distinct()
        .orderBy(spread("doc_id", 3), "doc_id", "label")
        .limit(sample_rows)
    )
    texts = df.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    # One text for each id: no more rows than were chosen.
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    known = texts.mapInArrow(in_slices(_rows), "doc_id bigint, features binary").toPandas()
    both = known.merge(chosen.toPandas(), on="doc_id").sort_values(["doc_id", "label", "features"])
    rows = np.frombuffer(b"".join(both["features"]), float).reshape(-1, WIDTH)
    return gbt.fit(rows, both["label"].to_numpy())


def quality_scores(
    df: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality",
    threshold=0.7, sample_rows=SAMPLE_ROWS,
) -> DataFrame:
    """Per row: doc_id, held_out, score in 0 to 1, predicted (1 from ``threshold`` on).

    ``labels`` has doc_id and a 0/1 label. Ids with crc32 mod 4 = 2 are held out: their
    labels are never read. Scores depend on the text alone. Null texts count as empty;
    null ids are scored and count as not held out; labels that are null or neither 0 nor 1
    are passed over. Of rows that repeat an id all are scored, and the smallest text is
    learnt from. Without labels of both kinds every row gets the same score.
    """
    docs = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    known = pick(labels, doc_id="doc_id", label=label).where(~held_out("doc_id"))
    trees = fit(docs, known.withColumn("doc_id", F.col("doc_id").cast("long")), sample_rows)

    def score(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                rows = np.stack([features(t) for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(trees.probability(rows))], names=["doc_id", "score"]
                )

    scored = docs.mapInArrow(in_slices(score), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
