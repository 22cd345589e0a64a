"""Language of a text by averaged hashed subword embeddings and a linear softmax.

Subwords are the byte 2-, 3- and 4-grams of the lower-cased text, with everything in ASCII
that is no letter as one blank. Their hashes pick rows of an embedding table; the average
row goes through a linear layer. Both are trained together by stochastic gradient descent
on the driver, from a bounded sample of rows; a temperature and a rejection level are then
set on a part of the sample that training has not seen.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, held_out, in_slices, pick, spread

#: Rows of a language that the model is fitted on, at most.
SAMPLE_ROWS = 1_500
#: Values of ``lang`` that are learnt, the most frequent ones, and rows of all together.
LANGUAGES = 500
TOTAL_ROWS = 24_000
BUCKETS = 4096
WIDTH = 16
UNKNOWN = "und"

_BLANK = np.arange(256, dtype=np.uint32)
_BLANK[[b for b in range(128) if not chr(b).isalpha()]] = 32
_FACTORS = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)
_ALNUM = re.compile(r"[^\W\d_]")
#: Bytes hashed at a time.
_PIECE = 1 << 20


def has_letter(text: str | None) -> bool:
    return any(m.group().isalpha() for m in _ALNUM.finditer(text or ""))


def subword_counts(text: str) -> np.ndarray:
    """How often each hash bucket occurs in a whole text."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(raw), _PIECE):
        piece = _BLANK[raw[start : start + _PIECE + 3]]
        gram = piece * _FACTORS[0]
        for k in (1, 2, 3):
            gram = (gram[:-1] ^ (gram[:-1] >> 15)) + piece[k:] * _FACTORS[k]
            counts += np.bincount((gram * _FACTORS[1]) >> 20, minlength=BUCKETS)
    return counts


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embedding rows times the linear layer
    bias: np.ndarray
    temperature: float
    reject_below: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 without a letter."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        counts = subword_counts(text)
        logits = (counts @ self.table / max(counts.sum(), 1) + self.bias) / self.temperature
        p = _softmax(logits[None])[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(x):
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Sparse:
    """Rows of subword counts as they came: places and counts, dense a few rows at a time."""

    def __init__(self, rows):
        self.rows = [(np.asarray(p, np.uint16), np.asarray(c, np.float32)) for p, c in rows]

    def __len__(self):
        return len(self.rows)

    def average(self, which) -> np.ndarray:
        """The share of every bucket in each of the chosen rows."""
        out = np.zeros((len(which), BUCKETS), np.float32)
        for line, row in enumerate(which):
            places, counts = self.rows[row]
            out[line, places] = counts / max(counts.sum(), 1)
        return out


def train(counts: Sparse, targets: np.ndarray, languages: list[str], epochs=20) -> Model:
    """Fit on rows of subword counts; ``targets`` index ``languages``."""
    random = np.random.default_rng(11)
    order = random.permutation(len(counts))
    aside, used = order[: len(order) // 5], order[len(order) // 5 :]
    table = random.normal(0, 0.1, (BUCKETS, WIDTH))
    layer = np.zeros((WIDTH, len(languages)))
    bias = np.zeros(len(languages))
    truth = np.eye(len(languages))[targets]
    for epoch in range(epochs):
        rate = 1.0 * (1 - epoch / epochs)
        used = random.permutation(used)
        for start in range(0, len(used), 32):
            rows = used[start : start + 32]
            x = counts.average(rows)
            hidden = x @ table
            wrong = (_softmax(hidden @ layer + bias) - truth[rows]) / len(rows)
            back = wrong @ layer.T
            layer -= rate * hidden.T @ wrong * 4
            bias -= rate * 0.1 * wrong.sum(axis=0)
            table -= rate * 40 * (x.T @ back)
    model = Model(languages, table @ layer, bias, 1.0, 0.0)
    if len(aside):
        pieces = [aside[start : start + 256] for start in range(0, len(aside), 256)]
        logits = np.concatenate([counts.average(piece) @ model.table + model.bias for piece in pieces])
        _calibrate(model, logits, targets[aside])
    return model


def _calibrate(model, logits, targets):
    """Temperature by likelihood; rejection so that 1 in 500 right answers would go."""
    every = np.arange(len(targets))
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    losses = [-np.log(_softmax(logits / t)[every, targets] + 1e-9).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])
    p = _softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == targets]
    chance = 1 / len(model.languages)
    if len(right):
        # Half of the lowest regular confidence: clean documents stay.
        model.reject_below = float(max(min(np.quantile(right, 0.002) * 0.5, 0.5), chance))


def fit(df: DataFrame, sample_rows=SAMPLE_ROWS) -> Model:
    """Model from (doc_id, text, lang): at most ``sample_rows`` ids of each language.

    The most frequent ``LANGUAGES`` values of ``lang`` are learnt, and ``TOTAL_ROWS`` rows in
    all, so that the driver's memory is bounded. Of rows that repeat an id and a language the
    smallest text is taken.
    """
    known = df.where("lang is not null and text is not null and doc_id is not null")
    known = known.where(~held_out("doc_id"))
    with Scratch(df.sparkSession, "langid") as scratch:
        return _fit(known, scratch.keep(_chosen(known.select("doc_id", "lang"), sample_rows)))


def _fit(known: DataFrame, chosen: DataFrame) -> Model:
    texts = known.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    texts = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    sample = texts.select("doc_id", "text", "lang").mapInArrow(
        in_slices(_sparse), "doc_id bigint, lang string, buckets binary, counts binary"
    )
    found = sample.toPandas().sort_values(["doc_id", "lang", "buckets", "counts"])
    languages = sorted(found["lang"].unique())
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    counts = Sparse(
        (np.frombuffer(buckets, "<u2"), np.frombuffer(often, "<u4"))
        for buckets, often in zip(found["buckets"], found["counts"])
    )
    place = {name: n for n, name in enumerate(languages)}
    return train(counts, found["lang"].map(place).to_numpy(), languages)


def _chosen(known: DataFrame, sample_rows: int) -> DataFrame:
    """The first ``sample_rows`` ids of each language in a fixed random order of ids.

    A language may hold most rows, so they are not ranked: counts by language set a level
    that about twice the wanted rows lie below, and only those meet in one task.
    """
    rows = known.distinct().withColumn("_place", spread("doc_id", 9))
    levels = rows.groupBy("lang").agg(
        F.expr("count(*) as _rows"), F.min("_place").alias("_least")
    )
    levels = levels.orderBy(F.desc("_rows"), "lang").limit(LANGUAGES)
    sample_rows = min(sample_rows, max(1, TOTAL_ROWS // max(1, levels.count())))
    # Places are spread evenly over all longs; the least one keeps every language in.
    share = f"{2.0 * sample_rows}D / _rows - 0.5D"
    levels = levels.selectExpr(
        "lang",
        f"case when _rows <= {2 * sample_rows} then {2**63 - 1}L "
        f"else greatest(_least, cast(({share}) * {2**64}D as bigint)) end as _level",
    )
    # One row for each class of the model.
    few = rows.join(F.broadcast(levels), "lang").where("_place <= _level")
    by_language = Window.partitionBy("lang").orderBy("_place", "doc_id")
    return (
        few.select("doc_id", "lang", "_place")
        .withColumn("_rank", F.row_number().over(by_language))
        .where(F.col("_rank") <= sample_rows)
        .select("doc_id", "lang")
    )


def _sparse(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        ids, languages, buckets, counts = [], [], [], []
        for doc, text, lang in zip(*[batch.column(k).to_pylist() for k in range(3)]):
            if has_letter(text):
                found = subword_counts(text)
                some = np.flatnonzero(found)
                ids.append(doc)
                languages.append(lang)
                buckets.append(some.astype("<u2").tobytes())
                counts.append(found[some].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(languages, pa.string()),
                pa.array(buckets, pa.binary()),
                pa.array(counts, pa.binary()),
            ],
            names=["doc_id", "lang", "buckets", "counts"],
        )


def languages(
    df: DataFrame, doc_id="doc_id", text="text", lang="lang", sample_rows=SAMPLE_ROWS
) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected.

    The model learns from text and ``lang`` of the rows that are not held out (crc32 of the
    id mod 4 = 2) and have an id; predictions use the text alone. A null text or one without a letter is
    ``und`` with score 0, as is every text if no row has a language. ``rejected`` marks
    those and answers below the calibrated level. Repeated rows give repeated answers.
    """
    docs = pick(df, doc_id=doc_id, text=text, lang=lang)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    model = fit(docs, sample_rows)

    def predict(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            names, scores = [f[0] for f in found], [f[1] for f in found]
            low = [n == UNKNOWN or s < model.reject_below for n, s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(low, pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    answers = docs.select("doc_id", "text").mapInArrow(
        in_slices(predict), "doc_id bigint, lang_pred string, score double, rejected boolean"
    )
    return answers.select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected"
    )


def known_languages(df: DataFrame, text="text", sample_rows=SAMPLE_ROWS) -> DataFrame:
    """The rows of ``df`` whose text the model does not reject, with all their columns.

    ``df`` has doc_id, the text column and lang. Rejected are null texts, texts without a
    letter and answers below the calibrated level. If no row has a language to learn from,
    only texts without a letter go.
    """
    model = fit(pick(df, doc_id="doc_id", text=text, lang="lang"), sample_rows)
    column = df.columns.index(text)

    def keep(value):
        if not model.languages:
            return has_letter(value)
        name, score = model.predict(value)
        return name != UNKNOWN and score >= model.reject_below

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield batch.filter(pa.array(map(keep, batch.column(column).to_pylist()), pa.bool_()))

    return df.mapInArrow(in_slices(run), df.schema)
