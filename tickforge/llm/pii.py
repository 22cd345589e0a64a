"""Personal data in texts: fixed patterns, and more spans chosen by boosted trees.

The base patterns (email, ip, card, phone) are exact: leftmost, non-overlapping per kind,
checked by value. High-recall generators propose further, overlapping spans: masked emails
and addresses, numbers written in other groupings. Gradient-boosted trees score every span
by its format and the words before it. They learn from all documents of the corpus itself,
base spans against proposals and base matches that failed their check; on a part set aside, a
threshold for each kind is set where nearly all base spans pass. Proposals at or above it that
overlap no better span are added.

Spans of equal binned features and label are one counted cell. A few cells are summed on the
driver, any number of them by Spark, level by level of each tree; both give the same trees.

All patterns are anchored at a character that they need ('@', '+', a run of digits), so a
text of any length takes linear time.
"""

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm import gbt
from tickforge.llm.common import Scratch, in_slices, pick

KINDS = ("email", "ip", "card", "phone")
TREES = 40
#: Cells that the driver sums by itself, at most; more are summed by Spark.
DRIVER_CELLS = 50_000
#: Parts of all spans, of 25: a fifth sets thresholds, a fifth of the rest calibrates.
THRESHOLD, CALIBRATE, LEARN = 0, 1, 2
_PARTS = [THRESHOLD] * 5 + [CALIBRATE] * 4 + [LEARN] * 16
#: Fixed point of margins and of scores, by which these are counted.
_MARGIN, _SCORE = 1 << 10, 1 << 20
#: Share of the base spans set aside that a kind's threshold lets pass, and its least value.
PASS_SHARE, LEAST_THRESHOLD = 0.98, 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Generators beyond the base patterns.
_MASKED_AT = re.compile(r"\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?")
_MASKED_DOMAIN = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:\x20?(?:[\[({]\x20?(?:dot|DOT)\x20?[\])}]|\.)\x20?[A-Za-z0-9-]{1,63}){1,8}"
)
_LOOSE_PHONE = re.compile(r"(?<![\w+(.-])(?:\([0-9]{2,4}\)|[0-9]{3})[\x20./-][0-9]{3}[\x20./-][0-9]{4}(?![\w-])")
_LOOSE_CARD = re.compile(r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")
_LOOSE_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\x20?[\[(]\x20?(?:\.|dot)\x20?[\])]\x20?[0-9]{1,3}){3}(?![0-9])")

# Words before a span that hint at its kind.
_CUES = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "client", "addr"),
    "card": ("card", "visa", "account", "payment", "iban"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "contact"),
}
_CONTEXT = 24


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def valid(kind: str, span: str) -> bool:
    """The value check of a base pattern."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in span.split("."))
    if kind == "card":
        digits = _digits(span)
        return 16 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 8 <= len(_digits(span)) <= 15
    return True


def _emails(text):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def matches(text: str):
    """(kind, start, end) of every base match, checked or not, by kind and start."""
    for start, end in _emails(text):
        yield "email", start, end
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            for m in pattern.finditer(text):
                yield kind, *m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(k, s, e) for k, s, e in matches(text) if valid(k, text[s:e])]


def proposals(text: str):
    """High-recall candidates beside the base matches; they may overlap anything."""
    for m in _MASKED_AT.finditer(text):
        start = m.start()
        while start > 0 and m.start() - start < 64 and text[start - 1] in _LOCAL:
            start -= 1
        domain = _MASKED_DOMAIN.match(text, m.end())
        if start < m.start() and domain:
            yield "email", start, domain.end()
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _LOOSE_IP), ("card", _LOOSE_CARD), ("phone", _LOOSE_PHONE)):
            for m in pattern.finditer(text):
                yield kind, *m.span()


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of one span, without the marks that define the base patterns."""
    span, before = text[start:end], text[max(0, start - _CONTEXT) : start].lower()
    digits = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    parts = [int(g) if len(g) < 9 else 10**9 for g in groups]
    return [
        *[float(kind == k) for k in KINDS],
        len(span), len(digits), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), len(set(digits)), float(_luhn(digits)),
        float(len(groups) == 4 and max(parts) <= 255), sum(c.isalpha() for c in span),
        sum(c in " -" for c in span), span.count("."), sum(c in "()[]{}" for c in span),
        *[float(any(cue in before for cue in _CUES[k])) for k in KINDS],
        float(before[-1:].isalnum()), float(text[end : end + 1].isalnum()),
        float(before[-1:] in ".-_/"), float(before.rstrip()[-1:] in ":="),
    ]


WIDTH = len(features("", "email", 0, 0))


@dataclass
class Detector:
    trees: gbt.Trees
    thresholds: dict[str, float]

    def spans(self, text: str | None) -> tuple[list, list]:
        """(base spans, added spans) of a whole text; null counts as empty."""
        text = text or ""
        base = base_spans(text)
        extra = list(dict.fromkeys(proposals(text)))
        if not extra:
            return base, []
        scores = self.trees.probability(np.array([features(text, *x) for x in extra]))
        taken, added = _Taken((s, e) for _, s, e in base), []
        for score, (kind, start, end) in sorted(zip(scores, extra), key=lambda x: (-x[0], x[1])):
            if score >= self.thresholds[kind] and taken.free(start, end):
                added.append((kind, start, end))
                taken.add(start, end)
        return base, added


class _Taken:
    """Places that spans hold, as sorted stretches that do not touch."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at == len(self.starts) or end <= self.starts[at]

    def add(self, start: int, end: int) -> None:
        """A free stretch."""
        at = bisect_right(self.ends, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def joined(spans) -> str:
    """kind:start:end by kind as listed, then start."""
    order = sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


def redact(text: str | None, spans) -> str | None:
    """The text with every span replaced by its kind in brackets; overlaps are merged."""
    if not spans:
        return text
    out, end = [], 0
    for kind, start, stop in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join(out) + text[end:]


def _cells(batches: Iterator[pa.RecordBatch]):
    """(part, label, bins, n): the spans of all texts, counted."""
    for batch in batches:
        found = Counter()
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            seen = [(x, int(valid(x[0], text[x[1] : x[2]]))) for x in matches(text)]
            base = {kind: _Taken(x[1:] for x, good in seen if good and x[0] == kind) for kind in KINDS}
            # A looser match of what a base span holds is personal data too.
            for kind, start, end in proposals(text):
                seen.append(((kind, start, end), int(not base[kind].free(start, end))))
            for x, good in seen:
                # Runs of one or two digits are numbers, not candidates.
                if good or x[2] - x[1] > 6:
                    part = _PARTS[zlib.crc32(f"{doc}:{x}".encode()) % len(_PARTS)]
                    found[part, good, gbt.bins(features(text, *x)).tobytes()] += 1
        rows = [(*cell, n) for cell, n in found.items()]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "label", "bins", "n"]
        )


def _columns(cells):
    """part, label, bins and n of cells in an Arrow batch or a data frame, as arrays."""
    part, label, packed, n = (np.asarray(cells[c]) for c in ("part", "label", "bins", "n"))
    return part, label, np.frombuffer(b"".join(packed), np.uint8).reshape(-1, WIDTH), n


def _tally(keys, n):
    """(keys, sums of n, zeros): whole numbers added up by key."""
    keys, place = np.unique(keys, return_inverse=True)
    sums = np.zeros((2, len(keys)), np.int64)
    np.add.at(sums[0], place, n)
    return keys, *sums


def _summed(cells: DataFrame, driver_cells: int):
    """What adds up (key, a, b), whole numbers that a function gives for cells, by key."""
    if cells.count() <= driver_cells:
        held = _columns(cells.toPandas())
        return lambda what: what(*held)

    def by_spark(what):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                sums = what(*_columns(batch))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in sums], names=["key", "a", "b"]
                )

        rows = cells.mapInArrow(run, "key bigint, a bigint, b bigint").groupBy("key")
        # As many keys as a level has nodes, features and bins, or margins and scores have steps.
        rows = sorted(rows.agg(F.sum("a"), F.sum("b")).collect())
        return tuple(np.array([row[k] for row in rows], np.int64) for k in range(3))

    return by_spark


def fit(docs: DataFrame, driver_cells=DRIVER_CELLS) -> Detector:
    """Trees and thresholds from the spans of all documents that have an id."""
    with Scratch(docs.sparkSession, "pii") as scratch:
        found = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(
            in_slices(_cells), "part int, label int, bins binary, n bigint"
        )
        cells = scratch.keep(found.groupBy("part", "label", "bins").agg(F.sum("n").alias("n")))
        summed = _summed(cells, driver_cells)

        def classes(part, label, binned, n):
            return _tally(2 * part.astype(np.int64) + label, n)

        keys, counts, _ = summed(classes)
        totals = dict(zip(keys.tolist(), counts.tolist()))

        def sums(model, t, level):
            def what(part, label, binned, n):
                some = part == LEARN
                return gbt.gradient_sums(model, t, level, binned[some], label[some], n[some])

            return summed(what)

        learn = [totals.get(2 * LEARN + label, 0) for label in (0, 1)]
        trees = gbt.fit_counted(sums, learn, WIDTH, TREES)

        def margins(part, label, binned, n):
            some = part == CALIBRATE
            fixed = np.rint(trees.margin(gbt.of_bins(binned[some])) * _MARGIN).astype(np.int64)
            return _tally(2 * fixed + label[some], n[some])

        keys, counts, _ = summed(margins)
        trees.calibrate((keys >> 1) / _MARGIN, keys & 1, counts)

        def scores(part, label, binned, n):
            some = (part == THRESHOLD) & (label == 1)
            fixed = np.floor(trees.probability(gbt.of_bins(binned[some])) * _SCORE)
            # What lies below the least threshold need not be told apart.
            fixed = np.where(fixed < LEAST_THRESHOLD * _SCORE, 0, fixed).astype(np.int64)
            kind = binned[some][:, : len(KINDS)].argmax(axis=1)
            return _tally(kind * (2 * _SCORE) + fixed, n[some])

        keys, counts, _ = summed(scores)
    thresholds = {}
    for number, kind in enumerate(KINDS):
        own = keys // (2 * _SCORE) == number
        passing = np.cumsum(counts[own][::-1]) >= PASS_SHARE * counts[own].sum()
        level = (keys[own][::-1] % (2 * _SCORE))[passing.argmax()] / _SCORE if own.any() else 1.1
        thresholds[kind] = max(float(level), LEAST_THRESHOLD)
    return Detector(trees, thresholds)


def personal_data(
    df: DataFrame, doc_id="doc_id", text="text", driver_cells=DRIVER_CELLS
) -> DataFrame:
    """Per row: doc_id, base and added spans, and the text with all spans redacted.

    ``base`` and ``added`` are strings ``kind:start:end,...`` by kind (email, ip, card,
    phone), then start, in code points, end exclusive. ``redacted`` has each span replaced
    by its kind in brackets; a null text counts as empty for the spans and stays null here.
    Rows with a null id are searched too, but the trees do not learn from them; repeated
    rows count as often as they stand. Kinds without any base span in the part of all spans
    that sets thresholds get no added spans. Other columns are left out.
    """
    docs = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    detector = fit(docs, driver_cells)

    def find(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            base, added, clean, counts = [], [], [], []
            for text in batch.column(1).to_pylist():
                fixed, extra = detector.spans(text)
                base.append(joined(fixed))
                added.append(joined(extra))
                clean.append(redact(text, fixed + extra))
                counts.append([sum(x[0] == k for x in fixed) for k in KINDS])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.string()), pa.array(added, pa.string())]
                + [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
                + [pa.array(clean, pa.string())],
                names=["doc_id", "base", "added", *[f"n_{k}" for k in KINDS], "redacted"],
            )

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.mapInArrow(
        in_slices(find), f"doc_id bigint, base string, added string, {counts}, redacted string"
    )


def without_personal_data(
    df: DataFrame, doc_id="doc_id", text="text", driver_cells=DRIVER_CELLS
) -> DataFrame:
    """The rows of ``df`` with all spans in the text redacted; other columns stay."""
    docs = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    detector = fit(docs, driver_cells)
    column = df.columns.index(text)

    def clean(value):
        fixed, extra = detector.spans(value)
        return redact(value, fixed + extra)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = pa.array(map(clean, batch.column(column).to_pylist()), pa.string())
            yield batch.set_column(column, batch.schema.names[column], texts)

    return df.mapInArrow(in_slices(run), df.schema)


def all_spans(base="base", added="added") -> F.Column:
    """Both lists as one, by kind as listed, then start."""
    pairs = F.filter(F.split(F.concat_ws(",", base, added), ","), lambda x: x != "")
    keyed = F.transform(
        pairs,
        lambda x: F.struct(
            F.array_position(F.lit(list(KINDS)), F.split_part(x, F.lit(":"), F.lit(1))).alias("k"),
            F.split_part(x, F.lit(":"), F.lit(2)).cast("long").alias("s"),
            F.split_part(x, F.lit(":"), F.lit(3)).cast("long").alias("e"),
            x.alias("x"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["x"]), ",")
