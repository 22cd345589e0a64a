"""Benchmark passages in documents, also with other numbers, names and units.

Words are canonicalised: numbers, capitalised names and units of measure become typed
placeholders, everything else its lower-cased letters. An item's windows of eight canonical
words, half of them at least literal, are hash-joined with those of the documents; where an
item holds names, also with the names as plain words, so that a lower-cased copy is found. An
item without such a window counts with all its windows, and one of fewer words as a single
window; where these have fewer than four literal words, only equal values match. Windows on
one alignment (document position minus item position) are then added up, and the values in
their slots must map one to one.

Documents are read once. Only windows that pass a filter of fixed size, built from the
benchmark's window hashes, leave the task that found them; the join afterwards is exact.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, in_slices, pick, remembers
from tickforge.llm.shingles import mix

WORDS = 8
LITERALS = 4
#: Windows an alignment needs, or all that the item has if those are fewer.
LEAST_WINDOWS = 3
#: Places in the filter, two for a hash: four megabytes, however large the benchmark is.
FILTER = 1 << 22
_PLACES = np.uint64(FILTER - 1)
#: Distinct words a worker remembers before it starts anew.
CACHE_WORDS = 200_000

# Words read as numbers, and units of measure.
_NUMBERS = "one two three four five six seven eight nine ten eleven twelve hundred thousand million"
_UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce "
    "ounces ton tons l ml liter liters litre litres gallon gallons s sec ms min h hr hrs second "
    "seconds minute minutes hour hours day days week weeks month months year years usd eur gbp "
    "dollar dollars cent cents euro euros percent degree degrees celsius fahrenheit kb mb gb tb "
    "watt watts kw volt volts joule joules hz khz mhz ghz mph kmh"
)
_NUMBER_WORDS, _UNIT_WORDS = frozenset(_NUMBERS.split()), frozenset(_UNITS.split())
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"\d[\d.,:/]*")
_MEASURE = re.compile(r"\d[\d.,:/]*[^\W\d_]{1,4}")
NUMBER, NAME, UNIT, MEASURE = 1, 2, 3, 4
_SLOTS = 16  # codes below are placeholders
#: Odd random factors of the words of a window.
_FACTORS = np.random.default_rng(408).integers(0, 1 << 63, WORDS, np.uint64) * 2 + 1


class _Codes(dict):
    """Canonical code of a word: 0 for mere punctuation, a placeholder, or a hash."""

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        code = self[word] = canonical(word)
        return code


def _hash(word: str) -> int:
    found = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return max(int.from_bytes(found, "little"), _SLOTS)


def canonical(word: str) -> int:
    plain = word.isalpha()
    core = word if plain else _EDGE.sub("", word)
    if not core:
        return 0
    low = core.lower()
    if low in _NUMBER_WORDS or not plain and _NUMBER.fullmatch(core):
        return NUMBER
    if low in _UNIT_WORDS:
        return UNIT
    if not plain and _MEASURE.fullmatch(core):
        return MEASURE
    if core[0].isupper():
        return NAME
    return _hash(low)


_CODES = _Codes()
remembers(__name__, _CODES.clear)


def _coded(text: str | None):
    """(codes, words) without mere punctuation."""
    words = (text or "").split()
    codes = np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))
    some = np.flatnonzero(codes)
    if len(some) < len(words):
        codes, words = codes[some], [words[k] for k in some]
    return codes, words


def _keys(codes: np.ndarray, size: int) -> np.ndarray:
    """One hash for every ``size`` words in a row."""
    sums = np.full(max(0, len(codes) - size + 1), np.uint64(size % WORDS), np.uint64)
    for k, factor in enumerate(_FACTORS[:size]):
        sums += codes[k : k + len(sums)] * factor
    return mix(sums)


def _slots(codes, words, at, size):
    """Hashes of the values in the slots of one window, in order."""
    slots = (words[k] for k in range(at, at + size) if codes[k] < _SLOTS)
    return [_hash(_EDGE.sub("", w).lower()) - (1 << 63) for w in slots]


def item_windows(text: str | None):
    """(place, size, key, slots, windows, strict) of the windows that an item is known by."""
    codes, words = _coded(text)
    size = min(WORDS, len(codes))
    if not size:
        return
    literal = np.convolve(codes >= _SLOTS, np.ones(size, int), "valid")
    rich = np.flatnonzero(literal >= LITERALS)
    strict = not len(rich)
    at = np.arange(len(literal)) if strict else rich
    names = codes == NAME
    plain = codes.copy()
    plain[names] = [_hash(_EDGE.sub("", words[k]).lower()) for k in np.flatnonzero(names)]
    for number, form in enumerate((codes, plain)):
        keys = _keys(form, size)
        for k in at:
            if not number or names[k : k + size].any():
                yield int(k), size, int(keys[k]) - (1 << 63), _slots(form, words, k, size), len(at), strict


def _templates(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        rows = [
            (item, *window)
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for window in item_windows(text)
        ]
        names = ["id", "place", "size", "key", "slots", "windows", "strict"]
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.int64(), pa.bool_()]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _matches(wanted):
    """Windows of each text whose hash is marked in the filter."""

    def run(batches: Iterator[pa.RecordBatch]):
        marked, sizes = wanted.value
        for batch in batches:
            ids, places, keys, slots = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, words = _coded(text)
                for size in sizes:
                    found = _keys(codes, size)
                    low, high = found & _PLACES, (found >> np.uint64(24)) & _PLACES
                    for k in np.flatnonzero(marked[low] & marked[high]):
                        ids.append(doc)
                        places.append(int(k))
                        keys.append(int(found[k]) - (1 << 63))
                        slots.append(_slots(codes, words, k, size))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(places, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(slots, pa.list_(pa.int64())),
                ],
                names=["id", "place", "key", "slots"],
            )

    return run


_ITEMS = (
    "id bigint, place bigint, size bigint, key bigint, slots array<bigint>, windows bigint, strict boolean"
)
_FOUND = "id bigint, place bigint, key bigint, slots array<bigint>"


def contaminated(
    df: DataFrame, benchmark: DataFrame, doc_id="doc_id", text="text",
    item_id="item_id", item_text="text",
) -> DataFrame:
    """One row for each document and benchmark item found in it.

    Columns: doc_id, item_id, windows (of the best alignment), of_windows (the item's own),
    exact (all slot values equal; else the item came re-parameterised).

    Whole texts are compared. Null texts, texts without words and rows with a null id match
    nothing. Rows that repeat count once; of documents that repeat an id with other texts, the
    windows are looked at together, and so are those of items.
    """
    docs = pick(df, id=doc_id, text=text).withColumn("id", F.col("id").cast("long"))
    items = pick(benchmark, id=item_id, text=item_text).withColumn("id", F.col("id").cast("long"))
    docs, items = docs.where("id is not null"), items.where("id is not null")
    with Scratch(df.sparkSession, "decontam") as scratch:
        templates = scratch.keep(items.mapInArrow(in_slices(_templates), _ITEMS).distinct())
        # At most FILTER / 62 rows of 62 places each, whatever the size of the benchmark.
        both = f"array(key & {FILTER - 1}L, shiftright(key, 24) & {FILTER - 1}L)"
        places = templates.select(F.explode(F.expr(both)).alias("p"))
        groups = places.groupBy(F.expr("p div 62").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(p % 62 as int))")).alias("bits")
        )
        marked = np.zeros(FILTER + 62, bool)
        for word, bits in groups.collect():
            marked[62 * word + np.flatnonzero([bits >> k & 1 for k in range(62)])] = True
        # Eight sizes at most.
        sizes = sorted(row["size"] for row in templates.select("size").distinct().collect())
        wanted = df.sparkSession.sparkContext.broadcast((marked, sizes))
        found = scratch.keep(docs.mapInArrow(in_slices(_matches(wanted)), _FOUND).distinct())
        pairs = found.selectExpr("id as doc_id", "place", "key", "slots").join(
            templates.selectExpr(
                "id as item_id", "place as at", "key", "slots as own", "windows as of_windows",
                "strict",
            ),
            "key",
        )
        return scratch.keep(_consistent(pairs), last=True)


def _consistent(pairs):
    """Alignments with enough windows whose slots map values one to one."""
    alignment = ["doc_id", "item_id", "offset"]
    slot = pairs.where("size(own) = size(slots)").select(
        "doc_id", "item_id", (F.col("place") - F.col("at")).alias("offset"), "of_windows", "strict",
        F.col("place"), F.posexplode_outer(F.arrays_zip("own", "slots")).alias("k", "slot"),
    ).select(
        *alignment, "of_windows", "strict",
        F.when(F.coalesce("k", F.lit(0)) == 0, F.col("place")).alias("window"),
        F.col("slot.own").alias("own"), F.col("slot.slots").alias("value"),
    )
    by_value = slot.groupBy(*alignment, "own").agg(
        F.collect_set("window").alias("places"),
        F.max("of_windows").alias("of_windows"),
        F.max("strict").alias("strict"),
        F.max("value").alias("value"),
        F.expr("max(value) <=> min(value)").alias("same"),
        F.expr("max(value) <=> own").alias("equal"),
    )
    by_alignment = by_value.groupBy(*alignment).agg(
        # A window counts once, also where it is known with names and without.
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("windows"),
        F.max("of_windows").alias("of_windows"),
        F.max("strict").alias("strict"),
        F.expr("min(same) and count(own) = size(collect_set(value))").alias("same"),
        F.min("equal").alias("exact"),
    )
    enough = F.expr(
        f"same and (exact or not strict) and windows >= least({LEAST_WINDOWS}, of_windows)"
    )
    best = by_alignment.where(enough).groupBy("doc_id", "item_id")
    return best.agg(
        F.max("windows").alias("windows"),
        F.max("of_windows").alias("of_windows"),
        F.max("exact").alias("exact"),
    )
