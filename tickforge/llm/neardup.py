"""Near-duplicate documents by SetSketch registers, checked on full shingle sets.

1. Each document's distinct word shingles give a fingerprint of the set and a SetSketch:
   per register the smallest of exponentially distributed hashes, kept as the truncated
   logarithm of its size to base 1.2. Registers merge by maximum and agree more often the
   more similar two sets are.
2. Documents with equal sets form a class; its smallest id stands for it from here on.
3. Eight registers make a band, 64 bands in all. Two sets at similarity 0.8 share no band
   with probability 9e-7. Representatives with equal bands meet in a bucket.
4. Candidates are first compared with the smallest member of a bucket, its leader, so that a
   bucket of any size costs one comparison for each member. Members that are then still
   outside their leader's component are held against all members of other components that
   have the same leader, once for all buckets of that leader, in blocks of bounded size
   within tasks. Those that share a band are estimated there, then the full sets of what may
   be links are compared; only links become rows of pairs. Nothing is left out.
5. A candidate's similarity is estimated by maximum likelihood from the registers that are
   smaller, equal and larger, jointly with the known set sizes. What may reach the
   threshold is decided on the full sets.
6. Links are closed to components by alternating stars.

Only written tables pass between steps. The driver sees counts, never ids.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, in_slices, pick, rows_of
from tickforge.llm.graph import components
from tickforge.llm.shingles import mix, shingle_set

REGISTERS = 512
BANDS = 64
BASE = 1.2
RATE = 20.0
LARGEST = 255
#: Estimates below this go no further; more than five deviations below a true 0.8.
LEAST_ESTIMATE = 0.7
#: Members of a leader's buckets that one block of a task holds, on average.
BLOCK_ROWS = 256

_RANDOM = np.random.default_rng(77)
_XOR = _RANDOM.integers(0, 1 << 32, REGISTERS, np.uint32)
_ODD = _RANDOM.integers(0, 1 << 32, REGISTERS, np.uint32) | np.uint32(1)
_BAND = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def set_sketch(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint8) of a set of 64-bit hashes."""
    narrow = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(narrow), 256):
        hashes = (narrow[start : start + 256, None] ^ _XOR) * _ODD
        np.minimum(least, hashes.min(axis=0), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LARGEST).astype(np.uint8)


def merge_sketches(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(one, other)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of eight registers."""
    return mix(registers.reshape(BANDS, -1).view(np.uint64)[:, 0] + _BAND)


def _less(x):
    """Chance that one register is smaller, by the share of the union it misses."""
    return -np.log(1 - x * (BASE - 1) / BASE) / np.log(BASE)


def estimate(one: np.ndarray, other: np.ndarray, size_one, size_other) -> np.ndarray:
    """Jaccard similarities of pairs by maximum likelihood on a grid of 0.01.

    ``one`` and ``other`` hold a sketch in each row, the sizes are those of the sets.
    """
    total = size_one + size_other
    u, v = (size_one / total)[:, None], (size_other / total)[:, None]
    larger = (one > other).sum(axis=1)[:, None]
    smaller = (one < other).sum(axis=1)[:, None]
    equal = one.shape[1] - larger - smaller
    j = np.minimum(u / v, v / u) * np.linspace(0, 1, 101)
    up, down = _less(np.maximum(u - v * j, 0)), _less(np.maximum(v - u * j, 0))
    tiny = 1e-12
    likelihood = (
        larger * np.log(up + tiny)
        + smaller * np.log(down + tiny)
        + equal * np.log(np.maximum(1 - up - down, tiny))
    )
    return j[np.arange(len(j)), likelihood.argmax(axis=1)]


def _sketches(words: int):
    """Per document: set size, fingerprint, band keys. Empty sets have no fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sizes, prints, bands = [], [], []
            for text in batch.column(1).to_pylist():
                shingles = shingle_set(text, words)
                sizes.append(len(shingles))
                if len(shingles):
                    prints.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(set_sketch(shingles)).view(np.int64))
                else:
                    prints.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "print", "bands"],
            )

    return run


def _with_registers(words: int):
    """Per candidate: id, set size, registers, text."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sets = [shingle_set(text, words) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array([set_sketch(s).tobytes() for s in sets], pa.binary()),
                    batch.column(1),
                ],
                names=["node", "n", "registers", "text"],
            )

    return run


def _likely(batches: Iterator[pa.RecordBatch]):
    """Keep the pairs whose estimate allows a link."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        one, other = (
            np.frombuffer(b"".join(columns[c].to_pylist()), np.uint8).reshape(-1, REGISTERS)
            for c in ("registers_a", "registers_b")
        )
        sizes = [columns[c].to_numpy().astype(float) for c in ("n_a", "n_b")]
        keep = pa.array(estimate(one, other, *sizes) >= LEAST_ESTIMATE)
        pairs = [columns["a"].filter(keep), columns["b"].filter(keep)]
        yield pa.RecordBatch.from_arrays(pairs, names=["a", "b"])


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two full sets reach the threshold."""
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(other) - common)


def _linked(words: int, percent: int):
    """Keep the pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep, known = [], {}
            for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                sets = []
                for text in (one, other):
                    if text not in known:
                        if len(known) >= 64:
                            known.clear()
                        known[text] = shingle_set(text, words)
                    sets.append(known[text])
                keep.append(linked(*sets, percent))
            keep = pa.array(keep, pa.bool_())
            pairs = [batch.column(0).filter(keep), batch.column(1).filter(keep)]
            yield pa.RecordBatch.from_arrays(pairs, names=["u", "v"])

    return run


def _pair_links(pairs, candidates, words, percent):
    """The pairs (a, b) that are links: sizes and estimate first, then the full sets."""

    def beside(df, side, *columns):
        own = candidates.selectExpr(f"node as {side}", *[f"{c} as {c}_{side}" for c in columns])
        return df.join(own.hint("merge"), side)

    sized = beside(beside(pairs, "a", "n", "registers"), "b", "n", "registers").where(
        f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    )
    likely = sized.mapInArrow(_likely, "a bigint, b bigint")
    texts = beside(beside(likely, "a", "text"), "b", "text")
    return texts.select("a", "b", "text_a", "text_b").mapInArrow(
        _linked(words, percent), "u bigint, v bigint"
    )


def near_duplicates(
    df: DataFrame, words=5, percent=80, doc_id="doc_id", text="text"
) -> DataFrame:
    """Per row: doc_id (long), n_shingles, component_id, kept.

    A document's set holds its distinct shingles of ``words`` words, A-Z lower-cased, words
    between ASCII white space; a shorter text counts as one shingle. Two documents are
    linked if 100 * intersection >= ``percent`` * union. ``component_id`` is the smallest id
    reachable, ``kept`` marks the row whose id it is.

    Null and empty texts have an empty set and are linked with nothing. Of rows that repeat an
    id each has the component of its own text. A null id takes the component of equal sets,
    or null if it has none, and is never kept. Columns beside id and text are left out.
    """
    docs = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    with Scratch(df.sparkSession, "neardup") as scratch:
        sketches = scratch.keep(
            docs.mapInArrow(
                in_slices(_sketches(words)), "doc_id bigint, n bigint, print binary, bands array<bigint>"
            )
        )
        classes = scratch.keep(
            sketches.where("print is not null")
            .groupBy("print")
            .agg(F.min("doc_id").alias("node"))
            .where("node is not null")
        )
        buckets = _buckets(sketches, classes, scratch)
        ids = buckets.select(F.col("node").alias("doc_id"))
        candidates = scratch.keep(
            rows_of(docs, ids, "doc_id", scratch).mapInArrow(
                in_slices(_with_registers(words)), "node bigint, n bigint, registers binary, text string"
            ).where("n > 0")
        )
        closed = _closed(buckets, candidates, words, percent, scratch)
        # Tables of ids grow with the corpus: shuffled at every size, never broadcast.
        named = sketches.select("doc_id", "n", "print").join(classes.hint("merge"), "print", "left")
        named = scratch.keep(named.select("doc_id", "n", F.coalesce("node", "doc_id").alias("node")))
        rows = named.join(closed.hint("merge"), "node", "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "node").alias("component_id"),
        )
        kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
        return scratch.keep(rows.withColumn("kept", kept), last=True)


def _buckets(sketches, classes, scratch):
    """(node, leader) of all buckets with two representatives or more, each pair once."""
    nodes = sketches.join(
        classes.select(F.col("node").alias("doc_id"), "print").hint("merge"),
        ["doc_id", "print"],
        "left_semi",
    )
    members = scratch.keep(
        nodes.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    )
    leaders = scratch.keep(
        members.groupBy("key")
        .agg(F.min("node").alias("leader"), F.max("node").alias("last"))
        .where("leader < last")
        .select("key", "leader")
    )
    joined = members.join(leaders.hint("merge"), "key")
    return scratch.keep(joined.select("node", "leader").distinct())


def _closed(buckets, candidates, words, percent, scratch):
    """(node, component) of all nodes that are not the smallest of their component."""

    others = buckets.where("node <> leader")
    # One leader for each node: the smallest it shares a bucket with.
    first = others.groupBy("node").agg(F.min("leader").alias("a")).selectExpr("a", "node as b")
    links = scratch.keep(_pair_links(first, candidates, words, percent))
    closed = components(links, scratch)
    for further in (_with_leaders, _in_blocks):
        more = scratch.keep(further(buckets, closed, candidates, words, percent, scratch))
        if not more.isEmpty():
            before = closed.selectExpr("node as u", "component as v")
            closed = components(before.union(more), scratch)
    return closed


def _named(buckets, closed, column, name):
    """Add the component of a column of ids."""
    found = closed.selectExpr(f"node as {column}", f"component as {name}_found")
    joined = buckets.join(found.hint("merge"), column, "left")
    return joined.withColumn(name, F.coalesce(f"{name}_found", column)).drop(f"{name}_found")


def _with_leaders(buckets, closed, candidates, words, percent, scratch):
    """Every member with its bucket's leader, where they are not yet connected."""
    others = buckets.where("node <> leader")
    named = _named(_named(others, closed, "node", "own"), closed, "leader", "of")
    pairs = named.where("own <> of").selectExpr("leader as a", "node as b")
    return _pair_links(pairs, candidates, words, percent)


def _in_blocks(buckets, closed, candidates, words, percent, scratch):
    """Members outside their leader's component with every member of another component.

    All buckets of one leader are looked at together, so that a member comes once and not
    under every band. Outside and all members are dealt to blocks by hash; each pair of an
    outside and a member block is one group of bounded size.
    """
    named = _named(_named(buckets, closed, "node", "own"), closed, "leader", "of")
    named = scratch.keep(named.selectExpr("leader as key", "node", "own", "own <> of as outside"))
    sizes = named.groupBy("key").agg(
        F.count("*").alias("members"), F.sum(F.col("outside").cast("long")).alias("out")
    )
    sizes = scratch.keep(
        sizes.where("out > 0").selectExpr(
            "key", f"ceil(out / {BLOCK_ROWS}) as outs", f"ceil(members / {BLOCK_ROWS}) as blocks"
        )
    )
    mixed = named.join(sizes, "key").join(
        candidates.select("node", F.col("n").cast("double").alias("n"), "registers").hint("merge"),
        "node",
    )
    place = "pmod(xxhash64(node), {})"
    first = mixed.where("outside").selectExpr(
        "*", f"{place.format('outs')} as i", "explode(sequence(0L, blocks - 1)) as j", "0 as side"
    )
    second = mixed.selectExpr(
        "*", "explode(sequence(0L, outs - 1)) as i", f"{place.format('blocks')} as j", "1 as side"
    )
    columns = ["side", "node", "own", "outside", "n", "registers"]
    likely = scratch.keep(
        _grouped(first.union(second), columns).mapInArrow(
            _compared(percent),
            "key bigint, i bigint, j bigint, a array<bigint>, b array<bigint>, nodes array<bigint>",
        )
    )
    # The texts that a group's likely pairs need, then the pairs themselves.
    needed = likely.select(*_GROUP, F.explode("nodes").alias("node"))
    texts = needed.join(candidates.select("node", "text").hint("merge"), "node")
    rows = texts.withColumn("last", F.lit(0)).unionByName(
        likely.select(*_GROUP, "a", "b").withColumn("last", F.lit(1)), allowMissingColumns=True
    )
    return _grouped(rows, ["last", "node", "text", "a", "b"], "last").mapInArrow(
        _confirmed(words, percent), "u bigint, v bigint"
    )


_GROUP = ["key", "i", "j"]


def _grouped(rows, columns, *order):
    """Rows of a group in a row, within one task; a task has many groups of bounded size."""
    dealt = rows.select(*_GROUP, *columns).repartition(*_GROUP)
    return dealt.sortWithinPartitions(*_GROUP, *order)


def _confirmed(words, percent):
    """Links among the likely pairs of each group, whose row follows those of its texts."""

    def run(batches: Iterator[pa.RecordBatch]):
        texts = {}
        for batch in batches:
            last, node, text, a, b = (batch.column(c) for c in ("last", "node", "text", "a", "b"))
            # Pairs of a group are many: they stay arrays, one group at a time.
            for row, done in enumerate(last.to_pylist()):
                if not done:
                    texts[node[row].as_py()] = text[row].as_py()
                    continue
                sets = {node: shingle_set(text, words) for node, text in texts.items()}
                texts = {}
                one, other = (c[row].values.to_numpy() for c in (a, b))
                pairs = zip(one.tolist(), other.tolist())
                keep = np.fromiter((linked(sets[x], sets[y], percent) for x, y in pairs), bool, len(one))
                if keep.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one[keep]), pa.array(other[keep])], names=["u", "v"]
                    )

    return run


def _compared(percent):
    """Likely pairs of each group, in one row with the nodes they are made of."""

    def pairs_of(rows):
        one, other = (rows["side"] == 0).nonzero()[0], (rows["side"] == 1).nonzero()[0]
        a, b = (x.ravel() for x in np.meshgrid(one, other, indexing="ij"))
        n, own, node = rows["n"], rows["own"], rows["node"]
        near = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        # Of two members that are both outside, one order is enough.
        keep = near & (own[a] != own[b]) & (~rows["outside"][b] | (node[a] < node[b]))
        a, b = a[keep], b[keep]
        if not len(a):
            return node[a], node[b]
        registers = np.frombuffer(b"".join(rows["registers"]), np.uint8).reshape(-1, REGISTERS)
        keys = np.stack([band_keys(r) for r in registers]).view(np.int64)
        found = []
        for start in range(0, len(a), 4096):
            one, other = a[start : start + 4096], b[start : start + 4096]
            meet = (keys[one] == keys[other]).any(axis=1)
            one, other = one[meet], other[meet]
            if len(one):
                guess = estimate(registers[one], registers[other], n[one], n[other])
                found.append((one[guess >= LEAST_ESTIMATE], other[guess >= LEAST_ESTIMATE]))
        one, other = (np.concatenate([f[k] for f in found] or [a[:0]]) for k in (0, 1))
        return node[one], node[other]

    def row_of(rows):
        a, b = pairs_of(rows)
        if len(a):
            nodes = np.unique(np.concatenate([a, b]))
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (a, b, nodes)]
            place = [pa.array(rows[c][:1]) for c in _GROUP]
            yield pa.RecordBatch.from_arrays([*place, *lists], names=[*_GROUP, "a", "b", "nodes"])

    def run(batches: Iterator[pa.RecordBatch]):
        held = None
        for batch in _joined(batches):
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            rows = {c: table.column(c).to_numpy() for c in table.column_names}
            edge = np.flatnonzero(np.any([rows[c][1:] != rows[c][:-1] for c in _GROUP], axis=0))
            starts = [0, *(edge + 1)]
            for start, end in zip(starts, starts[1:]):
                yield from row_of({c: v[start:end] for c, v in rows.items()})
            held = table.slice(starts[-1]).combine_chunks().to_batches()[0]
        if held is not None:
            last = pa.Table.from_batches([held])
            yield from row_of({c: last.column(c).to_numpy() for c in last.column_names})

    return run


def _joined(batches, rows=4096):
    """Arrow batches of at least so many rows each, but for the last."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
