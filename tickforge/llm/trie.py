"""The trie of all conversation prefixes, as balanced parentheses in shards.

A node is a distinct sequence of first turns. It is known by its depth and the sums of four
hashes of (place, turn) over the sequence: sums add up in parts, so a conversation of any
length is cut into blocks and no task needs all of it.

Only paths to leaves are laid out: one conversation for each leaf, dealt over shards by its
id. A shard encodes its paths as one balanced-parentheses sequence; ``findclose`` delimits
each subtree, the rank of pairs "()" counts the leaves in it, and cumulative arrays give the
savings. Every node's own value counts in one shard only, that of its owner, the smallest of
the laid-out conversations that pass it; the others hold it as part of a spine they share.
Adding up the shards' results by node merges the spines.

Paths longer than ``PIECE`` turns are cut into pieces. The totals of all pieces that hang from
a cut make up a smaller trie of cuts, which is solved first in the same way.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, pick
from tickforge.llm.parentheses import Parentheses
from tickforge.operators.slices import number_rows

#: Turns in one block of running sums, in one piece of a path, and rows of one shard.
BLOCK = 4096
PIECE = 65_536
SHARD_ROWS = 100_000
#: Bytes of ids in one row on the way to a digest.
CHUNK = 65_536

KEY = ["k1", "k2", "k3", "k4"]
PARENT = ["p1", "p2", "p3", "p4"]
NODE = ["depth", *KEY]


def _quarters(text) -> list[F.Column]:
    """The first 128 bits of a SHA-256 as four numbers."""
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9, 17, 25)]


def head_length(conv_id: str) -> F.Column:
    """How many turns a conversation takes from the first of its five: 0 to 8."""
    return (F.crc32(F.col(conv_id).cast("string")) % 9).cast("long")


def numbered_turns(df: DataFrame, scratch) -> DataFrame:
    """(conv_id, place from 1, turn digest, bytes of the text), texts left behind."""
    rows = pick(df, conv_id="conv_id", turn="turn", role="role", text="text")
    rows = rows.where("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        said.alias("said"), F.octet_length(text).cast("long").alias("bytes"),
        F.conv(F.substring(said, 1, 15), 16, 10).cast("long").alias("tie"),
    )
    numbered = number_rows(scratch.keep(turns), ["conv_id"], ["turn", "tie", "said"], "place")
    return scratch.keep(numbered.drop("turn", "tie"))


def rebuilt(turns: DataFrame, scratch) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows): (conv_id, length) and (conv_id, place, said, bytes) as rebuilt.

    Conversation c consists of the first ``head_length`` turns of conversation c - c % 5
    (all if fewer, none if absent), then of its own turns after as many.
    """
    counted = scratch.keep(turns.groupBy("conv_id").agg(F.max("place").alias("own")))
    firsts = counted.where("conv_id % 5 = 0").selectExpr("conv_id as base", "own as there")
    base = F.expr("conv_id - conv_id % 5 as base")
    convs = counted.select("conv_id", "own", head_length("conv_id").alias("head"), base)
    convs = convs.join(firsts, "base", "left")
    convs = scratch.keep(
        convs.withColumn("lent", F.least("head", F.coalesce("there", F.lit(0)))).withColumn(
            "length", F.col("lent") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
        )
    )
    lent = turns.where("place <= 8 and conv_id % 5 = 0").withColumnRenamed("conv_id", "base")
    lent = convs.select("base", "conv_id", "lent").join(lent, "base").where("place <= lent")
    own = turns.where(F.col("place") > head_length("conv_id"))
    short = convs.where("lent < head").select("conv_id", F.expr("lent - head as shift"))
    own = own.join(short, "conv_id", "left").withColumn("place", F.expr("place + coalesce(shift, 0)"))
    columns = ["conv_id", "place", "said", "bytes"]
    return convs, lent.select(*columns).unionByName(own.select(*columns))


def paths(rows: DataFrame, scratch) -> DataFrame:
    """(conv_id, depth, k1..k4, p1..p4, bytes): the node after each turn, and its parent."""
    parts = _quarters(F.concat_ws(":", "place", "said"))
    rows = scratch.keep(
        rows.select(
            "conv_id", F.col("place").alias("depth"), "bytes",
            F.expr(f"(place - 1) div {BLOCK} as block"),
            *[part.alias(name) for part, name in zip(parts, KEY)],
        )
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy("conv_id", "block")
        .agg(*[F.sum(k).alias(k) for k in KEY])
        .select("conv_id", "block", *[F.sum(k).over(before).alias(f"c{k}") for k in KEY])
        .where("block > 0")
    )
    in_block = Window.partitionBy("conv_id", "block").orderBy("depth")
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select(
        "conv_id", "depth", "block", "bytes",
        *[F.col(k).alias(f"own_{k}") for k in KEY], *[F.sum(k).over(upto).alias(k) for k in KEY],
    )
    sums = inside.join(carried, ["conv_id", "block"], "left")
    sums = sums.select(
        "conv_id", "depth", "bytes", *[f"own_{k}" for k in KEY],
        *[F.expr(f"{k} + coalesce(c{k}, 0)").alias(k) for k in KEY],
    )
    return sums.select(
        "conv_id", *NODE, "bytes", *[F.expr(f"{k} - own_{k}").alias(p) for k, p in zip(KEY, PARENT)]
    )


def shard_totals(rows: pd.DataFrame) -> pd.DataFrame:
    """Leaves and savings below every node of one shard.

    ``rows`` are pieces of paths: conv_id, piece, depth, key, leaf (a leaf of the whole trie),
    carried (leaves that count here besides) and saved. Nodes that several paths pass are
    laid out once; their values are added.
    """
    rows = rows.sort_values(["conv_id", "piece", "depth"], ignore_index=True)
    keys = rows[NODE].to_numpy()
    nodes, first, at = np.unique(keys, axis=0, return_index=True, return_inverse=True)
    at, count = at.ravel(), len(nodes)
    same = (rows["conv_id"].to_numpy()[1:] == rows["conv_id"].to_numpy()[:-1]) & (
        rows["piece"].to_numpy()[1:] == rows["piece"].to_numpy()[:-1]
    )
    above = np.full(len(rows), -1)
    above[1:][same] = at[:-1][same]
    parent = above[first]
    children = np.argsort(parent, kind="stable")
    begins = np.searchsorted(parent[children], np.arange(-1, count + 1))
    # Children of node v: children[begins[v + 1] : begins[v + 2]].
    bits, opened, stack = [], [], list(children[begins[0] : begins[1]][::-1])
    while stack:
        node = stack.pop()
        if node < 0:
            bits.append(0)
            continue
        bits.append(1)
        opened.append(node)
        stack.append(-1)
        stack.extend(children[begins[node + 1] : begins[node + 2]][::-1].tolist())
    tree = Parentheses(np.array(bits))
    opened, opens = np.array(opened), np.flatnonzero(tree.bits)
    closes = tree.findclose(opens)
    here = {name: np.zeros(count, np.int64) for name in ("leaf", "carried", "saved")}
    for name, total in here.items():
        np.add.at(total, at, rows[name].to_numpy())
    # A pair that is no leaf of the whole trie is a path cut short: what hangs there is carried.
    cut = (begins[opened + 2] == begins[opened + 1]) & (here["leaf"][opened] == 0)
    # Opening parentheses are the nodes in order, so a subtree is a stretch of them.
    ends = np.arange(len(opened)) + (closes - opens + 1) // 2
    running = lambda values: np.concatenate([[0], np.cumsum(values)])
    extra, saved = running(here["carried"][opened] - cut), running(here["saved"][opened])
    start = np.arange(len(opened))
    out = pd.DataFrame(nodes[opened], columns=NODE)
    out["n_leaves"] = tree.leaf_pairs(opens, closes) + extra[ends] - extra[start]
    out["saved"] = saved[ends] - saved[start]
    return out


def subtree_totals(rows: DataFrame, scratch, piece=PIECE, shard_rows=SHARD_ROWS) -> DataFrame:
    """(depth, k1..k4, n_leaves, saved) over the subtree of every node of ``rows``.

    ``rows``: conv_id, depth, k1..k4, leaf, carried, saved; the last two are 0 but in the row
    of a node's owner, and every row's ancestors are rows of the same conversation.
    """
    rows = scratch.keep(rows.withColumn("piece", F.expr(f"(depth - 1) div {piece}")))
    count, deepest = rows.agg(F.count("*"), F.max("depth")).first()
    if (deepest or 0) > piece:
        number = F.expr(f"depth div {piece}").alias("piece")
        cuts = rows.where(f"depth % {piece} = 0").select("conv_id", number, *KEY, "owner")
        cuts = scratch.keep(cuts)
        hanging = rows.where("piece > 0 and owner")
        hanging = hanging.select("conv_id", "piece", "leaf", "carried", "saved")
        hanging = (
            hanging.join(cuts.drop("owner"), ["conv_id", "piece"])
            .groupBy("piece", *KEY)
            .agg(F.sum(F.col("carried") + F.col("leaf")).alias("carried"), F.sum("saved").alias("saved"))
        )
        smaller = cuts.join(hanging, ["piece", *KEY], "left").select(
            "conv_id", F.col("piece").alias("depth"), *KEY, F.lit(0).alias("leaf"), "owner",
            F.expr("if(owner, coalesce(carried, 0), 0)").alias("carried"),
            F.expr("if(owner, coalesce(saved, 0), 0)").alias("saved"),
        )
        below = scratch.keep(subtree_totals(smaller, scratch, piece, shard_rows))
        below = below.select(
            (F.col("depth") * piece).alias("depth"), *KEY, "n_leaves", F.col("saved").alias("more")
        )
        rows = rows.join(below, NODE, "left")
        for name, more in (("carried", "n_leaves"), ("saved", "more")):
            rows = rows.withColumn(name, F.expr(f"{name} + if(owner, coalesce({more}, 0), 0)"))
    shards = max(1, -(-count // shard_rows))
    dealt = rows.select(
        "conv_id", "piece", *NODE, "leaf", "carried", "saved",
        F.expr(f"pmod(xxhash64(conv_id, piece), {shards}L) as shard"),
    )
    fields = ", ".join(f"{name} long" for name in [*NODE, "n_leaves", "saved"])
    totals = dealt.groupBy("shard").applyInPandas(shard_totals, fields)
    sums = [F.sum(name).alias(name) for name in ("n_leaves", "saved")]
    return totals.groupBy(*NODE).agg(*sums)


def _chunks(batches):
    """Runs of ids of one node, joined; rows come in order of node and id."""
    node, first, ids, size = None, None, [], 0

    def row():
        return pa.RecordBatch.from_pylist(
            [dict(zip(NODE, node), first=first, ids=",".join(ids))], schema=_CHUNK_SCHEMA
        )

    for batch in batches:
        for *now, conv_id in zip(*(batch.column(i).to_pylist() for i in range(len(NODE) + 1))):
            if now != node or size > CHUNK:
                if ids:
                    yield row()
                node, first, ids, size = now, conv_id, [], 0
            ids.append(str(conv_id))
            size += len(ids[-1]) + 1
    if ids:
        yield row()


_CHUNK_SCHEMA = pa.schema([*[(name, pa.int64()) for name in [*NODE, "first"]], ("ids", pa.string())])
_DIGEST_SCHEMA = pa.schema([*[(name, pa.int64()) for name in NODE], ("ends_sha256", pa.string())])


def _hashes(batches):
    """One digest for each node; its chunks come in order and are never held together."""
    node, digest = None, None
    for batch in batches:
        done = []
        for *now, _, ids in zip(*(batch.column(i).to_pylist() for i in range(len(NODE) + 2))):
            if now != node:
                if node:
                    done.append(dict(zip(NODE, node), ends_sha256=digest.hexdigest()))
                node, digest = now, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_DIGEST_SCHEMA)
    if node:
        last = dict(zip(NODE, node), ends_sha256=digest.hexdigest())
        yield pa.RecordBatch.from_pylist([last], schema=_DIGEST_SCHEMA)


def end_digests(ends: DataFrame, scratch) -> DataFrame:
    """(node, ends_sha256): SHA-256 of each node's ids in order, joined by commas.

    Ids are joined into chunks where a range partitioning of (node, id) has put them, so a
    node with very many is joined by many tasks. Its digest is one sequence by definition:
    one task streams the chunks.
    """
    ordered = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    longs = ", ".join(f"{name} long" for name in NODE)
    chunks = scratch.keep(ordered.mapInArrow(_chunks, f"{longs}, first long, ids string"))
    ordered = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return ordered.mapInArrow(_hashes, f"{longs}, ends_sha256 string")


def prefix_trie(df: DataFrame, piece=PIECE, shard_rows=SHARD_ROWS) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations.

    conv_id is the smallest member's, parent_conv_id the parent's conv_id (null for the root),
    n_convs counts members, n_children the sequences one turn longer, n_leaves the childless
    nodes of the subtree, saved_tokens adds (n_convs - 1) times the bytes of the last text over
    it, and ends_sha256 is the digest of the ids of the members that end here.

    Turns are ordered by turn, null first, and turns with equal numbers by their content's
    digest, so repeated rows are repeated turns. A null role or text counts as empty. Rows
    without conv_id are left out. A conversation that is rebuilt without turns is a member of
    the root. An empty table has no nodes. Other columns are left out.
    """
    with Scratch(df.sparkSession, "trie") as scratch:
        convs, rows = rebuilt(numbered_turns(df, scratch), scratch)
        along = scratch.keep(paths(rows, scratch))
        grouped = along.groupBy(*NODE)
        nodes = scratch.keep(
            grouped.agg(
                F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                F.min("bytes").alias("bytes"), *[F.min(p).alias(p) for p in PARENT],
            )
        )
        up = F.expr("depth - 1").alias("depth")
        children = scratch.keep(
            nodes.select(up, *[F.col(p).alias(k) for k, p in zip(KEY, PARENT)])
            .groupBy(*NODE)
            .agg(F.count("*").alias("n_children"))
        )
        leaves = nodes.join(children, NODE, "left_anti")
        leaves = scratch.keep(leaves.select("conv_id", F.col("depth").alias("end")))
        laid = scratch.keep(
            along.join(leaves, "conv_id")
            .where("depth <= end")
            .select("conv_id", *NODE, F.expr("cast(depth = end as int) as leaf"))
        )
        owners = laid.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"))
        values = nodes.select(*NODE, F.expr("(n_convs - 1) * bytes as saved"))
        owned = owners.join(values, NODE).withColumn("owner", F.lit(True))
        laid = laid.join(owned, ["conv_id", *NODE], "left").select(
            "conv_id", *NODE, "leaf", F.lit(0).cast("long").alias("carried"),
            F.coalesce("saved", F.lit(0)).alias("saved"), F.coalesce("owner", F.lit(False)).alias("owner"),
        )
        totals = scratch.keep(subtree_totals(laid, scratch, piece, shard_rows))
        zero = [F.lit(0).cast("long").alias(name) for name in NODE]
        root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
        root = root.where("n_convs > 0")
        # Without a turn the root is a leaf itself.
        root_totals = totals.where("depth = 1").agg(
            F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
            F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"),
        )
        last = convs.where("length > 0").select("conv_id", F.col("length").alias("depth"))
        ends = along.join(last, ["conv_id", "depth"]).select(*NODE, "conv_id")
        ends = ends.unionByName(convs.where("length = 0").select(*zero, "conv_id"))
        parts = [
            nodes.drop("bytes"), root.select(*zero, "conv_id", "n_convs"), children, totals,
            root_totals.select(*zero, "n_leaves", "saved"),
            end_digests(scratch.keep(ends), scratch),
        ]
        together = parts[0]
        for part in parts[1:]:
            together = together.unionByName(part, allowMissingColumns=True)
        names = ["conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256", *PARENT]
        found = together.groupBy(*NODE).agg(*[F.max(name).alias(name) for name in names])
        found = scratch.keep(found.where("conv_id is not null"))
        parents = nodes.select(
            F.expr("depth + 1").alias("depth"), *[F.col(k).alias(p) for k, p in zip(KEY, PARENT)],
            F.col("conv_id").alias("above"),
        )
        top = zip(["depth", *PARENT], [1, 0, 0, 0, 0])
        top = [F.lit(value).cast("long").alias(name) for name, value in top]
        parents = parents.unionByName(root.select(*top, F.col("conv_id").alias("above")))
        empty = hashlib.sha256().hexdigest()
        return scratch.keep(
            found.join(parents, ["depth", *PARENT], "left").select(
                "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs",
                F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
                F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
            ),
            last=True,
        )
