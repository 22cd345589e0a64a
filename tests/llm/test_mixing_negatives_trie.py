"""Mixing, hard negatives and the prefix trie against brute force, on odd tables too."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickforge.llm import mixing, negatives, trie
from tickforge.llm.parentheses import Parentheses

# 11. Mixing


def test_budgets_are_met_as_nearly_as_any_subset_can():
    random.seed(1)
    for _ in range(200):
        lengths = sorted(random.sample(range(1, 40), random.randint(1, 5)))
        counts = [random.randint(1, 4) for _ in lengths]
        sums = {
            sum(n * x for n, x in zip(some, lengths))
            for some in itertools.product(*[range(n + 1) for n in counts])
        }
        budget = random.randint(0, max(sums))
        taken = mixing.fill_budget(lengths, counts, budget)
        assert all(0 <= t <= n for t, n in zip(taken, counts))
        got = sum(t * x for t, x in zip(taken, lengths))
        assert abs(got - budget) == min(abs(s - budget) for s in sums)


def test_large_budgets_take_even_shares_of_all_lengths():
    lengths, counts = list(range(1, 3001)), [1000] * 3000
    words = sum(1000 * x for x in lengths)
    taken = mixing.fill_budget(lengths, counts, words // 3)
    assert sum(t * x for t, x in zip(taken, lengths)) == words // 3
    assert all(330 <= t <= 336 for t in taken[200:])


def brute_targets(sizes):
    """Water-filling in fractions: (weights 3, 1, 2, at most twice a source's size)."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode())
    names += [None] * (None in sizes)
    weights = {n: (3, 1, 2)[k % 3] for k, n in enumerate(names)}
    total, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in full]
        left = total - sum(2 * sizes[n] for n in full)
        share = left / sum(weights[n] for n in free) if free else 0
        above = {n for n in free if weights[n] * share > 2 * sizes[n]}
        if not above:
            return {n: 2 * sizes[n] if n in full else weights[n] * share for n in names}
        full |= above


def documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, size long, rank long, place long"
    return spark.createDataFrame([(i, t, "en", s, -1, -1, -1) for i, t, s in rows], schema)


def test_mix_meets_its_targets(spark):
    random.seed(2)
    sources = ["src1", "src10", "src2", "a", "é", "漢", "same-first-bytes-1", "same-first-bytes-0", None, "empty"]
    rows = []
    for n in range(3000):
        source = random.choice(["src1", random.choice(sources)])
        text = None if n % 50 == 0 else " \t".join(["w\xa0x"] * random.choice([0, 1, 2, 3, 40, 41, n % 90]))
        rows.append((n, None if source == "empty" else text, source))
    rows += [(7, "seven same words that are all alike", "src1")] * 500 + [(None, "no id", "a"), (9000, "x " * 50_000, "a")]
    table = documents(spark, rows)
    got = [tuple(r) for r in mixing.mix(table).collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(((i, size(t), s) for i, t, s in rows), key=str) == sorted(((r[0], r[1], r[5]) for r in got), key=str)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want, taken = brute_targets(sizes), Counter()
    for doc_id, n, source_size, target, took, source in got:
        assert source_size == sizes[source] and target == pytest.approx(float(want[source]), abs=1e-6)
        assert took in (0, n, 2 * n)
        taken[source] += took
    for name in sizes:
        target, sums = round(float(want[name])), {0}
        for _, n, _, _, _, source in got:
            if source == name:
                sums |= {x + n for x in sums if x + n <= 2 * sizes[name]}
        once = sizes[name] * (target // sizes[name]) if sizes[name] else 0
        assert abs(taken[name] - target) == min(abs(once + x - target) for x in sums)
    again = mixing.mix(table.repartition(5, "size", "doc_id").orderBy(F.desc("doc_id")))
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in again.collect())
    assert mixing.mix(table.limit(0)).count() == 0
    nothing = mixing.mix(documents(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


# 12. Hard negatives


def brute_negatives(rows, anchors, positives, k, share):
    """rows: (id, label, whole vector)."""
    found = []
    for a, label, query in (r for r in rows if r[0] in anchors):
        scored = [(-sum(x * y for x, y in zip(query, v)), n, l) for n, l, v in rows if n != a and len(v) == len(query)]
        for s, p, _ in sorted(x[:2] + (0,) for x in scored if x[2] == label)[:positives]:
            fits = sorted((t, n) for t, n, l in scored if l != label and share * -s <= 100 * -t <= 100 * -s)
            found += [(a, p, r + 1, n, -s, -t) for r, (t, n) in enumerate(fits[:k])]
    return sorted(found)


@pytest.mark.parametrize("dimensions, spread", [(2, 1.0), (12, 1.0), (3, 0.02)])
def test_hard_negatives_match_brute_force(spark, dimensions, spread):
    rng = np.random.default_rng(dimensions)
    vectors = (rng.normal(size=(400, dimensions)) * spread).astype(np.float32)
    vectors[100:160] = vectors[100]  # ties
    rows = [(n, int(rng.integers(0, 4)), [float(x) for x in v], 1, 2) for n, v in enumerate(vectors)]
    rows += [(900, None, [0.5] * dimensions, 1, 2), (901, 1, None, 1, 2), (902, 1, [None] * dimensions, 1, 2)]
    rows += [(903, 1, [float("nan")] * dimensions, 1, 2), (904, 1, [], 1, 2), (905, 2, [0.5] * (dimensions + 1), 1, 2)]
    rows += [(920, 1, [float("inf")] * dimensions, 1, 2), (None, 1, [0.5] * dimensions, 1, 2)]
    schema = "vec_id long, label int, embedding array<float>, score long, id long"
    table = spark.createDataFrame(rows, schema)
    got = negatives.hard_negatives(table.where("vec_id % 20 = 0"), table)
    whole = [
        (n, l, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for n, l, v, *_ in rows[:400] + [rows[405]]
    ]
    want = brute_negatives(whole, set(range(0, 400, 20)), 5, 5, 80)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want
    assert negatives.hard_negatives(table.limit(0), table).count() == 0
    assert negatives.hard_negatives(table, table.limit(0)).count() == 0


def test_large_components_are_compared_exactly(spark):
    values = [3e18, 2.9e18, 2.5e18, -1e20, 1e10, 0.5, 0.25, 2.99e18]
    rows = [(n, n % 2, [x, 1.0]) for n, x in enumerate(values)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = negatives.hard_negatives(table, table)
    whole = [(n, l, [int(np.floor(x)) * 256 if abs(x) > 1e15 else int(np.floor(256 * x)), 256]) for n, l, (x, _) in rows]
    want = [(a, p, r, n) for a, p, r, n, *_ in brute_negatives(whole, set(range(8)), 5, 5, 80)]
    assert sorted(tuple(r)[:4] for r in got.select("anchor_id", "positive_id", "rank", "negative_id").collect()) == want


# 13. Prefix trie


def test_parentheses_find_and_rank():
    random.seed(3)
    for n in (1, 2, 63, 64, 65, 200, 3000):
        for lean in (0.2, 0.5, 0.9):
            bits, depth, left = [], 0, n
            while left or depth:
                opens = left and (not depth or random.random() < lean)
                bits.append(int(opens > 0))
                depth, left = (depth + 1, left - 1) if opens else (depth - 1, left)
            stack, close = [], {}
            for at, bit in enumerate(bits):
                if bit:
                    stack.append(at)
                else:
                    close[stack.pop()] = at
            tree, opens = Parentheses(np.array(bits)), np.array(sorted(close))
            closes = tree.findclose(opens)
            assert closes.tolist() == [close[at] for at in opens]
            leaves = [sum(bits[k] == 1 > bits[k + 1] for k in range(at, close[at])) for at in opens]
            assert tree.leaf_pairs(opens, closes).tolist() == leaves


def brute_trie(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv_id].append((turn is not None, turn or 0, tie, role, text))
    turns = {c: [x[3:] for x in sorted(said)] for c, said in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        head = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        whole = tuple(turns.get(base, [])[:head] + turns[c][head:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, inside in members.items():
        value = (len(inside) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            leaves[node[:d]] += node not in children
    return sorted(
        (
            min(inside), len(node), members[node[:-1]][0] if node else -1, len(inside), children[node],
            leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, inside in members.items()
    )


def conversations(spark, rows):
    schema = "conv_id long, turn int, role string, text string, depth long, k1 long, piece long"
    return spark.createDataFrame([(*r, -1, -1, -1) for r in rows], schema)


def nodes(found):
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    found = found.select(*columns).fillna(-1, ["parent_conv_id"])
    return sorted(tuple(r) for r in found.collect())


def odd_conversations():
    random.seed(4)
    rows = []
    for c in [*range(-12, 60), *range(100, 160, 3)]:
        said = [("user", "hello"), ("bot", "hi, 漢"), *((random.choice("ab"), random.choice(["x", "é", "y"])) for _ in range(9))]
        rows += [(c, t, *turn) for t, turn in enumerate(said[: random.randint(1, 11)])]
    rows += [(30, 2, None, None), (30, 2, "", ""), (31, None, "x", None), (31, None, None, "x"), (33, 1, "user", "w" * 5000)]
    rows += [(None, 0, "user", "lost"), (70, 0, None, None)] + rows[:20]
    rows += [(40, t, "user", str(t % 3)) for t in range(300)] + [(41, t, "user", str(t % 3)) for t in range(290)]
    return rows


@pytest.mark.parametrize("piece, shard_rows", [(trie.PIECE, trie.SHARD_ROWS), (4, 50), (2, 20)])
def test_trie_matches_brute_force(spark, piece, shard_rows):
    rows = odd_conversations()
    assert nodes(trie.prefix_trie(conversations(spark, rows), piece, shard_rows)) == brute_trie(rows)


def test_trie_of_long_sums_and_chunked_ids(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 7)
    rows = odd_conversations()
    assert nodes(trie.prefix_trie(conversations(spark, rows))) == brute_trie(rows)


def test_trie_of_odd_tables(spark):
    assert nodes(trie.prefix_trie(conversations(spark, []))) == []
    turnless = [(c, 0, "u", "t") for c in range(1, 4) if zlib.crc32(str(c).encode()) % 9]
    assert turnless and nodes(trie.prefix_trie(conversations(spark, turnless))) == brute_trie(turnless)
    same = [(5 * c, t, "u", f"t{t}") for c in range(500) for t in range(3)]
    assert nodes(trie.prefix_trie(conversations(spark, same))) == brute_trie(same)


def test_shards_count_a_node_once():
    """Two paths that share a spine, the second without values of its own there."""
    rows = pd.DataFrame(
        [(1, 0, d, k, 0, 0, 0, leaf, 0, saved) for d, k, leaf, saved in [(1, 5, 0, 10), (2, 6, 1, 3)]]
        + [(2, 0, d, k, 0, 0, 0, leaf, 0, saved) for d, k, leaf, saved in [(1, 5, 0, 0), (2, 7, 1, 4)]],
        columns=["conv_id", "piece", *trie.NODE, "leaf", "carried", "saved"],
    )
    found = trie.shard_totals(rows).set_index("k1")
    assert found["n_leaves"].to_dict() == {5: 2, 6: 1, 7: 1}
    assert found["saved"].to_dict() == {5: 17, 6: 3, 7: 4}
