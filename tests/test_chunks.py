import json
import random

import pytest

from tickforge.operators.chunks import latest_per_key, message_chunks
from tickforge.operators.slices import number_rows
from tickforge.schemas import KEYS


@pytest.fixture(scope="module")
def skewed(make_trades):
    rng = random.Random(3)
    ids = rng.sample(range(-(10**15), 10**15), 300)
    return make_trades(*[{"symbol": "HOT" if i % 4 else "A", "id": n} for i, n in enumerate(ids)])


@pytest.mark.parametrize("target", [5, 60, 10_000])
def test_row_numbers_of_hot_keys(skewed, target):
    rows = number_rows(skewed, KEYS, ["id"], "n", target).collect()
    for symbol in ("HOT", "A"):
        numbers = [r.n for r in sorted(rows, key=lambda r: r.id) if r.symbol == symbol]
        assert numbers == list(range(1, len(numbers) + 1))


def test_numbering_joins_by_hash(skewed):
    numbered = number_rows(skewed, KEYS, ["id"], "n", 60)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    # Rows and their counts each meet hot keys and quantiles, rows the offsets, too.
    assert plan.count("BroadcastHashJoin") == 5
    assert "NestedLoop" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("target", [7, 10_000])
def test_chunks_hold_whole_messages_in_order(skewed, target):
    made = message_chunks(
        skewed.select(*KEYS, "id", "price"), ["id"], size=20, target_rows=target
    ).collect()
    assert all(1 <= c.n_messages <= 20 for c in made)
    for symbol, total in (("HOT", 225), ("A", 75)):
        mine = sorted((c for c in made if c.symbol == symbol), key=lambda c: c.chunk)
        assert [c.chunk for c in mine] == list(range(-(-total // 20)))
        ids = [m["id"] for c in mine for m in json.loads(c.messages)]
        assert ids == sorted(ids) and len(ids) == total
        assert all(c.n_messages == 20 for c in mine[:-1])
        for c in mine:
            inside = [m["id"] for m in json.loads(c.messages)]
            assert (c.first_order, c.last_order) == (inside[0], inside[-1])


def test_latest_per_key(make_trades):
    trades = make_trades(
        {"symbol": "A", "id": 1}, {"symbol": "A", "id": 5, "price": 3}, {"symbol": "B", "id": 2}
    )
    newest = latest_per_key(trades, "symbol", ["id"])
    assert {(r.symbol, r.id, r.price) for r in newest.collect()} == {("A", 5, 3.0), ("B", 2, 10.0)}
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
